import random

import public_tokenizers
import sentencepiece
from sentencepiece import sentencepiece_model_pb2

from trolley.llm import sentencepieces
from trolley.llm.sentencepieces import CharacterMap, Codec

PATH = public_tokenizers.path("piece_bpe_32k.model")
ALPHABET = " abcdefé  ▁\n\tßñ漢字😀́ﬁ①  the and　"


def texts(n, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(ALPHABET, k=rnd.randint(0, 40))) for _ in range(n)]


def test_ids_and_spans_are_the_librarys():
    codec = Codec(PATH)
    for text in texts(2_000):
        ids, starts, ends = codec.encode(text)
        pieces = codec.library.encode(text, return_type="proto").pieces
        assert ids.tolist() == [p.id for p in pieces]
        assert [*zip(starts.tolist(), ends.tolist(), strict=True)] == [(p.begin, p.end) for p in pieces]
        assert codec.decode(ids) == codec.library.decode(ids.tolist())


def test_character_maps_are_the_librarys():
    for rule in ("nmt_nfkc", "nfkc_cf"):
        for squeeze in (True, False):
            normalizer = sentencepiece.SentencePieceNormalizer(
                rule_name=rule, add_dummy_prefix=True, escape_whitespaces=True, remove_extra_whitespaces=squeeze
            )
            model = sentencepiece_model_pb2.ModelProto.FromString(normalizer.serialized_model_proto())
            codec = Codec.__new__(Codec)
            codec.map, codec.dummy, codec.escape, codec.squeeze = CharacterMap(model.normalizer_spec.precompiled_charsmap), True, True, squeeze
            for text in texts(1_500, 2):
                out, align = codec.normalise(text)
                shown, offsets = normalizer.normalize(text, with_offsets=True)
                assert out.decode() == shown
                at = [len(shown[:i].encode()) for i in range(len(shown) + 1)]
                assert [len(text.encode()[: align[i]].decode()) for i in at] == [*offsets]


def test_odd_documents(spark, odd_docs, no_docs):
    rows = sentencepieces.encoded(odd_docs, PATH, ["doc_id", "hash"])
    back = sentencepieces.decoded(rows, PATH, ["doc_id"]).join(odd_docs.select("doc_id", "text"), "doc_id")
    assert all(r.decoded == (r.text or "") for r in back.collect())
    assert rows.count() == odd_docs.count()
    assert sentencepieces.digests(no_docs, PATH, ["doc_id"]).count() == 0
