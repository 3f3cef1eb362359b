import collections
import hashlib
import random

import public_tokenizers
import pytest

from trolley.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TEXTS = [
    "The quick brown fox, 12345 times.\n\nEnd",
    "The quick brown fox, 12345 times.\n\nEnd",
    "Über-größe 漢字かな 😀😀 ▁ odd",
    "漢字かな交じり文 😀 и кириллица",
    "<|endoftext|> plain <s> </s> <0x41>A",
    "   spaces   and\ttabs\r\n\x00\x07",
    "x" * 3000,
    "ab " * 2000,
    "▁",
    "",
    None,
]


def plain(texts):
    """Groups and links one token at a time, by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer

    first = Tokenizer.from_file(A)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=B)
    # A byte's character in such vocabularies, from the library's own pre-tokenizer.
    from tokenizers.pre_tokenizers import ByteLevel

    letters = {}
    for char in [chr(c) for c in range(0x80)] + [chr(c) for c in (*range(0x80, 0x800), *range(0x800, 0xD800, 61), *range(0xE000, 0x110000, 4001))]:
        shown = "".join(p for p, _ in ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(char))
        letters.update(zip(shown, char.encode(), strict=True))
    documents = []
    for text in texts:
        if not text:
            documents.append([])
            continue
        left = [(i, bytes(letters[c] for c in first.id_to_token(i))) for i in first.encode(" " + text, add_special_tokens=False).ids]
        right = []
        for i in second.encode(text):
            piece = second.id_to_piece(i)
            right.append((i, bytes([int(piece[3:5], 16)]) if second.is_byte(i) else piece.replace("▁", " ").encode()))
        source = (" " + text).encode()
        if any(b"".join(x for _, x in side) != source for side in (left, right)):
            documents.append([])
            continue
        ends = [set(), set()]
        for side, seen in zip((left, right), ends, strict=True):
            at = 0
            for _, x in side:
                at += len(x)
                seen.add(at)
        groups = []
        for start, end in zip([0, *sorted(ends[0] & ends[1])], sorted(ends[0] & ends[1]), strict=False):
            group = []
            for side in (left, right):
                at, own = 0, []
                for i, x in side:
                    if start <= at < end:
                        own.append(i)
                    at += len(x)
                group.append(own)
            groups.append(group)
        documents.append(groups)
    counts = collections.Counter()
    for groups in documents:
        counts.update({(a, b) for x, y in groups for a in x for b in y})
    best = collections.Counter()
    for (a, _), n in counts.items():
        best[a] = max(best[a], n)
    out = []
    for groups in documents:
        links = [(a, b) for x, y in groups for a in x for b in y]
        listed = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append(
            (
                sum(len(x) for x, _ in groups),
                sum(len(y) for _, y in groups),
                len(groups),
                len(links),
                sum(counts[p] == best[p[0]] for p in links),
                sum(counts[p] for p in links),
                hashlib.sha256(listed.encode()).hexdigest() if groups else "",
            )
        )
    return out


@pytest.mark.parametrize("frequent, held", [(alignment.FREQUENT, alignment.HELD), (20, 64), (0, 1)])
def test_against_plain_alignment(spark, monkeypatch, frequent, held, small):
    """Also with most pairs' counts joined instead of looked up, and handed on early."""
    monkeypatch.setattr(alignment, "HELD", held)
    texts = [t[:300] for t in random.Random(1).sample([r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()], 25)]
    texts = TEXTS + texts
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id long, text string").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in alignment.link_counts(docs, A, B, RANKS, frequent=frequent).collect()}
    assert got == dict(enumerate(plain(texts)))


def test_odd_documents(spark, odd_docs, no_docs):
    rows = alignment.link_counts(odd_docs, A, B, RANKS).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        if r.doc_id in (0, 1):
            assert tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "")
    twins = [tuple(r)[1:] for r in rows if r.doc_id in (6, 8)]
    assert twins[0] == twins[1] and twins[0][0] > 0
    assert alignment.link_counts(no_docs, A, B, RANKS).collect() == []


def test_identity_map():
    assert alignment.identity_map([b"a", b"b", b"", b"d"], [b"", b"a", b"d", b"a"]).tolist() == [3, -1, -1, 2]
    assert sorted(alignment.byte_alphabet().values()) == [*range(256)]
