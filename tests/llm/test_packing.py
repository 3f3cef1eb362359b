import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from trolley.llm import packing

PATH, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


def reference():
    return Tokenizer.from_file(PATH)


def test_strings_of_special_tokens():
    """By default as the tokenizer takes them; as plain text if asked."""
    plain = Tokenizer.from_file(PATH)
    plain.encode_special_tokens = True
    for text in ("end <|endoftext|> here", "<|endoftext|>", "é<|endoftext|>漢", "<|endoftext"):
        own = packing.Tokens(PATH, RANKS).encode(text).tolist()
        assert own == reference().encode(text, add_special_tokens=False).ids
        assert (50256 in own) == ("text|>" in text)
        assert packing.Tokens(PATH, RANKS, special=False).encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_equal_rows_without_doc_id_are_dealt_apart(spark):
    docs = spark.range(2000).selectExpr("CAST(NULL AS long) AS doc_id", "'the same few words' AS text").repartition(4)
    placed = packing.pack(packing.stored(packing.pieces(docs, PATH, RANKS), "pieces"), group_pieces=100).collect()
    groups = {}
    for r in placed:
        groups[r.sequence_id >> 40] = groups.get(r.sequence_id >> 40, 0) + 1
    assert len(groups) == 20 and max(groups.values()) < 200 and sum(groups.values()) == 2000


def test_both_libraries_agree_on_plain_text():
    own, fast = reference(), packing.Tokens(PATH, RANKS)
    for point in range(0x250):
        for text in (chr(point), f"a{chr(point)}b", f"1{chr(point)} {chr(point)}\n{chr(point)}'s"):
            assert packing.PLAIN.fullmatch(text)
            assert fast.encode(text).tolist() == own.encode(text, add_special_tokens=False).ids


def plain_best_fit(lengths, capacity):
    free, out = [], []
    for length in lengths:
        fits = [left for left in free if left >= length]
        left = min(fits, default=None)
        if left is None:
            free.append(capacity)
            left = capacity
        free.remove(left)
        free.append(left - length)
        out.append(capacity - left)
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 32), max_size=60))
def test_tightest_window(lengths):
    lengths.sort(reverse=True)
    window, offset = packing.best_fit(lengths, 32)
    assert offset == plain_best_fit(lengths, 32)
    filled = {}
    for w, o, n in zip(window, offset, lengths, strict=True):
        assert filled.get(w, 0) == o
        filled[w] = o + n
    assert all(v <= 32 for v in filled.values())


def test_every_id_lies_in_one_place(spark, odd_docs, no_docs):
    cut = packing.pieces(odd_docs, PATH, RANKS, ids=True)
    rows = packing.pack(cut, group_pieces=8).collect()
    own, whole = reference(), {}
    for r in rows:
        assert len(r.ids) == r.length <= 1024 and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        whole.setdefault(r.doc_id, []).append((r.start, r.ids))
    for doc_id, text in ((r.doc_id, r.text) for r in odd_docs.collect()):
        if doc_id != 3:
            assert sum((ids for _, ids in sorted(whole[doc_id])), []) == [*own.encode(text or "", add_special_tokens=False).ids, 0]
    spans = {}
    for r in rows:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.offset + r.length))
    for parts in spans.values():
        parts.sort()
        assert [a for a, _ in parts] == [0, *(b for _, b in parts[:-1])] and parts[-1][1] <= 1024
    assert packing.sequences(packing.pack(cut)).count() > 0
    assert packing.packed(no_docs, PATH, RANKS).count() == 0


def test_little_padding(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    fill = [r[0] for r in packing.packed(docs, PATH, RANKS).groupBy("sequence_id").sum("length").select("sum(length)").collect()]
    assert sum(1024 - n for n in fill if n & (n - 1)) / sum(fill) < 0.02
