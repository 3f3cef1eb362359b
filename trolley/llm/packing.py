"""Packing token sequences: best-fit decreasing into windows of a fixed capacity.

Overlong documents are first cut into full windows. What remains goes, longest piece first, into the
open window it fills best; a segment tree indexed by remaining capacity finds that window.
"""

from __future__ import annotations

import functools
import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import stored

CAPACITY = 1024
END = 0
#: Pieces packed together in one task, on average. The more, the less padding.
GROUP_PIECES = 16_384
SLICE = 64
#: Where both libraries are known to split alike (see the tests).
PLAIN = re.compile("[\x00-ɏ]*")
PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"
_TYPES = [pa.int64()] * 5


class Tokens:
    """Ids of a byte-level BPE vocabulary, with no mark added. ``ranks`` is the same vocabulary for the
    faster library, which gets the texts of plain Latin script without special tokens; the rest goes to
    the tokenizer itself. With ``special`` the strings of special tokens in a text are those tokens, as
    the tokenizer takes them by itself; without, they are text like any other."""

    def __init__(self, path: str, ranks: str | None = None, special: bool = True):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()] if special else []
        self.fast = None
        if ranks:
            import base64

            import public_tokenizers
            import tiktoken

            with open(ranks, "rb") as file:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
            self.fast = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if self.fast and PLAIN.fullmatch(text) and not any(m in text for m in self.marks):
            return np.array(self.fast.encode_ordinary(text), "<u4")
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")


@functools.lru_cache(maxsize=4)
def tokens(path: str, ranks: str | None) -> Tokens:
    """The vocabulary of a file, loaded once per Python worker."""
    return Tokens(path, ranks)


def document_ids(text: str | None, path: str, ranks: str | None) -> np.ndarray:
    """A document's ids: those of its text (NULL: empty), then the end mark."""
    return np.append(tokens(path, ranks).encode(text or ""), np.uint32(END)).astype("<u4")


def pieces(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """Every document cut into full windows and one rest (columns: ``PIECES``, and with ``ids`` the
    ids of each piece).

    Rows of equal doc_id are documents of their own; a NULL doc_id stays NULL. Rows go one to many in
    place; nothing is shuffled.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), SLICE):
                rows, cut = [], []
                for doc_id, text in zip(*(c.to_pylist() for c in whole.slice(a, SLICE).columns), strict=True):
                    own = document_ids(text, path, ranks)
                    for start in range(0, len(own), capacity):
                        piece = own[start : start + capacity]
                        rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(own)))
                        cut.append(piece)
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                if ids:
                    made.append(pa.array(cut, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(made, [c.split()[0] for c in PIECES.split(", ")] + ["ids"] * ids)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, PIECES + ", ids array<bigint>" * ids)


class OpenWindows:
    """Windows by remaining capacity. The tree's leaf r counts the windows with r left, an inner node
    those below it."""

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.counts = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def put(self, left: int, window: int) -> None:
        self.windows[left].append(window)
        self._add(left, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """(left, window) of the window with the least capacity that is enough."""
        counts, node = self.counts, self.leaves + need
        if not counts[node]:
            while node > 1 and (node & 1 or not counts[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if counts[2 * node] else 2 * node + 1
        left = node - self.leaves
        self._add(left, -1)
        return left, self.windows[left].pop()

    def _add(self, left: int, change: int) -> None:
        node = self.leaves + left
        while node:
            self.counts[node] += change
            node >>= 1


def best_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Window and offset of each length, given in descending order."""
    free, window_of, offset_of, made = OpenWindows(capacity), [], [], 0
    for length in lengths:
        found = free.take(length) if length < capacity else None
        left, window = found or (capacity, made)
        made += found is None
        window_of.append(window)
        offset_of.append(capacity - left)
        if left > length:
            free.put(left - length, window)
    return window_of, offset_of


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """``cut`` (as ``pieces`` returns it) with ``sequence_id`` and ``offset`` in that sequence.

    Pieces are dealt at random, row by row, to groups of about ``group_pieces``, each packed by one task;
    equal rows are dealt apart, too. Only the few columns of a piece are shuffled, not its ids. A sequence is named by its group and its number
    there. Lengths lie between 1 and ``capacity``. Longest first, ties by doc_id, start. Extra columns
    stay.
    """
    groups = max(1, -(-cut.count() // group_pieces))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending")])
        group = table.column("_group")[0].as_py()
        window, offset = best_fit(table.column("length").to_pylist(), capacity)
        out = table.drop_columns(["_group"])
        return out.append_column("sequence_id", pa.array(np.array(window, np.int64) + (group << 40))).append_column(
            "offset", pa.array(offset, pa.int64())
        )

    # The place of a row in its input split; a task that runs again reads the same split.
    dealt = cut.withColumn("_group", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("_group").applyInArrow(run, f"{schema}, sequence_id bigint, offset bigint")


def packed(docs: DataFrame, path: str, ranks: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Where every piece of every document lies. The pieces are written once: texts are tokenised a
    single time, whatever the packing needs to know about them."""
    return pack(stored(pieces(docs, path, ranks, capacity), "pieces"), capacity)


def sequences(placed: DataFrame) -> DataFrame:
    """The packed ids: one row per sequence, from ``pack(pieces(..., ids=True))``.

    A sequence holds at most its capacity, so its row is bounded."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "doc_id", "start", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("_parts")).select(
        "sequence_id",
        F.flatten("_parts.ids").alias("ids"),
        F.col("_parts.doc_id").alias("doc_ids"),
        F.col("_parts.offset").alias("offsets"),
    )
