"""Alignment of two tokenizers' tokens by the bytes they stand for.

Offsets where tokens of both end cut a text into groups, and tokens of one group are linked. Mostly a
group is one token of each with the same bytes; an array from A's ids to B's ids of the same bytes
finds these, and they are counted in one vector as long as the vocabulary per task. Only the pairs of
other groups are shuffled to be counted.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import stored
from trolley.llm.packing import Tokens

SPACE = "▁"
#: Irregular pairs whose counts every task looks up: those of most documents, at most so many. The
#: counts of all others are joined.
FREQUENT = 1 << 19
#: Distinct pairs a task holds before it hands their counts on.
HELD = 1 << 20
SLICE = 64

#: Per document: the digests, A ids of linked identity pairs and how often each is linked, and the same
#: for all other pairs. ``row`` tells equal rows apart.
ALIGNED = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
    "same array<int>, same_times array<bigint>, a array<int>, b array<int>, times array<bigint>"
)
_NAMES = [c.split()[0] for c in ALIGNED.split(", ")]
_TYPES = [*[pa.int64()] * 5, pa.string(), pa.list_(pa.int32()), pa.list_(pa.int64()), *[pa.list_(pa.int32())] * 2, pa.list_(pa.int64())]


def byte_alphabet() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte: printable ones as themselves,
    the rest in ascending order from U+0100."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    other = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(other)}


def byte_level_vocabulary(path: str) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary; added tokens are their own text."""
    from tokenizers import Tokenizer

    tokenizer, alphabet = Tokenizer.from_file(path), byte_alphabet()
    added = tokenizer.get_added_tokens_decoder()
    out = []
    for i in range(tokenizer.get_vocab_size(with_added_tokens=True)):
        entry = tokenizer.id_to_token(i) or ""
        out.append(entry.encode() if i in added else bytes(alphabet[c] for c in entry))
    return out


def piece_vocabulary(model) -> list[bytes]:
    """The bytes of each piece: <0xHH> as that byte, others in UTF-8 with U+2581 as space."""
    pieces = [(i, model.id_to_piece(i)) for i in range(model.get_piece_size())]
    return [bytes([int(p[3:5], 16)]) if model.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in pieces]


class Aligner:
    """Two vocabularies: A of byte-level BPE (``ranks`` for the faster library), B of SentencePiece."""

    def __init__(self, a: str, b: str, ranks: str | None = None):
        import sentencepiece

        self.tokens = Tokens(a, ranks, special=False)
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=b)
        self.a_bytes, self.b_bytes = byte_level_vocabulary(a), piece_vocabulary(self.pieces)
        self.a_len, self.b_len = (np.array([len(x) for x in v], np.int64) for v in (self.a_bytes, self.b_bytes))
        self.same = identity_map(self.a_bytes, self.b_bytes)
        names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.names = np.array(names, object)

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """A's ids of space + text and B's ids of text, none if the text is empty or either's bytes
        are not those of space + text."""
        empty = np.empty(0, np.int64)
        if not text:
            return empty, empty
        spaced = " " + text
        a, b = self.tokens.encode(spaced).astype(np.int64), np.array(self.pieces.encode(text), np.int64)
        source = spaced.encode()
        for ids, known in ((a, self.a_bytes), (b, self.b_bytes)):
            if b"".join([known[i] for i in ids.tolist()]) != source:
                return empty, empty
        return a, b

    def groups(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of the group of each token of A and of B."""
        a_end, b_end = self.a_len[a].cumsum(), self.b_len[b].cumsum()
        cuts = np.intersect1d(a_end, b_end, assume_unique=True)
        return np.searchsorted(cuts, a_end), np.searchsorted(cuts, b_end)

    def listed(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> str:
        """The groups as ``a1,a2|b1;a3|b2,b3``."""
        if not len(a):
            return ""
        n = int(of_a[-1]) + 1
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        before_a, before_b = in_a.cumsum(), in_b.cumsum() - in_b
        parts = np.empty(2 * (len(a) + len(b)), object)
        at_a, at_b = np.arange(len(a)) + before_b[of_a], np.arange(len(b)) + before_a[of_b]
        parts[2 * at_a], parts[2 * at_b] = self.names[a], self.names[b]
        parts[1::2] = ","
        ends = (in_a + in_b).cumsum()
        parts[2 * (ends - in_b) - 1] = "|"
        parts[2 * ends - 1] = ";"
        return "".join(parts[:-1].tolist())

    def links(self, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A ids of identity pairs, times each is linked, keys of other pairs, times)."""
        n = int(of_a[-1]) + 1 if len(a) else 0
        in_a, in_b = np.bincount(of_a, minlength=n), np.bincount(of_b, minlength=n)
        single = (in_a == 1) & (in_b == 1)
        one_a, one_b = a[single[of_a]], b[single[of_b]]
        exact = self.same[one_a] == one_b
        keys, times = [one_a[~exact] << 32 | one_b[~exact]], [np.ones(int((~exact).sum()), np.int64)]
        rest = np.flatnonzero(~single)
        if len(rest):
            # Equal ids of a group are one with a number, so a pair of ids comes once per group.
            left, right = _multiset(a, of_a, ~single), _multiset(b, of_b, ~single)
            first, last = np.searchsorted(right[0], left[0]), np.searchsorted(right[0], left[0], "right")
            widths = last - first
            own = np.repeat(np.arange(len(widths)), widths)
            other = np.arange(len(own)) - np.repeat(widths.cumsum() - widths, widths) + first[own]
            keys.append(left[1][own] << 32 | right[1][other])
            times.append(left[2][own] * right[2][other])
        key, number = _summed(np.concatenate(keys), np.concatenate(times))
        identity = self.same[key >> 32] == (key & 0xFFFFFFFF)
        same, often = _summed(
            np.concatenate([one_a[exact], key[identity] >> 32]), np.concatenate([np.ones(int(exact.sum()), np.int64), number[identity]])
        )
        return same, often, key[~identity], number[~identity]


def identity_map(a_bytes: list[bytes], b_bytes: list[bytes]) -> np.ndarray:
    """For each A id the B id of the same bytes, -1 if there is none; of several the largest."""
    of_bytes = {own: i for i, own in enumerate(b_bytes) if own}
    return np.array([of_bytes.get(own, -1) for own in a_bytes], np.int64)


def _multiset(ids: np.ndarray, of: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) of the distinct ids of each wanted group, by group."""
    here = wanted[of]
    key, times = np.unique(of[here] << 32 | ids[here], return_counts=True)
    return key >> 32, key & 0xFFFFFFFF, times


def _summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, ascending, and their values added up."""
    distinct, at = np.unique(keys, return_inverse=True)
    out = np.zeros(len(distinct), np.int64)
    np.add.at(out, at, values)
    return distinct, out


@functools.lru_cache(maxsize=2)
def aligner(a: str, b: str, ranks: str | None) -> Aligner:
    """The vocabularies of the files, loaded once per Python worker."""
    return Aligner(a, b, ranks)


def aligned(docs: DataFrame, a: str, b: str, ranks: str | None = None, text: str = "text") -> DataFrame:
    """Rows of ``ALIGNED``, one per document: its tokens' groups and links, each id pair once.

    Rows go one to one; nothing is shuffled. The files must be readable on the executors.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a, b, ranks)
        for whole in batches:
            for at in range(0, len(whole), SLICE):
                batch, rows = whole.slice(at, SLICE), []
                for doc_id, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    ids_a, ids_b = own.encode(value or "")
                    of_a, of_b = own.groups(ids_a, ids_b)
                    same, often, keys, times = own.links(ids_a, ids_b, of_a, of_b)
                    listed = own.listed(ids_a, ids_b, of_a, of_b)
                    digest = hashlib.sha256(listed.encode()).hexdigest() if listed else ""
                    n_groups = int(of_a[-1]) + 1 if len(ids_a) else 0
                    n_links = int(often.sum() + times.sum())
                    rows.append(
                        (doc_id, len(ids_a), len(ids_b), n_groups, n_links, digest, same, often, keys >> 32, keys & 0xFFFFFFFF, times)
                    )
                made = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(made, _NAMES)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, ALIGNED)


def _flat(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.int64)


def _sizes(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)


def pair_counts(rows: DataFrame) -> DataFrame:
    """(same, key, n): in how many documents each pair is linked. ``same``: key is the A id of an
    identity pair, else A id and B id in 32 bits each.

    A task counts identity pairs in a vector over the vocabulary, and of the others hands on at most
    one row per pair for every ``HELD`` pairs it reads.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vector = np.zeros(1, np.int64)
        held: list[np.ndarray] = []
        size = 0

        def handed(flag: bool, keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), flag)), pa.array(keys), pa.array(counts)], ["same", "key", "n"])

        for batch in batches:
            own = np.bincount(_flat(batch, "same"), minlength=len(vector))
            own[: len(vector)] += vector
            vector = own
            held.append(_flat(batch, "a") << 32 | _flat(batch, "b"))
            size += len(held[-1])
            if size > HELD:
                yield handed(False, *np.unique(np.concatenate(held), return_counts=True))
                held, size = [], 0
        if size:
            yield handed(False, *np.unique(np.concatenate(held), return_counts=True))
        used = np.flatnonzero(vector)
        yield handed(True, used, vector[used])

    counted = rows.select("same", "a", "b").mapInArrow(run, "same boolean, key bigint, n bigint")
    return counted.groupBy("same", "key").agg(F.sum("n").alias("n"))


def _best(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """A ids and the highest count of a pair of each; one row per id of the vocabulary."""
    a = F.when(F.col("same"), F.col("key")).otherwise(F.shiftright("key", 32))
    best = counts.groupBy(a.alias("a")).agg(F.max("n").alias("n")).toArrow().sort_by("a")
    return tuple(best.column(c).to_numpy().astype(np.int64) for c in ("a", "n"))


def _found(keys: np.ndarray, known: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether each key is among the sorted known ones, and its value (else 0)."""
    if not len(known):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    there = known[at] == keys
    return there, np.where(there, values[at], 0)


def link_counts(docs: DataFrame, a: str, b: str, ranks: str | None = None, text: str = "text", frequent: int = FREQUENT) -> DataFrame:
    """Per document: tokens of A and B, groups, links, links with their A id's commonest partner
    (``n_best``), the sum of all links' counts (``count_sum``) and the digest of its groups.

    A pair's count is the number of documents in which it is linked; a link counts as often as it
    occurs. Texts that are NULL, empty, or that either tokenizer doesn't keep byte for byte have no
    tokens: zeros and an empty digest. Rows of equal doc_id, and rows without one, are documents of
    their own. Other columns are ignored; an empty table gives no rows.

    Every text is tokenized once, into a written table. Counts of all identity pairs and of the
    ``frequent`` commonest others travel to the tasks (bounded by the vocabulary and by that
    parameter); the rest, each in few documents, is joined, one row per document and pair.
    """
    rows = aligned(docs, a, b, ranks, text).withColumn("row", F.monotonically_increasing_id())
    rows = stored(rows, "aligned")  # The numbers of the rows are fixed from here on.
    counts = stored(pair_counts(rows), "pairs")
    spark = rows.sparkSession
    same = counts.where("same").select("key", "n").toArrow().sort_by("key")
    often = counts.where("NOT same").orderBy(F.desc("n"), "key").select("key", "n").limit(frequent).toArrow().sort_by("key")
    tables = [t.column(c).to_numpy().astype(np.int64) for t in (same, often) for c in ("key", "n")]
    known = spark.sparkContext.broadcast((*tables, *_best(counts)))
    n_pairs = counts.where("NOT same").count()
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "row"]

    def sums(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        same_keys, same_n, keys, n, best_a, best_n = known.value
        for batch in batches:
            best, total = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            left, right = _flat(batch, "a"), _flat(batch, "b")
            for ids, pairs, of, numbers, values, times in (
                (_flat(batch, "same"), _flat(batch, "same"), "same", same_keys, same_n, "same_times"),
                (left, left << 32 | right, "a", keys, n, "times"),
            ):
                there, count = _found(pairs, numbers, values)
                doc = np.repeat(np.arange(len(batch)), _sizes(batch, of))
                often = _flat(batch, times)
                np.add.at(total, doc, often * count)
                np.add.at(best, doc, often * (there & (count == _found(ids, best_a, best_n)[1])))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(best), pa.array(total)], [*kept, "n_best", "count_sum"])

    kinds = ", ".join(f"{c} {t}" for c, t in rows.select(*kept).dtypes)
    out = rows.mapInArrow(sums, f"{kinds}, n_best bigint, count_sum bigint")
    if n_pairs > frequent:
        out = _with_rare(out, rows, counts, known)
    return out.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def _with_rare(out: DataFrame, rows: DataFrame, counts: DataFrame, known) -> DataFrame:
    """``out`` with the pairs added whose counts the tasks did not know."""

    def rare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, _, keys, n, best_a, best_n = known.value
        for batch in batches:
            pairs = _flat(batch, "a") << 32 | _flat(batch, "b")
            other = ~_found(pairs, keys, n)[0]
            of = np.repeat(batch.column("row").to_numpy(), _sizes(batch, "a"))[other]
            highest = _found(pairs[other] >> 32, best_a, best_n)[1]
            columns = [of, pairs[other], _flat(batch, "times")[other], highest]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["row", "key", "times", "highest"])

    left = rows.select("row", "a", "b", "times").mapInArrow(rare, "row bigint, key bigint, times bigint, highest bigint")
    joined = left.join(counts.where("NOT same").select("key", "n"), "key")
    best = F.sum(F.when(F.col("n") == F.col("highest"), F.col("times")).otherwise(F.lit(0)))
    added = joined.groupBy("row").agg(best.alias("_best"), F.sum(F.col("times") * F.col("n")).alias("_sum"))
    return out.join(added, "row", "left").withColumns(
        {
            "n_best": F.col("n_best") + F.coalesce("_best", F.lit(0)),
            "count_sum": F.col("count_sum") + F.coalesce("_sum", F.lit(0)),
        }
    )
