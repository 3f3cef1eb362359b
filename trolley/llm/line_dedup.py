"""Line dedup against levelled sorted runs of line hashes.

Every batch of documents is compared with the runs of earlier batches by merge anti-joins; hashes not
found there are written as a run of their own, sorted by hash. When a level has ``fanout`` runs they
are merged into one run of the next level, so that a batch meets few runs however many batches came
before. Runs are bucketed by hash: a new batch is shuffled to them, the runs stay where they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trolley.llm.common import BLANKS, NO_ID, fresh_path, remove, stored

LEAST = 10
BATCHES = 4
FANOUT = 3
SLICE = 256


def _keys(texts: pa.Array) -> tuple[pa.Array, pa.Array, list[bytes | None]]:
    """The lines of all texts, the row of each, and its key's hash if the key is long enough."""
    lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    lines = lists.flatten()
    keys = pc.ascii_lower(pc.utf8_trim(lines, characters=BLANKS))
    long = pc.greater_equal(pc.utf8_length(keys), LEAST).to_pylist()
    hashes = [xxhash.xxh3_128_digest(k) if enough else None for k, enough in zip(keys.cast(pa.binary()).to_pylist(), long, strict=True)]
    return lines, pc.list_parent_indices(lists), hashes


def line_hashes(docs: DataFrame) -> DataFrame:
    """(hash, doc_id, text_key) of every distinct key of a row, of keys with at least ``LEAST`` code points;
    text_key stands for the row's text."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, len(whole), SLICE):
                batch = whole.slice(a, SLICE)
                _, parents, hashes = _keys(batch.column(1))
                ids, texts = batch.column(0).to_pylist(), batch.column(2).to_pylist()
                found = sorted({(h, ids[p], texts[p]) for h, p in zip(hashes, parents.to_pylist(), strict=True) if h})
                columns = zip(*found, strict=True) if found else ((),) * 3
                made = [pa.array(c, t) for c, t in zip(columns, (pa.binary(), pa.int64(), pa.int64()), strict=True)]
                yield pa.RecordBatch.from_arrays(made, ["hash", "doc_id", "text_key"])

    return docs.select(_id().alias("doc_id"), "text", _text_key().alias("text_key")).mapInArrow(run, "hash binary, doc_id bigint, text_key bigint")


def _id():
    return F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID))


def _text_key():
    return F.xxhash64(F.coalesce("text", F.lit("")))


class LineRuns:
    """The runs of one corpus. ``levels[i]`` names the runs of level i."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = [[]]
        self.paths: dict[str, str] = {}

    def runs(self) -> list[DataFrame]:
        return [self.spark.table(name) for level in self.levels for name in level]

    def _write(self, hashes: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        self.paths[name] = fresh_path(self.spark, name)
        dealt = hashes.select("hash", "doc_id").repartition(self.buckets, "hash")
        dealt.write.format("parquet").option("path", self.paths[name]).bucketBy(self.buckets, "hash").sortBy("hash").saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE {name}")
        remove(self.spark, self.paths.pop(name))

    def add(self, lines: DataFrame) -> DataFrame:
        """Add a batch's (hash, doc_id); returns the owners among them: the batch's smallest doc_id of
        each hash that no run has."""
        first = lines.groupBy("hash").agg(F.min("doc_id").alias("doc_id"))
        name = self._write(reduce(lambda new, run: new.join(run.hint("merge"), "hash", "left_anti"), self.runs(), first))
        self.levels[0].append(name)
        owners = stored(self.spark.table(name), "owners")
        self._compact()
        return owners

    def _compact(self) -> None:
        level = 0
        while len(self.levels[level]) >= self.fanout:
            if level + 1 == len(self.levels):
                self.levels.append([])
            old = self.levels[level]
            self.levels[level + 1].append(self._write(reduce(DataFrame.unionAll, map(self.spark.table, old))))
            self.levels[level] = []
            for name in old:
                self._drop(name)
            level += 1

    def close(self) -> None:
        for level in self.levels:
            for name in level:
                self._drop(name)
        self.levels = [[]]


def by_id(docs: DataFrame, batches: int) -> list[DataFrame]:
    """The documents in so many ranges of doc_id of about equal size, ascending; no id goes last."""
    if batches == 1:
        return [docs]
    cuts = docs.select(F.percentile_approx("doc_id", [i / batches for i in range(1, batches)], 10_000)).first()[0]
    bounds = sorted(set(cuts or []))
    if not bounds:
        return [docs]
    key = F.col("doc_id")
    inner = [docs.where((key > a) & (key <= b)) for a, b in zip(bounds, bounds[1:], strict=False)]
    return [docs.where(key <= bounds[0]), *inner, docs.where((key > bounds[-1]) | key.isNull())]


def repeated(batches: list[DataFrame], runs: LineRuns) -> DataFrame:
    """(doc_id, text_key, dropped hashes) of the rows that lose lines, given batches in order of age.

    Hashes are gathered per text, so a list holds no more than the lines of one text, however many rows
    share a doc_id, or have none."""
    lost = []
    for batch in batches:
        lines = line_hashes(batch)
        owners = runs.add(lines)
        lost.append(stored(lines.join(owners, ["hash", "doc_id"], "left_anti"), "lost"))
    return reduce(DataFrame.unionAll, lost).groupBy("doc_id", "text_key").agg(F.collect_set("hash").alias("_lost"))


def dedup_lines(docs: DataFrame, batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """``docs`` with the repeated lines gone from ``text``, and ``n_lines``, ``n_dropped``.

    A line's key is the line without ASCII blanks at both ends, A-Z in lower case. A key of at least
    ``LEAST`` code points stays in the document with the smallest doc_id only, with all its lines
    there. Rows of equal doc_id are one document; rows without doc_id are one that comes last. NULL
    text is one empty line and becomes empty. Other columns stay as they are, but for ``n_lines`` and
    ``n_dropped``, which are replaced. An empty table stays empty.
    """
    runs = LineRuns(docs.sparkSession, fanout)
    try:
        lost = repeated(by_id(docs, batches), runs)
    finally:
        runs.close()
    plain = docs.drop("n_lines", "n_dropped")
    lost = lost.withColumnsRenamed({"doc_id": "_lost_id", "text_key": "_lost_text"})
    same = (_id() == F.col("_lost_id")) & (_text_key() == F.col("_lost_text"))
    joined = plain.join(lost, same, "left").drop("_lost_id", "_lost_text")
    at = plain.columns.index("text")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)

    def run(rows: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in rows:
            for a in range(0, len(whole), SLICE):
                batch = whole.slice(a, SLICE)
                gone = [set(x or ()) for x in batch.column(batch.num_columns - 1).to_pylist()]
                lines, parents, hashes = _keys(batch.column(at))
                kept: list[list[str]] = [[] for _ in gone]
                counts = [0] * len(gone)
                for line, row, own in zip(lines.to_pylist(), parents.to_pylist(), hashes, strict=True):
                    counts[row] += 1
                    if own not in gone[row]:
                        kept[row].append(line)
                columns = batch.columns[:-1]
                columns[at] = pa.array(["\n".join(x) for x in kept], pa.string())
                dropped = [n - len(x) for n, x in zip(counts, kept, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(counts, pa.int64()), pa.array(dropped, pa.int64())], [*batch.schema.names[:-1], "n_lines", "n_dropped"]
                )

    return joined.mapInArrow(run, f"{schema}, n_lines bigint, n_dropped bigint")
