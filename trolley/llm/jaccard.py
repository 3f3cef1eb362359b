"""N-gram Jaccard join: a grouped prefix join.

Documents are sets of word shingles. Under one global order of shingles, two sets can be similar
enough only if their prefixes share a shingle. Documents with the same prefix and size are one group:
candidates are found between groups, and only then expanded to members and verified on whole sets.

A crowd of near copies would make a pair of groups for every two of them. To find components, links
that join what is joined already are not needed, so candidates come in two steps: first each group
against one hub of its bucket, then whatever pairs of a bucket still lie in different components.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import NO_ID, Scratch, stored
from trolley.llm.components import components

WORDS, PERCENT = 5, 80
#: Shingles known as frequent, at most; the order puts them last. The join is exact for any such set.
FREQUENT = 1 << 17
#: Documents whose keys may be broadcast to fetch their texts; beyond, the join shuffles.
BROADCAST_IDS = 1_000_000
SLICE_BYTES = 1 << 20
_BYTE = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


def shingle_sets(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct 64-bit hashes of each text's word shingles.

    Words are runs of bytes other than ASCII blanks, A-Z in lower case. A text with fewer words is one
    shingle; one without words, or NULL, has none. Texts are worked off in slices of ``SLICE_BYTES``.
    """
    texts = texts.cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    null = texts.is_null().to_numpy(zero_copy_only=False)
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    begin = 0
    while begin < len(texts):
        end = max(begin + 1, int(np.searchsorted(at, at[begin] + SLICE_BYTES, "right")) - 1)
        yield from _sets(data[at[begin] : at[end]], at[begin : end + 1] - at[begin], null[begin:end], words)
        begin = end


def _sets(raw: np.ndarray, at: np.ndarray, null: np.ndarray, k: int) -> Iterator[np.ndarray]:
    full = ~((raw == 32) | ((raw >= 9) & (raw <= 13)))
    edge = np.zeros(len(raw) + 1, bool)
    edge[at] = True
    starts = np.flatnonzero(full & (edge[:-1] | ~np.append(False, full[:-1])))
    ends = np.flatnonzero(full & (edge[1:] | ~np.append(full[1:], False))) + 1
    lower = raw + 32 * ((raw >= 65) & (raw <= 90)).astype(np.uint8)
    with np.errstate(over="ignore"):
        total = np.append(np.uint64(0), np.cumsum(_BYTE[lower] * _powers(_BASE, len(raw))[:-1], dtype=np.uint64))
        word = (total[ends] - total[starts]) * _powers(_BASE_INVERSE, len(raw))[starts]
        word = _mix(word + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        first = np.searchsorted(starts, at)
        n = np.diff(first)
        last = np.repeat(first[1:], n)
        index = np.arange(len(word))
        shingle = np.zeros(len(word), np.uint64)
        factors = _powers(np.uint64(0xC2B2AE3D27D4EB4F), k)
        for j in range(k):
            inside = index + j < last
            shingle[inside] += _mix(word[index[inside] + j] * factors[j + 1] + np.uint64(j))
        shingle = _mix(shingle)
    for i in range(len(n)):
        if null[i] or not n[i]:
            yield np.empty(0, np.uint64)
        elif n[i] < k:
            yield shingle[first[i] : first[i] + 1]
        else:
            yield np.unique(shingle[first[i] : first[i + 1] - k + 1])


def prefix_length(size: int, percent: int) -> int:
    """How many shingles of a set, first in the order, two similar sets can't both miss."""
    return size - -(-percent * size // 100) + 1 if size else 0


def _rows(batches: Iterable[pa.RecordBatch], words: int) -> Iterator[tuple[list, Iterator[np.ndarray]]]:
    for batch in batches:
        yield batch.column(0).to_pylist(), shingle_sets(batch.column(1), words)


def frequent_shingles(docs: DataFrame, words: int, most: int = FREQUENT) -> np.ndarray:
    """The shingles of most documents.

    Counted over all documents; a task reports those that it met at least twice, so counts are lower
    bounds. At most ``most`` come to the driver.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for _, sets in [*_rows(batches, words), (None, ())]:
            held += sets
            if _ is None or sum(map(len, held)) > 1 << 21:
                values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *held]), return_counts=True)
                often = counts > 1
                yield pa.RecordBatch.from_arrays([pa.array(values[often].view(np.int64)), pa.array(counts[often], pa.int64())], ["shingle", "n"])
                held = []

    counts = docs.select("doc_id", "text").mapInArrow(run, "shingle bigint, n bigint").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = counts.where("n > 8").orderBy(F.desc("n"), "shingle").limit(most)
    return np.sort(top.select("shingle").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))


SETS = "doc_id bigint, text_key bigint, n bigint, node bigint, grp bigint, prefix array<bigint>"


def prefixes(docs: DataFrame, words: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """Per document: size and hash of its set, its prefix under the order (frequent last, then by hash)
    and the hash of prefix and size. Columns: ``SETS``."""
    known = np.append(frequent, np.uint64(0))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for own in shingle_sets(batch.column(1), words):
                late = known[np.searchsorted(frequent, own)] == own
                prefix = np.concatenate([own[~late], own[late]])[: prefix_length(len(own), percent)]
                rows.append((len(own), _hash(own), _hash(prefix, len(own)), prefix.view(np.int64)))
            n, node, grp, prefix = zip(*rows, strict=True) if rows else ((),) * 4
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()))
            made = [pa.array(x, t) for x, t in zip((n, node, grp, prefix), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), *made], [c.split()[0] for c in SETS.split(", ")])

    return docs.select("doc_id", "text", "text_key").mapInArrow(run, SETS)


def _hash(own: np.ndarray, size: int | None = None) -> int:
    return xxhash.xxh3_64_intdigest(own.tobytes(), len(own) if size is None else size) - (1 << 63)


def _shipped(docs: DataFrame, asked: DataFrame, words: int) -> DataFrame:
    """(node, to, items): the whole sets of the classes in ``asked`` (doc_id, text_key, node, to). Keys
    are broadcast only when counted and few; else texts are shuffled to them."""
    asked = F.broadcast(asked) if asked.count() <= BROADCAST_IDS else asked

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[tuple[int, int]] = set()
            texts = batch.column(0).dictionary_encode()
            sets = [*shingle_sets(texts.dictionary, words)]
            rows = []
            for i, node, to in zip(texts.indices.to_pylist(), *(batch.column(c).to_pylist() for c in (1, 2)), strict=True):
                if i is not None and (node, to) not in seen:
                    seen.add((node, to))
                    rows.append((node, to, sets[i].view(np.int64)))
            columns = zip(*rows, strict=True) if rows else ((),) * 3
            made = [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.list_(pa.int64())), strict=True)]
            yield pa.RecordBatch.from_arrays(made, ["node", "to", "items"])

    joined = docs.select("doc_id", "text", "text_key").join(asked, ["doc_id", "text_key"])
    return joined.select("text", "node", "to").mapInArrow(run, "node bigint, to bigint, items array<bigint>")


def _verified(scratch: Scratch, docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are similar, by their whole sets: for each pair the set of a goes
    to b, and that of b goes there once."""
    ends = pairs.select(F.col("a").alias("node"), F.col("b").alias("to")).unionAll(pairs.select(F.col("b").alias("node"), F.col("b").alias("to")))
    asked = scratch.stored(ends.distinct().join(classes.select("node", "rep.doc_id", "rep.text_key"), "node"), "asked")
    sets = scratch.stored(_shipped(docs, asked, words), "sets")
    there = sets.where("node = to").select("to", F.col("items").alias("items_b"))
    joined = sets.where("node <> to").select(F.col("node").alias("a"), "to", F.col("items").alias("items_a")).join(there, "to")
    shared = F.size(F.array_intersect("items_a", "items_b"))
    union = F.size("items_a") + F.size("items_b") - shared
    return joined.where(shared * 100 >= union * percent).select("a", F.col("to").alias("b")).distinct()


def _alike(n: str, m: str, percent: int):
    """Sizes that similar sets can have."""
    return (F.col(n) * 100 >= F.col(m) * percent) & (F.col(m) * 100 >= F.col(n) * percent)


def _plausible(pairs: DataFrame, groups: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y) of groups that can be similar by size and by what their prefixes share.

    Of two sets, take the one whose prefix ends first: what they share and not both prefixes have lies
    behind that prefix. So they share no more than the prefixes do and the longer of the two rests.
    """
    one, two = (
        groups.select(F.col("grp").alias(c), F.col("n").alias(f"n_{c}"), F.col("prefix").alias(f"prefix_{c}")) for c in "xy"
    )
    known = pairs.join(one.drop("prefix_x"), "x").join(two.drop("prefix_y"), "y").where(_alike("n_x", "n_y", percent))
    joined = known.join(one.drop("n_x"), "x").join(two.drop("n_y"), "y")
    rest = F.greatest(F.col("n_x") - F.size("prefix_x"), F.col("n_y") - F.size("prefix_y"))
    most = F.size(F.array_intersect("prefix_x", "prefix_y")) + rest
    return joined.where(most * (100 + percent) >= (F.col("n_x") + F.col("n_y")) * percent).select("x", "y")


def near_duplicates(docs: DataFrame, words: int = WORDS, percent: int = PERCENT, keys: bool = False) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row.

    Two documents link when ``100 * shared >= percent * union`` of their distinct shingles of
    ``words`` words; component_id is the smallest doc_id that links reach, itself included. Documents
    without words (or with NULL text) have 0 shingles and are alone. Each row stands for its own text,
    also if a doc_id repeats; a NULL doc_id is linked like any other but never the name of a
    component, unless there is no other. Shingles are compared by 64-bit hashes. Other columns are
    ignored. With ``keys`` two columns more: ``text_key``, a hash of the text (of NULL text as of an
    empty one), and ``component``, which tells components apart also where none of a component has a
    doc_id (NULL for rows without shingles).
    """
    text = F.coalesce("text", F.lit(""))
    docs = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc_id"), "text", F.xxhash64(text).alias("text_key"))
    with Scratch(docs.sparkSession) as scratch:
        return _components(scratch, docs, words, percent, keys)


def _components(scratch: Scratch, docs: DataFrame, words: int, percent: int, keys: bool) -> DataFrame:
    whole = scratch.stored(prefixes(docs, words, percent, frequent_shingles(docs, words)), "prefixes")
    rows = stored(whole.select("doc_id", "text_key", "n", "node", "grp"), "rows")
    # Equal sets are one class, equal prefixes and sizes one group, so a group has one size and one prefix.
    rep = F.min(F.struct("doc_id", "text_key")).alias("rep")
    classes = scratch.stored(rows.where("n > 0").groupBy("node", "grp", "n").agg(rep), "classes")
    heads = classes.groupBy("grp").agg(F.min("node").alias("head"))
    groups = whole.where("n > 0").groupBy("grp").agg(F.first("n").alias("n"), F.first("prefix").alias("prefix"))
    groups = scratch.stored(groups, "groups")
    # Size and place in one number.
    postings = groups.select("grp", F.posexplode("prefix").alias("pos", "shingle"), "n")
    postings = postings.select("shingle", "grp", (F.col("n") * (1 << 32) + F.col("pos")).alias("at"))
    shared = postings.groupBy("shingle").agg(F.count(F.lit(1)).alias("many")).where("many > 1")
    postings = scratch.stored(postings.join(shared, "shingle"), "postings")
    # A bucket's hub is the group whose prefix is the commonest: the one that others are copies of.
    size = F.shiftright("at", 32)
    common = postings.groupBy("grp").agg((F.sum("many") / F.first(size)).alias("common"))
    hubs = postings.join(common, "grp").groupBy("shingle").agg(F.max(F.struct("common", "grp"))["grp"].alias("hub"))

    to_hub = postings.join(hubs, "shingle").where("grp <> hub").select(F.col("grp").alias("x"), F.col("hub").alias("y")).distinct()
    star = _plausible(to_hub, groups, percent)
    hub_heads = heads.select(F.col("grp").alias("y"), F.col("head").alias("b"))
    members = classes.select("grp", F.col("node").alias("a"))
    star = star.join(members.withColumnRenamed("grp", "x"), "x").join(hub_heads, "y").select("a", "b")
    inner = members.join(heads, "grp").where("a <> head").select("a", F.col("head").alias("b"))
    tried = scratch.stored(star.unionAll(inner), "candidates")
    links = scratch.stored(_verified(scratch, docs, classes, tried, words, percent), "links")

    roots = scratch.stored(_with_roots(classes, links), "roots")
    units = roots.select("grp", "root").distinct()
    buckets = postings.select("shingle", "grp", size.alias("n"), F.expr("at & 4294967295L").alias("pos")).join(units, "grp")
    mixed = buckets.groupBy("shingle").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("shingle")
    buckets = scratch.stored(buckets.join(mixed, "shingle", "left_semi"), "buckets")
    one, two = (buckets.select("shingle", *(F.col(c).alias(f"{c}_{s}") for c in ("grp", "n", "pos", "root"))) for s in "ab")
    # At the first shingle that two sets share, nothing before it counts; one row per pair must pass.
    rest = F.least(F.col("n_a") - F.col("pos_a"), F.col("n_b") - F.col("pos_b"))
    enough = rest * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent
    group_pairs = one.join(two, "shingle").where((F.col("root_a") < F.col("root_b")) & _alike("n_a", "n_b", percent) & enough)
    group_pairs = scratch.stored(group_pairs.select("grp_a", "root_a", "grp_b", "root_b").distinct(), "pairs")
    likely = _plausible(group_pairs.select(F.col("grp_a").alias("x"), F.col("grp_b").alias("y")).where("x <> y").distinct(), groups, percent)
    likely = likely.select(F.col("x").alias("grp_a"), F.col("y").alias("grp_b"))
    group_pairs = group_pairs.join(likely, ["grp_a", "grp_b"])
    # Two classes of one group have the same prefix.
    within = units.join(units.withColumnRenamed("root", "other"), "grp").where("root < other")
    within = within.select(F.col("grp").alias("grp_a"), F.col("grp").alias("grp_b"), F.col("root").alias("root_a"), F.col("other").alias("root_b"))
    left, right = (roots.select(F.col("grp").alias(f"grp_{s}"), F.col("root").alias(f"root_{s}"), F.col("node").alias(s)) for s in "ab")
    later = group_pairs.unionByName(within).distinct().join(left, ["grp_a", "root_a"]).join(right, ["grp_b", "root_b"]).select("a", "b")
    done = tried.unionAll(tried.select("b", "a"))
    later = scratch.stored(later.distinct().join(done, ["a", "b"], "left_anti"), "candidates")
    links = links.unionAll(_verified(scratch, docs, classes, later, words, percent)) if later.take(1) else links

    final = scratch.stored(_with_roots(classes, scratch.stored(links, "links")), "roots")
    lowest = final.groupBy("root").agg(F.min("rep.doc_id").alias("lowest"))
    named = stored(final.select("node", "root").join(lowest, "root").select("node", "root", "lowest"), "named")
    component_id = F.when(F.col("n") > 0, F.col("lowest")).otherwise(F.col("doc_id"))
    out = rows.join(named, "node", "left").withColumn("component_id", component_id)
    more = ["text_key", F.col("root").alias("component")] if keys else []
    return out.select(_known("doc_id").alias("doc_id"), F.col("n").alias("n_shingles"), _known("component_id").alias("component_id"), *more)


def _known(name: str):
    return F.when(F.col(name) != NO_ID, F.col(name))


def _with_roots(classes: DataFrame, links: DataFrame) -> DataFrame:
    found = components(links)
    return classes.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
