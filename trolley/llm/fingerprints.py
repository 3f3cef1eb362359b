"""Document fingerprints from closed syncmers.

Words are hashed; a run of ``K`` words is an anchor when the least hash among its inner runs of two
words lies at its first or last inner run. Whether a run is an anchor depends on its own words alone,
so an edit elsewhere in the text leaves it, and its place relative to its neighbours, as it was.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import BLANKS, stored

#: Words of an anchor. Of its K - 1 pairs of words, the least must be the first or the last.
K = 5
#: Documents of one range of ids, on average, and ranges at most.
RANGE_ROWS, RANGES = 2_048, 1 << 16
#: Bands that the rows of one key are split into are fewer than this.
BANDS = 1 << 20
_BLANK = r"[ \t-\r]+"


def with_anchors(rows: DataFrame, text: str, name: str) -> DataFrame:
    """``rows`` with the anchors of a text: 32-bit hashes, in order of place.

    A text of fewer than ``K`` words, or of which no run is an anchor (only with five or six words), has
    one anchor, made of them all; one without words, or NULL, and no other, has none. Each step is a column of its own, so that none is worked out once per element.
    """
    w, h, p, at = (f"_{name}_{c}" for c in "whpi")
    plain = F.btrim(F.coalesce(F.col(text), F.lit("")), F.lit(BLANKS))
    words = F.split(plain, _BLANK)
    rows = rows.withColumn(w, words).withColumn(h, F.transform(w, lambda x: F.xxhash64(x)))
    pairs = F.zip_with(F.slice(h, 1, F.size(h) - 1), F.slice(h, 2, F.size(h)), lambda a, b: F.xxhash64(a, b))
    rows = rows.withColumn(p, F.when(F.size(h) >= K, pairs))
    pair = lambda i, j: F.get(p, i + j)
    edge = lambda i: F.least(pair(i, 0), pair(i, K - 2))
    inner = lambda i: F.least(*(pair(i, j) for j in range(1, K - 2)))
    rows = rows.withColumn(at, F.filter(F.sequence(F.lit(0), F.size(p) - K + 1), lambda i: edge(i) <= inner(i)))
    kmer = lambda i: F.shiftright(F.xxhash64(*(pair(i, j) for j in range(0, K - 1, 2)), F.get(h, i + K - 1)), 32).cast("int")
    short = F.when(plain == "", F.array().cast("array<int>")).otherwise(F.array(F.shiftright(F.xxhash64(F.concat_ws(" ", w)), 32).cast("int")))
    return rows.withColumn(name, F.when(F.size(at) > 0, F.transform(at, kmer)).otherwise(short)).drop(w, h, p, at)


def as_string(anchors: str) -> Column:
    return F.concat_ws(" ", F.transform(anchors, lambda a: F.hex(a.cast("long").bitwiseAND(0xFFFFFFFF))))


def likeness(a: str, b: str) -> Column:
    """Shared distinct anchors against all of both (Dice); two texts without anchors, and so
    without words, are alike."""
    both = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(both == 0, 1.0).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def fingerprints(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row, with ``fingerprint``. Equal texts have equal ones."""
    rows = with_anchors(docs.select(*keep, F.col(text).alias("_text")), "_text", "_anchors")
    return rows.select(*keep, as_string("_anchors").alias("fingerprint"))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """Number of the range of a key: how many bounds lie below it, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, math.isqrt(len(bounds)))
    parts = [bounds[i : i + step] for i in range(0, len(bounds), step)]
    below = lambda values: F.size(F.filter(values, lambda b: b < key))
    tops = F.array(*(F.lit(p[-1]).cast("long") for p in parts))
    part = F.get(F.array(*(F.array(*(F.lit(b).cast("long") for b in p)) for p in [*parts, parts[-1]])), below(tops))
    return F.least(below(tops) * step + below(part), F.lit(len(bounds)))


def _place(key: str, text_hash: str, cuts: list[int]) -> Column:
    """Number of the part a row lies in; the higher, the earlier in descending order of keys.

    ``cuts`` are keys at equal steps of rank. A key that is cut at several times has that many rows: it is
    split further, into bands of the text's hash, which go by ascending hash before the rest of its range.
    """
    bounds = sorted(set(cuts))
    often = {k: n for k in bounds if (n := cuts.count(k)) > 1}
    whole = _range_of(F.col(key), bounds).cast("long") * BANDS
    if not often:
        return whole
    bands = F.try_element_at(F.create_map(*(F.lit(x).cast("long") for pair in often.items() for x in pair)), F.col(key))
    # The upper half of the hash, from 0, scaled to the number of bands.
    band = F.shiftright((F.shiftright(text_hash, 32) + (1 << 31)) * bands, 32)
    return whole + F.when(bands.isNotNull(), BANDS - 1 - band).otherwise(F.lit(0))


def _measured(rows: DataFrame, following: str, following_anchors: str) -> DataFrame:
    """The result of rows with a text, its anchors ``_own``, and the next text and its anchors."""
    chars = F.char_length("text")
    half = F.floor(chars / 2).cast("int")
    edited = F.concat(F.left(F.col("text"), chars - half), F.left(F.col(following), half))
    made = with_anchors(rows.withColumn("_edited", edited), "_edited", "_new")
    return made.select(
        "doc_id",
        chars.cast("long").alias("n_chars"),
        F.sha2(F.col("_edited").cast("binary"), 256).alias("edited_sha256"),
        as_string("_own").alias("fingerprint"),
        as_string("_new").alias("edited_fingerprint"),
        likeness("_own", "_new").alias("near_edited"),
        likeness("_own", following_anchors).alias("near_next"),
        "_copies",
    )


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of an edited one, and their likeness.

    The edited text has its last half (rounded down, in code points) replaced by as much of the
    beginning of the next document's text, or all of it; documents go by descending doc_id, and the
    first follows the last. NULL text is empty; NULL doc_ids come last; rows of equal doc_id go by a
    hash of their text. Extra columns are ignored. An empty table gives no rows.

    Documents are dealt by ranges of doc_id, those of a frequent doc_id (or without one) by ranges of
    their hash; the first of the following part is a guest at the end of each. Rows equal in doc_id and
    text that are more than a range has rows go through as one, since all but the last are followed by
    the same text. Texts are shuffled once.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("_key")).withColumn("_hash", F.xxhash64("text"))
    keys = stored(rows.select("_key", "_hash"), "keys")
    n = keys.count()
    ranges = min(RANGES, n // RANGE_ROWS + 1)
    cuts = keys.select(F.percentile_approx("_key", [i / ranges for i in range(1, ranges)], 100 * ranges)).first()[0] if ranges > 1 else []
    place = _place("_key", "_hash", cuts or []).alias("_range")

    # At most a row per RANGE_ROWS documents.
    crowds = stored(keys.groupBy("_key", "_hash").count().where(F.col("count") > RANGE_ROWS).select("_key", "_hash"), "crowds")
    crowded = bool(crowds.take(1))
    rows = rows.withColumn("_copies", F.lit(1).cast("long"))
    if crowded:
        same = rows.join(F.broadcast(crowds), ["_key", "_hash"], "left_semi")
        same = same.groupBy("doc_id", "text", "_key", "_hash").agg(F.count(F.lit(1)).alias("_copies"))
        rows = rows.join(F.broadcast(crowds), ["_key", "_hash"], "left_anti").unionByName(same)
    rows = rows.select("*", place)

    # One row per part: its first document, and the part above, whose last document that follows.
    first = F.min(F.struct(F.bitwise_not("_key").alias("down"), "_hash")).alias("first")
    heads = keys.select("*", place).groupBy("_range").agg(first)
    above = Window.orderBy("_range")
    heads = heads.withColumn("_to", F.coalesce(F.lead("_range").over(above), F.min("_range").over(Window.partitionBy())))
    heads = heads.select("_range", F.bitwise_not("first.down").alias("_key"), F.col("first._hash").alias("_hash"), "_to")
    guests = rows.join(F.broadcast(heads), ["_range", "_key", "_hash"]).groupBy("_to").agg(F.min("text").alias("text"))
    guests = guests.select(F.col("_to").alias("_range"), "text", F.lit(True).alias("_guest"))

    dealt = rows.withColumn("_guest", F.lit(False)).unionByName(guests, allowMissingColumns=True).repartition("_range")
    dealt = with_anchors(dealt, "text", "_own")
    after = Window.partitionBy("_range").orderBy("_guest", F.desc("_key"), "_hash", "text")
    paired = dealt.withColumn("_next", F.lead("text").over(after)).withColumn("_next_own", F.lead("_own").over(after)).where("not _guest")
    out = _measured(paired, "_next", "_next_own").drop("_copies")
    if not crowded:
        return out
    among = stored(_measured(with_anchors(same.where("_copies > 1"), "text", "_own"), "text", "_own"), "copies")
    # All but the last of a crowd, counted out in two steps of bounded length each.
    parts = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 2) / RANGE_ROWS))).alias("_part")
    left = F.least(F.lit(RANGE_ROWS).cast("long"), F.col("_copies") - 1 - F.col("_part") * RANGE_ROWS)
    dealt = among.select("*", parts).repartition("doc_id", "edited_sha256", "_part")
    return out.unionByName(dealt.withColumn("_one", F.explode(F.array_repeat(F.lit(1), left.cast("int")))).select(out.columns))
