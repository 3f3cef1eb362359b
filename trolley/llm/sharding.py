"""Balanced label propagation: linked documents gather in shards of equal size.

Linked documents start in shards at random. In each round a document looks at where its neighbours
are and moves to the shard that has most of them, if that shard has room; a shard that more want than
fit takes the share that fits. At the end the documents without links fill what is left, so that the
shards' counts differ by one at most. All documents with equal texts are neighbours; a round counts
them by group and shard and never lists pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trolley.llm.common import numbered, stored

SHARDS, ROUNDS = 24, 8
#: Rows that one slice of a numbering has, on average.
SLICE_ROWS = 4_096
#: A group that would take more than this part of a shard moves document by document.
LARGE = 0.02


def quotas(rows: int, shards: int) -> list[int]:
    """Documents of each shard: counts at most one apart."""
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def _lookup(values: list, key: Column) -> Column:
    return F.get(F.array(*map(F.lit, values)), key)


def _chance(turn: int, *columns: str) -> Column:
    """A number from 0 to 1 for each value, another in each round."""
    return F.pmod(F.xxhash64(F.lit(turn), *columns), F.lit(1 << 20)) / (1 << 20)


def _moved(linked: DataFrame, quota: list[int], turn: int) -> DataFrame | None:
    """One round; None if nobody wants to move. Per shard, its load and how many want to come reach the driver: as many rows as
    there are shards."""
    loads = dict(linked.groupBy("shard").count().collect())
    room = [q - loads.get(s, 0) for s, q in enumerate(quota)]
    votes = linked.groupBy("group", "shard").agg(F.count(F.lit(1)).alias("votes"))
    open_ = votes.where(_lookup(room, F.col("shard")) > 0)
    best = open_.groupBy("group").agg(F.max(F.struct("votes", (-F.col("shard")).alias("minus"))).alias("best"))
    best = best.select("group", F.col("best.votes").alias("there"), (-F.col("best.minus")).alias("to"))
    more = (F.col("there") > F.col("votes")) | ((F.col("there") == F.col("votes")) & (F.col("to") < F.col("shard")))
    wishes = stored(votes.join(best, "group").where(more).select("group", "shard", "votes", "to"), "wishes")
    wanted = dict(wishes.groupBy("to").agg(F.sum("votes")).collect())
    if not wanted:
        return None
    share = [min(1.0, room[s] / wanted[s]) if wanted.get(s) else 0.0 for s in range(len(quota))]
    total = Window.partitionBy("group")
    large = F.sum("votes").over(total) > LARGE * quota[-1]
    wishes = wishes.select("group", "shard", "to", large.alias("large"))
    chance = F.when(F.col("large"), _chance(turn, "key", "size")).otherwise(_chance(turn, "group"))
    goes = F.col("to").isNotNull() & (chance < _lookup(share, F.col("to")))
    return linked.join(wishes, ["group", "shard"], "left").withColumn("shard", F.when(goes, F.col("to")).otherwise(F.col("shard"))).drop("to", "large")


def _slice(slices: int) -> Column:
    """Keeps a group's documents together, but for a large group, which takes several slices."""
    parts = F.greatest(F.lit(1), F.ceil(F.col("members") / SLICE_ROWS)).cast("long")
    return F.pmod(F.xxhash64("group"), F.lit(slices)) * (1 << 32) + F.pmod(F.xxhash64("row"), parts)


def balanced_shards(docs: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every row.

    Law ``rows``: the shards' counts differ by one at most. ``size`` is the UTF-8 length of the text
    plus 8; NULL text counts as empty and is equal to an empty one. Rows of equal doc_id are rows of
    their own, numbered once, so that any number of equal rows spreads over slices and shards; a NULL
    doc_id is a value like any other. ``slot`` counts from 0 without gaps in each
    shard; ``grown_shard`` is NULL under this law. An empty table gives no rows.
    """
    text = F.coalesce("text", F.lit(""))
    rows = stored(
        docs.select("doc_id", (F.octet_length(text).cast("long") + 8).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.md5(text.cast("binary")).alias("group"), F.monotonically_increasing_id().alias("row")),
        "documents",
    )
    n = rows.count()
    quota, slices = quotas(n, shards), n // SLICE_ROWS + 1
    groups = stored(rows.groupBy("group").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), "groups")
    linked = rows.join(groups, "group").withColumn("key", F.coalesce(F.col("doc_id").cast("long"), "row")).withColumn("shard", F.pmod(F.xxhash64("key", "size"), F.lit(shards)).cast("int"))
    linked = stored(linked, "linked")
    for turn in range(rounds):
        moved = _moved(linked, quota, turn)
        if moved is None:
            break
        linked = stored(moved, "linked")

    ranked = stored(numbered(linked, ["shard"], _slice(slices), [F.col("group"), F.col("doc_id")], "rank"), "ranked")
    stay = F.col("rank") < _lookup(quota, F.col("shard"))
    held = dict(ranked.where(stay).groupBy("shard").count().collect())
    upto = [0]
    for s, q in enumerate(quota):
        upto.append(upto[-1] + q - held.get(s, 0))
    alone = rows.join(groups, "group", "left_anti").withColumn("members", F.lit(1).cast("long"))
    columns = ["doc_id", "size", "text_crc32", "group", "row", "members"]
    pool = stored(ranked.where(~stay).select(columns).unionByName(alone.select(columns)), "pool")
    dealt = numbered(pool, [], _slice(slices), [F.col("group"), F.col("doc_id")], "rank")
    place = F.size(F.filter(F.array(*map(F.lit, upto[1:])), lambda top: top <= F.col("rank")))
    final = ranked.where(stay).select(*columns, "shard").unionByName(dealt.select(*columns, place.cast("int").alias("shard")))
    final = stored(final, "placed")
    slotted = numbered(final, ["shard"], F.pmod(F.xxhash64("row"), F.lit(slices)), [F.col("doc_id"), F.col("text_crc32")], "slot")
    return slotted.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def cut_links(placed: DataFrame) -> DataFrame:
    """(kept, links): how many documents lie where most of their group lies, of those in groups."""
    votes = placed.groupBy("size", "text_crc32", "shard").agg(F.count(F.lit(1)).alias("votes"))
    groups = votes.groupBy("size", "text_crc32").agg(F.sum("votes").alias("members"), F.max("votes").alias("most")).where("members > 1")
    return groups.agg(F.sum("most").alias("kept"), F.sum("members").alias("links"))
