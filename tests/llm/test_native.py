"""Sharding, fingerprints, license scans and neighbours."""

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from trolley.llm import fingerprints, licenses, neighbours, sharding


def python_free(df):
    plan = df._jdf.queryExecution().toString()
    return not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_counts_one_apart_and_groups_together(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    copies = spark.range(40).selectExpr("id + 100000 AS doc_id", "'the same text' AS text")
    placed = sharding.balanced_shards(docs.unionByName(copies), shards=7)
    assert python_free(placed)
    rows = placed.collect()
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    assert {*slots} == {*range(7)} and all(sorted(s) == [*range(len(s))] for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    assert len({r.shard for r in rows if r.doc_id >= 100000}) == 2
    (kept, links) = sharding.cut_links(placed.where("doc_id < 100000")).first()
    assert kept == links


def test_fewer_cut_links_than_by_chance(spark):
    """Groups of many sizes among documents without links: where most of a group lies, against a placement
    that ignores groups."""
    groups = spark.range(400).selectExpr("id AS g", "explode(sequence(1, 2 + id % 9)) AS n")
    docs = groups.selectExpr("g * 100 + n AS doc_id", "concat('text ', g) AS text")
    alone = spark.range(12_000).selectExpr("id + 100000 AS doc_id", "concat('alone ', id) AS text")
    placed = sharding.stored(sharding.balanced_shards(docs.unionByName(alone)), "placed").where("doc_id < 100000")
    kept, links = sharding.cut_links(placed).first()
    chance = placed.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(sharding.SHARDS)).cast("int"))
    by_chance = sharding.cut_links(chance).first().kept
    assert links == docs.count()
    # A member of each group is where it is by definition; count the others.
    assert (kept - 400) / (links - 400) > 0.95 > 0.35 > (by_chance - 400) / (links - 400)


def test_equal_rows_without_doc_id_spread(spark):
    """Many equal rows: over all shards, and over slices of a bounded size."""
    docs = spark.range(30_000).selectExpr("CAST(NULL AS long) AS doc_id", "'same' AS text")
    seen = []
    real = sharding.numbered

    def watched(df, within, spread, order, name):
        seen.append(df.groupBy(*within, spread.alias("s")).count().agg(F.max("count")).first()[0])
        return real(df, within, spread, order, name)

    sharding.numbered = watched
    try:
        rows = sharding.balanced_shards(docs).collect()
    finally:
        sharding.numbered = real
    counts = [sum(r.shard == s for r in rows) for s in range(24)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == 30_000
    assert max(seen) < 2 * sharding.SLICE_ROWS


def test_sharding_odd_documents(odd_docs, no_docs):
    rows = sharding.balanced_shards(odd_docs, shards=4).collect()
    assert len(rows) == odd_docs.count() and {r.shard for r in rows} == {0, 1, 2, 3}
    assert min(r.size for r in rows) == 8
    assert sharding.balanced_shards(no_docs).count() == 0


def plain_anchors(text, spark):
    words = (text or "").strip(fingerprints.BLANKS)
    out = spark.range(1).select(F.lit(words).alias("t"))
    rows = fingerprints.with_anchors(out, "t", "a").first()
    return rows.a


def test_syncmers_against_brute_force(spark, small):
    """Anchors, worked out again from hashes that Spark returns for each run of words."""
    docs = spark.read.parquet(f"{small}/documents.parquet").where("n_chars < 3000").limit(20)
    made = fingerprints.with_anchors(docs, "text", "anchors").select("doc_id", "text", "anchors").collect()
    for row in made:
        words = row.text.split()
        h = [r[0] for r in spark.createDataFrame([(i, w) for i, w in enumerate(words)], "i int, w string").orderBy("i").select(F.xxhash64("w")).collect()] if words else []
        if len(words) < fingerprints.K:
            assert len(row.anchors) == (1 if words else 0)
            continue
        pairs = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(zip(h, h[1:], strict=False))], "i int, a long, b long")
        p = [r[0] for r in pairs.orderBy("i").select(F.xxhash64("a", "b")).collect()]
        places = [i for i in range(len(words) - 4) if min(p[i], p[i + 3]) <= min(p[i + 1 : i + 3])]
        runs = spark.createDataFrame([(n, p[i], p[i + 2], h[i + 4]) for n, i in enumerate(places)], "n int, a long, b long, c long")
        assert row.anchors == [r[0] for r in runs.orderBy("n").select(F.shiftright(F.xxhash64("a", "b", "c"), 32).cast("int")).collect()]


def test_texts_of_five_and_six_words_have_anchors(spark):
    texts = [" ".join(f"{c}{n}of{size}" for c in "abcdef"[:size]) for n in range(60) for size in (5, 6)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")
    made = fingerprints.with_anchors(rows, "text", "a")
    assert all(r.a for r in made.collect())
    pairs = made.crossJoin(made.selectExpr("i AS j", "a AS b")).where("i <> j")
    assert pairs.select(F.max(fingerprints.likeness("a", "b"))).first()[0] == 0
    blank = fingerprints.with_anchors(spark.createDataFrame([(" ",), (None,)], "text string"), "text", "b")
    assert made.crossJoin(blank.select("b")).select(F.max(fingerprints.likeness("a", "b"))).first()[0] == 0
    assert blank.select(F.min(fingerprints.likeness("b", "b"))).first()[0] == 1


def test_edited_texts(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text")
    rows = docs.orderBy(F.desc("doc_id")).collect()
    after = [r.text for r in rows[1:] + rows[:1]]
    for size in (2_048, 16):
        monkeypatch.setattr(fingerprints, "RANGE_ROWS", size)
        out = fingerprints.edited_fingerprints(docs.selectExpr("*", "1 AS _range"))
        assert python_free(out)
        got = {r.doc_id: r for r in out.collect()}
        for r, other in zip(rows, after, strict=True):
            half = len(r.text) // 2
            edited = r.text[: len(r.text) - half] + other[:half]
            assert got[r.doc_id].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
            assert 0 <= got[r.doc_id].near_edited <= 1
        long = [r for r in got.values() if r.n_chars > 500]
        assert all(r.near_edited > r.near_next for r in long)


def test_frequent_ids_and_crowds_of_equal_rows(spark, monkeypatch):
    """A third of all rows without doc_id, many of one doc_id, and crowds of equal rows, in small parts."""
    monkeypatch.setattr(fingerprints, "RANGE_ROWS", 20)
    text = lambda i: " ".join(f"w{(i * j) % 97}" for j in range(3, 25))
    rows = [(i, text(i)) for i in range(200)] + [(None, text(i)) for i in range(300, 420)] + [(50, text(i)) for i in range(500, 580)]
    rows += [(None, text(1))] * 90 + [(120, text(2))] * 33 + [(None, None)] * 25 + [(7, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _range", "2 AS _copies", "3 AS _hash")
    docs = docs.repartition(4)
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).distinct().collect()}
    order = sorted(((-(1 << 63) if i is None else i), t) for i, t in ((i, t or "") for i, t in rows))
    order.sort(key=lambda r: (-r[0], hashes[r[1] or None], r[1]))
    wanted = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        half = len(t) // 2
        wanted.append((None if i == -(1 << 63) else i, len(t), hashlib.sha256((t[: len(t) - half] + after[:half]).encode()).hexdigest()))
    out = fingerprints.edited_fingerprints(docs)
    assert python_free(out)
    got = out.collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=repr) == sorted(wanted, key=repr)
    crowd = [r for r in got if r.doc_id is None and r.n_chars == len(text(1))]
    assert len(crowd) >= 90 and sum(r.near_next == 1 for r in crowd) >= 89
    parts = []
    real = fingerprints._place
    monkeypatch.setattr(fingerprints, "_place", lambda *a: parts.append(real(*a)) or parts[-1])
    fingerprints.edited_fingerprints(docs)
    rows = docs.select(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("_key"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("_hash")).distinct()
    assert rows.groupBy(parts[0]).count().agg(F.max("count")).first()[0] < 3 * 20


def test_fingerprints_odd_documents(odd_docs, no_docs):
    rows = fingerprints.edited_fingerprints(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    prints = {r.doc_id: r.fingerprint for r in rows}
    assert prints[6] == prints[8] and prints[0] == prints[1] == prints[2] == ""
    assert fingerprints.edited_fingerprints(no_docs).count() == 0


def test_own_and_inherited_licenses(spark):
    """Licence files speak for their directory and below, other files for themselves."""
    files = [
        ("a/LICENSE", "Released under the MIT License."),
        ("a/b/one.txt", "the text\nlicensed under the apache license, version 2.0"),
        ("a/b/two.txt", "the license of the work"),
        ("a/c/COPYING.md", "some words\nLicensed under CC BY 4.0."),
        ("a/c/d/three.txt", "nothing"),
        ("a/c/d/four.txt", "words\nAll rights reserved."),
        ("a/c/d/five.txt", "All rights reserved.\nReleased under the MIT License."),
        ("e/four.txt", None),
        ("f/LICENSE", "All rights reserved."),
        ("f/six.txt", "nothing"),
        ("licenses.txt", "Licensed under CC BY-SA 4.0."),
        ("five.txt", ""),
        (None, "Licensed under CC BY-NC 4.0."),
    ]
    files = spark.createDataFrame(files, "path string, text string").selectExpr("*", "'x' AS key", "'y' AS dir", "'z' AS _own_key")
    out = licenses.scan(files)
    assert python_free(out)
    got = {r.path: (r.own_licence, r.licence, r.inherited_from) for r in out.collect()}
    assert got == {
        "a/LICENSE": ("MIT", "MIT", None),
        "a/b/one.txt": ("Apache-2.0", "Apache-2.0", None),
        "a/b/two.txt": (None, "MIT", "a"),
        "a/c/COPYING.md": ("CC-BY-4.0", "CC-BY-4.0", None),
        "a/c/d/three.txt": (None, "CC-BY-4.0", "a/c"),
        "a/c/d/four.txt": (licenses.NO_RIGHTS, licenses.NO_RIGHTS, None),
        "a/c/d/five.txt": ("MIT", "MIT", None),
        "e/four.txt": (None, None, None),
        "f/LICENSE": (licenses.NO_RIGHTS, licenses.NO_RIGHTS, None),
        "f/six.txt": (None, None, None),
        "licenses.txt": ("CC-BY-SA-4.0", "CC-BY-SA-4.0", None),
        "five.txt": (None, None, None),
        None: ("CC-BY-NC-4.0", "CC-BY-NC-4.0", None),
    }
    assert licenses.scan(files.limit(0)).count() == 0
    root = files.unionByName(spark.createDataFrame([("UNLICENSE", "Dedicated to the public domain under CC0 1.0 Universal.", "x", "y", "z")], files.schema))
    got = {r.path: (r.licence, r.inherited_from) for r in licenses.scan(root).collect()}
    assert got["five.txt"] == got["e/four.txt"] == got["f/six.txt"] == ("CC0-1.0", "") and got["a/b/two.txt"] == ("MIT", "a")


def test_licenses_of_odd_documents(spark, odd_docs, no_docs):
    """Rows without a key keep their notice, and repeated rows are one file."""
    docs = odd_docs.withColumn("path", F.concat(F.lit("p/"), F.col("doc_id").cast("string")))
    mit = docs.where("doc_id IS NULL").withColumn("text", F.lit("Released under the MIT License."))
    rows = licenses.scan(docs.where("doc_id IS NOT NULL").unionByName(mit), key="doc_id", order="doc_id").collect()
    assert len(rows) == odd_docs.count()
    assert [r.own_licence for r in rows if r.doc_id is None] == ["MIT"]
    assert {r.licence for r in rows if r.doc_id is not None} == {None}
    assert licenses.scan(no_docs, key="doc_id", order="doc_id").count() == 0


GPL_HEADER = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""


def test_headers_tags_and_licence_texts(spark):
    notices = {
        "LICENSE": ("MIT", "MIT License\n\nCopyright (c) 2020 Some One\n\n" + licenses._MIT.replace(", ", ",\n") + "\n\nThe above copyright notice and this permission notice shall be included in\nall copies or substantial portions of the Software.\n\n" + licenses._AS_IS),
        "bsd2/COPYING": ("BSD-2-Clause", "Copyright 2019, Some One\n\n" + licenses._BSD + licenses._BSD_AS_IS),
        "bsd3/LICENSE.txt": ("BSD-3-Clause", "Copyright 2019, Some One\n\n" + licenses._BSD + licenses._BSD_NAMES + licenses._BSD_AS_IS),
        "gpl3/COPYING": ("GPL-3.0", "                    GNU GENERAL PUBLIC LICENSE\n                       Version 3, 29 June 2007\n\n Everyone is permitted to copy"),
        "agpl/COPYING": ("AGPL-3.0", "GNU AFFERO GENERAL PUBLIC LICENSE\nVersion 3, 19 November 2007\n\n Everyone is permitted to copy"),
        "a.py": ("GPL-3.0", "import os\n# a module of mine\n" + GPL_HEADER + "\nprint(1)"),
        "b.py": ("MIT", "# SPDX-License-Identifier: MIT\nprint(1)"),
        "c.py": ("Apache-2.0", "// SPDX-License-Identifier: Apache-2.0"),
        "d.py": ("MIT", "# This file is released under the MIT License. See LICENSE for details."),
        "e.txt": ("MIT", "Some words before it come here. Released under the MIT License. And after it more words follow"),
        "f.txt": ("Apache-2.0", "Copyright 2020 Some One\r\nLicensed under the Apache License,\r\nVersion 2.0\r\nwords"),
        "g.txt": ("Apache-2.0", "one thing ends. Licensed under the\nApache License, Version 2.0. Another thing goes on"),
        "h.txt": (None, "The license of the work, and a permission to copy it, were much talked of.\nGNU GENERAL PUBLIC LICENSE"),
        "i.txt": (None, "SPDX-License-Identifier: Zlib"),
        "j.txt": ("MIT", "MIT License"),
    }
    plain = [(f"p/{i}", "the words of a text and of a work that is to be read in the house") for i in range(200)]
    files = spark.createDataFrame([(p, t) for p, (_, t) in notices.items()] + plain, "path string, text string")
    out = licenses.scan(files)
    assert python_free(out)
    got = {r.path: r.own_licence for r in out.collect()}
    assert {p: got[p] for p in notices} == {p: n for p, (n, _) in notices.items()}
    assert not any(got[p] for p, _ in plain)


def test_notice_cues_lose_nothing():
    weights = {t: 3.0 for t in licenses.NOTICE_VOCABULARY} | {None: 5.0}
    notices = {str(i): text for i, (_, text) in enumerate(licenses.NOTICES)}
    chosen = set(licenses.cues(weights, templates=notices))
    for unit in licenses.template_weights(weights, notices).values():
        assert math.sqrt(sum(w * w for t, w in unit.items() if t not in chosen)) < licenses.THRESHOLD


def test_cues_lose_nothing():
    weights = {t: 3.0 for t in licenses.VOCABULARY} | {None: 5.0}
    units = licenses.template_weights(weights)
    chosen = set(licenses.cues(weights))
    for unit in units.values():
        assert math.sqrt(sum(w * w for t, w in unit.items() if t not in chosen)) < licenses.THRESHOLD


def test_recall_and_scores(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = neighbours.nearest(vectors, vectors.where("vec_id % 100 = 0"), trees=8, leaf_rows=64).collect()
    table = vectors.toPandas()
    ids, matrix = table.vec_id.to_numpy(), np.stack(table.embedding).astype(float)
    hits = 0
    for query in {r.query_id for r in rows}:
        own = sorted((r.rank, r.vec_id, r.score) for r in rows if r.query_id == query)
        d = np.sqrt(((matrix - matrix[ids == query]) ** 2).sum(1))
        assert [r for r, _, _ in own] == [*range(1, 11)] and own == sorted(own, key=lambda r: (r[2], r[1]))
        assert all(abs(s - d[ids == v][0]) < 1e-12 for _, v, s in own)
        d[ids == query] = np.inf
        hits += len({v for _, v, _ in own} & set(ids[np.lexsort((ids, d))[:10]].tolist()))
    assert hits >= 0.9 * len(rows)


def derived_vectors(n):
    """``n`` unit vectors with the mean and covariance of the embeddings."""
    rnd, base = np.random.default_rng(n), np.stack(pq.read_table("/root/testdata/sf0.1/embeddings.parquet").to_pandas().embedding).astype(float)
    spread = np.linalg.cholesky(np.cov(base.T) + 1e-12 * np.eye(base.shape[1]))
    out = np.empty((n, base.shape[1]), np.float32)
    for a in range(0, n, 100_000):
        x = rnd.standard_normal((len(out[a : a + 100_000]), base.shape[1])) @ spread.T + base.mean(0)
        out[a : a + 100_000] = x / np.linalg.norm(x, axis=1, keepdims=True)
    return out


def test_visits_reach_neighbours_at_every_size():
    """With the default parameters, of the 10 nearest by brute force, those that share a visited leaf."""
    for n in (51_282, 262_144, 1_000_000):
        vectors = derived_vectors(n)
        forest = neighbours.fit(vectors[: neighbours.SAMPLE].astype(float), n)
        hits, queries = 0, np.arange(0, n, n // 100)[:100]
        likes = vectors[queries] @ vectors.T
        likes[np.arange(100), queries] = -2
        for i, like in zip(queries, likes, strict=True):
            met = {*forest.visits(vectors[i].astype(float), neighbours.visits_for(forest))}
            best = forest.leaves_of(vectors[np.argpartition(-like, 10)[:10]].astype(float))
            hits += sum(any((t, x) in met for t, x in enumerate(row)) for row in best)
        assert hits >= 0.95 * 1000


def test_recall_of_the_query_with_its_own_parameters(spark, tmp_path):
    """Fifty thousand vectors, so that the trees have many leaves: the whole join against brute force."""
    n = 50_000
    vectors = derived_vectors(n)
    rows = pa.table({"vec_id": pa.array(range(n), pa.int64()), "embedding": pa.array([*vectors], pa.list_(pa.float32()))})
    pq.write_table(rows, tmp_path / "embeddings.parquet")
    table = spark.read.parquet(str(tmp_path / "embeddings.parquet"))
    got = neighbours.nearest(table, table.where("vec_id % 1000 = 0")).collect()
    whole, hits = vectors.astype(float), 0
    for query in range(0, n, 1000):
        d = np.sqrt(((whole - whole[query]) ** 2).sum(1))
        d[query] = np.inf
        own = [r for r in got if r.query_id == query]
        assert [r.rank for r in sorted(own, key=lambda r: (r.score, r.vec_id))] == [*range(1, 11)]
        hits += len({r.vec_id for r in own} & set(np.argsort(d, kind="stable")[:10].tolist()))
    assert neighbours.fit(whole[: neighbours.SAMPLE], n).depth > 4
    assert hits >= 0.95 * len(got) == 0.95 * 500


def test_crowded_leaves_are_sliced(spark, monkeypatch):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asked = vectors.where("vec_id % 100 = 0")
    whole = sorted(map(tuple, neighbours.nearest(vectors, asked).collect()))
    seen, crowded = [], neighbours.crowded
    monkeypatch.setattr(neighbours, "SLICE_ROWS", 300)
    monkeypatch.setattr(neighbours, "crowded", lambda *a: seen.append(crowded(*a)) or seen[0])
    assert sorted(map(tuple, neighbours.nearest(vectors, asked).collect())) == whole
    assert len(seen[0]) == 2 * neighbours.TREES and {*seen[0].values()} <= {3, 4, 5}


def test_queries_of_another_length_and_equal_queries(spark):
    """The table's commonest length holds for both sides; equal queries are searched once."""
    rows = [(i, [float(i % 7), float(i % 5), 1.0]) for i in range(1, 60)]
    rows += [(100, [1.0, 2.0]), (200, [1.0, 2.0]), (300, [2.0, 2.0, 1.0]), (400, [2.0, 2.0, 1.0]), (500, [2.0, 2.0, 1.0])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    asked = vectors.where("vec_id % 100 = 0")
    got = neighbours.nearest(vectors, asked, k=4).collect()
    assert {r.query_id for r in got} == {300, 400, 500}
    whole = [(i, v) for i, v in rows if len(v) == 3]
    for query in (300, 400, 500):
        own = dict(whole)[query]
        best = sorted((math.dist(own, v), i) for i, v in whole if i != query)[:4]
        assert [(r.score, r.vec_id) for r in sorted((r for r in got if r.query_id == query), key=lambda r: r.rank)] == best
    assert neighbours.nearest(vectors, vectors.where("vec_id = 100")).collect() == []


def test_neighbours_odd_vectors(spark):
    same = [(i, [1.0, 2.0]) for i in range(1, 41)]
    bad = [(50, None), (51, [0.0, 0.0]), (52, [1.0, None]), (53, [1.0, float("nan")]), (54, [float("inf"), 1.0]), (55, []), (56, [1.0]), (None, [1.0, 1.0])]
    vectors = spark.createDataFrame([*same, (0, [1.0, 2.5]), (0, [1.0, 2.5]), *bad], "vec_id long, embedding array<float>").selectExpr("*", "1 AS id", "2 AS leaf")
    got = [tuple(r) for r in neighbours.nearest(vectors, vectors.where("vec_id IN (0, 5, 51)")).orderBy("query_id", "rank").collect()]
    assert got[:10] == [(0, i, i, 0.5) for i in range(1, 11)]
    assert got[10:] == [(5, i + 1, v, 0.0) for i, v in enumerate([1, 2, 3, 4, 6, 7, 8, 9, 10, 11])]
    assert neighbours.nearest(vectors.limit(0), vectors).count() == 0
