from trolley.llm import line_dedup


def plain(rows):
    key = lambda s: s.strip(" \t\n\x0b\x0c\r").translate({i: i + 32 for i in range(65, 91)})
    owner, holders = {}, {}
    for i, t in rows:
        for s in (t or "").split("\n"):
            owner[key(s)] = min(owner.get(key(s), i), i)
            holders.setdefault(key(s), set()).add(i)
    gone = lambda i, s: len(key(s)) >= 10 and len(holders[key(s)]) > 1 and owner[key(s)] != i
    return {i: "\n".join(s for s in (t or "").split("\n") if not gone(i, s)) for i, t in rows}


def test_batches_and_levels_change_nothing(spark):
    lines = [f"line number {i} of them" for i in range(30)] + ["short", "", "  Line Number 3 OF them\t", "é" * 9, "É" * 10]
    rows = [(i * 3 % 101, "\n".join(lines[(i * k) % len(lines)] for k in range(1, 9))) for i in range(101)] + [(200, None), (201, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' AS hash", "1 AS n_lines")
    for batches, fanout in ((1, 3), (4, 2), (9, 2)):
        out = line_dedup.dedup_lines(docs, batches, fanout).collect()
        assert {r.doc_id: r.text for r in out} == plain(rows)
        assert all(r.hash == "x" and r.n_lines - r.n_dropped == len(r.text.split("\n")) or not r.text for r in out)


def test_runs_are_merged(spark):
    runs = line_dedup.LineRuns(spark, fanout=2)
    for i in range(5):
        batch = spark.createDataFrame([(f"a common line\nline {j} of batch {i}", 10 * i + j) for j in range(3)], "text string, doc_id long")
        owners = runs.add(line_dedup.line_hashes(batch))
        assert owners.count() == (4 if i == 0 else 3)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert sum(r.count() for r in runs.runs()) == 16
    plan = line_dedup.line_hashes(batch).join(runs.runs()[-1].hint("merge"), "hash", "left_anti")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    runs.close()


def test_odd_documents(spark, odd_docs, no_docs):
    out = line_dedup.dedup_lines(odd_docs)
    assert out.count() == odd_docs.count() and out.where("hash = 'x'").count() == out.count()
    assert line_dedup.dedup_lines(no_docs).count() == 0
