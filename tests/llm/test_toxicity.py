import zlib

from pyspark.sql import functions as F

from trolley.llm import toxicity


def test_noisy_or():
    model = toxicity.Model({f: 4.0 for f in toxicity.word_features("scum")[:1]}, -4.0)
    scorer = model.scorer()
    assert scorer.score(None) == scorer.score("") == scorer.score(" . \n") == 0
    one, two = scorer.score("scum here."), scorer.score("scum here. scum there.")
    assert abs(one - 0.5) < 1e-9 and abs(two - 0.75) < 1e-9
    assert scorer.score("scum scum scum") == scorer.score("scum")


def test_held_out_accuracy_and_sentences(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = toxicity.scored(docs.select("doc_id", "text"), model).withColumn("held", toxicity.held_out()).join(labels, "doc_id")
    found = {(r.toxic, r.predicted): r["count"] for r in rows.where("held").groupBy("toxic", "predicted").count().collect()}
    assert found[1, 1] / (found[1, 1] + found.get((1, 0), 0)) > 0.8
    assert found[0, 0] / (found[0, 0] + found.get((0, 1), 0)) > 0.97
    held = rows.where("held").limit(50).collect()
    assert all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in held)
    worst = toxicity.offending(docs.where(F.lower("text").contains("idiot")), model).select("sentence").take(5)
    assert worst


def test_odd_documents(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(0, 1), (1, 0), (5, 1), (5, 0), (None, 1), (6, None)], "doc_id long, toxic int")
    model = toxicity.fit(odd_docs, labels)
    rows = toxicity.scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 and r.hash == "x" for r in rows)
    nobody = toxicity.fit(no_docs, labels.limit(0))
    assert toxicity.scored(no_docs, nobody).count() == 0


def test_scorer_keeps_few_words():
    """Many distinct words: their weights don't pile up in the worker, and the score is the same."""
    text = ". ".join(f"word{i} scum{i}" for i in range(40_000))
    model = toxicity.Model({f: 0.01 for f in toxicity.word_features("word")}, -9.0)
    scorer = model.scorer()
    known = [toxicity.Scorer(model).score(s) for s in text.split(". ")[:50]]
    assert [scorer.score(s) for s in text.split(". ")[:50]] == known
    scorer.score(text)
    assert len(scorer) <= 1 << 15
    assert [scorer.score(s) for s in text.split(". ")[:50]] == known
