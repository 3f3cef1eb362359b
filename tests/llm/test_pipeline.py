"""The pipeline against a plain version of its stages."""

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from llm.test_jaccard import plain_components, plain_sets
from llm.test_line_dedup import plain
from trolley.llm import toxicity


def test_run_against_plain_stages(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    scorer = toxicity.fit(docs, labels).scorer()
    kept = [(r.doc_id, r.text) for r in docs.collect() if scorer.score(r.text) < toxicity.THRESHOLD]
    assert 0 < len(kept) < docs.count()
    kept = sorted(plain(kept).items())
    sets = plain_sets([t for _, t in kept], 5)
    component = plain_components([i for i, _ in kept], sets, 80)
    kept = {i: t for i, t in kept if component[i] == i}
    own = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(own.encode(t, add_special_tokens=False).ids) + 1 for i, t in kept.items()}
    out = corpus_pipeline.run(spark, small)
    got = {r.doc_id: (r["sum(length)"], r.n) for r in out.groupBy("doc_id").agg(F.sum("length"), F.max("doc_tokens").alias("n")).collect()}
    assert got == {i: (n, n) for i, n in want.items()}


def test_stages_return_documents(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, small).columns == docs.columns


def test_one_row_of_each_group_stays(spark):
    """Repeated, missing and clashing doc_ids: rows are told apart by their text."""
    words = [f"w{i}" for i in range(60)]
    base, near, other = " ".join(words), " ".join([*words[:-1], "x"]), " ".join(f"o{i}" for i in range(30))
    rows = [(1, base), (1, base), (2, other), (2, base), (None, near), (None, near), (None, base), (3, None), (3, ""), (None, ""), (None, "")]
    lone = " ".join(f"q{i}" for i in range(40))
    rows += [(None, lone), (None, lone), (None, lone + " end"), (4, near)]
    docs = spark.createDataFrame([(i, t, "en", "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr)
    lones = [t for _, t in got if t and t.startswith("q0")]
    assert len(lones) == 1
    assert [x for x in got if x[1] not in lones] == sorted([(1, base), (2, other), (3, None), (3, ""), (None, ""), (None, "")], key=repr)


def test_odd_documents(spark, small, odd_docs, no_docs):
    """Every stage on odd rows, each on what the one before left; and on none."""
    names = list(corpus_pipeline.DOCUMENTS)
    for docs in (odd_docs, no_docs):
        n = docs.count()
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, small)
            assert docs.columns == names and docs.count() <= n
        packed = corpus_pipeline.pack(spark, docs, small)
        assert packed.where("start = 0").count() == docs.count()


def test_texts_go_to_python_in_batches_of_bounded_bytes(spark, monkeypatch):
    """24 MB of texts in one partition: well under the rows of a batch."""

    def sizes(batches):
        for batch in batches:
            made = [pa.array([str(batch.nbytes)] * len(batch)) if n == "text" else c for n, c in zip(batch.schema.names, batch.columns, strict=True)]
            yield pa.RecordBatch.from_arrays(made, batch.schema.names)

    kind = "doc_id long, text string, lang string, source string, n_chars long"
    docs = spark.range(0, 240, 1, 1).selectExpr("id doc_id", "repeat('abcdefghi ', 10000) text", "'en' lang", "'s' source", "100000L n_chars")
    monkeypatch.setattr(corpus_pipeline.line_dedup, "dedup_lines", lambda rows: rows.mapInArrow(sizes, kind))
    try:
        rows = dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, "").collect()
        assert len(rows) == 240 and max(int(r.text) for r in rows) <= 2 * corpus_pipeline.BATCH_BYTES
        spark.conf.set(corpus_pipeline.BATCH_SETTING, "12345678")
        dict(corpus_pipeline.STAGES)["line dedup"](spark, docs, "")
        assert spark.conf.get(corpus_pipeline.BATCH_SETTING) == "12345678"
    finally:
        spark.conf.unset(corpus_pipeline.BATCH_SETTING)
