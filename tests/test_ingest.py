"""CSV reading, cleaning, JSON lines and the replay clock."""

import json

import pytest
from helpers import tuples
from pyspark.sql import functions as F

from trolley.operators import cleaning
from trolley.sources import raw_csv, topic

HEADER = "event_time,event_type,product_id,category_id,price,user_id,user_session,brand"
GOOD = "2020-01-01 00:00:00 UTC,view,p1,1,2.5,7,s1,acme"


def csv(spark, tmp_path, *lines, name="in.csv"):
    (tmp_path / name).write_text("\n".join([HEADER, *lines]) + "\n", encoding="utf-8")
    return raw_csv.read_raw_csv(spark, str(tmp_path))


def test_clean_row_converts_and_passes_the_rest(spark, tmp_path):
    row = cleaning.payload(cleaning.clean(csv(spark, tmp_path, GOOD.replace(",7,", ", 5.9 ,")))).first()
    assert row.asDict() == {
        "event_time": "2020-01-01 00:00:00 UTC",
        "event_type": "view",
        "product_id": "p1",
        "category_id": 1,
        "price": 2.5,
        "user_id": 5,
        "user_session": "s1",
        "brand": "acme",
    }


def test_rejects_carry_a_reason(spark, tmp_path):
    raw = csv(
        spark,
        tmp_path,
        GOOD,
        GOOD.replace(",7,", ",abc,"),
        GOOD.replace(",7,", ",,"),
        GOOD.replace(",1,2.5", ",0x10,2.5"),
        GOOD.replace("2.5", "1.0d"),
        GOOD.replace(",7,", ",1e300,"),
        "2020-01-01 00:00:00 UTC,view,p1",
    )
    assert cleaning.clean(raw).count() == 1
    reasons = sorted(r["reason"] for r in cleaning.rejected(raw).collect())
    assert reasons == [
        "bad_category_id",
        "bad_price",
        "bad_user_id",
        "bad_user_id",
        "bad_user_id",
        "out_of_range",
    ]


def test_odd_values_that_are_kept(spark, tmp_path):
    raw = csv(
        spark,
        tmp_path,
        " x ,view,,1487580005268456287,nan,7,s1,",
        ',view,"a ""b"", c",1,inf,7,s1,x',
    )
    rows = cleaning.clean(raw).orderBy("category_id").collect()
    assert rows[1]["event_time"] == "x" and rows[1]["category_id"] == 1487580005268456192
    assert rows[1]["price"] != rows[1]["price"] and rows[1]["product_id"] == ""
    assert rows[0]["event_time"] == "" and rows[0]["product_id"] == 'a "b", c'
    assert rows[0]["price"] == float("inf")


def test_rows_longer_than_the_header_and_line_breaks(spark, tmp_path):
    raw = csv(spark, tmp_path, GOOD + ",extra", GOOD.replace("p1", '"p\n2"'))
    assert [r.product_id for r in cleaning.clean(raw).collect()] == ["p1"]
    whole = raw_csv.read_raw_csv(spark, str(tmp_path), multi_line=True)
    assert sorted(r.product_id for r in cleaning.clean(whole).collect()) == ["p\n2", "p1"]


def test_a_file_with_other_columns_is_an_error(spark, tmp_path):
    csv(spark, tmp_path, GOOD)
    (tmp_path / "other.csv").write_text("event_type,event_time\nview,2020-01-01 00:00:00\n")
    with pytest.raises(Exception, match="header"):
        raw_csv.read_raw_csv(spark, str(tmp_path), HEADER.split(",")).collect()


def test_a_missing_column_rejects_every_row(spark):
    raw = spark.createDataFrame([("1", "2", "3")], "user_id string, category_id string, price string")
    assert [r["reason"] for r in cleaning.rejected(raw).collect()] == ["missing_event_time"]


def test_replay_clock_counts_accepted_rows_only(spark, tmp_path):
    """Several files cut into many small splits still number like one pass in file order."""
    expected, good = [], 0
    for f in range(3):
        lines = []
        for i in range(200):
            bad = (i + f) % 7 == 0
            lines.append(GOOD.replace(",p1,", f",f{f}r{i},").replace(",7,", ",x," if bad else ",7,"))
            if not bad:
                expected.append((f"f{f}r{i}", good, good * 200))
                good += 1
        csv(spark, tmp_path, *lines, name=f"part-{f}.csv")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = raw_csv.read_raw_csv(spark, str(tmp_path))
        assert raw.rdd.getNumPartitions() > 10
        rows = cleaning.number_rows(cleaning.clean(raw))
        assert tuples(rows, "ordinal", "product_id", "arrival_ms") == [(o, p, a) for p, o, a in expected]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_replay_clock_without_broadcast(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(cleaning, "MAX_BROADCAST_BYTES", 0)
    rows = cleaning.number_rows(cleaning.clean(csv(spark, tmp_path, GOOD, GOOD, GOOD)))
    assert tuples(rows, "ordinal") == [(0,), (1,), (2,)]


def lines(spark, *values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def event(**change):
    base = {
        "event_time": "2020-01-01 00:00:00 UTC",
        "event_type": "cart",
        "product_id": "p1",
        "category_id": 1,
        "price": 2.5,
        "user_id": 7,
        "user_session": "s1",
    }
    return json.dumps({k: v for k, v in (base | change).items() if v != "-"})


def test_decode(spark):
    row = topic.accepted(topic.parse(lines(spark, event(extra=[1, {"a": 2}])))).first()
    assert (row.event_type, row.product_id, row.category_id, row.price) == ("cart", "p1", 1, 2.5)
    assert (row.user_id, row.user_session, row.time_ok) == (7, "s1", True)
    assert row.event_ms == 1577836800000


def test_decode_spellings(spark):
    parsed = topic.accepted(
        topic.parse(
            lines(spark, event(user_id="5"), event(user_id=5.0), event(price=float("nan")), event(price="x"))
        )
    )
    assert sorted(r.user_id for r in parsed.collect()) == [5, 5, 7, 7]
    assert sum(1 for r in parsed.collect() if r.price is None) == 1


def test_last_duplicate_key_wins(spark):
    row = topic.accepted(topic.parse(lines(spark, '{"user_id": 1, "user_id": 2}'))).first()
    assert row.user_id == 2


def test_bad_lines_are_set_aside(spark):
    good = event()
    bad = {
        event()[:-5]: "malformed_json",
        f"[{event()}]": "not_an_object",
        "": "not_an_object",
        "null": "not_an_object",
        "x": "not_an_object",
        event(user_id=None): "missing_user_id",
        event(user_id="abc"): "missing_user_id",
        event(product_id="-"): "missing_product_id",
    }
    parsed = topic.parse(lines(spark, good, *bad))
    needs = ("user_id", "product_id")
    assert topic.accepted(parsed, needs).count() == 1
    assert {r.value: r.reason for r in topic.rejects(parsed, needs).collect()} == bad


def test_encode_keeps_nulls_and_round_trips(spark):
    row = spark.createDataFrame([("view", None, 2.5)], "event_type string, product_id string, price double")
    text = topic.encode(row).first().value
    assert json.loads(text) == {"event_type": "view", "product_id": None, "price": 2.5}
    odd = row.withColumn("price", F.lit(float("nan")))
    back = topic.accepted(topic.parse(topic.encode(odd))).first()
    assert back.price != back.price


def test_lines_as_files(spark, tmp_path):
    folder = str(tmp_path / "topic")
    topic.write_lines(lines(spark, event(), event(user_id=8)), folder)
    assert topic.accepted(topic.parse(topic.read_lines(spark, folder))).count() == 2


def test_topic_record_columns_give_the_arrival(spark):
    record = lines(spark, event()).select(
        "value",
        F.timestamp_millis(F.lit(1234)).alias("timestamp"),
        F.lit(5).cast("bigint").alias("offset"),
    )
    row = topic.accepted(topic.parse(record)).first()
    assert (row.arrival_ms, row.ordinal) == (1234, 5)


def test_topic_options():
    assert topic.topic_options("broker:9092", group="g") == {
        "kafka.bootstrap.servers": "broker:9092",
        "subscribe": "shopping-events",
        "startingOffsets": "earliest",
        "kafka.group.id": "g",
    }
