"""Result tables: versions, compaction beside writers and readers, lookups that open few files."""

import random
import threading
from datetime import datetime, timedelta

import pytest
from helpers import tuples

from trolley.schema import RESULT_KEYS, RESULT_ORDER, RESULT_SCHEMAS, RESULT_SUMS
from trolley.sources import manifest, tables

START = datetime(2020, 1, 1)


def row_of(rng, name, batch):
    """A row of a micro-batch; windows may be older than those of earlier ones."""
    values = {
        "product_id": f"p{rng.randrange(6)}",
        "user_id": rng.randrange(8),
        "user_session": f"s{rng.randrange(8)}",
        "pane_start": START + timedelta(seconds=max(0, batch - rng.randrange(9))),
        "window_start": START + timedelta(seconds=max(0, batch - rng.randrange(9))),
        "fired_at": START + timedelta(seconds=rng.randrange(100)),
        "added": rng.random() < 0.5,
        "value": f"line {rng.randrange(5)}",
        "reason": "malformed_json",
        "period_start": START + timedelta(days=rng.randrange(3)),
        "day": rng.randrange(3),
        "second": rng.randrange(5),
    }
    names = [c.split()[0] for c in RESULT_SCHEMAS[name].split(", ")]
    return tuple(values.get(c, rng.randrange(1000)) for c in names)


class Twin:
    """The same table kept by hand."""

    def __init__(self, name):
        self.names = [c.split()[0] for c in RESULT_SCHEMAS[name].split(", ")]
        self.keys, self.by = RESULT_KEYS.get(name, (None, ()))
        self.sums = name in RESULT_SUMS
        if self.sums:
            self.keys = RESULT_SUMS[name][0]
        self.rows = [] if self.keys is None else {}

    def value(self, row, names):
        return tuple(row[self.names.index(c)] for c in names)

    def batch(self, rng, name, number):
        rows = [row_of(rng, name, number) for _ in range(rng.randrange(1, 5))]
        if self.keys is None:
            return rows
        return [*{self.value(r, self.keys): r for r in rows}.values()]

    def add(self, rows):
        for row in rows:
            if self.keys is None:
                self.rows.append(row)
                continue
            key = self.value(row, self.keys)
            if self.sums:
                self.rows[key] = (*key, self.rows.get(key, (0,))[-1] + row[-1])
            elif key not in self.rows or self.value(row, self.by) >= self.value(self.rows[key], self.by):
                self.rows[key] = row

    def all(self):
        return sorted(self.rows if self.keys is None else self.rows.values(), key=repr)


def content(spark, root, name):
    read = tables.read_latest if name in RESULT_KEYS else tables.read_totals if name in RESULT_SUMS else tables.read_rows
    columns = [c.split()[0] for c in RESULT_SCHEMAS[name].split(", ")]
    return sorted(map(tuple, read(spark, root, name).select(*columns).collect()), key=repr)


@pytest.mark.parametrize("name", RESULT_SCHEMAS)
def test_every_table_reads_the_same_while_it_is_compacted(spark, tmp_path, name):
    root, rng, twin = str(tmp_path), random.Random(name), Twin(name)
    write = tables.batch_writer(root, name)
    for number in range(11):
        rows = twin.batch(rng, name, number)
        frame = spark.createDataFrame(rows, RESULT_SCHEMAS[name])
        write(frame, number)
        if number % 5 == 1:
            write(frame, number)  # a restart runs the newest batch again
        twin.add(rows)
        if number % 3 != 1:
            tables.compact(spark, root, name, 2, grace=0)
        assert content(spark, root, name) == twin.all()
    now = manifest.current(spark, f"{root}/{name}")
    assert now.runs and now.upto >= 7 and len({r.tier for r in now.runs}) == len(now.runs)
    assert tables.batches_of(spark, f"{root}/{name}")[-1] == 10
    place = twin.names.index(RESULT_ORDER.get(name, twin.names[0]))
    values = sorted({r[place] for r in twin.all()})
    for found, wanted in ((tables.lookup(spark, root, name, values[:2]), values[:2]), (tables.lookup_range(spark, root, name, values[1], values[-2]), values[1:-1])):
        assert sorted(map(tuple, found.select(*twin.names).collect()), key=repr) == [r for r in twin.all() if r[place] in wanted]
    assert tables.lookup(spark, root, name, []).count() == 0


def test_a_late_window_does_not_become_the_latest(spark, tmp_path):
    """Batch 0 has a product's later window, batch 1 an earlier one, batch 2 another product."""
    root, name = str(tmp_path), "latest_purchases"
    write = tables.batch_writer(root, name)
    for number, (product, hour, cnt) in enumerate([("a", 10, 5), ("a", 9, 1), ("b", 11, 2)]):
        write(spark.createDataFrame([(product, START + timedelta(hours=hour), cnt)], RESULT_SCHEMAS[name]), number)
    assert tables.compact(spark, root, name, 2)
    assert [r[2] for r in tuples(tables.read_latest(spark, root, name))] == [5, 2]


def activity_rows(spark, users, number):
    return spark.createDataFrame([(u, number, 1, 1, 1, 1) for u in users], RESULT_SCHEMAS["user_activity"])


def test_a_lookup_opens_few_files(spark, tmp_path):
    root, name = str(tmp_path), "user_activity"
    write = tables.batch_writer(root, name)
    for number in range(50):
        write(activity_rows(spark, [number % 4, 100 + number], number), number)
        tables.compact(spark, root, name, 3, grace=0)
    found = tables.lookup(spark, root, name, [2])
    assert [(r.user_id, r.score) for r in found.collect()] == [(2, 46)]
    runs = manifest.current(spark, f"{root}/{name}").runs
    # At most two runs a tier and three recent batches, where 50 batches were written.
    assert len(found.inputFiles()) <= len(runs) + 4 <= 2 * 4 + 4
    assert len(tables.batches_of(spark, f"{root}/{name}")) <= 7


def test_only_files_whose_range_holds_a_key_are_opened(spark, tmp_path):
    root, name = str(tmp_path), "user_activity"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write = tables.batch_writer(root, name)
        for number in range(3):
            write(activity_rows(spark, range(number * 400, number * 400 + 400), number), number)
        assert tables.compact(spark, root, name, 2, grace=0)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    run = manifest.current(spark, f"{root}/{name}").runs[0]
    files = [n for n, _ in manifest.children(spark, f"{root}/{name}/_runs/{run.name}") if n.endswith(".parquet")]
    found = tables.lookup(spark, root, name, [5])
    assert found.count() == 1
    opened = [f for f in found.inputFiles() if "_runs" in f]
    assert len(files) > 1 and len(opened) == 1


def test_of_two_compactors_one_wins(spark, tmp_path):
    root, name = str(tmp_path), "rejects"
    write = tables.batch_writer(root, name)
    for number in range(6):
        write(spark.createDataFrame([(f"l{number}", "r")], RESULT_SCHEMAS[name]), number)
    results = []

    def work():
        results.append(tables.compact(spark, root, name, 2))

    threads = [threading.Thread(target=work) for _ in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert results.count(True) == 1
    assert sorted(r.value for r in tables.read_rows(spark, root, name).collect()) == [f"l{i}" for i in range(6)]
    tables.compact(spark, root, name, 2, grace=0)  # what the others wrote is swept
    assert len(manifest.children(spark, f"{root}/{name}/_runs")) == 1
    table = f"{root}/{name}"
    assert not manifest.publish(spark, table, manifest.current(spark, table), "late")


def test_a_reader_that_planned_before_goes_on(spark, tmp_path):
    """Replaced folders stay for a time, and a reset table has no runs."""
    root, name = str(tmp_path), "rejects"
    write = tables.batch_writer(root, name)
    for number in range(4):
        write(spark.createDataFrame([(f"l{number}", "r")], RESULT_SCHEMAS[name]), number)
    before = tables.read_rows(spark, root, name)
    assert tables.compact(spark, root, name, 2)
    assert before.count() == tables.read_rows(spark, root, name).count() == 4
    # Folders that a compactor may delete meanwhile are not even listed.
    for now in (tables.read_rows(spark, root, name), tables.lookup(spark, root, name, ["l3"])):
        assert not [f for f in now.inputFiles() if "batch_id=0" in f or "batch_id=2" in f]
    tables.reset(spark, root, (name,))
    assert tables.read_rows(spark, root, name).count() == 0
    assert tables.lookup(spark, root, name, ["l1"]).count() == 0


def test_deep_pages_read_their_own_files(spark, tmp_path):
    """Pages of a log of many days by its counts; the rest of the log is not opened."""
    from trolley.operators import abandonment, ranking
    from trolley.plans import dashboard

    root, rng = str(tmp_path), random.Random(7)
    log = [(f"s{rng.randrange(40)}", START + timedelta(days=i // 40, seconds=rng.randrange(300), milliseconds=rng.randrange(3) * 400)) for i in range(480)]
    frame = spark.createDataFrame(log, RESULT_SCHEMAS["abandonment_log"])
    derived = {"abandonment_counts": ranking.slice_counts, "abandoned_sessions": abandonment.last_firings}
    write = tables.batch_writer(root, "abandonment_log", derived)
    for number in range(6):
        write(spark.createDataFrame(log[number * 80 : number * 80 + 80], RESULT_SCHEMAS["abandonment_log"]), number)
        if number in (2, 5):
            for name in ("abandonment_log", *derived):
                assert tables.compact(spark, root, name, 2, grace=0)
    for number in (0, 7, 30, 47):
        assert dashboard.log_page(spark, root, number).collect() == ranking.page(frame, number).collect()
    assert dashboard.log_page(spark, root, 48).count() == 0
    assert dashboard.log_page(spark, root, 3, 200).count() == 0 and dashboard.log_page(spark, root, 2, 200).count() == 80
    assert tuples(dashboard.abandoned_pages(spark, root)) == [(480, 48)]
    files = [f.rsplit("/", 2)[1] for f in dashboard.log_page(spark, root, 47).inputFiles()]
    assert len([f for f in files if not f.startswith("batch_id")]) < len(tables.manifest.current(spark, f"{root}/abandonment_log").runs) + 1
    last = {s: max(t for x, t in log if x == s) for s, _ in log}
    assert dict(map(tuple, tables.read_latest(spark, root, "abandoned_sessions").collect())) == last


def test_index_of_a_run_is_aggregated_in_more_than_its_one_writing_task(spark, tmp_path):
    """As in a micro-batch, without AQE: the task that writes the index must not hold the maps of all partitions."""
    root, context, parts = str(tmp_path), spark.sparkContext, 7
    rows = [(user, user, 0, 0, 0, 0) for user in range(1000)]
    for batch in range(3):
        tables._write(spark.createDataFrame(rows, RESULT_SCHEMAS["user_activity"]), batch, root, "user_activity")
    set_before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        spark.conf.set("spark.sql.shuffle.partitions", str(parts))
        context.setJobGroup("index", "")
        assert tables.compact(spark, root, "user_activity", 2)
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for key, value in set_before.items():
            spark.conf.set(key, value)
    status = context.statusTracker()
    stages = sorted(status.getJobInfo(max(status.getJobIdsForGroup("index"))).stageIds)
    assert [status.getStageInfo(s).numTasks for s in stages][-2:] == [parts, 1]
    assert len(stages) == 3
    assert tuples(tables.lookup(spark, root, "user_activity", [5, 999])) == [rows[5], rows[999]]
    assert tuples(tables.read_latest(spark, root, "user_activity")) == rows
