import os
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tillsight.streaming import jobs, sinks
from tillsight.streaming.current import KEPT, OPEN, CurrentTable, to_current
from tillsight.catalog.purchases import events_as_purchases
from tillsight.streaming.sources import (
    STREAM_FILE_SCHEMA,
    read_stream,
    with_ingest_columns,
    with_lateness,
)

SCHEMA = "k STRING, event_time TIMESTAMP"


class Stage:
    """A folder of files that a stream takes one per trigger, in the order they were added."""

    def __init__(self, spark, root):
        self.spark, self.root, self.n = spark, root, 0
        self.path = str(root / "in")
        os.makedirs(self.path)

    def add(self, *rows):
        text = "k,event_time\n" + "".join(f"{k},2024-01-01 {t}\n" for k, t in rows)
        name = f"{self.path}/{self.n:03d}.csv"
        with open(name, "w") as f:
            f.write(text)
        when = time.time() - 1000 + self.n
        os.utime(name, (when, when))
        self.n += 1

    def stream(self):
        return read_stream(self.spark, self.path, SCHEMA)


@pytest.fixture
def stage(spark, tmp_path):
    return Stage(spark, tmp_path)


def _minutes(stream):
    return (
        with_lateness(stream)
        .groupBy(F.window("event_time", "1 minute"), "k")
        .agg(F.count("*").alias("n"))
        .select(F.date_format("window.start", "HH:mm").alias("minute"), "k", "n")
    )


def _append(stage):
    out, checkpoint = str(stage.root / "out"), str(stage.root / "checkpoint")
    sinks.finish(sinks.to_parquet(_minutes(stage.stream()), out, checkpoint))
    return sorted(tuple(r) for r in stage.spark.read.parquet(out).collect())


def test_late_rows(stage):
    stage.add(("a", "00:00:10"), ("a", "00:05:30"))
    stage.add(("b", "00:05:40"))
    stage.add(("late_closed", "00:00:20"), ("late_open", "00:03:05"), ("a", "00:06:00"))
    stage.add(("a", "00:10:00"))
    got = _append(stage)
    assert ("00:03", "late_open", 1) in got
    assert not [r for r in got if r[1] == "late_closed"]
    assert not [r for r in got if r[0] == "00:10"]


def test_row_right_after_the_watermark_moved_counts(stage):
    stage.add(("a", "00:00:10"), ("a", "00:05:30"))
    stage.add(("b", "00:05:40"), ("a", "00:00:20"))
    stage.add(("a", "00:10:00"))
    assert ("00:00", "a", 2) in _append(stage)


def test_restart_adds_only_what_is_new(stage):
    stage.add(("a", "00:00:10"), ("a", "00:05:30"))
    first = _append(stage)
    assert _append(stage) == first
    stage.add(("a", "00:12:00"))
    second = _append(stage)
    assert set(first) < set(second) and len(second) == len(set(second))


def test_update_mode_keeps_versions_and_latest_has_one(spark, stage):
    for t in ("00:00:10", "00:00:20", "00:00:30"):
        stage.add(("a", t))
    table = "versions_of_a"
    sinks.finish(sinks.to_memory(_minutes(stage.stream()), table, str(stage.root / "m"), mode="update"))
    assert sorted(r["n"] for r in spark.table(table).collect()) == [1, 2, 3]

    result = _minutes(stage.stream())
    out = str(stage.root / "v")
    sinks.finish(sinks.to_versions(result, out, str(stage.root / "c")))
    versions = sinks.read_versions(spark, out, result)
    assert versions.count() >= 3
    assert [tuple(r) for r in sinks.latest_version(versions, ["minute", "k"]).collect()] == [("00:00", "a", 3)]


def test_repeated_batch_overwrites_its_version(spark, tmp_path):
    one = spark.createDataFrame([("a", 1)], "k STRING, n BIGINT")
    for _ in range(2):
        one.write.mode("overwrite").parquet(f"{tmp_path}/v/batch_id=0")
    assert sinks.read_versions(spark, f"{tmp_path}/v", one).count() == 1


def test_times_that_do_not_parse(spark, rows):
    df = spark.createDataFrame(
        [("2024-01-01 10:00:00", 1, 2), ("soon", None, 2), ("", 3, None), (None, 4, 5)],
        "timestamp STRING, age INT, purchase_amount INT",
    )
    got = with_ingest_columns(df).select("event_time", "age_valid", "amount_valid").collect()
    assert [r[0] for r in got] == [datetime(2024, 1, 1, 10), None, None, None]
    assert [(r[1], r[2]) for r in got] == [(True, True), (False, True), (True, False), (True, True)]


def test_file_stream_schema(spark, tmp_path):
    fields = spark.createDataFrame([], STREAM_FILE_SCHEMA).columns
    assert len(fields) == 19 and fields[-1] == "timestamp" and fields[5] == "Purchase Amount (USD)"


def _purchases(spark):
    start = datetime(2024, 1, 1)
    rows = [(i, start + timedelta(seconds=13 * i), i % 40, ["view", "click"][i % 2], float(i % 97), "{}") for i in range(400)]
    events = spark.createDataFrame(rows, "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING")
    return events


def test_stream_equals_batch(spark, tmp_path):
    """One-minute windows over several micro-batches give what a batch job gives."""
    events = _purchases(spark)
    for k in range(4):
        events.where((F.col("event_id") >= 100 * k) & (F.col("event_id") < 100 * (k + 1))).coalesce(1).write.parquet(
            f"{tmp_path}/in/{k}"
        )
    stream = read_stream(spark, f"{tmp_path}/in/*", events.schema, fmt="parquet")
    job = jobs.category_performance
    result = job(with_lateness(events_as_purchases(stream), "1 hour"))
    sinks.finish(sinks.to_versions(result, f"{tmp_path}/out", f"{tmp_path}/checkpoint"))
    got = sinks.latest_version(
        sinks.read_versions(spark, f"{tmp_path}/out", result), ["window_start", "window_end", "category"]
    )
    expected = job(events_as_purchases(events))
    assert sorted(map(tuple, got.select(expected.columns).collect())) == sorted(map(tuple, expected.collect()))


def test_approximate_customers(spark):
    df = spark.range(20_000).select(
        F.lit(datetime(2024, 1, 1)).alias("event_time"),
        F.lit("x").alias("category"),
        (F.col("id") % 5_000).alias("customer_id"),
        F.lit(1).cast("decimal(12,2)").alias("purchase_amount"),
        F.lit(30).alias("age"),
        F.lit(4.0).cast("decimal(2,1)").alias("review_rating"),
    )
    assert jobs.category_performance(df).first()["unique_customers"] == pytest.approx(5_000, rel=0.1)


def test_memory_query_keeps_state_in_the_shared_folder(spark, monkeypatch):
    from tillsight.catalog import QUERIES
    from tillsight.sources.shared import session_folder
    from tillsight.streaming import sinks

    seen, start = [], sinks.to_memory
    monkeypatch.setattr(sinks, "to_memory", lambda df, name, checkpoint, **how: seen.append(checkpoint) or start(df, name, checkpoint, **how))
    assert QUERIES["stream_memory_latest"](spark, "/root/testdata/sf0.001").count() > 0
    assert seen[0].startswith(session_folder(spark))
    assert spark.read.format("statestore").load(seen[0]).count() > 0


def _hours(spark, *rows):
    return spark.createDataFrame([(datetime(2024, 1, d, h), k, n) for d, h, k, n in rows], "window_start TIMESTAMP, k STRING, n BIGINT")


def _table(spark, path):
    return CurrentTable(spark, f"{path}/t", "window_start TIMESTAMP, k STRING, n BIGINT", ["window_start", "k"])


def _files(df):
    return sorted(df.inputFiles())


def test_current_table_replaces_rows_and_rewrites_only_what_changed(spark, tmp_path, rows):
    t = _table(spark, tmp_path)
    assert t.read().count() == 0 and t.manifest()["batch"] == -1
    t.merge(_hours(spark, (1, 0, "a", 1), (1, 1, "a", 2), (2, 0, None, 3), (3, 0, "a", 4), (4, 0, "a", 5)), 0)
    first = t.manifest()["periods"]
    t.merge(_hours(spark, (4, 0, "a", 6), (4, 0, "b", 7), (2, 0, None, 8)), 1)
    second = t.manifest()["periods"]
    assert rows(t.read().select(F.dayofmonth("window_start"), "k", "n")) == sorted(
        [(1, "a", 1), (1, "a", 2), (2, None, 8), (3, "a", 4), (4, "a", 6), (4, "b", 7)], key=repr
    )
    assert {p for p in first if first[p] != second[p]} == {"2024-01-02", "2024-01-04"}


def test_current_table_reads_only_the_newest_periods(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.merge(_hours(spark, *[(d, h, "a", h) for d in range(1, 21) for h in range(24)]), 0)
    assert t.read().count() == 480
    newest = t.read(at_least=30)
    assert newest.count() == 48 and all("2024-01-20" in f or "2024-01-19" in f for f in _files(newest))
    closed = [p for p, (_, _, c) in t.manifest()["periods"].items() if c]
    assert len(closed) == 20 - OPEN
    assert sum("2024-01-03" in f for f in _files(t.read())) == 1  # a closed period is one file


def test_a_batch_that_dies_leaves_the_old_state(spark, tmp_path):
    t = _table(spark, tmp_path)
    t.merge(_hours(spark, (1, 0, "a", 1)), 0)

    def die(batch):
        raise RuntimeError(batch)

    t.before_commit = die
    with pytest.raises(RuntimeError):
        t.merge(_hours(spark, (1, 0, "a", 2)), 1)
    assert [r.n for r in _table(spark, tmp_path).read().collect()] == [1]
    t.before_commit = None
    t.merge(_hours(spark, (1, 0, "a", 2)), 1)
    t.merge(_hours(spark, (1, 0, "a", 9)), 1)  # a batch that is part of the state already
    assert [r.n for r in _table(spark, tmp_path).read().collect()] == [2]


def test_old_manifests_and_folders_go(spark, tmp_path):
    t = _table(spark, tmp_path)
    for b in range(6):
        t.merge(_hours(spark, (1, 0, "a", b)), b)
    assert len(t._manifests()) == KEPT and len(os.listdir(tmp_path / "t" / "rows")) >= KEPT
    assert len([d for d in (tmp_path / "t" / "rows").iterdir() if any(d.iterdir()) and any(x.is_dir() for x in d.iterdir())]) <= KEPT
    assert [r.n for r in t.read().collect()] == [5]


def test_current_table_of_a_stream_with_all_its_rows_again(spark, stage, tmp_path):
    stage.add(("a", "00:00:10"), ("b", "00:05:30"))
    stage.add(("a", "00:05:40"))
    result = with_lateness(stage.stream()).groupBy(F.window("event_time", "1 minute"), "k").agg(F.count("*").alias("n"))
    result = result.select(F.col("window.start").alias("window_start"), "k", "n")
    t = CurrentTable(spark, f"{tmp_path}/t", result.schema, ["window_start", "k"], period="yyyy-MM-dd-HH-mm")
    sinks.finish(to_current(result, t, f"{tmp_path}/c"))
    assert sorted(r.n for r in t.read().collect()) == [1, 1, 1] and len(t.manifest()["periods"]) == 2


def test_no_events(spark, tmp_path):
    """Stream queries over an empty table have no rows and no error."""
    from tillsight.catalog import QUERIES

    spark.read.parquet("/root/testdata/sf0.001/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    for name in ("stream_sink_durable", "stream_watermark_late", "stream_restart", "stream_category_window", "snapshot_quality"):
        assert QUERIES[name](spark, str(tmp_path)).count() == 0, name
    five = QUERIES["stream_five_queries"](spark, str(tmp_path)).collect()
    assert len(five) == 5 and all(r.n == 0 and r.rows_read == 0 for r in five)


def test_a_wrong_header_of_a_stream_file_is_an_error(spark, tmp_path):
    os.makedirs(f"{tmp_path}/in")
    with open(f"{tmp_path}/in/0.csv", "w") as f:
        f.write("b,a\n1,2\n")
    stream = read_stream(spark, f"{tmp_path}/in", "a INT, b INT")
    with pytest.raises(Exception, match="(?i)header"):
        sinks.finish(sinks.to_parquet(stream, f"{tmp_path}/out", f"{tmp_path}/c"))


def test_sketches_merge_over_time_and_keys(spark):
    from tillsight.sources.retail import table

    purchases = events_as_purchases(table(spark, "/root/testdata/sf0.001", "events"))
    hours = jobs.category_performance(purchases, "1 hour", keep_sketch=True)
    merged = {(r.window_start, r.category): r.unique_customers for r in jobs.customers_over(hours, "1 day", "category").collect()}
    direct = {(r.window_start, r.category): r.unique_customers for r in jobs.category_performance(purchases, "1 day").collect()}
    assert merged == direct and len(direct) > 10


def test_an_error_of_one_query_stops_the_others(spark, tmp_path):
    events = _purchases(spark)
    events.write.parquet(f"{tmp_path}/in")
    good = read_stream(spark, f"{tmp_path}/in", events.schema, fmt="parquet")
    bad = good.select(F.raise_error(F.lit("no")).alias("x"), "event_id")
    with pytest.raises(Exception, match="no"):
        sinks.run_together(
            spark,
            {
                "bad": lambda: sinks.to_parquet(bad, f"{tmp_path}/b", f"{tmp_path}/cb", name="bad"),
                "good": lambda: sinks.to_parquet(good, f"{tmp_path}/g", f"{tmp_path}/cg", name="good"),
            },
        )
    assert not [q for q in spark.streams.active]


def test_fan_out_with_a_stateful_query_beside_it(spark):
    """The hours and categories of the stateful query are those of a batch job."""
    from tillsight.catalog import QUERIES

    got = {r.output: r.n for r in QUERIES["stream_fanout"](spark, "/root/testdata/sf0.001").collect()}
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    hours = events_as_purchases(events).select(F.date_trunc("hour", "event_time"), "category").distinct().count()
    assert got["flags"] == events.count() and got["hours"] == hours > 0 and set(got) == {"alerts", "flags", "hours"}
