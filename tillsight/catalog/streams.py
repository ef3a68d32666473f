"""Stream queries, run over what is available and read back as tables.

The events of the test tables lie in one file or many in no fixed order.  Windowed queries
stage them in arrival order first, so that windows are continued from the state of earlier
batches and closed by the watermark; other queries take all events in one micro-batch.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, functions as F

from ..functions.rules import AnomalyLimits
from ..sources.files import save
from ..sources.retail import table
from ..sources.shared import shared_folder
from ..streaming import jobs, sinks, snapshots
from ..streaming.current import CurrentTable, to_current
from ..streaming.sources import (
    TIMESTAMP_FORMAT,
    read_stream,
    with_ingest_columns,
    with_lateness,
    with_validity_flags,
)
from .purchases import events_as_purchases, with_missing_values
from .registry import FIVE_AGES_OPEN, avg, on_gappy, on_purchases, pct, query, share, tot

AMOUNT = "purchase_amount"
EVENT_LIMITS = AnomalyLimits(high_amount=450)


def _event_stream(spark, sf_dir):
    schema = table(spark, sf_dir, "events").schema
    return read_stream(spark, f"{sf_dir}/events*.parquet", schema, fmt="parquet", files_per_trigger=None)


def _purchases(spark, sf_dir):
    return events_as_purchases(_event_stream(spark, sf_dir))


def _wall_clock(df):
    """Timestamps without zone, as the events have them."""
    times = [c for c, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in times}) if times else df


#: Arrivals of the windowed queries.
TIMES = 3


def _current(spark, sf_dir, result_of, keys, at_least=None):
    """Run an update-mode result over the events as they come in time, and return its current rows."""
    events = table(spark, sf_dir, "events")
    cuts = events.agg(F.percentile_approx("ts", [k / TIMES for k in range(1, TIMES)])).first()[0] or []
    arrival = F.lit(0)
    for cut in cuts:
        arrival = arrival + F.coalesce(F.col("ts") > F.lit(cut), F.lit(False)).cast("int")
    return _wall_clock(_run_arrivals(spark, events, arrival, TIMES, result_of, keys).read(at_least))


def _appended(spark, result):
    folder = shared_folder(spark)
    sinks.finish(sinks.to_parquet(result, f"{folder}/rows", f"{folder}/checkpoint"))
    return _wall_clock(spark.read.schema(result.schema).parquet(f"{folder}/rows"))


_TEXT_SCHEMA = "event_id BIGINT, age INT, purchase_amount DOUBLE, timestamp STRING"


def _text_stream(spark, sf_dir, malformed: bool):
    """The events as CSV files with a text timestamp, read as a stream of several files."""
    text = F.date_format("event_time", TIMESTAMP_FORMAT)
    if malformed:
        text = F.when(F.col("event_id") % 29 == 0, "not a time").otherwise(text)
    rows = events_as_purchases(table(spark, sf_dir, "events")).select(
        "event_id", "age", F.col(AMOUNT).cast("double").alias(AMOUNT), text.alias("timestamp")
    )
    path = shared_folder(spark)
    save(rows, path, "csv")
    return with_ingest_columns(read_stream(spark, path, _TEXT_SCHEMA))


@query(
    "stream_scan",
    "SELECT event_id, CAST(18 + user_id % 53 AS INT) AS age, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS purchase_amount, "
    "DATE_TRUNC('second', ts) AS event_time, TRUE AS age_valid, TRUE AS amount_valid FROM events",
)
def stream_scan(spark, sf_dir):
    stream = _text_stream(spark, sf_dir, malformed=False)
    return _appended(
        spark, stream.select("event_id", "age", AMOUNT, "event_time", "age_valid", "amount_valid")
    )


@query(
    "stream_event_time",
    "SELECT event_id, CASE WHEN event_id % 29 <> 0 THEN DATE_TRUNC('second', ts) END AS event_time, "
    "event_id % 29 <> 0 AS time_valid, TRUE AS was_stamped FROM events",
)
def stream_event_time(spark, sf_dir):
    stream = _text_stream(spark, sf_dir, malformed=True)
    return _appended(
        spark,
        stream.select(
            "event_id",
            "event_time",
            F.col("event_time").isNotNull().alias("time_valid"),
            F.col("processing_time").isNotNull().alias("was_stamped"),
        ),
    )


# Arrival order of the events: three thirds by id, and every tenth event one third later.
SPLITS = 4


def _split_number(events):
    last_id = events.agg(F.coalesce(F.max("event_id"), F.lit(0))).first()[0]
    on_time = F.floor(F.col("event_id") * 3 / F.lit(last_id + 1)).cast("int")
    return on_time + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0)


_ARRIVALS = (
    "SELECT *, CAST(FLOOR(event_id * 3e0 / (SELECT MAX(event_id) + 1 FROM events)) AS INT) "
    "+ CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS split FROM purchases"
)


def _run_arrivals(spark, events, arrival, arrivals, result_of, keys, each=None, folder=None):
    """Stage one arrival after the other; each is a run of the same query that stops when done."""
    folder = folder or shared_folder(spark)
    for k in range(arrivals):
        events.where(arrival == k).write.parquet(f"{folder}/arrivals/{k}")
        stream = read_stream(
            spark, f"{folder}/arrivals/*", events.schema, fmt="parquet", files_per_trigger=None
        )
        result = result_of(events_as_purchases(stream))
        current = CurrentTable(spark, f"{folder}/current", result.schema, keys)
        run = each or (lambda _, __, begin: sinks.finish(begin()))
        run(k, current, lambda: to_current(result, current, f"{folder}/checkpoint"))
    return current


@query(
    "stream_memory_latest",
    on_purchases(f"SELECT category, gender, COUNT(*) AS n, {tot(AMOUNT)} AS revenue FROM purchases GROUP BY 1, 2"),
)
def stream_memory_latest(spark, sf_dir):
    """Complete mode: the memory table holds one current row per key and no old versions."""
    totals = (
        _purchases(spark, sf_dir)
        .groupBy("category", "gender")
        .agg(F.count("*").alias("n"), F.sum(AMOUNT).cast("double").alias("revenue"))
    )
    name = "latest_" + uuid.uuid4().hex
    sinks.finish(sinks.to_memory(totals, name, shared_folder(spark), mode="complete"))
    return spark.table(name)


def _daily(purchases):
    return (
        with_lateness(purchases, "40 days")
        .groupBy(F.window("event_time", "1 day"), "category")
        .agg(F.count("*").alias("n"), F.sum(AMOUNT).cast("double").alias("revenue"))
        .select(F.col("window.start").alias("window_start"), "category", "n", "revenue")
    )


@query(
    "stream_sink_durable",
    on_purchases(
        "SELECT DATE_TRUNC('day', event_time)::TIMESTAMP AS window_start, category, COUNT(*) AS n, "
        f"{tot(AMOUNT)} AS revenue FROM purchases GROUP BY 1, 2"
    ),
)
def stream_sink_durable(spark, sf_dir):
    """Four arrivals in four runs on one checkpoint; the table holds the newest version of each row."""
    events = table(spark, sf_dir, "events")
    current = _run_arrivals(spark, events, _split_number(events), SPLITS, _daily, ["window_start", "category"])
    return _wall_clock(current.read())


def _late(purchases):
    return (
        with_lateness(purchases, "5 days")
        .groupBy(F.window("event_time", "1 hour"))
        .agg(F.count("*").alias("n"), F.sum(AMOUNT).cast("double").alias("revenue"))
        .select(F.col("window.start").alias("window_start"), "n", "revenue")
    )


_LATE = {
    "arrivals": _ARRIVALS,
    "newest": "SELECT split, MAX(event_time) AS t FROM arrivals GROUP BY split",
    "limits": "SELECT s.split, DATE_TRUNC('millisecond', MAX(e.t)) - INTERVAL 5 DAY AS mark FROM newest s "
    "LEFT JOIN newest e ON e.split < s.split GROUP BY s.split",
    "counted": "SELECT DATE_TRUNC('hour', event_time) AS window_start, COUNT(*) AS n, "
    f"{tot(AMOUNT)} AS revenue FROM arrivals a JOIN limits l ON a.split = l.split "
    "WHERE l.mark IS NULL OR DATE_TRUNC('hour', event_time) + INTERVAL 1 HOUR > l.mark GROUP BY 1",
    "closing": "SELECT DATE_TRUNC('millisecond', MAX(event_time)) - INTERVAL 5 DAY AS mark FROM purchases",
}


def _kept_state(spark, checkpoint):
    """Windows and row counts that the query still holds in its state."""
    rows = spark.read.format("statestore").load(checkpoint)
    window = rows.schema["key"].dataType.fieldNames()[0]
    count = rows.schema["value"].dataType.fieldNames()
    counts = next(c for c in count if c.startswith("count"))
    return rows.select(F.col(f"key.{window}.start").alias("window_start"), F.col(f"value.{counts}").alias("in_state"))


@query(
    "stream_watermark_late",
    on_purchases(
        "SELECT window_start, n, revenue, CASE WHEN window_start + INTERVAL 1 HOUR > mark THEN n END AS in_state FROM counted, closing",
        **_LATE,
    ),
)
def stream_watermark_late(spark, sf_dir):
    """Late rows are dropped once the watermark of the earlier arrivals has passed their window, and its state is let go."""
    events, folder = table(spark, sf_dir, "events"), shared_folder(spark)
    with sinks.state_provider(spark):
        current = _run_arrivals(spark, events, _split_number(events), SPLITS, _late, ["window_start"], folder=folder)
    state = _kept_state(spark, f"{folder}/checkpoint")
    return _wall_clock(current.read().join(state, "window_start", "left"))


class _Interrupted(Exception):
    """What the killed batch of ``stream_restart`` dies of."""


@query(
    "stream_restart",
    on_purchases(
        "SELECT window_start, n, revenue, CASE WHEN window_start + INTERVAL 1 HOUR > mark THEN n END AS in_state, "
        "'stateStoreSave' AS operator FROM counted, closing",
        **_LATE,
    ),
)
def stream_restart(spark, sf_dir):
    """The third arrival's batch dies after its rows were written and before they are part of the table.

    The old state is still read then; a restart on the same checkpoint runs the batch again, and nothing is
    lost or counted twice, in the table as in the state, which is kept in RocksDB.
    """
    events, folder = table(spark, sf_dir, "events"), shared_folder(spark)

    def die(batch):
        raise _Interrupted(batch)

    def each(k, current, begin):
        if k == 2:
            before, current.before_commit = current.manifest(), die
            try:
                sinks.finish(begin())
            except StreamingQueryException:
                if current.manifest() != before:
                    raise
            current.before_commit = None
        sinks.finish(begin())

    with sinks.state_provider(spark):
        current = _run_arrivals(spark, events, _split_number(events), SPLITS, _late, ["window_start"], each, folder)
    state = _kept_state(spark, f"{folder}/checkpoint")
    operators = spark.read.format("state-metadata").load(f"{folder}/checkpoint").agg(F.max("operatorName").alias("operator"))
    found = _wall_clock(current.read().join(state, "window_start", "left"))
    return found.withColumn("operator", operators.scalar())


def _hourly_categories(spark, sf_dir, at_least=None, keep_sketch=False):
    def result_of(purchases):
        return jobs.category_performance(with_lateness(purchases), "1 hour", keep_sketch)

    return _current(spark, sf_dir, result_of, ["window_start", "window_end", "category"], at_least)


_HOUR = "DATE_TRUNC('hour', event_time)"
_CATEGORY_SQL = (
    f"SELECT {_HOUR} AS window_start, {_HOUR} + INTERVAL 1 HOUR AS window_end, category, COUNT(*) AS transaction_count, "
    f"{tot(AMOUNT)} AS total_revenue, {avg(AMOUNT)} AS avg_purchase, {avg('age', 1)} AS avg_age, {avg('review_rating')} AS avg_rating, "
    "COUNT(DISTINCT customer_id) AS unique_customers FROM purchases GROUP BY 1, 2, 3"
)


@query("stream_category_window", on_purchases(_CATEGORY_SQL))
def stream_category_window(spark, sf_dir):
    return _hourly_categories(spark, sf_dir)


@query(
    "snapshot_category",
    on_purchases(
        "SELECT window_start, category, transaction_count, total_revenue, avg_purchase FROM current_rows "
        "ORDER BY window_start DESC, total_revenue DESC, category LIMIT 5",
        current_rows=_CATEGORY_SQL,
    ),
)
def snapshot_category(spark, sf_dir):
    return snapshots.recent_categories(_hourly_categories(spark, sf_dir, snapshots.CATEGORIES), snapshots.CATEGORIES)


@query(
    "stream_customers_rules",
    on_purchases(
        "SELECT DISTINCT CAST(DATE_TRUNC('day', event_time) AS TIMESTAMP) AS window_start, category, TRUE AS as_if_direct, "
        "TRUE AS near_exact FROM purchases"
    ),
)
def stream_customers_rules(spark, sf_dir):
    """Days from merged hours have the sketch of the days themselves, within 5 % of the exact number of customers."""
    merged = jobs.customers_over(_hourly_categories(spark, sf_dir, keep_sketch=True), "1 day", "category")
    purchases = events_as_purchases(table(spark, sf_dir, "events"))
    day = F.window("event_time", "1 day").start.cast("timestamp_ntz")
    exact = purchases.groupBy(day.alias("day"), F.col("category").alias("of")).agg(
        F.count_distinct("customer_id").alias("exact"), F.hll_sketch_estimate(F.hll_sketch_agg("customer_id", F.lit(jobs.SKETCH))).alias("direct")
    )
    both = merged.join(exact, (F.col("window_start") == F.col("day")) & F.col("category").eqNullSafe(F.col("of")))
    return both.select(
        "window_start",
        "category",
        (F.abs(F.col("unique_customers") - F.col("direct")) <= F.col("direct") * F.lit(0.01)).alias("as_if_direct"),
        (F.abs(F.col("unique_customers") - F.col("exact")) <= F.col("exact") * F.lit(0.05)).alias("near_exact"),
    )


_IS_PURCHASE = "payment_method = 'purchase'"
_IS_VIEW = "payment_method = 'view'"
_SUBSCRIBED = "subscription_status = 'Yes'"


@query(
    "stream_kpis",
    on_purchases(
        f"SELECT {_HOUR} AS window_start, {_HOUR} + INTERVAL 1 HOUR AS window_end, COUNT(*) AS total_transactions, "
        f"{tot(AMOUNT)} AS total_revenue, {avg(AMOUNT)} AS avg_order_value, {avg('review_rating')} AS avg_rating, "
        f"{share(_IS_PURCHASE, 1)} AS purchase_pct, "
        f"{share(_IS_VIEW, 1)} AS view_pct, "
        f"{share(_SUBSCRIBED, 1)} AS subscriber_rate, "
        f"{share('purchase_amount >= 60', 1)} AS premium_rate, COUNT(DISTINCT customer_id) AS unique_customers "
        "FROM purchases GROUP BY 1, 2"
    ),
)
def stream_kpis(spark, sf_dir):
    def result_of(purchases):
        return jobs.live_kpis(
            with_lateness(purchases), "1 hour", payment_shares={"purchase_pct": "purchase", "view_pct": "view"}
        )

    return _current(spark, sf_dir, result_of, ["window_start", "window_end"])


def _daily_behavior(spark, sf_dir, at_least=None):
    def result_of(purchases):
        return jobs.customer_behavior(with_lateness(purchases), "1 day")

    return _current(spark, sf_dir, result_of, ["window_start", "window_end", "age_group", "gender"], at_least)


_DAY = "CAST(DATE_TRUNC('day', event_time) AS TIMESTAMP)"
_BEHAVIOR_SQL = (
    f"SELECT {_DAY} AS window_start, {_DAY} + INTERVAL 1 DAY AS window_end, {FIVE_AGES_OPEN} AS age_group, gender, "
    f"COUNT(*) AS customer_count, {tot(AMOUNT)} AS total_spent, {avg(AMOUNT)} AS avg_spent, {avg('review_rating')} AS avg_rating, "
    f"{avg('previous_purchases', 1)} AS avg_loyalty, {share('purchase_amount >= 60', 1)} AS premium_rate FROM purchases GROUP BY 1, 2, 3, 4"
)


@query("stream_behavior", on_purchases(_BEHAVIOR_SQL))
def stream_behavior(spark, sf_dir):
    return _daily_behavior(spark, sf_dir)


@query(
    "snapshot_behavior",
    on_purchases(
        "SELECT window_start, age_group, gender, customer_count, avg_spent, premium_rate FROM current_rows "
        "ORDER BY window_start DESC, customer_count DESC, age_group, gender LIMIT 5",
        current_rows=_BEHAVIOR_SQL,
    ),
)
def snapshot_behavior(spark, sf_dir):
    return snapshots.recent_behavior(_daily_behavior(spark, sf_dir, snapshots.BEHAVIOR), snapshots.BEHAVIOR)


_ALERT = (
    "CASE WHEN purchase_amount >= 450 THEN 'HIGH_PURCHASE' WHEN age >= 70 THEN 'SENIOR_BUYER' "
    "WHEN purchase_amount <= 20 THEN 'LOW_PURCHASE' WHEN previous_purchases >= 40 THEN 'SUPER_LOYAL' ELSE 'NORMAL' END"
)


@query(
    "stream_anomalies",
    on_purchases(
        "SELECT event_time, customer_id, age, gender, item_purchased, category, CAST(purchase_amount AS DOUBLE) AS purchase_amount, "
        f"previous_purchases, {_ALERT} AS anomaly_type FROM purchases WHERE {_ALERT} <> 'NORMAL'"
    ),
)
def stream_anomalies(spark, sf_dir):
    alerts = jobs.anomaly_alerts(_purchases(spark, sf_dir), EVENT_LIMITS)
    return _appended(spark, alerts.withColumn(AMOUNT, F.col(AMOUNT).cast("double")))


def _hourly_quality(spark, sf_dir, at_least=None):
    def result_of(purchases):
        gappy = with_validity_flags(with_missing_values(purchases))
        return jobs.data_quality(with_lateness(gappy, column="processing_time"), "1 hour")

    return _current(spark, sf_dir, result_of, ["window_start", "window_end"], at_least)


_PROCESSED = "DATE_TRUNC('hour', processing_time)"
_QUALITY_SQL = (
    f"SELECT {_PROCESSED} AS window_start, {_PROCESSED} + INTERVAL 1 HOUR AS window_end, COUNT(*) AS total_records, "
    "COUNT(*) - COUNT(age) AS age_null_count, COUNT(*) - COUNT(purchase_amount) AS amount_null_count, "
    f"{avg('CAST(FLOOR(EPOCH(processing_time)) - FLOOR(EPOCH(event_time)) AS BIGINT)', 1)} AS avg_delay_sec, "
    f"{pct('(COUNT(*) - COUNT(age))', 'COUNT(*)')} AS age_null_pct, "
    f"{pct('(COUNT(*) - COUNT(purchase_amount))', 'COUNT(*)')} AS amount_null_pct FROM purchases GROUP BY 1, 2"
)


@query("stream_quality", on_gappy(_QUALITY_SQL))
def stream_quality(spark, sf_dir):
    return _hourly_quality(spark, sf_dir)


@query(
    "snapshot_quality",
    on_gappy(
        "SELECT window_start, total_records, age_null_count, amount_null_count, age_null_pct, amount_null_pct, avg_delay_sec "
        "FROM current_rows ORDER BY window_start DESC LIMIT 3",
        current_rows=_QUALITY_SQL,
    ),
)
def snapshot_quality(spark, sf_dir):
    return snapshots.recent_quality(_hourly_quality(spark, sf_dir, snapshots.QUALITY), snapshots.QUALITY)


@query(
    "stream_fanout",
    on_purchases(
        f"SELECT 'alerts' AS output, COUNT(*) AS n FROM purchases WHERE {_ALERT} <> 'NORMAL' UNION ALL "
        "SELECT 'flags', COUNT(*) FROM purchases UNION ALL "
        "SELECT 'hours', COUNT(*) FROM (SELECT DISTINCT DATE_TRUNC('hour', event_time), category FROM purchases)"
    ),
)
def stream_fanout(spark, sf_dir):
    """Two stateless outputs from one read, and a stateful query of its own beside them."""
    folder = shared_folder(spark)
    purchases = _purchases(spark, sf_dir)
    hourly = jobs.category_performance(with_lateness(purchases), "1 hour")
    both = sinks.fan_out(
        purchases,
        {
            "alerts": lambda b: jobs.anomaly_alerts(b, EVENT_LIMITS),
            "flags": lambda b: with_validity_flags(b).select("event_id", "age_valid", "amount_valid"),
        },
        folder,
        f"{folder}/checkpoint-fan-out",
    )
    stateful = sinks.to_versions(hourly, f"{folder}/hours", f"{folder}/checkpoint-hours")
    sinks.finish(both, stateful)
    hours = sinks.latest_version(
        sinks.read_versions(spark, f"{folder}/hours", hourly), ["window_start", "window_end", "category"]
    )

    def rows(name, df):
        return df.agg(F.count("*").alias("n")).select(F.lit(name).alias("output"), "n")

    return (
        rows("alerts", spark.read.parquet(f"{folder}/alerts"))
        .union(rows("flags", spark.read.parquet(f"{folder}/flags")))
        .union(rows("hours", hours))
    )


_FIVE = {
    "category_performance": "SELECT COUNT(*) AS n, SUM(transaction_count) AS total FROM categories",
    "business_kpis": "SELECT COUNT(*), SUM(total_transactions) FROM kpis",
    "customer_behavior": "SELECT COUNT(*), SUM(customer_count) FROM behavior",
    "anomaly_alerts": f"SELECT COUNT(*), COUNT(*) FROM purchases WHERE {_ALERT} <> 'NORMAL'",
    "data_quality": "SELECT COUNT(*), SUM(total_records) FROM quality",
}


@query(
    "stream_five_queries",
    on_gappy(
        "SELECT output, n, CAST(COALESCE(total, 0) AS BIGINT) AS total, (SELECT COUNT(*) FROM purchases) AS rows_read FROM ("
        + " UNION ALL ".join(f"SELECT '{name}' AS output, * FROM ({sql})" for name, sql in _FIVE.items())
        + ")",
        categories=f"SELECT {_HOUR}, category, COUNT(*) AS transaction_count FROM purchases GROUP BY 1, 2",
        kpis=f"SELECT {_HOUR}, COUNT(*) AS total_transactions FROM purchases GROUP BY 1",
        behavior=f"SELECT {_DAY}, {FIVE_AGES_OPEN}, gender, COUNT(*) AS customer_count FROM purchases GROUP BY 1, 2, 3",
        quality=f"SELECT {_PROCESSED}, COUNT(*) AS total_records FROM purchases GROUP BY 1",
    ),
)
def stream_five_queries(spark, sf_dir):
    """All five stream queries at once, each in a scheduler pool of its own: rows per output and rows read by each."""
    folder = shared_folder(spark)
    rows = with_validity_flags(with_missing_values(_purchases(spark, sf_dir)))
    late = with_lateness(rows)
    windowed = {
        "category_performance": (jobs.category_performance(late, "1 hour"), ["window_start", "window_end", "category"], "transaction_count"),
        "business_kpis": (jobs.live_kpis(late, "1 hour"), ["window_start", "window_end"], "total_transactions"),
        "customer_behavior": (
            jobs.customer_behavior(late, "1 day"), ["window_start", "window_end", "age_group", "gender"], "customer_count"
        ),
        "data_quality": (
            jobs.data_quality(with_lateness(rows, column="processing_time"), "1 hour"), ["window_start", "window_end"], "total_records"
        ),
    }
    tables = {n: CurrentTable(spark, f"{folder}/{n}", df.schema, keys) for n, (df, keys, _) in windowed.items()}
    alerts = jobs.anomaly_alerts(rows, EVENT_LIMITS)
    starts = {
        n: lambda n=n, df=df: to_current(df, tables[n], f"{folder}/checkpoint-{n}", name=n) for n, (df, _, _) in windowed.items()
    }
    starts["anomaly_alerts"] = lambda: sinks.to_parquet(
        alerts, f"{folder}/anomaly_alerts", f"{folder}/checkpoint-anomaly_alerts", name="anomaly_alerts"
    )
    progress = sinks.run_together(spark, starts)
    counted = [
        tables[n].read().agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(total), F.lit(0)).alias("total")).withColumn("output", F.lit(n))
        for n, (_, _, total) in windowed.items()
    ]
    found = spark.read.schema(alerts.schema).parquet(f"{folder}/anomaly_alerts")
    counted.append(found.agg(F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("total")).withColumn("output", F.lit("anomaly_alerts")))
    read = spark.createDataFrame([(n, progress.rows.get(n, 0)) for n in starts], "name STRING, rows_read BIGINT")
    outputs = reduce(DataFrame.unionByName, counted)
    return outputs.join(read, F.col("output") == F.col("name")).select("output", "n", "total", "rows_read")
