import json
import random
import subprocess
import sys
from collections import defaultdict
from itertools import combinations
from pathlib import Path

import pytest

from tillsight.operators.basket import affinity, basket_items, frequent_pairs, pairs_of


def _purchases():
    rng = random.Random(5)
    rows = [(b, f"i{rng.randrange(12)}", rng.randrange(1, 50)) for b in range(120) for _ in range(rng.randrange(1, 6))]
    rows += [(999, f"i{i % 12}", 10) for i in range(600)]  # one basket with many lines
    rows += [(1000, "only", 3), (1000, "only", 5)]
    return rows


def _brute_force(rows):
    lines = defaultdict(list)
    for b, i, a in rows:
        lines[b, i].append(a)
    baskets = defaultdict(set)
    for b, i in lines:
        baskets[b].add(i)
    out = defaultdict(lambda: [0, 0.0, 0])
    for b, items in baskets.items():
        for x, y in combinations(sorted(items), 2):
            o = out[x, y]
            o[0] += 1
            o[1] += sum(lines[b, x]) / len(lines[b, x]) + sum(lines[b, y]) / len(lines[b, y])
            o[2] += len(lines[b, x]) + len(lines[b, y])
    return {k: (n, round(s, 6), p) for k, (n, s, p) in out.items()}


def _as_dict(df):
    return {
        (r["item_a"], r["item_b"]): (r["baskets_with_both"], round(r["spend"], 6), r["purchases"]) for r in df.collect()
    }


@pytest.mark.parametrize("rows_per_part", [1, 5, 1_000])
def test_pairs_equal_brute_force(spark, rows_per_part):
    rows = _purchases()
    items = basket_items(spark.createDataFrame(rows, "b INT, i STRING, a INT"), "b", "i", "a")
    assert _as_dict(pairs_of(items, rows_per_part)) == _brute_force(rows)


def test_support_limit_is_exact(spark):
    rows = _purchases()
    items = basket_items(spark.createDataFrame(rows, "b INT, i STRING, a INT"), "b", "i", "a")
    pairs = _brute_force(rows)
    support = sorted(v[0] for v in pairs.values())[len(pairs) // 2]
    expected = {k: v for k, v in pairs.items() if v[0] >= support}
    assert 0 < len(expected) < len(pairs)
    assert _as_dict(frequent_pairs(items, support)) == expected


def test_lift_and_confidence(spark):
    rows = [(b, i, 10) for b, items in enumerate(["ab", "ab", "a", "b", "c", "c"]) for i in items]
    df = spark.createDataFrame(rows, "b INT, i STRING, a INT")
    got = affinity(df, "b", "i", "a", min_support=2).collect()
    assert len(got) == 1
    r = got[0]
    assert (r["item_a"], r["item_b"], r["baskets_with_both"]) == ("a", "b", 2)
    assert (r["confidence_a_to_b"], r["confidence_b_to_a"], r["lift"]) == (0.667, 0.667, 1.33)
    assert (r["strength"], r["penetration_pct"], r["avg_combined_spend"]) == ("Moderate Affinity", 33.33, 20.0)


def test_tasks_go_by_the_number_of_rows(spark, monkeypatch):
    """With room for 50 rows in a task, items and pairs are made by many tasks, whatever the session's partitions."""
    from tillsight.operators import basket

    monkeypatch.setattr(basket, "TASK_ROWS", 50)
    df = spark.createDataFrame(_purchases(), "basket INT, item STRING, amount INT")
    items = basket_items(df, "basket", "item", "amount")
    assert items.rdd.getNumPartitions() >= df.count() // 50 > int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert _as_dict(pairs_of(items)) == _brute_force(_purchases())


_WHOLE_QUERY = """
import sys
from pyspark.sql import SparkSession
from __spark_entry__ import queries
from tillsight.operators import basket
from tillsight.sources import retail

folder, name = sys.argv[1:]
conf = {
    "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.sql.shuffle.partitions": "2",
    "spark.checkpoint.dir": folder + "/shared", "spark.eventLog.enabled": "true", "spark.eventLog.dir": folder,
    "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false",
}
basket.TASK_ROWS = retail.TASK_LINES = 500
spark = SparkSession.builder.master("local[2]").config(map=conf).getOrCreate()
queries()[name](spark, "/root/testdata/sf0.001").write.format("noop").mode("overwrite").save()
assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
assert spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
spark.stop()
"""


def test_no_task_of_the_whole_query_reads_rows_that_grow_with_the_tables(tmp_path):
    """6,000 lines, room for 500 in a task, 2 partitions in the session: neither joins nor baskets go by the latter."""
    root = Path(__file__).parent.parent
    subprocess.run([sys.executable, "-c", _WHOLE_QUERY, str(tmp_path), "basket_affinity"], cwd=root, check=True, timeout=600)
    (log,) = tmp_path.glob("local-*")
    ends = [e for e in map(json.loads, log.open()) if e["Event"] == "SparkListenerTaskEnd"]
    read = [e["Task Metrics"]["Shuffle Read Metrics"]["Total Records Read"] for e in ends]
    assert 500 <= max(read) <= 2_000


def test_items_in_more_baskets_than_a_task_has_room_for(spark, monkeypatch):
    from tillsight.operators import basket

    df = spark.createDataFrame(_purchases(), "b INT, i STRING, a INT")
    expected = sorted(map(tuple, affinity(df, "b", "i", "a").collect()))
    monkeypatch.setattr(basket, "TASK_ROWS", 7)
    assert sorted(map(tuple, affinity(df, "b", "i", "a").collect())) == expected != []
    monkeypatch.setattr(basket, "TASK_ROWS", 500_000)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(map(tuple, affinity(df, "b", "i", "a").collect())) == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
