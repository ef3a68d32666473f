"""Rows without an id and ids that repeat: no link, draw or count may be lost or shared."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tillsight.llm import embedding_dedup, mixing, simhash
from tools.check_results import compare, duckdb_on


def _with_fingerprints(monkeypatch, by_text):
    monkeypatch.setattr(
        simhash, "fingerprints", lambda docs: docs.select("doc_id", F.col("text").cast("long").alias("fp"))
    )
    monkeypatch.setattr(simhash, "fingerprint", by_text)


def test_a_null_id_between_two_groups_links_them(spark, monkeypatch):
    _with_fingerprints(monkeypatch, lambda t: int(t))
    rows = [(1, "0"), (None, "7"), (2, "63"), (None, "4294967295"), (None, "4294967294")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    found = {r.fp: r.component for r in simhash.near_duplicates(df).collect()}
    assert found == {0: 1, 7: 1, 63: 1, 4294967295: None, 4294967294: None}
    kept = sorted(((r.doc_id, r.text) for r in simhash.keep_one(df).collect()), key=repr)
    assert kept == [(1, "0"), (None, "4294967294")]


@pytest.mark.parametrize("rows", [
    [(None, f"{'w ' * 9}w", "a")] * 2_000 + [(k, "x y", "b") for k in range(20)] + [(50, "v " * 30_000, "c")],
    [(None, f"{'w ' * 9}{k}", "a") for k in range(2_000)] + [(7, "x y", "b")] * 20 + [(50, "v " * 30_000, "c")],
])
def test_rows_without_ids_come_near_their_target(spark, tmp_path, rows):
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert compare(spark, con, "op9", mixing.op9_mixing, mixing.OP9_SQL, str(tmp_path)) is None
    found = mixing.mix_report(df.repartition(7)).collect()
    of_a = [r for r in found if r["source_size"] == 20_000]
    assert abs(sum(r.taken for r in of_a) / of_a[0].target - 1) < 0.05
    assert all(r.taken <= 2 * r["size"] for r in found)
    again = mixing.mix_report(df.repartition(3)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))
    assert mixing.mix(df).count() == sum(r.taken // r["size"] for r in found)


def test_vec_ids_on_several_rows_keep_their_links_apart(spark, tmp_path):
    axis = np.eye(64, dtype="float32").tolist()
    near = (np.eye(64)[0] + 0.05 * np.eye(64)[1]).astype("float32").tolist()
    rows = [(1, axis[0], 0), (1, axis[5], 1), (2, near, 0), (3, axis[5], 1), (4, axis[9], 1), (4, axis[9], 1), (None, axis[9], 1),
            (6, None, 1), (None, [0.0] * 64, 1), (7, axis[0], None), (8, axis[20], 2), (8, axis[21], 2)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label bigint").coalesce(1)
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert compare(spark, con, "op8", embedding_dedup.op8_embedding_dedup, embedding_dedup.OP8_SQL, str(tmp_path)) is None
    found = {(r.vec_id, r.n_links, r.component_id) for r in embedding_dedup.op8_embedding_dedup(spark, str(tmp_path)).collect()}
    assert {(1, 1, 1), (2, 1, 1), (3, 1, 1), (4, 1, 4), (None, 1, 4), (7, 0, 7), (8, 0, 8), (None, 0, None)} <= found
