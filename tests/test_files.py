import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException

from tillsight.sources.files import normalize_columns, read_csv, read_first_available, save, schema_frame
from tillsight.sources.retail import DISPLAY_NAMES, RETAIL_FILE_SCHEMA, from_flat_file, to_display_names


def test_missing_input_is_reported(spark, tmp_path):
    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        read_csv(spark, str(tmp_path / "nowhere"))


def test_unknown_format_is_refused(spark, tmp_path):
    with pytest.raises(ValueError, match="unsupported sink format"):
        save(spark.range(1), str(tmp_path / "x"), "xml")


def test_header_mismatch_is_an_error(spark, tmp_path):
    path = str(tmp_path / "t")
    save(spark.createDataFrame([(1, "x")], "a INT, b STRING"), path, "csv")
    with pytest.raises((PySparkException, Py4JJavaError), match="CSV header does not conform to the schema"):
        read_csv(spark, path, "b STRING, a INT").collect()


def test_fallback_order(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    save(spark.createDataFrame([(1, "x")], "a INT, b STRING"), path, "csv")
    got = read_first_available(spark, [("parquet", str(tmp_path / "gone")), ("csv", path)])
    assert rows(got) == [(1, "x")]
    with pytest.raises(AnalysisException):
        read_first_available(spark, [("parquet", str(tmp_path / "gone"))])


def test_save_replaces_what_was_there(spark, tmp_path):
    path = str(tmp_path / "t")
    save(spark.range(10), path)
    save(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3


def test_flat_file_names_and_types(spark, tmp_path, rows):
    line = (1, 30, "Male", "Belt", "Accessories", 50, "Texas", "M", "Red", "Fall", 4.5, "Yes", "Express", "No", "No", 3, "Cash", "Weekly")
    path = str(tmp_path / "t")
    save(spark.createDataFrame([line], RETAIL_FILE_SCHEMA), path, "csv")
    df = from_flat_file(read_csv(spark, path, RETAIL_FILE_SCHEMA))
    assert df.columns == list(DISPLAY_NAMES) and rows(df) == [line]
    assert to_display_names(df).columns == list(DISPLAY_NAMES.values())
    assert normalize_columns(to_display_names(df)).columns[5] == "purchase_amount_usd"


def test_schema_frame(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a INT, `b c` STRING")
    assert rows(schema_frame(df)) == [(1, "a", "int", 2), (2, "b c", "string", 1)]


def test_intermediate_tables_need_a_shared_folder(spark, monkeypatch):
    """On a cluster the warehouse on a machine's own disk is refused; a set folder is taken as it is."""
    from tillsight.sources import shared

    class Elsewhere:
        def __init__(self, folder):
            self.conf = self
            self.folder = folder
            self.sparkContext = self
            self.master, self.applicationId = "spark://host:7077", "app-1"
            self._jvm, self._jsc = spark.sparkContext._jvm, spark.sparkContext._jsc

        def get(self, name, default=None):
            return {"spark.checkpoint.dir": self.folder, "spark.sql.warehouse.dir": "file:/tmp/warehouse"}[name]

        def getCheckpointDir(self):
            return None

    assert shared.session_folder(Elsewhere("file:/shared/x/")) == "file:/shared/x/tillsight-app-1"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.session_folder(Elsewhere(None))


def test_stored_frames_can_be_dropped(spark):
    import os

    from tillsight.sources.shared import drop_stored, materialize

    stored = materialize(spark.range(5))
    assert stored.count() == 5 and os.path.exists(stored._stored_in)
    drop_stored(stored)
    assert not os.path.exists(stored._stored_in)
