import pytest

from saleslane.plans.durable import checkpoint_dir, durable
from saleslane.sources import panels
from tests.helpers import SKU_SCHEMA, ordered, series, sku_rows


def test_panels_round_trip_through_csv_and_parquet(spark, tmp_path):
    df = spark.createDataFrame(sku_rows("a", [90.0, 50.0, None]), SKU_SCHEMA)
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        panels.write_panel(df, path, fmt, partition_by=["category"] if fmt == "parquet" else ())
        got = panels.read_sku_day(spark, path, fmt)
        assert got.schema.simpleString() == df.schema.simpleString()
        assert ordered(got, "date").equals(ordered(df, "date"))


def test_nan_and_timestamps_are_normalised_at_the_entrance(spark, tmp_path):
    raw = spark.sql(
        "select timestamp'2020-01-02 00:00:00' as date, 'A' as category, double('NaN') as avg_temperature,"
        " 1.0D as avg_rainfall, 0.0D as avg_snowfall, 3L as holiday_flag"
    )
    raw.write.parquet(str(tmp_path / "x"))
    row = panels.read_exog(spark, str(tmp_path / "x")).first()
    assert row["avg_temperature"] is None and str(row["date"]) == "2020-01-02"


def test_params_round_trip(spark, tmp_path):
    params = {"rounds": 50.0, "learning_rate": 0.1}
    panels.save_params(spark, params, str(tmp_path / "p"))
    assert panels.load_params(spark, str(tmp_path / "p")) == params
    assert panels.load_params(spark, str(tmp_path / "absent")) is None


def test_damaged_csv_is_an_error(spark, tmp_path):
    head = "date,sku_id,category,sales,instock_rate,high_impact_promo,final_sku_price"
    (tmp_path / "x.csv").write_text(f"{head}\n2020-01-02,a,A,oops,1.0,0,2.0\n")
    with pytest.raises(Exception, match="oops|MALFORMED"):
        panels.read_sku_day(spark, str(tmp_path / "x.csv"), "csv").collect()


class _Context:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class _Session:
    """Stands in for a session, whose checkpoint folder cannot change once it runs."""

    def __init__(self, master, named=None):
        self.sparkContext, self.conf = _Context(master), {"spark.checkpoint.dir": named}


def test_checkpoint_folder_is_the_named_one_or_local_only():
    assert checkpoint_dir(_Session("yarn", "hdfs:/shared")) == "hdfs:/shared"
    local = _Session("local[2]")
    assert checkpoint_dir(local) == checkpoint_dir(local) == local.sparkContext.folder
    with pytest.raises(ValueError, match="shared by all executors"):
        checkpoint_dir(_Session("yarn"))


def test_durable_tables_read_back(spark):
    assert durable(series(spark, range(3))).count() == 3


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    df = spark.createDataFrame(sku_rows("a", [90.0]), SKU_SCHEMA)
    df.write.parquet(str(tmp_path / "p"))
    read = panels.read_sku_day(spark, str(tmp_path / "p")).where("category = 'A'").select("sales")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(category), EqualTo(category,A)]" in plan
    assert "ReadSchema: struct<category:string,sales:double>" in plan
