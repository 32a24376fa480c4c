from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from saleslane.plans.pipeline import publish_run
from saleslane.sources.published import PublishedPanel

SCHEMA = "date date, category string, sales double"


def frame(spark, *rows):
    return spark.createDataFrame(rows, "d string, category string, sales double").select(
        F.to_date("d").alias("date"), "category", "sales"
    )


def shown(panel):
    rows = panel.read().select("date", "category", "sales").collect()
    return sorted(((str(r[0]), r[1], r[2]) for r in rows), key=repr)


@pytest.fixture
def panel(spark, tmp_path):
    panel = PublishedPanel(spark, str(tmp_path / "panel"), ("date", "category"))
    panel.publish(frame(spark, ("2020-01-01", "01", 1.0), ("2020-01-01", "B", 2.0), ("2020-01-02", None, 3.0), ("2020-01-02", None, 3.0)))
    return panel


def test_new_rows_replace_only_their_partitions(spark, panel):
    panel.publish(frame(spark, ("2020-01-02", None, 9.0), ("2020-01-03", "01", 4.0)))
    want = [("2020-01-01", "01", 1.0), ("2020-01-01", "B", 2.0), ("2020-01-02", None, 9.0), ("2020-01-03", "01", 4.0)]
    assert shown(panel) == sorted(want, key=repr)


def test_a_failed_write_leaves_the_panel(spark, panel):
    before = shown(panel)
    broken = frame(spark, ("2020-01-01", "01", 5.0)).withColumn("sales", F.when(F.col("sales") > 0, F.raise_error(F.lit("x")).cast("double")))
    with pytest.raises(Exception, match="x"):
        panel.publish(broken)
    assert shown(panel) == before
    # What the failed write left is removed; the panel is not.
    panel.vacuum()
    assert panel.vacuum() == 0 and shown(panel) == before


def test_a_panel_can_be_updated_from_itself(spark, panel):
    panel.publish(panel.read().withColumn("sales", F.col("sales") + 1))
    assert [r[2] for r in shown(panel)] == [2.0, 3.0, 4.0, 4.0]
    assert panel.vacuum() == 1 and len(shown(panel)) == 4


def test_whole_replacement_and_empty_frames(spark, panel):
    nothing = spark.createDataFrame([], SCHEMA)
    before = shown(panel)
    panel.publish(nothing)
    assert shown(panel) == before
    panel.publish(frame(spark, ("2020-02-01", "C", 7.0)), whole=True)
    assert shown(panel) == [("2020-02-01", "C", 7.0)]
    panel.publish(nothing, whole=True)
    assert shown(panel) == [] and panel.read().schema["date"].dataType.simpleString() == "date"


def test_columns_are_those_of_the_newest_publication(spark, panel):
    panel.publish(frame(spark, ("2020-01-03", "B", 4.0)).withColumn("promo", F.lit(1)))
    rows = {(str(r["date"]), r["category"]): r["promo"] for r in panel.read().collect()}
    assert rows == {("2020-01-01", "01"): None, ("2020-01-01", "B"): None, ("2020-01-02", None): None, ("2020-01-03", "B"): 1}


def test_misuse_is_an_error(spark, panel, tmp_path):
    with pytest.raises(ValueError, match="partition columns"):
        PublishedPanel(spark, panel.path, ())
    with pytest.raises(ValueError, match="partitioned by"):
        PublishedPanel(spark, panel.path, ("category",)).read()
    with pytest.raises(ValueError, match="own"):
        panel.publish(spark.createDataFrame([], f"{SCHEMA}, panel_run string"))
    empty = PublishedPanel(spark, str(tmp_path / "none"), ("date",))
    with pytest.raises(ValueError, match="nothing"):
        empty.read()
    empty.publish(spark.createDataFrame([], SCHEMA))
    with pytest.raises(ValueError, match="nothing"):
        empty.read()


def test_a_writer_with_the_same_number_loses_nothing(spark, panel):
    other = PublishedPanel(spark, panel.path, panel.keys)
    log = other._log()
    other._log = lambda: log.filter("number < 1")  # it looked before the first publication
    other.publish(frame(spark, ("2020-01-05", "B", 6.0)))
    assert len(shown(panel)) == 5


def test_filters_on_partitions_reach_the_scan(spark, panel):
    plan = panel.read().filter("category = 'B'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(category" in plan


def test_a_later_run_replaces_only_its_days(spark, tmp_path):
    rows = frame(spark, ("2020-01-01", "B", 1.0), ("2020-01-02", "B", 2.0))
    later = rows.filter("sales > 1").withColumn("sales", F.lit(9.0))
    for df in (rows, later):
        publish_run(SimpleNamespace(panel=df, features=df, forecast=df), str(tmp_path / "out"))
    for name in ("category_day", "features", "forecast"):
        got = PublishedPanel(spark, str(tmp_path / "out" / name), ("date",))
        assert shown(got) == [("2020-01-01", "B", 1.0), ("2020-01-02", "B", 9.0)]
