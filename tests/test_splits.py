import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from saleslane.operators import splits
from tests.helpers import day, ordered, same, series


def counts(df, *by):
    return {tuple(r[c] for c in by): r["count"] for r in df.groupBy(*by).count().collect()}


def test_start_and_end_anchors(spark):
    df = series(spark, range(20))
    assert counts(splits.date_split(df, 10, 3, 2), "split") == {("train",): 10, ("val",): 3, ("test",): 2}
    last = splits.date_split(df, None, 3, 2, "end")
    assert counts(last, "split") == {("train",): 15, ("val",): 3, ("test",): 2}
    assert last.where("split = 'test'").agg(F.max("date")).first()[0] == day(19)
    assert splits.union_splits(last, ("train", "val")).count() == 18


def test_too_few_dates_is_an_error(spark):
    with pytest.raises(PySparkException, match="not enough dates: need 30, have 20"):
        splits.date_split(series(spark, range(20)), 10, 10, 10).collect()


def test_expanding_folds(spark):
    df = series(spark, range(20))
    got = counts(splits.expanding_folds(df, 3, 10, 4), "fold", "role")
    # The third fold would need 22 dates.
    assert got == {(0, "train"): 10, (0, "val"): 4, (1, "train"): 14, (1, "val"): 4}
    last = counts(splits.expanding_folds(df, 2, 10, 4, "end"), "fold", "role")
    assert last == {(0, "train"): 12, (0, "val"): 4, (1, "train"): 16, (1, "val"): 4}


def test_fill_missing_stays_inside_a_series(spark):
    a, b = [None, 1, None, 3], [None, None, 5, None]
    df = series(spark, a).unionByName(series(spark, b, "B")).unionByName(series(spark, [None], "C"))
    got = ordered(splits.fill_missing(df, ["sales"]))
    same(got["sales"], [1, 1, 1, 3, 5, 5, 5, 5, 0])


def test_tail_last_state_and_semi_join(spark):
    df = series(spark, range(9)).unionByName(series(spark, range(4), "B"))
    assert splits.tail_per_series(df, 5).count() == 9
    state = {r["category"]: r for r in splits.last_state(df, ["sales", "absent"]).collect()}
    assert state["A"]["last_sales"] == 8.0 and state["B"]["n_rows"] == 4
    dates = spark.createDataFrame([(day(2),), (day(2),), (day(7),)], "date date")
    assert splits.semi_join_dates(df, dates).count() == 3
