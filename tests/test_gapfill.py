import random

import numpy as np
import pandas as pd
import pytest

from saleslane.operators.gapfill import MEASURES, fill_low_stock, fill_report, low_stock_stats
from saleslane.operators.quality import duplicate_keys
from tests.helpers import SKU_SCHEMA, day, ordered, same, sku_rows


def brute_force(rows, threshold, limit):
    """Plain interpolation per SKU, one row at a time."""
    frame = pd.DataFrame(rows, columns=[c.split()[0] for c in SKU_SCHEMA.split(", ")])
    parts = []
    for _, part in frame.sort_values("date").groupby("sku_id"):
        part = part.copy()
        low = part["instock_rate"] < threshold
        if low.any():
            for c in MEASURES:
                gaps = part[c].mask(low)
                part[c] = gaps.interpolate("linear", limit=limit, limit_direction="both").ffill()
            part.loc[part["instock_rate"] < threshold, "instock_rate"] = threshold
        parts.append(part)
    return pd.concat(parts).sort_values(["sku_id", "date"]).reset_index(drop=True)


def run(spark, rows, limit=7, partitions=4, threshold=60.0):
    df = spark.createDataFrame(rows, SKU_SCHEMA).repartition(partitions)
    return ordered(fill_low_stock(df, threshold, limit), "sku_id", "date")


def random_rows(seed):
    rng = random.Random(seed)
    rows = []
    for s in range(25):
        rates = []
        while len(rates) < 70:
            rates += [90.0 - rng.randrange(9)] * rng.randint(1, 5) + [30.0] * rng.randint(0, 24)
        sales = [round(rng.uniform(0, 90), 2) for _ in rates]
        sales = [None if rng.random() < 0.04 else v for v in sales]
        rows += sku_rows(f"S{s:02d}", rates, sales)
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("limit", [1, 2, 7, None])
def test_random_gaps_match_brute_force(spark, limit):
    rows = random_rows(3)
    got, want = run(spark, rows, limit), brute_force(rows, 60.0, limit)
    for c in MEASURES:
        same(got[c], want[c])


def test_layout_does_not_matter(spark):
    rows = random_rows(5)
    pd.testing.assert_frame_equal(run(spark, rows, 7, 1), run(spark, sorted(rows), 7, 8))


@pytest.mark.parametrize("gap", [8, 15, 20])
def test_long_interior_gaps(spark, gap):
    rows = sku_rows("S", [90.0] + [10.0] * gap + [90.0])
    got = run(spark, rows)
    first, last = got["sales"].iloc[0], got["sales"].iloc[-1]
    reached = [i if i <= 7 or gap + 1 - i <= 7 else 7 for i in range(1, gap + 1)]
    same(got["sales"][1:-1], [first + (last - first) * s / (gap + 1) for s in reached])
    kinds = ["interpolated" if i <= 7 or gap + 1 - i <= 7 else "forward_filled"
             for i in range(1, gap + 1)]
    assert got["fill_kind"][1:-1].tolist() == kinds


def test_leading_trailing_and_fully_low(spark):
    rows = sku_rows("lead", [1.0] * 10 + [90.0] * 2) + sku_rows("trail", [90.0] + [1.0] * 10)
    rows += sku_rows("all", [1.0] * 3)
    got = run(spark, rows).set_index("sku_id")
    assert got.loc["lead", "sales"].isna().tolist() == [True] * 3 + [False] * 9
    assert got.loc["lead", "fill_kind"].tolist() == (
        ["unfilled"] * 3 + ["interpolated"] * 7 + ["observed"] * 2
    )
    assert (got.loc["trail", "sales"] == 10.0).all()
    assert got.loc["trail", "fill_kind"].tolist() == (
        ["observed"] + ["interpolated"] * 7 + ["forward_filled"] * 3
    )
    assert got.loc["all", "sales"].isna().all()
    assert got.loc["all", "instock_rate"].isna().all()


def test_series_without_low_rows_keeps_its_missing_values(spark):
    got = run(spark, sku_rows("S", [90.0, 95.0, 60.0], [1.0, None, 3.0]))
    same(got["sales"], [1.0, np.nan, 3.0])
    assert got["fill_kind"].tolist() == ["observed", "unfilled", "observed"]


def test_reports(spark):
    rows = sku_rows("S", [90.0, 10.0, 90.0, None])
    df = spark.createDataFrame(rows, SKU_SCHEMA)
    stats = low_stock_stats(df).first()
    assert (stats["n_rows"], stats["n_low"], stats["pct_low"]) == (4, 1, 25.0)
    counts = {r["fill_kind"]: r["n_rows"] for r in fill_report(fill_low_stock(df)).collect()}
    assert counts == {"observed": 3, "interpolated": 1}


def test_two_rows_on_one_date_are_an_error(spark):
    rows = sku_rows("s", [90.0, 10.0, 90.0], promo=[0] * 3) + sku_rows("s", [80.0])
    with pytest.raises(Exception, match="two rows of series s on 2021-01-01"):
        fill_low_stock(spark.createDataFrame(rows, SKU_SCHEMA)).collect()
    found = duplicate_keys(spark.createDataFrame(rows, SKU_SCHEMA), ["sku_id"]).collect()
    assert [tuple(r) for r in found] == [("s", day(0), 2)]
