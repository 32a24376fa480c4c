"""Small frames and readers shared by the tests."""

from __future__ import annotations

import datetime as dt

import pandas as pd

START = dt.date(2021, 1, 1)


def day(i: int, start: dt.date = START) -> dt.date:
    return start + dt.timedelta(days=i)


def sku_rows(sku, rates, sales=None, category="A", promo=None, price=None):
    """SKU-day tuples; the values default to numbers that differ from row to row."""
    n = len(rates)
    sales = sales or [10.0 + 3 * i for i in range(n)]
    promo = promo or [0] * n
    price = price or [2.0 + i / 8 for i in range(n)]
    return [
        (day(i), sku, category, sales[i], rates[i], promo[i], price[i]) for i in range(n)
    ]


SKU_SCHEMA = (
    "date date, sku_id string, category string, sales double, instock_rate double, "
    "high_impact_promo int, final_sku_price double"
)


def series(spark, values, category="A", col="sales", start=START):
    rows = [(category, day(i, start), None if v is None else float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, f"category string, date date, {col} double")


def ordered(df, *by):
    pdf = df.toPandas()
    return pdf.sort_values(list(by or ("category", "date"))).reset_index(drop=True)


def same(a, b, tol=1e-9):
    """Equal numbers, with missing ones in the same places."""
    a, b = pd.Series(list(a), dtype=float), pd.Series(list(b), dtype=float)
    assert (a.isna() == b.isna()).all(), (a.tolist(), b.tolist())
    assert ((a - b).abs().dropna() <= tol * (1 + b.abs().dropna())).all(), (a.tolist(), b.tolist())
