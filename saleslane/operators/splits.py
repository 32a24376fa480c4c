"""Chronological splits, expanding folds and row sets by date.

Ranks are taken over the distinct dates only.  Their number is bounded by the calendar, not by
the rows, which is what makes a single ordered window and a broadcast of the result safe.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslane.functions.exprs import series_window, up_to_now, whole


def date_ranks(df: DataFrame) -> DataFrame:
    """Distinct dates with their 0-based ``date_rank`` and the count ``n_dates``.

    Where the rows are the end of a long plan, rank the dates of its source instead: that is
    one narrow scan, while ranking the rows themselves would run the plan once more.
    """
    dates = df.select("date").dropna().distinct()
    order = Window.orderBy("date")
    return dates.select(
        "date",
        (F.row_number().over(order) - 1).alias("date_rank"),
        F.count("date").over(whole(order)).cast("int").alias("n_dates"),
    )


def _split_of(
    rank: Column, n: Column, train: int | None, val: int, test: int, anchor: str
) -> Column:
    if anchor == "end":
        test_from = n - test
        val_from = test_from - val
        train_from = F.lit(0) if train is None else val_from - train
    else:
        if train is None:
            raise ValueError("anchor='start' needs a number of training dates")
        train_from, val_from = F.lit(0), F.lit(train)
        test_from = val_from + val
    needed = (train or 1) + val + test
    label = (
        F.when((rank >= train_from) & (rank < val_from), "train")
        .when((rank >= val_from) & (rank < test_from), "val")
        .when((rank >= test_from) & (rank < test_from + test), "test")
    )
    message = F.concat(
        F.lit(f"not enough dates: need {needed}, have "), n.cast("string")
    )
    return F.when(n < needed, F.raise_error(message).cast("string")).otherwise(label)


def split_table(
    df: DataFrame, train: int | None = 1000, val: int = 30, test: int = 30, anchor: str = "start"
) -> DataFrame:
    """One row ``(date, split)`` per date that belongs to a split."""
    ranks = date_ranks(df)
    split = _split_of(F.col("date_rank"), F.col("n_dates"), train, val, test, anchor)
    return ranks.select("date", split.alias("split")).where("split is not null")


def date_split(
    df: DataFrame,
    train: int | None = 1000,
    val: int = 30,
    test: int = 30,
    anchor: str = "start",
    dates: DataFrame | None = None,
) -> DataFrame:
    """Add ``split`` and drop the rows of dates outside every split.

    ``dates`` is a cheaper frame with the same dates, such as the source of the rows.
    """
    table = split_table(df if dates is None else dates, train, val, test, anchor)
    return df.join(F.broadcast(table), "date")


def fold_table(
    df: DataFrame, folds: int = 3, min_train: int = 500, val: int = 30, anchor: str = "start"
) -> DataFrame:
    """One row ``(date, fold, role)`` per date and fold of the expanding windows.

    Fold ``i`` trains on the first ``min_train + i * val`` dates and validates on the next
    ``val``; folds that would run past the last date are left out.  ``anchor='end'`` shifts
    all folds so that the last one ends on the last date.
    """
    rank, n, fold = F.col("date_rank"), F.col("n_dates"), F.col("fold")
    shift = F.lit(0) if anchor == "start" else n - (min_train + folds * val)
    val_from = F.lit(min_train) + shift + fold * val
    role = F.when(rank < val_from, "train").when(rank < val_from + val, "val")
    return (
        date_ranks(df)
        .withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(folds - 1))))
        .where((val_from >= min_train) & (val_from + val <= n))
        .select("date", "fold", role.alias("role"))
        .where("role is not null")
    )


def expanding_folds(
    df: DataFrame,
    folds: int = 3,
    min_train: int = 500,
    val: int = 30,
    anchor: str = "start",
    dates: DataFrame | None = None,
) -> DataFrame:
    """The panel in long form, one copy of a row per fold it takes part in."""
    table = fold_table(df if dates is None else dates, folds, min_train, val, anchor)
    return df.join(F.broadcast(table), "date")


def semi_join_dates(df: DataFrame, dates: DataFrame) -> DataFrame:
    """Rows whose date occurs in ``dates``."""
    return df.join(dates.select("date").distinct(), "date", "left_semi")


def union_splits(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The rows of several splits together."""
    return df.where(F.col("split").isin(*names))


def fill_missing(
    df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ("category",), order: str = "date"
) -> DataFrame:
    """Carry the last value forward, then the first value back, then use 0, per series.

    Only the rows before a series' first value are still empty after the forward pass, and
    all of them take that first value, so no frame has to look ahead row by row.
    """
    w = series_window(keys, order)

    def filled(c: str) -> Column:
        return F.coalesce(
            F.last(c, ignorenulls=True).over(up_to_now(w)),
            F.first(c, ignorenulls=True).over(whole(w)),
            F.lit(0),
        ).cast(df.schema[c].dataType)

    return df.withColumns({c: filled(c) for c in cols})


def tail_per_series(df: DataFrame, n: int, keys: Sequence[str] = ("category",)) -> DataFrame:
    """The last ``n`` rows of each series; the limit prunes rows before the shuffle."""
    newest_first = series_window(keys, descending=True)
    return (
        df.withColumn("_rank", F.row_number().over(newest_first))
        .where(F.col("_rank") <= n)
        .drop("_rank")
    )


def last_state(
    df: DataFrame,
    cols: Sequence[str],
    keys: Sequence[str] = ("category",),
    extra: dict[str, Column] | None = None,
) -> DataFrame:
    """Each series' last date and its values there, with the number of rows.

    ``extra`` aggregates are taken in the same pass.
    """
    extra = extra or {}
    present = [c for c in cols if c in df.columns]
    newest = F.max_by(F.struct("date", *present), "date")
    return (
        df.groupBy(*keys)
        .agg(
            newest.alias("_s"),
            F.count(F.lit(1)).alias("n_rows"),
            *(x.alias(n) for n, x in extra.items()),
        )
        .select(
            *keys,
            "n_rows",
            F.col("_s.date").alias("last_date"),
            *(F.col(f"_s.{c}").alias(f"last_{c}") for c in present),
            *extra,
        )
    )
