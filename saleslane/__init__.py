"""Daily sales panels on Spark: cleaning, features, hybrid forecasts and their scores.

Every operator takes DataFrames and returns DataFrames.  A *panel* has one row per
``(series keys, date)`` with ``date`` of day grain, so the length of a series is bounded
by the calendar (36,525 rows per century) however many series or source rows there are.
"""
