"""Trading calendars inferred from bars, and what is missing against them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def spans(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(F.min("date").alias("first"), F.max("date").alias("last"))


def live_counts(bars: DataFrame) -> DataFrame:
    """date, prints, live: a sweep over span ends instead of a join of dates and spans.

    The running sum has no partition key, but runs over one row a distinct date.
    """
    s = spans(bars)
    ends = s.select(F.col("first").alias("date"), F.lit(1).alias("d")).unionByName(s.select(F.date_add("last", 1).alias("date"), F.lit(-1).alias("d")))
    steps = ends.groupBy("date").agg(F.sum("d").alias("d"), F.lit(0).cast("bigint").alias("prints"))
    seen = bars.where(F.col("date").isNotNull()).groupBy("date").agg(F.lit(0).cast("bigint").alias("d"), F.count("*").alias("prints"))
    days = steps.unionByName(seen).groupBy("date").agg(F.sum("d").alias("d"), F.sum("prints").alias("prints"))
    run = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    return days.select("date", "prints", F.sum("d").over(run).alias("live"))


def infer_sessions(bars: DataFrame, quorum: float = 0.5) -> DataFrame:
    """date, prints, live of the dates on which at least the quorum of live tickers printed."""
    return live_counts(bars).where((F.col("prints") > 0) & (F.col("prints") >= F.lit(quorum) * F.col("live")))


def missing_sessions(bars: DataFrame, sessions: DataFrame, within_coverage_only: bool = True) -> DataFrame:
    """ticker, date of sessions without a bar; by default between a ticker's first and last bar.

    A ticker's own sessions are a run of the calendar's day numbers, so they are
    generated by a sequence and the join on dates is an equality.
    """
    calendar = sessions.select("date").distinct()
    if within_coverage_only:
        live = spans(bars)
    else:
        first, last = calendar.select(F.min("date"), F.max("date")).first()
        live = bars.select("ticker", F.lit(first).cast("date").alias("first"), F.lit(last).cast("date").alias("last")).distinct().where("first IS NOT NULL")
    expected = live.select("ticker", F.explode(F.sequence("first", "last")).alias("date")).join(calendar, "date", "left_semi")
    return expected.join(bars.select("ticker", "date"), ["ticker", "date"], "left_anti").select("ticker", "date")


def suspensions(bars: DataFrame, sessions: DataFrame, k: int = 20) -> DataFrame:
    """The k tickers with most missing sessions, ties by ticker."""
    return missing_sessions(bars, sessions).groupBy("ticker").agg(F.count("*").alias("missing")).orderBy(F.desc("missing"), "ticker").limit(k)


def calendar_sanity(sessions: DataFrame) -> DataFrame:
    """date, issue: sessions on weekends and on fixed holidays (1 January, 1 May, 1 to 7 October)."""
    weekend = F.when(F.weekday("date") >= 5, "weekend")
    month, day = F.month("date"), F.dayofmonth("date")
    holiday = F.when(((month == 1) & (day == 1)) | ((month == 5) & (day == 1)) | ((month == 10) & (day <= 7)), "holiday")
    return sessions.select("date", F.explode(F.array_compact(F.array(weekend, holiday))).alias("issue"))


def weekdays_between(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """Mondays to Fridays, both ends included."""
    if start > end:
        return spark.createDataFrame([], "date date")
    days = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(end))).alias("date"))
    return days.where(F.weekday("date") < 5)


def sessions_between(sessions: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    return sessions.where(F.col("date").between(start, end))


def year_bounds(spark: SparkSession, year: int) -> DataFrame:
    return spark.range(1).select(F.make_date(F.lit(year), F.lit(1), F.lit(1)).alias("first"), F.make_date(F.lit(year), F.lit(12), F.lit(31)).alias("last"))
