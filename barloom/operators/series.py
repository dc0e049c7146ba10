"""Selecting, splitting and summarising bar series."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.codec import chunk_id
from barloom.schemas import FIELDS


def slice_dates(bars: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Both bounds included, None open; where bars have a year partition, it is pruned too."""
    for bound, keep in ((start, lambda c, v: c >= v), (end, lambda c, v: c <= v)):
        if bound is not None:
            bars = bars.where(keep(F.col("date"), F.lit(bound)))
            if "year" in bars.columns:
                bars = bars.where(keep(F.col("year"), F.lit(bound.year)))
    return bars


def project(bars: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Key columns and the fields asked for; none means all, unknown names are ignored."""
    wanted = [c for c in FIELDS if c in bars.columns and (not fields or c in fields)]
    return bars.select("ticker", "date", *wanted)


def get_series(bars: DataFrame, ticker: str, start: dt.date | None = None, end: dt.date | None = None, fields: list[str] | None = None) -> DataFrame:
    return project(slice_dates(bars.where(F.col("ticker") == ticker), start, end), fields).orderBy("date")


def get_many(bars: DataFrame, requested: DataFrame, start: dt.date | None = None, end: dt.date | None = None, fields: list[str] | None = None) -> DataFrame:
    """Rows of every requested ticker; one without bars keeps a row of nulls."""
    return requested.select("ticker").distinct().join(project(slice_dates(bars, start, end), fields), "ticker", "left")


def get_chunk(bars: DataFrame, ticker: str, year: int) -> DataFrame:
    return bars.where((F.col("ticker") == ticker) & (F.year("date") == year))


def concat(*series: DataFrame) -> DataFrame:
    """Union over the columns that all have; nothing is deduplicated."""
    common = [c for c in series[0].columns if all(c in s.columns for s in series)]
    out = series[0].select(*common)
    for s in series[1:]:
        out = out.unionByName(s.select(*common))
    return out


def chunk_meta(bars: DataFrame) -> DataFrame:
    """ticker, year, n, first, last, chunk_id."""
    grouped = bars.groupBy("ticker", F.year("date").alias("year"))
    out = grouped.agg(F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))
    return out.withColumn("chunk_id", chunk_id(F.col("ticker"), F.col("year")))


def coverage(bars: DataFrame, tickers: list[str] | None = None) -> DataFrame:
    """ticker, first, last, bars, n_years; no list, or an empty one, means all."""
    rows = bars.where(F.col("ticker").isin(*tickers)) if tickers else bars
    rows = rows.groupBy("ticker", F.year("date").alias("year")).agg(F.min("date").alias("a"), F.max("date").alias("b"), F.count("*").alias("n"))
    return rows.groupBy("ticker").agg(F.min("a").alias("first"), F.max("b").alias("last"), F.sum("n").alias("bars"), F.count("*").alias("n_years"))


def watermarks(bars: DataFrame) -> DataFrame:
    return bars.groupBy("ticker").agg(F.max("date").alias("watermark"))


def bar_count(bars: DataFrame) -> DataFrame:
    return bars.agg(F.count("*").alias("n"))


def tickers(bars: DataFrame) -> DataFrame:
    return bars.select("ticker").distinct()


def sample_tickers(bars: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """A seeded sample: the n tickers with the least digests of seed and ticker."""
    return tickers(bars).orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col("ticker"))), "ticker").limit(n)


def head_tickers(tickers: DataFrame, n: int | None) -> DataFrame:
    """The first n tickers by name; None means all."""
    out = tickers.select("ticker").distinct().orderBy("ticker")
    return out if n is None else out.limit(n)


def iter_chunks(bars: DataFrame, ticker: str | None = None) -> DataFrame:
    """All bars, or a ticker's, in order of ticker, year and date."""
    rows = bars if ticker is None else bars.where(F.col("ticker") == ticker)
    return rows.withColumn("year", F.year("date")).orderBy("ticker", "year", "date")
