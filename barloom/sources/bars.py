"""Reading, normalising and writing bars."""

from __future__ import annotations

import datetime as dt
from typing import Protocol

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.operators.store import Store
from barloom.schemas import ACTIONS, BARS, FIELDS

# Vendor names of columns that have another name here.
ALIASES = {"adjclose": "adj_close", "stock_splits": "splits"}


class BarSource(Protocol):
    """A place that bars are read from: rows of the bars schema, with ``error`` set where a ticker's fetch failed."""

    def read(self, spark: SparkSession, tickers: DataFrame, start: dt.date, end: dt.date) -> DataFrame: ...


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], BARS)


def normalise(frame: DataFrame) -> DataFrame:
    """A vendor frame in the bars schema: names folded and aliased, NaN as null, dates without zone, absent prices null, absent actions zero."""
    names = {}
    for c in frame.columns:
        n = c.strip().lower().replace(" ", "_")
        names.setdefault(ALIASES.get(n, n), c)
    day = names.get("date", names.get("datetime"))
    out = [F.col(names["ticker"]).cast("string").alias("ticker"), F.to_date(F.col(day)).alias("date")]
    for c in FIELDS:
        default = F.lit(0.0) if c in ACTIONS else F.lit(None).cast("double")
        value = F.col(names[c]).cast("double") if c in names else default
        value = F.nanvl(value, F.lit(None).cast("double"))
        out.append((F.coalesce(value, F.lit(0.0)) if c in ACTIONS else value).alias(c))
    return frame.select(*out, *(F.col(names[c]) for c in ("board", "seq") if c in names))


class FileSource:
    """Bars from files: Parquet, ORC, CSV or JSON with a stated schema; the date range reaches the scan."""

    def __init__(self, path: str, fmt: str = "parquet") -> None:
        self.path, self.fmt = path, fmt

    def read(self, spark: SparkSession, tickers: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
        reader = spark.read.schema(BARS).format(self.fmt)
        rows = (reader.option("header", True) if self.fmt == "csv" else reader).load(self.path)
        rows = rows.where(F.col("date").between(start, end)).join(tickers.select("ticker").distinct(), "ticker", "left_semi")
        return rows.withColumn("error", F.lit(None).cast("string"))


def columnar_json(bars: DataFrame, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """ticker, doc: one JSON object of arrays a ticker, ``date`` first, null for missing, volume as integer.

    One row holds a ticker's history: a date a day, so some ten thousand values at most a column. Repeated dates raise.
    """
    fields = tuple(f for f in fields if f in bars.columns and f != "date")
    row = F.struct("date", *fields)
    before = F.lag("date").over(Window.partitionBy("ticker").orderBy("date"))
    once = bars.withColumn("date", F.when(F.col("date") == before, F.raise_error(F.lit("a ticker repeats a date")).cast("date")).otherwise(F.col("date")))
    grouped = once.groupBy("ticker").agg(F.array_sort(F.collect_list(row)).alias("r"))
    columns = [F.transform("r", lambda x: F.date_format(x["date"], "yyyy-MM-dd")).alias("date")]

    def column(f: str) -> Column:
        return F.transform("r", lambda x: F.rint(x[f]).cast("bigint") if f == "volume" else x[f]).alias(f)

    columns += [column(f) for f in fields]
    return grouped.select("ticker", F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}).alias("doc"))


def write_report(df: DataFrame, path: str) -> None:
    """One JSON object a row, nulls written, dates as text; replaces a report at the path."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


class StoreSource:
    """Bars that a store holds, as a source of another run."""

    def __init__(self, path: str) -> None:
        self.path = path

    def read(self, spark: SparkSession, tickers: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
        rows = Store(spark, self.path).bars(range(start.year, end.year + 1)).where(F.col("date").between(start, end))
        return rows.drop("year").join(tickers.select("ticker").distinct(), "ticker", "left_semi").withColumn("error", F.lit(None).cast("string"))
