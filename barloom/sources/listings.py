"""Listings from screen payloads and simulated screens."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.config import CAP_CEILING
from barloom.functions.codes import board, instrument, is_equity

QUOTE = "array<struct<symbol:string,longName:string,shortName:string,marketCap:double>>"
PAYLOAD = f"quotes {QUOTE}, records {QUOTE}, result {QUOTE}, finance struct<result:array<struct<quotes:{QUOTE}>>>, total bigint, count bigint"


def in_band(cap: Column, low: float | None, high: float | None) -> Column:
    """Market cap between the bounds, both included; a null cap is in no band."""
    return cap.between(F.lit(0.0 if low is None else low), F.lit(CAP_CEILING if high is None else high))


def quotes(payloads: DataFrame, column: str = "payload") -> DataFrame:
    """symbol, longName, shortName, marketCap of every quote in JSON payloads of any known shape."""
    p = F.from_json(column, PAYLOAD)
    found = F.coalesce(p["quotes"], p["records"], p["result"], F.try_element_at(p["finance"]["result"], F.lit(1))["quotes"])
    return payloads.select(F.inline(found))


def reported_total(column: str = "payload") -> Column:
    p = F.from_json(column, PAYLOAD)
    return F.coalesce(p["total"], p["count"])


def normalise_quotes(rows: DataFrame) -> DataFrame:
    """ticker, code, name, market_cap, instrument, board, is_equity: symbols of six digits only, one canonical suffix; others fall."""
    code = F.regexp_extract(F.trim("symbol"), r"(?i)^(\d{6})\.(SS|SH)$", 1)
    name = F.coalesce(F.nullif(F.col("longName"), F.lit("")), F.col("shortName"))
    out = rows.select(code.alias("code"), name.alias("name"), F.col("marketCap").alias("market_cap")).where("code <> ''")
    return out.select(F.concat("code", F.lit(".SS")).alias("ticker"), "code", "name", "market_cap", instrument(F.col("code")).alias("instrument"), board(F.col("code")).alias("board"), is_equity(F.col("code")).alias("is_equity"))
