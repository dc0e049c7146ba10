"""Whole flows over the operators: bulk load, incremental update, discovery, audit and verification."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.config import Capacity, Horizon
from barloom.functions.codec import verify_chunks
from barloom.operators import calendar, master, quality, runs, series, store
from barloom.operators.store import Store


def fetch_plan(tickers: DataFrame, marks: DataFrame, horizon: Horizon = Horizon(), full: bool = False, today: dt.date | None = None) -> DataFrame:
    """ticker, start, is_new: where each ticker's next fetch begins; those whose start is past are left out."""
    rows = tickers.select("ticker").distinct().join(marks, "ticker", "left")
    first = F.lit(horizon.first_day)
    back = F.greatest(F.date_sub("watermark", horizon.overlap_days), first)
    out = rows.select("ticker", (F.lit(full) | F.col("watermark").isNull()).alias("is_new"), F.when(F.lit(full), first).otherwise(F.coalesce(back, first)).alias("start"))
    return out.where(F.col("start") <= F.lit(today)) if today else out


def fetch_groups(plan: DataFrame) -> DataFrame:
    """start, n, first_ticker: tickers that one request can ask for, since they begin on the same day."""
    return plan.groupBy("start").agg(F.count("*").alias("n"), F.min("ticker").alias("first_ticker"))


def todo(known: DataFrame, bars: DataFrame, run_id: str | None = None, missing: bool = False, limit: int | None = None) -> DataFrame:
    """ticker: active names of a backfill; with a run id those that this run has not finished, with ``missing`` those without bars, and the first ``limit`` of them."""
    rows = master.pending(known, run_id) if run_id else known.where(F.col("status") == master.ACTIVE).select("ticker")
    rows = rows.join(bars.select("ticker").distinct(), "ticker", "left_anti") if missing else rows
    return series.head_tickers(rows, limit)


def over_capacity(held: Store, capacity: Capacity = Capacity()) -> bool:
    """Whether a store is at its halting size."""
    return bool(held.entry()[1]) and bool(store.storage_stats(held.bars(), capacity).first()["over_threshold"])


def bulk_load(raw: DataFrame, held: Store) -> DataFrame:
    """Cleans and stores raw rows by full replacement of their years; returns the census row."""
    held.replace(quality.sanitize(raw))
    return quality.census(raw)


def update(raw: DataFrame, held: Store, horizon: Horizon = Horizon(), full: bool = False) -> DataFrame:
    """Merges cleaned rows from each ticker's overlap on into the store; returns outcome, chunks, bars_submitted."""
    marks = held.manifest().groupBy("ticker").agg(F.max("last").alias("watermark"))
    plan = fetch_plan(raw.select("ticker"), marks, horizon, full)
    clean = quality.sanitize(raw).join(plan, "ticker").where(F.col("date") >= F.col("start")).drop("start", "is_new")
    before = held.manifest().select("ticker", "year", "sha256")
    submitted = clean.groupBy("ticker", F.year("date").alias("year")).agg(F.count("*").alias("bars"))
    held.merge(clean)
    after = held.manifest().select("ticker", "year", F.col("sha256").alias("fresh"))
    case = F.when(F.col("sha256").isNull(), store.INSERTED).when(F.col("sha256") == F.col("fresh"), store.UNCHANGED).otherwise(store.UPDATED)
    out = submitted.join(after, ["ticker", "year"]).join(before, ["ticker", "year"], "left")
    return out.groupBy(case.alias("outcome")).agg(F.count("*").alias("chunks"), F.sum("bars").alias("bars_submitted"))


def integrity_summary(bars: DataFrame) -> DataFrame:
    """One row of global facts: chunks, bars, tickers, first and last date, most bars in a chunk."""
    chunks = series.chunk_meta(bars)
    return chunks.agg(F.count("*").alias("chunks"), F.sum("n").alias("bars"), F.count_distinct("ticker").alias("tickers"), F.min("first").alias("first"), F.max("last").alias("last"), F.max("n").alias("largest_chunk"))


def integrity_by_year(bars: DataFrame) -> DataFrame:
    return series.chunk_meta(bars).groupBy("year").agg(F.count("*").alias("chunks"), F.sum("n").alias("bars"))


def audit(raw: DataFrame, quorum: float = 0.18) -> DataFrame:
    """ticker, first, last, bars, n_years, missing: cleaned coverage beside missing sessions of the inferred calendar."""
    clean = quality.sanitize(raw)
    sessions = calendar.infer_sessions(clean, quorum)
    gone = calendar.missing_sessions(clean, sessions).groupBy("ticker").agg(F.count("*").alias("missing"))
    return series.coverage(clean).join(gone, "ticker", "left").withColumn("missing", F.coalesce("missing", F.lit(0)))


def verify(bars: DataFrame, manifest: DataFrame) -> DataFrame:
    """state, chunks of bars against a manifest; reports and never raises."""
    return verify_chunks(bars, manifest).groupBy("state").agg(F.count("*").alias("chunks"))


def invariant(raw: DataFrame) -> DataFrame:
    """Error checks that survive cleaning: always empty."""
    return quality.quality_report(quality.sanitize(raw)).where("severity = 'error'")


def persist(known: DataFrame, discovered: DataFrame, unknown: DataFrame, source: str, now: dt.datetime, complete: bool) -> DataFrame:
    """The master after a discovery: upserted, and soft-deleted where a complete discovery misses names."""
    gone = master.vanished(known, discovered, unknown, complete)
    return master.mark_inactive(master.upsert(known, discovered, source, now), gone, now)


def persist_snapshot(discovered: DataFrame, run_id: str, source: str, now: dt.datetime, path: str) -> None:
    """Appends what a discovery found to the snapshots at ``path``."""
    runs.snapshot(discovered, run_id, source, now).write.mode("append").parquet(path)
