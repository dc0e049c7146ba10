"""Run events and discovery snapshots, append-only; current state is derived."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom.schemas import RUN_EVENTS, SNAPSHOTS

MOST_ERRORS = 200


def event(spark: SparkSession, run_id: str, name: str, at: dt.datetime, kind: str | None = None, status: str | None = None, counters: dict[str, int] | None = None, errors: list[str] | None = None, note: str | None = None) -> DataFrame:
    """One row to append: start, heartbeat or finish of a run."""
    return spark.createDataFrame([(run_id, name, at, kind, status, counters, errors, note)], RUN_EVENTS)


def current(events: DataFrame) -> DataFrame:
    """id, kind, status, started_at, heartbeat_at, finished_at, counters, error_count, errors (at most 200 are shown)."""
    def last(c: str) -> F.Column:
        return F.max_by(c, F.when(F.col(c).isNotNull(), F.col("at"))).alias(c)

    out = events.groupBy("id").agg(
        last("kind"),
        last("status"),
        F.min(F.when(F.col("event") == "start", F.col("at"))).alias("started_at"),
        F.max(F.when(F.col("event") == "heartbeat", F.col("at"))).alias("heartbeat_at"),
        F.max(F.when(F.col("event") == "finish", F.col("at"))).alias("finished_at"),
        last("counters"),
        last("errors"),
        last("note"),
    )
    return out.withColumns({"error_count": F.coalesce(F.size("errors"), F.lit(0)), "errors": F.slice("errors", 1, MOST_ERRORS)})


def latest(runs: DataFrame, kind: str) -> DataFrame:
    return runs.where(F.col("kind") == kind).orderBy(F.desc("started_at"), "id").limit(1)


def recent(runs: DataFrame, limit: int = 10) -> DataFrame:
    return runs.drop("errors").orderBy(F.desc("started_at"), "id").limit(limit)


def active(runs: DataFrame, since: dt.datetime | dt.date) -> DataFrame:
    """Running and heard of since the cutoff, newest first."""
    return runs.where((F.col("status") == "running") & (F.coalesce("heartbeat_at", "started_at") >= F.lit(since))).orderBy(F.desc("started_at"), "id")


def snapshot(symbols: DataFrame, run_id: str, source: str, at: dt.datetime, details: str = "{}") -> DataFrame:
    """One row to append with the sorted symbols of a discovery: a universe of thousands."""
    row = symbols.agg(F.sort_array(F.collect_set("ticker")).alias("symbols"))
    return row.select(F.lit(run_id).alias("run_id"), F.lit(source).alias("source"), F.lit(at).cast("timestamp_ntz").alias("taken_at"), F.size("symbols").alias("n_symbols"), "symbols", F.lit(details).alias("details"))


def snapshot_union(snapshots: DataFrame) -> DataFrame:
    return snapshots.select(F.explode("symbols").alias("symbol")).distinct()


def latest_snapshot(snapshots: DataFrame, source: str | None = None) -> DataFrame:
    rows = snapshots if source is None else snapshots.where(F.col("source") == source)
    return rows.orderBy(F.desc("taken_at"), "run_id").limit(1)


def latest_by_source(rows: DataFrame) -> DataFrame:
    """The newest snapshot rows of each source (long form: one row a symbol)."""
    w = Window.partitionBy("source").orderBy(F.desc("taken_at"))
    return rows.withColumn("__r", F.rank().over(w)).where("__r = 1").drop("__r")


def history(snapshots: DataFrame, limit: int = 20) -> DataFrame:
    return snapshots.drop("symbols").orderBy(F.desc("taken_at"), "run_id").limit(limit)


__all__ = ["SNAPSHOTS", "active", "current", "event", "history", "latest", "latest_by_source", "latest_snapshot", "recent", "snapshot", "snapshot_union"]
