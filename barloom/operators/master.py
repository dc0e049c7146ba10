"""The security master: upserts, soft deletion, search and ingest state."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ACTIVE, INACTIVE = "active", "inactive"


def upsert(master: DataFrame, rows: DataFrame, source: str, now: dt.datetime) -> DataFrame:
    """Incoming non-null fields win; matched and new rows become active and seen; first_seen stays; ingest is kept."""
    at = F.lit(now).cast("timestamp_ntz")
    fields = [c for c in rows.columns if c != "ticker"]
    both = master.alias("m").join(rows.withColumn("__in", F.lit(True)).alias("r"), "ticker", "full_outer")
    seen = F.coalesce(F.col("__in"), F.lit(False))

    def pick(c: str) -> Column:
        old = F.col(f"m.{c}") if c in master.columns else F.lit(None)
        if c == "status":
            return F.when(seen, ACTIVE).otherwise(old)
        if c == "last_seen":
            return F.when(seen, at).otherwise(old)
        if c == "last_source":
            return F.when(seen, F.lit(source)).otherwise(old)
        if c == "first_seen":
            return F.coalesce(old, at)
        if c == "inactive_since":
            return F.when(seen, None).otherwise(old)
        return F.coalesce(F.col(f"r.{c}"), old) if c in fields else old

    columns = list(dict.fromkeys([*(c for c in master.columns if c != "ticker"), *fields, "status", "first_seen", "last_seen", "last_source", "inactive_since"]))
    return both.select("ticker", *(pick(c).alias(c) for c in columns))


def upsert_counts(master: DataFrame, rows: DataFrame) -> DataFrame:
    """seen, inserted, modified of an upsert."""
    known = rows.select("ticker").distinct().join(master.select("ticker", F.lit(1).alias("k")), "ticker", "left")
    return known.agg(F.count("*").alias("seen"), F.count_if(F.col("k").isNull()).alias("inserted"), F.count_if(F.col("k").isNotNull()).alias("modified"))


def mark_inactive(master: DataFrame, gone: DataFrame, now: dt.datetime) -> DataFrame:
    """Active tickers among ``gone`` become inactive since now; nothing is removed."""
    rows = master.join(gone.select("ticker").distinct().withColumn("__gone", F.lit(True)), "ticker", "left")
    hit = F.coalesce(F.col("__gone"), F.lit(False)) & (F.coalesce("status", F.lit("")) == ACTIVE)
    since = F.col("inactive_since") if "inactive_since" in master.columns else F.lit(None).cast("timestamp_ntz")
    return rows.withColumns({"status": F.when(hit, INACTIVE).otherwise(F.col("status")), "inactive_since": F.when(hit, F.lit(now).cast("timestamp_ntz")).otherwise(since)}).drop("__gone")


def vanished(master: DataFrame, discovered: DataFrame, unknown: DataFrame, complete: bool) -> DataFrame:
    """Active tickers that a complete discovery lacks; names with an unanswered probe are spared, an incomplete one removes none."""
    active = master.where(F.col("status") == ACTIVE).select("ticker")
    return active.join(discovered, "ticker", "left_anti").join(unknown, "ticker", "left_anti").where(F.lit(complete))


def list_tickers(master: DataFrame, status: str | None = ACTIVE, board: str | None = None) -> DataFrame:
    for c, v in (("status", status), ("board", board)):
        if v is not None:
            master = master.where(F.col(c) == v)
    return master.select("ticker").orderBy("ticker")


def search(master: DataFrame, status: str | None = None, board: str | None = None, query: str | None = None) -> DataFrame:
    """Rows by status and board, and by a case-insensitive pattern found in ticker or name."""
    for c, v in (("status", status), ("board", board)):
        if v is not None:
            master = master.where(F.col(c) == v)
    if query:
        pattern = F.lit(f"(?i){query}")
        master = master.where(F.coalesce(F.rlike("ticker", pattern), F.lit(False)) | F.coalesce(F.rlike("name", pattern), F.lit(False)))
    return master


def page(rows: DataFrame, limit: int = 50, skip: int = 0) -> DataFrame:
    """A page by ticker; limit 0 means no limit. The total before paging is the rows' own count."""
    out = rows.orderBy("ticker").offset(skip)
    return out.limit(limit) if limit else out


def get(master: DataFrame, ticker: str) -> DataFrame:
    return master.where(F.col("ticker") == ticker)


def exists(master: DataFrame, ticker: str) -> bool:
    return not get(master, ticker).limit(1).isEmpty()


def set_ingest_state(master: DataFrame, ticker: str, state: str, now: dt.datetime, **extra: object) -> DataFrame:
    """Sets fields of the nested ingest state of one known ticker; the others are untouched."""
    fresh = F.col("ingest").withField("state", F.lit(state)).withField("updated_at", F.lit(now).cast("timestamp_ntz"))
    for k, v in extra.items():
        fresh = fresh.withField(k, F.lit(v))
    return master.withColumn("ingest", F.when(F.col("ticker") == ticker, fresh).otherwise(F.col("ingest")))


def pending(master: DataFrame, run_id: str, run: str = "run_id", state: str = "ingest_state") -> DataFrame:
    """Active tickers that this run has not finished: another or no run, or a state that is not done."""
    todo = ~F.col(run).eqNullSafe(F.lit(run_id)) | ~F.coalesce(F.col(state).isin("ok", "empty"), F.lit(False))
    return master.where((F.col("status") == ACTIVE) & todo).select("ticker")


def status_counts(master: DataFrame) -> DataFrame:
    return master.groupBy(F.coalesce("status", F.lit("unknown")).alias("status")).agg(F.count("*").alias("n"))


def missing_only(master: DataFrame, bars: DataFrame) -> DataFrame:
    """Active tickers without any bar."""
    return master.where(F.col("status") == ACTIVE).select("ticker").join(bars.select("ticker").distinct(), "ticker", "left_anti")
