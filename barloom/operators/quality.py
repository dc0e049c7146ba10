"""Validation, cleaning and the census of daily bars.

Missing is null, and a rule on a missing value never fires. Arrivals are grouped
by ticker and date, so a ticker with many arrivals of its dates spreads over
tasks; only rows that hold a date once are ever ordered within a ticker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.config import LIMIT_TOLERANCE, OHLC_EPSILON, PRICE_LIMITS
from barloom.schemas import ACTIONS, PRICES

ERRORS = ("duplicate_dates", "unsorted_dates", *(f"non_positive_{c}" for c in PRICES), "negative_volume", "ohlc_violations")
WARNINGS = (*(f"nan_{c}" for c in PRICES), "zero_volume", "price_limit_exceeded", "limit_locked_days", "long_gaps")


def _true(x: Column) -> Column:
    return F.coalesce(x, F.lit(False))


def ohlc_violation(columns: list[str] | None = None) -> Column:
    """High under, or low over, the other prices by more than the slack; without high or low never."""
    have = [c for c in ("open", "high", "low", "close") if columns is None or c in columns]
    if "high" not in have or "low" not in have:
        return F.lit(False)
    body = [F.col(c) for c in ("open", "close") if c in have]
    over = F.col("high") < F.greatest(*body, F.col("low")) - OHLC_EPSILON if body else F.col("high") < F.col("low") - OHLC_EPSILON
    under = F.col("low") > F.least(*body, F.col("high")) + OHLC_EPSILON if body else F.col("low") > F.col("high") + OHLC_EPSILON
    return _true(over) | _true(under)


def limit_of(board: Column) -> Column:
    out = F.when(board == "main", PRICE_LIMITS["main"])
    for name, limit in PRICE_LIMITS.items():
        if name != "main":
            out = out.when(board == name, limit)
    return out.otherwise(PRICE_LIMITS["other"])


def by_date() -> Window:
    return Window.partitionBy("ticker").orderBy("date")


def limit_break(board: Column) -> Column:
    """A close off the row before by more than the board's limit, on a day without action; a missing close on either side never fires."""
    before = F.lag("close").over(by_date())
    jump = F.when(before == 0, F.col("close") != 0).otherwise(F.abs(F.col("close") / F.nullif(before, F.lit(0.0)) - 1) > limit_of(board) + LIMIT_TOLERANCE)
    quiet = F.lit(True)
    for c in ACTIONS:
        quiet = quiet & (F.coalesce(F.col(c), F.lit(0.0)) == 0)
    return _true(jump) & quiet


def limit_locked() -> Column:
    return _true((F.col("high") == F.col("low")) & (F.col("open") == F.col("close")) & (F.col("high") == F.col("close")))


def gap_days() -> Column:
    return F.datediff("date", F.lag("date").over(by_date()))


def price_limit_breaks(bars: DataFrame) -> DataFrame:
    return bars.withColumn("broke", limit_break(F.col("board"))).where("broke").drop("broke")


def calendar_gaps(bars: DataFrame, min_days: int = 30) -> DataFrame:
    """ticker, before, after, days, label of spacings of at least ``min_days`` calendar days."""
    rows = bars.select("ticker", F.lag("date").over(by_date()).alias("before"), F.col("date").alias("after"), gap_days().alias("days")).where(F.col("days") >= min_days)
    return rows.withColumn("label", F.format_string("%s..%s (%dd)", F.col("before").cast("string"), F.col("after").cast("string"), F.col("days")))


def duplicate_dates(raw: DataFrame) -> DataFrame:
    """ticker, n: rows beyond the first of a date."""
    per = raw.groupBy("ticker", "date").agg((F.count("*") - 1).alias("extra")).where("extra > 0")
    return per.groupBy("ticker").agg(F.sum("extra").alias("n"))


def unsorted_tickers(raw: DataFrame) -> DataFrame:
    """ticker, n = 1 where a date arrives (by ``seq``) before an earlier date is through: one row a date is compared."""
    days = raw.groupBy("ticker", "date").agg(F.min("seq").alias("begin"), F.max("seq").alias("end"))
    past = F.max("end").over(by_date().rowsBetween(Window.unboundedPreceding, -1))
    return days.select("ticker", (past > F.col("begin")).alias("late")).where("late").groupBy("ticker").agg(F.max(F.lit(1)).alias("n"))


def keep_last(raw: DataFrame) -> DataFrame:
    """The last arrival of each (ticker, date)."""
    last = Window.partitionBy("ticker", "date").orderBy(F.desc("seq"))
    return raw.withColumn("__rn", F.row_number().over(last)).where("__rn = 1").drop("__rn")


def valid(columns: list[str]) -> Column:
    """Close finite and positive, other prices positive or missing, volume not negative or missing, no OHLC violation."""
    ok = F.lit(True)
    if "close" in columns:
        ok = ok & _true((F.col("close") > 0) & (F.col("close") < float("inf")))
    for c in PRICES:
        if c in columns and c != "close":
            ok = ok & ~_true(F.col(c) <= 0)
    if "volume" in columns:
        ok = ok & ~_true(F.col("volume") < 0)
    return ok & ~ohlc_violation(columns)


def sanitize(raw: DataFrame) -> DataFrame:
    """Last arrival a date, and only then the validity rules, so a bad last arrival removes its date; infinities left become null."""
    rows = keep_last(raw).where(valid(raw.columns))
    return rows.withColumns({c: F.when(F.abs(c) == float("inf"), None).otherwise(F.col(c)) for c in ("open", "high", "low", "adj_close") if c in raw.columns}).drop("seq")


def drop_counts(raw: DataFrame) -> DataFrame:
    """ticker, n_input, n_output, n_dropped of cleaning."""
    flagged = raw.withColumn("__last", F.row_number().over(Window.partitionBy("ticker", "date").orderBy(F.desc("seq"))) == 1)
    out = flagged.groupBy("ticker").agg(F.count("*").alias("n_input"), F.count_if(F.col("__last") & valid(raw.columns)).alias("n_output"))
    return out.withColumn("n_dropped", F.col("n_input") - F.col("n_output"))


def flag_counts(bars: DataFrame, min_gap: int = 30, moves: bool = True) -> DataFrame:
    """One row a ticker with every per-row check counted: one shuffle, one sort; without ``moves``, which compare days, no sort."""
    rows = bars.select("*", limit_break(F.col("board")).alias("__limit"), gap_days().alias("__gap")) if moves else bars
    counts = [F.count_if(F.col(c).isNull()).alias(f"nan_{c}") for c in PRICES]
    counts += [F.count_if(F.col(c) <= 0).alias(f"non_positive_{c}") for c in PRICES]
    counts += [F.count_if(F.col("volume") < 0).alias("negative_volume"), F.count_if(F.col("volume") == 0).alias("zero_volume"), F.count_if(ohlc_violation()).alias("ohlc_violations")]
    counts += [F.count_if(limit_locked()).alias("limit_locked_days")]
    counts += [F.count_if("__limit").alias("price_limit_exceeded"), F.count_if(F.col("__gap") >= min_gap).alias("long_gaps")] if moves else []
    return rows.groupBy("ticker").agg(F.count("*").alias("n_input"), *counts)


def long_form(counts: DataFrame) -> DataFrame:
    """ticker, severity, check, n; zero counts leave no row."""
    names = [c for c in (*ERRORS, *WARNINGS) if c in counts.columns]
    cells = F.array(*(F.struct(F.lit("error" if c in ERRORS else "warning").alias("severity"), F.lit(c).alias("check"), F.col(c).alias("n")) for c in names))
    return counts.select("ticker", F.inline(cells)).where("n > 0")


def quality_report(bars: DataFrame) -> DataFrame:
    return long_form(flag_counts(bars))


def validate(raw: DataFrame, moves: bool = True) -> DataFrame:
    """All checks of rows as they arrived, order and duplicates included; ``moves``: see ``flag_counts``. Errors need none."""
    extra = [rows.select("ticker", F.lit("error").alias("severity"), F.lit(c).alias("check"), F.col("n").cast("bigint").alias("n")) for c, rows in (("duplicate_dates", duplicate_dates(raw)), ("unsorted_dates", unsorted_tickers(raw)))]
    return long_form(flag_counts(raw, moves=moves)).unionByName(extra[0]).unionByName(extra[1])


def examples(bars: DataFrame, k: int = 5) -> DataFrame:
    """ticker, check, shown (the first k cases by date), n of the checks that name their cases: OHLC, price limits, gaps."""
    day = F.col("date").cast("string")
    seen = {"before": F.lag("date").over(by_date()).cast("string"), "last": F.lag("close").over(by_date()), "broke": limit_break(F.col("board")), "days": gap_days(), "odd": ohlc_violation()}
    labels = {
        "ohlc_violations": F.when(F.col("odd"), day),
        "price_limit_exceeded": F.when(F.col("broke"), F.concat_ws(" ", day, F.format_number("last", 4), F.lit("->"), F.format_number("close", 4))),
        "long_gaps": F.when(F.col("days") >= 30, F.concat(F.col("before"), F.lit(".."), day)),
    }
    cases = F.array(*(F.struct(F.lit(c).alias("check"), x.alias("label")) for c, x in labels.items()))
    rows = bars.select("ticker", "date", "close", *(v.alias(k) for k, v in seen.items())).select("ticker", "date", F.inline(cases)).where("label IS NOT NULL")
    # ranked first, so that only k cases of a check are ever put together
    rank = F.row_number().over(Window.partitionBy("ticker", "check").orderBy("date", "label"))
    out = rows.withColumn("rank", rank).groupBy("ticker", "check").agg(F.array_sort(F.collect_list(F.when(F.col("rank") <= k, F.struct("rank", "label")))).alias("first"), F.count("*").alias("n"))
    return out.select("ticker", "check", F.transform("first", lambda x: x["label"]).alias("shown"), "n")


def report_rows(raw: DataFrame) -> DataFrame:
    """ticker, n_input, n_output, n_dropped, errors (before cleaning), warnings (after), ok, summary; checks that count nothing are not listed."""
    pre = validate(raw, moves=False).where("severity = 'error'")
    post = quality_report(sanitize(raw))
    return reports(drop_counts(raw), pre, post)


def reports(drops: DataFrame, before: DataFrame, after: DataFrame) -> DataFrame:
    """Report rows of drop counts, checks before cleaning and checks after; ``ok`` means no error is left after."""
    lists = before.where("severity = 'error'").unionByName(after.where("severity = 'warning'")).withColumn("left", F.lit(0))
    lists = lists.unionByName(after.where("severity = 'error'").withColumn("left", F.lit(1)))

    def listed(severity: str) -> Column:
        mine = (F.col("severity") == severity) & (F.col("left") == 0)
        return F.map_from_entries(F.array_sort(F.collect_list(F.when(mine, F.struct("check", "n"))))).alias(f"{severity}s")

    wide = lists.groupBy("ticker").agg(listed("error"), listed("warning"), F.max("left").alias("left"))
    none = F.map_from_entries(F.array().cast("array<struct<check: string, n: bigint>>"))
    out = drops.join(wide, "ticker", "left").withColumns({"errors": F.coalesce("errors", none), "warnings": F.coalesce("warnings", none)})

    def text(name: str) -> Column:
        return F.array_join(F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ", ")

    summary = F.format_string("%s: kept %d of %d rows; errors: %s; warnings: %s", F.col("ticker"), F.col("n_output"), F.col("n_input"), F.coalesce(F.nullif(text("errors"), F.lit("")), F.lit("none")), F.coalesce(F.nullif(text("warnings"), F.lit("")), F.lit("none")))
    return out.select("ticker", "n_input", "n_output", "n_dropped", "errors", "warnings", (F.coalesce("left", F.lit(0)) == 0).alias("ok"), summary.alias("summary"))


def failing(rows: DataFrame, k: int = 50) -> DataFrame:
    """The first k report rows that are not ok, by ticker."""
    return rows.where("NOT ok").orderBy("ticker").limit(k)


def census(raw: DataFrame) -> DataFrame:
    """One row over all tickers: tickers, clean, with_errors, bars_in, bars_out, bars_dropped."""
    bad = quality_report(sanitize(raw)).where("severity = 'error'").select("ticker").distinct().withColumn("bad", F.lit(1))
    rows = drop_counts(raw).join(bad, "ticker", "left")
    return rows.agg(
        F.count("*").alias("tickers"),
        F.count_if(F.col("bad").isNull()).alias("clean"),
        F.count_if(F.col("bad").isNotNull()).alias("with_errors"),
        F.coalesce(F.sum("n_input"), F.lit(0)).alias("bars_in"),
        F.coalesce(F.sum("n_output"), F.lit(0)).alias("bars_out"),
        F.coalesce(F.sum("n_dropped"), F.lit(0)).alias("bars_dropped"),
    )


def check_totals(raw: DataFrame) -> DataFrame:
    """severity, check, n over all tickers: errors before cleaning and warnings after."""
    rows = validate(raw, moves=False).where("severity = 'error'").unionByName(quality_report(sanitize(raw)).where("severity = 'warning'"))
    return rows.groupBy("severity", "check").agg(F.sum("n").alias("n"))


def worst(raw: DataFrame, k: int = 20) -> DataFrame:
    """The k tickers that lose most rows, ties by ticker."""
    return drop_counts(raw).where("n_dropped > 0").orderBy(F.desc("n_dropped"), "ticker").limit(k)
