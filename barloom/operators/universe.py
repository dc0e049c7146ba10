"""Discovery of the universe: screens in bands, probes of code ranges, and their reconciliation."""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.config import CAP_CEILING, CODE_PREFIXES, DEEPEST_BAND, MIN_BAND_RATIO, MIN_RESOLVABLE_CAP, SCREEN_ROWS
from barloom.functions.codes import board, instrument, is_equity, padded, symbol

PRESENT, ABSENT, UNKNOWN = "present", "absent", "unknown"


def classify(listings: DataFrame) -> DataFrame:
    """Rows with their instrument, board, symbol and whether they are equities."""
    code = F.col("code")
    return listings.withColumns({"instrument": instrument(code), "board": board(code), "symbol": symbol(code), "is_equity": is_equity(code)})


def unknown_blocks(listings: DataFrame) -> DataFrame:
    """block, codes (sorted, repeats kept) of codes in no known block. Repeats are counted first: a block has at most a thousand codes of six digits."""
    rows = listings.select(F.col("code"), F.substring(padded(F.col("code")), 1, 3).alias("block"), instrument(F.col("code")).alias("i")).where("i = 'unknown'")
    counted = rows.groupBy("block", "code").agg(F.count("*").cast("int").alias("n"))
    return counted.groupBy("block").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("code", "n"))), lambda x: F.array_repeat(x["code"], x["n"]))).alias("codes"))


def instrument_counts(listings: DataFrame) -> DataFrame:
    return listings.groupBy(instrument(F.col("code")).alias("instrument")).agg(F.count("*").alias("n"))


def board_counts(listings: DataFrame) -> DataFrame:
    """Equities by board; a missing board counts as other."""
    return listings.where(is_equity(F.col("code"))).groupBy(F.coalesce(board(F.col("code")), F.lit("other")).alias("board")).agg(F.count("*").alias("n"))


def membership(screener: DataFrame, probe: DataFrame) -> DataFrame:
    """ticker, in_screener, in_probe: the outer join of two methods' symbols."""
    s = screener.select("ticker").distinct().withColumn("s", F.lit(True))
    p = probe.select("ticker").distinct().withColumn("p", F.lit(True))
    return s.join(p, "ticker", "full_outer").select("ticker", F.coalesce("s", F.lit(False)).alias("in_screener"), F.coalesce("p", F.lit(False)).alias("in_probe"))


def reconcile(members: DataFrame) -> DataFrame:
    """One row: totals of both methods, union, agreement, differences and their share; rows are code, in_screener, in_probe."""
    rows = members.groupBy("code").agg(F.max("in_screener").alias("s"), F.max("in_probe").alias("p"))
    equity = is_equity(F.col("code"))
    s, p = F.col("s"), F.col("p")
    out = rows.agg(
        F.count_if(equity & s).alias("screener_total"),
        F.count_if(equity & p).alias("probe_total"),
        F.count_if(equity & (s | p)).alias("union_total"),
        F.count_if(equity & s & p).alias("agreement"),
        F.count_if(equity & p & ~s).alias("probe_only"),
        F.count_if(equity & s & ~p).alias("screener_only"),
        F.count_if(~equity & (s | p)).alias("excluded"),
    )
    return out.withColumn("disagreement_fraction", F.coalesce(F.try_divide(F.greatest("probe_only", "screener_only"), "union_total"), F.lit(0.0)))


def gate(reconciliation: DataFrame, unresolved_probes: int, tolerance: float = 0.10) -> DataFrame:
    """The reconciliation with ``passes``: little disagreement and no unanswered probe."""
    return reconciliation.withColumn("passes", (F.col("disagreement_fraction") <= tolerance) & F.lit(unresolved_probes == 0))


def candidate_codes(spark: SparkSession, prefixes: tuple[str, ...] = CODE_PREFIXES) -> DataFrame:
    """code, prefix of all six-digit codes under the prefixes."""
    parts = [spark.range(10 ** (6 - len(p))).select(F.concat(F.lit(p), F.lpad(F.col("id").cast("string"), F.lit(6 - len(p)), F.lit("0"))).alias("code"), F.lit(p).alias("prefix")) for p in dict.fromkeys(prefixes)]
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def probe_outcomes(candidates: DataFrame, answers: DataFrame, skip: DataFrame | None = None) -> DataFrame:
    """code, outcome: present or absent as answered, unknown where an answer failed; candidates without an answer are absent.

    ``answers``: code, found boolean, failed boolean.
    """
    if skip is not None:
        candidates = candidates.join(skip.select("code"), "code", "left_anti")
    per = answers.groupBy("code").agg(F.max(F.coalesce("found", F.lit(False))).alias("found"), F.max(F.coalesce("failed", F.lit(False))).alias("failed"))
    case = F.when(F.col("found"), PRESENT).when(F.col("failed"), UNKNOWN).otherwise(ABSENT)
    return candidates.select("code").distinct().join(per, "code", "left").select("code", case.alias("outcome"))


Leaf = tuple[float, float | None, int, int, bool, str | None]


def band_edges(depth: int = DEEPEST_BAND) -> list[float]:
    """All bounds that halving at the geometric mean can reach: 0, then 2**depth rising values up to the ceiling."""
    edges = [0.0, CAP_CEILING]
    for _ in range(depth):
        between = [(max(a, 1.0) * b) ** 0.5 for a, b in zip(edges, edges[1:])]
        edges = [x for pair in zip(edges, between) for x in pair] + [CAP_CEILING]
    return edges


def cap_counts(listings: DataFrame, edges: list[float]) -> tuple[list[int], list[int]]:
    """How many caps lie in each [edge, next edge) and on each edge: one pass, and at most two rows an edge for the driver.

    Edges are even in the logarithm, which gives a cell that is off by one at most; the edges themselves decide.
    """
    cells = len(edges) - 1
    held = F.array(*map(F.lit, edges))
    rows = listings.select(F.col("market_cap").alias("cap")).where(F.col("cap").between(edges[0], edges[-1]))
    guess = F.least(F.greatest(F.floor(F.log(F.greatest("cap", F.lit(1.0))) * (cells / math.log(edges[-1]))), F.lit(0)), F.lit(cells - 1)).cast("int")
    rows = rows.withColumn("k", guess)
    rows = rows.withColumn("k", F.col("k") + F.when(F.col("cap") < F.get(held, F.col("k")), -1).when((F.col("cap") >= F.get(held, F.col("k") + 1)), 1).otherwise(0))
    found = rows.groupBy("k", (F.col("cap") == F.get(held, F.col("k"))).alias("on")).agg(F.count("*").alias("n")).collect()
    inside, on = [0] * (cells + 1), [0] * (cells + 1)
    for r in found:
        inside[r["k"]] += r["n"]
        on[r["k"]] += r["n"] if r["on"] else 0
    return inside, on


def screen_bands(listings: DataFrame, ceiling: int = SCREEN_ROWS) -> list[Leaf]:
    """Leaves (low, high, depth, n_returned, saturated, unresolvable) of halving the market caps until a screen of at most ``ceiling`` rows holds each band.

    A band holds both its bounds. All counts come from one pass, since the bounds that halving can reach are known beforehand.
    """
    edges = band_edges()
    inside, on = cap_counts(listings, edges)
    upto = list(accumulate([0, *inside]))
    leaves: list[Leaf] = []

    def visit(a: int, b: int, depth: int) -> None:
        low, high = edges[a], edges[b]
        n = upto[b] - upto[a] + on[b]
        last = b == len(edges) - 1
        why = None
        if n >= ceiling and not last:
            narrow = low > 0 and (high / low < MIN_BAND_RATIO or (low * high) ** 0.5 <= low * 1.000001)
            why = "no_reported_market_cap" if high <= MIN_RESOLVABLE_CAP else "interval_exhausted" if narrow else None
        if n >= ceiling and why is None and depth == DEEPEST_BAND:
            why = "max_depth"
        if n >= ceiling and why is None:
            middle = (a + b) // 2
            visit(a, middle, depth + 1)
            visit(middle, b, depth + 1)
        else:
            leaves.append((low, None if last else high, depth, min(n, ceiling), n >= ceiling, why))

    visit(0, len(edges) - 1, 0)
    return leaves


def bands_frame(spark: SparkSession, leaves: list[Leaf]) -> DataFrame:
    return spark.createDataFrame(leaves, "low double, high double, depth int, n_returned bigint, saturated boolean, unresolvable string")


def discover(listings: DataFrame, answers: DataFrame | None, prefixes: tuple[str, ...] = CODE_PREFIXES) -> DataFrame:
    """ticker, code, name, board, in_screener, in_probe of the equities that either method finds."""
    screened = listings.where(is_equity(F.col("code"))).select("code", "name").groupBy("code").agg(F.min("name").alias("name")).withColumn("s", F.lit(True))
    if answers is None:
        rows = screened.withColumn("p", F.lit(False))
    else:
        found = probe_outcomes(candidate_codes(listings.sparkSession, prefixes), answers).where(F.col("outcome") == PRESENT).select("code").withColumn("p", F.lit(True))
        rows = screened.join(found, "code", "full_outer")
    code = F.col("code")
    return rows.select(symbol(code).alias("ticker"), "code", "name", board(code).alias("board"), F.coalesce("s", F.lit(False)).alias("in_screener"), F.coalesce("p", F.lit(False)).alias("in_probe"))
