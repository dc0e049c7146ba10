"""The status of a store: one record from DataFrames, and the text that shows it."""

from __future__ import annotations

import re
from string import Template

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.functions.codes import age_text

OPENS, CLOSES = "<!-- status:begin -->", "<!-- status:end -->"  # fixed values: the marks that READMEs carry
TEXT = Template(
    """**Data $state** through $last.

- $bars bars of $tickers tickers in $chunks chunks, from $first on
- securities: $active active, $inactive inactive
- storage: $storage
- last run: $run
- census: $census"""
)


def live_facts(manifest: DataFrame, master: DataFrame) -> DataFrame:
    """One row: first, last, chunks, bars, tickers, active, inactive; nulls and zeros of an empty store."""
    held = manifest.agg(F.min("first").alias("first"), F.max("last").alias("last"), F.count("*").alias("chunks"), F.coalesce(F.sum("n"), F.lit(0)).alias("bars"), F.count_distinct("ticker").alias("tickers"))
    names = master.agg(F.count_if(F.col("status") == "active").alias("active"), F.count_if(F.col("status") == "inactive").alias("inactive"))
    return held.withColumn("k", F.lit(1)).join(names.withColumn("k", F.lit(1)), "k").drop("k")


def _grouped(x: Column) -> Column:
    return F.format_number(x, 0)


def storage_text(stats: DataFrame) -> DataFrame:
    """The storage column's text from rows of ``storage_facts`` with ``most_bytes``."""
    mib = lambda c, d: F.format_number(F.col(c) / (1 << 20), d)
    return stats.withColumn("storage", F.concat(mib("used_bytes", 1), F.lit(" of "), mib("most_bytes", 0), F.lit(" MiB ("), F.format_number(F.col("used_fraction") * 100, 1), F.lit(" %), encoded "), mib("data_bytes", 1), F.lit(" MiB, ratio "), F.format_number("compression_ratio", 2)))


def run_text(runs: DataFrame, now: Column) -> DataFrame:
    """id, run: what a run did and how long ago, from rows of ``runs.current``; a run without an end is shown by its start."""
    at = F.coalesce("finished_at", "heartbeat_at", "started_at")
    seconds = F.unix_timestamp(now.cast("timestamp")) - F.unix_timestamp(at.cast("timestamp"))
    return runs.select("id", F.concat_ws(", ", F.concat_ws(" ", "kind", "status"), age_text(seconds)).alias("run"))


def record(facts: DataFrame, now: Column, stale_days: int = 4) -> DataFrame:
    """Facts as the texts that the template takes; data older than ``stale_days`` are stale, whatever the last run says."""
    state = F.when(F.col("last").isNull(), "absent").when(F.datediff(now, "last") > stale_days, "stale").otherwise("fresh")
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("none")).alias(c) for c in ("first", "last")]
    texts += [_grouped(F.col(c)).alias(c) for c in ("bars", "tickers", "chunks", "active", "inactive")]
    return facts.select(state.alias("state"), *texts)


def block(values: dict[str, str]) -> str:
    """The marked block; what the values lack is shown as unknown."""
    names = re.findall(r"\$([a-z]+)", TEXT.template)
    return f"{OPENS}\n{TEXT.substitute({n: values.get(n) or 'unknown' for n in names})}\n{CLOSES}"


def placed(document: str, text: str) -> str:
    """The document with its marked block replaced; without one, the block follows the document as a paragraph of its own."""
    marked = re.compile(f"{re.escape(OPENS)}.*?{re.escape(CLOSES)}", re.DOTALL)
    replaced, times = marked.subn(lambda _: text, document, count=1)
    return replaced if times else "\n\n".join(part for part in (document.rstrip(), text) if part) + "\n"
