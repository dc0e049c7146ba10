"""Code, symbol and message classification as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from barloom.schemas import BLOCKS, BOARDS, EQUITIES

# Message fragments of an answered "no such listing", and of a request that failed.
ABSENT_MARKERS = ("possibly delisted", "no price data found", "no data found", "symbol may be delisted", "404")
TRANSIENT_MARKERS = ("timeout", "timed out", "connection", "failed to perform", "too many requests", "429", "500", "502", "503", "504", "temporarily unavailable", "ssl", "reset by peer", "curl")


def padded(code: Column) -> Column:
    """Codes of fewer than six characters get leading zeros; longer ones stay."""
    return F.when(F.length(code) < 6, F.lpad(code, F.lit(6), F.lit("0"))).otherwise(code)


def _by_block(code: Column, table: dict[str, str], default: str) -> Column:
    known = F.create_map(*(F.lit(x) for pair in table.items() for x in pair))
    return F.coalesce(F.try_element_at(known, F.substring(code, 1, 3)), F.lit(default))


def instrument(code: Column) -> Column:
    return _by_block(padded(code), BLOCKS, "unknown")


def is_equity(code: Column) -> Column:
    return instrument(code).isin(*EQUITIES)


def board(code: Column) -> Column:
    """By the code's own first three characters, without padding."""
    return _by_block(code, BOARDS, "other")


def symbol(code: Column, suffix: str = ".SS") -> Column:
    return F.concat(padded(code.cast("int").cast("string")), F.lit(suffix))


def is_transient(message: Column) -> Column:
    """A failed request rather than an answer; markers of absence win."""
    low = F.lower(message)
    absent = F.lit(False)
    for m in ABSENT_MARKERS:
        absent = absent | F.contains(low, F.lit(m))
    failed = F.lit(False)
    for m in TRANSIENT_MARKERS:
        failed = failed | F.contains(low, F.lit(m))
    return F.coalesce(~absent & failed, F.lit(False))


def absent_message(message: str) -> bool:
    """The same markers for one message: an answered "no such listing"."""
    return any(m in message.lower() for m in ABSENT_MARKERS)


def transient_message(message: str) -> bool:
    """The same rule for one message: worth another try."""
    return not absent_message(message) and any(m in message.lower() for m in TRANSIENT_MARKERS)


def age_text(seconds: Column) -> Column:
    """How long ago, in whole days, hours or minutes; null stays null."""
    unit = F.when(seconds >= 86_400, F.lit("d")).when(seconds >= 3600, F.lit("h")).otherwise(F.lit("min"))
    size = F.when(unit == "d", 86_400).when(unit == "h", 3600).otherwise(60)
    return F.concat_ws(" ", F.floor(seconds / size).cast("string"), F.when(seconds.isNotNull(), unit), F.when(seconds.isNotNull(), F.lit("ago")))


def redacted(text: Column) -> Column:
    """Passwords in connection strings masked."""
    return F.regexp_replace(text, r"(://)([^:/@\s]+):[^@/\s]+@", r"$1$2:***@")
