"""Vendor connectors: calls that are paced and repeated, spread over the cluster, whose failures are values.

A connector is any object with ``fetch(ticker, start, end)`` that gives rows of
the bars schema after the ticker, or raises; a prober is a callable that tells
whether a code is listed, or raises. Both run on executors, one ticker at a
time, so one bad ticker never fails a scan.
"""

from __future__ import annotations

import datetime as dt
import itertools
import math
import random
import threading
import time
from collections.abc import Callable, Iterable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.config import Retry
from barloom.functions.codes import absent_message, transient_message
from barloom.schemas import FIELDS

LONGEST_ERROR = 500
FETCHED = "ticker string, date date, " + ", ".join(f"{f} double" for f in FIELDS) + ", error string"
RATE_MARKERS = ("429", "too many requests", "rate limit", "temporarily unavailable")  # fixed values


class Connector(Protocol):
    def fetch(self, ticker: str, start: dt.date, end: dt.date) -> Iterable[tuple]: ...


class Pace:
    """At most ``per_minute`` calls in any 60 seconds, whatever threads call: each call books the time at which the one ``per_minute`` before it is a minute past."""

    def __init__(self, per_minute: int, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep) -> None:
        self.clock, self.sleep = clock, sleep
        self.booked = [-math.inf] * max(1, per_minute)
        self.turns = itertools.count()
        self.lock = threading.Lock()

    def take(self) -> float:
        """Returns when a call may be made: the time that it booked."""
        with self.lock:
            turn = next(self.turns) % len(self.booked)
            at = self.booked[turn] = max(self.clock(), self.booked[turn] + 60)
        if (rest := at - self.clock()) > 0:
            self.sleep(rest)
        return at


def backoff_bounds(attempt: Column, limited: Column, retry: Retry = Retry()) -> tuple[Column, Column]:
    """Least and longest wait in seconds before the try after ``attempt`` (from 0); four times as long where the vendor limits."""
    wait = F.least(F.pow(F.lit(retry.base), attempt) * F.when(limited, 4.0).otherwise(1.0), F.lit(retry.longest))
    return wait * 0.5, wait * 1.5


def _wait(attempt: int, message: str, retry: Retry) -> float:
    limited = any(m in message.lower() for m in RATE_MARKERS)
    return min(retry.base**attempt * (4 if limited else 1), retry.longest) * random.uniform(0.5, 1.5)


def tried(call: Callable[[], object], retry: Retry, pace: Pace, again: Callable[[str], bool] = lambda _: True) -> tuple[object, str | None]:
    """(result, None), or (None, message) once no try is left or the failure is not of a kind to try again."""
    for attempt in range(retry.attempts):
        pace.take()
        try:
            return call(), None
        except Exception as e:  # noqa: BLE001  whatever a vendor's client raises is this ticker's result
            message = (str(e) or type(e).__name__)[:LONGEST_ERROR]
            if attempt + 1 == retry.attempts or not again(message):
                return None, message
            pace.sleep(_wait(attempt, message, retry))
    return None, "no attempt allowed"


def fetch_many(tickers: DataFrame, connector: Connector, start: dt.date, end: dt.date, retry: Retry = Retry(), tasks: int = 8, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """Bars of all tickers from start to end, both included; a ticker whose last try failed has one row with ``error`` and no date.

    ``per_minute`` is shared out over ``tasks``. Rows outside the range fall.
    """
    share = max(1, retry.per_minute // tasks)
    names = [x.split()[0] for x in FETCHED.split(", ")]
    types = [pa.string(), pa.date32(), *[pa.float64()] * len(FIELDS), pa.string()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Pace(share, sleep=sleep)
        for batch in it:
            for ticker in batch.column(0).to_pylist():
                got, error = tried(lambda t=ticker: [(t, *r, None) for r in connector.fetch(t, start, end) if start <= r[0] <= end], retry, pace)
                rows = got if error is None else [(ticker, None, *[None] * len(FIELDS), error)]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    return tickers.select("ticker").distinct().repartition(tasks, "ticker").mapInArrow(run, FETCHED)


def fetch_results(requested: DataFrame, fetched: DataFrame) -> DataFrame:
    """ticker, n_bars, ok, error: one row a requested ticker; one without rows and error is ok with 0 bars."""
    per = fetched.groupBy("ticker").agg(F.count("date").alias("n_bars"), F.min("error").alias("error"))
    out = requested.select("ticker").distinct().join(per, "ticker", "left")
    return out.select("ticker", F.coalesce("n_bars", F.lit(0)).alias("n_bars"), F.col("error").isNull().alias("ok"), "error")


def probe_many(candidates: DataFrame, prober: Callable[[str], bool], skip: DataFrame | None = None, retry: Retry = Retry(), tasks: int = 8, sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """code, found boolean, failed boolean, error of every candidate not in ``skip``.

    An answer, or a message that says there is none such, settles a code;
    passing failures are tried again, and one that stays leaves the code failed.
    """
    if skip is not None:
        candidates = candidates.join(skip.select("code"), "code", "left_anti")
    share = max(1, retry.per_minute // tasks)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pace = Pace(share, sleep=sleep)
        for batch in it:
            rows = []
            for code in batch.column(0).to_pylist():
                found, error = tried(lambda c=code: bool(prober(c)), retry, pace, again=transient_message)
                failed = error is not None and not absent_message(error)
                rows.append((code, bool(found), failed, error))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.bool_(), pa.bool_(), pa.string()), strict=True)], names=["code", "found", "failed", "error"])

    return candidates.select("code").distinct().repartition(tasks, "code").mapInArrow(run, "code string, found boolean, failed boolean, error string")
