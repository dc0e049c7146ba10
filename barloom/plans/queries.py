"""Every query of the engine by name, each beside the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.config import CAP_CEILING, MIN_RESOLVABLE_CAP, Horizon, Retry
from barloom.functions import codec
from barloom.functions.codes import age_text, is_transient, redacted
from barloom.operators import calendar, master, quality, runs, series, store, universe
from barloom.operators.store import Store
from barloom.plans import flows, status
from barloom.plans.views import ctes, view
from barloom.schemas import BARS, BLOCKS, BOARDS, EQUITIES, FIELDS, PRICES
from barloom.session import scratch
from barloom.sources import bars as sources
from barloom.sources import listings, vendor
from barloom.streaming.ingest import daily_bars, merge_stream

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
FROM, TO = dt.date(1996, 1, 1), dt.date(1996, 12, 31)
REQUESTED = [str(i) for i in range(1, 8)] + ["none-such"]


def query(oracle: str | None = None) -> Callable[[Query], Query]:
    def keep(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return keep


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "raw_bars")


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.sanitize(raw(spark, sf_dir))


COLS = "ticker, date, " + ", ".join(FIELDS)
CLEAN_COLS = "ticker, board, date, " + ", ".join(FIELDS)


@query(f"{ctes('raw_bars')} SELECT {CLEAN_COLS}, seq FROM raw_bars")
def raw_bars_normalize(spark, sf_dir):
    vendor = raw(spark, sf_dir).withColumnsRenamed({"adj_close": "Adj Close", "splits": "Stock Splits", "date": "Date", "open": "Open"})
    return sources.normalise(vendor).select("ticker", "board", "date", *FIELDS, "seq")


@query(f"{ctes('clean_bars')} SELECT {COLS} FROM clean_bars WHERE date BETWEEN DATE '{FROM}' AND DATE '{TO}'")
def slice_dates_inclusive(spark, sf_dir):
    return series.project(series.slice_dates(clean(spark, sf_dir), FROM, TO))


@query(f"{ctes('clean_bars')} SELECT r.ticker, date, close, volume FROM (SELECT unnest({REQUESTED}) AS ticker) r LEFT JOIN (SELECT * FROM clean_bars WHERE date BETWEEN DATE '{FROM}' AND DATE '{TO}') b ON b.ticker = r.ticker")
def get_many_left(spark, sf_dir):
    requested = spark.createDataFrame([(t,) for t in [*REQUESTED, "1"]], "ticker string")
    return series.get_many(clean(spark, sf_dir), requested, FROM, TO, ["close", "volume", "nonsense"])


@query(f"{ctes('clean_bars')} SELECT date, close FROM clean_bars WHERE ticker = '1' AND date BETWEEN DATE '{FROM}' AND DATE '{TO}'")
def get_series_point(spark, sf_dir):
    return series.get_series(clean(spark, sf_dir), "1", FROM, TO, ["close"]).drop("ticker")


@query(f"{ctes('raw_bars')} SELECT {CLEAN_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY seq DESC) AS rn FROM raw_bars) WHERE rn = 1")
def dedupe_keep_last(spark, sf_dir):
    return quality.keep_last(raw(spark, sf_dir)).drop("seq")


@query(f"{ctes('clean_bars')} SELECT {CLEAN_COLS} FROM clean_bars")
def sanitize_bars(spark, sf_dir):
    return clean(spark, sf_dir)


DROPS = "d AS (SELECT r.ticker, n_input, coalesce(n_output, 0) AS n_output, n_input - coalesce(n_output, 0) AS n_dropped FROM (SELECT ticker, count(*) AS n_input FROM raw_bars GROUP BY 1) r LEFT JOIN (SELECT ticker, count(*) AS n_output FROM clean_bars GROUP BY 1) c ON c.ticker = r.ticker)"


@query(f"{ctes('clean_bars')}, {DROPS} SELECT * FROM d")
def sanitize_drop_counts(spark, sf_dir):
    return quality.drop_counts(raw(spark, sf_dir))


@query(f"{ctes('raw_bars')} SELECT ticker, " + ", ".join(f"count(*) FILTER ({c} IS NULL) AS nan_{c}" for c in PRICES) + " FROM raw_bars GROUP BY ticker")
def validate_missing_counts(spark, sf_dir):
    return quality.flag_counts(raw(spark, sf_dir)).select("ticker", *(f"nan_{c}" for c in PRICES))


@query(f"{ctes('raw_bars')} SELECT ticker, " + ", ".join(f"count(*) FILTER ({c} <= 0) AS non_positive_{c}" for c in PRICES) + ", count(*) FILTER (volume < 0) AS negative_volume, count(*) FILTER (volume = 0) AS zero_volume FROM raw_bars GROUP BY ticker")
def validate_non_positive(spark, sf_dir):
    return quality.flag_counts(raw(spark, sf_dir)).select("ticker", *(f"non_positive_{c}" for c in PRICES), "negative_volume", "zero_volume")


VIOLATES = "(coalesce(high < greatest(open, close, low) - 1e-6, false) OR coalesce(low > least(open, close, high) + 1e-6, false))"


@query(f"{ctes('raw_bars')} SELECT ticker, date, seq, open, high, low, close FROM raw_bars WHERE {VIOLATES}")
def ohlc_violations(spark, sf_dir):
    return raw(spark, sf_dir).where(quality.ohlc_violation()).select("ticker", "date", "seq", "open", "high", "low", "close")


LIMITS = "CASE board WHEN 'main' THEN 0.10 WHEN 'star' THEN 0.20 WHEN 'b_share' THEN 0.10 ELSE 0.20 END"
LAGGED = "l AS (SELECT *, lag(close) OVER w AS prev, date - lag(date) OVER w AS gap, lag(date) OVER w AS before FROM clean_bars WINDOW w AS (PARTITION BY ticker ORDER BY date))"
BROKE = f"(coalesce(CASE WHEN prev = 0 THEN close <> 0 ELSE abs(close / prev - 1) > CAST({LIMITS} AS DOUBLE) + CAST(0.005 AS DOUBLE) END, false) AND dividends = 0 AND splits = 0)"
LOCKED = "coalesce(high = low AND open = close AND high = close, false)"


@query(f"{ctes('clean_bars')}, {LAGGED} SELECT ticker, date, close FROM l WHERE {BROKE}")
def price_limit_breaks(spark, sf_dir):
    return quality.price_limit_breaks(clean(spark, sf_dir)).select("ticker", "date", "close")


@query(f"{ctes('clean_bars')} SELECT ticker, count(*) AS n FROM clean_bars WHERE {LOCKED} GROUP BY ticker")
def limit_locked_days(spark, sf_dir):
    return clean(spark, sf_dir).where(quality.limit_locked()).groupBy("ticker").agg(F.count("*").alias("n"))


@query(f"{ctes('clean_bars')}, {LAGGED} SELECT ticker, before, date AS after, CAST(gap AS INTEGER) AS days, before || '..' || date || ' (' || gap || 'd)' AS label FROM l WHERE gap >= 30")
def calendar_gaps(spark, sf_dir):
    return quality.calendar_gaps(clean(spark, sf_dir))


@query(f"{ctes('raw_bars')} SELECT ticker, CAST(sum(c - 1) AS BIGINT) AS n FROM (SELECT ticker, date, count(*) AS c FROM raw_bars GROUP BY 1, 2) WHERE c > 1 GROUP BY ticker")
def duplicate_dates(spark, sf_dir):
    return quality.duplicate_dates(raw(spark, sf_dir))


def _long(source: str, checks: list[tuple[str, str]]) -> str:
    severity = {**dict.fromkeys(quality.ERRORS, "error"), **dict.fromkeys(quality.WARNINGS, "warning")}
    return " UNION ALL ".join(f"SELECT ticker, '{severity[c]}' AS severity, '{c}' AS \"check\", count(*) AS n FROM {source} WHERE {rule} GROUP BY ticker" for c, rule in checks)


CHECKS = [*((f"nan_{c}", f"{c} IS NULL") for c in PRICES), *((f"non_positive_{c}", f"{c} <= 0") for c in PRICES), ("negative_volume", "volume < 0"), ("zero_volume", "volume = 0"), ("ohlc_violations", VIOLATES)]
MOVES = [("price_limit_exceeded", BROKE), ("limit_locked_days", LOCKED), ("long_gaps", "gap >= 30")]


@query(f"{ctes('clean_bars')}, {LAGGED} {_long('l', CHECKS + MOVES)}")
def quality_report(spark, sf_dir):
    return quality.quality_report(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')}, {DROPS} SELECT count(*) AS tickers, count(*) AS clean, CAST(0 AS BIGINT) AS with_errors, CAST(sum(n_input) AS BIGINT) AS bars_in, CAST(sum(n_output) AS BIGINT) AS bars_out, CAST(sum(n_dropped) AS BIGINT) AS bars_dropped FROM d")
def quality_census(spark, sf_dir):
    return quality.census(raw(spark, sf_dir))


DUPLICATES = "SELECT ticker, 'error' AS severity, 'duplicate_dates' AS \"check\", CAST(sum(c - 1) AS BIGINT) AS n FROM (SELECT ticker, date, count(*) AS c FROM raw_bars GROUP BY 1, 2) WHERE c > 1 GROUP BY ticker"
DISORDER = "SELECT ticker, 'error' AS severity, 'unsorted_dates' AS \"check\", CAST(1 AS BIGINT) AS n FROM (SELECT ticker, date < lag(date) OVER (PARTITION BY ticker ORDER BY seq, date) AS x FROM arrivals) WHERE x GROUP BY ticker"
ARRIVALS = "arrivals AS (SELECT * REPLACE (row_number() OVER (PARTITION BY ticker ORDER BY volume, date, seq) AS seq) FROM raw_bars)"


@query(f"{ctes('clean_bars')}, {ARRIVALS}, {LAGGED} SELECT severity, \"check\", CAST(sum(n) AS BIGINT) AS n FROM ({_long('raw_bars', [c for c in CHECKS if c[0] in quality.ERRORS])} UNION ALL {DUPLICATES} UNION ALL {DISORDER} UNION ALL {_long('l', [c for c in CHECKS if c[0] in quality.WARNINGS] + MOVES)}) GROUP BY 1, 2")
def quality_check_totals(spark, sf_dir):
    from pyspark.sql import Window

    rows = raw(spark, sf_dir)
    arrivals = rows.withColumn("seq", F.row_number().over(Window.partitionBy("ticker").orderBy("volume", "date", "seq")).cast("bigint"))
    pre = quality.validate(arrivals).where("severity = 'error'")
    post = quality.quality_report(clean(spark, sf_dir)).where("severity = 'warning'")
    return pre.unionByName(post).groupBy("severity", "check").agg(F.sum("n").alias("n"))


@query(f"{ctes('clean_bars')}, {DROPS} SELECT * FROM d WHERE n_dropped > 0 ORDER BY n_dropped DESC, ticker LIMIT 20")
def worst_tickers_topk(spark, sf_dir):
    return quality.worst(raw(spark, sf_dir), 20)


ERRORS_BEFORE = f"SELECT ticker, \"check\", n FROM ({_long('raw_bars', [c for c in CHECKS if c[0] in quality.ERRORS])} UNION ALL {DUPLICATES} UNION ALL {DISORDER.replace('arrivals', 'raw_bars')})"
WARNINGS_AFTER = f"SELECT ticker, \"check\", n FROM ({_long('l', [c for c in CHECKS if c[0] in quality.WARNINGS] + MOVES)})"
TEXTS = "SELECT ticker, string_agg(\"check\" || '=' || n, ', ' ORDER BY \"check\") AS t FROM"


@query(
    f"{ctes('clean_bars')}, {LAGGED}, {DROPS}, e AS ({TEXTS} ({ERRORS_BEFORE}) GROUP BY 1), w AS ({TEXTS} ({WARNINGS_AFTER}) GROUP BY 1) "
    "SELECT d.ticker, n_input, n_output, n_dropped, coalesce(e.t, '') AS errors, coalesce(w.t, '') AS warnings, true AS ok, "
    "d.ticker || ': kept ' || n_output || ' of ' || n_input || ' rows; errors: ' || coalesce(e.t, 'none') || '; warnings: ' || coalesce(w.t, 'none') AS summary FROM d LEFT JOIN e ON e.ticker = d.ticker LEFT JOIN w ON w.ticker = d.ticker"
)
def report_rows(spark, sf_dir):
    text = lambda c: F.array_join(F.transform(F.array_sort(F.map_entries(c)), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ", ").alias(c)
    return quality.report_rows(raw(spark, sf_dir)).select("ticker", "n_input", "n_output", "n_dropped", text("errors"), text("warnings"), "ok", "summary")


@query(f"{ctes('raw_bars')} SELECT ticker, n_input, n_output, CAST(sum(n) AS BIGINT) AS errors_left FROM (SELECT ticker, count(*) AS n_input, count(*) AS n_output FROM raw_bars GROUP BY 1) t JOIN ({ERRORS_BEFORE}) e USING (ticker) WHERE \"check\" NOT IN ('duplicate_dates', 'unsorted_dates') GROUP BY 1, 2, 3 ORDER BY ticker LIMIT 50")
def failing_reports(spark, sf_dir):
    """Reports of rows that nothing has cleaned: the first 50 tickers that are not ok."""
    rows = raw(spark, sf_dir)
    found = quality.quality_report(rows.drop("seq"))
    drops = rows.groupBy("ticker").agg(F.count("*").alias("n_input")).withColumns({"n_output": F.col("n_input"), "n_dropped": F.lit(0).cast("bigint")})
    bad = quality.failing(quality.reports(drops, found.limit(0), found), 50)
    left = found.where("severity = 'error'").groupBy("ticker").agg(F.sum("n").alias("errors_left"))
    return bad.select("ticker", "n_input", "n_output").join(left, "ticker")


CASES = f"SELECT ticker, date, 'price_limit_exceeded' AS \"check\", CAST(date AS VARCHAR) AS label FROM l WHERE {BROKE} UNION ALL SELECT ticker, date, 'long_gaps', before || '..' || date FROM l WHERE gap >= 30"


@query(f"{ctes('clean_bars')}, {LAGGED}, k AS (SELECT *, row_number() OVER (PARTITION BY ticker, \"check\" ORDER BY date, label) AS r FROM ({CASES})) SELECT ticker, \"check\", string_agg(CASE WHEN r <= 5 THEN label END, ', ' ORDER BY r) AS shown, count(*) AS n FROM k GROUP BY 1, 2")
def report_examples(spark, sf_dir):
    shown = F.transform("shown", lambda x: F.when(F.col("check") == "price_limit_exceeded", F.substring(x, 1, 10)).otherwise(x))
    return quality.examples(clean(spark, sf_dir)).select("ticker", "check", F.array_join(shown, ", ").alias("shown"), "n")


COVERAGE = 'SELECT ticker, min(date) AS "first", max(date) AS "last", count(*) AS bars, count(DISTINCT year(date)) AS n_years FROM clean_bars GROUP BY ticker'


@query(f"{ctes('clean_bars')} {COVERAGE}")
def coverage(spark, sf_dir):
    return series.coverage(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')} SELECT ticker, max(date) AS watermark FROM clean_bars GROUP BY ticker")
def watermarks(spark, sf_dir):
    return series.watermarks(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')} SELECT count(*) AS n FROM clean_bars")
def bar_count(spark, sf_dir):
    return series.bar_count(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')} SELECT DISTINCT ticker FROM clean_bars")
def distinct_tickers(spark, sf_dir):
    return series.tickers(clean(spark, sf_dir))


CHUNKS = "SELECT ticker, CAST(year(date) AS INTEGER) AS year, count(*) AS n, min(date) AS \"first\", max(date) AS \"last\", ticker || ':' || year(date) AS chunk_id FROM clean_bars GROUP BY ticker, year(date)"


@query(f"{ctes('clean_bars')} {CHUNKS}")
def split_by_year(spark, sf_dir):
    return series.chunk_meta(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')} SELECT ticker, count(*) AS n FROM (SELECT ticker FROM clean_bars UNION ALL SELECT ticker FROM clean_bars WHERE date >= DATE '2001-06-01') GROUP BY ticker")
def concat_common_columns(spark, sf_dir):
    rows = clean(spark, sf_dir)
    late = rows.where(F.col("date") >= dt.date(2001, 6, 1)).drop("splits")
    return series.concat(rows, late).groupBy("ticker").agg(F.count("*").alias("n"))


ENCODED = ", ".join(f"CAST(round_even({c} * 10000, 0) AS INTEGER) AS {c}" for c in PRICES)


@query(f"{ctes('clean_bars')} SELECT ticker, CAST(date - DATE '1970-01-01' AS INTEGER) AS date, {ENCODED}, CAST(round_even(volume, 0) AS BIGINT) AS volume FROM clean_bars")
def fixed_point_encode(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return rows.select("ticker", codec.pack_date(F.col("date")).alias("date"), *(codec.pack_price(F.col(c)).alias(c) for c in PRICES), codec.pack_volume(F.col("volume")).alias("volume"))


@query(f"{ctes('clean_bars')} SELECT ticker, date, " + ", ".join(f"CAST(round_even({c} * 10000, 0) AS INTEGER) / CAST(10000 AS DOUBLE) AS {c}" for c in PRICES) + ", CAST(CAST(round_even(volume, 0) AS BIGINT) AS DOUBLE) AS volume FROM clean_bars")
def fixed_point_roundtrip(spark, sf_dir):
    rows = fixed_point_encode(spark, sf_dir)
    return rows.select("ticker", codec.unpack_date(F.col("date")).alias("date"), *(codec.unpack_price(F.col(c)).alias(c) for c in PRICES), codec.unpack_volume(F.col("volume")).alias("volume"))


@query(f"{ctes('clean_bars')}, i AS (SELECT *, CAST(row_number() OVER (PARTITION BY ticker, year(date) ORDER BY date) - 1 AS INTEGER) AS row FROM clean_bars) SELECT ticker, CAST(year(date) AS INTEGER) AS year, kind, row, CAST(round_even(v * 10000, 0) AS INTEGER) AS value FROM (SELECT ticker, date, row, 'dividends' AS kind, dividends AS v FROM i UNION ALL SELECT ticker, date, row, 'splits', splits FROM i) WHERE v <> 0")
def sparse_actions(spark, sf_dir):
    return codec.sparse_actions(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')} SELECT ticker, date, CAST(round_even(dividends * 10000, 0) AS INTEGER) / CAST(10000 AS DOUBLE) AS dividends, splits FROM clean_bars")
def sparse_actions_restored(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return codec.restore_actions(rows, codec.sparse_actions(rows)).select("ticker", "date", "dividends", "splits")


def _bytes(value: str, size: int) -> str:
    """Hex of a number's low bytes, least significant first, in DuckDB."""
    cells = ", ".join(f"CAST((({value}) >> {8 * k}) & 255 AS INTEGER)" for k in range(size))
    return f"printf('{'%02x' * size}', {cells})"


def _buffer(name: str, body: str) -> str:
    return f"CASE WHEN coalesce({body}, '') = '' THEN '' ELSE '{name.encode().hex()}' || {_bytes(f'CAST(length({body}) // 2 AS BIGINT)', 4)} || {body} END"


SCALED = {c: f"CASE WHEN {c} IS NULL THEN 2147483648 ELSE CAST(round_even({c} * 10000, 0) AS BIGINT) END" for c in PRICES}
BUFFERS = {"date": f"string_agg({_bytes("CAST(date - DATE '1970-01-01' AS BIGINT)", 4)}, '' ORDER BY date)"}
BUFFERS |= {c: f"string_agg({_bytes(SCALED[c], 4)}, '' ORDER BY date)" for c in PRICES}
BUFFERS["volume"] = f"string_agg({_bytes('CAST(round_even(volume, 0) AS BIGINT)', 8)}, '' ORDER BY date)"
for _k in ("dividends", "splits"):
    BUFFERS[f"{_k}.i"] = f"string_agg({_bytes('i', 4)}, '' ORDER BY date) FILTER ({_k} <> 0)"
    BUFFERS[f"{_k}.v"] = f"string_agg({_bytes(f'CAST(round_even({_k} * 10000, 0) AS BIGINT)', 4)}, '' ORDER BY date) FILTER ({_k} <> 0)"


def _digests(rows: str) -> str:
    """ticker, year, n, first, last, sha256 of the rows of a table."""
    parts = ", ".join(f'{v} AS "{k}"' for k, v in BUFFERS.items())
    framed = " || ".join(_buffer(k, f'"{k}"') for k in BUFFERS)
    return (
        f'SELECT ticker, year, n, "first", "last", sha256(unhex({framed})) AS sha256 FROM (SELECT ticker, CAST(year(date) AS INTEGER) AS year, count(*) AS n, min(date) AS "first", max(date) AS "last", {parts} '
        f"FROM (SELECT *, row_number() OVER (PARTITION BY ticker, year(date) ORDER BY date) - 1 AS i FROM {rows}) GROUP BY 1, 2)"
    )


@query(f"{ctes('clean_bars')} {_digests('clean_bars')}")
def chunk_checksum(spark, sf_dir):
    return codec.chunk_checksums(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')} SELECT *, 'open,high,low,close,adj_close,volume' AS columns, CAST(10000 AS INTEGER) AS price_scale, CAST(1 AS INTEGER) AS schema_version, 'cols-v1' AS codec, n * 4 AS date_bytes, n * 8 AS volume_bytes FROM ({_digests('clean_bars')})")
def encode_chunks(spark, sf_dir):
    rows = codec.encode_chunks(clean(spark, sf_dir))
    sizes = [F.octet_length(f"b_{c}").cast("bigint").alias(f"{c}_bytes") for c in ("date", "volume")]
    return rows.select("ticker", "year", "n", "first", "last", "sha256", F.array_join("columns", ",").alias("columns"), "price_scale", "schema_version", "codec", *sizes)


def _rounded(c: str) -> str:
    return f"CAST(round_even({c} * 10000, 0) AS BIGINT) / CAST(10000 AS DOUBLE) AS {c}"


@query(f"{ctes('clean_bars')} SELECT ticker, date, {_rounded('close')}, volume, {_rounded('dividends')} FROM clean_bars")
def decode_chunks(spark, sf_dir):
    """Some fields of encoded chunks, after their digests are verified."""
    return codec.decode_chunks(codec.encode_chunks(clean(spark, sf_dir)), ["close", "volume", "dividends", "nonsense"], verify=True)


@query(f"{ctes('raw_bars')} SELECT DISTINCT ticker, CAST(year(date) AS INTEGER) AS year, 'dates do not increase' AS problem FROM (SELECT *, lag(date) OVER (PARTITION BY ticker, year(date) ORDER BY volume, date, seq) AS before FROM raw_bars) WHERE date <= before")
def chunk_problems(spark, sf_dir):
    from pyspark.sql import Window

    order = Window.partitionBy("ticker").orderBy("volume", "date", "seq")
    return codec.chunk_problems(raw(spark, sf_dir).withColumn("seq", F.row_number().over(order)))


TAMPERED = "t AS (SELECT * REPLACE (CASE WHEN CAST(ticker AS INT) % 7 = 3 AND year(date) = 1997 THEN close + 1 ELSE close END AS close) FROM clean_bars WHERE NOT (CAST(ticker AS INT) % 5 = 2 AND year(date) = 1996)), k AS (SELECT DISTINCT ticker, CAST(year(date) AS INTEGER) AS year FROM clean_bars)"


def _tampered(rows: DataFrame) -> DataFrame:
    """Some chunks gone, some with another close; a manifest that has not heard of some others makes those extra."""
    t, y = F.col("ticker").cast("int"), F.year("date")
    return rows.where(~((t % 5 == 2) & (y == 1996))).withColumn("close", F.when((t % 7 == 3) & (y == 1997), F.col("close") + 1).otherwise(F.col("close")))


@query(f"{ctes('clean_bars')}, {TAMPERED} SELECT ticker, year, CASE WHEN CAST(ticker AS INT) % 5 = 2 AND year = 1996 THEN 'missing' WHEN CAST(ticker AS INT) % 9 = 4 THEN 'extra' WHEN CAST(ticker AS INT) % 7 = 3 AND year = 1997 THEN 'corrupt' ELSE 'ok' END AS state FROM k WHERE NOT (CAST(ticker AS INT) % 9 = 4 AND CAST(ticker AS INT) % 5 = 2 AND year = 1996)")
def verify_checksums(spark, sf_dir):
    """Tampered bars against the manifest that was stored with the sound ones."""
    rows = clean(spark, sf_dir)
    held = _stored(spark, rows, "verify")
    manifest = held.manifest().where(F.col("ticker").cast("int") % 9 != 4)
    return codec.verify_chunks(_tampered(rows), manifest)


@query(f"{ctes('clean_bars')}, {TAMPERED}, v AS (SELECT CASE WHEN CAST(ticker AS INT) % 5 = 2 AND year = 1996 THEN 'missing' WHEN CAST(ticker AS INT) % 7 = 3 AND year = 1997 THEN 'corrupt' ELSE 'ok' END AS state FROM k) SELECT state, count(*) AS chunks FROM v GROUP BY 1")
def verify_totals(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return flows.verify(_tampered(rows), codec.chunk_checksums(rows))


@query(f"{ctes('clean_bars')} SELECT ticker, CAST(year(date) AS INTEGER) AS year, (count(*) * 32 + 8 * sum((dividends <> 0)::INT + (splits <> 0)::INT)) / CAST(count(*) AS DOUBLE) AS bytes_per_bar FROM clean_bars GROUP BY ticker, year(date)")
def bytes_per_bar(spark, sf_dir):
    return codec.bytes_per_bar(clean(spark, sf_dir))


@query(f"{ctes('clean_bars', 'overlay')} SELECT {COLS} FROM overlay UNION ALL SELECT {COLS} FROM clean_bars c WHERE NOT EXISTS (SELECT 1 FROM overlay o WHERE o.ticker = c.ticker AND o.date = c.date)")
def merge_overlay(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return store.merge(rows.drop("board"), _overlay(rows))


def _overlay(rows: DataFrame) -> DataFrame:
    late = rows.where((F.col("date") >= dt.date(2001, 6, 1)) & (F.col("ticker").cast("int") % 4 == 0))
    return late.drop("board").withColumn("close", F.col("close") * 1.01)


SAME = " AND ".join(f"o.{c} IS NOT DISTINCT FROM c.{c}" for c in FIELDS)


@query(
    f"{ctes('clean_bars', 'overlay')}, i AS (SELECT {COLS} FROM overlay UNION ALL SELECT {COLS} FROM clean_bars WHERE CAST(ticker AS INT) % 4 = 1 UNION ALL SELECT ticker || 'x', {COLS.removeprefix('ticker, ')} FROM clean_bars WHERE ticker = '2'), "
    "n AS (SELECT ticker, year(date) AS y, count(*) AS n FROM i GROUP BY 1, 2), s AS (SELECT ticker, year(date) AS y, count(*) AS n FROM clean_bars GROUP BY 1, 2), "
    f"m AS (SELECT o.ticker, year(o.date) AS y, count(*) AS n FROM i o JOIN clean_bars c ON c.ticker = o.ticker AND c.date = o.date AND {SAME} GROUP BY 1, 2) "
    "SELECT n.ticker, CAST(n.y AS INTEGER) AS year, CASE WHEN s.n IS NULL THEN 'inserted' WHEN s.n = n.n AND m.n = n.n THEN 'unchanged' ELSE 'updated' END AS outcome FROM n LEFT JOIN s ON s.ticker = n.ticker AND s.y = n.y LEFT JOIN m ON m.ticker = n.ticker AND m.y = n.y"
)
def upsert_outcomes(spark, sf_dir):
    rows = clean(spark, sf_dir)
    body = rows.drop("board")
    fresh = body.where("ticker = '2'").withColumn("ticker", F.concat("ticker", F.lit("x")))
    incoming = _overlay(rows).unionByName(body.where(F.col("ticker").cast("int") % 4 == 1)).unionByName(fresh)
    return store.outcomes(codec.chunk_checksums(body), incoming)


@query(f"{ctes('clean_bars', 'overlay')}, k AS (SELECT DISTINCT ticker, year(date) AS y FROM overlay) SELECT {COLS} FROM overlay UNION ALL SELECT {COLS} FROM clean_bars c WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.ticker = c.ticker AND k.y = year(c.date))")
def upsert_series(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return store.upsert_series(rows.drop("board"), _overlay(rows)).select("ticker", "date", *FIELDS)


@query(f"{ctes('clean_bars')}, t AS (SELECT DISTINCT ticker FROM clean_bars UNION ALL SELECT 'fresh'), w AS (SELECT ticker, max(date) AS m FROM clean_bars GROUP BY 1) SELECT t.ticker, m IS NULL AS is_new, CAST(coalesce(greatest(m - 10, DATE '1995-01-01'), DATE '1995-01-01') AS DATE) AS start FROM t LEFT JOIN w ON w.ticker = t.ticker")
def incremental_plan(spark, sf_dir):
    rows = clean(spark, sf_dir)
    names = series.tickers(rows).union(spark.createDataFrame([("fresh",)], "ticker string"))
    return flows.fetch_plan(names, series.watermarks(rows), Horizon(dt.date(1995, 1, 1)))


@query(f"{ctes('clean_bars')}, w AS (SELECT ticker, max(date) AS m FROM clean_bars GROUP BY 1) SELECT CAST(greatest(m - 10, DATE '1995-01-01') AS DATE) AS start, count(*) AS n, min(ticker) AS first_ticker FROM w GROUP BY 1")
def fetch_groups(spark, sf_dir):
    rows = clean(spark, sf_dir)
    return flows.fetch_groups(flows.fetch_plan(series.tickers(rows), series.watermarks(rows), Horizon(dt.date(1995, 1, 1))))


STORED = "stored AS (SELECT (CASE CAST(ticker AS INT) WHEN 1 THEN '600000.SS' WHEN 2 THEN '688003.SS' ELSE ticker END) AS ticker FROM clean_bars)"


@query(f"{ctes('clean_bars', 'master')}, {STORED} SELECT ticker FROM master WHERE status = 'active' AND ticker NOT IN (SELECT ticker FROM stored)")
def missing_only(spark, sf_dir):
    t = F.col("ticker")
    stored = clean(spark, sf_dir).select(F.when(t == "1", "600000.SS").when(t == "2", "688003.SS").otherwise(t).alias("ticker"))
    return master.missing_only(view(spark, sf_dir, "master"), stored)


def _sessions(base: str, quorum: float) -> str:
    spans = f"s AS (SELECT ticker, min(date) AS a, max(date) AS b FROM {base} GROUP BY 1), d AS (SELECT date, count(*) AS prints FROM {base} GROUP BY 1)"
    live = "v AS (SELECT d.date, d.prints, CAST((SELECT count(*) FROM s WHERE d.date BETWEEN a AND b) AS BIGINT) AS live FROM d)"
    return f"{spans}, {live}, sessions AS (SELECT date, prints, live FROM v WHERE prints >= CAST({quorum} AS DOUBLE) * live)"


@query(f"{ctes('event_bars')}, {_sessions('event_bars', 0.5)} SELECT * FROM sessions")
def infer_sessions(spark, sf_dir):
    return calendar.infer_sessions(view(spark, sf_dir, "event_bars"), 0.5)


@query(f"{ctes('clean_bars')}, {_sessions('clean_bars', 0.18)} SELECT * FROM sessions")
def infer_sessions_bars(spark, sf_dir):
    return calendar.infer_sessions(clean(spark, sf_dir), 0.18)


MISSING = "g AS (SELECT s.ticker, c.date FROM s JOIN sessions c ON c.date BETWEEN s.a AND s.b WHERE NOT EXISTS (SELECT 1 FROM event_bars e WHERE e.ticker = s.ticker AND e.date = c.date))"


@query(f"{ctes('event_bars')}, {_sessions('event_bars', 0.5)}, {MISSING} SELECT * FROM g")
def missing_sessions(spark, sf_dir):
    rows = view(spark, sf_dir, "event_bars")
    return calendar.missing_sessions(rows, calendar.infer_sessions(rows, 0.5))


@query(f"{ctes('event_bars')}, {_sessions('event_bars', 0.5)} SELECT s.ticker, c.date FROM s, sessions c WHERE NOT EXISTS (SELECT 1 FROM event_bars e WHERE e.ticker = s.ticker AND e.date = c.date)")
def missing_sessions_whole_calendar(spark, sf_dir):
    rows = view(spark, sf_dir, "event_bars")
    return calendar.missing_sessions(rows, calendar.infer_sessions(rows, 0.5), within_coverage_only=False)


@query(f"{ctes('event_bars')}, {_sessions('event_bars', 0.5)}, {MISSING} SELECT ticker, count(*) AS missing FROM g GROUP BY ticker ORDER BY missing DESC, ticker LIMIT 20")
def most_suspended_topk(spark, sf_dir):
    rows = view(spark, sf_dir, "event_bars")
    return calendar.suspensions(rows, calendar.infer_sessions(rows, 0.5))


@query(f"{ctes('clean_bars')}, {_sessions('clean_bars', 0.18)} SELECT date, 'weekend' AS issue FROM sessions WHERE isodow(date) >= 6 UNION ALL SELECT date, 'holiday' FROM sessions WHERE (month(date) = 1 AND day(date) = 1) OR (month(date) = 5 AND day(date) = 1) OR (month(date) = 10 AND day(date) <= 7)")
def calendar_sanity(spark, sf_dir):
    return calendar.calendar_sanity(calendar.infer_sessions(clean(spark, sf_dir), 0.18))


@query("SELECT CAST(d AS DATE) AS date FROM (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS d) WHERE isodow(d) < 6")
def weekdays_between(spark, sf_dir):
    return calendar.weekdays_between(spark, dt.date(2024, 1, 1), dt.date(2025, 12, 31))


@query("SELECT DATE '2024-01-01' AS \"first\", DATE '2024-12-31' AS \"last\"")
def year_bounds(spark, sf_dir):
    return calendar.year_bounds(spark, 2024)


BLOCK = "CASE substr(code, 1, 3) " + " ".join(f"WHEN '{b}' THEN '{name}'" for b, name in BLOCKS.items()) + " ELSE 'unknown' END"
BOARD = "CASE substr(code, 1, 3) " + " ".join(f"WHEN '{b}' THEN '{name}'" for b, name in BOARDS.items()) + " ELSE 'other' END"
NAMED = f"c AS (SELECT *, {BLOCK} AS instrument, {BOARD} AS board FROM listings), e AS (SELECT *, instrument IN {EQUITIES} AS is_equity FROM c)"


@query(f"{ctes('listings')}, {NAMED} SELECT code, instrument, board, code || '.SS' AS symbol, is_equity FROM e")
def classify_codes(spark, sf_dir):
    return universe.classify(view(spark, sf_dir, "listings")).select("code", "instrument", "board", "symbol", "is_equity")


@query(f"{ctes('listings')}, {NAMED} SELECT block, string_agg(code, ',' ORDER BY code) AS codes FROM c WHERE instrument = 'unknown' GROUP BY block")
def unknown_blocks(spark, sf_dir):
    return universe.unknown_blocks(view(spark, sf_dir, "listings")).select("block", F.array_join("codes", ",").alias("codes"))


@query(
    f"{ctes('listings')}, {NAMED}, m AS (SELECT code, is_equity, bool_or(in_screener) AS s, bool_or(in_probe) AS p FROM e GROUP BY 1, 2), "
    "r AS (SELECT count(*) FILTER (is_equity AND s) AS screener_total, count(*) FILTER (is_equity AND p) AS probe_total, count(*) FILTER (is_equity AND (s OR p)) AS union_total, count(*) FILTER (is_equity AND s AND p) AS agreement, count(*) FILTER (is_equity AND p AND NOT s) AS probe_only, count(*) FILTER (is_equity AND s AND NOT p) AS screener_only, count(*) FILTER (NOT is_equity AND (s OR p)) AS excluded FROM m) "
    "SELECT *, coalesce(greatest(probe_only, screener_only) / CAST(nullif(union_total, 0) AS DOUBLE), 0) AS disagreement_fraction, coalesce(greatest(probe_only, screener_only) / CAST(nullif(union_total, 0) AS DOUBLE), 0) <= CAST(0.1 AS DOUBLE) AS passes FROM r"
)
def reconcile_methods(spark, sf_dir):
    return universe.gate(universe.reconcile(view(spark, sf_dir, "listings")), unresolved_probes=0)


@query(f"{ctes('listings')} SELECT ticker, bool_or(in_screener) AS in_screener, bool_or(in_probe) AS in_probe FROM listings GROUP BY ticker HAVING bool_or(in_screener) OR bool_or(in_probe)")
def method_membership(spark, sf_dir):
    rows = view(spark, sf_dir, "listings")
    return universe.membership(rows.where("in_screener"), rows.where("in_probe"))


@query(f"{ctes('listings')}, {NAMED} SELECT instrument, count(*) AS n FROM c GROUP BY instrument")
def instrument_counts(spark, sf_dir):
    return universe.instrument_counts(view(spark, sf_dir, "listings"))


@query(f"{ctes('listings')}, {NAMED} SELECT board, count(*) AS n FROM e WHERE is_equity GROUP BY board")
def board_counts(spark, sf_dir):
    return universe.board_counts(view(spark, sf_dir, "listings"))


CANDIDATES = "SELECT p || right('000' || i, 3) AS code, p AS prefix FROM (SELECT unnest(['600', '601', '603', '605', '688', '689', '900']) AS p), (SELECT unnest(range(1000)) AS i)"


@query(CANDIDATES)
def candidate_codes(spark, sf_dir):
    return universe.candidate_codes(spark)


ANSWERS = "a AS (SELECT code, bool_or(in_probe) AS found, bool_or(CASE WHEN in_screener THEN false ELSE true END AND NOT in_probe) AS failed FROM listings GROUP BY code)"


@query(f"{ctes('listings')}, {ANSWERS}, k AS ({CANDIDATES}) SELECT k.code, CASE WHEN found THEN 'present' WHEN failed THEN 'unknown' ELSE 'absent' END AS outcome FROM k LEFT JOIN a ON a.code = k.code")
def probe_outcomes(spark, sf_dir):
    message = F.when(F.col("in_screener"), "No data found, symbol may be delisted").otherwise("HTTP 503: temporarily unavailable")
    answers = view(spark, sf_dir, "listings").select("code", F.col("in_probe").alias("found"), (~F.col("in_probe") & is_transient(message)).alias("failed"))
    return universe.probe_outcomes(universe.candidate_codes(spark), answers)


BISECT = f"""
b(low, high, depth, n) AS (
  SELECT CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE), 0, (SELECT count(*) FROM listings WHERE market_cap BETWEEN 0 AND CAST({CAP_CEILING} AS DOUBLE))
  UNION ALL
  SELECT CASE side WHEN 0 THEN low ELSE mid END, CASE side WHEN 0 THEN mid ELSE high END, depth + 1,
         (SELECT count(*) FROM listings WHERE market_cap BETWEEN (CASE side WHEN 0 THEN low ELSE mid END) AND coalesce(CASE side WHEN 0 THEN mid ELSE high END, CAST({CAP_CEILING} AS DOUBLE)))
  FROM (SELECT *, sqrt(greatest(low, 1) * coalesce(high, CAST({CAP_CEILING} AS DOUBLE))) AS mid FROM b) x, (SELECT unnest([0, 1]) AS side)
  WHERE n >= 100 AND depth < 12 AND (high IS NULL OR (high > {MIN_RESOLVABLE_CAP} AND NOT (low > 0 AND high / low < CAST(1.01 AS DOUBLE)) AND mid > low * CAST(1.000001 AS DOUBLE))))
"""


@query(
    ctes("listings").replace("WITH", "WITH RECURSIVE", 1)
    + f", {BISECT} SELECT round(low, 2) AS low, round(high, 2) AS high, depth, least(n, 100) AS n_returned, n >= 100 AS saturated FROM (SELECT *, sqrt(greatest(low, 1) * coalesce(high, CAST({CAP_CEILING} AS DOUBLE))) AS mid FROM b) WHERE NOT (n >= 100 AND depth < 12 AND (high IS NULL OR (high > {MIN_RESOLVABLE_CAP} AND NOT (low > 0 AND high / low < CAST(1.01 AS DOUBLE)) AND mid > low * CAST(1.000001 AS DOUBLE))))"
)
def band_bisection(spark, sf_dir):
    rows = universe.bands_frame(spark, universe.screen_bands(view(spark, sf_dir, "listings"), ceiling=100))
    return rows.select(F.round("low", 2).alias("low"), F.round("high", 2).alias("high"), "depth", "n_returned", "saturated")


BATCHES = "x AS (SELECT ticker, min(name) AS name FROM listings WHERE in_screener GROUP BY 1), y AS (SELECT ticker, max(name) AS name FROM listings WHERE in_probe GROUP BY 1)"
DAY1, DAY2 = dt.datetime(2026, 8, 11), dt.datetime(2026, 8, 12)


def _batch(rows: DataFrame, flag: str, pick: Callable) -> DataFrame:
    return rows.where(flag).groupBy("ticker").agg(pick("name").alias("name"))


def _first(spark: SparkSession, rows: DataFrame) -> DataFrame:
    none = spark.createDataFrame([], "ticker string, name string")
    return master.upsert(none, _batch(rows, "in_screener", F.min), "screener", DAY1)


@query(
    f"{ctes('listings')}, {BATCHES} SELECT coalesce(x.ticker, y.ticker) AS ticker, coalesce(y.name, x.name) AS name, 'active' AS status, CASE WHEN x.ticker IS NULL THEN DATE '2026-08-12' ELSE DATE '2026-08-11' END AS first_seen, CASE WHEN y.ticker IS NULL THEN DATE '2026-08-11' ELSE DATE '2026-08-12' END AS last_seen, CASE WHEN y.ticker IS NULL THEN 'screener' ELSE 'probe' END AS last_source FROM x FULL JOIN y ON x.ticker = y.ticker"
)
def master_upsert(spark, sf_dir):
    rows = view(spark, sf_dir, "listings")
    out = master.upsert(_first(spark, rows), _batch(rows, "in_probe", F.max), "probe", DAY2)
    return out.select("ticker", "name", "status", F.to_date("first_seen").alias("first_seen"), F.to_date("last_seen").alias("last_seen"), "last_source")


@query(f"{ctes('listings')}, {BATCHES} SELECT count(*) AS seen, count(*) FILTER (x.ticker IS NULL) AS inserted, count(*) FILTER (x.ticker IS NOT NULL) AS modified FROM y LEFT JOIN x ON x.ticker = y.ticker")
def master_upsert_counts(spark, sf_dir):
    rows = view(spark, sf_dir, "listings")
    return master.upsert_counts(_first(spark, rows), _batch(rows, "in_probe", F.max))


@query(f"{ctes('listings')}, {BATCHES} SELECT x.ticker, CASE WHEN y.ticker IS NULL THEN 'inactive' ELSE 'active' END AS status, CASE WHEN y.ticker IS NULL THEN DATE '2026-08-12' END AS inactive_since FROM x LEFT JOIN y ON y.ticker = x.ticker")
def mark_inactive(spark, sf_dir):
    rows = view(spark, sf_dir, "listings")
    known = _first(spark, rows)
    gone = master.vanished(known, _batch(rows, "in_probe", F.max).select("ticker"), spark.createDataFrame([], "ticker string"), complete=True)
    return master.mark_inactive(known, gone, DAY2).select("ticker", "status", F.to_date("inactive_since").alias("inactive_since"))


@query(f"{ctes('listings')}, m AS (SELECT ticker, min(name) AS name FROM listings GROUP BY 1) SELECT ticker, name FROM m WHERE regexp_matches(ticker, '60[01]') OR regexp_matches(name, '(?i)60[01]') ORDER BY ticker LIMIT 25 OFFSET 10")
def search_securities(spark, sf_dir):
    rows = view(spark, sf_dir, "listings").groupBy("ticker").agg(F.min("name").alias("name"))
    return master.page(master.search(rows, query="60[01]"), limit=25, skip=10)


@query(f"{ctes('master')} SELECT ticker FROM master WHERE status = 'active' AND (run_id IS DISTINCT FROM 'r1' OR NOT coalesce(ingest_state IN ('ok', 'empty'), false))")
def pending_tickers(spark, sf_dir):
    return master.pending(view(spark, sf_dir, "master"), "r1")


@query(f"{ctes('master')} SELECT ticker FROM master WHERE status = 'active' AND board = 'main'")
def list_tickers(spark, sf_dir):
    return master.list_tickers(view(spark, sf_dir, "master"), board="main")


@query(f"{ctes('master')} SELECT coalesce(status, 'unknown') AS status, count(*) AS n FROM master GROUP BY 1")
def status_counts(spark, sf_dir):
    return master.status_counts(view(spark, sf_dir, "master"))


@query(f"{ctes('master')} SELECT * FROM master WHERE ticker = '600001.SS'")
def get_security(spark, sf_dir):
    return master.get(view(spark, sf_dir, "master"), "600001.SS")


@query(f"{ctes('master')} SELECT t AS ticker, t IN (SELECT ticker FROM master) AS known FROM (SELECT unnest(['600001.SS', '600999.SS', 'none-such']) AS t)")
def security_exists(spark, sf_dir):
    rows = view(spark, sf_dir, "master")
    return spark.createDataFrame([(t, master.exists(rows, t)) for t in ("600001.SS", "600999.SS", "none-such")], "ticker string, known boolean")


@query(f"{ctes('master')} SELECT ticker, CASE WHEN ticker = '600001.SS' THEN 'ok' ELSE ingest_state END AS state, CASE WHEN ticker = '600001.SS' THEN 'r9' ELSE run_id END AS run_id, CASE WHEN ticker = '600001.SS' THEN DATE '2026-08-12' END AS updated_on FROM master")
def set_ingest_state(spark, sf_dir):
    rows = view(spark, sf_dir, "master").withColumn("ingest", F.struct(F.col("ingest_state").alias("state"), "run_id", F.lit(None).cast("timestamp_ntz").alias("updated_at")))
    out = master.set_ingest_state(rows.select("ticker", "ingest"), "600001.SS", "ok", DAY2, run_id="r9")
    return out.select("ticker", "ingest.state", "ingest.run_id", F.to_date("ingest.updated_at").alias("updated_on"))


@query(f"{ctes('master')} SELECT ticker FROM master WHERE status = 'active' AND (run_id IS DISTINCT FROM 'r1' OR NOT coalesce(ingest_state IN ('ok', 'empty'), false)) AND ticker NOT IN (SELECT ticker FROM master WHERE ticker LIKE '601%') ORDER BY ticker LIMIT 40")
def backfill_todo(spark, sf_dir):
    """What a resumed backfill of missing names would ask for first."""
    rows = view(spark, sf_dir, "master")
    return flows.todo(rows, rows.where("ticker LIKE '601%'"), run_id="r1", missing=True, limit=40)


def _arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "snapshots").groupBy("run_id", "source", "taken_at").agg(F.sort_array(F.collect_list("symbol")).alias("symbols"))


@query(f"{ctes('snapshots')} SELECT DISTINCT symbol FROM snapshots")
def snapshot_union(spark, sf_dir):
    return runs.snapshot_union(_arrays(spark, sf_dir))


@query(f"{ctes('snapshots')} SELECT run_id, source, taken_at, symbol FROM (SELECT *, rank() OVER (PARTITION BY source ORDER BY taken_at DESC) AS r FROM snapshots) WHERE r = 1")
def latest_snapshot(spark, sf_dir):
    return runs.latest_by_source(view(spark, sf_dir, "snapshots"))


@query(f"{ctes('snapshots')} SELECT DISTINCT run_id, source, taken_at FROM snapshots ORDER BY taken_at DESC, run_id, source LIMIT 20")
def snapshot_history(spark, sf_dir):
    return runs.history(_arrays(spark, sf_dir))


@query(f"{ctes('listings')} SELECT 'u1' AS run_id, 'screener' AS source, DATE '2026-08-12' AS taken_on, CAST(count(DISTINCT ticker) AS INTEGER) AS n_symbols, string_agg(DISTINCT ticker, ' ' ORDER BY ticker) AS symbols FROM listings WHERE in_screener")
def record_snapshot(spark, sf_dir):
    """A snapshot, appended to those at a path and read again."""
    path = scratch(spark, "snapshots")
    flows.persist_snapshot(view(spark, sf_dir, "listings").where("in_screener").select("ticker"), "u1", "screener", DAY2, path)
    return spark.read.parquet(path).select("run_id", "source", F.to_date("taken_at").alias("taken_on"), "n_symbols", F.array_join("symbols", " ").alias("symbols"))


@query(f"{ctes('runs')} SELECT * FROM runs WHERE status = 'running' AND coalesce(heartbeat_at, started_at) >= DATE '2001-07-01'")
def active_runs(spark, sf_dir):
    return runs.active(view(spark, sf_dir, "runs"), dt.date(2001, 7, 1))


@query(f"{ctes('runs')} SELECT * FROM runs WHERE kind = 'update' ORDER BY started_at DESC, id LIMIT 1")
def latest_run(spark, sf_dir):
    return runs.latest(view(spark, sf_dir, "runs"), "update")


@query(f"{ctes('runs')} SELECT * FROM runs ORDER BY started_at DESC, id LIMIT 10")
def recent_runs(spark, sf_dir):
    return runs.recent(view(spark, sf_dir, "runs").withColumn("errors", F.array(F.lit("x"))))


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run events from orders: each starts, most are heard of, ended ones finish with counters and a list of errors."""
    rows = view(spark, sf_dir, "runs")
    key = F.col("id").cast("bigint")
    blank = {"counters": "map<string, bigint>", "errors": "array<string>", "note": "string"}
    none = [F.lit(None).cast(t).alias(c) for c, t in blank.items()]
    start = rows.select("id", F.lit("start").alias("event"), F.col("started_at").cast("timestamp_ntz").alias("at"), "kind", F.lit("running").alias("status"), *none)
    beat = rows.where("heartbeat_at IS NOT NULL").select("id", F.lit("heartbeat").alias("event"), F.col("heartbeat_at").cast("timestamp_ntz").alias("at"), F.lit(None).cast("string").alias("kind"), F.lit(None).cast("string").alias("status"), F.create_map(F.lit("ok"), key % 10).alias("counters"), *none[1:])
    errors = F.when(key % 50 > 0, F.transform(F.sequence(F.lit(1), (key % 50 * 10).cast("int")), lambda i: F.concat(F.lit("e"), i.cast("string"))))
    end = rows.where("status <> 'running'").select("id", F.lit("finish").alias("event"), F.date_add("started_at", 60).cast("timestamp_ntz").alias("at"), F.lit(None).cast("string").alias("kind"), "status", F.create_map(F.lit("ok"), key % 100).alias("counters"), errors.alias("errors"), F.lit("done").alias("note"))
    return start.unionByName(beat).unionByName(end)


@query(
    f"{ctes('runs')} SELECT id, kind, status, started_at AS started_on, heartbeat_at AS heard_on, CASE WHEN status <> 'running' THEN started_at + 60 END AS finished_on, CASE WHEN status <> 'running' THEN CAST(id AS BIGINT) % 100 WHEN heartbeat_at IS NOT NULL THEN CAST(id AS BIGINT) % 10 END AS ok, "
    "CAST(CASE WHEN status <> 'running' THEN CAST(id AS BIGINT) % 50 * 10 ELSE 0 END AS INTEGER) AS error_count, CAST(CASE WHEN status <> 'running' THEN least(200, CAST(id AS BIGINT) % 50 * 10) ELSE 0 END AS INTEGER) AS errors_shown FROM runs"
)
def run_states(spark, sf_dir):
    """Runs as their events leave them: started, heard of, finished, with counters and at most 200 errors shown."""
    now = runs.current(_events(spark, sf_dir))
    days = [F.to_date(c).alias(n) for c, n in (("started_at", "started_on"), ("heartbeat_at", "heard_on"), ("finished_at", "finished_on"))]
    return now.select("id", "kind", "status", *days, F.try_element_at("counters", F.lit("ok")).alias("ok"), "error_count", F.coalesce(F.size("errors"), F.lit(0)).alias("errors_shown"))


AGES = "CASE WHEN s >= 86400 THEN (s // 86400) || ' d ago' WHEN s >= 3600 THEN (s // 3600) || ' h ago' ELSE (s // 60) || ' min ago' END"


@query(f"{ctes('runs')}, a AS (SELECT id, kind, status, CAST(epoch(TIMESTAMP '2001-08-01 10:30:00' - CAST(coalesce(CASE WHEN status <> 'running' THEN started_at + 60 END, heartbeat_at, started_at) AS TIMESTAMP)) AS BIGINT) AS s FROM runs) SELECT id, kind || ' ' || status || ', ' || {AGES} AS run FROM a WHERE s >= 0")
def run_texts(spark, sf_dir):
    now = runs.current(_events(spark, sf_dir))
    at = F.lit("2001-08-01 10:30:00").cast("timestamp_ntz")
    return status.run_text(now.where(F.coalesce("finished_at", "heartbeat_at", "started_at") <= at), at)


@query(f"SELECT i AS seconds, {AGES.replace('s ', 'i ').replace('(s', '(i')} AS age FROM (SELECT unnest(range(0, 400000, 700)) AS i)")
def age_texts(spark, sf_dir):
    return spark.range(0, 400_000, 700).select(F.col("id").alias("seconds"), age_text(F.col("id")).alias("age"))


@query("SELECT c_custkey, 'mongodb+srv://u' || c_custkey || ':***@host/db' AS uri FROM customer")
def redacted_uris(spark, sf_dir):
    key = F.col("c_custkey").cast("string")
    uri = F.concat(F.lit("mongodb+srv://u"), key, F.lit(":pw"), key, F.lit("x@host/db"))
    return spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", redacted(uri).alias("uri"))


@query(f"{ctes('clean_bars')}, c AS ({CHUNKS}) SELECT count(*) AS chunks, CAST(sum(n) AS BIGINT) AS bars, count(DISTINCT ticker) AS tickers, min(\"first\") AS \"first\", max(\"last\") AS \"last\", max(n) AS largest_chunk FROM c")
def integrity_summary(spark, sf_dir):
    return flows.integrity_summary(clean(spark, sf_dir))


@query(f"{ctes('clean_bars')}, {_sessions('clean_bars', 0.18)}, g AS (SELECT s.ticker, count(*) AS missing FROM s JOIN sessions c ON c.date BETWEEN s.a AND s.b WHERE NOT EXISTS (SELECT 1 FROM clean_bars e WHERE e.ticker = s.ticker AND e.date = c.date) GROUP BY 1), v2 AS ({COVERAGE}) SELECT v2.*, coalesce(missing, 0) AS missing FROM v2 LEFT JOIN g ON g.ticker = v2.ticker")
def integrity_audit(spark, sf_dir):
    return flows.audit(raw(spark, sf_dir), 0.18)


@query(f"{ctes('clean_bars')} SELECT ticker, severity, \"check\", n FROM (SELECT '' AS ticker, '' AS severity, '' AS \"check\", CAST(0 AS BIGINT) AS n) WHERE false")
def sanitize_invariant(spark, sf_dir):
    return flows.invariant(raw(spark, sf_dir))


@query(f"{ctes('clean_bars')} SELECT ticker, date, close, volume FROM clean_bars")
def columnar_json(spark, sf_dir):
    """Bars out to one JSON object a ticker, and read back from it."""
    docs = sources.columnar_json(clean(spark, sf_dir), ("close", "volume"))
    held = F.from_json("doc", "date array<date>, close array<double>, volume array<bigint>")
    return docs.select("ticker", F.inline(F.arrays_zip(held["date"], held["close"], held["volume"]))).toDF("ticker", "date", "close", "volume").withColumn("volume", F.col("volume").cast("double"))


@query(f"{ctes('clean_bars')} {COVERAGE}")
def json_report(spark, sf_dir):
    """A report of coverage, written as JSON and read back."""
    path = scratch(spark, "report")
    rows = series.coverage(clean(spark, sf_dir))
    sources.write_report(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query(f"{ctes('event_bars')} SELECT * FROM event_bars")
def event_daily_bars(spark, sf_dir):
    return daily_bars(spark.read.parquet(f"{sf_dir}/events.parquet"))


def _stored(spark: SparkSession, rows: DataFrame, label: str) -> Store:
    """A store of its own that holds the rows."""
    held = Store(spark, scratch(spark, label))
    held.create()
    held.replace(rows.drop("board"))
    return held


@query(f"{ctes('clean_bars', 'overlay')} SELECT {COLS}, CAST(year(date) AS INTEGER) AS year FROM (SELECT {COLS} FROM overlay UNION ALL SELECT {COLS} FROM clean_bars c WHERE NOT EXISTS (SELECT 1 FROM overlay o WHERE o.ticker = c.ticker AND o.date = c.date))")
def store_merge(spark, sf_dir):
    """A merge into a stored year, after an earlier merge into others and a newer bulk load, read back."""
    path = scratch(spark, "clean")
    clean(spark, sf_dir).write.parquet(path)  # four writes read it
    rows = spark.read.parquet(path)
    held = _stored(spark, rows, "merge")
    held.merge(_overlay(rows).withColumn("close", F.col("close") * 3))
    held.replace(rows.drop("board").where(F.year("date") >= 2001))
    held.merge(_overlay(rows))
    return held.bars()


@query(f"{ctes('clean_bars', 'overlay')}, k AS (SELECT DISTINCT ticker, year(date) AS y FROM overlay) SELECT {COLS} FROM overlay UNION ALL SELECT {COLS} FROM clean_bars c WHERE NOT EXISTS (SELECT 1 FROM k WHERE k.ticker = c.ticker AND k.y = year(c.date))")
def store_upsert(spark, sf_dir):
    rows = clean(spark, sf_dir)
    held = _stored(spark, rows, "upsert")
    held.upsert(_overlay(rows))
    return held.bars().drop("year")


@query(f"{ctes('clean_bars')} SELECT {COLS} FROM clean_bars WHERE ticker <> '3'")
def store_delete(spark, sf_dir):
    """Two tickers deleted, one of them alone in its year."""
    rows = clean(spark, sf_dir)
    alone = rows.where("ticker = '4'").limit(1).withColumns({"ticker": F.lit("solo"), "date": F.lit(dt.date(2033, 3, 3))})
    held = _stored(spark, rows.unionByName(alone), "delete")
    held.delete("solo")
    held.delete("3")
    return held.bars().drop("year")


@query(f"{ctes('clean_bars')} SELECT {COLS} FROM clean_bars WHERE date BETWEEN DATE '{FROM}' AND DATE '{TO}'")
def store_pruned_read(spark, sf_dir):
    """One year of a store by its dates; only that year's folder is read."""
    return series.project(series.slice_dates(_stored(spark, clean(spark, sf_dir), "pruned").bars(), FROM, TO))


@query(f"{ctes('clean_bars')} SELECT * FROM ({_digests('clean_bars')})")
def store_manifest(spark, sf_dir):
    return _stored(spark, clean(spark, sf_dir), "manifest").manifest().select("ticker", "year", "n", "first", "last", "sha256")


@query(f"{ctes('clean_bars')} SELECT {COLS}, CAST(year(date) AS INTEGER) AS year FROM clean_bars WHERE ticker = '5' ORDER BY ticker, year, date")
def iter_chunks(spark, sf_dir):
    return series.iter_chunks(clean(spark, sf_dir).drop("board"), "5")


@query(f"{ctes('clean_bars')} SELECT date, close FROM clean_bars WHERE ticker = '7' AND year(date) = 1998")
def get_chunk(spark, sf_dir):
    return series.get_chunk(clean(spark, sf_dir), "7", 1998).select("date", "close")


@query(f"{ctes('clean_bars')} SELECT ticker FROM (SELECT DISTINCT ticker FROM clean_bars) ORDER BY md5('7:' || ticker), ticker LIMIT 25")
def sample_tickers(spark, sf_dir):
    return series.sample_tickers(clean(spark, sf_dir), 25, seed=7)


@query(f"{ctes('clean_bars')} SELECT DISTINCT ticker FROM clean_bars ORDER BY ticker LIMIT 30")
def head_tickers(spark, sf_dir):
    return series.head_tickers(clean(spark, sf_dir), 30)


@query(f"{ctes('event_bars')}, {_sessions('event_bars', 0.5)} SELECT * FROM sessions WHERE date BETWEEN (SELECT min(date) + 3 FROM sessions) AND (SELECT min(date) + 20 FROM sessions)")
def sessions_between(spark, sf_dir):
    found = calendar.infer_sessions(view(spark, sf_dir, "event_bars"), 0.5)
    first = found.agg(F.min("date")).first()[0]
    return calendar.sessions_between(found, first + dt.timedelta(days=3), first + dt.timedelta(days=20)) if first else found


@query(f"{ctes('clean_bars')} SELECT ticker, date, strftime(CAST(date AS TIMESTAMP), '%Y-%m-%d %H:%M:%S') AS at FROM clean_bars WHERE ticker = '1'")
def day_timestamps(spark, sf_dir):
    return clean(spark, sf_dir).where("ticker = '1'").select("ticker", "date", F.date_format(codec.midnight(F.col("date")), "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("SELECT CAST(NULL AS VARCHAR) AS ticker, CAST(NULL AS DATE) AS date, " + ", ".join(f"CAST(NULL AS DOUBLE) AS {c}" for c in FIELDS) + " WHERE false")
def empty_series(spark, sf_dir):
    return sources.empty(spark)


@query(f"{ctes('clean_bars')} SELECT {COLS} FROM clean_bars WHERE CAST(ticker AS INT) BETWEEN 1 AND 9 AND date BETWEEN DATE '{FROM}' AND DATE '{TO}'")
def file_source(spark, sf_dir):
    """A vendor's CSV files read with the stated schema, the range and the tickers."""
    path = scratch(spark, "csv")
    clean(spark, sf_dir).select(*BARS.names).write.option("header", True).csv(path)
    wanted = spark.createDataFrame([(str(i),) for i in range(1, 10)], "ticker string")
    return sources.FileSource(path, "csv").read(spark, wanted, FROM, TO).drop("error")


class _Vendor:
    """Bars by rule: tickers divisible by 7 always fail, those divisible by 5 fail a few times first, those divisible by 11 have none."""

    def __init__(self) -> None:
        self.calls: dict[str, int] = {}

    def fetch(self, ticker: str, start: dt.date, end: dt.date) -> list[tuple]:
        n = int(ticker)
        self.calls[ticker] = self.calls.get(ticker, 0) + 1
        if n % 7 == 0 or (n % 5 == 0 and self.calls[ticker] < 4):
            raise ConnectionError("HTTP 429: too many requests")
        days = [start + dt.timedelta(days=i) for i in range(-1, n % 11 * 2)]
        return [(d, 1.0 * n, 2.0 * n, 0.5 * n, 1.5 * n, 1.5 * n, 100.0, 0.0, 0.0) for d in days] if n % 11 else []


def _no_wait(seconds: float) -> None:
    """Tests and queries do not wait for a vendor that is not there."""


def _fetched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    wanted = series.tickers(clean(spark, sf_dir))
    return wanted, vendor.fetch_many(wanted, _Vendor(), FROM, TO, Retry(per_minute=800_000), tasks=4, sleep=_no_wait)


VENDOR = "v AS (SELECT DISTINCT ticker, CAST(ticker AS INT) AS n FROM clean_bars)"


@query(f"{ctes('clean_bars')}, {VENDOR} SELECT ticker, date, CAST(1.5 AS DOUBLE) * n AS close, CAST(NULL AS VARCHAR) AS error FROM (SELECT ticker, n, CAST(unnest(generate_series(DATE '{FROM}', DATE '{FROM}' + CAST(n % 11 * 2 - 1 AS INTEGER), INTERVAL 1 DAY)) AS DATE) AS date FROM v WHERE n % 11 > 0 AND n % 7 > 0) UNION ALL SELECT ticker, NULL, NULL, 'HTTP 429: too many requests' FROM v WHERE n % 7 = 0")
def fetch_bars(spark, sf_dir):
    return _fetched(spark, sf_dir)[1].select("ticker", "date", "close", "error")


@query(f"{ctes('clean_bars')}, {VENDOR} SELECT ticker, CAST(CASE WHEN n % 7 = 0 THEN 0 ELSE n % 11 * 2 END AS BIGINT) AS n_bars, n % 7 > 0 AS ok, CASE WHEN n % 7 = 0 THEN 'HTTP 429: too many requests' END AS error FROM v")
def fetch_results(spark, sf_dir):
    return vendor.fetch_results(*_fetched(spark, sf_dir))


@query("SELECT CAST(a AS INTEGER) AS attempt, l AS limited, least(pow(1.5, a) * CASE WHEN l THEN 4 ELSE 1 END, 60) * 0.5 AS shortest, least(pow(1.5, a) * CASE WHEN l THEN 4 ELSE 1 END, 60) * 1.5 AS longest FROM (SELECT unnest(range(0, 12)) AS a), (SELECT unnest([true, false]) AS l)")
def backoff_bounds(spark, sf_dir):
    rows = spark.range(12).select(F.col("id").cast("int").alias("attempt"), F.explode(F.array(F.lit(True), F.lit(False))).alias("limited"))
    low, high = vendor.backoff_bounds(F.col("attempt"), F.col("limited"))
    return rows.select("attempt", "limited", low.alias("shortest"), high.alias("longest"))


def _prober(code: str) -> bool:
    """Codes by their last digit: 0 to 5 listed, 6 and 7 not, 8 delisted, 9 without an answer."""
    if code[-1] == "8":
        raise ValueError("No data found, symbol may be delisted")
    if code[-1] == "9":
        raise ConnectionError("HTTP 503: temporarily unavailable")
    return code[-1] < "6"


@query(f"{ctes('listings')}, k AS ({CANDIDATES}) SELECT code, CASE WHEN right(code, 1) < '6' THEN 'present' WHEN right(code, 1) = '9' THEN 'unknown' ELSE 'absent' END AS outcome FROM k WHERE code NOT IN (SELECT code FROM listings WHERE in_screener)")
def probe_many(spark, sf_dir):
    """All candidate codes but the screened ones, probed with retries."""
    codes, skip = universe.candidate_codes(spark), view(spark, sf_dir, "listings").where("in_screener")
    answers = vendor.probe_many(codes, _prober, skip, Retry(per_minute=800_000), tasks=4, sleep=_no_wait)
    return universe.probe_outcomes(codes, answers, skip)


def _payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings as vendors' JSON: four shapes, suffixes in either case, symbols that are none, and totals under two names."""
    rows = spark.read.parquet(f"{sf_dir}/part.parquet")
    k = F.col("p_partkey")
    code = F.lpad((k % 1000 + 600_000).cast("string"), 6, "0")
    name = F.when(k % 3 > 0, F.col("p_name")).otherwise("")
    quote = F.struct(F.concat(code, F.when(k % 5 == 0, ".sh").when(k % 5 == 1, ".X").otherwise(".SS")).alias("symbol"), name.alias("longName"), F.concat(F.lit("short "), "p_name").alias("shortName"), (F.col("p_retailprice") * 100).alias("marketCap"))
    one = F.array(quote)
    shape = F.when(k % 4 == 0, F.to_json(F.struct(one.alias("quotes"), k.alias("total")))).when(k % 4 == 1, F.to_json(F.struct(one.alias("records"), k.alias("count")))).when(k % 4 == 2, F.to_json(F.struct(one.alias("result")))).otherwise(F.to_json(F.struct(F.struct(F.array(F.struct(one.alias("quotes"))).alias("result")).alias("finance"))))
    return rows.select("p_partkey", shape.alias("payload"))


QUOTED = "q AS (SELECT CAST(p_partkey % 1000 + 600000 AS VARCHAR) AS code, CASE WHEN p_partkey % 3 > 0 THEN p_name ELSE 'short ' || p_name END AS name, p_retailprice * 100 AS market_cap FROM part WHERE p_partkey % 5 <> 1)"


@query(f"WITH {QUOTED} SELECT code || '.SS' AS ticker, code, name, market_cap, {BLOCK} AS instrument, {BOARD} AS board, {BLOCK} IN {EQUITIES} AS is_equity FROM q")
def payload_quotes(spark, sf_dir):
    return listings.normalise_quotes(listings.quotes(_payloads(spark, sf_dir)))


@query("SELECT p_partkey, CASE WHEN p_partkey % 4 < 2 THEN p_partkey END AS total FROM part")
def payload_totals(spark, sf_dir):
    return _payloads(spark, sf_dir).select("p_partkey", listings.reported_total().alias("total"))


@query(f"{ctes('listings')}, {NAMED}, s AS (SELECT code, min(name) AS name FROM e WHERE is_equity AND in_screener GROUP BY code), p AS (SELECT DISTINCT code FROM listings WHERE in_probe AND substr(code, 1, 3) IN ('600', '601', '603', '605', '688', '689', '900')), j AS (SELECT coalesce(s.code, p.code) AS code, name, s.code IS NOT NULL AS in_screener, p.code IS NOT NULL AS in_probe FROM s FULL JOIN p ON p.code = s.code) SELECT code || '.SS' AS ticker, code, name, {BOARD} AS board, in_screener, in_probe FROM j")
def discover(spark, sf_dir):
    rows = view(spark, sf_dir, "listings")
    return universe.discover(rows.where("in_screener"), rows.select("code", F.col("in_probe").alias("found"), F.lit(False).alias("failed")))


@query(f"{ctes('listings')}, {BATCHES}, z AS (SELECT ticker FROM x WHERE ticker LIKE '%3.SS') SELECT coalesce(x.ticker, y.ticker) AS ticker, coalesce(y.name, x.name) AS name, CASE WHEN y.ticker IS NULL AND x.ticker NOT IN (SELECT ticker FROM z) THEN 'inactive' ELSE 'active' END AS status, CASE WHEN y.ticker IS NULL AND x.ticker NOT IN (SELECT ticker FROM z) THEN DATE '2026-08-12' END AS inactive_since FROM x FULL JOIN y ON x.ticker = y.ticker")
def persist_discovery(spark, sf_dir):
    """A complete discovery kept: names it lacks become inactive, but for those whose probe had no answer."""
    rows = view(spark, sf_dir, "listings")
    known = _first(spark, rows)
    unknown = known.where("ticker LIKE '%3.SS'").select("ticker")
    out = flows.persist(known, _batch(rows, "in_probe", F.max), unknown, "probe", DAY2, complete=True)
    return out.select("ticker", "name", "status", F.to_date("inactive_since").alias("inactive_since"))


@query(f"{ctes('clean_bars', 'master')}, c AS ({CHUNKS}) SELECT min(\"first\") AS \"first\", max(\"last\") AS \"last\", count(*) AS chunks, CAST(sum(n) AS BIGINT) AS bars, count(DISTINCT ticker) AS tickers, (SELECT count(*) FROM master WHERE status = 'active') AS active, (SELECT count(*) FROM master WHERE status = 'inactive') AS inactive FROM c")
def live_facts(spark, sf_dir):
    return status.live_facts(series.chunk_meta(clean(spark, sf_dir)), view(spark, sf_dir, "master"))


@query(f"{ctes('clean_bars', 'master')}, c AS ({CHUNKS}) SELECT CASE WHEN max(\"last\") < DATE '2001-11-01' THEN 'stale' ELSE 'fresh' END AS state, CAST(min(\"first\") AS VARCHAR) AS \"first\", CAST(max(\"last\") AS VARCHAR) AS \"last\", format('{{:,}}', CAST(sum(n) AS BIGINT)) AS bars, format('{{:,}}', count(DISTINCT ticker)) AS tickers, format('{{:,}}', count(*)) AS chunks, format('{{:,}}', (SELECT count(*) FROM master WHERE status = 'active')) AS active, format('{{:,}}', (SELECT count(*) FROM master WHERE status = 'inactive')) AS inactive FROM c")
def status_record(spark, sf_dir):
    facts = status.live_facts(series.chunk_meta(clean(spark, sf_dir)), view(spark, sf_dir, "master"))
    return status.record(facts, F.lit(dt.date(2001, 11, 5)))


@query("SELECT p_partkey, CAST(p_size AS BIGINT) * 10000000 AS used_bytes, CAST(p_size AS BIGINT) * 9000000 AS data_bytes, p_size * 10000000 / CAST(536870912 AS DOUBLE) AS used_fraction, p_size * 10000000 >= 483183820 AS over_threshold, CASE WHEN p_size = 0 THEN 0 ELSE CAST(0.9 AS DOUBLE) END AS compression_ratio FROM part")
def storage_facts(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", (F.col("p_size").cast("bigint") * 10_000_000).alias("used_bytes"), (F.col("p_size").cast("bigint") * 9_000_000).alias("data_bytes"), F.col("p_partkey").alias("objects"))
    return store.storage_facts(rows).withColumnRenamed("objects", "p_partkey")


@query(f"{ctes('clean_bars')} SELECT CAST(count(*) * 32 + 8 * sum((dividends <> 0)::INT + (splits <> 0)::INT) AS BIGINT) AS data_bytes, true AS holds_files, false AS over_threshold FROM clean_bars")
def storage_stats(spark, sf_dir):
    """Of a store's files; their sizes themselves depend on the writer."""
    out = store.storage_stats(_stored(spark, clean(spark, sf_dir), "stats").bars())
    return out.select("data_bytes", ((F.col("used_bytes") > 0) & (F.col("objects") > 0)).alias("holds_files"), "over_threshold")


@query(f"{ctes('clean_bars')} SELECT {COLS} FROM clean_bars")
def merge_stream_into_store(spark, sf_dir):
    """Landing files merged by a stream, each ticker's rows in one file, so that one batch holds all arrivals of a date; then the same stream again, which changes nothing."""
    base = scratch(spark, "stream")
    raw(spark, sf_dir).repartition(3, "ticker").write.parquet(f"{base}/landing")
    for _ in range(2):
        merge_stream(spark, f"{base}/landing", f"{base}/store", f"{base}/checkpoint").awaitTermination()
    return Store(spark, f"{base}/store").bars().drop("year")


@query(f"{ctes('clean_bars', 'overlay')}, w AS (SELECT ticker, max(date) AS m FROM clean_bars GROUP BY 1), i AS (SELECT o.* FROM overlay o JOIN w ON w.ticker = o.ticker WHERE o.date >= m - 10), k AS (SELECT ticker, year(date) AS y, count(*) AS n FROM i GROUP BY 1, 2) SELECT 'updated' AS outcome, count(*) AS chunks, CAST(sum(n) AS BIGINT) AS bars_submitted FROM k HAVING count(*) > 0")
def incremental_update(spark, sf_dir):
    """An update of a store: only rows from each ticker's overlap on are merged."""
    rows = clean(spark, sf_dir)
    incoming = _overlay(rows).withColumns({"high": F.col("high") * 2, "board": F.lit("main"), "seq": F.lit(1).cast("bigint")})
    return flows.update(incoming, _stored(spark, rows, "update"), Horizon(dt.date(1995, 1, 1)))


@query("SELECT * FROM (VALUES ('first', true), ('again', false)) AS t(attempt, made)")
def store_create(spark, sf_dir):
    """Making a store is idempotent: the second attempt finds the first."""
    held = Store(spark, scratch(spark, "create"))
    return spark.createDataFrame([("first", held.create()), ("again", held.create())], "attempt string, made boolean")


@query("SELECT * FROM (VALUES (1, 'a', true), (2, 'b', false), (3, 'a', true), (4, 'b', true)) AS t(step, owner, held)")
def writer_lock(spark, sf_dir):
    """One writer at a time: b waits until a has released the store."""
    store_ = Store(spark, scratch(spark, "lock"))
    steps = [(1, "a", store_.hold("a")), (2, "b", store_.hold("b")), (3, "a", store_.hold("a"))]
    store_.release("b")
    store_.release("a")
    return spark.createDataFrame([*steps, (4, "b", store_.hold("b"))], "step int, owner string, held boolean")


@query(f"{ctes('clean_bars', 'overlay')} SELECT {COLS} FROM clean_bars WHERE CAST(ticker AS INT) % 4 = 0")
def store_conflict(spark, sf_dir):
    """A writer that read the log before another one wrote is refused, and the store shows the other's rows alone."""
    rows = clean(spark, sf_dir).drop("board").where(F.col("ticker").cast("int") % 4 == 0)
    held = Store(spark, scratch(spark, "conflict"))
    held.create()
    late = Store(spark, held.path)
    seen = late.entry()
    held.replace(rows)
    late.entry = lambda: seen
    try:
        late.replace(rows.withColumn("close", F.lit(1.0)))
    except store.Conflict:
        return held.bars().drop("year")
    raise AssertionError("two writers made one entry")
