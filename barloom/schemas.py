"""Schemas and small dimensions. Nothing is inferred from data."""

from __future__ import annotations

from pyspark.sql import types as T

PRICES = ("open", "high", "low", "close", "adj_close")
ACTIONS = ("dividends", "splits")
FIELDS = (*PRICES, "volume", *ACTIONS)

BARS = T.StructType([T.StructField("ticker", T.StringType()), T.StructField("date", T.DateType()), *(T.StructField(c, T.DoubleType()) for c in FIELDS)])
RUN_EVENTS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("event", T.StringType()),
        T.StructField("at", T.TimestampNTZType()),
        T.StructField("kind", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("counters", T.MapType(T.StringType(), T.LongType())),
        T.StructField("errors", T.ArrayType(T.StringType())),
        T.StructField("note", T.StringType()),
    ]
)
SNAPSHOTS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("taken_at", T.TimestampNTZType()),
        T.StructField("n_symbols", T.IntegerType()),
        T.StructField("symbols", T.ArrayType(T.StringType())),
        T.StructField("details", T.StringType()),
    ]
)

INGEST = T.StructType([T.StructField("state", T.StringType()), T.StructField("run_id", T.StringType()), T.StructField("updated_at", T.TimestampNTZType())])
MASTER = T.StructType(
    [
        *(T.StructField(c, T.StringType()) for c in ("ticker", "code", "name", "board", "status")),
        T.StructField("first_seen", T.TimestampNTZType()),
        T.StructField("last_seen", T.TimestampNTZType()),
        T.StructField("last_source", T.StringType()),
        T.StructField("inactive_since", T.TimestampNTZType()),
        T.StructField("ingest", INGEST),
    ]
)
CHUNKS = T.StructType(
    [
        T.StructField("ticker", T.StringType()),
        T.StructField("n", T.LongType()),
        T.StructField("first", T.DateType()),
        T.StructField("last", T.DateType()),
        T.StructField("sha256", T.StringType()),
        T.StructField("codec", T.StringType()),
        T.StructField("schema_version", T.IntegerType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)

# The instrument of a code by its first three digits.
BLOCKS = {
    "000": "index",
    "010": "bond_treasury",
    "018": "bond_treasury",
    "019": "bond_treasury",
    "020": "bond_treasury",
    "110": "bond_convertible",
    "111": "bond_convertible",
    "113": "bond_convertible",
    "118": "bond_convertible",
    "122": "bond_corporate",
    "124": "bond_corporate",
    "126": "bond_corporate",
    "127": "bond_corporate",
    "128": "bond_corporate",
    "132": "bond_corporate",
    "136": "bond_corporate",
    "163": "bond_corporate",
    "175": "bond_corporate",
    "204": "repo",
    "500": "fund_closed",
    "501": "fund_lof",
    "502": "fund_structured",
    "505": "fund_lof",
    "506": "fund_lof",
    "507": "fund_lof",
    "508": "reit",
    "510": "etf",
    "511": "etf_bond",
    "512": "etf",
    "513": "etf_qdii",
    "515": "etf",
    "516": "etf",
    "517": "etf",
    "518": "etf_gold",
    "560": "etf",
    "561": "etf",
    "562": "etf",
    "563": "etf",
    "588": "etf_star",
    "600": "equity_main",
    "601": "equity_main",
    "603": "equity_main",
    "605": "equity_main",
    "688": "equity_star",
    "689": "equity_star",
    "900": "equity_b_share",
}
EQUITIES = ("equity_main", "equity_star", "equity_b_share")
# The board of a code by its first three digits; all others are "other".
BOARDS = {"600": "main", "601": "main", "603": "main", "605": "main", "688": "star", "689": "star", "900": "b_share"}
