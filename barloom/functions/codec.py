"""Storage columns: fixed-point prices, integer volumes, day numbers and chunk checksums, all built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.config import MAX_SCALED, PRICE_SCALE
from barloom.schemas import ACTIONS, PRICES


def finite(x: Column) -> Column:
    """Null for NaN and infinities."""
    return F.when(F.isnan(x) | (F.abs(x) == float("inf")), None).otherwise(x)


def pack_price(x: Column, scale: int = PRICE_SCALE) -> Column:
    """int of the value times the scale, half to even; missing is null; out of range raises."""
    scaled = F.rint(finite(x) * F.lit(float(scale)))
    return F.when(F.abs(scaled) > MAX_SCALED, F.raise_error(F.lit("price beyond fixed-point range"))).otherwise(scaled).cast("int")


def unpack_price(x: Column, scale: int = PRICE_SCALE) -> Column:
    return x / F.lit(float(scale))


def pack_volume(x: Column) -> Column:
    return F.rint(finite(x)).cast("bigint")


def unpack_volume(x: Column) -> Column:
    return x.cast("double")


def pack_date(x: Column) -> Column:
    return F.unix_date(x)


def unpack_date(x: Column) -> Column:
    return F.date_from_unix_date(x)


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def chunk_id(ticker: Column, year: Column) -> Column:
    return F.concat_ws(":", ticker, year.cast("string"))


def sparse_actions(bars: DataFrame) -> DataFrame:
    """ticker, year, kind, row (0-based place in the chunk), value (scaled): the non-zero actions only."""
    w = Window.partitionBy("ticker", F.year("date")).orderBy("date")
    rows = bars.withColumn("row", F.row_number().over(w) - 1)
    kinds = F.array(*(F.struct(F.lit(k).alias("kind"), F.coalesce(finite(F.col(k)), F.lit(0.0)).alias("v")) for k in ACTIONS))
    rows = rows.select("ticker", F.year("date").alias("year"), "row", F.inline(kinds)).where("v <> 0")
    return rows.select("ticker", "year", "kind", "row", pack_price(F.col("v")).alias("value"))


def restore_actions(bars: DataFrame, sparse: DataFrame) -> DataFrame:
    """Dense action columns again: zero wherever the sparse table has nothing."""
    w = Window.partitionBy("ticker", F.year("date")).orderBy("date")
    wide = sparse.groupBy("ticker", "year", "row").agg(*(F.max(F.when(F.col("kind") == k, unpack_price(F.col("value")))).alias(k) for k in ACTIONS))
    base = bars.drop(*ACTIONS).withColumn("year", F.year("date")).withColumn("row", F.row_number().over(w) - 1)
    out = base.join(wide, ["ticker", "year", "row"], "left")
    return out.withColumns({k: F.coalesce(k, F.lit(0.0)) for k in ACTIONS}).drop("row", "year")


CODEC, VERSION = "cols-v1", 1
MISSING = {4: -(2**31), 8: -(2**63)}
DENSE = {"date": 4, **dict.fromkeys(PRICES, 4), "volume": 8}


def _cell(x: Column, size: int) -> Column:
    """Hex of a bigint's low ``size`` bytes, least significant first: the bytes of each half change places before they are written."""

    def half(v: Column) -> Column:
        swapped = F.shiftleft(v.bitwiseAND(0xFF), 24).bitwiseOR(F.shiftleft(v.bitwiseAND(0xFF00), 8)).bitwiseOR(F.shiftright(v.bitwiseAND(0xFF0000), 8)).bitwiseOR(F.shiftrightunsigned(v, 24).bitwiseAND(0xFF))
        return F.lpad(F.hex(swapped), F.lit(8), F.lit("0"))

    return half(x) if size == 4 else F.concat(half(x), half(F.shiftrightunsigned(x, 32)))


def _from_cell(buffer: Column, at: Column, size: int) -> Column:
    """The bigint of cell ``at`` (from 0) of a buffer of little-endian cells."""
    digits = F.concat(*(F.hex(F.substring(buffer, at * size + k, F.lit(1))) for k in range(size, 0, -1)))
    raw = F.conv(digits, 16, 10).cast("decimal(20,0)")
    top = F.lit(str(2 ** (8 * size - 1))).cast("decimal(20,0)")
    return F.when(raw >= top, raw - top - top).otherwise(raw).cast("bigint")


def chunk_problems(bars: DataFrame) -> DataFrame:
    """ticker, year, problem of the chunks that cannot be encoded: a missing date, or dates that do not strictly increase.

    Rows come in order of ``seq`` where they have it, else of their dates. Chunks of no rows do not exist.
    """
    year = F.year("date")
    order = ["seq"] if "seq" in bars.columns else ["date"]
    w = Window.partitionBy("ticker", "year").orderBy(*order)
    rows = bars.select("ticker", "date", year.alias("year"), *(c for c in order if c != "date"))
    rows = rows.withColumn("step", F.datediff("date", F.lag("date").over(w)))
    out = rows.groupBy("ticker", "year").agg(F.count_if(F.col("date").isNull()).alias("nulls"), F.min("step").alias("least"))
    problem = F.when(F.col("nulls") > 0, "missing date").when(F.col("least") <= 0, "dates do not increase")
    return out.select("ticker", "year", problem.alias("problem")).where("problem IS NOT NULL")


def encode_chunks(bars: DataFrame, digest_only: bool = False) -> DataFrame:
    """One row a ticker-year: its metadata, digest and buffers; a chunk that repeats a date raises.

    Metadata: n, first, last, columns (prices and volume present), price_scale,
    schema_version, codec. Dates and prices are 4-byte, volumes 8-byte little-endian
    integers, the least integer meaning missing; an action has two buffers, row
    numbers and values of its non-zero days. ``sha256`` runs over the present
    buffers in a fixed order: name, byte length in four bytes, bytes. Grouping
    holds a ticker-year at a time, at most 366 rows since dates are distinct.
    """
    have = [c for c in (*PRICES, "volume") if c in bars.columns]
    cells = {"date": _cell(pack_date(F.col("date")).cast("bigint"), 4)}
    for c in have:
        packed = pack_volume(F.col(c)) if c == "volume" else pack_price(F.col(c)).cast("bigint")
        cells[c] = _cell(F.coalesce(packed, F.lit(MISSING[DENSE[c]])), DENSE[c])
    acts = [k for k in ACTIONS if k in bars.columns]
    hits = {k: F.coalesce(finite(F.col(k)), F.lit(0.0)) for k in acts}
    row = F.struct("date", *(v.alias(f"x_{k}") for k, v in cells.items()), *(pack_price(v).cast("bigint").alias(f"v_{k}") for k, v in hits.items()), *((v != 0).alias(f"k_{k}") for k, v in hits.items()))
    # seen before rows are collected, so that a date that is repeated without end never makes one long array
    before = F.lag("date").over(Window.partitionBy("ticker", "year").orderBy("date"))
    once = bars.withColumn("year", F.year("date"))
    once = once.withColumn("date", F.when(F.col("date") == before, F.raise_error(F.lit("a chunk repeats a date")).cast("date")).otherwise(F.col("date")))
    grouped = once.groupBy("ticker", "year").agg(F.array_sort(F.collect_list(row)).alias("rows"), F.count("*").alias("n"), F.min("date").alias("first"), F.max("date").alias("last"))

    def dense(c: str) -> Column:
        return F.array_join(F.transform("rows", lambda r: r[f"x_{c}"]), "")

    def sparse(k: str, part: str) -> Column:
        cells = F.transform("rows", lambda r, i: F.struct(i.cast("bigint").alias("i"), r[f"v_{k}"].alias("v"), r[f"k_{k}"].alias("k")))
        return F.array_join(F.transform(F.filter(cells, lambda h: h["k"]), lambda h: _cell(h[part], 4)), "")

    buffers = {c: dense(c) for c in cells} | {f"{k}.{part}": sparse(k, part) for k in acts for part in ("i", "v")}
    out = grouped.select("ticker", "year", "n", "first", "last", *(v.alias(f"b_{c.replace('.', '_')}") for c, v in buffers.items()))

    def framed(name: str) -> Column:
        body = F.col(f"b_{name.replace('.', '_')}")
        head = F.concat(F.lit(name.encode().hex().upper()), _cell((F.length(body) / 2).cast("bigint"), 4))
        return F.when(F.length(body) > 0, F.concat(head, body)).otherwise(F.lit(""))

    digest = F.sha2(F.unhex(F.concat(*map(framed, buffers))), 256).alias("sha256")
    meta = [F.array(*map(F.lit, have)).alias("columns"), F.lit(PRICE_SCALE).alias("price_scale"), F.lit(VERSION).alias("schema_version"), F.lit(CODEC).alias("codec")]
    names = [f"b_{c.replace('.', '_')}" for c in buffers]
    return out.select("ticker", "year", "n", "first", "last", *([] if digest_only else meta), digest, *([] if digest_only else [F.unhex(c).alias(c) for c in names]))


def decode_chunks(chunks: DataFrame, fields: list[str] | None = None, verify: bool = False) -> DataFrame:
    """Bars of encoded chunks; no fields, or none, means all, and unknown names are ignored.

    Another codec or version, a count that differs from the buffers' and, with
    ``verify``, a digest that differs raise when the row is read.
    """
    known = [c for c in (*PRICES, "volume", *ACTIONS) if f"b_{c}" in chunks.columns or f"b_{c}_i" in chunks.columns]
    wanted = [c for c in known if not fields or c in fields]
    held = (F.octet_length("b_date") / 4).cast("bigint")
    bad = F.when((F.col("codec") != CODEC) | (F.col("schema_version") != VERSION), "unknown codec or version").when(held != F.col("n"), "count differs")
    if verify:
        bad = bad.when(~F.col("sha256").eqNullSafe(digest_of(chunks.columns)), "digest differs")
    count = F.when(bad.isNotNull(), F.raise_error(F.concat(F.col("ticker"), F.lit(": "), bad))).otherwise(held)
    rows = chunks.withColumn("i", F.explode(F.sequence(F.lit(0).cast("bigint"), count - 1)))

    def value(c: str) -> Column:
        if c in ACTIONS:
            hits = F.sequence(F.lit(0).cast("bigint"), (F.octet_length(f"b_{c}_i") / 4).cast("bigint") - 1)
            entries = F.when(F.octet_length(f"b_{c}_i") > 0, F.transform(hits, lambda k: F.struct(_from_cell(F.col(f"b_{c}_i"), k, 4).alias("i"), _from_cell(F.col(f"b_{c}_v"), k, 4).alias("v"))))
            found = F.filter(F.coalesce(entries, F.array().cast("array<struct<i: bigint, v: bigint>>")), lambda h: h["i"] == F.col("i"))
            return F.coalesce(F.try_element_at(found, F.lit(1))["v"] / F.lit(float(PRICE_SCALE)), F.lit(0.0))
        size = DENSE[c]
        cell = F.nullif(_from_cell(F.col(f"b_{c}"), F.col("i"), size), F.lit(MISSING[size]))
        return unpack_volume(cell) if size == 8 else cell / F.col("price_scale").cast("double")

    return rows.select("ticker", unpack_date(_from_cell(F.col("b_date"), F.col("i"), 4).cast("int")).alias("date"), *(value(c).alias(c) for c in wanted))


def digest_of(columns: list[str]) -> Column:
    """The digest of the buffers that an encoded chunk holds."""
    parts = []
    for name in (*DENSE, *(f"{k}.{p}" for k in ACTIONS for p in ("i", "v"))):
        if (c := f"b_{name.replace('.', '_')}") in columns:
            head = F.concat(F.lit(name.encode().hex().upper()), _cell(F.octet_length(c).cast("bigint"), 4))
            parts.append(F.when(F.octet_length(c) > 0, F.concat(head, F.hex(c))).otherwise(F.lit("")))
    return F.sha2(F.unhex(F.concat(*parts)), 256)


def chunk_checksums(bars: DataFrame) -> DataFrame:
    """ticker, year, n, first, last, sha256 of every chunk."""
    return encode_chunks(bars, digest_only=True)


def verify_chunks(bars: DataFrame, manifest: DataFrame) -> DataFrame:
    """ticker, year, state of bars against a manifest: ok, corrupt, missing (no bars) or extra (no entry); never raises.

    A manifest without a digest for a chunk makes it corrupt, and so does a date that the bars repeat.
    """
    copies = bars.groupBy("ticker", "date").agg(F.count("*").alias("copies"))
    repeated = copies.where("copies > 1").select("ticker", F.year("date").alias("year")).distinct()
    sound = bars.withColumn("year", F.year("date")).join(repeated, ["ticker", "year"], "left_anti").drop("year")
    now = chunk_checksums(sound).select("ticker", "year", F.col("sha256").alias("now")).unionByName(repeated.withColumn("now", F.lit("")))
    both = manifest.select("ticker", "year", F.col("sha256"), F.lit(True).alias("listed")).join(now, ["ticker", "year"], "full_outer")
    state = F.when(F.col("now").isNull(), "missing").when(F.col("listed").isNull(), "extra").when(F.col("sha256") == F.col("now"), "ok").otherwise("corrupt")
    return both.select("ticker", "year", state.alias("state"))


def bytes_per_bar(bars: DataFrame) -> DataFrame:
    """ticker, year, bytes_per_bar: 32 bytes a row and 8 for each non-zero action."""
    hits = sum((F.coalesce(finite(F.col(k)), F.lit(0.0)) != 0).cast("int") for k in ACTIONS)
    return bars.groupBy("ticker", F.year("date").alias("year")).agg(((F.count("*") * 32 + 8 * F.sum(hits)) / F.count("*")).alias("bytes_per_bar"))
