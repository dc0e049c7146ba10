"""A store of bars by year: immutable files, and a log whose last entry says which files hold each year.

``<path>/data/year=Y/batch=B`` holds the bars of a year as one write left them,
``<path>/chunks/year=Y/batch=B`` the manifest of its chunks, and ``<path>/log/N.json``
names, for every year, the batch that counts. A write makes new batches and then
the next log entry, which only one writer can make: a reader sees all of a write or
nothing, a failed write leaves files that nothing names, and of two writers at
once the later one raises ``Conflict`` and changes nothing, on file systems where a
file is never renamed onto another, as HDFS; elsewhere the lock keeps writers
apart. ``vacuum`` removes batches that the log no longer names, and leaves of refused
writes. Only Spark's file systems are used.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.config import Capacity
from barloom.functions.codec import CODEC, VERSION, chunk_checksums, chunk_problems
from barloom.schemas import ACTIONS, BARS, CHUNKS, FIELDS

INSERTED, UPDATED, UNCHANGED = "inserted", "updated", "unchanged"
DEALS = 16  # files of a year, by ticker


class Conflict(RuntimeError):
    """Another writer made the log entry that this write was about to make."""


class Refused(ValueError):
    """Rows that cannot be stored."""


class _Files:
    """The few file operations that a log needs, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        jvm = spark._jvm
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        self.io = jvm.org.apache.commons.io.IOUtils

    def names(self, path: str) -> list[str]:
        at = self.path(path)
        return sorted(f.getPath().getName() for f in self.fs.listStatus(at)) if self.fs.exists(at) else []

    def read(self, path: str) -> str:
        stream = self.fs.open(self.path(path))
        try:
            return self.io.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """False if the file is there already."""
        draft = self.path(f"{path}.{uuid.uuid4().hex}.draft")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(text.encode()))
        stream.close()
        at = self.path(path)
        made = not self.fs.exists(at) and self.fs.rename(draft, at)
        if not made:
            self.fs.delete(draft, False)
        return made

    def remove(self, path: str) -> None:
        self.fs.delete(self.path(path), True)


class Store:
    """One store; every reading method sees the log's last entry of that moment."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        self.files = _Files(spark, path)

    def entry(self) -> tuple[int, dict[int, str]]:
        """Number and content of the last log entry: year -> batch. An empty or absent store is entry 0 of no years."""
        numbers = [n.removesuffix(".json") for n in self.files.names(f"{self.path}/log") if n.endswith(".json")]
        if not numbers:
            return 0, {}
        last = max(map(int, numbers))
        held = json.loads(self.files.read(f"{self.path}/log/{last:09d}.json"))
        return last, {int(y): b for y, b in held["years"].items()}

    def create(self) -> bool:
        """Makes an empty store; False, and nothing done, where there is one."""
        return self.files.create(f"{self.path}/log/{1:09d}.json", json.dumps({"years": {}}))

    def _load(self, kind: str, schema: T.StructType, years: Iterable[int] | None = None) -> DataFrame:
        _, held = self.entry()
        chosen = {y: b for y, b in held.items() if years is None or y in set(years)}
        if not chosen:
            return self.spark.createDataFrame([], T.StructType([*schema.fields, T.StructField("year", T.IntegerType())]))
        base = f"{self.path}/{kind}"
        reader = self.spark.read.schema(T.StructType([*schema.fields, T.StructField("year", T.IntegerType()), T.StructField("batch", T.StringType())])).option("basePath", base)
        return reader.parquet(*(f"{base}/year={y}/batch={b}" for y, b in sorted(chosen.items()))).drop("batch")

    def bars(self, years: Iterable[int] | None = None) -> DataFrame:
        """ticker, date, fields, year. A condition on year prunes folders; within a year, files are sorted by ticker and date."""
        return self._load("data", BARS, years)

    def manifest(self, years: Iterable[int] | None = None) -> DataFrame:
        """ticker, n, first, last, sha256, codec, schema_version, updated_at, year of every chunk."""
        return self._load("chunks", CHUNKS, years)

    def commit(self, bars: DataFrame, years: Iterable[int], now: dt.datetime | None = None, changed: DataFrame | None = None) -> None:
        """Makes ``bars`` all there is of ``years``; a year without rows leaves the store. Other years stay untouched.

        Dates of a ticker must be present and distinct, else ``Refused``, and the log stays as it is. Chunks whose digest is unchanged keep their ``updated_at``.
        ``changed`` (ticker, year) names the only chunks that may differ from the stored ones; the others keep their manifest entries.
        """
        years = sorted(set(years))
        number, held = self.entry()
        batch = f"{number + 1:09d}-{uuid.uuid4().hex[:8]}"
        rows = bars.select(*(f.name if f.name in bars.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in BARS.fields)).where(F.year("date").isin(*years) | F.col("date").isNull())
        dealt = rows.withColumn("year", F.year("date")).repartition("year", F.pmod(F.xxhash64("ticker"), F.lit(DEALS)))
        dealt.withColumn("batch", F.lit(batch)).sortWithinPartitions("year", "ticker", "date").write.mode("append").partitionBy("year", "batch").parquet(f"{self.path}/data")
        written = [n.removeprefix("year=") for n in self.files.names(f"{self.path}/data") if n.startswith("year=") and f"batch={batch}" in self.files.names(f"{self.path}/data/{n}")]
        if not all(y.isdigit() for y in written):
            raise Refused("missing date")
        made = set(map(int, written))
        if made:
            fresh = self.spark.read.schema(T.StructType([*BARS.fields, T.StructField("year", T.IntegerType()), T.StructField("batch", T.StringType())])).option("basePath", f"{self.path}/data")
            fresh = fresh.parquet(*(f"{self.path}/data/year={y}/batch={batch}" for y in sorted(made))).drop("batch", "year")
            # the rows are looked at where they were written: nothing names them yet
            before = self.manifest(years)
            kept = None
            if changed is not None:
                keys = changed.select("ticker", "year").distinct()
                fresh = fresh.withColumn("year", F.year("date")).join(keys, ["ticker", "year"], "left_semi").drop("year")
                kept = before.join(keys, ["ticker", "year"], "left_anti").where(F.col("year").isin(*made))
            wrong = chunk_problems(fresh).limit(3).collect()
            if wrong:
                raise Refused("; ".join(f"{r['ticker']} {r['year']}: {r['problem']}" for r in wrong))
            before = before.select("ticker", "year", F.col("sha256").alias("was"), F.col("updated_at").alias("at"))
            stamp = F.lit(now or dt.datetime.now(dt.UTC).replace(tzinfo=None)).cast("timestamp_ntz")
            entries = chunk_checksums(fresh).join(before, ["ticker", "year"], "left")
            entries = entries.select("ticker", "n", "first", "last", "sha256", F.lit(CODEC).alias("codec"), F.lit(VERSION).alias("schema_version"), F.when(F.col("was") == F.col("sha256"), F.col("at")).otherwise(stamp).alias("updated_at"), "year")
            entries = entries.unionByName(kept.select(*entries.columns)) if kept is not None else entries
            entries.repartition("year").withColumn("batch", F.lit(batch)).write.mode("append").partitionBy("year", "batch").parquet(f"{self.path}/chunks")
        counted = {y: b for y, b in held.items() if y not in years} | dict.fromkeys(made, batch)
        if not self.files.create(f"{self.path}/log/{number + 1:09d}.json", json.dumps({"years": {str(y): b for y, b in sorted(counted.items())}})):
            raise Conflict(f"entry {number + 1} of {self.path} was made by another writer")

    def replace(self, bars: DataFrame) -> None:
        """Bulk load: every year that the rows have is replaced whole."""
        self.commit(bars, _years(bars))

    def upsert(self, incoming: DataFrame) -> None:
        """Every ticker-year that the rows have is replaced whole; the rest stays."""
        years = _years(incoming)
        self.commit(upsert_series(self.bars(years).drop("year"), incoming), years, changed=_chunks_of(incoming))

    def merge(self, incoming: DataFrame) -> None:
        """Incoming rows replace stored rows of their (ticker, date) whole, in the years that they have."""
        years = _years(incoming)
        self.commit(merge(self.bars(years).drop("year"), incoming.select("ticker", "date", *(c for c in FIELDS if c in incoming.columns))), years, changed=_chunks_of(incoming))

    def delete(self, ticker: str) -> None:
        """Removes all bars of a ticker; years that hold nothing else leave the store."""
        years = [r["year"] for r in self.manifest().where(F.col("ticker") == ticker).select("year").distinct().collect()]
        if years:
            gone = self.manifest(years).where(F.col("ticker") == ticker)
            self.commit(self.bars(years).where(F.col("ticker") != ticker).drop("year"), years, changed=gone)

    def vacuum(self) -> int:
        """Removes batches that the last log entry does not name, as failed and replaced writes leave them; returns how many. Not while others read or write."""
        _, held = self.entry()
        gone = 0
        for kind in ("data", "chunks"):
            for y in (n for n in self.files.names(f"{self.path}/{kind}") if n.startswith("year=")):
                year = y.removeprefix("year=")
                for b in self.files.names(f"{self.path}/{kind}/{y}"):
                    if not year.isdigit() or b.removeprefix("batch=") != held.get(int(year)):
                        self.files.remove(f"{self.path}/{kind}/{y}/{b}")
                        gone += 1
        return gone

    def hold(self, owner: str) -> bool:
        """Takes the store's lock for a run of several writes; False where another owner holds it."""
        at = f"{self.path}/writer.lock"
        return self.files.create(at, owner) or self.files.read(at) == owner

    def release(self, owner: str) -> None:
        if "writer.lock" in self.files.names(self.path) and self.files.read(f"{self.path}/writer.lock") == owner:
            self.files.remove(f"{self.path}/writer.lock")


def _chunks_of(bars: DataFrame) -> DataFrame:
    return bars.select("ticker", F.year("date").alias("year"))


def _years(bars: DataFrame) -> list[int]:
    """The years of the rows: a few dozen at most."""
    return [r["y"] for r in bars.select(F.year("date").alias("y")).where("y IS NOT NULL").distinct().collect()]


def outcomes(manifest: DataFrame, incoming: DataFrame) -> DataFrame:
    """ticker, year, outcome of writing incoming chunks whole: equal digests need no write. Digests are computed for incoming chunks only."""
    now = chunk_checksums(incoming).select("ticker", "year", F.col("sha256").alias("fresh"))
    case = F.when(F.col("sha256").isNull(), INSERTED).when(F.col("sha256") == F.col("fresh"), UNCHANGED).otherwise(UPDATED)
    return now.join(manifest.select("ticker", "year", "sha256"), ["ticker", "year"], "left").select("ticker", "year", case.alias("outcome"))


def upsert_series(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """All bars after incoming ticker-years replace their like whole; other years stay."""
    keys = incoming.select("ticker", F.year("date").alias("__y")).distinct()
    kept = stored.withColumn("__y", F.year("date")).join(keys, ["ticker", "__y"], "left_anti").drop("__y")
    return kept.select(*stored.columns).unionByName(incoming, allowMissingColumns=True)


def merge(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """All bars after incoming rows replace stored rows of their (ticker, date) whole, missing values included."""
    cols = [c for c in FIELDS if c in stored.columns or c in incoming.columns]

    def side(df: DataFrame, src: int) -> DataFrame:
        return df.select("ticker", "date", *((F.col(c) if c in df.columns else F.lit(None).cast("double")).alias(c) for c in cols), F.lit(src).alias("__src"))

    w = Window.partitionBy("ticker", "date").orderBy(F.desc("__src"))
    both = side(stored, 0).unionByName(side(incoming, 1))
    return both.withColumn("__rn", F.row_number().over(w)).where("__rn = 1").drop("__rn", "__src")


def storage_stats(bars: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """used_bytes (files), data_bytes (encoded width), objects, used_fraction, over_threshold, compression_ratio."""
    files = bars.select(F.col("_metadata.file_path").alias("f"), F.col("_metadata.file_size").alias("s")).distinct()
    used = files.agg(F.coalesce(F.sum("s"), F.lit(0)).alias("used_bytes"), F.count("*").alias("objects"))
    hits = sum((F.coalesce(F.col(k), F.lit(0.0)) != 0).cast("bigint") for k in ACTIONS if k in bars.columns)
    data = bars.agg(F.coalesce(F.count("*") * 32 + 8 * F.sum(hits), F.lit(0)).alias("data_bytes"))
    return storage_facts(used.withColumn("k", F.lit(1)).join(data.withColumn("k", F.lit(1)), "k").drop("k"), capacity)


def storage_facts(sizes: DataFrame, capacity: Capacity = Capacity()) -> DataFrame:
    """Shares and flags of rows of used_bytes, data_bytes, objects; shares of nothing are 0, and the threshold itself is over it."""
    return sizes.select(
        "used_bytes",
        "data_bytes",
        "objects",
        F.coalesce(F.try_divide("used_bytes", F.lit(capacity.most_bytes)), F.lit(0.0)).alias("used_fraction"),
        (F.col("used_bytes") >= capacity.halt_bytes).alias("over_threshold"),
        F.coalesce(F.try_divide("data_bytes", "used_bytes"), F.lit(0.0)).alias("compression_ratio"),
    )
