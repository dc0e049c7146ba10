"""Fixed-size bitmaps over 63-bit keys: a task skips rows that cannot matter, whatever the input's size.

A bitmap has 2**26 bits (8 MB) however many keys go in. It only answers "surely
not" or "maybe": where it fills up, less is skipped and results stay the same.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS, BITS = 2048, 32768


def collect_bitmap(df: DataFrame, key: Column) -> np.ndarray:
    """Bits of all keys (non-negative bigints), gathered as at most ``BUCKETS`` rows of 4 KB."""
    rows = df.select(F.shiftright(key, 15).alias("h"), (key % BITS).alias("bit")).select((F.col("h") % BUCKETS).alias("bucket"), "bit")
    out = np.zeros((BUCKETS, BITS // 8), np.uint8)
    for r in rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("bits")).toLocalIterator():
        out[r["bucket"]] = np.frombuffer(bytes(r["bits"]), np.uint8)
    return out


def shared_bitmap(df: DataFrame, key: Column) -> Broadcast:
    """The bitmap of all keys as a broadcast, which its user destroys when the last job that reads it is over."""
    return df.sparkSession.sparkContext.broadcast(collect_bitmap(df, key))


def maybe(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False where a key (non-negative int64) is surely not in the bitmap."""
    k = keys.astype(np.int64)
    bit = k & (BITS - 1)
    return (bitmap[(k >> 15) & (BUCKETS - 1), bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1


def id_key(column: str | Column) -> Column:
    """A bitmap key of an id."""
    return F.xxhash64(column).bitwiseAND(F.lit((1 << 63) - 1))
