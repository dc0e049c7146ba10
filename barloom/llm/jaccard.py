"""N-gram Jaccard join: a size-aware heavy-light join, with its connected components.

A document's set holds 63-bit hashes of its distinct shingles. Sets that are
equal are joined by a digest first, so the rest works on one document a set.

Light sets (up to ``boundary`` shingles) enumerate, for each size of a partner,
all subsets as large as the overlap that a link needs; two sets that share one
are linked, with no check to follow. Heavy sets scan inverted lists. A list
holds the sets whose first few shingles include its shingle (the prefix without
which the overlap cannot be reached), in an order that puts shingles with long
lists last; pairs must also fit by size and by place in the prefix. The boundary
is where the counts of subsets and of list entries by size cost least.

Lists do not make all pairs. First sets are compared with the pivot of their
lists, which links groups of near copies as stars. A list's pivot is the set with
the fewest rare shingles, of these the largest, so lists that hold the same sets
agree on it. After that only sets of different components are compared: in
lists under ``HOT`` members, all that fit by size and place; in longer lists, by
what each set shares with a core, the pivot and all that ``HOT`` or more of its
sets share beside it. If two sets share nothing outside the core, they share no
more than either shares with it, so sizes and shares decide, first for classes
of sets of one size and share; if they do, they meet in the
short list of a shingle that the core lacks. No link between components is lost.

Shingles are compared as 63-bit hashes: two sets of n and m shingles are taken
to share one that they do not with a chance under n * m / 2**63.

Texts without words, or null, have empty sets and link with nothing. Rows are
kept one for one. Rows of a repeated id count as one document: what one of its
texts links with, all do. Rows with a null id keep their set's size and have a
null component. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.bitmaps import id_key, maybe, shared_bitmap
from barloom.llm.common import cut, discard, keyed_text, slices, stored
from barloom.llm.components import components

# Odd multipliers that mix the words of a shingle.
MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
HOT = 32  # lists at least so long come last in the order of shingles
SALTS = 16
PARITY = 512  # bits of a set's parity signature: their differences never exceed those of the sets


@dataclass(frozen=True)
class Threshold:
    """Links need ``whole * |A & B| >= part * |A | B|``."""

    part: int
    whole: int = 100
    words: int = 4

    def overlap(self, a: int, b: int) -> int:
        return -(-self.part * (a + b) // (self.part + self.whole))

    def smallest(self, n: int) -> int:
        return -(-self.part * n // self.whole)

    def prefix(self, n: int) -> int:
        return n - self.smallest(n) + 1

    def low(self) -> float:
        """The share of the hash range whose shingles are counted: twice a prefix's share."""
        return min(1.0, 2 * (1 - self.part / self.whole))


class Shingler:
    """Sorted distinct shingle hashes of a text; word hashes are remembered up to a bound."""

    def __init__(self, words: int, memory: int = 150_000) -> None:
        self.words, self.memory, self.known = words, memory, {}

    def hashes(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        found = list(map(known.get, words))
        if None in found:
            if len(known) > self.memory:
                known.clear()
            for i, h in enumerate(found):
                if h is None:
                    w = words[i]
                    if (h := known.get(w)) is None:
                        h = known[w] = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
                    found[i] = h
        return np.array(found, np.uint64)

    def shingles(self, text: str) -> np.ndarray:
        words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z change, only \x20 \x09-\x0D divide
        n = len(words)
        if not n:
            return np.zeros(0, np.int64)
        w, k = self.hashes(words), min(self.words, n)
        h = np.full(n - k + 1, k, np.uint64)
        for j in range(k):
            h = (h ^ w[j : n - k + 1 + j]) * MIX[j]
            h ^= h >> np.uint64(29)
        return np.unique(h >> np.uint64(1)).astype(np.int64)


def _sets(df: DataFrame, limit: Threshold) -> DataFrame:
    """doc_id, n, digest, parity, low: the counted shingles and at least a prefix's number, smallest hashes first."""
    top = int(limit.low() * 2**63)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(limit.words)
        for batch in slices(it):
            ns, digests, parities, lows = [], [], [], []
            for text in batch.column(1).to_pylist():
                s = shingler.shingles(text)
                ns.append(len(s))
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=12).digest() if len(s) else None)
                parities.append(np.packbits(np.bincount(s & (PARITY - 1), minlength=PARITY) & 1).view(np.int64))
                lows.append(s[: max(limit.prefix(len(s)), np.searchsorted(s, top))] if len(s) else s)
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in lows])]).astype(np.int32)
            low = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(lows) if lows else np.zeros(0, np.int64)))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ns, pa.int32()), pa.array(digests, pa.binary()), pa.array(parities, pa.list_(pa.int64())), low], names=["doc_id", "n", "digest", "parity", "low"])

    return df.mapInArrow(run, "doc_id bigint, n int, digest binary, parity array<bigint>, low array<bigint>")


def subset_count(n: int, limit: Threshold, boundary: int) -> int:
    sizes = range(limit.smallest(n), min(boundary, n * limit.whole // limit.part) + 1)
    return sum(math.comb(n, c) for m in sizes if (c := limit.overlap(n, m)) <= min(n, m))


def choose_boundary(sizes: dict[int, int], list_length: float, limit: Threshold) -> int:
    """The boundary of least cost: subsets of light sets, against prefix entries of the others times the sets met in a list.

    Boundaries are tried as long as one set's subsets cost less than all lists do.
    """
    listed = {n: c * limit.prefix(n) * (1 + list_length) for n, c in sizes.items() if n}
    total = sum(listed.values())

    def cost(b: int) -> float:
        return sum(c * subset_count(n, limit, b) if n <= b else listed[n] for n, c in sizes.items() if n)

    best, least = 0, total
    for b in sorted(listed):
        if subset_count(b, limit, b) > total:
            break
        if (now := cost(b)) < least:
            best, least = b, now
    return best


def _stars(postings: DataFrame) -> DataFrame:
    """Edges (a, b) from each member of a subset's bucket to its least; a bucket of two sizes needs both."""
    heads = postings.groupBy("key").agg(F.min("doc_id").alias("a"), F.count("*").alias("members"), F.min("n").alias("lo"), F.max("n").alias("hi"), F.first("equal").alias("equal"))
    heads = cut(heads.where("members > 1 AND (equal OR lo < hi)").select("key", "a"))
    return postings.join(heads, "key").where("doc_id <> a").select("a", F.col("doc_id").alias("b")).distinct()


def _light(sets: DataFrame, limit: Threshold, boundary: int) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, ns, keys, equal = [], [], [], []

        def flush() -> pa.RecordBatch:
            cols = [pa.array(c, t) for c, t in zip((docs, ns, keys, equal), (pa.int64(), pa.int32(), pa.binary(), pa.bool_()), strict=True)]
            for c in (docs, ns, keys, equal):
                c.clear()
            return pa.RecordBatch.from_arrays(cols, names=["doc_id", "n", "key", "equal"])

        for batch in slices(it):
            for doc, n, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                s = np.array(s, np.int64)
                for m in range(limit.smallest(n), min(boundary, n * limit.whole // limit.part) + 1):
                    c = limit.overlap(n, m)
                    if c <= min(n, m):
                        head = struct.pack("<2I", min(n, m), max(n, m))
                        for pick in combinations(range(n), c):
                            docs.append(doc)
                            ns.append(n)
                            keys.append(hashlib.blake2b(head + s[list(pick)].tobytes(), digest_size=12).digest())
                            equal.append(n == m)
                            if len(docs) >= 50_000:
                                yield flush()
        yield flush()

    return sets.where(F.col("n").between(1, boundary)).select("doc_id", "n", "set").mapInArrow(run, "doc_id bigint, n int, key binary, equal boolean")


def _postings(sets: DataFrame, limit: Threshold, boundary: int, hot: Broadcast, shared: Broadcast) -> DataFrame:
    """shingle, doc_id, n, place, most (largest partner), rare (the set's rare shingles): prefix entries of sets that a heavy set can link with."""
    top, least = int(limit.low() * 2**63), limit.smallest(boundary + 1)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            docs, ns = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            values, at = batch.column(2).values.to_numpy(), batch.column(2).offsets.to_numpy()  # offsets count from the values' start, in slices too
            is_hot, is_shared = maybe(hot.value, values), maybe(shared.value, values)
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for i, (doc, n) in enumerate(zip(docs, ns)):
                a, b = at[i], at[i + 1]
                late = np.where(values[a:b] >= top, 2, is_hot[a:b])
                order = np.argsort(late, kind="stable")[: limit.prefix(int(n))]
                place = np.nonzero(is_shared[a:b][order])[0]
                if len(place):
                    out[0].append(values[a:b][order[place]])
                    out[1].append(np.full(len(place), doc))
                    out[2].append(np.full(len(place), n))
                    out[3].append(place)
                    out[4].append(np.full(len(place), np.count_nonzero(late == 0)))
            if out[0]:
                token, doc, n, place, rare = (np.concatenate(x).astype(np.int64) for x in out)
                most = (n - place) * (limit.part + limit.whole) // limit.part - n
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (token, doc, n, place, most, rare)], names=["shingle", "doc_id", "n", "place", "most", "rare"])

    return sets.where(F.col("n") >= least).select("doc_id", "n", "low").mapInArrow(run, "shingle bigint, doc_id bigint, n bigint, place bigint, most bigint, rare bigint")


def _full_sets(docs: DataFrame, limit: Threshold, wanted: Broadcast) -> DataFrame:
    """doc_id, set (packed sorted hashes) of the documents that ``wanted`` may hold."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(limit.words)
        for batch in slices(it):
            keep = batch.filter(pa.array(maybe(wanted.value, batch.column(2).to_numpy(zero_copy_only=False))))
            if keep.num_rows:
                sets = [shingler.shingles(t).tobytes() for t in keep.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([keep.column(0), pa.array(sets, pa.binary())], names=["doc_id", "set"])

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text", id_key("doc_id").alias("k")).mapInArrow(run, "doc_id bigint, set binary")


def _overlaps(pairs: DataFrame, sets: DataFrame, limit: Threshold, shared: Broadcast | None = None) -> DataFrame:
    """For pairs (a, b, hot): na, nb, the overlap, and of hot pairs what b has beside a.

    ``extra`` holds the shingles that another set may hold too; ``alone`` counts the others, which no list holds.
    """
    names, top = ["a", "b", "na", "nb", "overlap", "extra", "alone"], int(limit.low() * 2**63)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(it):
            na, nb, overlap, extra, alone = [], [], [], [], []
            for hot, x, y in zip(batch.column(2).to_pylist(), batch.column(3), batch.column(4), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
                at = np.searchsorted(p, q)
                at[at == len(p)] = 0
                both = p[at] == q if len(p) else np.zeros(len(q), bool)
                na.append(len(p))
                nb.append(len(q))
                overlap.append(int(both.sum()))
                more = q[~both] if hot else None
                known = (more >= top) | maybe(shared.value, more) if hot else None
                extra.append(more[known] if hot else None)
                alone.append(int((~known).sum()) if hot else None)
            cols = [pa.array(x, pa.int64()) for x in (na, nb, overlap)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *cols, pa.array(extra, pa.list_(pa.int64())), pa.array(alone, pa.int64())], names=names)

    left = pairs.join(sets.select(F.col("doc_id").alias("b"), F.col("set").alias("set_b")), "b")
    both = left.join(sets.select(F.col("doc_id").alias("a"), F.col("set").alias("set_a")), "a")
    return both.select("a", "b", "hot", "set_a", "set_b").mapInArrow(run, "a bigint, b bigint, na bigint, nb bigint, overlap bigint, extra array<bigint>, alone bigint")


def _plausible(pairs: DataFrame, slim: DataFrame, limit: Threshold) -> DataFrame:
    """The pairs (a, b) whose parity signatures differ in no more bits than linked sets may have shingles of their own."""
    for side in ("a", "b"):
        pairs = pairs.join(slim.select(F.col("doc_id").alias(side), F.col("n").alias(f"n{side}"), F.col("parity").alias(f"s{side}")), side)
    apart = F.aggregate(F.zip_with("sa", "sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
    both = F.col("na") + F.col("nb")
    return pairs.where(apart <= both - 2 * F.ceil(F.lit(limit.part) * both / F.lit(limit.part + limit.whole))).select("a", "b").distinct()


def _linked(limit: Threshold) -> Column:
    return (F.col("overlap") > 0) & (F.lit(limit.whole) * F.col("overlap") >= F.lit(limit.part) * (F.col("na") + F.col("nb") - F.col("overlap")))


def jaccard_components(df: DataFrame, limit: Threshold = Threshold(85), key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    docs = keyed_text(df, key, text)
    base = stored(_sets(docs, limit), "sets")
    slim = stored(base.select("doc_id", "n", "digest", "parity"), "sizes")
    links, classes = _links(docs, base, slim, limit)
    found = components(links)
    # a class of equal sets takes its representative's component; rows reach it by salted digests, for a class may be huge
    named = classes.join(found.withColumnRenamed("node", "rep"), "rep", "left").select("digest", "rep", "members", F.coalesce("component", "rep").alias("component_id"))
    named = cut(named)
    sized = slim.select("doc_id", F.col("n").cast("bigint").alias("n_shingles"), "digest")
    own = sized.join(named.select(F.col("rep").alias("doc_id"), "digest", "component_id"), ["doc_id", "digest"], "left")
    done = own.where(F.col("component_id").isNotNull() | F.col("digest").isNull() | F.col("doc_id").isNull())
    done = done.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    rest = own.where(F.col("component_id").isNull() & F.col("digest").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "n_shingles", "digest")
    salted = named.where("members > 1").select("digest", "component_id", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    copies = rest.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int")).join(salted, ["digest", "salt"])
    return done.unionByName(copies.select("doc_id", "n_shingles", "component_id"))


def _one_id(known: DataFrame, classes: DataFrame) -> DataFrame:
    """Edges (a, b) between the representatives of all texts that one id holds; ids of one text give none."""
    held = known.select("doc_id", "digest").groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi")).where("lo <> hi").select("doc_id")
    reps = known.select("doc_id", "digest").join(held, "doc_id").join(classes, "digest").select("doc_id", "rep").distinct()
    return reps.select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))


def _links(docs: DataFrame, base: DataFrame, slim: DataFrame, limit: Threshold) -> tuple[DataFrame, DataFrame]:
    """Edges (a, b) that connect all linked representatives, and the classes of equal sets (digest, rep, members).

    Steps are stored as Parquet, and what no later step reads is removed on the way.
    """
    has_set = F.col("digest").isNotNull() & F.col("doc_id").isNotNull()
    classes = cut(slim.where(has_set).groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("members")))
    reps = classes.select(F.col("rep").alias("doc_id")).distinct()
    known = base.where(has_set)

    lists = known.select(F.explode("low").alias("shingle")).groupBy("shingle").agg(F.count("*").alias("df")).where("df > 1")
    lists = stored(lists, "lists")
    shared, hot = shared_bitmap(lists, F.col("shingle")), shared_bitmap(lists.where(F.col("df") >= HOT), F.col("shingle"))
    mean = lists.where(F.col("df") < HOT).select(F.sum(F.col("df") * F.col("df")) / F.sum("df")).first()[0]
    discard(lists)
    boundary = _boundary(slim, mean or 0.0, limit)

    entries = stored(_postings(known, limit, boundary, hot, shared).join(reps, "doc_id", "left_semi"), "entries")
    hot.destroy()
    discard(base)
    heads = entries.groupBy("shingle").agg(F.min(F.struct("rare", -F.col("n"), "doc_id", "n")).alias("pivot"), F.count("*").alias("members"), F.min("n").alias("least"))
    heads = cut(heads.where("members > 1"))
    live = entries.join(heads, "shingle").where(F.col("most") >= F.col("least"))
    live = live.select("shingle", entries["doc_id"], entries["n"], "place", "most", F.col("pivot.doc_id").alias("p"), F.col("pivot.n").alias("pn"), (F.col("members") >= HOT).alias("hot"))
    live = stored(live, "live")
    discard(entries)

    def fits(n: Column, m: Column) -> Column:
        return (F.lit(limit.whole) * F.least(n, m) >= F.lit(limit.part) * F.greatest(n, m)) & (F.greatest(n, m) > F.lit(boundary))

    near = live.where((F.col("doc_id") != F.col("p")) & fits(F.col("n"), F.col("pn")) & (F.col("pn") <= F.col("most")))
    votes = near.groupBy("doc_id", "p").agg(F.count("*").alias("votes")).groupBy("doc_id").agg(F.max_by("p", F.struct("votes", -F.col("p"))).alias("p"))
    near = _plausible(votes.select(F.col("p").alias("a"), F.col("doc_id").alias("b")), slim, limit).withColumn("hot", F.lit(False))
    pivots = near.union(live.where("hot AND doc_id <> p").select(F.col("p").alias("a"), F.col("doc_id").alias("b"), "hot").distinct())
    stars = cut(pivots.groupBy("a", "b").agg(F.max("hot").alias("hot")))

    light = slim.where(F.col("n").between(1, boundary)).select("doc_id").join(reps, "doc_id", "left_semi")
    ends = stars.select("a").union(stars.select("b"))
    wanted = shared_bitmap(ends.union(light) if boundary else ends, id_key("a"))
    sets = stored(_full_sets(docs, limit, wanted), "full")
    wanted.destroy()
    edges = _one_id(slim.where(has_set), classes)
    if boundary:
        unpacked = sets.withColumn("n", (F.octet_length("set") / 8).cast("int")).where(F.col("n") <= boundary).join(light, "doc_id", "left_semi")
        subsets = stored(_light(_unpack(unpacked), limit, boundary), "subsets")
        edges = cut(edges.union(_stars(subsets)))
        discard(subsets)
    met = stored(_overlaps(stars, sets, limit, shared), "overlaps")
    shared.destroy()
    found = cut(met.where(_linked(limit)).select("a", "b").union(edges))
    discard(sets)
    label = cut(components(found).withColumnRenamed("node", "doc_id"))

    def labelled(rows: DataFrame) -> DataFrame:
        return rows.join(label, "doc_id", "left").withColumn("c", F.coalesce("component", "doc_id")).drop("component")

    def mixed(rows: DataFrame, *keys: str) -> DataFrame:
        """Rows of the keys that hold several components."""
        several = cut(rows.groupBy(*keys).agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select(*keys))
        return rows.join(several, list(keys))

    def twice(rows: DataFrame, keys: list[str], *columns: str) -> DataFrame:
        return rows.join(rows.select(*keys, *(F.col(c).alias(f"{c}_") for c in columns)), keys).where("c <> c_")

    # lists that still hold several components
    named = stored(labelled(live.drop("pn")), "named")
    discard(live)
    lists = stored(mixed(named, "shingle"), "mixed")
    discard(named)

    # short lists: the smaller or equal set of a pair is found by a shorter prefix
    short = lists.where("NOT hot").select("shingle", "doc_id", "n", "place", "most", "c")
    role = F.lit(limit.part + limit.whole) * (F.col("n_") - F.col("place_")) >= F.lit(2 * limit.part) * F.col("n_")
    order = (F.col("n_") < F.col("n")) | ((F.col("n_") == F.col("n")) & (F.col("doc_id_") < F.col("doc_id")))
    pairs = twice(short, ["shingle"], "doc_id", "n", "place", "most", "c").where(order & role & fits(F.col("n"), F.col("n_")) & (F.col("n") <= F.col("most_")) & (F.col("n_") <= F.col("most"))).select("doc_id", "doc_id_").distinct()

    # long lists: what their sets have of their pivots and beside them
    beside = lists.where("hot AND doc_id <> p").select(F.col("p").alias("a"), F.col("doc_id").alias("b")).distinct()
    members = met.where("extra IS NOT NULL").join(beside, ["a", "b"], "left_semi").select("a", F.col("b").alias("doc_id"), F.col("nb").alias("n"), "na", "overlap", "alone", "extra")
    members = stored(labelled(members), "members")
    outside = members.select("a", "doc_id", "n", "c", "alone", F.explode("extra").alias("shingle"))
    tally = cut(outside.groupBy("a", "shingle").agg(F.count("*").alias("members"), F.min("c").alias("lo"), F.max("c").alias("hi")).where("members > 1"))
    core = outside.join(tally.where(F.col("members") >= HOT).select("a", "shingle"), ["a", "shingle"]).groupBy("a", "doc_id").agg(F.count("*").alias("more"))
    around = members.select("a", "doc_id", "n", "overlap", "c").join(core, ["a", "doc_id"], "left").select("a", "doc_id", "n", "c", (F.col("overlap") + F.coalesce("more", F.lit(0))).alias("inside"))
    own = members.groupBy("a").agg(F.first("na").alias("n")).select("a", F.col("a").alias("doc_id"), "n", F.col("n").alias("inside"))
    around = stored(around.unionByName(labelled(own)), "around")

    # nothing shared outside the core: what two sets share is at most what either shares with it; first by classes of size and share
    kinds = around.where(F.lit(limit.whole) * F.col("inside") >= F.lit(limit.part) * F.col("n")).groupBy("a", "n", "inside").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    kinds = cut(kinds)
    others = kinds.select("a", *(F.col(c).alias(f"{c}_") for c in ("n", "inside", "lo", "hi")))
    need = F.lit(limit.part) * (F.col("n") + F.col("n_")) <= F.lit(limit.part + limit.whole) * F.least("inside", "inside_")
    several = (F.col("lo") != F.col("lo_")) | (F.col("hi") != F.col("hi_")) | (F.col("lo") != F.col("hi"))
    alike = cut(kinds.join(others, "a").where(need & several & fits(F.col("n"), F.col("n_"))).select("a", "n", "inside", "n_", "inside_"))
    band = around.join(alike, ["a", "n", "inside"]).join(around.select("a", *(F.col(c).alias(f"{c}_") for c in ("doc_id", "c", "n", "inside"))), ["a", "n_", "inside_"])
    band = band.where("c <> c_ AND doc_id < doc_id_").select("doc_id", "doc_id_").distinct()

    # something shared outside the core: prefixes again, of what a set has beside the core, rarest first
    outside = outside.join(tally, ["a", "shingle"], "left").where(F.coalesce("members", F.lit(1)) < HOT)
    rank = F.col("alone") + F.row_number().over(Window.partitionBy("a", "doc_id").orderBy(F.coalesce("members", F.lit(1)), "shingle"))
    first = F.col("n") - F.ceil(F.lit(limit.part) * F.col("n") / F.lit(limit.whole)) + 1
    beside = outside.withColumn("rank", rank).where((F.col("rank") <= first) & (F.col("lo") < F.col("hi"))).join(around.select("a", "doc_id", "inside"), ["a", "doc_id"])
    beside = beside.select("a", "shingle", "doc_id", "n", "c", "inside", (F.col("n") - F.col("inside") - F.col("rank") + 1).alias("left"))
    beside = stored(beside, "beside")
    reach = F.lit(limit.part) * (F.col("n") + F.col("n_")) <= F.lit(limit.part + limit.whole) * (F.least("inside", "inside_") + F.least("left", "left_"))
    beyond = twice(beside, ["a", "shingle"], "doc_id", "n", "c", "inside", "left").where((F.col("doc_id") < F.col("doc_id_")) & reach & fits(F.col("n"), F.col("n_"))).select("doc_id", "doc_id_").distinct()

    pairs = pairs.union(band).union(beyond).select(F.least("doc_id", "doc_id_").alias("a"), F.greatest("doc_id", "doc_id_").alias("b")).distinct()
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = cut(_plausible(pairs.join(tried, ["a", "b"], "left_anti"), slim, limit).withColumn("hot", F.lit(False)))
    for used in (lists, met, members, around, beside):
        discard(used)
    wanted = shared_bitmap(pairs.select("a").union(pairs.select("b")), id_key("a"))
    sets = stored(_full_sets(docs, limit, wanted), "full")
    wanted.destroy()
    links = cut(found.union(_overlaps(pairs, sets, limit).where(_linked(limit)).select("a", "b")))
    discard(sets)
    return links, classes


def _boundary(slim: DataFrame, list_length: float, limit: Threshold) -> int:
    """The boundary of least cost for the sizes of all sets; sizes beyond any that could be light come as one row."""
    n = F.col("n").cast("bigint")
    prefix = n - F.ceil(F.lit(limit.part) * n / F.lit(limit.whole)) + 1
    total = (slim.where("n > 0").select(F.sum(prefix)).first()[0] or 0) * (1 + list_length)
    top = 1
    while subset_count(top, limit, top) <= total:
        top += 1
    sizes = {r["n"]: r["c"] for r in slim.where(F.col("n").between(1, top)).groupBy("n").agg(F.count("*").alias("c")).collect()}  # at most ``top`` rows
    return choose_boundary(sizes, list_length, limit)


def _unpack(packed: DataFrame) -> DataFrame:
    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            sets = [np.frombuffer(x.as_buffer(), np.int64).tolist() for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sets, pa.list_(pa.int64()))], names=["doc_id", "n", "set"])

    return packed.select("doc_id", "n", "set").mapInArrow(run, "doc_id bigint, n int, set array<bigint>")


def brute_force(rows: list[tuple[int, str | None]], limit: Threshold = Threshold(85)) -> dict[int, tuple[int, int]]:
    """doc_id -> (n_shingles, component_id) by comparing all; for tests, on distinct ids."""
    sets = {}
    for doc, text in rows:
        words = (text or "").encode().lower().split()
        k = min(limit.words, len(words))
        sets[doc] = {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if words else set()
    of = {d: d for d in sets}

    def root(d: int) -> int:
        while of[d] != d:
            d = of[d]
        return d

    docs = sorted(sets)
    for i, a in enumerate(docs):
        for b in docs[:i]:
            inter = len(sets[a] & sets[b])
            if inter and limit.whole * inter >= limit.part * len(sets[a] | sets[b]):
                x, y = root(a), root(b)
                of[max(x, y)] = min(x, y)
    return {d: (len(s), root(d)) for d, s in sets.items()}
