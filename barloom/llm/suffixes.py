"""Suffix dedup: repeated passages by hashes of suffixes at minimisers and of windows around them.

A passage counts when at least ``min_words`` words (50) occur word for word at
an earlier place, in a smaller doc_id or earlier in the same text. Suffixes are
kept only at minimisers, the word groups with the least hash among ``reach``
neighbours, so that two equal passages keep suffixes at equal places. The kept
suffixes are sorted across the cluster by a hash of their first words, which is
no suffix order, and neighbours are compared: a suffix unlike both neighbours is dropped. What is left is extended
left and right: the hash of every window of ``min_words`` words that a minimiser
stands for is compared with its neighbours in a second sort, except where the whole stretch
around the suffix equals the neighbour's already. Both sorts are range
partitioned by content, document and place, so equal passages, however many,
spread over tasks, and the comparison carries across partition borders.
Stretches and windows are known by two hashes, 126 bits together, so that even
among 10**14 windows unequal ones meet with a chance under 10**-9.

The first occurrence stays, all later ones are repeated. Words are runs without
ASCII white space, compared as they are. Null and empty texts, and rows with a
null id, have no repeated words. Rows are kept one for one; rows of one id and
one text are one occurrence, and different texts of one id are documents of
their own, in the order of a hash of the text (``row``). Other columns pass
through ``remove_repeats`` and are ignored elsewhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.bitmaps import maybe, shared_bitmap
from barloom.llm.common import discard, keyed_text, slices, stored
from barloom.llm.jaccard import MIX, Shingler

GRAM = 4
BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


class _Powers:
    """Powers of a hash base and of its inverse modulo 2**64."""

    def __init__(self, base: int) -> None:
        self.bases = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, b, np.uint64)])) for b in self.bases)
        return self.up, self.down


def least(g: np.ndarray, reach: int) -> np.ndarray:
    """For every run of ``reach`` values the place of its least (ties: the leftmost), in memory that grows with the values alone."""
    at, size = np.arange(len(g)), 1
    while size < reach:
        step = min(size, reach - size)
        left, right = at[:-step], at[step:]
        at = np.where(g[right] < g[left], right, left)
        size += step
    return at


class Passages:
    """Minimisers and stretch hashes of one text."""

    def __init__(self, min_words: int, reach: int) -> None:
        if reach + GRAM > min_words:
            raise ValueError("a window must hold all its minimiser's neighbours")
        self.min_words, self.reach = min_words, reach
        self.words, self.powers = Shingler(1), [_Powers(b) for b in BASES]

    def read(self, text: str) -> bool:
        raw = text.encode("utf-8", "surrogatepass").split()
        self.n = n = len(raw)
        if n < self.min_words:
            return False
        w = self.words.hashes(raw)
        g = np.zeros(n - GRAM + 1, np.uint64)
        for j in range(GRAM):
            g = (g ^ w[j : n - GRAM + 1 + j]) * MIX[j]
            g ^= g >> np.uint64(29)
        self.down, self.sums = [], []
        for powers in self.powers:
            up, down = powers.upto(n + 1)
            self.down.append(down)
            self.sums.append(np.concatenate([[np.uint64(0)], np.cumsum(w * up[:n])]))
            w = (w ^ (w >> np.uint64(32))) * MIX[4]  # the second hash sees other numbers for the words
        starts = n - self.min_words + 1
        at = least(g, self.reach)[:starts]
        self.lo = np.nonzero(np.concatenate([[True], at[1:] != at[:-1]]))[0]
        self.pos = at[self.lo]
        self.count = np.diff(np.append(self.lo, starts))
        return True

    def stretch(self, a: np.ndarray, b: np.ndarray, which: int = 0) -> np.ndarray:
        """63-bit hashes of the words from a to b, by the first or second base."""
        h = (self.sums[which][b] - self.sums[which][a]) * self.down[which][a]
        h ^= h >> np.uint64(31)
        h *= MIX[1]
        h ^= h >> np.uint64(29)
        return (h >> np.uint64(1)).astype(np.int64)

    def suffixes(self) -> np.ndarray:
        """Hashes of the words that every window has from its minimiser on."""
        return self.stretch(self.pos, self.pos + self.min_words - self.reach + 1)

    def stretches(self, which: int) -> np.ndarray:
        """Hashes of all that a minimiser's windows cover, and of their places around it."""
        h = self.stretch(self.lo, self.lo + self.count - 1 + self.min_words, which)
        return (h ^ ((self.pos - self.lo) * 1_000_003 + self.count)) & np.int64((1 << 63) - 1)


def _row(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def _place(doc: int | np.ndarray, row: int | np.ndarray, lo: np.ndarray) -> np.ndarray:
    """A bitmap key of a minimiser's place."""
    h = (np.asarray(doc).astype(np.uint64) * MIX[0]) ^ (np.asarray(row).astype(np.uint64) * MIX[1]) ^ (lo.astype(np.uint64) * MIX[2])
    h ^= h >> np.uint64(32)
    return ((h * MIX[3]) >> np.uint64(1)).astype(np.int64)


def _scan(docs: DataFrame, min_words: int, reach: int) -> DataFrame:
    """suffix, stretch, stretch2, doc_id, row, lo, count of every minimiser."""
    names = ["suffix", "stretch", "stretch2", "doc_id", "row", "lo", "count"]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Passages(min_words, reach)
        for batch in slices(it):
            out: list[list[np.ndarray]] = [[] for _ in names]
            for doc, text, row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if p.read(text):
                    for column, x in zip(out, (p.suffixes(), p.stretches(0), p.stretches(1), np.full(len(p.lo), doc, np.int64), np.full(len(p.lo), row, np.int64), p.lo.astype(np.int32), p.count.astype(np.int32)), strict=True):
                        column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=names)

    return docs.mapInArrow(run, "suffix bigint, stretch bigint, stretch2 bigint, doc_id bigint, row bigint, lo int, count int")


HELD = 50_000  # rows that are gathered by document before they leave a task


def _by_document(parts: list[list[np.ndarray]], min_words: int) -> pa.RecordBatch:
    """doc_id, row, whole (stretches that repeat, and where from), places (of the others): one row a document."""
    doc, row, lo, count, place, source, same = (np.concatenate(x) for x in zip(*parts))
    order = np.lexsort((lo, row, doc))
    doc, row, lo, count, place, source, same = (x[order] for x in (doc, row, lo, count, place, source, same))
    first = np.nonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (row[1:] != row[:-1])]))[0]

    def lists(keep: np.ndarray, values: pa.Array) -> pa.Array:
        upto = np.concatenate([[0], np.cumsum(keep)])
        return pa.ListArray.from_arrays(pa.array(upto[np.append(first, len(doc))].astype(np.int32)), values)

    spans = pa.StructArray.from_arrays([pa.array(x[same]) for x in (lo.astype(np.int32), (lo + count - 1 + min_words).astype(np.int32), source)], names=["a", "b", "source"])
    return pa.RecordBatch.from_arrays([pa.array(doc[first]), pa.array(row[first]), lists(same, spans), lists(~same, pa.array(place[~same]))], names=["doc_id", "row", "whole", "places"])


def _compare_suffixes(sorted_rows: DataFrame, min_words: int) -> DataFrame:
    """Of rows sorted by suffix, stretch and place those like a neighbour, gathered by document in each task.

    ``whole`` has the stretches that equal the neighbour's before, at another place, and its doc; ``places`` the place keys of the others.

    The first of equal suffixes is left out where all of them, seen in one batch, have its stretch. The first and
    last row of a partition, whose outer neighbour is elsewhere, are kept; the windows decide on them.
    """

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last row, held back until its next neighbour is known
        prior, ended, parts = None, False, []
        while not ended:
            batch = next(it, None)
            ended = batch is None
            rows = [] if ended else [batch.column(i).to_numpy() for i in range(7)]
            if ended and held is None:
                break
            if held is not None:
                rows = [np.concatenate([h, r]) for h, r in zip(held, rows, strict=True)] if not ended else held
            if not len(rows[0]):
                continue
            suffix, stretch, stretch2, doc, row, lo, count = rows
            n = len(suffix) if ended else len(suffix) - 1
            if n:
                before = np.concatenate([[prior[0] if prior else -1], suffix[:-1]])
                like_before = suffix == before
                like_next = np.append(suffix[1:] == suffix[:-1], ended)
                if prior is None:
                    like_next[0] = True
                was = [np.concatenate([[prior[k] if prior else -1], x[:-1]]) for k, x in enumerate((suffix, stretch, stretch2, doc, row, lo))]
                source = was[3]
                # rows of one id and one text are one occurrence, no repeat of each other
                same = like_before & (stretch == was[1]) & (stretch2 == was[2]) & ((doc != source) | (row != was[4]) | (lo != was[5]))
                keep = (like_before | like_next)[:n]
                # suffixes in a row that share one stretch are whole repeats of their first, whose windows nothing needs then
                begin = np.nonzero(~like_before)[0]
                first, last = begin[:-1], begin[1:] - 1
                first = first[(stretch[first] == stretch[last]) & (stretch2[first] == stretch2[last])]
                keep[first if prior else first[first > 0]] = False
                if keep.any():
                    parts.append([x[:n][keep] for x in (doc, row, lo, count, _place(doc, row, lo), source, same)])
                    if sum(len(x[0]) for x in parts) >= HELD:
                        yield _by_document(parts, min_words)
                        parts.clear()
                prior = tuple(x[n - 1] for x in (suffix, stretch, stretch2, doc, row, lo))
            held = None if ended else [x[n:] for x in rows]
        if parts:
            yield _by_document(parts, min_words)

    return sorted_rows.mapInArrow(run, "doc_id bigint, row bigint, whole array<struct<a: int, b: int, source: bigint>>, places array<bigint>")


def _windows(docs: DataFrame, min_words: int, reach: int, places: Broadcast) -> DataFrame:
    """window, window2, doc_id, row, start of all windows of the minimisers whose place ``places`` may hold."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Passages(min_words, reach)
        for batch in slices(it):
            out: list[list[np.ndarray]] = [[], [], [], [], []]
            for doc, text, row in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if p.read(text):
                    keep = maybe(places.value, _place(np.int64(doc), np.int64(row), p.lo))
                    if keep.any():
                        n = p.count[keep]
                        start = np.repeat(p.lo[keep], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                        for column, x in zip(out, (p.stretch(start, start + min_words), p.stretch(start, start + min_words, 1), np.full(len(start), doc, np.int64), np.full(len(start), row, np.int64), start.astype(np.int32)), strict=True):
                            column.append(x)
            if out[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in out], names=["window", "window2", "doc_id", "row", "start"])

    return docs.mapInArrow(run, "window bigint, window2 bigint, doc_id bigint, row bigint, start int")


def _compare_windows(sorted_rows: DataFrame) -> DataFrame:
    """Of rows sorted by window and place: repeats with the neighbour's doc; and each partition's first and last row, marked."""
    names = ["kind", "part", "window", "window2", "doc_id", "row", "start", "source"]

    def rows(kind: int, part: int, *columns: np.ndarray) -> pa.RecordBatch:
        n = len(columns[0])
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int32)), pa.array(np.full(n, part, np.int32)), *map(pa.array, columns)], names=names)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last = TaskContext.get().partitionId(), None
        for batch in it:
            if not batch.num_rows:
                continue
            columns = [batch.column(i).to_numpy() for i in range(5)]
            window, window2, doc, row, start = columns
            if last is None:
                yield rows(0, part, *(c[:1] for c in columns), doc[:1])
                last = (window[0] ^ 1, *(c[0] for c in columns[1:]))
            before = [np.concatenate([[x], c[:-1]]) for x, c in zip(last, columns, strict=True)]
            same = (window == before[0]) & (window2 == before[1]) & ((doc != before[2]) | (row != before[3]) | (start != before[4]))
            if same.any():
                yield rows(1, part, *(c[same] for c in columns), before[2][same])
            last = tuple(c[-1] for c in columns)
        if last is not None:
            yield rows(2, part, *(np.array([x], t) for x, t in zip(last, (*[np.int64] * 4, np.int32), strict=True)), np.array([last[2]], np.int64))

    return sorted_rows.mapInArrow(run, "kind int, part int, window bigint, window2 bigint, doc_id bigint, row bigint, start int, source bigint")


def repeated_spans(df: DataFrame, min_words: int = 50, reach: int = 32, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, row, spans array<struct<a, b>> (word places, disjoint, sorted), source_ids of documents that have repeated passages."""
    docs = keyed_text(df, key, text).where(F.col("doc_id").isNotNull()).withColumn("row", _row(F.col("text")))
    kept = stored(_scan(docs, min_words, reach), "suffixes")
    order = ["suffix", "stretch", "stretch2", "doc_id", "row", "lo"]
    alike = stored(_compare_suffixes(kept.repartitionByRange(*order).sortWithinPartitions(*order), min_words), "alike")
    discard(kept)
    places = shared_bitmap(alike.select(F.explode("places").alias("place")), F.col("place"))
    windows = stored(_windows(docs, min_words, reach, places), "windows")
    places.destroy()
    order = ["window", "window2", "doc_id", "row", "start"]
    compared = stored(_compare_windows(windows.repartitionByRange(*order).sortWithinPartitions(*order)), "compared")
    discard(windows)
    # a partition's first row repeats the last row before it if their windows are equal: two rows a partition meet here
    before = Window.orderBy("part", "kind")
    ends = compared.where("kind <> 1").withColumns({c: F.lag(x).over(before) for c, x in (("w", "window"), ("w2", "window2"), ("d", "doc_id"), ("r", "row"), ("s", "start"))})
    carried = ends.where("kind = 0 AND window = w AND window2 = w2 AND (doc_id <> d OR row <> r OR start <> s)").select("doc_id", "row", "start", F.col("d").alias("source"))
    single = compared.where("kind = 1").select("doc_id", "row", "start", "source").union(carried)
    span = F.struct(F.col("start").alias("a"), (F.col("start") + min_words).alias("b"), "source")
    found = single.select("doc_id", "row", F.array(span).alias("whole")).union(alike.where(F.size("whole") > 0).select("doc_id", "row", "whole"))
    # a document's own intervals: no more than it has words
    by_doc = found.groupBy("doc_id", "row").agg(F.flatten(F.collect_list("whole")).alias("whole"))
    by_doc = by_doc.select("doc_id", "row", F.array_sort(F.transform("whole", lambda x: F.struct(x["a"].alias("a"), x["b"].alias("b")))).alias("s"), F.array_sort(F.array_distinct(F.transform("whole", lambda x: x["source"]))).alias("source_ids"))

    def merge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(it):
            out = []
            for pairs in batch.column(2).to_pylist():
                spans: list[list[int]] = []
                for x in pairs:
                    if spans and x["a"] <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], x["b"])
                    else:
                        spans.append([x["a"], x["b"]])
                out.append([{"a": a, "b": b} for a, b in spans])
            kind = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, kind), batch.column(3)], names=["doc_id", "row", "spans", "source_ids"])

    return by_doc.mapInArrow(merge, "doc_id bigint, row bigint, spans array<struct<a: int, b: int>>, source_ids array<bigint>")


def report(df: DataFrame, min_words: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_repeated (words), n_spans, spans as 'a-b a-b', source_ids (documents with an earlier occurrence) of every row."""
    spans = repeated_spans(df, min_words, key=key, text=text)
    rows = df.select(F.col(key).cast("bigint").alias("doc_id"), _row(F.col(text)).alias("row")).join(spans, ["doc_id", "row"], "left")
    words = F.aggregate("spans", F.lit(0), lambda n, s: n + s["b"] - s["a"])
    shown = F.array_join(F.transform("spans", lambda s: F.concat_ws("-", s["a"].cast("string"), s["b"].cast("string"))), " ")
    return rows.select("doc_id", F.coalesce(words, F.lit(0)).cast("bigint").alias("n_repeated"), F.coalesce(F.size("spans"), F.lit(0)).cast("bigint").alias("n_spans"), F.coalesce(shown, F.lit("")).alias("spans"), F.coalesce("source_ids", F.array().cast("array<bigint>")).alias("source_ids"))


def cut_words(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans; white space before each next word stays with the word before the span."""
    raw = text.encode("utf-8", "surrogatepass")
    at = [m.start() for m in WORD.finditer(raw)] + [len(raw)]
    out, last = [], 0
    for s in spans:
        out.append(raw[last : at[s["a"]]])
        last = at[s["b"]]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


def remove_repeats(df: DataFrame, min_words: int = 50, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df``, all columns whatever their names, with repeated passages cut from the text."""
    names = df.columns
    spans = repeated_spans(df, min_words, key=key, text=text).select("doc_id", "row", "spans")
    held = df.select(F.col(key).cast("bigint").alias("doc_id"), _row(F.col(text)).alias("row"), F.struct(*(F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names))).alias("held"))
    joined = held.join(spans, ["doc_id", "row"], "left").select("held.*", "spans")

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = names.index(text)
        for batch in slices(it):
            texts = [t if not s or t is None else cut_words(t, s) for t, s in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist(), strict=True)]
            columns = [pa.array(texts, pa.string()) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return joined.mapInArrow(run, df.schema)


def brute_force(rows: list[tuple[int, str | None]], min_words: int = 50) -> dict[int, list[tuple[int, int]]]:
    """doc_id -> spans, by a dictionary of all windows; for tests, on distinct ids."""
    seen: set[tuple] = set()
    out: dict[int, list[tuple[int, int]]] = {}
    for doc, text in sorted(rows, key=lambda r: r[0]):
        words, spans = (text or "").encode().split(), []
        for s in range(len(words) - min_words + 1):
            w = tuple(words[s : s + min_words])
            if w in seen:
                if spans and s <= spans[-1][1]:
                    spans[-1] = (spans[-1][0], s + min_words)
                else:
                    spans.append((s, s + min_words))
            seen.add(w)
        if spans:
            out[doc] = spans
    return out
