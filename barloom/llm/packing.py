"""Best-fit packing of token sequences by exact-complement hashing over the histogram of lengths.

Every text is tokenised once; a document's ids are those of the tokenizers library and end with
an end-of-text id, and only documents beyond the capacity are cut (the first
piece takes the remainder). The plan works on counts by length, of which there
are at most ``capacity``, whatever the input. Lengths, sums of two and sums of
three are indexed by their sum. For each length from the longest the gap that it
leaves is looked up among singles, pairs and triples, and matching combinations
are consumed in bulk as long as all counts last; what is left goes
best fit. Pieces then find their slots without meeting: a piece's rank within
its length (its rank in its partition, plus the counts of earlier partitions)
decides which slot of which pattern it takes.

Null text is empty and makes one piece of the end id alone. Rows are kept one
for one: repeated ids are packed each on their own; other columns are ignored.
Empty input gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from barloom.llm.common import keyed_text, slices, stored

# Fixed value: how byte-level vocabularies of this family part a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
CHECKED = 8  # texts of a slice whose ids are held against the library's
PIECES = "doc_id bigint, piece int, start bigint, length int, ids_crc32 bigint, part int, nth bigint"
Pattern = tuple[tuple[int, ...], int]


def _bytes_of(library: Tokenizer) -> dict[str, int]:
    """The byte that each letter of the vocabulary stands for, asked from the library character by character."""
    out: dict[str, int] = {}
    samples = [*range(0x801), *range(0x1000, 0x10000, 0x1000), *range(0x10000, 0x110000, 0x40000)]
    for code in samples:
        letters = "".join(part for part, _ in library.pre_tokenizer.pre_tokenize_str(chr(code)))
        out |= dict(zip(letters, chr(code).encode(), strict=True))
    return out


def _by_ranks(path: str, library: Tokenizer) -> tiktoken.Encoding | None:
    """The same vocabulary as merge ranks, or None where ids do not follow the order of its merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, added = model["vocab"], {t.content: i for i, t in library.get_added_tokens_decoder().items()}
    merged = [vocab["".join(m) if isinstance(m, list) else m.replace(" ", "")] for m in model["merges"]]
    if merged != sorted(set(merged)):
        return None
    letters = _bytes_of(library)
    ranks = {bytes(map(letters.__getitem__, t)): i for t, i in vocab.items() if t not in added and all(c in letters for c in t)}
    return tiktoken.Encoding("barloom", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)


class Ids:
    """Ids of texts as the tokenizers library gives them, several times faster.

    Where the vocabulary's ids follow its merges, they are also ranks, by which
    tiktoken merges; the ids are the same. ``checked`` holds a text's ids against
    the library's own, which are used for all texts once any differ, or where
    the vocabulary is of another kind.
    """

    def __init__(self, path: str) -> None:
        self.library = Tokenizer.from_file(path)
        self.fast = _by_ranks(path, self.library)

    def ids(self, text: str) -> np.ndarray:
        found = self.fast.encode(text, allowed_special="all") if self.fast else self.library.encode(text, add_special_tokens=False).ids
        return np.array(found, "<u4")

    def checked(self, text: str) -> bool:
        if self.fast and self.fast.encode(text, allowed_special="all") != self.library.encode(text, add_special_tokens=False).ids:
            self.fast = None
        return self.fast is not None


def pieces(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a piece with its place in its document, and its rank by length in its partition."""
    names = [x.split()[0] for x in PIECES.split(", ")]
    types = [pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, seen = Ids(tokenizer_path), TaskContext.get().partitionId(), Counter()
        for batch in slices(it):
            rows, texts = [], batch.column(1).to_pylist()
            for body in texts[:: max(1, len(texts) // CHECKED)]:
                encoder.checked(body)
            for doc, body in zip(batch.column(0).to_pylist(), texts, strict=True):
                ids = np.append(encoder.ids(body), np.uint32(end_id))
                n = len(ids)
                cuts = [0, *range(n % capacity or capacity, n + 1, capacity)] if n > capacity else [0, n]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    rows.append((doc, k, a, b - a, zlib.crc32(ids[a:b].tobytes()), part, seen[b - a]))
                    seen[b - a] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names=names)

    return keyed_text(df, key, text).mapInArrow(run, PIECES)


class Sums:
    """Sums of one, two and three lengths, each sum with the combinations that make it.

    Counts only fall, so a combination that has lost a length is dropped for good:
    a pair's entry is removed, and a triple, kept as a length and a pair's sum, is
    passed over once either is gone.
    """

    def __init__(self, have: np.ndarray) -> None:
        self.have = have
        self.live = np.nonzero(have)[0]
        top = len(have) - 1
        a, b = np.meshgrid(self.live, self.live, indexing="ij")
        fit = (a >= b) & (a + b <= top)
        a, total = a[fit], (a + b)[fit]
        order = np.lexsort((a, total))  # within a sum the longest partner comes last, so that it can be popped
        edges = np.searchsorted(total[order], np.arange(top + 2))
        a = a[order]
        self.pairs = [a[x:y].tolist() for x, y in zip(edges, edges[1:])]

    def enough(self, lengths: tuple[int, ...]) -> bool:
        return all(self.have[n] >= lengths.count(n) for n in lengths)

    def pair(self, total: int, besides: tuple[int, ...]) -> tuple[int, int] | None:
        """Two lengths of the sum that last beside ``besides``, the longest first."""
        found = self.pairs[total]
        while found and not (self.have[found[-1]] and self.have[total - found[-1]]):
            found.pop()
        for a in reversed(found):
            if self.enough((*besides, a, total - a)):
                return a, total - a
        return None

    def complement(self, longest: int) -> tuple[int, ...] | None:
        """``longest`` with the single, pair or triple that exactly fills its gap, in this order."""
        gap = len(self.have) - 1 - longest
        if gap == 0:
            return (longest,)
        if self.enough((longest, gap)):
            return longest, gap
        if two := self.pair(gap, (longest,)):
            return longest, *two
        for a in range(gap - 2, 0, -1):
            if self.have[a] and self.pairs[gap - a] and (two := self.pair(gap - a, (longest, a))):
                return longest, a, *two
        return None


def plan(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns (lengths that share a sequence, how often) that use up all counts."""
    have = np.zeros(capacity + 1, np.int64)
    for n, c in counts.items():
        have[n] += c
    out: list[Pattern] = []
    sums = Sums(have)

    def take(lengths: tuple[int, ...]) -> None:
        times = min(int(have[n]) // k for n, k in Counter(lengths).items())
        for n in lengths:
            have[n] -= times
        out.append((tuple(sorted(lengths, reverse=True)), times))

    for longest in range(capacity, 0, -1):
        while have[longest] and (found := sums.complement(longest)):
            take(found)
    for longest in range(capacity, 0, -1):
        while have[longest]:
            lengths, gap = [longest], capacity - longest
            left = have.copy()
            left[longest] -= 1
            while gap and len(found := np.nonzero(left[1 : gap + 1])[0]):
                best = int(found[-1]) + 1  # the longest that fits leaves the least
                lengths.append(best)
                left[best] -= 1
                gap -= best
            take(tuple(lengths))
    return out


def slots(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]]:
    """For each length, over the patterns that hold it: first rank, first sequence, copies in a sequence, their offsets."""
    found: dict[int, list] = {}
    sequence = 0
    for lengths, times in patterns:
        at: dict[int, list[int]] = {}
        offset = 0
        for n in lengths:
            at.setdefault(n, []).append(offset)
            offset += n
        for n, offsets in at.items():
            found.setdefault(n, []).append((times * len(offsets), sequence, len(offsets), np.array(offsets)))
        sequence += times
    return {n: (np.cumsum([0, *(x[0] for x in xs[:-1])]), np.array([x[1] for x in xs]), np.array([x[2] for x in xs]), [x[3] for x in xs]) for n, xs in found.items()}


def pack(df: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece."""
    cut = stored(pieces(df, tokenizer_path, capacity, end_id, key, text), "pieces")
    by_part = cut.groupBy("part", "length").agg(F.count("*").alias("n"))
    # one row a partition and length: the window holds as many rows of a length as the input has partitions
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    totals = {r["length"]: r["n"] for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    table = slots(plan(totals, capacity))

    def place(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                first, base_sequence, copies, offsets = table[int(n)]
                at = np.nonzero(length == n)[0]
                p = np.searchsorted(first, rank[at], "right") - 1
                within = rank[at] - first[p]
                sequence[at] = base_sequence[p] + within // copies[p]
                offset[at] = [offsets[i][j] for i, j in zip(p, within % copies[p])]
            keep = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(sequence), pa.array(offset)], names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = cut.join(base, ["part", "length"]).select("doc_id", "piece", "start", F.col("length").cast("bigint").alias("length"), "ids_crc32", (F.col("base") + F.col("nth")).alias("rank"))
    return ranked.mapInArrow(place, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint")
