"""Exact top-k inner products by a dual-tree cover-tree search.

The top of the tree is common to all tasks: every vector belongs to the nearest
of at most ``cells`` centres, a sample by hash of the ids, and a cell has a covering
radius. Queries and candidates are dealt by cell, large cells in blocks of a few
thousand. First each query block is searched in one block of its own cell, which
gives every query a worst k-th score, a floor. Then a query block meets
the blocks of those cells alone whose bound reaches its least floor: for centres
q, p and radii a, b no product exceeds ``q.p + a|p| + b|q| + ab``. In a pair of blocks
both sides are indexed by cover trees, and the search descends pairs of nodes
with the same bound and the floors. Equal bounds are kept, for ties go to smaller ids.
The k best of each block pair are merged by a ranking window, whose input has at
most k rows a query and block.

Vectors that are null, or hold null or non-finite components, take no part;
vectors of another length than a query's are no candidates of it. An empty
vector scores 0. Scores beyond 64 bits count as the end of the bigint range that
they pass, in ranks too. Repeated ids count as rows of their own, but no row of the
query's own id is its candidate. Empty input gives no rows.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.llm.common import slices, stored

LEAF = 48
SHRINK = 0.7
FEW = 16


class CoverTree:
    """Nodes over integer vectors: a centre, a covering radius, and children or a leaf's range of ``order``."""

    def __init__(self, vectors: np.ndarray) -> None:
        self.x = vectors
        self.centre: list[int] = []
        self.radius: list[float] = []
        self.kids: list[list[int]] = []
        self.span: list[tuple[int, int]] = []
        self.order = np.arange(len(vectors))
        if len(vectors):
            self._grow()
        self.centre_x = vectors[self.centre] if self.centre else vectors[:0]
        self.norm = np.sqrt((self.centre_x**2).sum(1))
        self.reach = np.array(self.radius)

    def _node(self, points: np.ndarray, distance: np.ndarray, lo: int) -> int:
        self.centre.append(int(points[0]))
        self.radius.append(float(distance.max()))
        self.kids.append([])
        self.span.append((lo, lo + len(points)))
        return len(self.centre) - 1

    def _grow(self) -> None:
        points = self.order.copy()
        work = [(self._node(points, d := self._away(points), 0), points, d)]
        while work:
            node, points, distance = work.pop()
            lo = self.span[node][0]
            self.order[lo : lo + len(points)] = points
            if len(points) <= LEAF or self.radius[node] == 0:
                continue
            cover = self.radius[node] * SHRINK
            size, few = len(points), []
            while len(points):  # greedy cover: the first point left is a centre, and takes all within the cover radius
                near = distance <= cover
                near[0] = True
                taken, away = points[near], distance[near]
                points = points[~near]
                if len(taken) < FEW:  # scattered points share one leaf, which is covered from its own first point
                    few.append(taken)
                else:
                    lo = self._child(node, taken, away, lo, work)
                if len(points):
                    distance = self._away(points)
            if few:
                scattered = np.concatenate(few)
                if len(scattered) < size:
                    self._child(node, scattered, self._away(scattered), lo, None)

    def _child(self, node: int, points: np.ndarray, distance: np.ndarray, lo: int, work: list | None) -> int:
        kid = self._node(points, distance, lo)
        self.kids[node].append(kid)
        self.order[lo : lo + len(points)] = points
        if work is not None:
            work.append((kid, points, distance))
        return lo + len(points)

    def _away(self, points: np.ndarray) -> np.ndarray:
        return np.sqrt(((self.x[points] - self.x[points[0]]) ** 2).sum(1))


class _Best:
    """The k best (score, smaller id) of each query so far, unordered; ``floor`` is the k-th score."""

    def __init__(self, n: int, k: int, least: np.ndarray) -> None:
        self.k, self.least = k, least  # what a score must reach, known beforehand
        self.score = np.full((n, k), -np.inf)
        self.id = np.full((n, k), np.iinfo(np.int64).max)
        self.floor = least.copy()

    def offer(self, rows: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        live = (scores >= self.floor[rows, None]).any(1)
        if not live.any():
            return
        rows, k = rows[live], self.k
        s = np.concatenate([self.score[rows], scores[live]], 1)
        i = np.concatenate([self.id[rows], np.broadcast_to(ids, (len(rows), len(ids)))], 1)
        floor = np.partition(s, -k, 1)[:, -k]
        keep = s >= floor[:, None]
        tied = keep.sum(1) > k
        if tied.any():  # of the scores at the floor, the smallest ids
            st, it = s[tied], np.where(keep[tied], i[tied], np.iinfo(np.int64).max)
            take = np.lexsort((it, -np.where(keep[tied], st, -np.inf)), axis=1)[:, :k]
            chosen = np.zeros(st.shape, bool)
            np.put_along_axis(chosen, take, True, 1)
            keep[tied] = chosen
        at = np.nonzero(keep)
        self.score[rows] = s[at].reshape(-1, k)
        self.id[rows] = i[at].reshape(-1, k)
        self.floor[rows] = np.maximum(floor, self.least[rows])


def search(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int, floors: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Scores and ids (k columns, -inf where there are fewer) of each query row; scores under a query's floor may be missing."""
    best = _Best(len(queries), k, np.full(len(queries), -np.inf) if floors is None else floors)
    if not len(queries) or not len(ids):
        return best.score, best.id
    qt, rt = CoverTree(queries), CoverTree(vectors)
    width = np.array([b - a for a, b in rt.span])

    def bounds(q: int, rs: np.ndarray) -> np.ndarray:
        dot = rt.centre_x[rs] @ qt.centre_x[q]
        up = dot + qt.reach[q] * rt.norm[rs] + rt.reach[rs] * qt.norm[q] + qt.reach[q] * rt.reach[rs]
        return up + np.abs(up) * 1e-9 + 1e-6

    def leafwise(q: int, rs: np.ndarray) -> None:
        rows = qt.order[slice(*qt.span[q])]
        own, x = query_ids[rows], queries[rows]
        work = [(rs, bounds(q, rs))]
        while work:
            rs, up = work.pop()
            keep = up >= best.floor[rows].min()
            rs, up = rs[keep], up[keep]
            if not len(rs):
                continue
            parents = [r for r in rs if rt.kids[r]]
            leaves = [r for r in rs if not rt.kids[r]]
            if parents:  # best bounds last, so that they are handled first
                fresh = np.array([c for r in parents for c in rt.kids[r]] + leaves)
                up = bounds(q, fresh)
                by = np.argsort(up)
                half = len(by) - max(1, len(by) // 4)
                if half:
                    work.append((fresh[by[:half]], up[by[:half]]))
                work.append((fresh[by[half:]], up[by[half:]]))
                continue
            by = np.argsort(-up)
            cut = 1
            while cut < len(by) and width[rs[by[:cut]]].sum() < 2048:
                cut += 1
            if cut < len(by):
                work.append((rs[by[cut:]], up[by[cut:]]))
            take = np.concatenate([rt.order[slice(*rt.span[r])] for r in rs[by[:cut]]])
            scores = x @ vectors[take].T
            scores = np.where(own[:, None] == ids[take][None, :], -np.inf, scores)
            best.offer(rows, scores, ids[take])

    def descend(q: int, rs: np.ndarray) -> None:
        if not qt.kids[q]:
            leafwise(q, rs)
            return
        floor = best.floor[qt.order[slice(*qt.span[q])]].min()
        rs = rs[bounds(q, rs) >= floor]
        split = [c for r in rs for c in (rt.kids[r] or [r])]
        for c in qt.kids[q]:
            descend(c, np.array(split))

    descend(0, np.array([0]))
    return best.score, best.id


def _integer(x: float) -> int:
    """A whole double as an integer; what scaling has made infinite counts as the largest double."""
    return int(x) if math.isfinite(x) else int(math.copysign(1.7976931348623157e308, x))


def _bounded(score: int) -> int:
    return max(-(2**63), min(2**63 - 1, score))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), dim)


TAME = 2.0**22  # larger components take no part in cells: their products are not exact in doubles


@dataclass(frozen=True)
class _Cells:
    """Centres by vector length; a cell's number is its centre's place in all of them, -1 is the cell of all other vectors."""

    centres: dict[int, np.ndarray]
    first: dict[int, int]

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells of vectors of one length, and how far each is from its centre."""
        cell, far = np.full(len(x), -1, np.int32), np.full(len(x), np.inf)
        c = self.centres.get(x.shape[1])
        tame = np.nonzero((np.abs(x) < TAME).all(1))[0]
        if c is not None and len(tame):
            y = x[tame]
            near = np.argmin((c**2).sum(1)[None, :] - 2 * (y @ c.T), 1)
            cell[tame] = near + self.first[x.shape[1]]
            far[tame] = np.sqrt(((y - c[near]) ** 2).sum(1))
        return cell, far

    def reaching(self, dim: int, cell: int, radius: float, floor: float, others: dict[int, float]) -> list[int]:
        """Those of the other cells, with their radii, whose bound with this cell reaches the floor."""
        if cell < 0:
            return list(others)
        c, first = self.centres[dim], self.first[dim]
        known = np.array([o for o in others if o >= 0], np.int64)
        p, b = c[known - first], np.array([others[o] for o in known.tolist()])
        up = p @ c[cell - first] + radius * np.sqrt((p**2).sum(1)) + b * np.sqrt((c[cell - first] ** 2).sum()) + radius * b
        return known[up + np.abs(up) * 1e-9 + 1e-6 >= floor].tolist() + [o for o in others if o < 0]


def top_k(df: DataFrame, k: int = 20, scale: float = 64.0, every: int = 20, key: str = "vec_id", vector: str = "embedding", block: int = 4096, cells: int = 512) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k highest integer products. Queries are ids divisible by ``every``.

    The driver gets at most ``cells`` vectors, and one row a cell and vector length.
    """
    spark = df.sparkSession
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull()).where(~bad)
    # beyond 2**53 a double is whole already, and a bigint would not hold all of them
    whole = F.transform("v", lambda x: F.when(F.abs(x * F.lit(float(scale))) < 2.0**53, F.floor(x * F.lit(float(scale))).cast("double")).otherwise(x * F.lit(float(scale))))
    rows = rows.select("vec_id", F.size("v").alias("dim"), whole.alias("v"))
    n_queries = rows.where(F.col("vec_id") % every == 0).count()
    wanted = max(1, min(cells, math.ceil(n_queries / block)))  # no more cells than blocks of queries: each is met by every candidate that it can reach
    picked = rows.where(F.forall("v", lambda x: F.abs(x) < TAME) & (F.col("dim") > 0)).orderBy(F.xxhash64("vec_id"), "vec_id").limit(wanted).select("v").collect()
    by_dim: dict[int, list] = {}
    for r in picked:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    sizes = {d: len(c) for d, c in sorted(by_dim.items())}
    top = _Cells({d: np.unique(np.array(by_dim[d]), axis=0) for d in sizes}, dict(zip(sizes, [0, *np.cumsum(list(sizes.values()))[:-1].tolist()])))

    def deal(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = 977 * TaskContext.get().partitionId()
        for batch in slices(it, 2000):
            dims, lists = batch.column(1).to_numpy(), batch.column(2)
            cell, far = np.full(len(dims), -1, np.int32), np.full(len(dims), np.inf)
            for d in np.unique(dims):
                at = np.nonzero(dims == d)[0]
                cell[at], far[at] = top.place(_matrix(lists.take(pa.array(at)), int(d)))
            # rows are dealt in turns: rows of one id, however many, fill several blocks
            turn = np.arange(seen, seen + len(dims))
            seen += len(dims)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far), pa.array(turn)], names=["vec_id", "dim", "v", "cell", "far", "turn"])

    placed = stored(rows.mapInArrow(deal, "vec_id bigint, dim int, v array<double>, cell int, far double, turn bigint"), "vectors")
    is_query = F.col("vec_id") % every == 0
    tally = placed.groupBy("dim", "cell").agg(F.count("*").alias("n"), F.count_if(is_query).alias("n_queries"), F.max("far").alias("far"), F.max(F.when(is_query, F.col("far"))).alias("query_far")).collect()
    others: dict[int, dict[int, float]] = {}
    for r in tally:
        others.setdefault(r["dim"], {})[r["cell"]] = r["far"]
    radius = {(r["dim"], r["cell"]): r["query_far"] for r in tally}
    blocks = {(r["dim"], r["cell"]): math.ceil(r["n"] / block) for r in tally}
    counted = spark.createDataFrame([(r["dim"], r["cell"], blocks[r["dim"], r["cell"]], max(1, math.ceil(r["n_queries"] / block))) for r in tally], "dim int, cell int, blocks int, query_blocks int")

    def dealt_by(into: str) -> DataFrame:
        return placed.join(F.broadcast(counted), ["dim", "cell"]).select(*(F.col(c).alias(c) for c in ("vec_id", "dim", "cell", "v")), F.pmod("turn", F.col(into)).cast("int").alias("part"))

    dealt = dealt_by("blocks")
    queries = dealt_by("query_blocks").where(is_query).withColumn("floor", F.lit(float("-inf")))

    def pair(a: pa.Table, b: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not a.num_rows or not b.num_rows:
            return pa.table([pa.array([], pa.int64())] * 3, names=names)
        dim = a["dim"][0].as_py()
        qid, rid = a["vec_id"].to_numpy(), b["vec_id"].to_numpy()
        q, r = (_matrix(t["v"].combine_chunks(), dim) for t in (a, b))
        most = float(np.abs(q).max(initial=0)) * float(np.abs(r).max(initial=0)) * max(1, dim)
        if most < 2.0**52:
            s, i = search(qid, q, rid, r, k, a["floor"].to_numpy())
            at = np.nonzero(~np.isneginf(s))
            return pa.table([pa.array(qid[at[0]]), pa.array(i[at]), pa.array(s[at].astype(np.int64))], names=names)
        out: list[tuple[int, int, int]] = []  # beyond exact doubles: Python's integers
        exact = [[_integer(c) for c in y] for y in r]
        for x, own in zip(q, qid):
            ints = [_integer(c) for c in x]
            best = heapq.nsmallest(k, ((-_bounded(sum(a * b for a, b in zip(ints, y))), int(j)) for y, j in zip(exact, rid) if j != own))
            out += [(int(own), j, -s) for s, j in best]
        return pa.table([pa.array(c, pa.int64()) for c in (zip(*out) if out else ([], [], []))], names=names)

    found = "query_id bigint, vec_id bigint, score bigint"
    home = ["dim", "cell", "part"]
    tame = F.col("cell") >= 0
    first = queries.where(tame).groupBy(*home).cogroup(dealt.where(tame).groupBy(*home)).applyInArrow(pair, found)
    # a query's worst score of k in its own block; repeated ids count once, with the least
    floors = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").cast("double").alias("floor")).where(F.col("n") == k)
    floors = stored(floors.select(F.col("query_id").alias("vec_id"), "floor"), "floors")
    queries = queries.drop("floor").join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    groups = queries.groupBy(*home).agg(F.min("floor").alias("floor"))

    def meet(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            out: list[tuple[int, int, int, int, int]] = []
            for dim, cell, part, floor in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                for other in top.reaching(dim, cell, radius[dim, cell], floor, others[dim]):
                    out += [(dim, cell, part, other, n) for n in range(blocks[dim, other])]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int32()) for c in (zip(*out) if out else [[]] * 5)], names=["dim", "cell", "part", "other", "piece"])

    met = stored(groups.mapInArrow(meet, "dim int, cell int, part int, other int, piece int"), "met")
    keys = ["dim", "cell", "part", "other", "piece"]
    left = queries.join(met, home)
    right = dealt.select("vec_id", "dim", "v", F.col("cell").alias("other"), F.col("part").alias("piece")).join(met, ["dim", "other", "piece"])
    every_pair = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(pair, found)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return every_pair.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def brute_force(ids: Iterator[int], vectors: list, k: int, scale: float = 64.0, every: int = 20) -> list[tuple[int, int, int, int]]:
    """The same rows by comparing all; for tests."""
    good = [(i, [math.floor(scale * x) if math.isfinite(scale * x) else _integer(scale * x) for x in v]) for i, v in zip(ids, vectors) if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for qi, q in good:
        if qi % every == 0:
            scored = sorted((-_bounded(sum(a * b for a, b in zip(q, v))), i) for i, v in good if i != qi and len(v) == len(q))[:k]
            out += [(qi, rank + 1, i, -s) for rank, (s, i) in enumerate(scored)]
    return out
