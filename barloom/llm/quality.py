"""Quality by a byte-level convolutional network in numpy.

Learned filters of four bytes run over overlapping chunks that cover the whole
text as UTF-8; each filter's rectified response is max-pooled in a chunk, the
chunks' pooled vectors are averaged, the share of a text's only chunk that is
empty and the fourth power of that share join them (a short text has fewer
places for a maximum), and a logistic unit makes one probability.
A filter is a table of weights by place and byte, so scoring looks up two tables
of byte pairs. Fitting is by Adam, with gradients through the pooled maxima.

The fit uses all chunks of at most ``per_class`` labelled documents of each
label; it never uses held-out rows. Texts
under four bytes, null and empty included, are padded with zero bytes. Rows are
kept one for one; repeated texts score equally.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barloom.llm.common import batches, keyed_text, returned, slices
from barloom.llm.samples import HELD_OUT, labelled

WIDTH, CHUNK, STRIDE = 4, 512, 384
PASS = 0.7


def chunk_starts(n: int) -> range:
    """Starts of the overlapping chunks over n bytes; the last one ends at or after the end."""
    return range(0, max(1, n - (CHUNK - STRIDE)), STRIDE)


@dataclass(frozen=True)
class ByteNet:
    filters: np.ndarray  # WIDTH x 256 x filters
    bias: np.ndarray
    out: np.ndarray
    offset: float

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        f = self.filters
        first = (f[0][:, None, :] + f[1][None, :, :]).reshape(65536, -1) + self.bias
        last = (f[2][:, None, :] + f[3][None, :, :]).reshape(65536, -1)
        return np.ascontiguousarray(first, np.float32), np.ascontiguousarray(last, np.float32)


def pooled(raw: bytes, tables: tuple[np.ndarray, np.ndarray], step: int = 64) -> np.ndarray:
    """Mean over chunks of the max-pooled filter responses of one text."""
    b = np.frombuffer(raw if len(raw) >= WIDTH else raw + b"\x00" * (WIDTH - len(raw)), np.uint8)
    total, chunks, n = np.zeros(tables[0].shape[1]), 0, len(b)
    spare = 0.0
    block = STRIDE * step
    for at in range(0, max(1, n - (CHUNK - STRIDE)), block):  # long texts in blocks of whole strides
        part = b[at : at + block + CHUNK - STRIDE].astype(np.uint16)
        pair = part[:-1] << 8 | part[1:]
        h = tables[0].take(pair[:-2], 0)
        h += tables[1].take(pair[2:], 0)
        starts = np.arange(0, max(1, len(part) - (CHUNK - STRIDE)), STRIDE)
        ends = np.minimum(starts + CHUNK - WIDTH + 1, len(h))
        # chunks overlap, so reduceat runs over start, end pairs and every other result counts
        edges = np.stack([starts, np.minimum(ends, len(h) - 1)], 1).reshape(-1)
        top = np.maximum.reduceat(h, edges, 0)[::2]
        top[-1] = h[starts[-1] :].max(0)
        total += np.maximum(top, 0).sum(0)
        chunks += len(starts)
        if n <= CHUNK:
            spare = 1 - n / CHUNK
    return np.concatenate([total / chunks, _spare(spare)])


def _spare(x: float | np.ndarray) -> np.ndarray:
    """The empty share of a text's only chunk and its fourth power; 0 for longer texts."""
    return np.stack([np.asarray(x), np.asarray(x) ** 4], -1)


def scorer(net: ByteNet) -> Callable[[str], float]:
    tables = net.tables()

    def score(text: str) -> float:
        z = float(pooled(text.encode("utf-8", "surrogatepass"), tables) @ net.out + net.offset)
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))

    return score


def fit(texts: list[bytes], labels: list[int], filters: int = 8, epochs: int = 14, seed: int = 7) -> ByteNet:
    """From whole texts as bytes. Without rows of both labels every text scores the share of label 1 (0.5 without rows)."""
    rng = np.random.default_rng(seed)
    order = sorted(range(len(texts)), key=lambda i: (texts[i], labels[i]))
    y = np.array([labels[i] for i in order], float)
    t = rng.normal(0, 0.15, (WIDTH, 256, filters))
    if not len(y) or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return ByteNet(t, np.zeros(filters), np.zeros(filters + 2), float(np.log(share / (1 - share))))
    # all texts end to end, zero bytes after each, so that a chunk is a place and a size
    lengths = np.array([max(WIDTH, len(texts[i])) for i in order])
    at = np.concatenate([[0], np.cumsum(lengths + CHUNK)])
    body = np.zeros(at[-1], np.uint8)
    for i, a in zip(order, at, strict=False):
        body[a : a + len(texts[i])] = np.frombuffer(texts[i], np.uint8)
    starts = [chunk_starts(n) for n in lengths]
    counts = np.array([len(s) for s in starts])
    first = np.concatenate([[0], np.cumsum(counts)[:-1]])
    chunk_at = np.concatenate([a + np.array(s) for a, s in zip(at, starts, strict=False)])
    size = np.concatenate([np.minimum(CHUNK, n - np.array(s)) for n, s in zip(lengths, starts, strict=True)])
    spare = _spare(np.where(counts == 1, 1 - np.minimum(lengths, CHUNK) / CHUNK, 0.0))
    params = [t, np.zeros(filters), np.append(rng.normal(0, 0.5, filters), [0.0, 0.0]), np.zeros(1)]
    m, v, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    place = np.arange(CHUNK - WIDTH + 1)

    def peaks(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each chunk's greatest responses and the body's places of them, a few hundred chunks at a time."""
        top, where = np.empty((len(rows), filters)), np.empty((len(rows), filters), np.int64)
        tables = [params[0][j].astype(np.float32) for j in range(WIDTH)]
        for k in range(0, len(rows), 256):
            some = rows[k : k + 256]
            x = body[chunk_at[some][:, None] + np.arange(CHUNK)[None, :]]
            h = tables[0].take(x[:, : len(place)], 0)
            for j in range(1, WIDTH):
                h += tables[j].take(x[:, j : j + len(place)], 0)
            short = np.nonzero(size[some] < CHUNK)[0]
            h[short] = np.where((place[None, :] <= (size[some[short]] - WIDTH)[:, None])[:, :, None], h[short], np.float32(-1e9))
            best = h.argmax(1)
            top[k : k + 256] = np.take_along_axis(h, best[:, None, :], 1)[:, 0, :] + params[1]
            where[k : k + 256] = chunk_at[some][:, None] + best
        return top, where

    for epoch in range(epochs):
        rate = 0.03 * (1 - epoch / epochs) + 0.002
        for batch in np.array_split(rng.permutation(len(y)), max(1, len(y) // 64)):
            rows = np.concatenate([np.arange(first[i], first[i] + counts[i]) for i in batch])
            doc = np.repeat(np.arange(len(batch)), counts[batch])
            peak, where = peaks(rows)
            live = np.maximum(peak, 0)
            d = np.stack([np.bincount(doc, live[:, f], minlength=len(batch)) for f in range(filters)], 1) / counts[batch][:, None]
            d = np.concatenate([d, spare[batch]], 1)
            p = 1 / (1 + np.exp(-np.clip(d @ params[2] + params[3], -40, 40)))
            dz = (p - y[batch]) / len(batch)
            dpeak = (dz / counts[batch])[doc][:, None] * params[2][None, :filters] * (peak > 0)
            g0 = np.zeros_like(params[0])
            for j in range(WIDTH):
                np.add.at(g0[j], (body[where + j], np.arange(filters)[None, :]), dpeak)
            grads = [g0 + 1e-5 * params[0], dpeak.sum(0), d.T @ dz + 1e-4 * params[2], np.array([dz.sum()])]
            step += 1
            for q, (pm, g) in enumerate(zip(params, grads, strict=True)):
                m[q] = 0.9 * m[q] + 0.1 * g
                v[q] = 0.99 * v[q] + 0.01 * g * g
                pm -= rate * (m[q] / (1 - 0.9**step)) / (np.sqrt(v[q] / (1 - 0.99**step)) + 1e-8)
    return ByteNet(params[0], params[1], params[2], float(params[3][0]))


def train(docs: DataFrame, labels: DataFrame, per_class: int = 3000) -> ByteNet:
    """Fits on the driver from the whole texts of at most ``per_class`` documents of each label."""
    sample = labelled(docs, labels, "quality", per_class).select("text", "y")
    rows = [(r["text"].encode("utf-8", "surrogatepass"), r["y"]) for r in sample.toLocalIterator()]
    net = fit([t for t, _ in rows], [y for _, y in rows])
    rows.clear()
    returned()
    return net


def score(df: DataFrame, net: ByteNet, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.7)."""
    def make() -> Callable[[list, list], list]:
        one = scorer(net)

        def run(keys: list, texts: list) -> list:
            s = [round(one(t), 9) for t in texts]
            held = [None if k is None else zlib.crc32(str(k).encode()) % 4 == HELD_OUT for k in keys]
            return [keys, held, s, [int(x >= PASS) for x in s]]

        return run

    fields = [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32())]

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(make(), fields)(it)

    return keyed_text(df, key, text).mapInArrow(task, "doc_id bigint, held_out boolean, score double, predicted int")


def keep_good(df: DataFrame, net: ByteNet, text: str = "text") -> DataFrame:
    """The rows of ``df``, all its columns, whose text scores at least 0.7."""
    names = df.columns

    def task(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one, at = scorer(net), names.index(text)
        for batch in slices(it):
            yield batch.filter(pa.array([one(t or "") >= PASS for t in batch.column(at).to_pylist()], pa.bool_()))

    return df.mapInArrow(task, df.schema)
