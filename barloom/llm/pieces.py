"""SentencePiece encoding and decoding for merge-type vocabularies.

The encoder keeps an agenda of adjacent symbol pairs ordered by piece score
(ties: the leftmost pair first), merges the best pair, and pushes the pairs that
the merge made. Pieces never hold a word mark after another character, so a
text falls into units at those marks (and at line ends and closing marks that no
piece joins to a letter), and each distinct unit is merged once a worker and then
looked up, as long as it is short and a bound on bytes allows. Every Arrow batch is
also encoded by the sentencepiece library and compared; ``agrees`` holds the
comparison, and where they differ the library's ids count. Models that change
texts before they cut them are refused.

Null text is empty and gives no ids. Rows are kept one for one, repeats
included; other columns of the input are ignored.
"""

from __future__ import annotations

import gc
import hashlib
import heapq
import re
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from barloom.llm.common import keyed_text, slices

MARK = "▁"
SHORT = 40  # longer units are merged from a heap, shorter ones from a list; results are equal
LONGEST = 64  # characters of a unit that is remembered
SAMPLE = "a \uff21 e\u0301 \ufb01  x\t \u00bd"  # what most normalisers would change
ENDERS = ",.;:!?"


class MergeEncoder:
    """Encodes and decodes like the library's merge model with byte fallback and identity normalisation."""

    def __init__(self, model: str, memory: int = 400 << 20) -> None:
        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=model)
        n = lib.get_piece_size()
        names = lib.id_to_piece(list(range(n)))
        plain = [i for i in range(n) if not (lib.is_byte(i) or lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i))]
        if lib.normalize(SAMPLE) != MARK + SAMPLE.replace(" ", MARK):
            raise ValueError("the model changes texts before it cuts them")
        if any(MARK in names[i].lstrip(MARK) for i in plain):
            raise ValueError("a piece holds a word mark inside; units cannot be cut at marks")
        self.ids = {names[i]: i for i in plain}
        scores = {names[i]: lib.get_score(i) for i in plain}
        # dense ranks: a lower rank is a higher score; equal scores share a rank
        order = {s: r for r, s in enumerate(sorted(set(scores.values()), reverse=True))}
        self.rank = {p: order[s] for p, s in scores.items() if len(p) > 1}
        self.bytes = [lib.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # marks of sentence that no piece joins to a letter before, and whether line ends stand alone in all pieces
        self.enders = frozenset(c for c in ENDERS if not any(b == c and a.isalpha() for p in self.rank for a, b in zip(p, p[1:])))
        self.lines = not any("\n" in p for p in self.rank)
        self.units: dict[str, tuple[int, ...]] = {}
        self.inner: dict[str, tuple[int, ...]] = {}
        self.memory, self.held = memory, 0  # bytes of remembered units

    def merge(self, unit: str) -> tuple[int, ...]:
        """Ids of one unit that starts with its word marks."""
        symbols = self._few(unit) if len(unit) <= SHORT else self._many(unit)
        ids, out = self.ids, []
        for s in symbols:
            i = ids.get(s)
            if i is None:
                out.extend(self.bytes[b] for b in s.encode())
            else:
                out.append(i)
        return tuple(out)

    def _few(self, unit: str) -> list[str]:
        # a short agenda: the ranks of all adjacent pairs in a list, of which min() and index() find the leftmost best
        rank, none = self.rank.get, 1 << 30
        s = list(unit)
        agenda = [rank(a + b, none) for a, b in zip(s, s[1:])]
        while agenda:
            best = min(agenda)
            if best == none:
                break
            i = agenda.index(best)
            s[i] += s.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = rank(s[i - 1] + s[i], none)
            if i < len(agenda):
                agenda[i] = rank(s[i] + s[i + 1], none)
        return s

    def _many(self, unit: str) -> list[str]:
        rank = self.rank.get
        s: list[str] = list(unit)
        n = len(s)
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [(r, i, s[i] + s[i + 1]) for i in range(n - 1) if (r := rank(s[i] + s[i + 1])) is not None]
        heapq.heapify(agenda)
        while agenda:
            _, i, merged = heapq.heappop(agenda)
            j = right[i]
            if not s[i] or j < 0 or s[i] + s[j] != merged:  # one of the two has merged since
                continue
            s[i], s[j] = merged, ""
            right[i] = k = right[j]
            if k >= 0:
                left[k] = i
                if (r := rank(merged + s[k])) is not None:
                    heapq.heappush(agenda, (r, i, merged + s[k]))
            if (h := left[i]) >= 0 and (r := rank(s[h] + merged)) is not None:
                heapq.heappush(agenda, (r, h, s[h] + merged))
        return [x for x in s if x]

    def learn(self, word: str) -> tuple[int, ...]:
        """Ids of a word with its mark, made from its parts where no piece crosses between them."""
        if (ids := self.units.get(word)) is None:
            if self.lines and "\n" in word:
                head, *rest = word.split("\n")
                ids = self.learn(head)
                for part in rest:
                    ids += self.merge("\n") + (self.learn_inner(part) if part else ())
            elif word[-1:] in self.enders and word[-2:-1].isalpha():
                ids = self.learn(word[:-1]) + self.learn_inner(word[-1])
            else:
                ids = self.merge(MARK + word)
            self._keep(self.units, word, ids)
        return ids

    def _keep(self, known: dict[str, tuple[int, ...]], part: str, ids: tuple[int, ...]) -> None:
        if len(part) > LONGEST:
            return
        self.held += 200 + len(part) + 8 * len(ids)
        if self.held > self.memory:
            self.units.clear()
            self.inner.clear()
            self.held = 0
        known[part] = ids

    def learn_inner(self, part: str) -> tuple[int, ...]:
        """Ids of a part without a mark before it."""
        if (ids := self.inner.get(part)) is None:
            if len(part) > 1 and part[-1] in self.enders and part[-2].isalpha():
                ids = self.learn_inner(part[:-1]) + self.learn_inner(part[-1])
            else:
                ids = self.merge(part)
            self._keep(self.inner, part, ids)
        return ids

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, without begin and end ids."""
        if not text:
            return []
        get = self.units.get
        if text[0] == " " or "  " in text or MARK in text:
            marked = MARK + text.replace(" ", MARK)
            words = [u[1:] for u in re.findall(f"{MARK}+[^{MARK}]*|[^{MARK}]+", marked)]
        else:
            words = text.split(" ")
        found = list(map(get, words))
        if None in found:
            for k, ids in enumerate(found):
                if ids is None:
                    found[k] = self.learn(words[k])
        return list(chain.from_iterable(found))

    def decode(self, ids: list[int]) -> str:
        return self.library.decode(ids)


ENCODERS: dict[str, MergeEncoder] = {}


def encoder(model: str) -> MergeEncoder:
    """One encoder a worker process and model: what earlier tasks of the process have merged stays known."""
    if model not in ENCODERS:
        ENCODERS[model] = MergeEncoder(model)
    return ENCODERS[model]


def encode_documents(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, ids array<int>, decoded string, agrees boolean (the library gives the same ids)."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for keys, ids, decoded, agrees in _encoded(enc, it):
            yield pa.RecordBatch.from_arrays([keys, pa.array(ids, pa.list_(pa.int32())), pa.array(decoded, pa.string()), pa.array(agrees)], names=["doc_id", "ids", "decoded", "agrees"])

    return keyed_text(df, key, text).mapInArrow(run, "doc_id bigint, ids array<int>, decoded string, agrees boolean")


def encode_digests(df: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, agrees: what ``encode_documents`` gives, digested in the task."""

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        digits = [str(i) for i in range(enc.library.get_piece_size())]
        sha = hashlib.sha256
        for keys, ids, decoded, agrees in _encoded(enc, it):
            yield pa.RecordBatch.from_arrays(
                [
                    keys,
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([sha(",".join(map(digits.__getitem__, x)).encode()).hexdigest() for x in ids]),
                    pa.array([sha(x.encode()).hexdigest() for x in decoded]),
                    pa.array(agrees),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "agrees"],
            )

    return keyed_text(df, key, text).mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, agrees boolean")


def _encoded(enc: MergeEncoder, it: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[list[int]], list[str], list[bool]]]:
    # merged units are hundreds of thousands of tuples without cycles; the collector would walk them again and again
    collecting = gc.isenabled()
    gc.disable()
    try:
        for batch in slices(it):
            texts = batch.column(1).to_pylist()
            ids = [enc.encode(x) for x in texts]
            checked = enc.library.encode(texts, num_threads=1)
            agrees = [a == b for a, b in zip(ids, checked)]
            ids = [a if same else b for a, b, same in zip(ids, checked, agrees)]
            yield batch.column(0), ids, [enc.decode(x) for x in ids], agrees
    finally:
        if collecting:
            gc.enable()
