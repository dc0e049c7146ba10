"""Media columns: baseline JPEG coding, decoding and DC-only luminance thumbnails.

``decode_jpeg`` parses the markers of a baseline JPEG, Huffman-decodes its scan
and reconstructs the thumbnail of the luminance DC terms, one sample a block.
``encode_gray`` writes samples as a grey baseline image in which every 8 x 8
block is flat, so that a block's DC term is one 8-bit sample and survives
exactly. Its Huffman tables give the difference category s a code of 9 - s bits;
with the s magnitude bits each block takes 10 bits, and a decoder that sees such
tables reads all blocks at once in numpy. Other tables are decoded by symbol.

Null text is empty; any text, short or long, is padded with zero bytes to a
positive multiple of 64. A payload beyond one image's height goes on in further
images of the same stream. The feature has every image's size and the
average hash of its thumbnail, and their number. Rows are kept one for one; other
columns are ignored.

``decode_jpeg`` reads files of other makers too: AC terms are passed over, restart
intervals start anew, of several components the first is the thumbnail. Media
that are null, cut short or no baseline JPEG raise ``ValueError`` there, and have
null digests and the feature ``unreadable`` in ``media_features``.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from barloom.llm.common import batches, keyed_text

UNIT = 64
ROWS = 65_535 // 8


def _table(kind: int, lengths: dict[int, int]) -> bytes:
    """A DHT body from symbol lengths; canonical codes in order of length."""
    counts = [sum(1 for v in lengths.values() if v == n) for n in range(1, 17)]
    symbols = sorted(lengths, key=lambda s: (lengths[s], s))
    return bytes([kind, *counts, *symbols])


DC_LENGTHS = {s: 9 - s for s in range(9)}
SEGMENT = lambda marker, body: bytes([0xFF, marker]) + (len(body) + 2).to_bytes(2, "big") + body


def _codes(lengths: list[tuple[int, int]]) -> dict[int, tuple[int, int]]:
    """symbol -> (code, length) for canonical codes over (length, symbol) in table order."""
    out, code, last = {}, 0, 0
    for n, s in lengths:
        code <<= n - last
        out[s] = (code, n)
        code, last = code + 1, n
    return out


def _words() -> np.ndarray:
    """The 10 bits of each DC difference from -255 to 255: code, magnitude and the end-of-block bit 0."""
    codes = _codes(sorted((n, s) for s, n in DC_LENGTHS.items()))
    out = np.zeros(511, np.uint64)
    for d in range(-255, 256):
        s = abs(d).bit_length()
        code, _ = codes[s]
        out[d + 255] = ((code << s) | ((d if d > 0 else d + (1 << s) - 1) if s else 0)) << 1
    return out


WORDS = _words()
HEAD = b"\xff\xd8" + SEGMENT(0xE0, b"JFIF\x00\x01\x01\x00\x00\x01\x00\x01\x00\x00") + SEGMENT(0xDB, bytes([0]) + bytes([8] * 64))
TABLES = SEGMENT(0xC4, _table(0x00, DC_LENGTHS)) + SEGMENT(0xC4, _table(0x10, {0: 1})) + SEGMENT(0xDA, bytes([1, 1, 0x00, 0, 63, 0]))


def encode_gray(samples: np.ndarray) -> bytes:
    """A grey baseline JPEG of 8 x 8 flat blocks, a block for each sample; samples: rows x columns, uint8, with 4 | size."""
    height, width = samples.shape
    level = samples.reshape(-1).astype(np.int16) - 128
    step = np.diff(level, prepend=np.int16(0))
    w = WORDS[step + 255].reshape(-1, 4)
    joined = (w[:, 0] << np.uint64(30)) | (w[:, 1] << np.uint64(20)) | (w[:, 2] << np.uint64(10)) | w[:, 3]
    scan = joined.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 3:].tobytes().replace(b"\xff", b"\xff\x00")
    frame = SEGMENT(0xC0, bytes([8]) + (8 * height).to_bytes(2, "big") + (8 * width).to_bytes(2, "big") + bytes([1, 1, 0x11, 0]))
    return HEAD + frame + TABLES + scan + b"\xff\xd9"


class Huffman:
    """A decoding table: for each 16-bit window the symbol and the length of its code."""

    def __init__(self, counts: bytes, symbols: bytes) -> None:
        self.pairs = []
        at = 0
        for n, c in enumerate(counts, 1):
            self.pairs += [(n, s) for s in symbols[at : at + c]]
            at += c
        self.symbol, self.length = bytearray(1 << 16), bytearray(1 << 16)
        for s, (code, n) in _codes(self.pairs).items():
            lo, size = code << (16 - n), 1 << (16 - n)
            self.symbol[lo : lo + size] = bytes([s]) * size
            self.length[lo : lo + size] = bytes([n]) * size


HUFFMAN: dict[bytes, tuple[int, Huffman]] = {}  # tables by their segment's bytes; files mostly share them


def _same_stride(dc: Huffman, ac: Huffman) -> int:
    """Bits of every block if all DC symbols take equally many and each block ends at once, else 0."""
    strides = {n + s for n, s in dc.pairs}
    return strides.pop() + ac.pairs[0][0] if len(strides) == 1 and len(ac.pairs) == 1 and ac.pairs[0][1] == 0 else 0


LOOKUP: dict[tuple, np.ndarray] = {}


def _differences(dc: Huffman, stride: int) -> np.ndarray:
    """The DC difference for each window of ``stride`` bits."""
    if (found := LOOKUP.get(key := (tuple(dc.pairs), stride))) is None:
        windows = np.arange(1 << stride, dtype=np.int64)
        at16 = windows << (16 - stride)
        s = np.frombuffer(bytes(dc.symbol), np.uint8)[at16].astype(np.int64)
        n = np.frombuffer(bytes(dc.length), np.uint8)[at16].astype(np.int64)
        v = (windows >> np.maximum(stride - n - s, 0)) & ((1 << s) - 1)
        found = LOOKUP[key] = np.where(s == 0, 0, np.where(v < (1 << np.maximum(s - 1, 0)), v - (1 << s) + 1, v))
    return found


def decode_jpeg(data: bytes, at: int = 0) -> tuple[int, int, np.ndarray, int]:
    """(width, height, thumbnail of luminance DC samples, offset after the image) of a baseline JPEG."""
    try:
        return _decode(data, at)
    except (IndexError, KeyError) as e:
        raise ValueError(f"broken image: {e}") from e


def _decode(data: bytes, at: int) -> tuple[int, int, np.ndarray, int]:
    if data[at : at + 2] != b"\xff\xd8":
        raise ValueError("no JPEG start marker")
    at += 2
    quant, huff, frame, restart = {}, {}, None, 0
    while True:
        if data[at] != 0xFF:
            raise ValueError("marker expected")
        marker = data[at + 1]
        if marker == 0xFF:
            at += 1
            continue
        size = int.from_bytes(data[at + 2 : at + 4], "big")
        if size < 2 or at + 2 + size > len(data):
            raise ValueError("segment cut short")
        body = data[at + 4 : at + 2 + size]
        at += 2 + size
        if marker == 0xDB:
            while body:
                wide = body[0] >> 4
                quant[body[0] & 15] = int.from_bytes(body[1 : 2 + wide], "big")
                body = body[1 + 64 * (1 + wide) :]
        elif marker == 0xC4:
            if body in HUFFMAN and body[1:17]:
                kind, h = HUFFMAN[body]
                huff[kind] = h
                continue
            rest = body
            while rest:
                n = sum(rest[1:17])
                huff[rest[0]] = Huffman(rest[1:17], rest[17 : 17 + n])
                if len(rest) == len(body) == 17 + n and len(HUFFMAN) < 64:
                    HUFFMAN[body] = rest[0], huff[rest[0]]
                rest = rest[17 + n :]
        elif marker == 0xC0:
            frame = body
        elif 0xC1 <= marker <= 0xCF:
            raise ValueError("not a baseline image")
        elif marker == 0xDD:
            restart = int.from_bytes(body[:2], "big")
        elif marker == 0xDA:
            break
    if frame is None or frame[0] != 8:
        raise ValueError("no 8-bit frame")
    height, width = int.from_bytes(frame[1:3], "big"), int.from_bytes(frame[3:5], "big")
    parts = [(frame[6 + 3 * i], frame[7 + 3 * i] >> 4, frame[7 + 3 * i] & 15, frame[8 + 3 * i]) for i in range(frame[5])]
    use = {body[1 + 2 * i]: body[2 + 2 * i] for i in range(body[0])}
    if set(use) != {p[0] for p in parts}:
        raise ValueError("components in separate scans")
    end = at
    while True:
        end = data.find(b"\xff", end)
        if end < 0:
            raise ValueError("scan without end")
        if data[end + 1] == 0 or 0xD0 <= data[end + 1] <= 0xD7:
            end += 2
            continue
        break
    scan = data[at:end]
    after = end + 2 if data[end + 1] == 0xD9 else end
    first = parts[0]
    dc, ac = huff[use[first[0]] >> 4], huff[0x10 | (use[first[0]] & 15)]
    q = quant[first[3]]
    if len(parts) == 1:
        rows, cols = -(-height // 8), -(-width // 8)
        stride = 0 if restart else _same_stride(dc, ac)
        if stride and stride <= 16:
            terms = np.cumsum(_uniform(scan.replace(b"\xff\x00", b"\xff"), rows * cols, dc, stride))
        else:
            terms = np.array(_by_symbol(scan, [(0, dc, ac)], rows * cols, restart)[0])
        grid = terms.reshape(rows, cols)
    else:
        h, v = max(p[1] for p in parts), max(p[2] for p in parts)
        mcus = -(-width // (8 * h)) * -(-height // (8 * v))
        plan = [(i, huff[use[p[0]] >> 4], huff[0x10 | (use[p[0]] & 15)]) for i, p in enumerate(parts) for _ in range(p[1] * p[2])]
        terms = np.array(_by_symbol(scan, plan, mcus, restart)[0])
        across = -(-width // (8 * h))
        grid = terms.reshape(-1, across, first[2], first[1]).transpose(0, 2, 1, 3).reshape(-1, across * first[1])
        grid = grid[: -(-(-(-height * first[2] // v)) // 8), : -(-(-(-width * first[1] // h)) // 8)]
    thumb = np.clip((grid * q + 4) // 8 + 128, 0, 255).astype(np.uint8)
    return width, height, thumb, after


def _uniform(scan: bytes, blocks: int, dc: Huffman, stride: int) -> np.ndarray:
    diff = _differences(dc, stride)
    if stride == 10 and blocks % 4 == 0:
        if len(scan) != blocks // 4 * 5:
            raise ValueError("scan of another length")
        b = np.frombuffer(scan, np.uint8).reshape(-1, 5).astype(np.uint16)
        w = np.empty((len(b), 4), np.uint16)
        w[:, 0] = b[:, 0] << 2 | b[:, 1] >> 6
        w[:, 1] = (b[:, 1] & 63) << 4 | b[:, 2] >> 4
        w[:, 2] = (b[:, 2] & 15) << 6 | b[:, 3] >> 2
        w[:, 3] = (b[:, 3] & 3) << 8 | b[:, 4]
        return diff[w.reshape(-1)]
    bits = np.unpackbits(np.frombuffer(scan, np.uint8))[: blocks * stride].reshape(blocks, stride)
    return diff[bits @ (1 << np.arange(stride - 1, -1, -1))]


def _by_symbol(scan: bytes, plan: list[tuple[int, Huffman, Huffman]], mcus: int, restart: int) -> dict[int, list[int]]:
    """DC terms by component; AC symbols are decoded and passed over."""
    out: dict[int, list[int]] = {}
    pieces, at = [], 0
    if restart:
        k = 0
        while (k := scan.find(b"\xff", k)) >= 0:
            if 0xD0 <= scan[k + 1] <= 0xD7:
                pieces.append(scan[at:k])
                at = k + 2
            k += 2
    pieces.append(scan[at:])
    done = 0
    for piece in pieces:
        piece = piece.replace(b"\xff\x00", b"\xff") + b"\xff" * 8
        hold, held, at, last = 0, 0, 0, {}
        end = len(piece)
        for _ in range(min(restart or mcus, mcus - done)):
            if at - held // 8 > end:
                raise ValueError("scan cut short")
            for i, dc, ac in plan:
                k = 0
                while k < 64:
                    while held < 32:
                        hold, held, at = (hold << 8 | (piece[at] if at < len(piece) else 255)) & 0xFFFFFFFFFFFF, held + 8, at + 1
                    t = ac if k else dc
                    peek = hold >> (held - 16) & 0xFFFF
                    s, n = t.symbol[peek], t.length[peek]
                    if not n:
                        raise ValueError("bad Huffman code")
                    held -= n
                    bits = s & 15
                    if k == 0:
                        held -= bits
                        v = hold >> held & (1 << bits) - 1
                        last[i] = last.get(i, 0) + (v if not bits or v >> (bits - 1) else v - (1 << bits) + 1)
                        out.setdefault(i, []).append(last[i])
                        k = 1
                    elif s == 0:
                        break
                    else:
                        held -= bits
                        k += (s >> 4) + 1
            done += 1
    if done < mcus:
        raise ValueError("scan cut short")
    return out


def pack(payload: bytes) -> bytes:
    """The stored form: one image, or several for a payload beyond an image's height."""
    samples = np.frombuffer(payload, np.uint8).reshape(-1, UNIT)
    return b"".join(encode_gray(samples[a : a + ROWS]) for a in range(0, len(samples), ROWS))


def average_hash(thumb: np.ndarray) -> str:
    """An 8 x 8 average hash of a thumbnail."""
    rows = np.linspace(0, len(thumb), 9).astype(int)[:-1]
    sums = np.add.reduceat(np.add.reduceat(thumb.astype(np.int64), np.minimum(rows, len(thumb) - 1), 0), np.arange(0, UNIT, 8), 1)
    share = np.maximum(np.diff(np.append(rows, len(thumb))), 1)[:, None] * (UNIT // 8)
    cells = sums * 1000 // share
    return np.packbits(cells >= int(cells.mean())).tobytes().hex()


def unpack(media: bytes) -> tuple[bytes, str]:
    """Payload and feature: width x height of every image, count of images, and average hashes of all their thumbnails."""
    at, sizes, thumbs = 0, [], []
    while at < len(media):
        width, height, thumb, at = decode_jpeg(media, at)
        sizes.append(f"{width}x{height}")
        thumbs.append(thumb)
    payload = b"".join(t.tobytes() for t in thumbs)
    return payload, f"{'+'.join(sizes)}:{len(thumbs)}:{'+'.join(map(average_hash, thumbs))}"


def media_column(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: the stored JPEG stream of every text."""

    def run(keys: list, texts: list) -> list:
        raw = [x.encode() for x in texts]
        return [keys, [len(x) for x in raw], [pack(padded(x)) for x in raw]]

    fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("media", pa.binary())]
    return keyed_text(df, key, text).mapInArrow(batches(run, fields), "doc_id bigint, n_bytes bigint, media binary")


def padded(raw: bytes) -> bytes:
    return raw + b"\x00" * (max(UNIT, -(-len(raw) // UNIT) * UNIT) - len(raw))


def _features(keys: list, n_bytes: list, media: list) -> list:
    out: list[list] = [keys, n_bytes, [], [], [], [], [], []]
    for m in media:
        try:
            payload, feature = unpack(m or b"")
            if not m:
                raise ValueError("no image")
            values = (len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-UNIT:]), len(m), hashlib.sha256(m).hexdigest(), feature)
        except ValueError:
            values = (None, None, None, None if m is None else len(m), None if m is None else hashlib.sha256(m).hexdigest(), "unreadable")
        for column, value in zip(out[2:], values, strict=True):
            column.append(value)
    return out


FIELDS = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha256", pa.string()), ("tail_crc32", pa.int64()), ("media_bytes", pa.int64()), ("media_sha256", pa.string()), ("feature", pa.string())]
SCHEMA = "doc_id bigint, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"


def media_features(df: DataFrame) -> DataFrame:
    """Digests and features read back from a media column (doc_id, n_bytes, media)."""
    return df.select("doc_id", "n_bytes", "media").mapInArrow(batches(_features, FIELDS), SCHEMA)


def store_and_read(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``media_features`` of ``media_column`` in one pass: few stored forms are held at once."""

    def run(keys: list, texts: list) -> list:
        raw = [x.encode() for x in texts]
        return _features(keys, [len(x) for x in raw], [pack(padded(x)) for x in raw])

    return keyed_text(df, key, text).mapInArrow(batches(run, FIELDS), SCHEMA)
