"""Piece encoding: unigram Viterbi over a double-array trie (op 5).

The pieces come from a sentencepiece model file.  Its scores are merge ranks,
so a piece's log score is that of a Zipf law over its rank.  Text is prefixed
with one space, spaces are the white-space marker; a character no piece covers
is written as byte pieces.  The best path never crosses into a run of spaces
from the left (no piece has the marker behind another character), so distinct
space-led chunks are encoded once per batch, all of them at once in numpy.
"""

from __future__ import annotations

import functools
import math
import re
import struct
import zlib
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, small_batches

MARK = "▁"
#: How far an uncovered character's score lies below the least piece score.
UNKNOWN_PENALTY = 10.0
#: Texts of a batch are encoded together up to so many characters; chunks of
#: more bytes than the second bound are encoded one by one.
BATCH_CHARS, LONG_CHUNK = 8_000_000, 64


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


def _fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field, value) of a protocol-buffer message."""
    i = 0

    def varint(i):
        x = s = 0
        while True:
            c = raw[i]
            i, x, s = i + 1, x | (c & 127) << s, s + 7
            if c < 128:
                return x, i

    while i < len(raw):
        tag, i = varint(i)
        if tag & 7 == 0:
            value, i = varint(i)
        elif tag & 7 == 2:
            n, i = varint(i)
            value, i = raw[i:i + n], i + n
        else:
            n = 4 if tag & 7 == 5 else 8
            value, i = raw[i:i + n], i + n
        yield tag >> 3, value


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) in id order; types: 1 normal, 2 unknown, 3 control, 4 user-defined, 6 byte."""
    with open(path, "rb") as f:
        raw = f.read()
    out = []
    for field, value in _fields(raw):
        if field == 1:
            p = dict(_fields(value))
            out.append((p[1].decode(), struct.unpack("<f", p[2])[0] if 2 in p else 0.0, p.get(3, 1)))
    return out


def zipf_scores(pieces: list[tuple[str, float, int]]) -> list[float]:
    """Natural log of 1 / (rank + 1), normalised over the normal pieces."""
    ranks = np.cumsum([t in (1, 4) for _, _, t in pieces])
    total = math.log(sum(1 / (r + 1) for r in range(1, int(ranks[-1]) + 1)))
    return [float(-math.log(r + 1) - total) if t in (1, 4) else 0.0 for r, (_, _, t) in zip(ranks.tolist(), pieces)]


class Pieces:
    """Double array (base, check, piece at a node), scores, and byte pieces."""

    def __init__(self, pieces: list[tuple[str, float, int]], scores: list[float]):
        self.scores = np.array(scores, np.float32)
        words = sorted((p.replace(MARK, " ").encode(), i) for i, (p, _, t) in enumerate(pieces) if t in (1, 4))
        if any(b" " in w.lstrip(b" ") for w, _ in words):
            raise ValueError("a piece has the white-space marker behind another character")
        self.unknown = np.float32(min(self.scores[i] for _, i in words) - UNKNOWN_PENALTY)
        self.byte_ids = {int(p[3:5], 16): i for i, (p, _, t) in enumerate(pieces) if t == 6}
        self.longest = max(len(w) for w, _ in words)
        self._build(words)
        raw = [bytes([int(p[3:5], 16)]) if t == 6 else p.replace(MARK, " ").encode() if t in (1, 4) else b""
               for p, _, t in pieces]
        self.is_byte = np.array([t == 6 for _, _, t in pieces])
        self.piece_len = np.array([len(r) for r in raw])
        self.piece_at = np.cumsum(self.piece_len) - self.piece_len
        self.piece_bytes = np.frombuffer(b"".join(raw), np.uint8)

    def _build(self, words: list[tuple[bytes, int]]) -> None:
        size = 1 << 16
        base, check, piece = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        check[0] = 0
        used = np.zeros(size, bool)
        used[0] = True
        free, todo = 1, [(0, 0, len(words), 0)]
        while todo:
            node, lo, hi, depth = todo.pop()
            if len(words[lo][0]) == depth:
                piece[node] = words[lo][1]
                lo += 1
            children = []
            while lo < hi:
                c, at = words[lo][0][depth], lo
                while lo < hi and words[lo][0][depth] == c:
                    lo += 1
                children.append((c, at, lo))
            if not children:
                base[node] = -256  # no byte leads to a slot
                continue
            while used[free]:
                free += 1
            b = self._place(used, free, [c for c, _, _ in children])
            while b + 256 >= len(used):
                used = np.concatenate([used, np.zeros(len(used), bool)])
                base, check, piece = (np.concatenate([x, np.full(len(x), v, np.int32)])
                                      for x, v in ((base, 0), (check, -1), (piece, -1)))
            base[node] = b
            for c, at, end in children:
                used[b + c] = True
                check[b + c] = node
                todo.append((b + c, at, end, depth + 1))
        self.base, self.check, self.piece = base, check, piece

    @staticmethod
    def _place(used: np.ndarray, free: int, codes: list[int]) -> int:
        """The first base from ``free`` on whose slots for all codes are free."""
        b = max(free - codes[0], 1)
        while True:
            room = np.concatenate([used[b:b + 4096 + 256], np.zeros(max(0, b + 4096 + 256 - len(used)), bool)])
            taken = np.zeros(4096, bool)
            for c in codes:
                taken |= room[c:c + 4096]
            if not taken.all():
                return b + int(taken.argmin())
            b += 4096

    def step(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes reached by a byte, -1 where there is none."""
        to = np.maximum(self.base[node] + byte, 0)
        return np.where((self.base[node] >= 0) & (self.check[to] == node), to, -1)

    def encode_chunk(self, raw: bytes) -> list[int]:
        """Viterbi over one chunk, one byte at a time."""
        n = len(raw)
        best, back = [-math.inf] * (n + 1), [(0, -1)] * (n + 1)
        best[0] = np.float32(0)
        base, check, piece, scores = self.base, self.check, self.piece, self.scores
        for s in range(n):
            if raw[s] & 0xC0 == 0x80 or best[s] == -math.inf:
                continue
            width = 1 if raw[s] < 0x80 else 2 if raw[s] < 0xE0 else 3 if raw[s] < 0xF0 else 4
            node, covered = 0, False
            for e in range(s, min(n, s + self.longest)):
                to = base[node] + raw[e]
                if base[node] < 0 or check[to] != node:
                    break
                node = to
                if piece[node] >= 0:
                    covered |= e + 1 - s == width
                    score = best[s] + scores[piece[node]]
                    if score > best[e + 1]:
                        best[e + 1], back[e + 1] = score, (s, int(piece[node]))
            if not covered and best[s] + self.unknown > best[s + width]:
                best[s + width], back[s + width] = best[s] + self.unknown, (s, -1)
        out, e = [], n
        while e:
            s, p = back[e]
            out += [p] if p >= 0 else [self.byte_ids[b] for b in reversed(raw[s:e])]
            e = s
        return out[::-1]

    def encode_chunks(self, chunks: list[bytes]) -> list[list[int]]:
        """Viterbi over many chunks at once, those of like length together."""
        out: list[list[int]] = [[]] * len(chunks)
        size = np.array([len(c) for c in chunks])
        for i in np.flatnonzero(size > LONG_CHUNK).tolist():
            out[i] = self.encode_chunk(chunks[i])
        order = np.argsort(size, kind="stable")
        order = order[size[order] <= LONG_CHUNK]
        for at in range(0, len(order), 16_384):
            rows = order[at:at + 16_384]
            for i, ids in zip(rows.tolist(), self._encode_matrix([chunks[i] for i in rows.tolist()], size[rows])):
                out[i] = ids
        return out

    def _encode_matrix(self, chunks: list[bytes], size: np.ndarray) -> list[list[int]]:
        n, width = len(chunks), int(size.max())
        x = np.zeros((n, width + 4), np.int32)
        flat = np.frombuffer(b"".join(chunks), np.uint8)
        row = np.repeat(np.arange(n), size)
        x[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
        best = np.full((n, width + 5), -np.inf, np.float32)
        best[:, 0] = 0
        start = np.zeros((n, width + 5), np.int32)
        piece = np.full((n, width + 5), -1, np.int32)

        def offer(rows, s, e, score, p):
            better = score > best[rows, e]
            rows, e = rows[better], (e[better] if isinstance(e, np.ndarray) else e)
            best[rows, e], start[rows, e] = score[better], s
            piece[rows, e] = p[better] if isinstance(p, np.ndarray) else p

        for s in range(width):
            rows = np.flatnonzero((size > s) & ((x[:, s] & 0xC0) != 0x80) & np.isfinite(best[:, s]))
            lead = x[rows, s]
            chars = np.where(lead < 0x80, 1, np.where(lead < 0xE0, 2, np.where(lead < 0xF0, 3, 4)))
            covered = np.zeros(n, bool)
            width_of = np.zeros(n, np.int32)
            width_of[rows] = chars
            node, act = np.zeros(len(rows), np.int32), rows
            for e in range(s, min(width, s + self.longest)):
                node = self.step(node, x[act, e])
                ok = (node >= 0) & (size[act] > e)
                node, act = node[ok], act[ok]
                if not len(act):
                    break
                p = self.piece[node]
                hit = np.flatnonzero(p >= 0)
                h = act[hit]
                covered[h[width_of[h] == e + 1 - s]] = True
                offer(h, s, e + 1, best[h, s] + self.scores[p[hit]], p[hit])
            bare = rows[~covered[rows]]
            offer(bare, s, s + width_of[bare], best[bare, s] + self.unknown, -1)
        ends = size.copy()
        steps = []
        act = np.flatnonzero(ends > 0)
        while len(act):
            e = ends[act]
            s, p = start[act, e], piece[act, e]
            steps.append((act, p, s, e))
            ends[act] = s
            act = act[s > 0]
        rows = np.concatenate([a for a, *_ in steps]) if steps else np.empty(0, int)
        depth = np.concatenate([np.full(len(a), i) for i, (a, *_) in enumerate(steps)]) if steps else rows
        order = np.lexsort((-depth, rows))
        p = np.concatenate([q for _, q, _, _ in steps])[order].tolist() if steps else []
        where = np.cumsum(np.bincount(rows, minlength=n)).tolist()
        out, lo = [], 0
        for hi in where:
            out.append(p[lo:hi])
            lo = hi
        if steps and any((q < 0).any() for _, q, _, _ in steps):
            bad = np.unique(np.concatenate([a[q < 0] for a, q, _, _ in steps]))
            for i in bad.tolist():  # uncovered characters become byte pieces
                ids, e = [], int(size[i])
                while e:
                    s, q = int(start[i, e]), int(piece[i, e])
                    ids += [q] if q >= 0 else [self.byte_ids[b] for b in reversed(chunks[i][s:e])]
                    e = s
                out[i] = ids[::-1]
        return out

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """The ids of each text (null and empty: none)."""
        index: dict[str, int] = {}
        docs = []
        for t in texts:
            parts = split_chunks(t)
            docs.append(np.fromiter((index.setdefault(c, len(index)) for c in parts), np.int64, len(parts)))
        ids = self.encode_chunks([c.encode() for c in index])
        n = np.array([len(i) for i in ids])
        at = np.cumsum(n) - n
        flat = np.fromiter((p for i in ids for p in i), np.int32, int(n.sum()))
        out = []
        for d in docs:
            k = n[d]
            skip = np.repeat(at[d] - (np.cumsum(k) - k), k)
            out.append(flat[skip + np.arange(len(skip))])
        return out

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the pieces behind one another, without the leading space."""
        k = self.piece_len[ids]
        skip = np.repeat(self.piece_at[ids] - (np.cumsum(k) - k), k)
        return self.piece_bytes[skip + np.arange(len(skip))].tobytes()[1:]


def split_chunks(text: str | None) -> list[str]:
    """The text behind one more space, cut before every run of spaces."""
    if not text:
        return []
    if "  " in text or text[0] == " ":
        return re.findall(" +[^ ]*", " " + text)
    parts = text.split(" ")
    return [" " + p for p in parts]


@functools.lru_cache(maxsize=2)
def load_pieces(path: str) -> Pieces:
    pieces = read_pieces(path)
    return Pieces(pieces, zipf_scores(pieces))


def encode_documents(docs: DataFrame, model: str | None = None) -> DataFrame:
    """doc_id, ids, decoded (binary, from the ids alone) for every row.

    Null and empty texts have no ids and decode to nothing; a literal marker
    character is written as bytes, so decoding gives every text back.
    """
    small_batches(docs.sparkSession)
    path = model or default_model()
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            lo = chars = 0
            for hi in range(1, len(texts) + 1):
                chars += len(texts[hi - 1] or "")
                if chars < BATCH_CHARS and hi < len(texts):
                    continue
                ids = pieces.encode(texts[lo:hi])
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").slice(lo, hi - lo), pa.array([i.tolist() for i in ids], pa.list_(pa.int32())),
                     pa.array([pieces.decode(i) for i in ids], pa.binary())], ["doc_id", "ids", "decoded"])
                lo, chars = hi, 0

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {doc_id}, ids array<int>, decoded binary")


def op5_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: pieces, byte pieces, crc32 of the ids (little-endian
    32-bit) and of their order, and whether decoding gives the text back."""
    small_batches(spark)
    path = default_model()
    docs = documents(spark, sf_dir).select("doc_id", "text")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = load_pieces(path)
        for b in batches:
            texts = b.column("text").to_pylist()
            lo = chars = 0
            for hi in range(1, len(texts) + 1):
                chars += len(texts[hi - 1] or "")
                if chars < BATCH_CHARS and hi < len(texts):
                    continue
                rows = []
                for t, ids in zip(texts[lo:hi], pieces.encode(texts[lo:hi])):
                    back = pieces.decode(ids)
                    rows.append((len(ids), int(pieces.is_byte[ids].sum()), zlib.crc32(ids.astype("<u4").tobytes()),
                                 sha256(back).hexdigest(), back == (t or "").encode()))
                yield pa.RecordBatch.from_arrays([b.column("doc_id").slice(lo, hi - lo), *map(pa.array, zip(*rows))],
                                                 ["doc_id", "n_pieces", "n_bytes", "ids_crc32", "decoded_sha256", "round_trip"])
                lo, chars = hi, 0

    return docs.mapInArrow(digest, "doc_id long, n_pieces long, n_bytes long, ids_crc32 long, "
                                   "decoded_sha256 string, round_trip boolean")
