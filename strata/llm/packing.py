"""Sequence packing by minimum bin slack (op 2).

Documents are tokenised once; whole windows of a document are sequences of
their own, what remains is an item of 1 to window - 1 ids.  Only the number of
items of each length reaches the driver (window - 1 counters, whatever the
corpus).  There each window is seeded with the longest length left and a
bitset subset-sum program picks the multiset of other lengths that comes
closest to its capacity, counts being backtracked through the bitsets.  A
pattern is repeated as often as the counts allow, so each one uses up a length
and the plan stays small.  Where no multiset fits exactly one item more is
cut; the last window is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import json
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, pin, row_key, small_batches

WINDOW = 2048
END_ID = 1
#: Cut rows up to this many are broadcast to find their texts again, more are joined.
BROADCAST_ROWS = 20_000


def default_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


@functools.lru_cache(maxsize=2)
def _tokenizer(path: str):
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


@functools.lru_cache(maxsize=2)
def _fast(path: str):
    """The same merges in a faster encoder, for texts of plain characters; None
    if the file is no byte-level BPE of the usual split pattern."""
    try:
        import tiktoken
    except ImportError:
        return None
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    if spec["model"]["type"] != "BPE" or (spec.get("pre_tokenizer") or {}).get("type") != "ByteLevel" \
            or spec["pre_tokenizer"].get("add_prefix_space") or spec.get("normalizer"):
        return None
    # byte-level vocabularies write bytes as printable characters
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    char = {chr(b): b for b in plain}
    char |= {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(char[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
    pattern = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=1)
def _odd():
    import re
    return re.compile("[^\n\r\t\x20-\x7e¡-ɏ]|<\\|")


def encode(text: str | None, path: str) -> np.ndarray:
    """A document's ids and its end id, as little-endian unsigned 32-bit."""
    text = text or ""
    fast = _fast(path)
    if fast is not None and not _odd().search(text):
        ids = fast.encode_ordinary(text)
    else:
        ids = _tokenizer(path).encode(text, add_special_tokens=False).ids
    ids.append(END_ID)
    return np.array(ids, "<u4")


def best_subset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths (at most counts[l] of each) whose sum is the
    largest one up to ``capacity``.

    Bit s of a bitset says that sum s can be made; lengths are added longest
    first, in binary chunks of their count, until the capacity is reached.
    """
    mask = (1 << (capacity + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= capacity and counts[x] > 0), reverse=True):
        left, chunk = min(counts[length], capacity // length), 1
        while left > 0 and not reach >> capacity & 1:
            k = min(chunk, left)
            steps.append((length, k, reach))
            reach |= (reach << (length * k)) & mask
            left -= k
            chunk *= 2
        if reach >> capacity & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for length, k, before in reversed(steps):  # what a chunk added is taken only if the sum needs it
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + k
            at -= length * k
    return chosen


def plan_windows(counts: dict[int, int], window: int = WINDOW) -> tuple[dict, int, int]:
    """Records by length, the number of sequences, the number of cut items.

    A record (first rank, end rank, per window, pieces, tail): the item of
    rank r is slot i % m of repetition i // m with i = r - first; each piece is
    (start, length, sequence + repetition, offset + slot * stride) and a tail
    (length, rank) makes what is left the item of that rank of a shorter length.
    """
    avail = {k: v for k, v in counts.items() if v}
    used = dict.fromkeys(avail, 0)
    total = dict(avail)
    records: dict[int, list] = {}
    seq = cuts = 0

    def take(length, n, m, pieces, tail=None):
        records.setdefault(length, []).append((used[length], used[length] + n, m, pieces, tail))
        used[length] += n
        avail[length] -= n
        if not avail[length]:
            del avail[length]

    while avail:
        longest = max(avail)
        rest = dict(avail)
        rest[longest] -= 1
        chosen = best_subset(rest, window - longest)
        chosen[longest] = chosen.get(longest, 0) + 1
        slack = window - sum(k * v for k, v in chosen.items())
        spare = max((x for x in avail if avail[x] > chosen.get(x, 0)), default=None) if slack else None
        if slack and spare is None:  # all that is left: one window, cut at powers of two
            at, size = 0, window - slack
            bounds, pos = [], 0
            for b in reversed(range(size.bit_length())):
                if size >> b & 1:
                    bounds.append((pos, pos + (1 << b), seq))
                    seq += 1
                    pos += 1 << b
            for length in sorted(chosen, reverse=True):
                for _ in range(chosen[length]):
                    pieces = [(max(at, lo) - at, min(at + length, hi) - max(at, lo), s, max(at, lo) - lo, 0)
                              for lo, hi, s in bounds if lo < at + length and hi > at]
                    cuts += len(pieces) > 1
                    take(length, 1, 1, pieces)
                    at += length
            continue
        need = dict(chosen)
        if slack:
            need[spare] = need.get(spare, 0) + 1
        times = min(avail[x] // need[x] for x in need)
        offset = 0
        for length in sorted(chosen, reverse=True):
            take(length, times * chosen[length], chosen[length], [(0, length, seq, offset, length)])
            offset += length * chosen[length]
        if slack:
            short = spare - slack
            rank = total.get(short, 0)
            total[short] = rank + times
            avail[short] = avail.get(short, 0) + times
            used.setdefault(short, 0)
            take(spare, times, 1, [(0, slack, seq, offset, 0)], (short, rank))
            cuts += times
        seq += times
    return records, seq, cuts


def place(records: dict, starts: dict, length: int, rank: int) -> list[tuple[int, int, int, int]]:
    """(start, length, sequence, offset) of every piece of an item."""
    out, shift = [], 0
    while True:
        rows = records[length]
        lo, _, m, pieces, tail = rows[bisect_right(starts[length], rank) - 1]
        rep, slot = divmod(rank - lo, m)
        for start, n, s, off, stride in pieces:
            out.append((shift + start, n, s + rep, off + slot * stride))
        if tail is None:
            return out
        shift += pieces[0][1]
        length, rank = tail[0], tail[1] + rep


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset.

    Null and empty texts are the end id alone.  Every row of ``docs`` is a
    document of its own, also under a repeated or null doc_id.
    """
    spark = docs.sparkSession
    small_batches(spark)
    path = tokenizer or default_tokenizer()
    keyed = docs.select("doc_id", "text", *row_key(F.col("text"), F.col("doc_id")))
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ranks = TaskContext.get().partitionId(), {}
        for b in batches:
            rows = []
            for text in b.column("text").to_pylist():
                ids = encode(text, path)
                crcs = [zlib.crc32(ids[i:i + window].tobytes()) for i in range(0, len(ids), window)]
                rest = len(ids) % window
                whole = ranks.get(window, 0)
                ranks[window] = whole + len(ids) // window
                rank = ranks.get(rest, 0)
                ranks[rest] = rank + 1
                rows.append((part, len(ids), whole, rest, rank, crcs))
            cols = list(zip(*rows)) or [[]] * 6
            types = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("_llm_id"), b.column("_llm_th"), *(pa.array(c, t) for c, t in zip(cols, types))],
                ["doc_id", "_llm_id", "_llm_th", "part", "doc_tokens", "whole", "rest", "rank", "crcs"])

    measured = pin(keyed.mapInArrow(
        measure, f"doc_id {id_type}, _llm_id long, _llm_th long, part int, doc_tokens long, whole long, rest int, "
                 "rank long, crcs array<long>"), "tokens")
    # ranks count up within a task; tasks follow each other by their number
    per = measured.groupBy("part", "rest").agg(F.count(F.lit(1)).alias("n")).where("rest > 0").unionByName(
        measured.groupBy("part").agg(F.sum(F.floor(F.col("doc_tokens") / window)).alias("n"))
        .select("part", F.lit(window).alias("rest"), "n"))
    upto = Window.partitionBy("rest").orderBy("part")
    per = pin(per.withColumn("before", F.sum("n").over(upto) - F.col("n")), "lengths")
    counts = {r["rest"]: r["n"] for r in per.groupBy("rest").agg(F.sum("n").alias("n")).collect()}
    n_whole = counts.pop(window, 0) or 0
    records, _, n_cuts = plan_windows(counts, window)
    shared = spark.sparkContext.broadcast((records, {k: [r[0] for r in v] for k, v in records.items()}))
    base = per.select("part", "rest", "before")
    j = (measured.join(base.where(F.col("rest") == window).select("part", F.col("before").alias("whole0")), "part", "left")
         .join(base, ["part", "rest"], "left")
         .select("doc_id", "_llm_id", "_llm_th", "doc_tokens", (F.col("whole") + F.coalesce("whole0", F.lit(0))).alias("whole"),
                 "rest", (F.col("rank") + F.coalesce("before", F.lit(0))).alias("rank"), "crcs"))
    names = ["doc_id", "_llm_id", "_llm_th", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records, starts = shared.value
        for b in batches:
            at, rows = [], []
            cols = (b.column(i).to_pylist() for i in range(3, 8))
            for i, (tokens, whole, rest, rank, crcs) in enumerate(zip(*cols)):
                full = tokens // window
                for k in range(full):
                    at.append(i)
                    rows.append((k * window, window, crcs[k], tokens, whole + k, 0))
                if rest:
                    pieces = place(records, starts, rest, rank)
                    for start, n, s, off in pieces:
                        at.append(i)
                        rows.append((full * window + start, n, crcs[-1] if len(pieces) == 1 else None, tokens,
                                     n_whole + s, off))
            out = list(zip(*rows)) or [[]] * 6
            keys = b.select(["doc_id", "_llm_id", "_llm_th"]).take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([*keys.columns, *(pa.array(c, pa.int64()) for c in out)], names)

    pieces = j.mapInArrow(assign, f"doc_id {id_type}, _llm_id long, _llm_th long, start long, length long, ids_crc32 long, "
                                  "doc_tokens long, sequence_id long, offset long")
    if n_cuts:
        pieces = pin(pieces, "pieces")
        pieces = pieces.where("ids_crc32 is not null").unionByName(
            _checksum_cuts(keyed, pieces.where("ids_crc32 is null"), n_cuts, path))
    return pieces.drop("_llm_id", "_llm_th")


def _checksum_cuts(keyed: DataFrame, cut: DataFrame, n_cuts: int, path: str) -> DataFrame:
    """Checksums of the pieces of cut documents, from their texts."""
    texts = keyed.select("_llm_id", "_llm_th", "text")
    ids = cut.select("_llm_id", "_llm_th").distinct()
    if n_cuts <= BROADCAST_ROWS:
        texts = texts.join(F.broadcast(ids), ["_llm_id", "_llm_th"], "left_semi")
    else:
        texts = texts.join(ids, ["_llm_id", "_llm_th"], "left_semi")
    j = cut.join(texts.dropDuplicates(["_llm_id", "_llm_th"]).withColumnRenamed("text", "_text"), ["_llm_id", "_llm_th"])
    names = cut.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            crc = [zlib.crc32(encode(t, path)[s:s + n].tobytes()) for t, s, n in zip(
                b.column("_text").to_pylist(), b.column("start").to_pylist(), b.column("length").to_pylist())]
            cols = [pa.array(crc, pa.int64()) if c == "ids_crc32" else b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays(cols, names)

    return j.select(*names, "_text").mapInArrow(run, cut.schema)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir).select("doc_id", "text"))
