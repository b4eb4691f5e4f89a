"""Exact substring deduplication by a hash-compared suffix sort (op 1).

Every byte covered by a WINDOW-byte string that also starts elsewhere goes.

1. Anchors: each WINDOW-byte string owns the leftmost least hash among its
   K-byte grams.  The choice depends on the string alone, so equal strings own
   equal anchors at equal offsets, and an anchor owns a run of string starts.
2. Only anchors whose gram occurs twice or more go on, each with the bytes of
   the strings it owns: one sparse suffix per ~75 bytes of repeated text.
3. Suffixes of one gram meet in a task.  They are merge-sorted to the right
   and to the left of the anchor; a comparison finds the common extension by
   binary search over polynomial prefix hashes, and the common lengths of
   neighbours are verified against the bytes.  Equal contexts are settled
   beforehand and sorted once.  Two strings at the same offset
   are equal when both common lengths reach their ends, so neighbours in the
   two orders give classes of equal strings.
4. A gram with more than SALT_ROWS suffixes is split over tasks by salt.
   Strings found twice in one salt are settled there; the others, and one of
   each settled class, meet once more under a 128-bit hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import MIN_LONG, documents, pin, shuffle_partitions, small_batches

WINDOW, K = 200, 32
SALT_ROWS = 2000
BATCH_ROWS = 8192
_POS = 24  # bits of a position beside a truncated hash; longer texts are read in overlapping parts
_B = np.uint64(0x9E3779B97F4A7C15)


def _gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-byte gram: hashes of 2m bytes from two of m bytes."""
    table = (np.arange(256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    power, m, out, have = table[x], 1, None, 0
    n = len(x) - k + 1
    while m <= k:
        if k & m:  # put this power behind what is there
            out = power if out is None else out[:len(power) - have] * (_B + np.uint64(2 * m)) + power[have:have + len(out)] \
                if len(power) > have else out
            have += m
        if 2 * m <= k:
            mul = np.uint64(0x94D049BB133111EB + 2 * m)
            half = power[:-m] * mul + power[m:]
            power = half ^ (half >> np.uint64(29))
        m *= 2
    out = out[:n].copy()
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    out ^= out >> np.uint64(32)
    return out


def anchors(raw: bytes, window: int = WINDOW, k: int = K) -> list[np.ndarray]:
    """(gram hash, position, first start, last start) of each anchor."""
    x = np.frombuffer(raw, np.uint8)
    part = (1 << _POS) - window
    found = []
    for at in range(0, max(1, len(x) - window + 1), part):
        piece = x[at:at + part + window - 1]
        if len(piece) < window:
            break
        h = _gram_hashes(piece, k)
        key = (h & ~np.uint64((1 << _POS) - 1)) | np.arange(len(h), dtype=np.uint64)
        w, m, low = window - k + 1, 1, key
        while 2 * m <= w:
            low = np.minimum(low[:-m], low[m:])
            m *= 2
        if w > m:
            low = np.minimum(low[:len(low) - (w - m)], low[w - m:])
        pos = (low & np.uint64((1 << _POS) - 1)).astype(np.int64)
        first = np.flatnonzero(np.concatenate(([True], pos[1:] != pos[:-1])))
        last = np.concatenate((first[1:] - 1, [len(pos) - 1]))
        p = pos[first]
        found.append((h[p].view(np.int64), p + at, first + at, last + at))
    return [np.concatenate(c) for c in zip(*found)] if found else [np.empty(0, np.int64)] * 4


def _prefix_hashes(rows: np.ndarray) -> np.ndarray:
    out = np.zeros((len(rows), rows.shape[1] + 1), np.uint64)
    for j in range(rows.shape[1]):
        out[:, j + 1] = out[:, j] * _B + rows[:, j] + np.uint64(1)
        out[:, j + 1] ^= out[:, j + 1] >> np.uint64(31)
    return out


def _common(ph: np.ndarray, size: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the common start of rows a and b, by binary search over prefix hashes."""
    lo, hi = np.zeros(len(a), np.int64), np.minimum(size[a], size[b])
    while (lo < hi).any():
        mid = (lo + hi + 1) >> 1
        same = ph[a, mid] == ph[b, mid]
        lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
    return lo


def suffix_order(rows: np.ndarray, size: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, common length with the one before, -1 at a group's first) of
    zero-padded rows, sorted within groups (which come one after another).

    Bottom-up merge sort: in each round every element finds its place in the
    sibling run by binary search, all runs of all groups at once.
    """
    n = len(rows)
    ph = _prefix_hashes(rows)
    order = np.arange(n)
    first = np.searchsorted(group, group)  # where each slot's group starts
    end = np.searchsorted(group, group, side="right")
    slot = np.arange(n)
    width = rows.shape[1]

    def less(a, b, or_equal):
        c = _common(ph, size, a, b)
        at_end = (c >= size[a]) | (c >= size[b])
        cc = np.minimum(c, width - 1)
        out = np.where(at_end, size[a] < size[b], rows[a, cc] < rows[b, cc])
        return out | (at_end & (size[a] == size[b])) if or_equal else out

    run = 1
    longest = int((end - first).max()) if n else 0
    while run < longest:
        inside = slot - first
        block = inside // run
        is_left = block % 2 == 0
        sib_lo = first + np.where(is_left, block + 1, block - 1) * run
        sib_lo = np.minimum(sib_lo, end)
        sib_hi = np.minimum(sib_lo + run, end)
        lo, hi = sib_lo.copy(), sib_hi.copy()
        while True:
            live = np.flatnonzero(lo < hi)
            if not len(live):
                break
            mid = (lo[live] + hi[live]) >> 1
            a, b = order[mid], order[live]
            left = is_left[live]
            go = np.where(left, less(a, b, False), less(a, b, True))  # equal: the left run comes first
            lo[live] = np.where(go, mid + 1, lo[live])
            hi[live] = np.where(go, hi[live], mid)
        start = first + (block // 2) * 2 * run
        own = np.where(is_left, inside - block * run, inside - block * run)
        place = start + own + (lo - sib_lo)
        new = np.empty_like(order)
        new[place] = order
        order = new
        run *= 2
    a, b = order[:-1], order[1:]
    lcp = np.full(n, -1, np.int64)
    if n > 1:
        c = _common(ph, size, a, b)
        # collision check: equal up to c, and ended or different there
        cols = np.arange(width)
        wrong = ((rows[a] != rows[b]) & (cols[None, :] < c[:, None])).any(1)
        cc = np.minimum(c, width - 1)
        inner = c < np.minimum(size[a], size[b])
        wrong |= inner & (rows[a, cc] >= rows[b, cc]) & (group[:-1] == group[1:])
        if wrong.any():  # a hash collision: order by the bytes themselves
            order = np.array(sorted(range(n), key=lambda i: (group[i], rows[i, :size[i]].tobytes())))
            a, b = order[:-1], order[1:]
            diff = (rows[a] != rows[b]) | (cols[None, :] >= np.minimum(size[a], size[b])[:, None])
            c = np.where(diff.any(1), diff.argmax(1), width)
        lcp[1:] = np.where(group[a] == group[b], c, -1)
    return order, lcp


def repeated_windows(context: list[bytes], left: np.ndarray, group: np.ndarray, window: int = WINDOW):
    """For suffixes given by their bytes, the anchor's place in them and their
    group: a list of (row, starts that repeat, all starts that do not, and the
    starts that stand for their class), starts relative to the context."""
    n = len(context)
    size = np.array([len(c) for c in context])
    span = size - window  # last start in the context
    right_len, left_len = size - left, left
    right = np.zeros((n, int(right_len.max())), np.uint8)
    back = np.zeros((n, max(1, int(left_len.max()))), np.uint8)
    for i, c in enumerate(context):
        x = np.frombuffer(c, np.uint8)
        right[i, :right_len[i]] = x[left[i]:]
        back[i, :left_len[i]] = x[:left[i]][::-1]
    r_order, r_lcp = suffix_order(right, right_len, group)
    l_order, l_lcp = suffix_order(back, left_len, group)
    repeat = np.zeros((n, int(span.max()) + 1), bool)
    stands = np.zeros_like(repeat)
    rc, lc = np.empty(n, np.int64), np.empty(n, np.int64)
    for d in range(int((left - span).min()), int(left.max()) + 1):
        # strings that start d before the anchor
        start = left - d
        rows = np.flatnonzero((start >= 0) & (start <= span))
        if not len(rows):
            continue
        rc[r_order] = np.cumsum(r_lcp < window - d)
        lc[l_order] = np.cumsum(l_lcp < d)
        pair = rc[rows] * (n + 1) + lc[rows]
        _, one, inv, cnt = np.unique(pair, return_index=True, return_inverse=True, return_counts=True)
        repeat[rows, start[rows]] = cnt[inv] > 1
        stands[rows[one], start[rows[one]]] = True
    return repeat, stands, span


def _runs(starts: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Union of [s, s + window) over sorted starts."""
    if not len(starts):
        return []
    cut = np.flatnonzero(np.diff(starts) > window)
    lo = starts[np.concatenate(([0], cut + 1))]
    hi = starts[np.concatenate((cut, [len(starts) - 1]))] + window
    return list(zip(lo.tolist(), hi.tolist()))


def salt_of(doc_id: int, text_hash: int, lo: int, salts: int) -> int:
    """A suffix's salt, even for ids and places in steps."""
    return xxhash.xxh3_64_intdigest(b"%d %d %d" % (doc_id, text_hash, lo)) % salts if salts > 1 else 0


def _settled(rows: list[tuple], window: int) -> list[tuple]:
    """Result rows (_id, _th, lo, hi, w) of whole (gram, salt) groups of
    (gram, salt, salts, _id, _th, lo, left, context)."""
    classes: dict[tuple, int] = {}
    kind = [classes.setdefault((r[0], r[1], r[6], r[7]), len(classes)) for r in rows]
    times = np.bincount(kind)
    keys = list(classes)
    pairs = [k[:2] for k in keys]
    group = np.cumsum([0] + [a != b for a, b in zip(pairs, pairs[1:])])
    mixed = np.flatnonzero(np.bincount(group)[group] > 1)  # groups of several distinct contexts
    repeat: list[np.ndarray] = [np.zeros(len(k[3]) - window + 1, bool) for k in keys]
    stands: list[np.ndarray] = [np.ones(len(k[3]) - window + 1, bool) for k in keys]
    if len(mixed):
        found, first, span = repeated_windows([keys[i][3] for i in mixed], np.array([keys[i][2] for i in mixed]),
                                              group[mixed], window)
        for i, f, s, n in zip(mixed.tolist(), found, first, span.tolist()):
            repeat[i], stands[i] = f[:n + 1], s[:n + 1]
    out, shown = [], set()
    for r, k in zip(rows, kind):
        n = len(r[7]) - window
        rep = repeat[k]
        if times[k] > 1:
            out.append((r[3], r[4], r[5], r[5] + n + window, None))
        elif rep.any():
            out += [(r[3], r[4], r[5] + lo, r[5] + hi, None) for lo, hi in _runs(np.flatnonzero(rep), window)]
        if r[2] > 1:  # a salted gram: what this salt could not settle meets the other salts
            settled = rep | (times[k] > 1)
            show = stands[k] if k not in shown else np.zeros_like(settled)
            shown.add(k)
            for s in np.flatnonzero(~settled | show).tolist():
                out.append((r[3], r[4], r[5] + s, None if settled[s] else r[5] + s + window,
                            xxhash.xxh3_128_digest(r[7][s:s + window])))
    return out


def _squeezed(keyed: DataFrame) -> DataFrame:
    """(_id, _th, raw): the texts' bytes under zstd, for the way through a shuffle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in batches:
            raw = [squeeze((t or "").encode()) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(raw, pa.binary())],
                                             ["_llm_id", "_llm_th", "raw"])

    return keyed.mapInArrow(run, "_llm_id long, _llm_th long, raw binary")


def _keyed(docs: DataFrame) -> DataFrame:
    """(_id, _th, text): _th tells rows of one doc_id apart and is 0 where doc_ids are unique."""
    d = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(MIN_LONG)).alias("_llm_id"), "text")
    twice = d.groupBy("_llm_id").count().where("count > 1").limit(1).count()
    return d.select("_llm_id", (F.xxhash64("text") if twice else F.lit(0).cast("long")).alias("_llm_th"), "text")


def repeated_spans(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """(_id, _th, spans: array of (lo, hi)): byte ranges covered by strings of
    ``window`` bytes that start more than once in the table."""
    spark = docs.sparkSession
    keyed = _keyed(docs)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ths, texts = (b.column(i).to_pylist() for i in range(3))
            out = [[], [], [], []]
            for i, t, text in zip(ids, ths, texts):
                raw = (text or "").encode()
                if len(raw) < window:
                    continue
                h, pos, lo, hi = anchors(raw, window, k)
                out[0].append(np.full(len(h), i)), out[1].append(np.full(len(h), t))
                out[2].append(h), out[3].append(pos << 16 | (pos - hi) << 8 | (pos - lo))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(c) if c else np.empty(0, np.int64), pa.int64()) for c in out],
                ["_llm_id", "_llm_th", "gram", "at"])

    # counts are partial before their shuffle; as a written table they join by
    # two plain exchanges, which is where a hot gram's rows can be split
    found = keyed.mapInArrow(find, "_llm_id long, _llm_th long, gram long, at long")
    often = pin(found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "grams")
    salts = F.ceil(F.col("n") / SALT_ROWS).cast("int")
    per = (found.join(often.hint("merge"), "gram").select("_llm_id", "_llm_th", F.struct("gram", "at", salts.alias("salts")).alias("a"))
           .groupBy("_llm_id", "_llm_th").agg(F.collect_list("a").alias("a")))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["gram", "salt", "salts", "_llm_id", "_llm_th", "lo", "left", "context"]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for i, t, text, found in zip(*(b.column(c).to_pylist() for c in range(4))):
                raw = unpack(text)
                for a in found:
                    gram, at, salts = a["gram"], a["at"], a["salts"]
                    pos = at >> 16
                    hi, lo = pos - (at >> 8 & 255), pos - (at & 255)
                    salt = salt_of(i, t, lo, salts)
                    out.append((gram, salt, salts, i, t, lo, pos - lo, raw[lo:hi + window]))
                if len(out) >= 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*out), types)], names)
                    out = []
            cols = list(zip(*out)) or [[]] * 8
            yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(cols, types)], names)

    suffixes = _squeezed(keyed.where("text is not null")).join(per, ["_llm_id", "_llm_th"]).mapInArrow(
        contexts, "gram long, salt int, salts int, _llm_id long, _llm_th long, lo long, left int, context binary")

    def settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["_llm_id", "_llm_th", "lo", "hi", "w"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]

        def solve(rows):
            cols = list(zip(*_settled(rows, window))) or [[]] * 5
            return pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(cols, types)], names)

        rows, last = [], None
        for b in batches:
            for row in zip(*(b.column(c).to_pylist() for c in range(8))):
                if row[:2] != last and len(rows) >= BATCH_ROWS:
                    yield solve(rows)
                    rows = []
                last = row[:2]
                rows.append(row)
        if rows:
            yield solve(rows)

    settled = pin(
        suffixes.repartition(shuffle_partitions(spark), "gram", "salt").sortWithinPartitions("gram", "salt", "_llm_id", "lo")
        .mapInArrow(settle, "_llm_id long, _llm_th long, lo long, hi long, w binary"), "spans")
    open_ = settled.where("w is not null")
    again = open_.groupBy("w").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("w")
    late = open_.where("hi is not null").join(again, "w").select("_llm_id", "_llm_th", "lo", "hi")
    return (settled.where("w is null").select("_llm_id", "_llm_th", "lo", "hi").unionByName(late)
            .groupBy("_llm_id", "_llm_th").agg(F.sort_array(F.collect_list(F.struct("lo", "hi"))).alias("spans")))


def dedup_substrings(docs: DataFrame, window: int = WINDOW, k: int = K) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (bytes) for every row.

    Texts are judged as UTF-8 bytes on the input alone; null is empty, texts
    shorter than the window lose nothing, a repeated row loses all that its
    copy covers, and rows with a null doc_id take part like any other.
    """
    small_batches(docs.sparkSession)
    spans = pin(repeated_spans(docs, window, k), "merged")
    j = _squeezed(_keyed(docs)).join(spans, ["_llm_id", "_llm_th"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            out = []
            for i, raw, spans in zip(*(b.column(c).to_pylist() for c in range(3))):
                raw = unpack(raw)
                kept, at, runs = [], 0, []
                for s in spans or ():
                    if runs and s["lo"] <= runs[-1][1]:
                        runs[-1][1] = max(runs[-1][1], s["hi"])
                    else:
                        runs.append([s["lo"], s["hi"]])
                for lo, hi in runs:
                    kept.append(raw[at:lo])
                    at = hi
                kept.append(raw[at:])
                out.append((None if i == MIN_LONG else i, len(raw), sum(hi - lo for lo, hi in runs), len(runs),
                            b"".join(kept)))
            cols = list(zip(*out)) or [[]] * 5
            types = [*[pa.int64()] * 4, pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return j.select("_llm_id", "raw", "spans").mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_substrings(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
