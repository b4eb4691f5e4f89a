"""N-gram Jaccard join with adaptive multi-match prefixes (op 10).

1. Every text becomes its sorted set of shingle hashes.  Equal sets collapse
   to the smallest doc_id holding them.
2. Parts: the hash range is cut into k parts (k by classes of set size).  Linked
   sets differ in at most H shingles, so at least k - H of their parts are equal;
   the fullest of these is among the H + 1 fullest parts of either set, and only
   the signatures of those travel.  A part holds several shingles: sets that
   share single shingles by chance do not meet, however many sets there are.
3. Documents that share a part form candidate groups (connected components over
   part -> smallest holder edges).
4. Groups are cut into blocks of bounded size: first by bands of set size
   (linked sets lie in the same or adjacent bands), then by salt, every pair of
   salts meeting in one block.  A task links its block with adaptive prefixes:
   each set lengthens its prefix by l - 1 tokens where the estimated candidate
   cost falls, and a candidate must then share l prefix tokens before the sets
   are compared.  Sets already connected are not compared again, and a block
   returns a spanning forest of its links.

No pair list is ever made: all tables are linear in documents, parts or block
members.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import connected_components, documents, pin, shuffle_partitions, small_batches

#: Parts beyond the least number, per cent (so the thinnest ones are left out).
EXTRA = 25
#: Bounds of a block: sets, and shingles of all its sets together.
BLOCK_SETS, BLOCK_TOKENS = 2000, 4_000_000
#: Prefix lengthening tried per set, and the cost of comparing two sets in posting reads.
MAX_MATCH, COMPARE = 4, 20
_CACHE: dict[bytes, int] = {}


def _hash_word(word: bytes) -> int:
    h = _CACHE.get(word)
    if h is None:
        if len(_CACHE) > 400_000:
            _CACHE.clear()
        h = _CACHE[word] = xxhash.xxh3_64_intdigest(word)
    return h


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the n-word shingles (a shorter text is
    one shingle; null and blank texts have none)."""
    words = (text or "").encode().lower().split()  # bytes: only A-Z fall, only ASCII space splits
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(_hash_word, words), np.uint64, len(words))
    k = min(n, len(words))
    x = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + h[j:len(h) - k + 1 + j])
    return np.unique(x)


def least_overlap(size: int, num: int, den: int) -> int:
    """A set of this size shares at least so many shingles with any it links to."""
    return -(-num * size // den)


@lru_cache(maxsize=256)
def _parts(size_class: int, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """First hash and salt of every part for sets of 2 ** size_class to 2 ** (size_class + 1) - 1 shingles."""
    most = 2 * ((2 << size_class) - 1) * (den - num) // (den + num)  # shingles in which linked sets can differ
    k = -(-(most + 1) * (100 + EXTRA) // 100)
    first = np.array([(i << 64) // k for i in range(k)], np.uint64)
    return first, _mix(_mix(first) + np.uint64(size_class + 1))


def part_signatures(s: np.ndarray, num: int, den: int) -> np.ndarray:
    """Signatures of the fullest parts of a sorted set; linked, unequal sets have one in common.

    A pair meets in the class of its larger set, so a set has parts in every
    class up to that of the largest set it can link to.
    """
    n = len(s)
    largest = n * den // num
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_mix(s), dtype=np.uint64)))
    out = []
    for c in range(n.bit_length() - 1, largest.bit_length()):
        differ = (n + min(largest, (2 << c) - 1)) * (den - num) // (den + num)
        if not differ:  # only equal sets link
            continue
        first, salts = _parts(c, num, den)
        cuts = np.append(np.searchsorted(s, first), n)
        sizes = np.diff(cuts)
        sigs = _mix(sums[cuts[1:]] - sums[cuts[:-1]] + salts)
        out.append(sigs[np.lexsort((sigs, sizes))[-differ - 1:]])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def link_block(ids: list[int], sets: list[np.ndarray], sides: list[int], num: int, den: int) -> list[tuple[int, int]]:
    """A spanning forest of the links of a block (of links between its sides
    if it has two), as pairs of ids."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets])
    _, local, freq = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.empty(len(freq), np.int64)
    order[np.lexsort((np.arange(len(freq)), freq))] = np.arange(len(freq))
    by_rank = np.sort(freq)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    tokens = order[local]
    for i in range(n):
        tokens[starts[i]:ends[i]].sort()
    two = len(set(sides)) > 1
    side = np.array(sides)
    root = np.arange(n)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    match = np.ones(n, np.int64)
    posting: dict[int, list[int]] = {}
    flag = np.zeros(len(freq), bool)
    links = []
    for i in np.lexsort((np.array(ids), sizes)):
        own = tokens[starts[i]:ends[i]]
        base = len(own) - least_overlap(len(own), num, den)
        reads = np.cumsum(by_rank[own[:base + MAX_MATCH]])
        best = min((reads[min(base + m, len(reads)) - 1] * (1 + COMPARE / m), m)
                   for m in range(1, MAX_MATCH + 1) if m == 1 or base + m <= len(own))[1]
        match[i] = best
        prefix = own[:base + best]
        hits = [j for t in prefix.tolist() for j in posting.get(t, ())]
        if hits:
            cand, shared = np.unique(np.array(hits), return_counts=True)
            ok = (shared >= np.minimum(best, match[cand])) & (sizes[cand] * den >= num * sizes[i])
            if two:
                ok &= side[cand] != side[i]
            cand = cand[ok][np.argsort(-shared[ok], kind="stable")]
            if len(cand):
                flag[own] = True
                while len(cand):
                    mine = find(i)
                    cand = cand[np.fromiter((find(c) != mine for c in cand.tolist()), bool, len(cand))]
                    now, cand = cand[:64], cand[64:]
                    if not len(now):
                        break
                    flat = np.concatenate([tokens[starts[c]:ends[c]] for c in now])
                    both = np.add.reduceat(flag[flat], np.concatenate(([0], np.cumsum(sizes[now])[:-1])), dtype=np.int64)
                    for c in now[den * both >= num * (sizes[now] + sizes[i] - both)].tolist():
                        a, b = find(c), find(i)
                        if a != b:
                            root[max(a, b)] = min(a, b)
                            links.append((int(ids[i]), int(ids[c])))
                flag[own] = False
        for t in prefix.tolist():
            posting.setdefault(t, []).append(int(i))
    return links


def _profile(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """doc_id, n_shingles, sig (128-bit hash of the set), parts (signatures)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, sigs, flat, cuts = [], [], [], [0]
            for text in b.column("text").to_pylist():
                s = shingle_set(text, n)
                sizes.append(len(s))
                sigs.append(xxhash.xxh3_128_digest(s.tobytes()))
                flat.append(part_signatures(s, num, den) if len(s) else s)
                cuts.append(cuts[-1] + len(flat[-1]))
            tokens = np.concatenate(flat).view(np.int64) if flat else np.empty(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(tokens))],
                ["doc_id", "n_shingles", "sig", "parts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, sig binary, parts array<long>")


def link_documents(docs: DataFrame, n: int = 3, num: int = 90, den: int = 100) -> DataFrame:
    """doc_id, n_shingles, component_id for every row.

    Two documents link when den * |a & b| >= num * |a | b| over their sets of
    n-word shingles.  Null, empty and blank texts have no set and link with
    nothing; rows with a null doc_id have no component; rows repeated under
    one doc_id are one document; ties need no order.
    """
    small_batches(docs.sparkSession)
    rows = pin(_profile(docs, n, num, den), "sets")
    sets = rows.where("n_shingles > 0 and doc_id is not null")
    reps = sets.groupBy("sig").agg(F.min("doc_id").alias("rep"), F.count(F.lit(1)).alias("n"))
    # joins with texts and sets are merge joins at every size: what is small here grows
    copies = pin(sets.select("doc_id", "sig").join(reps.where("n > 1"), "sig").where("doc_id <> rep")
                 .select("doc_id", "sig", "rep").distinct(), "copies")
    alone = sets.join(copies.select("doc_id", "sig").hint("merge"), ["doc_id", "sig"], "left_anti")
    parts = alone.select("doc_id", F.explode("parts").alias("part"))
    # minima as a written table: the join is of two plain exchanges, whose hot keys can be split
    pivots = pin(parts.groupBy("part").agg(F.min("doc_id").alias("b"), F.max("doc_id").alias("top")).where("b < top")
                 .select("part", "b"), "pivots")
    groups = connected_components(parts.join(pivots.hint("merge"), "part").select(F.col("doc_id").alias("a"), "b"))
    links = _block_links(docs, alone.select("doc_id", "n_shingles"), groups, n, num, den)
    comps = connected_components(links)
    out = (rows.select("doc_id", "n_shingles", "sig")
           .join(copies, ["doc_id", "sig"], "left")
           .withColumn("node", F.coalesce("rep", "doc_id"))
           .join(comps, "node", "left"))
    return out.select("doc_id", "n_shingles", F.coalesce("component", "node").alias("component_id"))


def _block_links(docs: DataFrame, sizes: DataFrame, groups: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(a, b): the links inside candidate groups, a spanning forest per block."""
    spark = docs.sparkSession
    band = F.floor(F.log(F.col("n_shingles")) / F.log(F.lit(den / num)) + 1e-9).cast("int") if num < den \
        else F.col("n_shingles").cast("int")
    members = pin(groups.withColumnRenamed("node", "doc_id").join(sizes, "doc_id")
                  .select("doc_id", F.col("component").alias("grp"), "n_shingles", band.alias("band")).distinct(), "members")
    parts = lambda t, c: F.greatest(F.ceil(c / BLOCK_SETS), F.ceil(t / BLOCK_TOKENS)).cast("int")
    whole = members.groupBy("grp").agg(parts(F.sum("n_shingles"), F.count(F.lit(1))).alias("grp_parts"))
    bands = members.groupBy("grp", "band").agg(parts(F.sum("n_shingles"), F.count(F.lit(1))).alias("m"))
    near = bands.select("grp", (F.col("band") - 1).alias("band"), F.col("m").alias("m_above")).join(
        bands, ["grp", "band"], "full").select(
        "grp", "band", F.coalesce("m", F.lit(0)).alias("m"), F.coalesce("m_above", F.lit(0)).alias("m_above"))
    below = bands.select("grp", (F.col("band") + 1).alias("band"), F.col("m").alias("m_below"))
    plan = pin(near.where("m > 0").join(below, ["grp", "band"], "left").join(whole, "grp"), "plan")
    j = members.join(plan.hint("merge"), ["grp", "band"])
    salt = F.pmod(F.xxhash64("doc_id"), F.col("m")).cast("int")

    def key(lo, i, k, kind, side):
        return F.struct(lo.cast("int").alias("lo"), i.cast("int").alias("i"), k.cast("int").alias("k"),
                        F.lit(kind).alias("kind"), side.cast("int").alias("side"))

    def upto(c):
        return F.when(c > 0, F.sequence(F.lit(0), c - 1)).otherwise(F.array().cast("array<int>"))

    same = F.transform(upto(F.col("m")), lambda s: key(
        F.col("band"), F.least(s, F.col("salt")), F.greatest(s, F.col("salt")), 0, F.when(F.col("salt") <= s, 0).otherwise(1)))
    up = F.transform(upto(F.col("m_above")), lambda s: key(F.col("band"), F.col("salt"), s, 1, F.lit(0)))
    down = F.transform(upto(F.coalesce("m_below", F.lit(0))), lambda s: key(
        F.col("band") - 1, s, F.col("salt"), 1, F.lit(1)))
    one = F.array(key(F.lit(0), F.lit(0), F.lit(0), 2, F.lit(0)))
    keys = pin(j.withColumn("salt", salt).select(
        "doc_id", "n_shingles", "grp", F.when(F.col("grp_parts") <= 1, one).otherwise(F.concat(same, up, down)).alias("keys")),
        "blocks")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(keys.hint("merge"), "doc_id")

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for d, text, size, grp, keys in zip(*(b.column(i).to_pylist() for i in range(5))):
                s = shingle_set(text, n)
                if len(s) == size:
                    raw = s.tobytes()
                    out += [(grp, k["lo"], k["i"], k["k"], k["kind"], k["side"], d, raw) for k in keys]
            cols = list(zip(*out)) or [[]] * 8
            types = [pa.int64(), *[pa.int32()] * 5, pa.int64(), pa.binary()]
            for at in range(0, max(1, len(out)), 2000):
                yield pa.RecordBatch.from_arrays([pa.array(c[at:at + 2000], t) for c, t in zip(cols, types)],
                                                 ["grp", "lo", "i", "k", "kind", "side", "doc_id", "shingles"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, last, links = [], None, []
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(8))):
                if row[:5] != last:
                    links += _linked(block, last, num, den)
                    block, last = [], row[:5]
                block.append(row[5:])
            if len(links) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*links)], ["a", "b"])
                links = []
        links += _linked(block, last, num, den)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (list(zip(*links)) or [[], []])], ["a", "b"])

    cols = ["grp", "lo", "i", "k", "kind"]
    blocks = texts.select("doc_id", "text", "n_shingles", "grp", "keys").mapInArrow(
        sets_of, "grp long, lo int, i int, k int, kind int, side int, doc_id long, shingles binary")
    return (blocks.repartition(shuffle_partitions(spark), *cols).sortWithinPartitions(*cols, "doc_id", "side")
            .mapInArrow(link, "a long, b long"))


def _linked(block: list, key: tuple | None, num: int, den: int) -> list[tuple[int, int]]:
    if len(block) < 2:
        return []
    two = key[4] == 1 or (key[4] == 0 and key[2] != key[3])
    return link_block([r[1] for r in block], [np.frombuffer(r[2], np.uint64) for r in block],
                      [r[0] if two else 0 for r in block], num, den)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(documents(spark, sf_dir).select("doc_id", "text"))
