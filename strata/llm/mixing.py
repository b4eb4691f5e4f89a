"""Mixing sources to target weights (op 12).

1. Sizes are words.  A source's target is its weight's share of all words, but
   at most a multiple of the source's size; the excess is reshared by weight.
2. A source is a stream of words: its documents in the order of a hash of their
   id, over and over.  The mix takes the stream up to the target, cut into
   blocks of equal length (the last one is shorter), so a document stands in
   consecutive blocks and only the one at the target is taken in part.
3. Blocks go to output shards by a tree of multivariate hypergeometric splits:
   the blocks of all sources together are halved again and again, each half
   drawing how many blocks of each source it gets out of what its parent got.
   So each shard has its exact number of blocks, each source its exact quota,
   and the shares of a shard scatter as those of a random draw.  The tree is
   cut by chunks of sources: first chunks are split, then the sources of a chunk
   under its shards' quotas.
4. A shard's quota of a source is a run of the source's permuted block numbers
   (a keyed bijection, so shards draw disjoint blocks without a table), and its
   blocks are ordered by a hash.

A task holds one chunk of sources and one number a shard, or one shard.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.prefix import running_total, with_row_number
from .common import documents, pin, shuffle_partitions, small_batches

WEIGHTS, MOST = (1, 2, 3), 3
#: Words of a block (doubled until there are less than MAX_BLOCKS), and of a shard.
BLOCK_WORDS, MAX_BLOCKS, SHARD_WORDS = 1024, 1 << 29, 1 << 24
#: Sources split together.
CHUNK = 1024
#: A table of sources of at most so many bytes (measured) is broadcast.
SMALL_BYTES = 4 << 20
WORDS = r"[^\x20\x09-\x0D]+"


def _seed(*parts) -> int:
    return int.from_bytes(hashlib.sha256(repr(parts).encode()).digest()[:8])


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(ranks: np.ndarray, n: int, *key) -> np.ndarray:
    """The numbers below n that a keyed bijection gives to these ranks (a
    four-round Feistel network, walked until it falls below n)."""
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = [np.uint64(_seed("round", i, *key)) for i in range(4)]
    out = ranks.astype(np.uint64)
    todo = np.ones(len(out), bool)
    while todo.any():
        left, right = out[todo] >> shift, out[todo] & mask
        for k in keys:
            left, right = right, left ^ (_mix(right + k) & mask)
        out[todo] = (left << shift) | right
        todo = out >= np.uint64(n)
    return out.astype(np.int64)


def split_tree(counts: np.ndarray, capacities: np.ndarray, *key) -> Iterator[tuple[int, np.ndarray]]:
    """(shard, blocks of each source) for shards of these capacities, drawn
    without replacement from ``counts`` blocks of each source.

    A node of the tree draws its left half's blocks, seeded by the node alone.
    """
    ends = np.concatenate(([0], np.cumsum(capacities)))
    stack = [(0, len(capacities), counts.astype(np.int64))]
    while stack:
        lo, hi, have = stack.pop()
        if hi - lo == 1:
            yield lo, have
            continue
        mid = (lo + hi) // 2
        rng = np.random.Generator(np.random.PCG64(_seed("node", lo, hi, *key)))
        left = rng.multivariate_hypergeometric(have, int(ends[mid] - ends[lo]), method="marginals")
        stack.append((mid, hi, have - left))
        stack.append((lo, mid, left))


def source_targets(sources: DataFrame, most: int = MOST) -> DataFrame:
    """``sources`` (source_size, weight) with ``target``: weights share the sum
    of all sizes, no target is above ``most`` times its source's size.

    Each round is one aggregate over the sources; the level (words a unit of
    weight gets) rises until no further source is above.
    """
    full = F.col("source_size") * most
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level, capped = 0.0, -1
    while True:
        above = full < F.col("weight") * F.lit(level)
        row = sources.agg(F.coalesce(F.sum(F.when(above, full)), F.lit(0)).alias("given"),
                          F.sum(F.when(~above, F.col("weight"))).alias("weight"), F.count_if(above).alias("n")).first()
        if row["n"] == capped or not row["weight"]:
            break
        level, capped = (total - row["given"]) / row["weight"], row["n"]
    return sources.withColumn("target", F.least(full.cast("double"), F.col("weight") * F.lit(level)))


def _known(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """The rows of ``sized`` with their source's number."""
    few = sources.select(F.col("source").alias("name"), "source_no")
    size = sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64).alias("b")).first()["b"] or 0
    few = F.broadcast(few) if size <= SMALL_BYTES else few.hint("merge")
    return sized.join(few, F.col("source").eqNullSafe(F.col("name"))).drop("name")


def _quotas(sources: DataFrame, blocks: int, shards: int, seed: str) -> DataFrame:
    """shard, source_no, n_blocks, start, count: the ranks of a source's
    permuted blocks that a shard draws."""
    spark = sources.sparkSession
    chunked = sources.where("n_blocks > 0").withColumn("chunk", F.floor(F.col("source_no") / CHUNK))
    fields = ["chunk", "shard", "count"]

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple[int, int]] = []
        for b in batches:
            rows += list(zip(b.column("chunk").to_pylist(), b.column("n").to_pylist()))
        if not rows:
            return
        names, counts = map(np.array, zip(*sorted(rows)))
        capacities = np.diff([i * blocks // shards for i in range(shards + 1)])
        for shard, got in split_tree(counts, capacities, seed, "chunks"):
            some = np.flatnonzero(got)
            yield pa.RecordBatch.from_arrays([pa.array(names[some], pa.int64()), pa.array(np.full(len(some), shard), pa.int64()),
                                              pa.array(got[some], pa.int64())], fields)

    per_chunk = pin(chunked.groupBy("chunk").agg(F.sum("n_blocks").alias("n")).coalesce(1)
                    .mapInArrow(chunks, "chunk long, shard long, count long"), "mix-chunks")
    both = chunked.select("chunk", F.lit(0).alias("kind"), F.col("source_no").alias("who"), F.col("n_blocks").alias("count")).unionByName(
        per_chunk.select("chunk", F.lit(1).alias("kind"), F.col("shard").alias("who"), "count"))

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: dict[int, list[np.ndarray]] = {}
        for b in batches:
            chunk, kind, who, count = (b.column(i).to_numpy() for i in range(4))
            cuts = np.flatnonzero(np.diff(chunk)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(chunk)]):
                if hi > lo and now and chunk[lo] not in now:
                    yield from split(*now.popitem())
                if hi > lo:
                    now.setdefault(int(chunk[lo]), []).append(np.stack([kind[lo:hi], who[lo:hi], count[lo:hi]]))
        if now:
            yield from split(*now.popitem())

    def split(chunk: int, parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        kind, who, count = np.concatenate(parts, axis=1)
        names, counts, shard, capacity = who[kind == 0], count[kind == 0], who[kind == 1], count[kind == 1]
        given = np.zeros(len(names), np.int64)
        out, rows = [], 0
        for i, got in split_tree(counts, capacity, seed, chunk):
            some = np.flatnonzero(got)
            out.append(np.stack([np.full(len(some), shard[i]), names[some], counts[some], given[some], got[some]]))
            given += got
            rows += len(some)
            if rows > 50_000:
                yield batch(out)
                out, rows = [], 0
        if out:
            yield batch(out)

    def batch(parts: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in np.concatenate(parts, axis=1)],
                                          ["shard", "source_no", "n_blocks", "start", "count"])

    return (both.repartition(shuffle_partitions(spark), "chunk").sortWithinPartitions("chunk", "kind", "who")
            .mapInArrow(members, "shard long, source_no long, n_blocks long, start long, count long"))


def _drawn(quotas: DataFrame, seed: str) -> DataFrame:
    """shard, slot, source_no, block: the blocks of every shard in local order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, rows = None, []
        for b in batches:
            for row in zip(*(b.column(i).to_pylist() for i in range(5))):
                if row[0] != last:
                    if rows:
                        yield shard(last, rows)
                    last, rows = row[0], []
                rows.append(row[1:])
        if rows:
            yield shard(last, rows)

    def shard(number: int, rows: list[tuple]) -> pa.RecordBatch:
        source = np.concatenate([np.full(count, s) for s, _, _, count in rows])
        block = np.concatenate([permuted(np.arange(start, start + count), n, seed, s) for s, n, start, count in rows])
        order = np.random.Generator(np.random.PCG64(_seed("local", seed, number))).permutation(len(block))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(block), number), pa.int64()), pa.array(np.arange(len(block)), pa.int64()),
             pa.array(source[order], pa.int64()), pa.array(block[order], pa.int64())], ["shard", "slot", "source_no", "block"])

    n = shuffle_partitions(quotas.sparkSession)
    return (quotas.repartition(n, "shard").sortWithinPartitions("shard", "source_no")
            .mapInArrow(run, "shard long, slot long, source_no long, block long"))


def mix_documents(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, block_words: int = BLOCK_WORDS,
                  shard_words: int = SHARD_WORDS, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """(rows, pieces) of the mix of ``docs`` (doc_id, text, source).

    ``rows`` has one row per document: doc_id, source, size (words), source_no,
    source_size, target (of its source) and ``at``, its first word's place in
    its source's stream (null without words); (source_no, at) names a document
    with words.  ``pieces`` has what the mix takes: source_no, at, epoch, start
    and length (words of the document), block, first (place in the block), shard and slot (the
    block's place in the shard).

    Null texts have no words and null sources are a source of their own, the
    last one; null doc_ids are documents.  Rows of equal doc_id are documents
    of their own, ordered by size and text hash; for equal rows it does not
    matter which is which.  A table without words has no pieces and targets of
    zero.  Long texts are cut at block borders only.  Other columns are ignored.
    Every draw is seeded by its place, so reruns and recomputed tasks agree.
    """
    spark = docs.sparkSession
    small_batches(spark)
    text = F.col("text").cast("string")
    sized = pin(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long").alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("key"),
        F.xxhash64(text).alias("th"), F.monotonically_increasing_id().alias("row")), "mix-sizes")  # row: spreads equal rows
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumns({
        "last": F.col("source").isNull(), "name": F.coalesce("source", F.lit(""))})  # by code point, null last
    sources = with_row_number(sources, ["last", "name"], "source_no", 0, unique=True).drop("last", "name")
    sources = sources.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("source_no") % len(weights) + 1).cast("int")))
    sources = source_targets(pin(sources, "mix-sources"), most).withColumn(
        "words", F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * most))
    total = sources.agg(F.sum("words").alias("n"), F.count(F.lit(1)).alias("m")).first()
    while (total["n"] or 0) // block_words + total["m"] >= MAX_BLOCKS:
        block_words *= 2
    sources = pin(sources.withColumn("n_blocks", F.ceil(F.col("words") / block_words)), "mix-targets")
    blocks = sources.agg(F.sum("n_blocks").alias("n")).first()["n"] or 0
    shards = max(1, -(-blocks * block_words // shard_words))
    drawn = pin(_drawn(_quotas(sources, blocks, shards, seed), seed), "mix-blocks")

    numbered = _known(sized, sources.select("source", "source_no"))
    stream = running_total(numbered.where("size > 0").drop("source"), ["key", "size", "th", "row"], "size", ["source_no"], "upto")
    stream = pin(stream.select("doc_id", "source_no", "size", (F.col("upto") - F.col("size")).alias("at")), "mix-stream")
    facts = sources.select("source_no", "source", "source_size", "target", "words")
    facts = F.broadcast(facts) if (sources.agg(F.sum(F.coalesce(F.octet_length("source"), F.lit(0)) + 64).alias("b")).first()["b"] or 0) \
        <= SMALL_BYTES else facts.hint("merge")
    known = stream.join(facts, "source_no")
    rest = numbered.where("size = 0").select("doc_id", "source_no", "size", F.lit(None).cast("long").alias("at")).join(facts, "source_no")
    columns = ["doc_id", "source", "size", "source_no", "source_size", "target", "at"]
    rows = known.select(*columns).unionByName(rest.select(*columns))

    epochs = F.ceil((F.col("words") - F.col("at")) / F.col("source_size"))
    copies = known.where("words > at").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), epochs - 1)))
    begin = F.col("epoch") * F.col("source_size") + F.col("at")
    copies = copies.withColumns({"begin": begin, "end": F.least(begin + F.col("size"), F.col("words"))})
    cut = copies.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("begin") / block_words), F.floor((F.col("end") - 1) / block_words))))
    low = F.greatest(F.col("begin"), F.col("block") * block_words)
    high = F.least(F.col("end"), (F.col("block") + 1) * block_words)
    pieces = cut.select("source_no", "at", "epoch", (low - F.col("begin")).alias("start"), (high - low).alias("length"), "block",
                        (low - F.col("block") * block_words).alias("first"))
    return rows, pieces.join(drawn.hint("merge"), ["source_no", "block"])


def op12_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, pieces = mix_documents(documents(spark, sf_dir))
    taken = pieces.groupBy("source_no", "at").agg(F.sum("length").alias("taken"))
    return rows.join(taken, ["source_no", "at"], "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


OP12_SQL = """
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS n, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM d GROUP BY source),
o AS (SELECT row_number() OVER v AS k, 3 * n / w AS r, sum(3 * n) OVER v AS given, sum(w) OVER v AS used
      FROM s WINDOW v AS (ORDER BY 3 * n / w, source ROWS UNBOUNDED PRECEDING)),
l AS (SELECT k, given, used FROM o UNION ALL SELECT 0, 0, 0),
level AS (
  SELECT ((SELECT sum(n) FROM s) - given)::DOUBLE / ((SELECT sum(w) FROM s) - used) AS x
  FROM l WHERE used < (SELECT sum(w) FROM s)
    AND ((SELECT sum(n) FROM s) - given)::DOUBLE / ((SELECT sum(w) FROM s) - used) <= (SELECT r FROM o WHERE o.k = l.k + 1)
  ORDER BY k LIMIT 1),
t AS (SELECT source, n, least(3 * n::DOUBLE, w * coalesce((SELECT x FROM level), 0)) AS target FROM s),
q AS (SELECT d.*, t.n, t.target, floor(t.target + 0.5)::BIGINT AS words,
             sum(size) OVER (PARTITION BY d.source ORDER BY key, size ROWS UNBOUNDED PRECEDING) - size AS pos
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, n AS source_size, target,
       (greatest(0, least(size, words - pos)) + greatest(0, least(size, words - n - pos)) + greatest(0, least(size, words - 2 * n - pos)))::BIGINT AS taken
FROM q
"""
