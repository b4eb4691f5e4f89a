"""Prefix trie of rebuilt conversations (op 13).

Every conversation is rebuilt from the first turns of its base conversation
and its own later turns.  No rebuilt text is ever made:

1. A turn becomes a 128-bit content hash and three residues.  Prefixes are
   products in the monoid of pairs (value, power) with
   ``(a, p) * (b, q) = (a + p b, p q)`` modulo a prime, three bases wide.  The
   prefix products of the stored turns come from one distributed scan.
2. A rebuilt prefix is the base's head product times the conversation's own
   suffix product; the suffix is the own prefix with its head divided out.  So
   every (conversation, depth) gets its fingerprint from a few stored numbers.
3. Prefixes group by (depth, fingerprint) into nodes.  A group is verified by
   its stored turns: all members must refer to the same content of the last turn
   and to one parent group, which makes their sequences equal by induction;
   content hashes are verified against the texts of all stored turns.  If
   either should fail, everything is done again with other bases or hashes.
4. A node is named by its smallest member.  The nodes named by one
   conversation are a path, so the trie falls into paths that hang from one
   another.  Totals of whole paths are summed up by pointer doubling (as many
   rounds as the logarithm of the tree of paths is high), sums below each node
   of a path by a distributed scan of the path.

Members' ids are hashed in a stream: ids of one value range become a chunk of
text, and a task reads the chunks of a node in order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import pin, shuffle_partitions, small_batches

#: The prime of the residues; the bases of an attempt are taken from its number.
P = 2 ** 31 - 1
LANES = (1, 2, 3)
#: Attempts with other hashes and bases before giving up.
ATTEMPTS = 4
#: Ids of one range of so many values make a chunk of text.
ID_RANGE = 8192
GROUP, HEAD = 20, 4
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def _base(attempt: int, lane: int) -> int:
    return int.from_bytes(hashlib.sha256(f"base {attempt} {lane}".encode()).digest()[:4]) % (P - 1000) + 500


def _mul(a: Column, b: Column) -> Column:
    return F.pmod(a * b, F.lit(P))


def _table(values: list[int]) -> Column:
    return F.expr(f"array({', '.join(f'{v}L' for v in values)})")


def _power(base: int, exponent: Column) -> Column:
    """base ** exponent modulo P for 0 <= exponent < 2 ** 32: one table look-up a byte."""
    out = None
    for byte in range(4):
        step = pow(base, 1 << (8 * byte), P)
        table = _table([pow(step, i, P) for i in range(256)])
        at = (F.shiftright(exponent.cast("long"), 8 * byte).bitwiseAND(F.lit(255)) + 1).cast("int")
        out = F.element_at(table, at) if out is None else _mul(out, F.element_at(table, at))
    return out


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of the turns that belong to a conversation."""
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))


def _hashed(turns: DataFrame, attempt: int) -> DataFrame:
    return turns.select(
        "conv_id", "turn", "role", "text",
        F.xxhash64(F.lit(attempt), "role", "text").alias("hi"), F.xxhash64("text", F.lit(attempt), "role").alias("lo"))


def _collides(hashed: DataFrame) -> bool:
    """Whether one content hash stands for two contents among the stored turns."""
    ends = hashed.groupBy("hi", "lo").agg(*[f(c).alias(f"{f.__name__}_{c}") for c in ("role", "text") for f in (F.min, F.max)])
    return not ends.where("min_role <> max_role or min_text <> max_text").isEmpty()


def stored_prefixes(hashed: DataFrame, attempt: int) -> DataFrame:
    """conv_id, pos (from 1), hi, lo, words and per lane the turn's factor c
    (its residue times the power of its place) and the prefix product f.

    One range shuffle in conversation order (a long conversation is split over
    tasks); slices are scanned by themselves and multiplied with the product of
    the slices before them.
    """
    # written without the texts: finding the ranges reads the rows a second time
    rows = pin(hashed.select("conv_id", "turn", "hi", "lo", F.regexp_count("text", F.lit(WORDS)).cast("long").alias("words"),
                             F.monotonically_increasing_id().alias("row")), "trie-rows")
    # row: equal turns, whose order does not matter, are spread over ranges
    order = [F.col("turn").asc_nulls_first(), F.col("hi"), F.col("lo"), F.col("row")]
    ranged = (rows.repartitionByRange(shuffle_partitions(hashed.sparkSession), "conv_id", *order)
              .withColumn("pid", F.spark_partition_id()))
    slice_ = Window.partitionBy("pid", "conv_id").orderBy(*order)
    upto = slice_.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = ranged.withColumn("at", F.row_number().over(slice_).cast("long"))
    for i in LANES:
        residue = F.pmod(F.xxhash64("hi", "lo", F.lit(i)), F.lit(P))
        local = local.withColumn(f"c{i}", _mul(residue, _power(_base(attempt, i), F.col("at"))))
    local = pin(local.select("*", *[F.pmod(F.sum(f"c{i}").over(upto), F.lit(P)).alias(f"f{i}") for i in LANES]), "trie-scan")
    slices = local.groupBy("pid", "conv_id").agg(
        F.max("at").alias("n"), *[F.pmod(F.sum(f"c{i}"), F.lit(P)).alias(f"s{i}") for i in LANES])
    before = Window.partitionBy("conv_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("n0", F.coalesce(F.sum("n").over(before), F.lit(0)))
    for i in LANES:
        slices = slices.withColumn(f"p{i}", _power(_base(attempt, i), F.col("n0")))
    slices = pin(slices.select("pid", "conv_id", "n0", *[f"p{i}" for i in LANES], *[
        F.pmod(F.coalesce(F.sum(_mul(F.col(f"p{i}"), F.col(f"s{i}"))).over(before), F.lit(0)), F.lit(P)).alias(f"o{i}")
        for i in LANES]), "trie-slices")
    out = local.join(slices.hint("merge"), ["pid", "conv_id"])
    return out.select(
        "conv_id", (F.col("n0") + F.col("at")).alias("pos"), "hi", "lo", "words",
        *[_mul(F.col(f"p{i}"), F.col(f"c{i}")).alias(f"c{i}") for i in LANES],
        *[F.pmod(F.col(f"o{i}") + _mul(F.col(f"p{i}"), F.col(f"f{i}")), F.lit(P)).alias(f"f{i}") for i in LANES])


def rebuild_plan(stored: DataFrame) -> DataFrame:
    """conv_id, h, k (turns taken of the base), length (rebuilt), heads (of the
    base) and per lane the own head's product ``own`` and the base's ``top``."""
    head = F.struct("pos", "hi", "lo", "words", *[f"c{i}" for i in LANES], *[f"f{i}" for i in LANES])
    convs = pin(stored.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.sort_array(F.collect_list(F.when(F.col("pos") < HEAD, head))).alias("heads")), "trie-convs")
    base = convs.select(F.col("conv_id").alias("b"), F.col("n").alias("n_b"), F.col("heads").alias("heads_b"))
    h = F.crc32(F.col("conv_id").cast("string")) % HEAD
    plan = convs.select("*", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("b")).join(base, "b", "left")
    plan = plan.withColumn("k", F.least("h", F.coalesce("n_b", F.lit(0))))

    def product(heads: str, at: str, lane: int) -> Column:
        return F.coalesce(F.when(F.col(at) > 0, F.try_element_at(F.col(heads), F.col(at).cast("int"))[f"f{lane}"]), F.lit(0))

    return plan.select(
        "conv_id", "h", "k", (F.col("k") + F.greatest(F.lit(0), F.col("n") - F.col("h"))).alias("length"),
        F.slice(F.coalesce("heads_b", F.array().cast(convs.schema["heads"].dataType)), F.lit(1), F.col("k").cast("int")).alias("heads"),
        *[product("heads", "h", i).alias(f"own{i}") for i in LANES], *[product("heads_b", "k", i).alias(f"top{i}") for i in LANES])


def rebuilt_prefixes(stored: DataFrame, plan: DataFrame, attempt: int) -> DataFrame:
    """conv_id, depth, f (fingerprint), p (its parent's), hi, lo, words, is_end
    for every prefix of every rebuilt conversation of at least one turn."""
    out = ["conv_id", "depth", *[f"f{i}" for i in LANES], *[f"p{i}" for i in LANES], "hi", "lo", "words", "is_end"]
    parent = [F.pmod(F.col(f"f{i}") - F.col(f"c{i}"), F.lit(P)).alias(f"p{i}") for i in LANES]
    heads = plan.select("conv_id", "length", F.explode("heads").alias("t")).select("conv_id", "length", "t.*").select(
        "*", F.col("pos").alias("depth"), *parent).withColumn("is_end", F.col("depth") == F.col("length"))
    own = stored.join(plan.drop("heads").hint("merge"), "conv_id").where("pos > h").withColumn(
        "depth", F.col("pos") - F.col("h") + F.col("k"))
    for i in LANES:
        back = pow(_base(attempt, i), -1, P)
        shift = F.element_at(_table([pow(back, d, P) for d in range(HEAD)]), (F.col("h") - F.col("k") + 1).cast("int"))
        own = own.withColumn(f"c{i}", _mul(F.col(f"c{i}"), shift)).withColumn(f"f{i}", F.pmod(
            F.col(f"top{i}") + _mul(F.pmod(F.col(f"f{i}") - F.col(f"own{i}"), F.lit(P)), shift), F.lit(P)))
    own = own.select("*", *parent).withColumn("is_end", F.col("depth") == F.col("length"))
    return heads.select(*out).unionByName(own.select(*out))


def _nodes(prefixes: DataFrame) -> DataFrame:
    same = ["hi", "lo", *[f"p{i}" for i in LANES]]
    return prefixes.groupBy("depth", *[f"f{i}" for i in LANES]).agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), F.max("words").alias("words"),
        *[F.min(c).alias(c) for c in same], *[F.max(c).alias(f"{c}_max") for c in same]) \
        .withColumn("equal", F.expr(" and ".join(f"{c} = {c}_max" for c in same))).drop(*[f"{c}_max" for c in same], "hi", "lo")


def _ends(ends: DataFrame, key: list[str]) -> DataFrame:
    """key, ends_sha256: the hash of the comma-joined ids of each key in numeric order."""
    spark = ends.sparkSession
    chunks = ends.groupBy(*key, F.floor(F.col("conv_id") / ID_RANGE).alias("part")).agg(
        F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for b in batches:
            done = []
            for *at, ids in zip(*(b.column(i).to_pylist() for i in (*range(len(key)), len(key) + 1))):
                if at != last:
                    if last is not None:
                        done.append((*last, state.hexdigest()))
                    last, state = at, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            yield _batch(done)
        yield _batch([] if last is None else [(*last, state.hexdigest())])

    def _batch(rows: list) -> pa.RecordBatch:
        cols = list(zip(*rows)) or [[]] * (len(key) + 1)
        return pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in cols[:-1]], pa.array(cols[-1], pa.string())],
                                          [*key, "ends_sha256"])

    return (chunks.repartition(shuffle_partitions(spark), *key).sortWithinPartitions(*key, "part")
            .mapInArrow(digest, ", ".join(f"{k} long" for k in key) + ", ends_sha256 string"))


def _suffix_sums(df: DataFrame, segment: str, order: str, sums: Sequence[str]) -> DataFrame:
    """``df`` with each of ``sums`` added up over this and all larger ``order``
    of its segment; segments are split over range partitions."""
    ranged = (df.repartitionByRange(shuffle_partitions(df.sparkSession), F.col(segment), F.col(order).desc())
              .withColumn("pid", F.spark_partition_id()))
    upto = Window.partitionBy("pid", segment).orderBy(F.col(order).desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = pin(ranged.select("*", *[F.sum(c).over(upto).alias(f"{c}_to") for c in sums]), "trie-sums")
    before = Window.partitionBy(segment).orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = local.groupBy("pid", segment).agg(*[F.sum(c).alias(c) for c in sums])
    offsets = pin(slices.select("pid", segment, *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_off") for c in sums]),
                  "trie-offsets")
    out = local.join(offsets.hint("merge"), ["pid", segment])
    return out.select(*[(F.col(f"{c}_to") + F.col(f"{c}_off")).alias(c) if c in sums else c for c in df.columns])


def path_totals(paths: DataFrame, root: int, sums: Sequence[str]) -> DataFrame:
    """``paths`` (conv_id, up: the conversation whose path this one hangs from,
    null for the root's, and ``sums``) with the sums of all paths below added.

    Pointer doubling: after round r a path holds the sums of the paths less
    than 2 ** r above which it hangs; paths that point to the root are done
    after adding themselves to it.
    """
    now = pin(paths.select("conv_id", "up", *sums), "trie-paths")
    while not now.where("up is not null").isEmpty():
        given = now.where("up is not null").groupBy("up").agg(*[F.sum(c).alias(f"{c}_add") for c in sums])
        given = pin(given.withColumnRenamed("up", "conv_id"), "trie-given")
        ups = now.where(F.col("up").isNotNull() & (F.col("up") != root)).select("conv_id", "up")
        ups = pin(ups.join(now.select(F.col("conv_id").alias("up"), F.col("up").alias("next")).hint("merge"), "up")
                  .select("conv_id", "next"), "trie-ups")
        now = pin(now.join(given.hint("merge"), "conv_id", "left").join(ups.hint("merge"), "conv_id", "left").select(
            "conv_id", F.col("next").alias("up"), *[(F.col(c) + F.coalesce(f"{c}_add", F.lit(0))).alias(c) for c in sums]), "trie-paths")
    return now.drop("up")


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per node of the trie of rebuilt conversations: conv_id (smallest
    member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256.

    ``conversations`` has conv_id, turn, role and text; other columns are
    ignored, whatever their names.  Rows without a conv_id belong to no
    conversation; a null turn comes first; a null role or text is empty.
    Turns of one number are ordered by their content hash, so repeated rows are
    turns of their own and their order does not matter.  The base of
    conversation c is ``c - c % 20`` with SQL's remainder (its sign is that of
    c).  An empty table has no conversation and gives no node, not even a
    root; texts of any length are hashed and counted as a whole.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    turns = _turns(conversations)
    for attempt in range(ATTEMPTS):
        hashed = _hashed(turns, attempt)
        stored = pin(stored_prefixes(hashed, attempt), "trie-turns")
        plan = pin(rebuild_plan(stored), "trie-plan")
        prefixes = pin(rebuilt_prefixes(stored, plan, attempt), "trie-prefixes")
        nodes = pin(_nodes(prefixes), "trie-nodes")
        if nodes.where("not equal").isEmpty() and not _collides(hashed):
            break
    else:
        raise RuntimeError("content hashes or fingerprints collided in every attempt")
    key = ["depth", *[f"f{i}" for i in LANES]]
    row = plan.agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("c")).first()
    root = spark.createDataFrame([(0, 0, 0, 0, row["c"], row["n"], 0)] if row["n"] else [],
                                 ", ".join(f"{k} long" for k in key) + ", conv_id long, n_convs long, words long")
    zero = [F.lit(0).cast("long").alias(k) for k in key]
    ends = _ends(prefixes.where("is_end").select(*key, "conv_id").unionByName(
        plan.where("length = 0").select(*zero, "conv_id")), key)
    top = row["c"] if row["n"] else 0
    full = nodes.drop("equal").unionByName(root, allowMissingColumns=True)

    # where each path hangs
    span = full.groupBy("conv_id").agg(F.min("depth").alias("first"), F.max("depth").alias("last"))
    full = pin(full.join(pin(span, "trie-span").hint("merge"), "conv_id"), "trie-full")
    tops = full.where("depth = first and depth > 0").select("conv_id", (F.col("depth") - 1).alias("depth"), *[f"p{i}" for i in LANES])
    owners = full.select(F.col("conv_id").alias("up"), "depth", *[F.col(f"f{i}").alias(f"p{i}") for i in LANES])
    hangs = pin(tops.where("depth > 0").join(owners.hint("merge"), ["depth", *[f"p{i}" for i in LANES]])
                .select("conv_id", "up", "depth")
                .unionByName(tops.where("depth = 0").select("conv_id", F.lit(top).cast("long").alias("up"), "depth")), "trie-hangs")

    # each node's own values, each path's totals, sums below each node
    below = hangs.groupBy(F.col("up").alias("conv_id"), "depth").agg(F.count(F.lit(1)).alias("hung"))
    own = pin(full.join(pin(below, "trie-below").hint("merge"), ["conv_id", "depth"], "left").select(
        *key, "conv_id", "n_convs", "first", (F.coalesce("hung", F.lit(0)) + (F.col("depth") < F.col("last")).cast("long")).alias("n_children"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved_tokens"))
        .withColumn("n_leaves", (F.col("n_children") == 0).cast("long")), "trie-own")
    sums = ["n_leaves", "saved_tokens"]
    paths = own.groupBy("conv_id").agg(*[F.sum(c).alias(c) for c in sums]).join(hangs.select("conv_id", "up"), "conv_id", "left")
    totals = path_totals(paths, top, sums)
    hung = pin(hangs.join(totals.hint("merge"), "conv_id").groupBy(F.col("up").alias("conv_id"), "depth")
               .agg(*[F.sum(c).alias(f"{c}_hung") for c in sums]), "trie-hung")
    value = own.join(hung.hint("merge"), ["conv_id", "depth"], "left").select(
        *[(F.col(c) + F.coalesce(f"{c}_hung", F.lit(0))).alias(c) if c in sums else F.col(c) for c in own.columns])
    summed = _suffix_sums(value, "conv_id", "depth", sums)
    ups = hangs.select("conv_id", "up")
    return (summed.join(ends, key, "left").join(ups, "conv_id", "left")
            .select("conv_id", "depth", F.when(F.col("depth") > 0, F.when(F.col("depth") == F.col("first"), F.col("up"))
                                               .otherwise(F.col("conv_id"))).alias("parent_conv_id"),
                    "n_convs", "n_children", "n_leaves", "saved_tokens",
                    F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256")))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


#: Remainders of the cyclic redundancy check by half-byte (fixed values).
_CRC = [0x00000000, 0x1DB71064, 0x3B6E20C8, 0x26D930AC, 0x76DC4190, 0x6B6B51F4, 0x4DB26158, 0x5005713C,
        0xEDB88320, 0xF00F9344, 0xD6D6A3E8, 0xCB61B38C, 0x9B64C2B0, 0x86D3D2D4, 0xA00AE278, 0xBDBDF21C]

OP13_SQL = f"""
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) p,
         coalesce(role, '') role, coalesce(text, '') AS txt
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT *, dense_rank() OVER (ORDER BY role, txt) AS turn_id FROM t),
n AS (SELECT conv_id, count(*) AS len FROM t GROUP BY 1),
crc AS (
  SELECT conv_id, len, conv_id - conv_id % 20 AS b, xor(list_reduce(list_concat([4294967295], flatten(list_transform(
           range(1, length(conv_id::VARCHAR) + 1), lambda i: [ascii(substr(conv_id::VARCHAR, i, 1)) & 15, ascii(substr(conv_id::VARCHAR, i, 1)) >> 4]))),
         lambda a, x: xor(a >> 4, list_extract({_CRC}, (xor(a, x) & 15) + 1))), 4294967295) % 4 AS h
  FROM n),
k AS (SELECT crc.conv_id, crc.b, crc.h, least(crc.h, coalesce(m.len, 0)) AS k,
             least(crc.h, coalesce(m.len, 0)) + greatest(0, crc.len - crc.h) AS len
      FROM crc LEFT JOIN n m ON m.conv_id = crc.b),
e AS (
  SELECT k.conv_id, ids.p AS depth, turn_id, txt, k.len FROM k JOIN ids ON ids.conv_id = k.b AND ids.p <= k.k
  UNION ALL
  SELECT k.conv_id, ids.p - k.h + k.k, turn_id, txt, k.len FROM k JOIN ids ON ids.conv_id = k.conv_id AND ids.p > k.h),
s AS (
  SELECT conv_id, depth, list(turn_id) OVER (PARTITION BY conv_id ORDER BY depth) AS seq,
         len(regexp_extract_all(txt, '[^\\x20\\x09-\\x0D]+')) AS words, depth = len AS is_end
  FROM e
  UNION ALL SELECT conv_id, 0, [], 0, len = 0 FROM k),
v AS (
  SELECT seq, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (is_end), '')) AS ends_sha256
  FROM s GROUP BY seq),
c AS (SELECT a.seq, b.conv_id AS parent_conv_id, (SELECT count(*) FROM v d WHERE d.depth = a.depth + 1 AND d.seq[1:a.depth] = a.seq) AS n_children
      FROM v a LEFT JOIN v b ON a.depth > 0 AND b.seq = a.seq[1:a.depth - 1])
SELECT v.conv_id, v.depth, c.parent_conv_id, v.n_convs, c.n_children,
       (SELECT count(*) FROM v w JOIN c x ON x.seq = w.seq WHERE x.n_children = 0 AND w.seq[1:v.depth] = v.seq) AS n_leaves,
       (SELECT sum((w.n_convs - 1) * w.words)::BIGINT FROM v w WHERE w.seq[1:v.depth] = v.seq) AS saved_tokens,
       v.ends_sha256
FROM v JOIN c ON c.seq = v.seq
"""
