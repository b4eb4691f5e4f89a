import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

from strata.llm import hard_negatives, mixing, prefix_trie


# 11: hard negatives

def brute_negatives(rows):
    best = {}
    for vec_id, label, vector in rows:
        if vec_id is None or label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        label = math.fmod(label + 1, 10) if vec_id % 7 == 0 else label
        own = (int(label), [math.floor(256 * x) for x in vector])
        best[vec_id] = min(best.get(vec_id, own), own)
    out = set()
    for a, (label, q) in best.items():
        if a % 100:
            continue
        score = sorted((-sum(x * y for x, y in zip(q, v)), i) for i, (_, v) in best.items() if i != a)
        near = [(-s, i) for s, i in score if best[i][0] == label][:5]
        for p, i in near:
            far = [(-s, j) for s, j in score if best[j][0] != label and 80 * p <= 100 * -s <= 100 * p][:5]
            out |= {(a, i, rank, j, p, s) for rank, (s, j) in enumerate(far, 1)}
    return out


SCHEMA = "vec_id long, embedding array<float>, label int, score long, vector string, block string, who string, top int"


def vectors(rows):
    return [(i, v, lab, 0, "x", "x", "x", 0) for i, lab, v in rows]


def test_negatives_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "LEAST_ROWS", 100)
    rng = random.Random(3)
    rows = [(i, rng.randrange(4), [rng.choice((0.0, 0.25, -0.5, rng.gauss(0.2, 0.3))) for _ in range(21)]) for i in range(700)]
    rows += [(800, 1, [float("nan")] * 21), (900, 2, None), (1000, None, [0.5] * 21), (None, 1, [0.5] * 21), (1100, 1, [float("inf")]),
             (1200, 1, [0.1, None]), (1300, 1, [0.5] * 21), (1300, 1, [0.5] * 21), (1300, 0, [0.5] * 20), (1400, 3, []), (-100, 9, [0.5] * 5),
             *[(2001 + i, 2, [0.125] * 21) for i in range(40)]]
    rng.shuffle(rows)
    got = hard_negatives.mine_hard_negatives(spark.createDataFrame(vectors(rows), SCHEMA)).collect()
    assert len(got) == len({tuple(r) for r in got})
    as_float = [(i, lab, None if v is None else [x if x is None else float(np.float32(x)) for x in v]) for i, lab, v in rows]
    assert {tuple(r) for r in got} == brute_negatives(as_float)


def test_no_vectors(spark):
    assert hard_negatives.mine_hard_negatives(spark.createDataFrame([], SCHEMA)).count() == 0
    one = spark.createDataFrame(vectors([(100, 1, [0.5])]), SCHEMA)
    assert hard_negatives.mine_hard_negatives(one).count() == 0


def test_scan_is_exact_and_prunes():
    rng = np.random.default_rng(4)
    raw = (rng.normal(0, 60, (3000, 64)) + np.repeat(rng.normal(0, 60, (30, 64)), 100, 0)).astype(np.int64)
    for scale in (1, 1 << 20):  # doubles, then integers
        rows = raw * scale
        block = hard_negatives.Block(np.arange(3000), np.repeat(np.arange(10), 300), rows)
        seen = []
        real = hard_negatives.kth
        for a in (0, 1234, 2999):
            score = rows @ rows[a]
            same = [i for i in np.lexsort((np.arange(3000), -score)) if i // 300 == a // 300 and i != a][:5]
            ids, got = block.same_label(a, a // 300, rows[a], 5)
            assert ids.tolist() == same and got.tolist() == score[same].tolist()
            highs = score[same]
            lows = -(-4 * highs // 5)
            for (ids, _), lo, hi in zip(block.in_windows(a // 300, rows[a], lows, highs, 5), lows, highs):
                assert ids.tolist() == [i for i in np.lexsort((np.arange(3000), -score)) if i // 300 != a // 300 and lo <= score[i] <= hi][:5]
            block.scan(rows[a], np.arange(3000), lambda least, greatest, alive: (
                seen.append(int(alive.sum())), greatest < real(least, alive, 5))[1])
        assert min(seen) < 1500  # the bitmap shrinks before the last dimension


# 12: mixing

def test_splits_are_exact_and_even():
    counts, capacities = np.array([900, 30, 0, 3070]), np.diff([i * 4000 // 61 for i in range(62)])
    got = dict(mixing.split_tree(counts, capacities, "s"))
    table = np.stack([got[i] for i in range(61)])
    assert (table.sum(axis=0) == counts).all() and (table.sum(axis=1) == capacities).all() and (table >= 0).all()
    assert [x.tolist() for x in got.values()] == [x.tolist() for _, x in mixing.split_tree(counts, capacities, "s")]
    draws = np.array([next(x for i, x in mixing.split_tree(counts, capacities, k) if i == 7) for k in range(400)])
    want = capacities[7] * counts / counts.sum()
    assert (abs(draws.mean(axis=0) - want) < 5 * np.sqrt(want + 0.01) / 20).all() and draws[:, 0].std() > 1


def test_permutation():
    for n in (1, 2, 3, 17, 1000, 4097):
        assert sorted(mixing.permuted(np.arange(n), n, "a", 1).tolist()) == list(range(n))
    assert mixing.permuted(np.arange(500), 500, "a").tolist() != list(range(500))


def brute_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        rest = total - sum(3 * sizes[s] for s in stopped)
        share = {s: rest * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > 3 * sizes[s]}
        if not above:
            return {s: 3.0 * sizes[s] if s in stopped else share[s] for s in names}
        stopped |= above


def check_mix(rows, pieces, block, shard):
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
    target = brute_targets(sizes)
    number = {r["source_no"]: r["source"] for r in rows}
    taken, blocks, by_shard, words = Counter(), {}, defaultdict(set), defaultdict(list)
    for p in pieces:
        taken[p["source_no"], p["at"]] += p["length"]
        assert blocks.setdefault((p["source_no"], p["block"]), (p["shard"], p["slot"])) == (p["shard"], p["slot"])
        by_shard[p["shard"]].add((p["slot"], p["source_no"], p["block"]))
        words[p["source_no"], p["block"]].append((p["first"], p["length"]))
    for spans in words.values():  # a block is filled without gaps
        assert sum(n for _, n in spans) <= block
        assert sorted(spans) == [(sum(n for _, n in sorted(spans)[:i]), n) for i, (_, n) in enumerate(sorted(spans))]
    for s, name in number.items():
        got = sum(n for (no, _), n in taken.items() if no == s)
        assert abs(got - target[name]) <= 0.5 + 1e-6
    for r in rows:
        assert abs(r["target"] - target[r["source"]]) < 1e-6 and r["source_size"] == sizes[r["source"]]
        assert taken[r["source_no"], r["at"]] <= 3 * r["size"]
    counts = [len(x) for x in by_shard.values()]
    assert not counts or max(counts) - min(counts) <= 1 and max(counts) <= max(1, shard // block)
    for x in by_shard.values():
        assert sorted(s for s, _, _ in x) == list(range(len(x)))


def test_mix_of_the_documents(spark, sf, texts):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows, pieces = mixing.mix_documents(docs, block_words=64, shard_words=1024)
    rows, pieces = rows.collect(), [r.asDict() for r in pieces.collect()]
    assert {r["doc_id"]: r["size"] for r in rows} == {i: len((t or "").encode().split()) for i, t in texts.items()}
    check_mix(rows, pieces, 64, 1024)
    again = [r.asDict() for r in mixing.mix_documents(docs.repartition(7), block_words=64, shard_words=1024)[1].collect()]
    key = lambda r: sorted(r.items())
    assert sorted(pieces, key=key) == sorted(again, key=key)


def test_mix_of_many_sources_and_odd_rows(spark, monkeypatch, odd, nothing):
    monkeypatch.setattr(mixing, "CHUNK", 4)  # several chunks of sources
    rng = random.Random(6)
    names = [None, "", "a", "é", "\U0001f600", *(f"s{i}" for i in range(9))]
    rows = [(i, "w " * rng.choice((0, 1, 5, 900)), rng.choice(names), "x") for i in range(300)] + [(7, "w w", "a", "x")] * 3
    out, pieces = mixing.mix_documents(spark.createDataFrame(rows, "doc_id long, text string, source string, block string"),
                                       block_words=16, shard_words=160)
    check_mix(out.collect(), pieces.collect(), 16, 160)
    out, pieces = mixing.mix_documents(odd, block_words=16, shard_words=160)
    assert out.count() == odd.count()
    check_mix(out.collect(), pieces.collect(), 16, 160)
    out, pieces = mixing.mix_documents(nothing)
    assert out.count() == pieces.count() == 0
    out, pieces = mixing.mix_documents(spark.createDataFrame([(1, None, "a"), (2, " ", None)], "doc_id long, text string, source string"))
    assert [(r["size"], r["target"]) for r in out.collect()] == [(0, 0.0)] * 2 and pieces.count() == 0


# 13: prefix trie

def brute_trie(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:2])] for c, ts in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in own:
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt = tuple(own.get(c - int(math.fmod(c, 20)), [])[:h] + own[c][h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append(c)
        ends[rebuilt].append(c)
    children = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, convs in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", s[-1][1])) if s else 0
        for d in range(len(s) + 1):
            leaves[s[:d]] += not children[s]
            saved[s[:d]] += (len(convs) - 1) * words
    return {(min(m), len(s), min(members[s[:-1]]) if s else None, len(m), children[s], leaves[s], saved[s], hashlib.sha256(
        ",".join(map(str, sorted(ends[s]))).encode()).hexdigest()) for s, m in members.items()}


def test_trie_equals_brute_force(spark):
    rng = random.Random(8)
    rows = [(c, t, rng.choice("ua"), "w " * rng.randrange(3)) for c in range(-45, 260) if c not in (40, 60) for t in range(rng.randrange(1, 7))]
    rows += [(1000 + i, t, None if t == 1 else "u", f"step {t}\xa0x") for i in range(60) for t in range(min(i, 30))]  # a chain of paths
    rows += [(2001, t, "u", f"long {t % 3}") for t in range(700)] + [(2101, t, "u", f"long {t % 3}") for t in range(640)]
    rows += [(5, None, "u", None), (6, None, None, "first"), (None, 1, "u", "nobody"), (7, 30, "u", "again"), (7, 30, "u", "again")]
    rng.shuffle(rows)
    extra = [(*r, 0, "x", 1) for r in rows]
    df = spark.createDataFrame(extra, "conv_id long, turn long, role string, text string, depth long, hi string, pid long")
    got = [tuple(r) for r in prefix_trie.prefix_trie(df).collect()]
    assert len(got) == len(set(got))
    ties = {(c, t) for c, t, *_ in rows if c is not None}
    assert len(ties) == sum(c is not None for c, *_ in rows) - 1  # only the repeated row
    assert set(got) == brute_trie(rows)


def test_trie_of_nothing_and_of_collisions(spark, monkeypatch):
    schema = "conv_id long, turn long, role string, text string"
    assert prefix_trie.prefix_trie(spark.createDataFrame([], schema)).count() == 0
    rows = [(c, t, "u", f"{c % 3} {t}") for c in range(8) for t in range(4)]
    calls, real = [], prefix_trie._collides
    monkeypatch.setattr(prefix_trie, "_collides", lambda h: calls.append(1) or len(calls) == 1 or real(h))
    got = {tuple(r) for r in prefix_trie.prefix_trie(spark.createDataFrame(rows, schema)).collect()}
    assert len(calls) == 2 and got == brute_trie(rows)
    weak = spark.createDataFrame([(1, 1, "a", "b"), (1, 2, "a", "c")], schema).selectExpr("*", "1L hi", "1L lo")
    assert real(weak)
    # equal fingerprints of unequal sequences are seen
    twin = spark.createDataFrame([(1, 1, 5, 5, 5, 0, 0, 0, 7, 7, 1, True), (2, 1, 5, 5, 5, 0, 0, 0, 8, 7, 1, True)],
                                 "conv_id long, depth long, f1 long, f2 long, f3 long, p1 long, p2 long, p3 long, hi long, lo long, words long, is_end boolean")
    assert not prefix_trie._nodes(twin).first()["equal"]


def test_equal_rows_are_spread(spark):
    """A third of all rows that are equal in every column does not meet in one range."""
    docs = spark.range(3000).selectExpr("if(id < 1200, 7L, id) as doc_id", "if(id < 1200, 'same words here', concat('w ', id)) as text", "'s' as source")
    rows, pieces = mixing.mix_documents(docs, block_words=64, shard_words=640)
    check_mix(rows.collect(), pieces.collect(), 64, 640)
    turns = spark.range(900).selectExpr("if(id < 600, 41L, id) as conv_id", "if(id < 600, null, id) as turn", "'u' as role", "if(id < 600, 'same', 'x') as text")
    stored = prefix_trie.stored_prefixes(prefix_trie._hashed(prefix_trie._turns(turns), 0), 0)
    place = stored.where("conv_id = 41").collect()
    assert sorted(r["pos"] for r in place) == list(range(1, 601)) and len({r["f1"] for r in place}) == 600
    got = {tuple(r) for r in prefix_trie.prefix_trie(turns).collect()}
    assert got == brute_trie([tuple(r) for r in turns.collect()])
