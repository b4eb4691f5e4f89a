import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from strata.llm import jaccard_join, packing, piece_encoding, quality, suffix_dedup, toxicity
from strata.llm.html_extraction import extract, extract_pages, misplaced, nesting, op4_html_extraction


# 1: substrings

def brute_removed(texts, window):
    raws = [(t or "").encode() for t in texts]
    count = Counter(r[i:i + window] for r in raws for i in range(len(r) - window + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r), bool)
        for i in range(len(r) - window + 1):
            if count[r[i:i + window]] > 1:
                gone[i:i + window] = True
        edge = np.diff(np.concatenate(([0], gone.astype(int))))
        out.append((len(r), int(gone.sum()), int((edge == 1).sum()), hashlib.sha256(
            bytes(np.frombuffer(r, np.uint8)[~gone])).hexdigest()))
    return out


def test_substrings_equal_brute_force(spark, sf, texts):
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])
           for r in suffix_dedup.op1_suffix_dedup(spark, sf).collect()}
    assert got == dict(zip(texts, brute_removed(texts.values(), 200)))


def test_salts_are_even():
    for step, salts in ((1, 31), (1, 62), (31, 10), (64, 64)):
        count = Counter(suffix_dedup.salt_of(i * step, 0, 0, salts) for i in range(500 * salts))
        assert len(count) == salts and max(count.values()) < 650


@pytest.mark.parametrize("salt", [2000, 3])
def test_shared_passages_under_salt(spark, monkeypatch, salt):
    monkeypatch.setattr(suffix_dedup, "SALT_ROWS", salt)
    rng = random.Random(5)
    word = lambda n: "".join(rng.choices("abcdefgh ", k=n))
    passage = word(700)
    docs = [word(rng.randint(0, 150)) + passage[rng.randint(0, 200):rng.randint(350, 700)] + word(rng.randint(0, 150))
            for _ in range(25)] + ["ab" * 300, "x" * 250, word(90), "", None, passage, passage]
    rows = [(i, t) for i, t in enumerate(docs)]
    out = suffix_dedup.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], hashlib.sha256(r["kept"]).hexdigest()) for r in out.collect()}
    assert got == dict(zip(range(len(docs)), brute_removed(docs, 200)))


def test_suffix_order_survives_hash_collisions(monkeypatch):
    rng = np.random.default_rng(1)
    rows = rng.integers(97, 99, (60, 30)).astype(np.uint8)
    size = rng.integers(0, 31, 60)
    rows[np.arange(30)[None, :] >= size[:, None]] = 0
    group = np.sort(rng.integers(0, 5, 60))
    want = sorted(range(60), key=lambda i: (group[i], rows[i, :size[i]].tobytes()))
    key = lambda o: [(group[i], rows[i, :size[i]].tobytes()) for i in o]
    order, lcp = suffix_dedup.suffix_order(rows, size, group)
    assert key(order) == key(want)
    monkeypatch.setattr(suffix_dedup, "_prefix_hashes", lambda r: np.zeros((len(r), r.shape[1] + 1), np.uint64))
    order2, lcp2 = suffix_dedup.suffix_order(rows, size, group)
    assert key(order2) == key(want) and (lcp2 == lcp).all()


def test_substrings_odd_rows(spark, odd, odd_rows, nothing):
    out = suffix_dedup.dedup_substrings(odd)
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"]) for r in out.collect()), key=str)
    assert len(got) == len(odd_rows)
    by = {(d, n): k for d, n, k, _ in got}
    assert by[(5, 108000)] == by[(6, 108000)] == 108000 and by[(11, 700)] == 700 and by[(1, 0)] == 0
    assert suffix_dedup.dedup_substrings(nothing).count() == 0


# 2: packing

def check_packing(rows, texts_by_key, window=2048):
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    tok = packing._tokenizer(packing.default_tokenizer())
    for d, t in texts_by_key.items():
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            assert r["ids_crc32"] == zlib.crc32(ids[at:at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for seq in by_seq.values():
        at = 0
        for r in sorted(seq, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert 0 < at <= window
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding


def test_packing_of_the_documents(spark, sf, texts):
    assert check_packing(packing.op2_packing(spark, sf).collect(), texts) == 0


def test_best_subset_is_the_best_one():
    rng = random.Random(3)
    for _ in range(200):
        counts = {rng.randint(1, 40): rng.randint(1, 3) for _ in range(rng.randint(1, 6))}
        cap = rng.randint(0, 90)
        sums = {0}
        for length, k in counts.items():
            sums = {s + length * j for s in sums for j in range(k + 1)}
        chosen = packing.best_subset(counts, cap)
        assert all(v <= counts[k] for k, v in chosen.items())
        assert sum(k * v for k, v in chosen.items()) == max(s for s in sums if s <= cap)


def test_plans_place_every_item_once():
    rng = random.Random(4)
    for counts in ({1500: 1000}, {1025: 7}, {2047: 3}, {1: 5}, {rng.randint(1, 2047): rng.randint(1, 50) for _ in range(80)}):
        records, n_seq, _ = packing.plan_windows(dict(counts))
        starts = {k: [r[0] for r in v] for k, v in records.items()}
        cells = defaultdict(list)
        for length, k in counts.items():
            for rank in range(k):
                at = 0
                for start, n, s, off in packing.place(records, starts, length, rank):
                    assert start == at and 0 <= s < n_seq
                    at += n
                    cells[s].append((off, n))
                assert at == length
        for parts in cells.values():
            at = 0
            for off, n in sorted(parts):
                assert off == at
                at += n
            assert at == 2048 or at & (at - 1) == 0


def test_fast_encoder_equals_the_tokenizer():
    path = packing.default_tokenizer()
    tok = packing._tokenizer(path)
    for t in ["", " a  b\n\n c", "It's   12ab\t\r\n x ", "é\xa0ü <|endoftext|> z", "日本 x y", "don't 'll  ", "\n \n  a"]:
        assert packing.encode(t, path).tolist() == tok.encode(t, add_special_tokens=False).ids + [1]


def test_packing_odd_rows(spark, odd, odd_rows, nothing):
    out = packing.pack(odd).collect()
    assert sum(r["length"] for r in out) == sum(len(packing.encode(r[1], packing.default_tokenizer())) for r in odd_rows)
    assert packing.pack(nothing).count() == 0


# 3: quality

def brute_stats(t):
    t = t or ""
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", t) if w]
    grams = Counter(zip(words, words[1:], words[2:]))
    hit = [False] * len(words)
    for i in range(len(words) - 2):
        if grams[tuple(words[i:i + 3])] > 1:
            hit[i:i + 3] = [True] * 3
    seen, dup = set(), 0
    for x in t.split("\n"):
        if x.strip(" \t\n\x0b\x0c\r"):
            dup += x in seen
            seen.add(x)
    return [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), dup, sum(hit)]


def test_rule_statistics(texts):
    for t in [*texts.values(), None, "", "a b a b a b", "x\n\nx\n x", "é " * 60, "a\x1cb c d"]:
        assert quality.rule_stats(t)[:5] == brute_stats(t)


def test_quality_rules_keep_the_clean_and_drop_the_junk(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in quality.op3_quality_rules(spark, folder).collect()}
    label = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{folder}/labels.parquet'").fetchall())
    judged = [(label[d], r["kept"]) for d, r in got.items() if d in label and not r["base_failed"]]
    good = [k for q, k in judged if q == 1]
    assert sum(good) > 0.97 * len(good)
    bad = [k for q, k in judged if q == 0]
    assert sum(bad) < 0.1 * len(bad)
    for r in got.values():
        assert not (r["base_failed"] and r["kept"])
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])


def brute_path(tree, x):
    feature, cut, child, length = tree
    at = 0
    while feature[at] >= 0:
        at = int(child[at]) + int(x[int(feature[at])] >= cut[at])
    return length[at]


def test_forest_scores_equal_single_walks():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(200, 8))
    model = quality.grow_forest(x[:150], x[150:], trees=10, draw=32)
    want = [2.0 ** (-np.mean([brute_path(t, r) for t in model[0]]) / model[2]) for r in x]
    assert np.allclose(quality.anomaly(x, model), want)
    far = quality.anomaly(np.vstack([x, np.full((1, 8), 9.0)]), model)
    assert far[-1] > np.median(far[:-1])


def test_every_labelled_row_counts(spark):
    """8,100 clean rows come first in the order of hashed ids, all junk after
    them; the fit sees both, and equals one in memory over all rows."""
    ids = [r["id"] for r in spark.range(8600).orderBy(F.xxhash64("id"), "id").collect()]
    rng = np.random.default_rng(4)
    rows, labels = [], []
    for n, i in enumerate(ids):
        junk = n >= 8100
        words = ["".join(map(chr, rng.integers(97, 123, rng.integers(3, 9)))) for _ in range(60)]
        for k in rng.choice(60, int(rng.integers(8, 16)) if junk else int(rng.integers(0, 4)), replace=False):
            words[k] = "#" + words[k]
        rows.append((i, " ".join(words)))
        labels.append((i, int(not junk)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = quality.judge_quality(docs, spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    label = dict(labels)
    kept = {q: [r["kept"] for r in out if label[r["doc_id"]] == q and not r["base_failed"]] for q in (0, 1)}
    assert sum(kept[1]) > 0.97 * len(kept[1]) and sum(kept[0]) < 0.2 * len(kept[0])

    good, bad = (np.array([r["anomaly"] for r in out if label[r["doc_id"]] == q]) for q in (1, 0))
    cuts = np.unique(np.concatenate([good, bad]))
    cuts = cuts[cuts >= np.sort(good)[int(np.ceil(0.99 * (len(good) - 1)))]]
    gain = [(bad > c).mean() - 3 * (good > c).mean() for c in cuts]
    assert max(r["anomaly"] for r in out if r["kept"]) == cuts[int(np.argmax(np.round(gain, 12)))]

    rows = spark.createDataFrame([(*quality.rule_stats(t), label[i]) for i, t in rows], ", ".join(f"{c} long" for c in [*quality.STATS, "_q"]))
    table = np.array([tuple(r) for r in rows.collect()])
    x, q = quality.rule_features(table[:, :-1]), table[:, -1]
    auc = [((x[q == 1, f][None] < x[q == 0, f][:, None]).mean() + (x[q == 1, f][None] <= x[q == 0, f][:, None]).mean()) / 2 for f in range(8)]
    assert np.allclose(quality.rule_weights(rows.withColumn("_q", F.col("_q").cast("int"))), quality.split_weights(np.array(auc)))


def test_quality_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(5, 1), (None, 1), (3, None)], "doc_id long, quality int")
    out = quality.judge_quality(odd, labels)
    assert out.count() == odd.count() and out.where("kept and n_words < 50").count() == 0
    assert quality.judge_quality(nothing, labels.limit(0)).count() == 0


# 4: html

PAGE = ("<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li>Menu</ul></nav>"
        "<div class='cookie-notice'>We use</div><article class='post'><header><h1>Head &amp; line</h1></header>"
        "<script>var a='</p>';</script><p>One <b>two</b>\n three.<br>Four &lt;p&gt; five<div class=\"ad\">Buy</div>"
        "<p>Six <a href='x?a>b'>seven</a><form><input>Mail</form><section class=comments>Nice</section></article>"
        "<aside>Side</aside><!-- no > <p>hidden</p> --><footer>&copy; x</footer></body>")


def test_extract():
    want = "Head & line\nOne two three.\nFour <p> five\nSix seven"
    assert extract(PAGE) == want
    assert extract(PAGE[:PAGE.index("<aside>")]) == want
    assert [extract(None), extract(""), extract("<p>"), extract("plain"), extract("<p>a<p>b")] == ["", "", "", "plain", "a\nb"]
    assert extract("<article><p>" + "w " * 100_000) == ("w " * 100_000).strip()


def test_template_text_is_left_out(spark):
    page = "<body><div>Welcome to us</div><div class=x><p>{}</p><p>{}</p></div><div>Call now</div></body>"
    rows = [(i, f"http://h.example/{i}", page.format(f"alpha {i}", f"beta {i * i}")) for i in range(8)]
    rows += [(50, None, None), (51, "nonsense", "<p>x"), (51, "nonsense", "<p>x")]
    out = extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string"))
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in out.collect()}
    assert out.count() == len(rows)
    assert all(got[i][0] == f"alpha {i}\nbeta {i * i}" for i in range(8)) and got[50] == ("", 0) and got[51] == ("x", 1)
    assert extract_pages(spark.createDataFrame([], "page_id long, url string, html string, text string")).count() == 0


def texts_of_pages(spark, pages):
    rows = [(i, f"http://h.example/{i}", p) for i, p in enumerate(pages)]
    return {r["page_id"]: r["text"] for r in extract_pages(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}


def test_copies_of_a_page_are_no_template(spark):
    page = "<html><body><h1>A {0}</h1><div class=x><p>First of {0}.</p><p>Second of {0}.</p></div></body></html>"
    want = "A {0}\nFirst of {0}.\nSecond of {0}."
    assert set(texts_of_pages(spark, [page.format("one")] * 6).values()) == {want.format("one")}
    names = ["one"] * 5 + ["two", "three"]  # copies are most of the pages, on a tag path of their own
    pages = [page.format(n).replace("class=x", "class=y" if n == "one" else "class=x") for n in names]
    assert list(texts_of_pages(spark, pages).values()) == [want.format(n) for n in names]
    notes = [f"<body><!-- {i} --><nav>{i}</nav><article><h1>A</h1><p>Same text.</p></article></body>" for i in range(6)]
    assert set(texts_of_pages(spark, notes).values()) == {"A\nSame text."}


def test_template_and_slots_decide_inside_an_article(spark):
    adverts = ["Buy the first thing of this shop now.", "Get the second thing of this shop today."]
    page = ("<html><body><article><h1>Title {0}</h1><p class=k>Share this page with others</p><p class=c>{1}</p>"
            "<p class=d>{2}</p><p class=t>Body {0} is about <b>things</b> {0}{0} and it is long.</p></article></body></html>")
    pages = [page.format(f"n{i}", ("red", "blue")[i % 2], adverts[i % 3 % 2]) for i in range(12)]
    got = texts_of_pages(spark, pages)
    for i in range(12):
        assert got[i] == f"Title n{i}\n{('red', 'blue')[i % 2]}\nBody n{i} is about things n{i}n{i} and it is long."
    # versions of an article are no frame, whatever they share
    same = "".join(f"<p class=s{k}>Paragraph {k} of a text in versions.</p>" for k in range(5))
    got = texts_of_pages(spark, [f"<body><article><h1>One title</h1>{same}<p class=z>v{i}</p></article></body>" for i in range(8)])
    assert all(t.startswith("One title\nParagraph 0") and t.endswith(f"versions.\nv{i}") for i, t in got.items())


def test_template_tokens_are_in_order_and_nest(spark):
    classes = {1: (7, 0), 2: (7, 1), 3: (7, 2)}
    assert misplaced([1, 9, 2, 3], classes) == set() == misplaced([1, 2, 3, 1, 2, 3], classes)
    assert misplaced([3, 1, 2], classes) == {3} and misplaced([1, 1, 2, 2, 3, 3], classes) != set()
    two = classes | {5: (8, 0), 6: (8, 1)}
    size = {7: 3, 8: 2}
    assert nesting([1, 2, 5, 6, 5, 6, 3], two, size) == [(8, 7, 2, 2, 2)]
    assert nesting([1, 5, 2, 6, 3], two, size)[0][2] == -1 and nesting([5, 6, 1, 2, 3], two, size) == []
    # a text that stands now before and now behind the others of its class is no template
    page = "<body><div class=a>{}</div><div class=b>{}</div><p>{}</p></body>"
    pages = [page.format(*(("Moves about", f"u{i}") if i % 2 else (f"u{i}", "Moves about")), f"t{i}") for i in range(8)]
    moved = [p.replace("<div class=b>Moves about</div>", "<div class=b></div>Moves about") for p in pages]
    assert all("u" + str(i) in t and "t" + str(i) in t for i, t in texts_of_pages(spark, moved).items())


def test_pages_give_their_article(spark, sf):
    import html
    import re
    pages = duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall()
    got = {r["page_id"]: r["text"] for r in op4_html_extraction(spark, sf).collect()}
    for i, h in pages:
        body = re.search(r"<article>(.*?)(?:</article>|\Z)", h, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:h1|p|br)>", body)]
        assert got[i] == "\n".join(b for b in blocks if b)


# 5: pieces

def test_pieces_equal_the_unigram_model_of_the_library(tmp_path, texts):
    spm = pytest.importorskip("sentencepiece")
    path = piece_encoding.default_model()
    pieces = piece_encoding.read_pieces(path)
    scores = piece_encoding.zipf_scores(pieces)

    def field(n, wire, body):
        return bytes([n << 3 | wire]) + body

    def sized(b):
        n, out = len(b), b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n]) + b

    raw = b""
    for (p, _, t), s in zip(pieces, scores):
        raw += field(1, 2, sized(field(1, 2, sized(p.encode())) + field(2, 5, struct.pack("<f", s)) + field(3, 0, bytes([t]))))
    raw += field(2, 2, sized(field(3, 0, b"\x01") + b"\x98\x02\x01"))  # unigram, byte fallback
    raw += field(3, 2, sized(field(1, 2, sized(b"identity")) + field(3, 0, b"\x01") + field(4, 0, b"\x00") + field(5, 0, b"\x01")))
    m = spm.SentencePieceProcessor(model_proto=raw)
    ours = piece_encoding.load_pieces(path)
    same = total = 0
    sample = [t for t in texts.values() if t and "  " not in t][:60] + ["naïve 日本語 \t x", "a\nb  c"]
    for t, ids in zip(sample, ours.encode(sample)):
        want = m.encode(t)
        score = lambda x: sum(float(ours.scores[i]) for i in x)
        total += 1
        same += want == ids.tolist()
        assert ours.is_byte[ids].any() or abs(score(want) - score(ids)) < 1e-3 * max(1, len(want))  # ties apart
        assert ours.decode(ids) == t.encode()
    assert same > 0.9 * total


def test_piece_paths():
    ours = piece_encoding.load_pieces(piece_encoding.default_model())
    odd = [None, "", " ", "  a", "▁ mark", "x" * 500, "a   b ", "\x00\x7f", "😀é", "é" * 200]
    for t, ids in zip(odd, ours.encode(odd)):
        assert ours.decode(ids) == (t or "").encode()
        slow = [p for c in piece_encoding.split_chunks(t) for p in ours.encode_chunk(c.encode())]
        assert slow == ids.tolist()


def test_pieces_odd_rows(spark, odd, nothing):
    out = piece_encoding.encode_documents(odd)
    assert out.count() == odd.count()
    assert piece_encoding.encode_documents(nothing).count() == 0


# 9: toxicity

def test_toxicity_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    got = {r["doc_id"]: r for r in toxicity.op9_toxicity(spark, folder).collect()}
    label = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{folder}/labels.parquet'").fetchall())
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    held = [(label[d], r["predicted"]) for d, r in got.items() if r["held_out"] and d in label]
    assert sum(a == b for a, b in held) / len(held) > 0.9


def test_toxicity_keeps_the_share_of_all_labels(spark, monkeypatch):
    rows = [(i, f"w{i % 7} w{i % 3} is {'bad' if i % 10 == 0 else 'good'}") for i in range(1, 1001)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i, _ in rows], "doc_id long, toxic int")
    used = spark.sql("select *, xxhash64(doc_id) as o from {t} where crc32(cast(doc_id as string)) % 5 <> 0", t=labels)
    toxic, clean = (used.where(f"toxic = {y}") for y in (1, 0))
    picked = toxic.orderBy("o").limit(40).unionByName(clean.orderBy("o").limit(60)).select("doc_id", "toxic")
    keys, weights, bias = toxicity.fit_toxicity(docs, picked)
    monkeypatch.setattr(toxicity, "MAX_TOXIC", 40)
    monkeypatch.setattr(toxicity, "MAX_CLEAN", 60)
    got = toxicity.fit_toxicity(docs, labels)
    assert list(got[0]) == list(keys) and np.allclose(got[1], weights)
    assert np.isclose(got[2], bias + np.log((toxic.count() / clean.count()) / (40 / 60)))


def test_toxicity_odd_rows(spark, odd, nothing):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 12)] + [(None, 1)], "doc_id long, toxic int")
    out = toxicity.score_toxicity(odd, labels)
    assert out.count() == odd.count() and out.where("toxicity is null or toxicity < 0 or toxicity > 1").count() == 0
    assert toxicity.score_toxicity(odd, labels.limit(0)).where("toxicity >= 0.5").count() == 0
    assert toxicity.score_toxicity(nothing, labels).count() == 0


# 10: Jaccard

def brute_components(rows, n, num, den):
    sets = {}
    for d, t in rows:
        w = (t or "").encode().lower().split()
        if d is not None:
            sets.setdefault(d, []).append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            if any(x and y and den * len(x & y) >= num * len(x | y) for x in sets[a] for y in sets[b]):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in ids}


@pytest.mark.parametrize("n,num,den", [(3, 90, 100), (5, 80, 100)])
def test_jaccard_components(spark, texts, n, num, den):
    rng = random.Random(9)
    rows = list(texts.items())
    word = [f"w{i}" for i in range(4000)]
    for c in range(12):  # near copies at every distance from the threshold
        base = rng.choices(word, k=rng.randint(8, 400))
        for _ in range(rng.randint(2, 25)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = rng.choice(word)
            rows.append((1000 + len(rows), " ".join(copy[:len(copy) - rng.randint(0, 4)])))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(df, n, num, den).collect()}
    assert got == brute_components(rows, n, num, den)


def test_jaccard_blocks_do_not_change_the_links(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", 4)
    rng = random.Random(2)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):
        copy = base[:rng.randint(90, 120)]
        for _ in range(rng.randint(0, 3)):
            copy[rng.randrange(len(copy))] = f"x{rng.randrange(999)}"
        rows.append((i, " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(df).collect()}
    assert got == brute_components(rows, 3, 90, 100)


@pytest.mark.parametrize("num,den", [(95, 100), (90, 100), (80, 100), (50, 100)])
def test_linked_sets_share_a_part(num, den):
    rng = np.random.default_rng(num)
    for _ in range(2000):
        n = int(rng.integers(2, 30 if rng.random() < 0.5 else 700))
        a = np.unique(rng.integers(0, 2 ** 64, n, dtype=np.uint64))
        least = jaccard_join.least_overlap(n, num, den)  # a part of a that still links, and one that takes as much anew
        b = a[np.sort(rng.permutation(n)[:least])]
        c = np.unique(np.concatenate((a, rng.integers(0, 2 ** 64, n * den // num - n, dtype=np.uint64))))
        half = (n - least) // 2
        d = np.unique(np.concatenate((a[half:], rng.integers(0, 2 ** 64, half, dtype=np.uint64))))
        for x in (b, c, d):
            both = len(np.intersect1d(a, x))
            if len(x) and not np.array_equal(a, x) and den * both >= num * (len(a) + len(x) - both):
                assert np.isin(jaccard_join.part_signatures(a, num, den), jaccard_join.part_signatures(x, num, den)).any()


def test_jaccard_sets_that_share_phrases_form_no_group(spark, monkeypatch):
    rng = random.Random(4)
    phrases = [" ".join(f"p{p}w{i}" for i in range(8)) for p in range(300)]
    rows = [(i, " ".join(rng.sample(phrases, 12))) for i in range(400)]
    rows += [(1000 + i, f"{rows[i][1]} end") for i in range(5)]
    grouped = []
    components = jaccard_join.connected_components

    def seen(edges):
        out = components(edges)
        grouped.append(out.count())
        return out

    monkeypatch.setattr(jaccard_join, "connected_components", seen)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in jaccard_join.link_documents(df).collect()}
    assert got == {i: i % 1000 for i, _ in rows} and grouped[0] == 10


def test_jaccard_odd_rows(spark, odd, odd_rows, nothing):
    out = jaccard_join.link_documents(odd).collect()
    assert len(out) == len(odd_rows)
    want = brute_components([r[:2] for r in odd_rows], 3, 90, 100)
    assert {r["doc_id"]: r["component_id"] for r in out if r["doc_id"] is not None} == want
    assert all(r["component_id"] is None for r in out if r["doc_id"] is None)
    assert jaccard_join.link_documents(nothing).count() == 0


def test_class_words_inside_an_article_count_as_whole_values():
    page = "<article><div class='article-header'><h1>Headline</h1><p>Lead.</p></div><p>Body.</p></article>"
    assert extract(page) == "Headline\nLead.\nBody."
    page = ("<article><section class='legal-analysis'>x</section><figure class='share-price'>y</figure><div class='related-work'>z</div>"
            "<div class='wide share'>no</div><div id=comments>no</div><p>Body</p></article><div class='ad-slot'>no</div>")
    assert extract(page) == "x\ny\nz\nBody"
