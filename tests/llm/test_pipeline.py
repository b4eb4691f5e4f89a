import corpus_pipeline
from strata.llm import jaccard_join, toxicity

from .test_models import brute_components, check_packing
from .test_native import brute_lines, brute_spans


def test_stages_follow_their_operators(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    name, stage = corpus_pipeline.STAGES[0]
    out = stage(spark, docs, sf)
    assert out.columns == docs.columns
    scores = toxicity.score_toxicity(docs, spark.read.parquet(f"{sf}/labels.parquet")).collect()
    assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in scores if r["toxicity"] < 0.5}
    out = corpus_pipeline.STAGES[1][1](spark, docs, sf)
    got = out.collect()
    assert out.columns == docs.columns and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["doc_id"]: r["text"] for r in got} == {d: t for d, _, _, t in brute_lines(rows.items())}
    out = corpus_pipeline.STAGES[2][1](spark, docs, sf)
    groups = brute_components(rows.items(), 5, 80, 100)
    assert out.columns == docs.columns and {r["doc_id"] for r in out.collect()} == set(groups.values())
    out = corpus_pipeline.STAGES[3][1](spark, docs, sf)
    got = out.collect()
    assert out.columns == docs.columns and len(got) == len(rows) and not any(brute_spans(r["text"]) for r in got)
    clean = {d for d, t in rows.items() if not brute_spans(t)}
    changed = [r["doc_id"] for r in got if r["doc_id"] in clean and r["text"] != rows[r["doc_id"]]]
    assert all("[REDACTED]" in r["text"] for r in got if r["doc_id"] in changed)
    out = corpus_pipeline.STAGES[4][1](spark, docs, sf).collect()
    assert check_packing(out, rows) == 0


def test_texts_under_one_doc_id_stay_apart(spark, sf):
    a, b, c = (" ".join(f"{x}{i}" for i in range(60)) for x in "abc")
    rows = [(1, a), (2, a), (2, b), (4, c), (4, a), (3, c), (7, None), (7, b), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {tuple(r) for r in corpus_pipeline.near_duplicates(spark, docs, sf).collect()}
    assert got == {(1, a), (2, b), (3, c), (7, None), (None, a)}


def test_run_and_odd_rows(spark, sf, odd, nothing):
    assert corpus_pipeline.run(spark, sf).count() > 0
    for docs in (odd, nothing):
        d = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, d, sf)
            assert out.columns == docs.columns, name
            d = spark.createDataFrame(out.collect(), docs.schema)
        corpus_pipeline.STAGES[-1][1](spark, d, sf).count()
    assert jaccard_join.EXTRA > 0
