"""Secret scanning with corpus-wide ownership frequency (op 7).

Pattern matches give base spans.  Candidate values - of base spans and of
long mixed tokens - are hashed and aggregated by distinct repositories
(source, lang) and owners (source) over the whole corpus: a value that several
owners hold is a copied example, a mixed token of a single owner looks live
and its occurrences are added as spans of kind ``token``.

DataFrame functions only: no Python code runs on executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import documents, let, pin, row_key

#: kind -> (pattern, group that holds the value, least length of that value)
BASE = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),  # a longest run: the same spans as [0-9a-f]+ of 24 and more
}
TOKEN = r"[A-Za-z0-9_-]{20,}"
KINDS = [*BASE, "token"]


def _matches(text: Column, kind: str) -> Column:
    """Array of (kind, i, gap, match): every match of the kind's pattern in
    order, with the code points between it and the match before."""
    pattern = BASE[kind][0] if kind in BASE else TOKEN
    none = F.array().cast("array<struct<kind:int,i:int,gap:int,match:string>>")
    found = let(F.split(text, pattern, -1), lambda gaps: let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda ms: F.transform(
            ms, lambda m, i: F.struct(F.lit(KINDS.index(kind)).alias("kind"), i.alias("i"),
                                      F.char_length(F.get(gaps, i)).alias("gap"), m.alias("match")))))
    return F.when(text.rlike(pattern), found).otherwise(none)


def _value(kind: Column, match: Column) -> Column:
    """The value whose length and ownership count; null if it fails."""
    out = F.lit(None).cast("string")
    for n, (pattern, group, least) in enumerate(BASE.values()):
        v = F.regexp_extract(match, pattern, group) if group else match
        out = F.when((kind == n) & (F.char_length(v) >= least), v).otherwise(out)
    mixed = match.rlike("[0-9]") & match.rlike("[a-z]") & match.rlike("[A-Z]")
    return F.when(kind == len(BASE), F.when(mixed, match)).otherwise(out)


def find_secrets(docs: DataFrame) -> DataFrame:
    """One row per span: _id, _th, kind (index in KINDS), start, end (code
    points, end exclusive), value, n_repos, n_owners, live.

    Positions are running sums over a row's matches, taken in a window per
    (row, kind); only rows with matches are shuffled.  Base spans are all
    kept; ``token`` spans only if one owner holds the value and no base span
    overlaps.  Null text has no span; null source or lang counts as a value.
    """
    d = docs.select("doc_id", "text", "source", "lang")
    found = (
        d.select(*row_key(F.col("text"), F.col("doc_id")),
                 F.coalesce("source", F.lit("")).alias("owner"), F.coalesce("lang", F.lit("")).alias("lang"),
                 F.concat(*[_matches(F.col("text"), k) for k in KINDS]).alias("found"))
        .where(F.size("found") > 0)
        .dropDuplicates(["_llm_id", "_llm_th"])
        .select("_llm_id", "_llm_th", "owner", "lang", F.inline("found"))
    )
    before = Window.partitionBy("_llm_id", "_llm_th", "kind").orderBy("i")
    n = F.char_length("match")
    spans = (
        found.withColumn("end", F.sum(F.col("gap") + n).over(before))
        .withColumn("start", F.col("end") - n)
        .withColumn("value", _value(F.col("kind"), F.col("match")))
        .where("value is not null")
        .withColumn("h", F.sha2("value", 256))
        .select("_llm_id", "_llm_th", "owner", "lang", "kind", "start", "end", "value", "h")
    )
    spans = pin(spans, "spans")
    owned = (
        spans.groupBy("h", "owner", "lang").agg(F.count(F.lit(1)).alias("n"))
        .groupBy("h", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
        .groupBy("h").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"))
    )
    spans = spans.join(owned, "h").withColumn("live", F.col("n_owners") == 1).drop("h")
    token = len(BASE)
    # a token overlapped by a base span of its row adds nothing: intervals in
    # order of start carry the furthest base end so far and the next base start
    up = Window.partitionBy("_llm_id", "_llm_th").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy("_llm_id", "_llm_th").orderBy("start", "kind").rowsBetween(1, Window.unboundedFollowing)
    base = F.col("kind") < token
    spans = spans.withColumn("_e", F.max(F.when(base, F.col("end"))).over(up)) \
                 .withColumn("_s", F.min(F.when(base, F.col("start"))).over(down))
    clear = (F.coalesce("_e", F.lit(0)) <= F.col("start")) & (F.col("_s").isNull() | (F.col("_s") >= F.col("end")))
    return spans.where(base | (F.col("live") & clear)).drop("_e", "_s")


def _masked(text: Column, n: int, mask: str) -> Column:
    """The text with the matches of kind n that count replaced by ``mask``."""
    pattern = BASE[KINDS[n]][0] if KINDS[n] in BASE else TOKEN

    def put(match):
        hit = _value(F.lit(n), match).isNotNull() if KINDS[n] in BASE else F.array_contains("_llm_tokens", match)
        return F.coalesce(F.when(hit, F.lit(mask)).otherwise(match), F.lit(""))

    def joined(gaps, matches):
        return F.array_join(F.transform(gaps, lambda g, i: F.concat(g, put(F.get(matches, i)))), "")

    new = let(F.split(text, pattern, -1), lambda gaps: let(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda matches: joined(gaps, matches)))
    return F.when(F.col("_llm_tokens").isNotNull() & text.rlike(pattern), new).otherwise(text)


def redact(docs: DataFrame, mask: str = "[REDACTED]") -> DataFrame:
    """``docs`` with the text of every span replaced by ``mask`` (kinds in
    order, each on the outcome of the one before); n_chars follows if there.
    Rows without a span, and null texts, stay as they are."""
    spans = find_secrets(docs)
    per = spans.groupBy("_llm_id", "_llm_th").agg(
        F.collect_set(F.when(F.col("kind") == len(BASE), F.col("value"))).alias("_llm_tokens"))
    names = [c for c in docs.columns if c not in ("_llm_id", "_llm_th", "_llm_tokens")]
    j = docs.select(*names, *row_key(F.col("text"), F.col("doc_id"))).join(per, ["_llm_id", "_llm_th"], "left")
    for n, kind in enumerate(KINDS):
        j = j.withColumn("text", _masked(F.col("text"), n, mask))
    cols = [F.char_length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else F.col(c)
            for c in names]
    return j.select(*cols)


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = documents(spark, sf_dir)
    spans = find_secrets(d)
    token = len(BASE)
    label = F.array(*[F.lit(k) for k in KINDS])
    text = F.concat_ws(":", F.get(label, F.col("kind")), F.col("start"), F.col("end"))
    per = spans.groupBy("_llm_id", "_llm_th").agg(
        *[F.count(F.when(F.col("kind") == n, 1)).alias(f"n_{k}") for n, k in enumerate(BASE)],
        F.count(F.when(F.col("kind") == token, 1)).alias("n_token"),
        F.count(F.when(F.col("live"), 1)).alias("n_live"),
        F.sort_array(F.collect_list(F.struct("start", "kind", text.alias("s")))).alias("all"))
    per = per.select(
        "_llm_id", "_llm_th", *[f"n_{k}" for k in BASE], "n_token", "n_live",
        F.array_join(F.transform(F.filter("all", lambda x: x["kind"] < token), lambda x: x["s"]), ",").alias("base"),
        F.array_join(F.transform("all", lambda x: x["s"]), ",").alias("spans"))
    counts = [f"n_{k}" for k in BASE] + ["n_token", "n_live"]
    return (d.select("doc_id", *row_key(F.col("text"), F.col("doc_id"))).join(per, ["_llm_id", "_llm_th"], "left")
            .select("doc_id", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in counts],
                    F.sha2(F.coalesce("base", F.lit("")).cast("binary"), 256).alias("base_sha256"),
                    F.coalesce("spans", F.lit("")).alias("spans")))
