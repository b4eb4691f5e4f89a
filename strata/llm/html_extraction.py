"""HTML extraction by equivalence-class template deduction (op 4).

A page is a list of tokens: tags, each in the path of its open elements, and
text segments.  Over the pages of a host every token's occurrence vector is
folded into one number (exclusive-or of hashes of page and count; pages of one
content count once), so tokens with equal vectors - an equivalence class - meet
under an equal key without any host's pages meeting in one task.  Classes that
are large enough, found on enough pages, in one order on every page and nested
are the host's template; the slots between template tokens hold its content.
A slot is boilerplate if its few contents come back on pages of different main
texts, or if its text belongs to the template itself; tags and words of class,
id and role (menu, header, footer, advert, form, comments) are hints beside it.
With an article or main element, text outside of it is left out.
"""

from __future__ import annotations

import html as html_lib
import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Collection, Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import if_small, pin, small_batches, with_fields

#: Least pages behind a class, least share of the host's pages, least tokens in a class.
MIN_PAGES, MIN_SHARE, MIN_TOKENS = 3, 0.5, 2
#: Least mean length of a slot's texts that may be boilerplate; shorter ones that come back are values.
MIN_CHARS = 20

# Fixed values of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "svg", "math")
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var wbr img".split())
#: Elements that never hold an article's text, and words of class, id or role that say so.
BOILERPLATE_TAGS = frozenset("nav footer aside form script style noscript iframe template button select option "
                             "textarea input head title menu dialog svg math object canvas audio video"
                             .split())
BOILERPLATE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner "
                              "nav navbar navigation menu breadcrumb breadcrumbs sidebar side aside widget footer "
                              "header masthead topbar cookie cookies consent gdpr notice alert popup modal overlay "
                              "newsletter subscribe subscription signup login search share sharing social related "
                              "recommended comment comments comment-list disqus reply replies respond pagination pager "
                              "toolbar skip copyright legal complementary contentinfo".split())
_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"</?[a-zA-Z][^\s/>]*(?:\"[^\"]*\"|'[^']*'|[^'\">])*>|<[/a-zA-Z][^>]*(?:>|\Z)", re.S)
_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_MARKS = re.compile(r"""(?:\s|["'])(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
#: An open element of the left kind ends where one of the right kinds begins.
_CLOSES = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                          "nav ol p pre section table ul".split()),
           "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]),
           "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
           "option": frozenset(["option"])}


#: Tags and hashes kept by their text in a worker, at most.
KEPT = 200_000
_TAGS: dict[str, tuple | None] = {}
_HASHES: dict[str, int] = {}


def _read_tag(tag: str) -> tuple[bool, str, str, tuple[str, ...], tuple[str, ...]] | None:
    """(end tag, name, name and words, words, whole values) of class, id and
    role of a tag; pages of a host repeat their tags, so they are kept."""
    if tag in _TAGS:
        return _TAGS[tag]
    m = _TAG.match(tag)
    out = None
    if m:
        values = [v for x in _MARKS.finditer(tag) for v in (x[1] or x[2] or x[3] or "").lower().split()]
        words = tuple(w for v in values for w in re.split(r"[^a-z0-9]+", v) if w)
        out = (bool(m[1]), m[2].lower(), ".".join((m[2].lower(), *words)), words, tuple(values))
    if len(_TAGS) >= KEPT:
        _TAGS.clear()
    if len(tag) < 500:
        _TAGS[tag] = out
    return out


def _is_boilerplate(name: str, words: tuple[str, ...], values: tuple[str, ...], in_article: bool) -> bool:
    """Inside an article a word counts only as a whole value: "share" drops a
    block there, "share-price" or "article-header" does not."""
    if name in BOILERPLATE_TAGS:
        return True
    if name == "header":  # a page's header; an article's own holds its headline
        return not in_article
    return name not in ("html", "body", "article", "main", "h1", "h2", "h3", "h4", "h5", "h6", "p") \
        and any(w in BOILERPLATE_WORDS for w in (values if in_article else words))


def walk(page: str) -> Iterator[tuple[str, str, bool, bool, bool]]:
    """(kind, value, breaks block, in boilerplate, in article) of each token:
    kind ``tag`` with the tag's path, or ``text`` with the raw segment."""
    stack: list[tuple[str, bool, bool, str]] = []  # name, boilerplate, article, path of the blocks inside
    at, n = 0, len(page)
    while at < n:
        m = _TOKEN.search(page, at)
        lo, hi = (m.start(), m.end()) if m else (n, n)
        bad = bool(stack) and stack[-1][1]
        art = bool(stack) and stack[-1][2]
        if lo > at:
            yield "text", page[at:lo], False, bad, art
        at = hi
        t = m and _read_tag(m[0])
        if not t:
            continue
        end_tag, name, label, words, values = t
        if end_tag:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), None)
            if depth is not None and not (name in INLINE and any(
                    s[0] in ("article", "main", "body", "nav", "footer", "div", "aside") for s in stack[depth + 1:])):
                del stack[depth:]
            yield "tag", "/" + name, name not in INLINE, bad, art
            continue
        while stack and name in _CLOSES.get(_block_of(stack), ()):
            _pop_block(stack)
        bad = bool(stack) and stack[-1][1]
        art = bool(stack) and stack[-1][2]
        above = stack[-1][3] if stack else ""
        yield "tag", above + label, name not in INLINE, bad, art
        if name in VOID or m[0].endswith("/>") and name in ("svg", "math"):
            continue
        if name in RAW:  # text up to the end tag, never markup
            end = re.compile(rf"</{name}\s*[^>]*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        bad = bad or _is_boilerplate(name, words, values, art)
        art = art or name in ("article", "main") or "main" in words and name != "nav"
        stack.append((name, bad, art, above if name in INLINE else f"{above}{name}/"))


def _block_of(stack: list) -> str:
    for s in reversed(stack):
        if s[0] not in INLINE:
            return s[0]
    return ""


def _pop_block(stack: list) -> None:
    while stack and stack[-1][0] in INLINE:
        stack.pop()
    if stack:
        stack.pop()


def _hash(value: str) -> int:
    return xxhash.xxh3_64_intdigest(value) - (1 << 63)


def _tag_hash(value: str) -> int:
    h = _HASHES.get(value)
    if h is None:
        if len(_HASHES) >= KEPT:
            _HASHES.clear()
        h = _HASHES[value] = _hash(value)
    return h


def _text_key(path: str, text: str) -> int:
    return _hash(f"{path}\x00{' '.join(html_lib.unescape(text).split())}")


def page_tokens(page: str | None) -> tuple[list[int], list[int]]:
    """(tokens in page order, sizes): a tag's size is 0, a text's its
    characters, less than 0 if it is not an article's own."""
    tokens: list[int] = []
    sizes: list[int] = []
    path = ""
    for kind, value, _, bad, art in walk(page or ""):
        if kind == "tag":
            if not value.startswith("/"):
                path = value
            tokens.append(_tag_hash(value))
            sizes.append(0)
        elif value.strip():
            tokens.append(_text_key(path, value))
            sizes.append(len(value) if art and not bad else -len(value))
    return tokens, sizes


def _folded(values: list[int]) -> int:
    return xxhash.xxh3_64_intdigest(array("q", values).tobytes()) - (1 << 63)


def page_content(tokens: list[int], sizes: list[int]) -> int:
    """Equal for pages of one article, whatever stands around it; without an
    article, for pages of the same texts."""
    return _folded([t for t, n in zip(tokens, sizes) if n > 0] or [t for t, n in zip(tokens, sizes) if n < 0])


def misplaced(tokens: list[int], classes: dict[int, tuple[int, int]]) -> set[int]:
    """Tokens that leave their class's order on this page.

    ``classes`` gives a token's class and place in it.  The k-th occurrences of
    a class's tokens must come in the class's order, before the k+1-th; of each
    class the longest part in order stays.
    """
    times: Counter[int] = Counter()
    rows: dict[int, list[tuple[tuple[int, int], int]]] = {}
    for t in tokens:
        if t in classes:
            c, place = classes[t]
            times[t] += 1
            rows.setdefault(c, []).append(((times[t], place), t))
    out: set[int] = set()
    for row in rows.values():
        if all(x[0] < y[0] for x, y in zip(row, row[1:])):
            continue
        tails: list[tuple[int, int]] = []
        ends: list[int] = []
        back: list[int] = []
        for i, (key, _) in enumerate(row):
            at = bisect_left(tails, key)
            tails[at:at + 1] = [key]
            ends[at:at + 1] = [i]
            back.append(ends[at - 1] if at else -1)
        stay, i = set(), ends[-1]
        while i >= 0:
            stay.add(i)
            i = back[i]
        out |= {t for i, (_, t) in enumerate(row) if i not in stay}
    return out


def nesting(tokens: list[int], classes: dict[int, tuple[int, int]], size: dict[int, int]) -> list[tuple[int, int, int, int, int]]:
    """(class, other, first slot, last slot, tuples inside) of classes whose
    tuples begin in a slot of the other's; -1 as first slot if one does not end in it."""
    opened: list[list[int]] = []  # class, tokens seen
    found: dict[tuple[int, int], list[int]] = {}
    for t in tokens:
        if t not in classes:
            continue
        c = classes[t][0]
        at = next((i for i in range(len(opened) - 1, -1, -1) if opened[i][0] == c), None)
        if at is None:
            for o, seen in opened:
                f = found.setdefault((c, o), [seen, seen, 0])
                f[0], f[1], f[2] = min(f[0], seen), max(f[1], seen), f[2] + 1
            opened.append([c, 1])
            continue
        for o, _ in opened[at + 1:]:
            found[o, c][0] = -1
        opened[at][1] += 1
        if opened[at][1] == size[c]:
            del opened[at]
    return [(c, o, *f) for (c, o), f in found.items()]


def slots(tokens: list[int], sizes: list[int], template: Collection[int]) -> list[tuple[int, int, int, int]]:
    """(template token before it, folded texts, characters, longest text of an
    article's other slots) of each slot that holds text."""
    found: list[tuple[int, int, int, tuple[int, int]]] = []
    at, texts = 0, []
    for t, n in zip([*tokens, None], [*sizes, 0]):
        if t is None or t in template:
            if texts:
                found.append((at, _folded([x for _, x in texts]), sum(abs(k) for k, _ in texts), max(texts)))
            at, texts = t, []
        elif n:
            texts.append((n, t))
    most = sorted(((x[3], i) for i, x in enumerate(found)), reverse=True)[:2]
    out = []
    for i, (at, content, chars, _) in enumerate(found):
        longest = next((m for m, j in most if j != i), (0, 0))
        out.append((at, content, chars, longest[1] if longest[0] > 0 else page_content(tokens, sizes)))
    return out


#: What a template says of a token: it is part of it, its text is boilerplate
#: outside an article, inside one too, the slot behind it holds boilerplate.
PART, OUTSIDE, INSIDE, FIXED = 1, 2, 4, 8


def extract(page: str | None, template: dict[int, int] | None = None) -> str:
    """The main text of a page, its blocks joined by newlines.

    With an ``article`` or ``main`` element its slots are the text; without,
    every slot of the page is.  Text of the host's template and slots that it
    says hold boilerplate are left out, in an article too.
    """
    blocks: list[tuple[bool, str]] = []
    current: list[str] = []
    inside = kept = False
    path = ""
    template = template or {}
    slot = template.get(0, 0)

    def close():
        nonlocal kept
        text = " ".join(html_lib.unescape("".join(current)).split())
        if text and kept:
            blocks.append((inside, text))
        current.clear()
        kept = False

    for kind, value, breaks, bad, art in walk(page or ""):
        if kind == "tag":
            if not value.startswith("/"):
                path = value
            if template:
                slot = template.get(_tag_hash(value), slot)
            if breaks:
                close()
            continue
        left_out = False
        if template and value.strip():
            role = template.get(_text_key(path, value), 0)
            slot = role or slot
            left_out = bool(role & (INSIDE if art else OUTSIDE) or not role and slot & FIXED)
        if bad or left_out and not art:
            continue
        if art != inside:
            close()
        inside = art
        kept = kept or bool(value.strip()) and not left_out  # a sentence keeps a repeated word
        current.append(value)
    close()
    if any(a for a, _ in blocks):
        blocks = [b for b in blocks if b[0]]
    return "\n".join(t for _, t in blocks)


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1), F.lit("")))


def _rows(fn, names: list[str], kinds: list[pa.DataType], *read: str):
    """A mapInArrow function: the rows that ``fn`` gives for the values of ``read``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for row in zip(*(b.column(c).to_pylist() for c in read)):
                out += fn(*row)
                if len(out) > 100_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                    out = []
            cols = list(zip(*out)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)
    return run


class _ByHost:
    """What ``prepare`` makes of a host's array column, made once a host and
    task (at most KEPT elements are kept)."""

    def __init__(self, prepare):
        self.prepare, self.made, self.size = prepare, {}, 0

    def get(self, host: str, column: pa.Array, i: int):
        if host not in self.made:
            what = column[i].as_py() or ()
            if self.size + len(what) > KEPT:
                self.made, self.size = {}, 0
            self.made[host], self.size = self.prepare(what), self.size + len(what)
        return self.made[host]


def _rows_by_host(prepare, fn, names: list[str], kinds: list[pa.DataType]):
    """As ``_rows`` over host, tokens, sizes and what ``prepare`` makes of the host's ``what``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts = _ByHost(prepare)
        read = _rows(fn, names, kinds, "host", "tokens", "sizes", "what")
        for b in batches:
            what = b.column("what")
            table = [hosts.get(h, what, i) for i, h in enumerate(b.column("host").to_pylist())]
            yield from read([_Columns(b, table)])
    return run


class _Columns:
    """A batch whose column ``what`` is a list of Python values."""

    def __init__(self, batch: pa.RecordBatch, what: list):
        self.batch, self.what = batch, what

    def column(self, name: str):
        return self if name == "what" else self.batch.column(name)

    def to_pylist(self) -> list:
        return self.what


def page_contents(pages: DataFrame) -> DataFrame:
    """(host, row, tokens, sizes) of one page of each host and content, so that
    copies of a page are no evidence of a template.  ``pages`` has host and html."""
    def read(host, page):
        tokens, sizes = page_tokens(page)
        return [(host, page_content(tokens, sizes), _folded(tokens), tokens, sizes)]

    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    found = pages.select("host", "html").mapInArrow(
        _rows(read, ["host", "content", "whole", "tokens", "sizes"], [pa.string(), pa.int64(), pa.int64(), longs, ints],
              "host", "html"), "host string, content long, whole long, tokens array<long>, sizes array<int>")
    found = pin(found.withColumn("row", F.monotonically_increasing_id()), "tokens")
    first = found.groupBy("host", "content").agg(F.min(F.struct("whole", "row")).alias("first")).select("first.row")
    return pin(found.join(first, "row", "left_semi").select("host", "row", "tokens", "sizes"), "contents")


def _by_host(table: DataFrame, *columns: str) -> DataFrame:
    """(host, what: array of ``columns``), in a fixed order."""
    return pin(table.groupBy("host").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("what")), "by-host")


def deduce_templates(contents: DataFrame) -> DataFrame:
    """(host, _llm_template: array of (token, role)) from ``page_contents``.

    Folding is associative, so a host with a third of all pages is reduced in
    every task before it is shuffled.
    """
    long, text = pa.int64(), pa.string()

    def count(host, row, tokens, sizes):
        size = dict(zip(tokens, sizes))
        article = sum(n for n in sizes if n > 0)
        where: dict[int, int] = {}
        for i, t in enumerate(tokens):
            where.setdefault(t, i)
        return [(host, row, t, c, where[t], size[t], article) for t, c in Counter(tokens).items()]

    found = contents.mapInArrow(
        _rows(count, ["host", "row", "token", "times", "place", "size", "article"], [text, *[long] * 6],
              "host", "row", "tokens", "sizes"),
        "host string, row long, token long, times long, place long, size long, article long")
    vector = found.groupBy("host", "token").agg(
        F.count(F.lit(1)).alias("pages"), F.expr("bit_xor(xxhash64(row, times))").alias("vector"),
        F.avg("place").alias("place"), F.max("size").alias("size"),
        F.sum(F.expr("times * greatest(size, 0)")).alias("own"), F.sum("article").alias("article")) \
        .where(F.col("pages") >= MIN_PAGES)
    hosts = contents.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    vector = pin(vector.join(hosts, "host").where(F.col("pages") >= MIN_SHARE * F.col("host_pages"))
                 .withColumn("class", F.xxhash64("pages", "vector")), "vectors")

    def enough(members: DataFrame) -> DataFrame:
        keep = members.groupBy("host", "class").agg(F.count(F.lit(1)).alias("n"), F.min(F.abs("size")).alias("least")) \
            .where((F.col("n") >= MIN_TOKENS) & (F.col("least") == 0)).select("host", "class")
        return members.join(keep, ["host", "class"], "left_semi")

    def places(what) -> tuple[dict[int, tuple[int, int]], dict[int, int]]:
        n: Counter[int] = Counter()
        out = {}
        for m in what:
            out[m["token"]] = m["class"], n[m["class"]]
            n[m["class"]] += 1
        return out, n

    def with_table(table: DataFrame, prepare, fn, names: list[str], kinds: list[pa.DataType], schema: str, *columns: str) -> DataFrame:
        j = contents.join(if_small(_by_host(table, *columns), 4096), "host")
        return j.mapInArrow(_rows_by_host(prepare, fn, names, kinds), schema)

    # order: tokens that leave their class's order on some page are no members
    members = pin(enough(vector), "members")
    wrong = with_table(members, places, lambda host, tokens, sizes, at: [(host, t) for t in misplaced(tokens, at[0])],
                       ["host", "token"], [text, long], "host string, token long", "class", "place", "token").distinct()
    members = pin(enough(members.join(wrong, ["host", "token"], "left_anti")), "members")

    # containment: of two classes that cross, or whose tuples lie in several
    # slots of the other or partly outside, the one on fewer pages is none
    def pairs(host, tokens, sizes, placed):
        at, n = placed
        times = Counter(tokens)
        all_tuples = {c: times[t] for t, (c, place) in at.items() if place == 0 and times[t]}
        return [(host, *x) for x in nesting(tokens, at, n)] + [(host, c, c, 0, 0, k) for c, k in all_tuples.items()]

    inside = pin(with_table(members, places, pairs, ["host", "class", "other", "low", "high", "n"], [text, *[long] * 5],
                            "host string, class long, other long, low long, high long, n long", "class", "place", "token")
                 .groupBy("host", "class", "other")
                 .agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")), "nesting")
    total = inside.where("class = other").select("host", "class", F.col("n").alias("total"))
    rank = members.groupBy("host", "class").agg(F.struct(F.max("pages"), F.count(F.lit(1)), F.col("class")).alias("rank"))
    crossed = inside.where("class <> other").join(total, ["host", "class"]).where("low < 0 or low <> high or n <> total") \
        .join(rank, ["host", "class"]).join(rank.select("host", F.col("class").alias("other"), F.col("rank").alias("other_rank")),
                                            ["host", "other"]) \
        .select("host", F.when(F.col("rank") < F.col("other_rank"), F.col("class")).otherwise(F.col("other")).alias("class"))
    members = pin(members.join(crossed.distinct(), ["host", "class"], "left_anti"), "members")

    # a class with most of its pages' article text is versions of an article, not its frame
    share = members.groupBy("host", "class").agg((2 * F.sum("own") > F.max("article")).alias("versions"))
    roles = members.join(share, ["host", "class"]).select("host", "token", (
        F.lit(PART) + F.when(F.col("size") != 0, OUTSIDE).otherwise(0)
        + F.when((F.col("size") != 0) & ~F.col("versions"), INSIDE).otherwise(0)).cast("long").alias("role"))

    # slots: boilerplate if their few contents come back in pages of different main texts
    def contents_of(host, tokens, sizes, what):
        whole = sum(n for n in sizes if n > 0) or sum(map(abs, sizes))
        return [(host, *s, whole) for s in slots(tokens, sizes, what)]

    fixed = with_table(members, lambda what: {m["token"] for m in what}, contents_of, ["host", "token", "content", "chars", "body", "whole"], [text, *[long] * 5],
                       "host string, token long, content long, chars long, body long, whole long", "class", "place", "token") \
        .groupBy("host", "token", "content", "body").agg(F.max("chars").alias("chars"), F.max("whole").alias("whole")) \
        .groupBy("host", "token", "content").agg(
            F.count(F.lit(1)).alias("n"), F.sum("chars").alias("chars"), F.sum("whole").alias("whole")) \
        .groupBy("host", "token").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("kinds"),
                                      F.sum("chars").alias("chars"), F.sum("whole").alias("whole")) \
        .where((F.col("n") >= 2 * MIN_PAGES) & (F.col("n") >= MIN_PAGES * F.col("kinds"))
               & (F.col("chars") >= MIN_CHARS * F.col("n")) & (2 * F.col("chars") <= F.col("whole"))) \
        .select("host", "token", F.lit(FIXED).cast("long").alias("role"))
    roles = roles.unionByName(fixed).groupBy("host", "token").agg(F.sum("role").alias("role"))
    return roles.groupBy("host").agg(F.collect_list(F.struct("token", "role")).alias("_llm_template"),
                                     F.max("role").alias("most")).where(F.col("most") > PART).drop("most")


def extract_pages(pages: DataFrame) -> DataFrame:
    """``pages`` with text and n_chars for every row.

    Null and empty html give an empty text; pages without a usable url share
    one nameless host; repeated rows are pages each; an empty table gives an
    empty result.
    """
    small_batches(pages.sparkSession)
    names = [c for c in pages.columns if c not in ("text", "n_chars", "_llm_template", "_llm_host", "_llm_page")]
    d = pages.select(*names, host_of(F.col("url")).alias("_llm_host"))
    templates = pin(deduce_templates(page_contents(d.select(F.col("_llm_host").alias("host"), "html"))), "templates")
    j = d.join(if_small(templates.withColumnRenamed("host", "_llm_host"), 4096), "_llm_host", "left")
    columns = [*names, "_llm_template", "_llm_host"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hosts = _ByHost(lambda what: {x["token"]: x["role"] for x in what})
        for b in batches:
            template, host = b.column(len(names)), b.column(len(names) + 1).to_pylist()
            out = [extract(page, hosts.get(h, template, i))
                   for i, (page, h) in enumerate(zip(b.column(names.index("html")).to_pylist(), host))]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(names)], pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                [*names, "text", "n_chars"])

    return j.select(*columns).mapInArrow(run, with_fields(j.select(*names), ("text", "string"), ("n_chars", "long")))


def op4_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract_pages(pages).select("page_id", "url", "text", "n_chars")
