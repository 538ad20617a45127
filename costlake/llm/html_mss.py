"""Main-text extraction by maximum-scoring subsequence.

A page becomes a sequence of scores: words score positive, tags negative. The
contiguous run with the largest sum (one linear scan) is the content region.
The weights come from labelled pages, those that mark their article with
exactly one ``<article>`` element: log-odds of a word to lie inside, and of the
pages with a tag inside to those with it outside, smoothed by one page. Only
``article``, ``main``, ``body`` and ``html`` end any region; what the sample has not
seen inside an article costs a finite amount, and nothing inside an ``<article>``.
Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments, known by element or by class, id and role, carry no words:
each counts as one tag. A hint is a whole class, id or role, or outside articles one
whose further parts only say where (``site-footer``); headings, paragraphs and
cells inside an article always count. On a page without article or main, an element that
holds most of its words is no boilerplate, whatever its class.

A page is read in one pass over its characters (``tokens``): tags by their attributes,
a quote counting as such only after ``=``; elements by a stack, with the end tags that
HTML lets pages leave out.

``fit_weights`` learns from at most ``MAX_LABELLED`` labelled pages (those with
the smallest content hashes, so the sample does not depend on partitioning): hashes
are ordered, and only the pages that they name are read again, where they are;
every page is extracted from its whole html.

Defined results: a NULL or empty html, or one without words, gives the empty
text; an element that never ends runs to the end of its parent or the page, but an
article in it counts; a nested article belongs to the outer one, of several others the
best one counts, and ties go to the first region; very long and broken pages take time in
proportion to their length; repeated rows are extracted one by one; an empty table gives an
empty result; extra columns pass through, clashing names are replaced.
"""

from __future__ import annotations

import html as html_lib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from costlake.llm.text import packed, text_of

MAX_LABELLED = 500
# Elements without article text, hints in class, id and role, and
# elements that separate blocks.
RAW = frozenset("script style noscript template iframe svg math canvas object textarea select title head".split())
SKIPPED = frozenset("nav header footer aside form button menu dialog".split())
HINTS = frozenset(
    "ad ads advert adverts advertisement alert banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies dialog disqus footer header menu modal nav navbar navigation newsletter notice notices "
    "pager pagination popup promo related replies reply respond search share sharing sidebar signup social sponsor "
    "sponsored subscribe toolbar widget".split())
BLOCKS = frozenset(
    "address article blockquote body br caption center dd details div dl dt fieldset figcaption figure h1 h2 h3 h4 h5 h6 "
    "hr html legend li main ol p pre section summary table tbody td tfoot th thead tr ul".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
ARTICLES = frozenset(["article", "main"])
FOREIGN = frozenset(["svg", "math"])         # may close themselves
CONTENT = frozenset("h1 h2 h3 h4 h5 h6 p td".split())

# Parts of a class that only say where a thing is, elements whose end tag may be
# left out with what ends them (a like element) and bounds their search, and what ends a paragraph.
PLACES = frozenset(
    "site main page top bottom left right primary secondary box bar block area container wrapper wrap section list inner "
    "outer global mobile desktop post body item items content text links area panel".split())
IMPLIED = {"li": "li", "dt": "dd", "dd": "dd", "option": "option", "optgroup": "option", "td": "td", "th": "td", "tr": "tr", "p": "p"}
ENCLOSING = {"li": frozenset("ul ol menu".split()), "dd": frozenset(["dl"]), "option": frozenset(["select"]),
             "td": frozenset("tr table".split()), "tr": frozenset(["table"]),
             "p": frozenset("table td th caption button object".split())}
ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl dt dd fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr li main menu nav ol p pre search section summary table ul".split())

# The groups that a name's start ends, and those whose search its element bounds.
_STARTS = {n: tuple(g for g, names in [(IMPLIED.get(n), [n]), ("td", ["tr"]), ("p", ENDS_P)] if g and n in names)
           for n in {*IMPLIED, *ENDS_P}}
_BOUNDS = {n: tuple(g for g, names in ENCLOSING.items() if n in names) for n in frozenset().union(*ENCLOSING.values())}

_TAG_START = re.compile(r"<(?=[a-zA-Z/!?])")
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_ATTR = re.compile(r"""[\s/]*([^\s/>][^\s/>=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_TAIL = re.compile(r"[\s/]*")
_PART = re.compile(r"[a-z]+")
_CLOSE = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for name in RAW}
_COMMENT = re.compile(r"--!?>")

TEXT, TAG, SKIP = 0, 1, 2
ENDS = frozenset(["article", "main", "body", "html"])
DEFAULT_WEIGHTS = {"word": 1.0, "link word": 0.2, "other tag": -0.5, "skipped": -1.0, **dict.fromkeys(sorted(ENDS), -1e4)}


def _hinted(name: str, attrs: list[tuple[str, str]], inside: bool, nested: bool = False) -> bool:
    """Whether its class, id or role makes an element boilerplate; ``inside`` an
    article, or ``nested`` in an element that is left out."""
    if name in ("body", "html") or inside and name in CONTENT:
        return False
    whole = inside or name in CONTENT or name in ARTICLES and not nested
    for key, value in attrs:
        if key not in ("class", "id", "role"):
            continue
        only = whole or key == "id" and (name == "section" or name in ARTICLES)
        for word in [value.strip()] if key == "id" else value.split():
            parts = [word] if only else _PART.findall(word)
            hints = [p for p in parts if p in HINTS and not (p == "header" and inside)]
            if hints and all(p in HINTS or p in PLACES for p in parts):
                return True
    return False


class _Open:
    """The open elements of a page, with the implied ends of HTML."""

    def __init__(self):
        self.stack: list[tuple[str, int, int]] = []        # name, what it leaves out, words before it
        self.count: Counter = Counter()
        self.latest = {g: [-1] for g in ENCLOSING}          # per enclosing element: place of the open one

    def push(self, name: str, kind: int, words: int) -> None:
        for g in _BOUNDS.get(name, ()):
            self.latest[g].append(-1)
        if name in IMPLIED:
            self.latest[IMPLIED[name]][-1] = len(self.stack)
        self.stack.append((name, kind, words))
        self.count[name] += 1

    def pop(self) -> tuple[str, int, int]:
        name, kind, words = self.stack.pop()
        self.count[name] -= 1
        if name in IMPLIED:
            self.latest[IMPLIED[name]][-1] = -1
        for g in _BOUNDS.get(name, ()):
            self.latest[g].pop()
        return name, kind, words

    def ended_by(self, name: str) -> int:
        """Height of the stack when a start tag has ended what it ends."""
        height = len(self.stack)
        for g in _STARTS.get(name, ()):
            if 0 <= (at := self.latest[g][-1]) < height:
                height = at
        return height


def _attributes(page: str, at: int) -> tuple[list[tuple[str, str]], bool, int]:
    """(attributes, self-closed, place behind the tag) from behind a tag's name."""
    attrs = []
    if page.startswith(">", at):
        return attrs, False, at + 1
    while True:
        end = _TAIL.match(page, at).end()
        if end >= len(page) or page[end] == ">":
            return attrs, page[end - 1] == "/", min(end + 1, len(page))
        m = _ATTR.match(page, at)
        attrs.append((m[1].lower(), (m[2] or m[3] or m[4] or "").lower()))
        at = m.end()


KEPT, BY_NAME, BY_HINT, ARTICLE_IN_SKIPPED = 0, 1, 2, 3


def tokens(page: str, spared: frozenset[int] = frozenset(), sizes: list[int] | None = None) -> Iterator[tuple[int, str, str, bool]]:
    """(kind, tag name or raw text, '' or '/', in a link) in page order; what a
    skipped element holds is left out. Elements skipped by a hint are numbered:
    those in ``spared`` are not skipped, and ``sizes`` gets the words of each,
    then of the page."""
    is_open, at, words, hinted = _Open(), 0, 0, 0
    skipping, inside, held, unclosed = 0, 0, [], set()
    numbers: list[int] = []

    def close(height: int) -> Iterator[tuple[int, str, str, bool]]:
        nonlocal skipping, inside
        while len(is_open.stack) > height:
            name, kind, before = is_open.pop()
            if kind == BY_HINT and sizes is not None:
                sizes[numbers[-1]] = words - before
            if kind in (BY_NAME, BY_HINT):
                skipping -= 1
            elif name in ARTICLES:
                inside -= 1
                if not skipping:
                    yield TAG, name, "/", is_open.count["a"] > 0
            if kind == BY_HINT:
                numbers.pop()
            elif kind == ARTICLE_IN_SKIPPED:
                skipping = held.pop()

    while at < len(page):
        m = _TAG_START.search(page, at)
        lt = m.start() if m else len(page)
        text = page[at:lt]
        if text:
            words += len(text.split())
            if not skipping:
                yield TEXT, text, "", is_open.count["a"] > 0
        if lt >= len(page):
            break
        at = lt
        if page.startswith("<!--", at):
            m = _COMMENT.search(page, at + 2)
            at = m.end() if m else len(page)
            continue
        end = "/" if page.startswith("</", at) else ""
        m = _NAME.match(page, at + 1 + len(end))
        if not m:                                     # a declaration, or broken: up to the next >
            gt = page.find(">", at)
            at = gt + 1 if gt >= 0 else len(page)
            continue
        name = m[0].lower()
        attrs, shut, at = _attributes(page, m.end())
        link = is_open.count["a"] > 0
        if end:
            if is_open.count[name]:
                k = len(is_open.stack) - 1
                while is_open.stack[k][0] != name:
                    k -= 1
                was = skipping
                yield from close(k)
                if not was and not skipping and name not in ARTICLES:
                    yield TAG, name, "/", link
            elif not skipping and name not in ARTICLES:
                yield TAG, name, "/", link
            continue
        if (k := is_open.ended_by(name)) < len(is_open.stack):
            yield from close(k)
        if name in RAW:
            if not skipping:
                yield SKIP, name, "", False
            if not (page[at - 2] == "/" and name in FOREIGN) and name not in unclosed:
                m = _CLOSE[name].search(page, at)
                if not m:
                    unclosed.add(name)
                at = m.end() if m else at if name in FOREIGN or name == "head" else len(page)
            continue
        if name in VOID or shut and name not in ARTICLES:
            if not skipping:
                yield TAG, name, "", link
            continue
        kind = KEPT
        if name in SKIPPED and not (name == "header" and inside):
            kind = BY_NAME
        elif _hinted(name, attrs, inside > 0, skipping > 0):
            kind = KEPT if hinted in spared else BY_HINT
            if sizes is not None:
                sizes.append(0)
            if kind == BY_HINT:
                numbers.append(hinted)
            hinted += 1
        elif skipping and name in ARTICLES:
            kind = ARTICLE_IN_SKIPPED
        if kind == ARTICLE_IN_SKIPPED:
            held.append(skipping)
            skipping = 0
        is_open.push(name, kind, words)
        if kind in (BY_NAME, BY_HINT):
            if not skipping:
                yield SKIP, name, "", False
            skipping += 1
            continue
        if name in ARTICLES:
            inside += 1
        if not skipping:
            yield TAG, name, "", is_open.count["a"] > 0
    yield from close(0)
    if sizes is not None:
        sizes.append(words)


def count_labelled(page: str) -> Counter:
    """Words by (kind, inside the article) on a labelled page, and 1 for each tag
    that it has inside or outside."""
    got, inside = Counter(), False
    for kind, s, end, link in tokens(page):
        if kind == TEXT:
            got["link word" if link else "word", inside] += len(s.split())
        elif kind == TAG:
            if s == "article":
                inside = not end
            else:
                got[s, inside] = 1
    return got


def fit_weights(pages: DataFrame, html: str = "html", max_labelled: int = MAX_LABELLED) -> dict[str, float]:
    """Weights from labelled pages; the defaults where there are none."""
    h = F.lower(text_of(html))
    labelled = (pages.select(text_of(html).alias("html")).filter(F.regexp_count(h, F.lit("<article[\\s>]")) == 1)
                .withColumn("h", F.xxhash64("html")))
    # At most max_labelled numbers come to the driver; the pages stay where they are.
    named = [r["h"] for r in labelled.select("h").distinct().orderBy("h").limit(max_labelled).collect()]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for b in batches:
            for h, page in zip(b.column(0).to_pylist(), b.column(1)):
                if h not in seen:
                    seen.add(h)
                    yield pa.RecordBatch.from_pylist(
                        [{"h": h, "kind": k, "inside": i, "n": n} for (k, i), n in count_labelled(page.as_py()).items()],
                        pa.schema([("h", pa.int64()), ("kind", pa.string()), ("inside", pa.bool_()), ("n", pa.int64())]))

    # Equal pages give equal rows in every task that holds one.
    rows = (labelled.filter(F.col("h").isin(named)).select("h", "html").mapInArrow(count, "h bigint, kind string, inside boolean, n bigint")
            .distinct().groupBy("kind", "inside").agg(F.sum("n").alias("n")).collect())
    return weights_from({(r["kind"], r["inside"]): r["n"] for r in rows})


def weights_from(got: dict[tuple[str, bool], int]) -> dict[str, float]:
    out = dict(DEFAULT_WEIGHTS)
    for kind in {k for k, _ in got} - ENDS:
        a, b = got.get((kind, True), 0), got.get((kind, False), 0)
        odds = math.log((a + 1) / (b + 1))
        if kind in ("word", "link word"):
            out[kind] = min(3.0, max(0.2, odds))
        else:
            out[kind] = -min(6.0, max(0.05, -odds))
    return out


def _page_tokens(page: str) -> list[tuple[int, str, str, bool]]:
    sizes: list[int] = []
    seq = list(tokens(page, sizes=sizes))
    total = sizes.pop()
    most = frozenset(n for n, size in enumerate(sizes) if 2 * size > total)
    if most and not any(k == TAG and s in ARTICLES for k, s, _, _ in seq):
        seq = list(tokens(page, most))
    return seq


def extract(page: str | None, weights: dict[str, float]) -> str:
    """The page's main text: blocks in page order, one space between them."""
    seq = _page_tokens(page or "")
    other, skipped = weights["other tag"], weights["skipped"]
    best, best_at, here, start, inside = 0.0, (0, 0), 0.0, 0, 0
    for i, (kind, s, end, link) in enumerate(seq):
        if kind == TAG and s in ARTICLES and end:
            inside = max(0, inside - 1)
        if kind == TEXT:
            here += weights["link word" if link else "word"] * len(s.split())
        elif not inside:                     # nothing costs inside the outermost article
            here += skipped if kind == SKIP else weights.get(s, other)
        if kind == TAG and s in ARTICLES and not end:
            inside += 1
        if here > best:
            best, best_at = here, (start, i + 1)
        if here <= 0:
            here, start = 0.0, i + 1
    blocks, run = [], []
    for kind, s, _, _ in seq[best_at[0]:best_at[1]]:
        if kind == TEXT:
            run.append(html_lib.unescape(s))
        elif s in BLOCKS or kind == SKIP and s in SKIPPED:
            blocks.append("".join(run))
            run = []
    blocks.append("".join(run))
    return " ".join(" ".join(blocks).split())


def main_text(pages: DataFrame, html: str = "html", weights: dict[str, float] | None = None) -> DataFrame:
    """``pages`` with ``text`` and ``n_chars`` of the main content."""
    w = weights or fit_weights(pages, html)

    @F.arrow_udf(T.StringType())
    def run(h: pa.Array) -> pa.Array:
        return pa.array([extract(x.as_py(), w) for x in h], pa.string())

    out = pages.select(packed(pages, ("text", "n_chars")), run(F.col(html)).alias("text"))
    return out.select("_doc.*", "text", F.char_length("text").cast("bigint").alias("n_chars"))
