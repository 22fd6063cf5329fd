"""Main text of web pages: the maximum-scoring run of words and tags.

A page is read once into a sequence of text nodes and tags. Subtrees that never hold main text (scripts, menus, forms,
adverts, comments and the like, told by element name or by what class, id and role name) become single marks without a
score. In what remains, words score positive and tags negative; one linear scan finds the contiguous run with the highest sum, and the
text of that run is the result, block by block.

A page that marks its articles is scanned article by article, and the runs are joined. There a tag weighs next to nothing,
as the label itself says that what surrounds it is text; the label's own tags weigh nothing anywhere. In pages without
the mark a tag weighs what was learned, within bounds, so that no tag alone outweighs a sentence.

The weights come from labelled pages: pages with an ``article`` element mark their own main text. Of at most
``LABELLED_PAGES`` of them, in hash order, Spark counts tokens inside and outside the label; a token's weight is the log
ratio of its two frequencies, kept above zero for words and below zero for tags, in units of the weight of a word.

Defined cases: a null or empty page, and a page without words, give the empty text; markup that breaks off or is never
closed is read as far as it goes; without labelled pages the default weights stand; repeated rows are read one by one;
other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.llm.common import table

LABELLED_PAGES = 1000

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?P<raw>script|style|textarea|title|iframe)\b[^>]*>.*?(?:</(?P=raw)\s*>|\Z)"
    r"""|<(?P<close>/?)(?P<name>[a-z][a-z0-9:-]*)(?P<attrs>(?:[^>"']++|"[^"]*"|'[^']*')*+)>"""
    r"|</?(?P<loose>[a-z][a-z0-9:-]*)[^>]*(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.IGNORECASE | re.DOTALL)
MARKS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s>]+)""", re.IGNORECASE)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
MATH = frozenset("math semantics mrow mi mn mo ms mtext mspace msub msup msubsup mfrac msqrt mroot mover munder munderover "
                 "mmultiscripts mprescripts mstyle mpadded mphantom menclose merror mtable mtr mtd".split())
INLINE = MATH | frozenset("a abbr b bdi bdo big cite code data del dfn em font i img ins kbd label mark q s samp small span "
                   "strike strong sub sup time tt u var wbr".split())
OUTSIDE = frozenset("nav footer aside form menu dialog head fieldset noscript template svg object select button annotation "
                    "annotation-xml".split())
# What a class, id or role names by its last word, as in ``site-footer`` (``share-price`` names a price): other than main text.
OUTSIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies copyright disclaimer disqus footer gdpr masthead menu modal nav navbar navigation "
    "newsletter notice notices notification overlay pager pagination popup promo promotion recommended related reply "
    "respond search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar widget widgets".split())
# Words after which the word before is the name, as in ``ad-box``.
GENERAL_WORDS = frozenset(
    "area areas bar block blocks body bottom box boxes btn button buttons cell col column container content count desktop fixed form "
    "global group header heading holder icon icons inner item items left link links list lists mobile module outer page pages panel "
    "post posts primary right root secondary section site slot small space sticky title top unit units wrap wrapper zone".split())
# Elements that a class never makes other than main text: their names speak of their contents (``language-menu``).
CONTENTS = frozenset("html body pre code kbd samp blockquote figure figcaption table thead tbody tr td th h1 h2 h3 h4 h5 h6 math".split())
ARTICLES = frozenset(("article", "main"))
ROOTS = ARTICLES | {"body"}


SKIPPED = "#"             # a text node of a skipped subtree


def _text_tags() -> dict[str, float]:
    names = [*INLINE, *"header section p br h1 h2 h3 h4 h5 h6 li ul ol blockquote pre table tr td th tbody dl dt dd figure".split()]
    return {slash + n: -0.1 for n in names for slash in ("", "/")}


@dataclass(frozen=True)
class Weights:
    """Score of a word, and of tags by name (closing tags with a slash); ``other_tag`` for names without a count."""

    word: float = 1.0
    tags: dict[str, float] = field(default_factory=_text_tags)
    other_tag: float = -0.5
    least: float = -1.0              # bounds of a tag's weight: in a page without articles, and inside an article
    least_inside: float = -0.02

    def score(self, name: str, text: str, inside: int = 0) -> float:
        if not name:
            return self.word * len(text.split())
        if name == SKIPPED or name.lstrip("/") in ARTICLES:
            return 0.0
        return max(self.tags.get(name, self.other_tag), self.least_inside if inside else self.least)


def _outside(name: str, in_article: bool) -> bool:
    return name in OUTSIDE or (name == "header" and not in_article)


def _named_outside(name: str, attrs: str, in_article: bool) -> bool:
    """Whether a word in class, id or role names something other than main text."""
    if not attrs or name in CONTENTS:
        return False
    for _, value in MARKS.findall(attrs):
        for mark in value.strip("\"'").split():
            words = [w.lower() for w in NAME_WORD.findall(mark)]
            if not in_article and words and words[-1] == "header":
                return True
            while len(words) > 1 and words[-1] in GENERAL_WORDS:
                words.pop()
            if words and words[-1] in OUTSIDE_WORDS:
                return True
    return False


def page_tokens(html: str) -> list[tuple[str, str, int]]:
    """The sequence ``(tag name or "", text, number of the article it is in or 0)``; closing names start with a slash.

    Tags of skipped subtrees are left out, their text is marked ``SKIPPED``. Words in class, id and role skip no ``article``
    or ``main`` by themselves, and no element that holds most of the page's words, unless the page's article is elsewhere.
    """
    spared: set[int] = set()                                    # places of elements that are not skipped for their names
    while True:
        tokens, by_name, elsewhere = _read(html, spared)
        total = sum(len(text.split()) for name, text, _ in tokens if name in ("", SKIPPED))
        largest = {at for at, (words, in_article) in by_name.items() if 2 * words > total and (in_article or not elsewhere)}
        if not largest:
            return tokens
        spared |= largest


def _read(html: str, spared: set[int]) -> tuple[list[tuple[str, str, int]], dict[int, tuple[int, bool]], bool]:
    """The tokens; words and being inside an article of each subtree skipped for its names; whether an article has words."""
    tokens: list[tuple[str, str, int]] = []
    stack: list[tuple[str, bool]] = []                          # open elements; whether each is outside main text
    by_name: dict[int, tuple[int, bool]] = {}
    skipper = -1                                                # place of the outermost skipped element, if skipped by name
    labelled = False
    outside = articles = 0
    number = 0                                                  # of the outermost article
    at = 0

    def drop(to: int) -> None:
        nonlocal outside, articles
        for name, out in stack[to:]:
            outside -= out
            articles -= name in ARTICLES
        del stack[to:]

    def text(upto: int) -> None:
        nonlocal labelled
        if upto > at:
            words = unescape(html[at:upto])
            tokens.append((SKIPPED if outside else "", words, number if articles > 0 and not outside else 0))
            if outside and skipper >= 0:
                count, in_article = by_name[skipper]
                by_name[skipper] = count + len(words.split()), in_article
            elif articles and not outside and not labelled:
                labelled = bool(words.strip())

    for m in MARKUP.finditer(html):
        text(m.start())
        at = m.end()
        name = (m["name"] or m["loose"] or "").lower()
        if not name:
            if m["raw"]:
                tokens.append((SKIPPED, "", 0))
            continue
        attrs = m["attrs"] or ""
        if m["close"] or m[0].startswith("</"):
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == name), -1)
            skipped = outside > 0
            if depth >= 0:
                drop(depth)
            if not skipped:
                tokens.append(("/" + name, "", number if articles > 0 else 0))
            continue
        named = m.start() not in spared and _named_outside(name, attrs, articles > 0)
        if name in ARTICLES:
            named = named and outside > 0                       # as an article of a comment among skipped comments
        out = named or _outside(name, articles > 0)
        if name in ROOTS and not out and not articles:
            drop(0)                                             # what was left open before does not hold the article
        if name in ARTICLES and not articles and not outside and not out:
            number += 1
        tokens.append((SKIPPED, "", 0) if outside or out else (name, "", number if articles > 0 else 0))
        if name not in VOID and not attrs.rstrip().endswith("/"):
            if out and not outside:
                skipper = m.start() if named and not _outside(name, articles > 0) else -1
                if skipper >= 0:
                    by_name[skipper] = 0, articles > 0
            stack.append((name, out))
            outside += out
            articles += name in ARTICLES
    text(len(html))
    return tokens, by_name, labelled


def token_counts(html: str) -> tuple[Counter, Counter]:
    """Tokens inside and outside the labelled text: words under ``""``, tags under their names."""
    inside, outside = Counter(), Counter()
    for name, text, labelled in page_tokens(html):
        if name in ("", SKIPPED):
            (inside if labelled else outside)[""] += len(text.split())
        else:
            (inside if labelled else outside)[name] += 1
    return inside, outside


def weights_from(counts: dict[str, tuple[int, int]]) -> Weights:
    """Weights from ``{token: (inside, outside)}``."""
    inside, outside = (sum(c[k] for c in counts.values()) for k in (0, 1))
    if not inside:
        return Weights()

    def ratio(token):
        a, b = counts.get(token, (0, 0))
        return log((a + 0.5) / (inside + 1)) - log((b + 0.5) / (outside + 1))

    word = max(ratio(""), 0.1)
    return Weights(1.0, _text_tags() | {t: min(ratio(t), -0.01) / word for t in counts if t and t.lstrip("/") not in ARTICLES})


def best_run(scores: list[float]) -> tuple[int, int]:
    """The contiguous run ``[start, end)`` with the highest positive sum, the first and longest of equal ones."""
    best, run, start, found = 0.0, 0.0, 0, (0, 0)
    for i, s in enumerate(scores):
        if run < 0:
            run, start = 0.0, i
        run += s
        if run > best or (run == best and best > 0 and start == found[0]):
            best, found = run, (start, i + 1)
    return found


def main_text(html: str | None, weights: Weights) -> str:
    tokens = page_tokens(html or "")
    numbers = {number for name, text, number in tokens if number and not name and text.strip()}
    regions = [[t for t in tokens if t[2] == k or t[0] == SKIPPED] for k in sorted(numbers)] or [tokens]
    runs = []
    for region in regions:
        start, end = best_run([weights.score(*t) for t in region])
        runs += [*region[start:end], ("article", "", 0)]        # a block ends with its article
    blocks, parts = [], []
    for name, text, _ in runs:
        if not name:
            parts.append(text)
        elif name.lstrip("/") not in INLINE:
            blocks.append("".join(parts))
            parts = []
    blocks.append("".join(parts))
    return " ".join(filter(None, (" ".join(b.split()) for b in blocks)))


def learned_weights(pages: DataFrame, labelled_pages: int = LABELLED_PAGES) -> Weights:
    """Weights from a bounded sample of the pages that hold an article element."""
    labelled = pages.where(F.col("html").rlike("(?i)<article[ >]")).select(F.xxhash64("html").alias("h"), "html")
    # the hash up to which pages are taken: only hashes are sorted, pages stay where they are
    last = labelled.select("h").distinct().orderBy("h").limit(labelled_pages).agg(F.max("h")).first()[0]
    if last is None:
        return Weights()
    sample = labelled.where(F.col("h") <= last).select("html")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: dict[str, list[int]] = {}
            for html in batch.column(0).to_pylist():
                for k, counter in enumerate(token_counts(html)):
                    for token, n in counter.items():
                        total.setdefault(token, [0, 0])[k] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([v[0] for v in total.values()], pa.int64()),
                 pa.array([v[1] for v in total.values()], pa.int64())], names=["token", "inside", "outside"])

    rows = sample.mapInArrow(count, "token string, inside long, outside long") \
        .groupBy("token").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).collect()
    return weights_from({r["token"]: (r["inside"], r["outside"]) for r in rows})


def extract(pages: DataFrame, weights: Weights) -> DataFrame:
    """Rows ``(page_id, url, text, n_chars)``."""
    chosen = pages.select("page_id", "url", "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(html, weights) for html in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in chosen.schema}
    return chosen.mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return extract(pages, learned_weights(pages))
