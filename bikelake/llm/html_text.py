"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of words and tags.  A word scores +1 less the weight of the tags it
stands under, a tag costs a little and, unless it is inline, its weight; one linear scan finds the
contiguous region with the largest sum.  The weights come from labelled pages: pages that
mark their article themselves (one ``article`` or ``main`` element).  The weight of a tag is
twice the share of its words that lie outside the marked article, so words under a tag that
is never part of an article count -1 and those under a tag that always is count +1.  Tags
that no labelled page shows take the prior below.

Elements that are never text of an article (scripts, forms, menus, notices, adverts, reader
comments ...) score nothing but the tag cost and are left out of the region.  A container is
one of them by a whole class, id or role that says so, unless it holds most of the page's
words; where such a word is only part of a name, the element just has a weight of its own to
be learned.  What remains is cut into blocks.
"""

from __future__ import annotations

import html
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

import pandas as pd

LABELLED_PAGES = 2000  # bound of the sample of labelled pages

RAW = frozenset("script style noscript template svg textarea title iframe object select canvas".split())
NEVER = RAW | frozenset("nav header footer aside form button menu dialog head fieldset audio map".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp "
                   "small span strike strong sub sup time tt u var wbr label "
                   "math mfrac mi mn mo mover mroot mrow ms mspace msqrt mstyle msub msubsup msup mtext munder "
                   "munderover semantics".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
LABELS = ("article", "main")
#: Elements of NEVER that some pages put around or into their article.  They stay out like a named
#: container does: unless they hold most of the page's words, or, for a header, lie in an article.
USUAL = frozenset("form fieldset dialog header button".split())
#: Names (class, id or role) of a container that is no part of an article.
NAMES = ("ads?|adverts?|advertisements?|sponsored|promo|banner|sidebar|menu|nav|navbar|navigation|breadcrumbs?|"
         "footer|comments?|cookies?|notices?|popup|modal|newsletter|subscribe|share|social|related|widget|"
         "disclaimer|complementary|contentinfo|search|hidden")
NAMED = re.compile(rf"(?:^|[\s_-])({NAMES})(?=$|[\s_-])", re.I)
WHOLE = re.compile(rf"(?:^|\s)({NAMES})(?=$|\s)", re.I)
#: Elements that no name leaves out or gives a weight of its own.
UNNAMED = frozenset("h1 h2 h3 h4 h5 h6 p figcaption body html".split())
PRIOR = {**{t: 2.0 for t in NEVER}, "a": 1.0, "ul": 0.0, "li": 0.0}
TAG_COST = 0.01

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*(?:>|$)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*(?:\"|$)|'[^']*(?:'|$))*)(?:>|$)", re.S)
_NAMES = re.compile(r"(?<![^\s\"'])(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)


def _key(name: str, attributes: str) -> tuple[str, bool]:
    """Weight key of a tag, and whether its names say that it is no part of an article."""
    if "=" in attributes and name not in LABELS and name not in UNNAMED:
        named = " ".join(x for m in _NAMES.findall(attributes) for x in m if x)
        whole = WHOLE.search(named)
        found = whole or NAMED.search(named)
        if found:
            return f"{name}.{found[1].lower()}", bool(whole) and name not in INLINE
    return name, False


def events(page: str):
    """``(kind, key, under, number, text)`` in page order.  kind: text, open, close; under: the
    open elements as (tag, key, never text of an article, number if only its name says so);
    number: that of the element that opens."""
    stack: list[tuple[str, str, bool, int | None]] = []
    at, raw_until = 0, None
    pos = 0
    while True:
        m = _TOKEN.search(page, pos)
        if m is None:
            break
        name = m[2].lower() if m[2] else ""
        if raw_until and not (m[1] and name == raw_until):
            # scripts and the like end only at their own end tag
            end = re.compile(rf"</{raw_until}\b", re.I).search(page, pos)
            at = pos = end.start() if end else len(page)
            if not end:
                return
            continue
        if m.start() > at and not raw_until:
            yield "text", "", stack, None, page[at:m.start()]
        at = pos = m.end()
        if not name:
            continue
        if m[1]:
            raw_until = None
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == name), None)
            yield "close", name, stack, None, ""
            if depth is not None:
                # an inline end tag closes nothing outside its own block
                if name in INLINE and any(s[0] not in INLINE for s in stack[depth + 1:]):
                    continue
                del stack[depth:]
            continue
        key, named = _key(name, m[3])
        if name == "p" or name in ("li", "dt", "dd", "tr", "td", "th", "option"):
            # these end an open element of their kind in the same container
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
                if stack[k][0] in ("ul", "ol", "dl", "table", "div", "section", "blockquote", *LABELS):
                    break
        elif name not in INLINE and name not in VOID and stack and any(s[0] == "p" for s in stack):
            # a block element ends an open paragraph
            k = max(i for i, s in enumerate(stack) if s[0] == "p")
            del stack[k:]
        titled = name == "header" and not named and any(s[0] in LABELS for s in stack)
        never = (named or name in NEVER) and not titled
        number = pos if never and (name not in NEVER or name in USUAL) else None
        yield "open", key, stack, number, name
        if name not in VOID and not m[3].rstrip().endswith("/"):
            stack.append((name, "" if titled else key, never, number))
            if name in RAW:
                raw_until = name
    if at < len(page) and not raw_until:
        rest = page[at:]
        yield "text", "", stack, None, rest


def learn_weights(pages) -> dict[str, float]:
    """Weights of tags from pages with exactly one ``article`` or ``main`` element."""
    inside, total = Counter(), Counter()
    for page in pages:
        if not page or sum(len(re.findall(rf"<{t}[\s>]", page, re.I)) for t in LABELS) != 1:
            continue
        for kind, _, stack, _, text in events(page):
            if kind == "text":
                n = len(text.split())
                held = any(s[0] in LABELS for s in stack)
                for key in {s[1] for s in stack if s[0] not in LABELS and s[0] not in ("html", "body")}:
                    total[key] += n
                    inside[key] += n * held
    return {k: 2.0 * (1 - inside[k] / v) for k, v in total.items() if v}


def _along(step):
    """Function of the open elements that carries ``step(value above, element)`` down to the
    innermost one.  Elements open and close at the end only, so each is visited once."""
    held: list[tuple] = []

    def value(stack):
        while held and (len(held) > len(stack) or held[-1][0] is not stack[len(held) - 1]):
            held.pop()
        for entry in stack[len(held):]:
            held.append((entry, step(held[-1][1] if held else None, entry)))
        return held[-1][1] if held else None

    return value


def extract(page: str | None, weights: dict[str, float] | None = None) -> str:
    """Main text of a page; an empty string for none.  Null counts as an empty page."""
    if not page:
        return ""
    known = {**PRIOR, **(weights or {})}
    weight = lambda key: known[key] if key in known else known.get(key.split(".")[0], 0.0)
    total, held_by = 0, Counter()
    inside = _along(lambda above, s: (above or (False, ())) if s[3] is None and not s[2] else
                    ((above or (False, ()))[0] or s[3] is None, (s[3], (above or (False, ()))[1])))
    for kind, _, stack, _, text in events(page):
        if kind == "text":
            raw, numbers = inside(stack) or (False, ())
            if not raw:
                n = len(text.split())
                total += n
                while numbers:
                    held_by[numbers[0]] += n
                    numbers = numbers[1]
    most = {number for number, n in held_by.items() if 2 * n > total}
    # (weight, left out) of the open elements together: a form or header that is kept is a plain container
    under = _along(lambda above, s: (max(above[0] if above else 0.0, 0.0 if s[0] in USUAL and s[3] in most else weight(s[1])),
                                     bool(above and above[1]) or s[2] and s[3] not in most))
    steps: list[tuple[float, str, bool]] = []  # score, text (None for a block break), left out
    for kind, key, stack, number, text in events(page):
        worst, out = under(stack) or (0.0, False)
        if kind == "text":
            # what is left out anyway must not split the article around it
            steps.append((0.0 if out else len(text.split()) * (1.0 - worst), text, out))
        else:
            name = text if kind == "open" else key
            out = out or name in NEVER or (number is not None and number not in most)
            # a link or an accent is no border: its words carry its weight, its tags the small cost
            cost = TAG_COST if out or name in INLINE else TAG_COST + weight(key)
            steps.append((-cost, None if name not in INLINE | RAW else "", False))
    best, best_range, run, start = 0.0, (0, 0), 0.0, 0
    for k, (score, _, _) in enumerate(steps):
        if run <= 0:
            run, start = 0.0, k
        run += score
        if run > best:
            best, best_range = run, (start, k + 1)
    blocks, held = [], []
    for _, text, out in [*steps[slice(*best_range)], (0, None, False)]:
        if text is None:
            block = " ".join(html.unescape("".join(held)).split())
            if block:
                blocks.append(block)
            held = []
        elif not out:
            held.append(text)
    return "\n".join(blocks)


def labelled_sample(pages: DataFrame, html_col: str = "html", id_col: str = "page_id",
                    bound: int = LABELLED_PAGES) -> list[str]:
    """About ``bound`` pages that mark their article, chosen by a hash and so the same ones in
    every run; at most twice as many reach the driver."""
    marked = pages.filter(F.col(html_col).rlike(r"(?i)<(article|main)[\s>]"))
    share = min(1.0, bound / max(1, marked.count()))
    dice = F.pmod(F.xxhash64(id_col, html_col), F.lit(1 << 20)) / float(1 << 20)
    return [r[0] for r in marked.filter(dice < share).select(html_col).limit(2 * bound).collect()]


def main_text(weights: dict[str, float]):
    """Column function ``html -> text`` with learned weights."""
    @pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pages.map(lambda p: extract(p, weights))
    return run


def extract_pages(spark: SparkSession, pages: DataFrame, *, html_col: str = "html", id_col: str = "page_id",
                  bound: int = LABELLED_PAGES) -> DataFrame:
    """All columns of ``pages`` but the html, and ``text``, ``n_chars`` (replacing columns of
    these names).  Null html gives an empty text; tables without marked pages use the prior
    weights; repeated rows and nulls in other columns pass through."""
    udf = main_text(learn_weights(labelled_sample(pages, html_col, id_col, bound)))
    keep = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    return (pages.select(*keep, udf(F.col(html_col)).alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
