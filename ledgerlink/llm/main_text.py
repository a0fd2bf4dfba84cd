"""Main text of HTML pages by two-pass block rules.

A page is cut into blocks at block-level tags. Scripts, styles, forms, comments
and elements that name themselves menus, headers, footers, sidebars, notices,
adverts or reader comments give no blocks. An element names itself so by a whole
name in its class, id or role: ``NOISE`` words, beside which only words of
``PARTS`` and single letters may stand (``site-footer``, but not ``has-sidebar``). A header inside an
article belongs to it, and an article element gives no blocks only where it is
one reader's comment. First pass, each block by itself:

* much link text: bad;
* at least ``LONG`` characters: good with enough stop words;
* else with a copyright sign, outside of an article element: bad;
* at least ``LONG`` characters: bad, or undecided inside an article element;
* shorter: near-good with enough stop words, else short; both undecided.

Second pass: a run of undecided blocks takes the label of the nearest decided
block before and after it in the same container kind, the nearer one where the
two differ and good on a tie. Near-good blocks without any decided neighbour are
good, short ones only inside an article element. Where a page has an article
element, blocks outside of it are bad.

Kept blocks are joined in page order by two line feeds. Each page is a row by
itself: no shuffle, memory bounded by an Arrow batch.

Defined cases: a null or empty page has the text ''; a page without markup is
one block; an unclosed element reaches to the end of its parent; a tag that is
never closed is text, and one whose quotes are never closed ends at its first
'>', as do all tags up to that quote; extra columns are ignored; repeated rows
stay. The time a page takes grows with its length, whatever is in it.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from ledgerlink.llm.common import table

LONG = 70
STOP_DENSITY = 0.2
LINK_DENSITY = 0.5

# Frequent function words of the languages handled.
STOP_WORDS = frozenset("""
the of and to in a is that for it as was with be by on not he i this are or his from at which but have an they you were
der die und in den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach
le la les de des du un une et en à est que qui dans pour pas sur par au avec il ce plus ne se son ou aux elle on sont
el la los las de del que y en un una por con para no se su al lo como más o es le ya sus este pero son
il di che e la per un in non una sono da con si come le dei nel alla più o het een van en dat op te zijn voor met
""".split())

# Elements without text of their own, or whose text belongs to the page around the article.
SKIP = frozenset("script style noscript template iframe object svg math canvas nav footer aside form menu dialog button select textarea "
                 "option datalist head title".split())
BLOCK = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre blockquote figcaption caption address div section article main body html header "
                  "footer nav aside form ul ol dl table tbody thead tfoot hr figure fieldset center details summary dialog menu hgroup".split())
RAW = frozenset("script style noscript template iframe textarea title".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr".split())
# Words of a class, id or role that mark what surrounds an article.
NOISE = frozenset("""
ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert
nav navbar navigation menu breadcrumb breadcrumbs pagination pager toolbar header masthead footer sidebar aside widget
comment comments commentlist disqus reply replies respond social share sharing related recommended newsletter subscribe signup login
popup modal overlay complementary contentinfo search
""".split())
COMMENT = frozenset("comment comments reply replies".split())
HEADER = frozenset("header masthead".split())
# Words that may stand beside those in a name: what part of a page or of its layout it is.
PARTS = frozenset("""
site page main global top bottom left right primary secondary mobile desktop sticky fixed inner outer wrap wrapper container content
area block box section panel list item items link links bar button buttons slot unit text title form post posts entry article articles
stories user users reader readers media js body author thread row col column columns grid card cards icons group cta strip
""".split())

_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_REST = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+")
_ATTR = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[^\W\d_]+")


def _noisy(attrs: str, name: str, article: bool) -> bool:
    """Whether an element's attributes say that it is not main text."""
    if not attrs:
        return False
    noise = COMMENT if name == "article" else frozenset() if name == "main" else NOISE - HEADER if article else NOISE
    for m in _ATTR.finditer(attrs):
        for one in (m[2] or m[3] or m[4] or "").lower().split():
            words = [w for w in re.split(r"[^a-z]+", one) if len(w) > 1]
            if not noise.isdisjoint(words) and all(w in noise or w in PARTS for w in words):
                return True
    return bool(_HIDDEN.search(attrs))


def markup(page: str) -> Iterator[tuple[int, int, str, bool, str]]:
    """(start, end, name, closing, attributes) of all markup, in one pass forward;
    the name is '' where there is nothing but characters to leave out."""
    n, at, broken = len(page), 0, 0
    last, cdata = page.rfind(">"), page.rfind("]]>")
    while (i := page.find("<", at)) >= 0:
        if i > last:                             # nothing ends any more, but a comment may begin
            i = page.find("<!--", i)
            if i >= 0:
                yield i, n, "", False, ""
            return
        name, closing, attrs = "", False, ""
        if page.startswith("<!--", i):
            stop = page.find("-->", i + 4)
            at = stop + 3 if stop >= 0 else n
        elif page.startswith("<![CDATA[", i) and cdata >= i + 9:
            at = page.find("]]>", i + 9) + 3
        elif page[i + 1] in "!?":
            at = page.find(">", i) + 1
        else:
            m = _NAME.match(page, i)
            if not m:                            # a character like any other
                at = i + 1
                continue
            stop = m.end()
            if i >= broken:
                stop = _REST.match(page, stop).end()
                if stop == n or page[stop] != ">":
                    stop, broken = m.end(), stop
            at = page.find(">", stop) + 1
            name, closing, attrs = m[2].lower(), bool(m[1]), page[m.end():at - 1]
            if not closing and name in RAW:      # text up to the end tag is not markup
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                name, at = "", end.end() if end else n
        yield i, at, name, closing, attrs


def blocks(page: str) -> list[tuple[str, int, bool, bool]]:
    """(text, characters of it inside links, inside an article, heading)."""
    out: list[tuple[str, int, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []     # open block elements: name, skipped, inside an article
    text: list[str] = []
    links, in_link, heading = [0], 0, False

    def flush() -> None:
        nonlocal heading
        if text:
            clean = " ".join(html.unescape("".join(text)).split())
            if clean:
                out.append((clean, links[0], bool(stack) and stack[-1][2], heading))
            text.clear()
        links[0], heading = 0, False

    open_: Counter[str] = Counter()              # names in the stack

    def push(name: str, skipped: bool, article: bool) -> None:
        stack.append((name, skipped, article))
        open_[name] += 1

    def pop() -> str:
        name = stack.pop()[0]
        open_[name] -= 1
        return name

    at = 0
    for start, end, name, closing, attrs in chain(markup(page), [(len(page), len(page), "", False, "")]):
        piece, at = page[at:start], end
        if piece and not (stack and stack[-1][1]):
            text.append(piece)
            if in_link:
                links[0] += len(piece.strip())
        if not name:
            continue
        skipped, article = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        if name == "a":
            in_link = 0 if closing else 1
        elif name == "br":
            if not skipped:
                text.append(" ")
        elif name in BLOCK or name in SKIP:
            if not skipped:
                flush()
                heading = not closing and name in ("h1", "h2", "h3", "h4", "h5", "h6")
            if closing:
                while open_[name] and pop() != name:
                    pass
            elif name not in VOID:
                if name == "p" and stack and stack[-1][0] == "p":
                    pop()
                if name in ("li", "td", "th", "tr", "dt", "dd", "option") and stack and stack[-1][0] in (name, "p"):
                    pop()
                out_of = name in SKIP or name == "header" and not article or name not in ("body", "html") and _noisy(attrs, name, article)
                push(name, skipped or out_of, article or name in ("article", "main"))
        elif not closing and attrs and not attrs.rstrip().endswith("/") and name in ("span", "b", "i", "em", "strong", "label", "small") and _noisy(attrs, name, article):
            flush() if not skipped else None
            push(name, True, article)
        elif closing and stack and stack[-1][0] == name:
            pop()
    flush()
    return out


def main_text(page: str | None) -> str:
    found = blocks(page or "")
    if not found:
        return ""
    if any(b[2] for b in found):
        found = [b for b in found if b[2]]
    labels: list[str] = []
    for text, linked, article, _ in found:
        words = _WORD.findall(text)
        density = sum(w.lower() in STOP_WORDS for w in words) / max(1, len(words))
        if linked > LINK_DENSITY * len(text):
            labels.append("bad")
        elif len(text) >= LONG and density >= STOP_DENSITY:
            labels.append("good")
        elif "©" in text and not article:
            labels.append("bad")
        elif len(text) >= LONG:
            labels.append("near" if article else "bad")
        else:
            labels.append("near" if density >= STOP_DENSITY else "short")
    decided = [i for i, x in enumerate(labels) if x in ("good", "bad")]
    keep, k = [], 0
    for i, label in enumerate(labels):
        while k < len(decided) and decided[k] < i:
            k += 1
        if label in ("near", "short"):
            around = [decided[j] for j in (k - 1, k) if 0 <= j < len(decided)]
            if around:
                near = min(abs(j - i) for j in around)
                label = "good" if any(labels[j] == "good" and abs(j - i) == near for j in around) else "bad"
                if found[i][2] and label == "bad" and not found[i][1]:
                    label = "good"               # text without links inside an article is not given up for a list of links beside it
            else:
                label = "good" if label == "near" or found[i][2] else "bad"
        if label == "good":
            keep.append(found[i][0])
    return "\n\n".join(keep)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    kinds = dict(pages.dtypes)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            pdf["text"] = [main_text(x) for x in pdf.pop("html")]
            pdf["n_chars"] = [len(x) for x in pdf["text"]]
            yield pdf

    rows = pages.selectExpr("cast(page_id as string) page_id", "url", "html")
    out = rows.mapInPandas(run, "page_id string, url string, text string, n_chars long")
    return out.withColumn("page_id", out.page_id.cast(kinds["page_id"]))


def op8_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"))
