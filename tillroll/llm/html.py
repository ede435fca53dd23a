"""Main text of web pages by the distribution of text over line blocks.

Markup is stripped first: scripts, styles, comments and everything in elements
that are no article (menus, page headers, footers, sidebars, forms, notices,
adverts, reader comments) leave a gap, and each block element's text becomes one
line.  Text lengths are summed over a sliding window of lines.  Where the sum
surges above a floor a run of text begins; where it dives to nothing the run
ends.  The text between surge and dive is kept.  Stripped markup is a gap in the
article, no end of it: from the first surge above the floor to the last dive all
runs count, and after that those whose text ends as a sentence does.  A page with
an ``article`` or ``main`` element is looked at inside it, and every run counts.

Defined results: a null or empty page, or one without text, gives an empty text;
markup left open ends with the page; character references are decoded, any run
of white space in a block is one space, and blocks are joined by one; repeated
pages are read one by one; null ids and urls are carried; empty tables give no
rows; pages are read whole.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Elements that begin and end a block.
BLOCKS = frozenset("""address article aside blockquote body br caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol option p pre section
summary table tbody td tfoot th thead tr ul""".split())
# Elements whose content is no text of the article.
NO_TEXT = frozenset("""aside button canvas dialog embed footer form head iframe input map menu nav noscript object
option select svg template textarea audio video""".split())
# Elements that close themselves.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements that may be left open; an open one ends with its parent.
LOOSE = frozenset("""a abbr b big cite code dd dt em font i kbd label li mark option p q s samp small span strike strong
sub sup tbody td tfoot th thead tr tt u var""".split())
# Words of a class, id or role that mark what is no article.
MARKS = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments
consent contentinfo cookie cookies copyright disqus footer gdpr login menu modal nav navbar navigation newsletter notice
notices outbrain pager pagination popup promo promotion related search share sharing sidebar signup skip social sponsor
sponsored subscribe subscription taboola toolbar widget""".split())
PAGE_MARKS = frozenset({"header", "masthead", "topbar"})  # of no article only outside one
# First parts of names that tell of a page's layout ("has-sidebar"), not of an element.
LAYOUT = frozenset("has have is layout no not page single theme with without".split())

MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style)\b(?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?(?:>|\Z).*?(?:</\1\s*>|\Z)"
    r"|<!\[CDATA\[.*?(?:\]\]>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-z][a-z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*'|[\"'])*?)(?:>|\Z)", re.I | re.S)
NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
PARTS = re.compile(r"[a-z0-9]+")
WINDOW = 3
SENTENCE_END = re.compile(r"[.!?…。！？][\"'”’»)\]]*$")
GAP = ("", False)  # a line of stripped markup


def _marked(attributes: str, inside: bool) -> bool:
    """Whether a class, id or role says, by its first or last part, that an element is no article."""
    for m in NAMES.finditer(attributes):
        for name in (m[1] or m[2] or m[3] or "").lower().split():
            parts = PARTS.findall(name)
            if not parts or parts[0] in LAYOUT:
                continue
            ends = {parts[0], parts[-1]}
            if not MARKS.isdisjoint(ends) or not inside and not PAGE_MARKS.isdisjoint(ends):
                return True
    return False


def lines_of(html: str, by_name: bool = True) -> list[tuple[str, bool]]:
    """(text, whether inside an article or main element) of each block; gaps where markup is stripped.

    Without ``by_name``, classes, ids and roles are not looked at."""
    lines: list[tuple[str, bool]] = []
    text: list[str] = []
    stack: list[tuple[str, bool, bool]] = []  # (element, dropped, inside) of open elements
    opened: Counter = Counter()  # how many of each are open
    dropped = inside = False

    def settle():
        words = unescape("".join(text)).split()
        text.clear()
        if words:
            lines.append((" ".join(words), inside))

    at = 0
    for m in MARKUP.finditer(html):
        if m.start() > at and not dropped:
            text.append(html[at:m.start()])
        at = m.end()
        name = (m[3] or "").lower()
        if not name:
            continue
        if name in BLOCKS:
            settle()
        if m[2]:
            if opened[name]:
                while True:
                    last = stack.pop()
                    if name in LOOSE and last[0] not in LOOSE:  # a stray end doesn't close its parents
                        stack.append(last)
                        break
                    opened[last[0]] -= 1
                    if last[0] == name:
                        break
                was = dropped
                dropped, inside = (stack[-1][1], stack[-1][2]) if stack else (False, False)
                if was and not dropped:
                    lines.extend([GAP] * WINDOW)
            continue
        if name in VOID or m[4].endswith("/"):
            continue
        into = inside or name in ("article", "main")
        # Of loose elements only those matter that say something by a name.
        drop = dropped or name in NO_TEXT or name == "header" and not inside or bool(m[4]) and (
            by_name and _marked(m[4], into) or bool(HIDDEN.search(m[4])))
        if name in ("html", "body", "article", "main"):
            drop = dropped
        if name in LOOSE and not drop:
            continue
        if drop and not dropped:
            settle()
        stack.append((name, drop, into))
        opened[name] += 1
        dropped, inside = drop, into
    if at < len(html) and not dropped:
        text.append(html[at:])
    settle()
    return lines


def surges(sizes: list[int], floor: int) -> list[tuple[int, int, int]]:
    """(first, past the last, highest sum) of the runs between a surge and the next dive."""
    sums, total = [], 0
    for i, s in enumerate(sizes):
        total += s - (sizes[i - WINDOW] if i >= WINDOW else 0)
        sums.append(total)  # of the window that ends here
    out, start, peak = [], None, 0
    for i, s in enumerate([*sums, 0]):
        if start is None and s > 0:
            start, peak = i, 0
        if start is not None:
            peak = max(peak, s)
            if s == 0:
                if peak >= floor:
                    out.append((start, i, peak))
                start = None
    return out


def main_text(html: str | None, *, floor: int = 40) -> str:
    """The article's text of one page.

    A page on which names mark all text as no article is read without them."""
    lines = lines_of(html or "")
    if not any(t for t, _ in lines):
        lines = lines_of(html or "", by_name=False)
    if any(inside and t for t, inside in lines):
        kept = [(t if inside else "") for t, inside in lines]
        runs = surges([len(t) for t in kept], 1)
    else:
        kept = [t for t, _ in lines]
        runs = surges([len(t) for t in kept], 1)
        high = [i for i, r in enumerate(runs) if r[2] >= floor]
        if high:
            ends = [next((t for t in reversed(kept[a:b]) if t), "") for a, b, _ in runs]
            runs = [r for i, r in enumerate(runs) if high[0] <= i <= high[-1] or i > high[-1] and SENTENCE_END.search(ends[i])]
    return " ".join(t for a, b, _ in runs for t in kept[a:b] if t)


def extract(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            floor: int = 40) -> DataFrame:
    """(page_id, url, text, n_chars) for every row of ``pages``."""
    fields = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("text", pa.string()), ("n_chars", pa.int64())])

    def run(batches):
        for b in batches:
            texts = [main_text(h, floor=floor) for h in b.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], schema=fields)

    return pages.select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), F.col(html_col).alias("html"),
    ).mapInArrow(run, "page_id long, url string, text string, n_chars long")
