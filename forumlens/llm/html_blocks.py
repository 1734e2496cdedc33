"""Main text of HTML pages by the distribution of text over line blocks.

Markup is stripped to lines, one per block element, each with its length in characters.  Lines of menus, headers,
footers, sidebars, notices, adverts, forms and reader comments (by element, role, class or id) and lines that are mostly
links have length 0; scripts, styles and comments have no line at all.  Over windows of ``WINDOW`` lines the lengths
are summed: a surge is where the sum leaves 0, a dive where it falls back to 0, and the lines between
them are a region.  The edges of an ``article`` or ``main`` element part regions like a stretch of empty lines.

Regions inside such an element are the text, unless the longest region outside is longer than each of these elements:
then the regions outside are, with the elements of at least half its length.  Of the regions outside, one is text if its
sum reaches ``SURGE`` somewhere or it lies between two that do, and if none does, the longest is.  Of a kept region
every line of its own stays, however short.

A class or id name marks an element if each of its words is a mark or a plain word of layout: ``site-footer`` does,
``has-sidebar`` and ``comments-open`` don't.  Such names never mark an ``article`` or ``main``, but for an article inside
another one (its comments), nor the element that holds most of the text, if no landmark outside it has text; readers'
comments only count so if nearly nothing else is left.

Defined results: null or empty html, or a page without text: the empty string.  Unclosed elements end with
their parent, unclosed markup is text.  Repeated rows each get their result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

WINDOW = 3
SURGE = 80

# HTML elements by their part in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = "script style noscript template svg math iframe object canvas head select textarea title"
ASIDE = frozenset("nav header footer aside form dialog menu button fieldset".split())
LANDMARK = frozenset(["article", "main"])
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot "
    "th thead tr ul".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
# Words of class and id names that mark what is not the article.
MARKS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner nav navbar navigation menu menubar breadcrumb "
    "breadcrumbs sidebar aside rail widget footer masthead cookie cookies consent gdpr notice popup modal overlay newsletter subscribe "
    "subscription signup login share sharing social comment comments commentlist reply replies disqus respond related recommended "
    "recommendations pagination pager toolbar copyright".split())
HEADER_MARKS = frozenset(["header"])
READER_MARKS = frozenset("comment comments commentlist reply replies disqus respond".split())
# Words that may stand beside a mark in a name.
PLAIN = frozenset(
    "site page main global primary secondary left right top bottom upper lower wrapper wrap container inner outer box bar block "
    "section area list item items links link group row col column panel posts post article text form button buttons icon "
    "icons the and us by for side slot unit google dfp banner head header".split())

_TOKEN = re.compile(
    r"<!--(?:.*?-->|.*)"
    r"|<!\[CDATA\[.*?\]\]>"
    r"|<(?P<close>/?)(?P<name>[a-zA-Z][^\s>/]*+)(?P<attrs>(?:\"[^\"]*+\"|'[^']*+'|[^'\">]|['\"](?=[^'\"]*+>))*+)>"
    r"|<[!?][^>]*+>"
    r"|[^<]++|<", re.S)
_ATTR = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_SILENT = {n: re.compile(rf"</{n}\s*>", re.I) for n in SILENT.split()}


def _apart(name: str, attrs: str) -> str:
    """Why an element is not part of the article: by "kind", by a "name" or as a "reader"'s; empty if it is."""
    if name in ASIDE:
        return "kind"
    if not attrs or name in ("body", "html"):
        return ""
    named = ""
    for m in _ATTR.finditer(attrs):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "role" and value.lower() in ROLES or key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            return "kind"
        if key in ("class", "id"):
            for part in value.split():
                found = {w.lower() for w in _WORD.findall(part)}
                marks = found & MARKS
                if name not in LANDMARK and not name.startswith("h"):
                    marks |= found & HEADER_MARKS
                if marks and found <= marks | PLAIN:
                    named = named or ("name" if READER_MARKS.isdisjoint(marks) else "reader")
    return named


def _shut(found: list[tuple[str, int, int, int]], outer: list[int], readers: set[int]) -> list[bool]:
    """Per element set apart by a name (from 1; 0 is none): whether its lines are, as it or one around it doesn't hold most text."""
    held: dict[int, int] = {}
    anchored = False
    for _, n, landmark, mark in found:
        held[mark] = held.get(mark, 0) + n
        anchored |= landmark > 0 and n > 0 and not mark
    whole, left = sum(held.values()), held.pop(0, 0)
    free: set[int] = set()
    while held and not anchored:
        most = max(held, key=held.get)
        if held[most] * 2 <= whole or most in readers and left >= SURGE:
            break
        free.add(most)
        n, around = held.pop(most), outer[most]
        if around:
            held[around] = held.get(around, 0) + n
        else:
            left += n
    shut = [False]
    for mark in range(1, len(outer)):
        shut.append(mark not in free or shut[outer[mark]])
    return shut


def lines(html: str) -> list[tuple[str, int, int]]:
    """(text, length for the distribution, number of the landmark it is in or 0) of every line."""
    out: list[tuple[str, int, int, int]] = []
    text: list[str] = []
    linked = [0]
    stack: list[tuple[str, bool, int, int]] = []  # element, apart by kind, landmark, innermost element apart by name
    landmarks = 0
    outer = [0]  # per element apart by name: the one around it
    readers: set[int] = set()
    links = 0

    def here() -> tuple[bool, int, int]:
        return stack[-1][1:] if stack else (False, 0, 0)

    def flush() -> None:
        line = " ".join(unescape("".join(text)).split())
        if line:
            apart, landmark, mark = here()
            mostly_links = linked[0] > 0.6 * len(line) and not landmark
            out.append((line, 0 if apart or mostly_links else len(line), landmark, mark))
        text.clear()
        linked[0] = 0

    at = 0
    while at < len(html):
        m = _TOKEN.match(html, at)
        at = m.end()
        name = m["name"]
        if name is None:
            piece = m[0]
            if piece[0] != "<" or len(piece) == 1:
                text.append(piece)
                if links:
                    linked[0] += len(piece)
            elif piece.startswith("<![CDATA["):
                text.append(piece[9:-3].replace("&", "&amp;"))
            continue
        name = name.lower()
        if name in _SILENT:
            if not m["close"] and not m["attrs"].endswith("/"):
                end = _SILENT[name].search(html, at)
                if name == "head":
                    body = re.compile(r"<body[\s>]", re.I).search(html, at)
                    at = min([x for x in (end and end.end(), body and body.start()) if x] or [at])
                else:
                    at = end.end() if end else len(html)
            continue
        if name == "a":
            links = 0 if m["close"] else 1
            continue
        if name == "br":
            text.append(" ")
            continue
        if name in BLOCK:
            flush()
            links = 0
        if name in VOID or name in ("p", "li") or name not in BLOCK and name not in ASIDE and not m["attrs"]:
            # Paragraphs and plain inline elements don't nest anything that matters; marked ones below do.
            if name not in ("p", "li") or m["close"] or not _apart(name, m["attrs"]):
                if not (m["close"] and stack and stack[-1][0] == name):
                    continue
        if m["close"]:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    flush()
                    del stack[k:]
                    break
            continue
        if m["attrs"].endswith("/") and name not in BLOCK:
            continue
        apart, landmark, mark = here()
        if name not in BLOCK and name not in ASIDE and not _apart(name, m["attrs"]):
            continue
        if stack and stack[-1][0] in ("p", "li") and name in BLOCK:
            stack.pop()
            apart, landmark, mark = here()
        own = _apart(name, m["attrs"])
        # An article's own header holds its title.
        if name == "header" and landmark and not apart and not mark:
            own = ""
        if name in LANDMARK and own != "kind" and not (own and any(s[0] == "article" for s in stack)):
            own = ""
        if name in LANDMARK and not own and not apart:
            landmarks += 1
            landmark = landmarks
        if own:
            flush()
        if own in ("name", "reader"):
            outer.append(mark)
            mark = len(outer) - 1
            if own == "reader":
                readers.add(mark)
        stack.append((name, apart or own == "kind", landmark, mark))
    flush()
    shut = _shut(out, outer, readers)
    return [(line, 0 if shut[mark] else n, landmark) for line, n, landmark, mark in out]


def main_text(html: str | None) -> str:
    found = lines(html or "")
    if not found:
        return ""
    # Empty lines stand at the edges of landmarks, so that no region reaches across.
    spread: list[tuple[int, int]] = []
    before = found[0][2]
    for k, (_, n, landmark) in enumerate(found):
        if landmark != before:
            spread.extend([(-1, 0)] * WINDOW)
            before = landmark
        spread.append((k, n))
    sums = [sum(n for _, n in spread[i : i + WINDOW]) for i in range(len(spread))]
    regions: list[tuple[int, int, list[int]]] = []  # peak, total, lines
    surge = False
    for i, (k, n) in enumerate(spread):
        if n and not surge:
            regions.append((0, 0, []))
        surge = n > 0 or surge and sums[i] > 0  # until the dive
        if surge:
            peak, total, own = regions[-1]
            if n:
                own.append(k)
            regions[-1] = (max(peak, sums[i]), total + n, own)
    if not regions:
        return ""
    masses: dict[int, int] = {}  # of the landmarks
    for _, n, landmark in found:
        if landmark:
            masses[landmark] = masses.get(landmark, 0) + n
    outside = [r for r in regions if not found[r[2][0]][2]]
    longest = max((r[1] for r in outside), default=0)
    if masses and max(masses.values()) >= longest:
        kept = [r for r in regions if found[r[2][0]][2]]
    else:
        high = [k for k, r in enumerate(outside) if r[0] >= SURGE]
        kept = outside[high[0] : high[-1] + 1] if high else [max(outside, key=lambda r: r[1])]
        kept += [r for r in regions if masses.get(found[r[2][0]][2], 0) * 2 >= longest]
        kept.sort(key=lambda r: r[2][0])
    return "\n\n".join(found[k][0] for _, _, own in kept for k in own)


def extract(pages: DataFrame) -> DataFrame:
    """Per row: page_id, url, text, n_chars (code points)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kinds = {f.name: f.dataType.simpleString() for f in pages.schema.fields}
    return pages.select("page_id", "url", "html").mapInArrow(
        run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long")
