"""Main text of web pages by line-block distribution.

Markup is stripped into lines, one for each block element. A line's weight is the length of its text;
lines inside menus, headers, footers, sidebars, notices, adverts, forms, comments of readers and the
like (by element, ARIA role or the words of class and id), and lines that are mostly links, weigh
nothing. The block at a line is the sum of the weights of ``WIDTH`` lines from there on. The text
surges where a block first reaches ``SURGE`` characters after silence and dives where blocks fall to
zero; everything with weight between a surge and its dive is kept, in page order. A page whose
``article`` or ``main`` element has text is read inside it alone, and there any weight is a surge, so
that short articles stay whole. On a page without such an element, if no block reaches ``SURGE``, the
heaviest run of lines is kept.

An ``article`` or ``main`` element that is not itself one of these starts afresh inside a form, an
element that is never closed and one that only its class or id calls chrome. Where these words name
texts of others (comments, related pages, sidebars), articles inside count only if the page has no
text otherwise. Class names such as ``no-sidebar`` or ``with-menu`` tell the layout, not chrome.

Pages are independent: one pass over the rows, no shuffle, memory bounded by a slice of pages.

Defined cases: a null or empty html gives the empty text with 0 characters; unclosed elements end with
the element around them or the page; character references are decoded (unknown ones stay as they
are); repeated rows give repeated results; other columns are not looked at.
"""

from __future__ import annotations

import html as html_lib
import re

from pyspark.sql import DataFrame

from tripstar.llm.common import map_batches

WIDTH, SURGE = 3, 80
LINK_SHARE = 0.6

_TAG = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[(.*?)(?:\]\]>|$)|<[!?][^>]*>"
    r"|<(script|style|noscript|template|textarea|svg|iframe|object|select|title)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\2\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S | re.I)
_ATTR = re.compile(r"""\b(class|id|role|hidden|aria-hidden|style)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORD = re.compile(r"[a-z]+|[A-Z][a-z]*")
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CHROME = frozenset("nav header footer aside form button menu dialog label fieldset".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_CHROME_WORDS = frozenset(
    "nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer foot sidebar aside ad ads advert adverts "
    "advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr notice notices alert popup modal "
    "overlay comment comments commentlist disqus reply replies respond discussion share sharing social newsletter subscribe "
    "subscription signup login form search related recommended recommendations widget pagination pager copyright legal disclaimer "
    "toolbar skip teaser".split())
# words that make a class name one of the article itself, whatever else it says
_MAIN_WORDS = frozenset("article content main post entry story body".split())
# words that make a class name tell which of these parts a page has or lacks
_HAVING_WORDS = frozenset("no non not with without has have".split())
_LAYOUT_WORDS = frozenset("nav navbar navigation menu menubar breadcrumb breadcrumbs header masthead topbar footer sidebar aside banner toolbar widget".split())
# chrome words of elements that often hold articles which are not the page's own
_OTHERS_WORDS = frozenset(
    "footer foot sidebar aside ad ads advert adverts advertisement advertising sponsor sponsored promo promotion comment comments commentlist "
    "disqus reply replies respond discussion related recommended recommendations widget teaser".split())
# why an element is chrome, from what an article inside leaves behind to what it does not
_NOT, _WORDS, _FORM, _OTHERS, _ELEMENT, _HIDDEN = range(6)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd mark q s samp small span strike strong sub sup "
    "time tt u var wbr label button".split())


def _chrome_kind(name: str, attrs: str) -> int:
    kinds = [_FORM if name == "form" else _ELEMENT if name in _CHROME else _NOT]
    if name in ("html", "body", "main", "article") or "=" not in attrs and "hidden" not in attrs:
        return kinds[0]
    for m in _ATTR.finditer(attrs):
        value = (m[2] or m[3] or m[4] or "").strip()
        kind = m[1].lower()
        if kind == "role":
            if value.lower() in _ROLES:
                kinds.append(_ELEMENT)
        elif kind == "style":
            if re.search(r"display\s*:\s*none", value, re.I):
                kinds.append(_HIDDEN)
        elif kind == "aria-hidden":
            if value.lower() == "true":
                kinds.append(_HIDDEN)
        elif kind in ("class", "id"):
            for token in value.split():
                words = [w.lower() for w in _WORD.findall(token)]
                said = _CHROME_WORDS.intersection(words)
                if _HAVING_WORDS.intersection(words[:-1]):
                    said -= _LAYOUT_WORDS
                if said and not (_MAIN_WORDS.intersection(words) and words[-1] in _MAIN_WORDS):
                    kinds.append(_OTHERS if _OTHERS_WORDS.intersection(words) else _WORDS)
    return max(kinds)


def lines_of(page: str) -> list[tuple[str, bool, bool]]:
    """(text, chrome, main) of every block line; text in chrome is dropped but keeps its line."""
    out, buried = _walk(page)
    fresh = frozenset(at for at, kind in buried if kind < _OTHERS)
    if fresh:
        out, _ = _walk(page, fresh)
    others = frozenset(at for at, kind in buried if kind <= _OTHERS)
    if others - fresh and not any(text for text, _, _ in out):
        out, _ = _walk(page, others)
    return out


def _walk(page: str, fresh: frozenset[int] = frozenset()) -> tuple[list[tuple[str, bool, bool]], list[tuple[int, int]]]:
    """The lines, and of each article or main element in chrome its place and the strongest kind of
    chrome around it; the elements at the places ``fresh`` leave it behind."""
    buried: list[tuple[int, str, list[list]]] = []
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool, list]] = []  # element, chrome from here on, main from here on, own [kind, closed by its tag]
    piece: list[str] = []
    linked = chars = 0
    in_link = 0
    chrome = main = False

    def end_line():
        nonlocal linked, chars
        text = " ".join(html_lib.unescape("".join(piece)).split()) if piece else ""
        if text or chrome:
            mostly_links = chars > 0 and linked >= LINK_SHARE * chars and not main
            if not (chrome and out and out[-1][1] and not out[-1][0]):
                out.append(("" if chrome or mostly_links else text, chrome, main))
        piece.clear()
        linked = chars = 0

    def add(text: str):
        nonlocal linked, chars
        if text and not chrome:
            piece.append(text)
            n = len(text.strip())
            chars += n
            linked += n if in_link else 0

    at = 0
    for m in _TAG.finditer(page):
        add(page[at:m.start()])
        at = m.end()
        if m[1] is not None:
            add(html_lib.escape(m[1], quote=False))
            continue
        if m[4] is None:
            continue
        name, closing = m[4].lower(), bool(m[3])
        if name not in _INLINE:
            end_line()
        if name == "a":
            in_link = 0 if closing else 1
        if name in _VOID:
            continue
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    stack[k][3][1] = True
                    del stack[k:]
                    break
                if stack[k][0] in ("article", "main", "body") and name not in ("html", "body"):
                    break
        elif not m[5].rstrip().endswith("/"):
            if name in ("p", "li") and stack and stack[-1][0] == name:
                stack.pop()
            own = [_chrome_kind(name, m[5] or ""), False]
            if chrome and name in ("article", "main"):
                buried.append((m.start(), name, [x[3] for x in stack if x[3][0]]))
            now = chrome and m.start() not in fresh or own[0] > _NOT
            if name in _INLINE and now and not chrome:
                end_line()
            stack.append((name, now, main or name in ("article", "main"), own))
        was = chrome
        chrome, main = (stack[-1][1], stack[-1][2]) if stack else (False, False)
        if was != chrome:
            piece.clear() if was else None
            linked = chars = 0 if was else chars
    add(page[at:])
    end_line()
    kinds = []
    for place, name, around in buried:
        # what is never closed is forgotten, unless it hides; a main element is the page's own
        left = [_WORDS if not closed and kind < _HIDDEN or kind == _OTHERS and name == "main" else kind for kind, closed in around]
        kinds.append((place, max(left)))
    return out, kinds


def main_lines(lines: list[tuple[str, bool, bool]], width: int = WIDTH, surge: int = SURGE) -> list[str]:
    """Texts between surges and dives of the line-block distribution."""
    inside = [i for i, (t, _, main) in enumerate(lines) if main and t]
    if inside:
        lines = [x for x in lines if x[2]]
        surge = 1
    weight = [len(t) for t, _, _ in lines]
    n = len(weight)
    block = [sum(weight[i:i + width]) for i in range(n)]
    runs, i = [], 0
    while i < n:
        if block[i] < surge:
            i += 1
            continue
        first = i
        while first > 0 and weight[first - 1] and not lines[first - 1][1]:
            first -= 1  # lines that lead up to the surge without a gap
        last = i
        while last + 1 < n and block[last + 1] > 0:
            last += 1
        runs.append((first, last))
        i = last + 1
    if not runs and any(weight):
        best, start = (0, 0, 0), None
        for k in range(n + 1):
            if k < n and weight[k]:
                start = k if start is None else start
            elif start is not None:
                best = max(best, (sum(weight[start:k]), -start, k))
                start = None
        runs = [(-best[1], best[2] - 1)]
    kept, done = [], 0
    for first, last in runs:
        for k in range(max(first, done), last + 1):
            if weight[k]:
                kept.append(lines[k][0])
        done = max(done, last + 1)
    return kept


def main_text(page: str | None, width: int = WIDTH, surge: int = SURGE) -> str:
    return " ".join(main_lines(lines_of(page), width, surge)) if page else ""


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 width: int = WIDTH, surge: int = SURGE) -> DataFrame:
    """One row per page: the id and url columns, ``text`` and ``n_chars``."""
    id_type, url_type = (pages.schema[c].dataType.simpleString() for c in (id_col, url_col))

    def run(cols):
        texts = [main_text(None if h is None else h.decode(), width, surge) for h in cols["html"]]
        return {"id": cols["id"], "url": cols["url"], "text": texts, "n_chars": [len(t) for t in texts]}

    picked = pages.selectExpr(f"`{id_col}` AS id", f"`{url_col}` AS url", f"`{html_col}` AS html")
    return map_batches(picked, run, f"id {id_type}, url {url_type}, text string, n_chars long", ("html",)).selectExpr(
        f"id AS `{id_col}`", f"url AS `{url_col}`", "text", "n_chars")
