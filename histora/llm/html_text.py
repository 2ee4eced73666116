"""Main text of HTML pages by composite text density (operator 13).

1. The page becomes a tree of elements. End tags that HTML lets an author leave out are implied.
2. Elements that say what they are (navigation, forms, adverts, notices, comments, ...) leave the tree with all they hold.
3. Every node gets its composite text density: characters per tag, adjusted by the characters and tags of links below it and
   by the share of links in the whole page.
4. The container whose children have the largest sum of densities is the main text. If an article or main element holds it
   or is the only one in it, that element is. Otherwise the smallest density on the way from it to the body is a threshold: what else is as dense, outside
   of it, belongs to the text as well, except lists of links.
5. Its text is put out block by block.

All of it takes time and memory in proportion to the page, at any depth of nesting.
"""

from __future__ import annotations

import re
from html import unescape
from math import e, log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from histora.llm.common import ship

# Quotes count only behind an equals sign; one that is never closed is an ordinary character
_TAG = re.compile(
    r"""<!--(?:-?>|.*?(?:--!?>|\Z))|<(?:[!?]|/(?![a-zA-Z]))[^>]*(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>=]++|=\s*+(?:"[^"]*"|'[^']*')?+)*+)(?:>|\Z)""",
    re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")

# Element names of HTML by the role they play here
_VOID = set("area base basefont bgsound br col embed frame hr img input link meta param source track wbr".split())
_RAW = set("script style title textarea xmp iframe noembed noframes".split())
_BLOCK = set(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup legend li main menu nav ol optgroup option p pre search section select summary table tbody tfoot "
    "thead tr ul".split()
)
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
_LEAVES = _HEADINGS | set("p pre li dt dd summary legend caption figcaption address".split())
_LISTS = set("ul ol dl dir table".split())
_ENDS_P = _BLOCK - set("body caption tbody tfoot thead tr option optgroup legend select".split()) | {"hr", "xmp"}
# an opening tag ends the nearest of these unless one of the others is nearer
_IMPLIED = {
    **{name: (("p",), ("button", "table", "td", "th", "caption", "object", "template")) for name in _ENDS_P},
    "li": (("li", "p"), ("ul", "ol", "dir", "menu", "table")),
    **{name: (("dt", "dd", "p"), ("dl", "table")) for name in ("dt", "dd")},
    **{name: (("option",), ("select", "datalist")) for name in ("option", "optgroup")},
    **{name: (("td", "th"), ("table",)) for name in ("td", "th")},
    "tr": (("tr",), ("table",)),
    **{name: (("thead", "tbody", "tfoot", "caption"), ("table",)) for name in ("thead", "tbody", "tfoot")},
    "a": (("a",), ("table", "td", "th", "button", "object")),
}
_FOREIGN = ("svg", "math")
_FENCE = ("table", "td", "th", "caption", "button", "template", "object")
# Elements, roles and words of class and id names that mark what isn't the main text
_OUT_TAGS = set("aside audio button canvas datalist dialog embed fieldset footer form iframe input label legend menu nav noscript object "
                "optgroup option script search select style svg template textarea title video".split())
_OUT_ROLES = set("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search status tablist toolbar".split())
_OUT_WORDS = set(
    "ad ads adsense advert adverts advertisement advertising alert alerts announcement banner breadcrumb breadcrumbs captcha comment commentlist "
    "comments consent cookie cookies copyright disclaimer disqus gdpr login modal newsletter notice notices notification outbrain "
    "pagination paywall popup promo promoted promotion recommendations recommended related replies reply respond share sharing "
    "signup skip social sponsor sponsored subscribe subscription taboola teaser teasers toolbar trending".split()
)
_LAYOUT_WORDS = set("aside footer form header masthead menu nav navbar navigation search sidebar widget widgets".split())
_NAMED = _HEADINGS | {"article", "main", "tr", "th", "thead"}
_BESIDE = set("has is no not open with without".split())


class Page:
    """The elements of a page in arrays; element 0 is the body. `events` holds texts (element, text, in a link) and block ends in order."""

    def __init__(self, html: str):
        self.tag, self.parent, self.attributes = ["body"], [-1], [""]
        self.events: list[tuple[int, str | None, bool]] = []
        self._stack, self._blocks, self._at = [0], [0], {}
        self._read(html)

    def _pop_to(self, depth: int) -> None:
        while len(self._stack) > depth:
            tag, at = self.tag[self._stack.pop()], len(self._stack)
            places = self._at.get(tag)
            if places and places[-1] == at:
                places.pop()
            if self._blocks[-1] == at:
                self._blocks.pop()
                self.events.append((0, None, False))

    def _nearest(self, names) -> int:
        return max((self._at[n][-1] for n in names if self._at.get(n)), default=0)

    def _open(self, name: str, attributes: str) -> None:
        if name == "form" and self._at.get("form"):
            return
        ends, fence = _IMPLIED.get(name, ((), ()))
        place = self._nearest(ends)
        if place and place > self._nearest(fence):
            # an item ends with the paragraph in it
            self._pop_to(min([p for n in ends if self._at.get(n) and (p := self._at[n][-1]) > self._nearest(fence)]))
        if name in _HEADINGS and self.tag[self._stack[-1]] in _HEADINGS:
            self._pop_to(len(self._stack) - 1)
        self.tag.append(name)
        self.parent.append(self._stack[-1])
        self.attributes.append(attributes)
        if name in _BLOCK or name == "hr":
            self.events.append((0, None, False))
        foreign = name in _FOREIGN or any(self._at.get(f) for f in _FOREIGN)
        if name in _VOID or (foreign and attributes.endswith("/")):
            if name == "br":
                self.events.append((self._stack[-1], " ", False))
            return
        if name in ("td", "th"):
            self.events.append((len(self.tag) - 1, " ", False))
        self._at.setdefault(name, []).append(len(self._stack))
        if name in _BLOCK:
            self._blocks.append(len(self._stack))
        self._stack.append(len(self.tag) - 1)

    def _close(self, name: str) -> None:
        if name == "br":
            self.events.append((self._stack[-1], " ", False))
        places = self._at.get(name)
        if not places or (name not in _FENCE and places[-1] < self._nearest(_FENCE)):
            return
        if name in _BLOCK or name in _FENCE or self._blocks[-1] < places[-1]:
            self._pop_to(places[-1])
        else:
            # an inline element that is closed inside of a block opened in it: the block goes on
            places.pop()

    def _read(self, html: str) -> None:
        at, end, find = 0, len(html), _TAG.search
        while at < end:
            m = find(html, at)
            start = m.start() if m else end
            if start > at:
                text = html[at:start]
                self.events.append((self._stack[-1], unescape(text) if "&" in text else text, bool(self._at.get("a"))))
            if not m:
                break
            at, name = m.end(), m[2]
            if not name:
                continue
            name = name.lower()
            if name in ("html", "head", "body"):
                continue
            if m[1]:
                self._close(name)
            elif name in _RAW:
                # what it holds is no markup and never main text
                close = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(html, at)
                at = close.start() if close else end
            else:
                self._open(name, m[3])
        self._pop_to(1)


def _marks(tag: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is marked as something else than main text: in any case, and unless it holds an article."""
    found = {}
    for m in _ATTRIBUTE.finditer(attributes):
        found.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    style = found.get("style", "").lower().replace(" ", "")
    if "hidden" in found or found.get("aria-hidden", "").lower() == "true" or "display:none" in style or "visibility:hidden" in style:
        return True, False
    if not _OUT_ROLES.isdisjoint(found.get("role", "").lower().split()):
        return False, True
    strong = weak = False
    for name in f"{found.get('class', '')} {found.get('id', '')}".split():
        words = [w.lower() for w in _PARTS.findall(name)]
        if tag in _NAMED:
            # an article of the category "ads" or a heading named after its header is main text, an article "comment-7" isn't
            strong |= bool(words) and words[0] in _OUT_WORDS
        elif _BESIDE.isdisjoint(words):
            strong |= not _OUT_WORDS.isdisjoint(words)
            weak |= not _LAYOUT_WORDS.isdisjoint(words)
    return strong and tag != "main", weak


def _left_out(page: Page) -> list[int]:
    """For every element: 0 in the tree, 1 left out, 2 the header of an article, of which only headings stay."""
    tag, parent, n = page.tag, page.parent, len(page.tag)
    strong, weak = [False] * n, [False] * n
    for i in range(1, n):
        if page.attributes[i]:
            strong[i], weak[i] = _marks(tag[i], page.attributes[i])
        if tag[i] in _OUT_TAGS:
            strong[i], weak[i] = strong[i] or tag[i] != "form", True
    size, inside = [0] * n, [0] * n
    for i, text, _ in page.events:
        if text:
            size[i] += len(text) - text.count(" ")
    for i in range(n - 1, 0, -1):
        # a form or frame of the layout around the whole article is no reason to lose it
        holds = tag[i] in ("article", "main") and not strong[i]
        inside[parent[i]] += inside[i] + holds if not strong[i] else 0
        size[parent[i]] += size[i]
    state, article = [0] * n, [False] * n
    for i in range(1, n):
        up, article[i] = state[parent[i]], article[parent[i]] or tag[i] in ("article", "main")
        if up == 1 or strong[i]:
            state[i] = 1
        elif not inside[i] and (weak[i] or tag[i] == "header") and not _around_all(page, i, size):
            state[i] = 2 if article[i] and _is_header(page, i) else 1
        else:
            state[i] = 0 if tag[i] in _HEADINGS else up
    return state


def _is_header(page: Page, i: int) -> bool:
    return page.tag[i] == "header" or "header" in page.attributes[i].lower()


def _around_all(page: Page, form: int, size: list[int]) -> bool:
    """Whether a form is the frame of the page: it holds most of the text, and two paragraphs or a heading."""
    if page.tag[form] != "form" or 2 * size[form] <= size[0]:
        return False
    paragraphs = 0
    for i in range(form + 1, len(page.tag)):
        if page.parent[i] < form:
            break
        paragraphs += 2 if page.tag[i] in _HEADINGS else page.tag[i] == "p"
    return paragraphs >= 2


def _path(page: Page, i: int):
    while i >= 0:
        yield i
        i = page.parent[i]


def densities(page: Page, state: list[int]) -> tuple[list[float], list[float], list[float]]:
    """Composite text density, sum of the children's densities, and share of link characters, for every element."""
    tag, parent, n = page.tag, page.parent, len(page.tag)
    chars, links, tags, link_tags = [0] * n, [0] * n, [0] * n, [0] * n
    own = [0] * n
    for i, text, linked in page.events:
        if text and not state[i]:
            size = len(text) - text.count(" ")
            chars[i] += size
            own[i] += size
            links[i] += size * linked
    for i in range(n - 1, 0, -1):
        if not state[i]:
            j = parent[i]
            chars[j] += chars[i]
            links[j] += links[i]
            tags[j] += tags[i] + 1
            link_tags[j] += link_tags[i] + (tag[i] == "a")
    share = links[0] / max(chars[0], 1)
    density, total = [0.0] * n, [0.0] * n
    for i in range(n):
        c, t = chars[i], max(tags[i], 1)
        if not c or state[i]:
            continue
        density[i] = c / t
        if share:
            base = log(c / max(c - links[i], 1) * links[i] + share * c + e)
            density[i] *= log(c / max(links[i], 1) * t / max(link_tags[i], 1) + 1e-9) / max(log(base), 1e-9)
        if i:
            total[parent[i]] += density[i]
        if tag[i] not in _LEAVES:
            # text outside of any paragraph counts like one
            total[i] += own[i]
    return density, total, [x / max(c, 1) for x, c in zip(links, chars, strict=True)]


def _chosen(page: Page, state: list[int]) -> list[bool]:
    """Elements whose subtrees are the main text."""
    tag, parent, n = page.tag, page.parent, len(page.tag)
    density, total, linked = densities(page, state)
    best = 0
    for i in range(n):
        if not state[i] and tag[i] in _BLOCK and tag[i] not in _LEAVES and total[i] > total[best]:
            best = i
    chosen = [False] * n
    path = list(_path(page, best))
    for name in ("article", "main"):
        named = [i for i in range(n) if tag[i] == name and not state[i]]
        around = [i for i in path if tag[i] == name] or (named if len(named) == 1 and best in _path(page, named[0]) else [])
        if around:
            chosen[around[-1]] = True
            return chosen
    threshold = min(density[i] for i in path)
    # the densest container below an element that is dense enough, and again in what is left beside it
    largest, where = total[:], list(range(n))
    for i in range(n - 1, 0, -1):
        j = parent[i]
        if not state[i] and tag[i] in _BLOCK and tag[i] not in _LEAVES and largest[i] > largest[j]:
            largest[j], where[j] = largest[i], where[i]
    chosen[best] = True
    above, covered = set(path), chosen[:]
    for i in range(1, n):
        covered[i] = covered[i] or covered[parent[i]]
        if covered[i] or i in above or state[i] or tag[i] not in _BLOCK or density[i] < threshold or not density[i]:
            continue
        if linked[i] <= 0.5 or tag[i] not in _LISTS:
            target = i if tag[i] in _LEAVES else where[i]
            chosen[target] = covered[target] = True
    return chosen


def main_text(html: str | None) -> str:
    """The main text of a page; empty if there is none."""
    if not html:
        return ""
    page = Page(html)
    state = _left_out(page)
    chosen = _chosen(page, state)
    kept = [False] * len(page.tag)
    for i, j in enumerate(page.parent):
        kept[i] = state[i] != 1 and (chosen[i] or (j >= 0 and kept[j]))
    blocks, block = [], []
    for i, text, _ in page.events:
        if text is not None:
            if kept[i] and not state[i]:
                block.append(text)
        elif block:
            blocks.append(" ".join("".join(block).split()))
            block = []
    blocks.append(" ".join("".join(block).split()))
    return "\n\n".join(b for b in blocks if b)


def extract_main_text(pages: DataFrame, html_col: str = "html", text_col: str = "text") -> DataFrame:
    """pages with the main text of each row's html in `text_col`; a column of that name is replaced.

    Rows with a null or empty page, or one without main text, have an empty text. Rows aren't compared with each other: repeated
    rows come back repeatedly, an empty table stays empty, all other columns and nulls in them stay as they are.
    """
    ship(pages.sparkSession)

    def run(html: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in html], dtype="object")

    return pages.withColumn(text_col, F.pandas_udf(run, "string")(F.col(html_col).cast("string")))


def page_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row a page: id_col, url_col, text and n_chars (code points of the text). Other columns are not read."""
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    found = extract_main_text(rows).select("id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
    return found.withColumnsRenamed({"id": id_col, "url": url_col})
