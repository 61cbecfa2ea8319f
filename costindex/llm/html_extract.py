"""Main text of web pages: flat text blocks classified by a decision tree.

A page is cut into blocks at block-level tags.  A block has its word count and
link density (share of words inside links) and those of the blocks before and
after it, and whether it lies in a region that its element, class, id or role
names as menu, header, footer, sidebar, notice, advert, form or comments, or in
an article.  A decision tree (CART, trained here on the small labelled table in
``html_labels``) keeps or drops each block.  Scripts, styles, comments and
other unseen content are no blocks.

Inside a block, character references are decoded, white space becomes one
space, and the ends are trimmed.  Kept blocks are joined in page order by one
newline.  Nothing is cut off.  Everything is a narrow operation: a page is
handled within its row, and no shuffle is needed.

Defined results: a null or empty page, and one without kept blocks, has the
empty text; unclosed elements end with their parent; an unclosed comment or
raw-text element (script, style, iframe, textarea, title) reaches to the end;
quoted values may hold '<' and '>', and a quote without its partner is a
character; repeated rows get a row each.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from costindex.llm.common import append_columns
from costindex.llm.html_labels import PAGES

#: Unseen elements: the content of the first is text up to their end tag, or else the page's end; the others hold elements.
_RAW = {"script", "style", "iframe", "textarea", "title"}
_UNSEEN = {"noscript", "template", "svg", "math", "canvas", "object", "audio", "video", "select", "button"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_UNQUOTED = r"""=\s*+[^\s"'<>][^\s<>]*+|[^<>=]"""
#: Attributes whose quoted values end before the next '<'; a tag that goes on behind them is read by _tag_end.
_PLAIN = rf"""(?:=\s*+"[^"<]*"|=\s*+'[^'<]*'|{_UNQUOTED}|=(?!\s*["']))*+"""
_TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<(/?)([a-z][a-z0-9:-]*)({_PLAIN})(>?)|<[!?/][^>]*+(?:>|\Z)", re.S | re.I)
_RUN = re.compile(rf"""(?:{_UNQUOTED}|=(?!\s*["']))*+(?:=\s*+(["']))?""", re.S)
#: What follows the closing quote of a value that holds '<'; else the opening quote is a character, its partner missing.
_BEHIND = re.compile(r"""\s|/?\s*>|[a-z][\w:.-]*\s*=\s*["']""", re.I)
#: A tag that is broken by a missing quote: a quote without its partner before the next '<' is a character.
_BROKEN = re.compile(rf"""(?:=\s*+"[^"<]*"|=\s*+'[^'<]*'|{_UNQUOTED}|=)*+>""", re.S)
_RAW_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in _RAW}
_NAMES = re.compile(r"""(?:\b(class|id|role)\s*)?=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)

#: Elements that hold other blocks; the others in _BREAK only end a block.
_HOLDS = {"article", "main", "section", "div", "nav", "header", "footer", "aside", "form", "ul", "ol", "menu", "table",
          "dialog", "figure", "details", "fieldset", "blockquote", "body", "center", "dl"}
_BREAK = _HOLDS | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "tr", "td", "th", "thead", "tbody", "tfoot", "caption", "pre",
                   "hr", "address", "dt", "dd", "figcaption", "summary", "legend", "label", "input", "html", "head", "hgroup", "option"}
_ASIDE_TAGS = {"nav", "footer", "aside", "form", "dialog", "menu"}
_ASIDE_NAMES = re.compile(
    r"(?:^|[\s_-])(nav|navbar|navigation|menu|footer|sidebar|side|aside|complementary|contentinfo|ads?|advert|adverts|advertisement|"
    r"banner|promo|sponsor|sponsored|cookie|cookies|consent|gdpr|notice|notification|alert|popup|modal|dialog|overlay|newsletter|subscribe|"
    r"signup|login|search|comment|comments|replies|respond|disqus|share|sharing|social|related|recommended|breadcrumbs?|"
    r"pagination|pager|widget|toolbar|copyright|legal)(?:$|[\s_-])", re.I)
_HEADER_NAMES = re.compile(r"(?:^|[\s_-])(header|masthead|topbar)(?:$|[\s_-])", re.I)
FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "aside", "article")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    aside: bool
    article: bool


def _state(tag: str, attributes: str, aside: str, article: bool, first: bool) -> tuple[str, bool]:
    """(why aside: '' no, 'tag' by element, 'name' by name; in an article) inside an element, from its parent's."""
    names = " ".join(x for m in _NAMES.findall(attributes) if m[0] for x in m[1:] if x) if attributes else ""
    named = bool(names) and tag not in ("body", "html", "main") and bool(_ASIDE_NAMES.search(names))
    if tag in ("article", "main"):
        # the page's first article ends a region that a name or a form gave (a wrapper); teasers in a sidebar come later
        return ("name" if named else aside if aside == "tag" or not first else ""), True
    if tag == "form":
        return aside or "name", article
    if tag in _ASIDE_TAGS:
        return "tag", article
    if named or not article and (tag == "header" or names and tag not in ("body", "html") and _HEADER_NAMES.search(names)):
        return aside or "name", article
    return aside, article


def _tag_end(page: str, at: int, last: dict[str, int], dead: set[int]) -> int:
    """Position behind the '>' of the tag whose attributes start at ``at``, or -1 when '<' or the page's end comes first.

    ``last`` has the page's last quotes.  ``dead`` keeps the quotes from which no '>' was reached, so that no part
    of a page is read again for every '<' in it.
    """
    seen = []
    while True:
        m = _RUN.match(page, at)
        at = m.end()
        if m[1] is None and page[at:at + 1] == ">":
            return at + 1
        if m[1] is None or at in dead:
            dead.update(seen)
            return -1
        seen.append(at)
        if at <= last[m[1]]:
            end = page.index(m[1], at)
            if page.find("<", at, end) < 0 or _BEHIND.match(page, end + 1):
                at = end + 1


def _tokens(page: str):
    """(start, end, tag, whether an end tag, attributes) of tags; comments and raw-text elements have no tag."""
    at, last, dead, closed = 0, {q: page.rfind(q) for q in "\"'"}, set(), page.rfind(">")
    while (m := _TOKEN.search(page, at)) and m.start() < closed:
        at, tag, attributes = m.end(), m[2], m[3]
        if tag and not m[4]:
            at = _tag_end(page, m.end(2), last, dead)
            if at < 0:
                broken = _BROKEN.match(page, m.end(2))
                if not broken:
                    at = m.end(2)
                    continue
                at = broken.end()
            attributes = page[m.end(2):at - 1]
        tag = tag and tag.lower()
        if (tag in _RAW or tag in _UNSEEN) and attributes and attributes[0] != "/" and not attributes[0].isspace():
            tag += attributes[0]  # a longer name
        if tag in _RAW and not m[1]:
            if not attributes.endswith("/"):
                end = _RAW_END[tag].search(page, at)
                at = page.find(">", end.end()) + 1 if end else 0
                at = at or len(page)
            tag = None
        yield m.start(), at, tag, bool(m[1]), attributes
    if (start := page.find("<!--", at)) >= 0:
        yield start, len(page), None, False, ""


def blocks_of(page: str) -> list[Block]:
    out: list[Block] = []
    stack: list[tuple[str, str, bool]] = []
    aside, article, link, first = "", False, False, True
    held: list[tuple[str, bool]] = []
    opened: Counter[str] = Counter()    # elements without an end tag yet
    unseen, inside = "", Counter()      # the unseen element that the place lies in, and what is open inside it

    def flush():
        if held:
            parts = [(html.unescape(t) if "&" in t else t, a) for t, a in held]
            words = " ".join("".join(t for t, _ in parts).split())
            if words:
                n = words.count(" ") + 1
                linked = sum(len(t.split()) for t, a in parts if a)
                out.append(Block(words, n, min(linked, n), bool(aside), article))
            held.clear()

    at = 0
    for start, end, tag, closing, attributes in _tokens(page):
        if start > at and not unseen:
            held.append((page[at:start], link))
        at = end
        if tag is None:
            continue
        opening = not closing and tag not in _VOID and not attributes.endswith("/")
        if unseen:
            if not closing:
                inside[tag] += opening and not (tag == unseen and tag in ("button", "select"))  # these cannot nest
                continue
            if inside[tag]:
                inside[tag] -= 1
                continue
            if tag != unseen and not opened[tag]:
                continue
            ended, unseen = unseen, ""
            if tag == ended:
                continue
        if tag in _UNSEEN:
            if opening:
                unseen, inside = tag, Counter()
            continue
        if tag not in _HOLDS:
            opened[tag] += opening or -(closing and opened[tag] > 0)
        if tag == "a":
            link = not closing
        elif tag == "br":
            held.append((" ", False))
        elif tag in _BREAK:
            flush()
            if tag in _HOLDS:
                link = False
                if closing:
                    while opened[tag]:
                        held_tag, aside, article = stack.pop()
                        opened[held_tag] -= 1
                        if held_tag == tag:
                            break
                elif opening:
                    stack.append((tag, aside, article))
                    opened[tag] += 1
                    aside, article = _state(tag, attributes, aside, article, first)
                    first = first and tag not in ("article", "main")
    if at < len(page) and not unseen:
        held.append((page[at:], link))
    flush()
    return out


def features_of(blocks: list[Block]) -> np.ndarray:
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.linked / b.words for b in blocks], float)
    pad = lambda v: np.concatenate([[0.0], v, [0.0]])
    w, d = pad(words), pad(density)
    return np.column_stack([words, density, w[:-2], d[:-2], w[2:], d[2:],
                            [b.aside for b in blocks], [b.article for b in blocks]]) if blocks else np.zeros((0, len(FEATURES)))


# ---- decision tree ---------------------------------------------------------------

def train(x: np.ndarray, y: np.ndarray, depth: int = 6, least: int = 1) -> tuple:
    """CART by Gini impurity: ('leaf', share of kept) or (feature, cut, below, above)."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(y) < 2 * least:
        return ("leaf", share)
    best = (2 * share * (1 - share) * len(y) - 1e-9, None, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            below = x[:, f] < cut
            n = int(below.sum())
            if min(n, len(y) - n) < least:
                continue
            p, q = y[below].mean(), y[~below].mean()
            impurity = 2 * p * (1 - p) * n + 2 * q * (1 - q) * (len(y) - n)
            if impurity < best[0] - 1e-9:
                best = (impurity, f, float(cut))
    if best[1] is None:
        return ("leaf", share)
    below = x[:, best[1]] < best[2]
    return (best[1], best[2], train(x[below], y[below], depth - 1, least), train(x[~below], y[~below], depth - 1, least))


def predict(tree: tuple, x: np.ndarray) -> np.ndarray:
    if tree[0] == "leaf":
        return np.full(len(x), tree[1] > 0.5)
    out = np.zeros(len(x), bool)
    below = x[:, tree[0]] < tree[1]
    out[below] = predict(tree[2], x[below])
    out[~below] = predict(tree[3], x[~below])
    return out


def labelled(pages=PAGES) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the labelled pages' blocks."""
    x, y = [], []
    for page in pages:
        blocks = blocks_of(page)
        x.append(features_of(blocks))
        y += [b.text[0] == "+" for b in blocks]
    return np.concatenate(x), np.array(y, float)


@lru_cache(maxsize=1)
def default_tree() -> tuple:
    return train(*labelled())


def extract(pages: list[str], tree: tuple) -> list[str]:
    cut = [blocks_of(p) for p in pages]
    x = np.concatenate([features_of(b) for b in cut]) if cut else np.zeros((0, len(FEATURES)))
    kept = iter(predict(tree, x))
    return ["\n".join(b.text for b in blocks if next(kept)) for blocks in cut]


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", tree: tuple | None = None) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    tree = tree or default_tree()

    def kernel(texts):
        out = extract(texts, tree)
        return [out, [len(t) for t in out]]

    src = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    return append_columns(src, "html", [("text", pa.string(), "string"), ("n_chars", pa.int64(), "long")], kernel).drop("html")
