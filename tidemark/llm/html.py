"""Main text of a page: flat text blocks classified by a decision tree.

A page is cut in flat blocks of text between block-level tags.  A block is
described by its number of words and its link density, by those of its two
neighbours, and by the containers it stands in (Kohlschuetter et al., WSDM 2010,
for the shallow features).  A decision tree trained on the small labelled table
below tells main text from the rest.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices

# a quote opens only behind "=": an apostrophe in an unquoted value is a character of it
_TAG = re.compile(r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|"
                  r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+)*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/>\"']+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")

#: elements whose content is no text of the page
SILENT = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "object", "svg", "canvas",
          "select", "datalist", "audio", "video", "math", "button"}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript"}     # tags in these are text
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub",
          "sup", "time", "tt", "u", "var"}
#: containers that hold no main text, by tag, role or word of a class or id
ASIDE_TAGS = {"nav", "footer", "aside", "form", "menu", "dialog", "fieldset", "marquee"}
ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu", "menubar"}
ASIDE_WORDS = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored", "promo",
               "promotion", "banner", "sidebar", "side", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs",
               "footer", "header", "masthead", "topbar", "toolbar", "comment", "comments", "reply", "replies", "respond",
               "discussion", "disqus", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "popup", "modal",
               "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing", "social", "related",
               "recommended", "recommendations", "widget", "widgets", "pagination", "pager", "copyright", "legal", "disclaimer",
               "search", "skip", "print", "meta", "byline", "tags", "taglist", "rating", "hidden"}
MAIN_TAGS = {"article", "main"}
MAIN_ROLES = {"main", "article"}
MAIN_WORDS = {"article", "post", "entry", "story", "content", "main", "articlebody", "body", "prose"}
#: parts of a name after which it says what the page has or lacks, and ends that name a state, not a container
MARKERS = {"has", "no", "not", "with", "without", "show", "hide"}
STATES = {"open", "opened", "closed", "enabled", "disabled", "on", "off", "active", "inactive", "visible"}
FEATURES = ("words", "words before", "words behind", "link density", "link density before", "link density behind",
            "in a main container", "in an aside container")

#: the labelled table: pages whose blocks are marked, 1 for main text, in page order
LABELLED = (
    ("<header><a href=x>Site name</a></header><nav><ul><li><a href=1>Home</a></li><li><a href=2>News</a></li></ul></nav>"
     "<div class=ad>Buy our wonderful new shoes today and save a lot of money.</div><article><h1>A title of some words</h1>"
     "<p>The first paragraph says what happened and gives a reader more than ten words of it.</p><p>So it goes.</p><p>Yes.</p>"
     "</article><footer>All rights reserved by the publisher of this site, since the year it began.</footer>",
     (0, 0, 0, 0, 1, 1, 1, 1, 0)),
    ("<div id=top><a href=/>Start</a> <a href=/a>About</a></div><div id=text><h2>Heading here</h2><p>A long paragraph without any "
     "container that would name it, of which the words alone tell that it is the text a reader came for.</p><p>Another long "
     "paragraph follows it, and again there are many words and not a single link in any of them.</p></div>"
     "<div id=end><a href=/b>Imprint</a> <a href=/c>Contact</a></div>", (0, 1, 1, 1, 0)),
    ("<main><h1>Short title</h1><p>Some words with <a href=q>one link</a> among many others that make a paragraph of text.</p>"
     "<ul><li>First point of the list</li><li>Second</li></ul><aside>Read also what we wrote last week about the very same "
     "matter and its end.</aside><p>Last words.</p><div class=comments><p>I think that this is a very good article and I want to "
     "read more of them.</p><p>Me too</p></div></main>", (1, 1, 1, 1, 0, 1, 0, 0)),
    ("<div class='cookie notice'>We use cookies so that this site can work, please accept all of them now.</div><div class=post>"
     "<p>One.</p><p>Two words.</p><p>And then a third paragraph, which has quite a lot of words in it, all plain.</p></div><form>"
     "Enter your address here to get our letter every week <input> and press the button</form><div class=share>Tell your "
     "friends</div>", (0, 1, 1, 1, 0, 0)),
    ("<table><tr><td><a href=1>One</a></td><td><a href=2>Two</a></td></tr></table><p>Plain page of the old kind with a paragraph "
     "of text that has no container at all but is long enough to be what the page is about.</p><p><a href=n>Next page of this "
     "long list of many pages</a></p><p>Updated today</p>", (0, 0, 1, 0, 0)),
    ("<article><p>Only text in an article, and a good deal of it, so that nobody has to guess.</p><nav><a href=1>Previous</a> "
     "<a href=2>Next</a></nav><p>It ends here.</p><footer>Filed under things</footer></article><div class=sidebar><p>Popular "
     "articles that others have read on this site during the last days.</p></div>", (1, 0, 1, 0, 0)),
    ("<article class=comment><p>A comment may be an article too, and it may well be long, but it is none of the page.</p>"
     "</article><div class=content><p>Word</p></div><div>Log in</div><div>12 March</div>", (0, 1, 0, 0)),
    ("<article><h1>Title</h1></article>", (1,)),
    ("<article><p>Short.</p><p>The whole page is this article, and it ends with a word or two.</p><p>The end</p></article>", (1, 1, 1)),
    ("<main><p>It begins here.</p><p>On</p></main>", (1, 1)),
    ("<div>Menu</div><article><p>Two words</p><p>Three short words</p></article>", (0, 1, 1)),
    ("<p>This page has nothing around its only paragraph, which is as long as a paragraph should be.</p>", (1,)),
    ("<div>Note</div><article>A</article>", (0, 1)),
    ("<article><p>Some text that a reader came for, and at its end a list of links to other pages.</p><ul><li><a href=1>First "
     "other page</a></li><li><a href=2>Second other page with a longer name</a></li></ul></article>", (1, 0, 0)),
)


@dataclass
class Block:
    text: str
    words: int
    linked: int
    main: bool
    aside: bool


@dataclass
class Box:
    """An element: what it is by its tag, role and names, and the one around it."""
    tag: str
    main: bool = False
    aside: bool = False
    named: bool = False      # aside by a name, or a form: not if it turns out to hold the page
    sure: bool = False       # main by its tag or role
    around: Box | None = None
    known: bool = False      # not aside by its name after all, nor any around it
    in_main: bool = False    # with those around it
    in_aside: bool = False
    any_aside: bool = False


def _kind(token: str, tag: str) -> str:
    """"aside", "main" or "" for one class or id."""
    parts = re.split(r"[_-]+", token)
    for k, part in enumerate(parts):
        if part in MARKERS:
            parts = parts[:k]
            break
    if not parts or len(parts) > 1 and parts[-1] in STATES:
        return ""
    main = bool(MAIN_WORDS.intersection(parts))
    if "header" in parts and (main or tag == "header"):     # the header of a text; a header's place decides about it
        parts = [x for x in parts if x != "header"]
    return "aside" if ASIDE_WORDS.intersection(parts) else "main" if main else ""


def _box(tag: str, attributes: str) -> Box:
    if tag in ("html", "body"):          # names there tell the kind of page
        return Box(tag)
    role, kinds, hidden = "", set(), False
    if attributes and ("class" in (low := attributes.lower()) or "id" in low or "role" in low or "hidden" in low or "style" in low):
        for m in _ATTRIBUTE.finditer(low):
            key, value = m[1], m[2] or m[3] or m[4] or ""
            if key == "role":
                role = value.strip()
            elif key in ("class", "id"):
                kinds.update(_kind(x, tag) for x in value.split())
                hidden = hidden or "hidden" in value.split()
            elif key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value):
                hidden = True
        hidden = hidden or bool(re.search(r"(?:^|\s)hidden(?:\s|$)", re.sub(_ATTRIBUTE, " ", low)))
    fixed = hidden or tag in ASIDE_TAGS - {"form"} or role in ASIDE_ROLES - {"form"}
    aside = fixed or tag == "form" or role == "form" or "aside" in kinds
    sure = not aside and (tag in MAIN_TAGS or role in MAIN_ROLES)
    return Box(tag, sure or not aside and "main" in kinds, aside, aside and not fixed, sure)


def blocks(page: str | None) -> list[Block]:
    """The flat text blocks of a page, in page order; null and empty pages have none.

    Unclosed elements end with the element around them, a paragraph also with the next
    one; a page that breaks off ends all of them.  An element that is aside by name only is not
    if it holds the page's main element, or all of its articles, or all of its text."""
    found: list[Block] = []
    page = page or ""
    stack: list[Box] = []                           # open elements, nearest last
    opened: Counter[str] = Counter()                # by tag
    boxes: list[Box] = []                           # all elements, each behind the one around it
    around: list[Box | None] = []                   # the innermost of each block
    sure: list[Box] = []                            # main elements and articles
    endless: set[str] = set()                       # silent tags of which no end follows
    pieces: list[str] = []
    linked: list[str] = []
    in_link = False

    def clear(box: Box | None) -> None:
        while box and not box.known:
            box.aside, box.known = box.aside and not box.named, True
            box = box.around

    def sum_up() -> None:
        """What is around each element.  The innermost of main and aside decides about a
        header: a page's header is aside, an article's is not."""
        outer = Box("")
        for box in boxes:
            up = box.around or outer
            box.any_aside = up.any_aside or box.aside
            box.in_main = up.in_main or box.main
            box.in_aside = up.in_aside or box.aside or (box.tag == "header" and not up.in_main)

    def drop(k: int) -> None:
        opened.subtract(box.tag for box in stack[k:])
        del stack[k:]

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        if text:
            around.append(stack[-1] if stack else None)
            found.append(Block(text, text.count(" ") + 1, len("".join(linked).split()), False, False))
        pieces.clear()
        linked.clear()

    def say(raw: str) -> None:
        text = html.unescape(raw)
        pieces.append(text)
        if in_link:
            linked.append(text)

    at = 0
    while at < len(page):
        m = _TAG.search(page, at)
        if not m:
            say(page[at:])
            break
        if m.start() > at:
            say(page[at:m.start()])
        at = m.end()
        closing, tag = m[1], (m[2] or "").lower()
        if not tag:                                   # comment or declaration
            continue
        if tag == "br":
            say(" ")
        elif tag == "a":
            in_link = not closing
        elif tag in SILENT:
            if not closing and not m[3].rstrip().endswith("/"):
                end = None if tag in endless else re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                if not end:
                    endless.add(tag)
                if end or tag in RAW:
                    at = end.end() if end else len(page)
        elif tag in VOID:
            if tag == "hr":
                flush()
        elif closing:
            if tag not in INLINE:
                flush()
            for k in range(len(stack) - 1, -1, -1) if opened[tag] else ():
                if stack[k].tag == tag:
                    flush()
                    drop(k)
                    in_link = in_link and tag in INLINE
                    break
        else:
            box = _box(tag, m[3])
            if tag in INLINE and not box.aside:
                continue
            flush()
            if tag not in INLINE:
                in_link = False
                if stack and stack[-1].tag == "p":
                    drop(-1)
                if tag in ("li", "dd", "dt", "tr", "td", "th", "option") and stack and stack[-1].tag == tag:
                    drop(-1)
            box.around = stack[-1] if stack else None
            stack.append(box)
            boxes.append(box)
            opened[tag] += 1
            if box.sure:
                sure.append(box)
    flush()
    for box in sure:
        if box.tag == "main":
            clear(box)
    for those in (sure, around):
        sum_up()
        if all(box is not None and box.any_aside for box in those):
            for box in those:
                clear(box)
    sum_up()
    for block, box in zip(found, around):
        block.main, block.aside = (box.in_main, box.in_aside) if box else (False, False)
    return found


def table_of(found: list[Block]) -> np.ndarray:
    """Features of every block, in the order of ``FEATURES``."""
    own = np.array([(b.words, b.linked / b.words) for b in found], float).reshape(-1, 2)
    before = np.concatenate([np.zeros((1, 2)), own[:-1]]) if len(own) else own
    behind = np.concatenate([own[1:], np.zeros((1, 2))]) if len(own) else own
    around = np.array([(b.main, b.aside) for b in found], float).reshape(-1, 2)
    return np.column_stack([own[:, 0], before[:, 0], behind[:, 0], own[:, 1], before[:, 1], behind[:, 1], around])


def grow(x: np.ndarray, y: np.ndarray, depth: int = 6):
    """A binary tree by Gini impurity: a leaf is its share of main blocks, an inner node
    (feature, threshold, low side, high side)."""
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0):
        return share
    best = None
    # container features first, so that they win ties against chance splits of word counts
    for f in (*range(6, x.shape[1]), *range(6)):
        values = np.unique(x[:, f])
        for t in (values[:-1] + values[1:]) / 2:
            low = x[:, f] < t
            cost = sum(part.sum() * (1 - part.mean()) for part in (y[low], y[~low]))
            if best is None or cost < best[0] - 1e-9:
                best = (cost, f, float(t), low)
    if best is None:
        return share
    _, f, t, low = best
    return f, t, grow(x[low], y[low], depth - 1), grow(x[~low], y[~low], depth - 1)


def train():
    found = [blocks(page) for page, _ in LABELLED]
    return grow(np.concatenate([table_of(b) for b in found]),
                np.concatenate([np.array(marks, float) for _, marks in LABELLED]))


def is_main(tree, row) -> bool:
    while isinstance(tree, tuple):
        f, t, low, high = tree
        tree = low if row[f] < t else high
    return tree >= 0.5


def main_text(page: str | None, tree) -> str:
    found = blocks(page)
    return " ".join(b.text for b, row in zip(found, table_of(found).tolist()) if is_main(tree, row))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """One row per row of ``pages``: (page_id, url, text), the main text of the whole page.

    Null and empty pages, and pages without main text, give ""; a repeated row gets a
    repeated result; an empty table gives no row.  Other columns are not read."""
    tree = train()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "h"):
                texts = [main_text(h, tree) for h in piece.column("h").to_pylist()]
                yield pa.RecordBatch.from_arrays([piece.column("page_id"), piece.column("url"), pa.array(texts, pa.string())],
                                                 ["page_id", "url", "text"])
    three = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("h"))
    return three.mapInArrow(run, "page_id long, url string, text string")
