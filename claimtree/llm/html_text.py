"""Main text of web pages by tree scoring.

Paragraphs pass points for their length and commas to their ancestors, the parent in full and each further
one less; a container's points are discounted by the share of its text that is links. The container with
the most points is the article, and its siblings with enough points of their own belong to it. Parts that
are never article text (menus, notices, adverts, comments of readers) are left out before scoring. A part whose
name alone is doubtful stays if it holds over half of the page's points, and so does a form, which may span the
page, or a part that was never closed, which swallows what follows it.

Any text gives a tree: declarations and marked sections are comments, ``head`` ends where the body's content
begins, and end tags without a start are skipped. Every tag costs the same, however deep the page is.
"""

from __future__ import annotations

import re
from collections import defaultdict
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from claimtree.llm.common import small_batches

# Element names by what they mean in a page.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
DROPPED = frozenset(
    "script style noscript template head title nav aside footer button select textarea option iframe object svg "
    "canvas audio video dialog menu input map applet".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
    "sub sup time tt u var wbr ruby rt rp img".split()
)
PARAGRAPHS = frozenset("p pre blockquote td li dd h1 h2 h3 h4 h5 h6 figcaption".split())
# A paragraph ends where one of these begins.
CLOSES_P = frozenset(
    "p div ul ol dl table h1 h2 h3 h4 h5 h6 pre blockquote section article aside header footer nav form main figure hr "
    "address fieldset details".split()
)
SAME_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
SCOPES = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}}
# Names of parts that are never the article, however long, and names that an article's container can bear as well
# (social-science, search-engines, side-by-side): those are left out unless they hold most of the page's points.
JUNK_NAME = re.compile(
    r"(?:^|[-_\s])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:s|ed)?|banners?|cookies?|consent|gdpr|popups?|modals?|"
    r"overlays?|newsletters?|breadcrumbs?|comments?|comment(?:list|form|box)|repl(?:y|ies)|respond|disqus|login|signup|"
    r"pag(?:er|ination)|outbrain|taboola|skip-?link)"
    r"(?=$|[-_\s\d])",
    re.IGNORECASE,
)
DOUBTFUL_NAME = re.compile(
    r"(?:^|[-_\s])(?:advert\w*|sponsor\w*|promo(?:s|box|bar|tions?|tional)?|banner\w*|cookie\w*|notices?|notification\w*|alerts?|"
    r"popup\w*|modal\w*|overlay\w*|newsletter\w*|subscri\w*|shar(?:e|ing)(?:s|d|bar|box|this|buttons?|links?|icons?)?|social\w*|"
    r"related\w*|recommend\w*|sidebars?|side|menus?|nav\w*|foot|footers?|foot(?:er)?(?:bar|nav|links?|menu|text)|masthead|"
    r"site-?header|page-?header|top-?bar|header|comments?(?:area|section|wrap|wrapper|s|ers?)|"
    r"search(?:bar|box|form|field|input|results?)?|widgets?|toolbar|disclaimer|legal)"
    r"(?=$|[-_\s\d])",
    re.IGNORECASE,
)
JUNK_ROLES = frozenset(
    "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar status".split()
)
HIDDEN_STYLE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)
KEPT_TAGS = frozenset("html body article main".split())
# What a head may hold; anything else ends it.
HEAD_TAGS = frozenset("base basefont bgsound link meta title script style noscript template".split())
# Elements that need no end tag, so that a missing one says nothing.
OPEN_ENDED = frozenset("p li dt dd td th tr option thead tbody tfoot colgroup".split())

# Elements whose content is text up to their own end tag; without that end, the last two are like any other.
RAW = frozenset("script style xmp iframe noembed noframes textarea title".split())
TEXT_IF_OPEN = frozenset("textarea title".split())
# A tag with quoted values; longer ones end at the next sign that could end them.
TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>""")
OPEN_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>")
LONGEST_QUOTED = 1 << 16
ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]*+))?""")

BASE_POINTS, CHARS_A_POINT, MOST_LENGTH_POINTS = 1.0, 100, 3.0
LEAST_PARAGRAPH = 25
SIBLING_SHARE = 0.2


class Node:
    __slots__ = ("tag", "parent", "children", "junk", "points", "chars", "link_chars", "doubtful", "held", "depth")

    def __init__(self, tag: str, parent: Node | None, junk: bool, doubtful: bool = False):
        self.tag, self.parent, self.junk, self.doubtful = tag, parent, junk, doubtful
        self.children: list[Node | str] = []
        self.points = self.held = 0.0
        self.chars = self.link_chars = 0
        self.depth = 0 if parent is None else parent.depth + 1


def is_junk(tag: str, attributes: list[tuple[str, str | None]], inside_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not inside_article):
        return True
    for name, value in attributes:
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if value and (
            (name == "style" and HIDDEN_STYLE.search(value))
            or (name == "role" and value.lower() in JUNK_ROLES)
            or (name in ("class", "id") and tag not in KEPT_TAGS and JUNK_NAME.search(value))
        ):
            return True
    return False


def is_doubtful(tag: str, attributes: list[tuple[str, str | None]]) -> bool:
    if tag in KEPT_TAGS:
        return False
    if tag == "form":
        return True
    return any(name in ("class", "id") and value and DOUBTFUL_NAME.search(value) for name, value in attributes)


class Tree:
    """A forgiving tree: unclosed paragraphs, items and inline marks end where their block ends."""

    def __init__(self):
        self.root = self.at = Node("html", None, False)
        self.doubtful: list[Node] = []
        # Open elements by tag, and the open ones that are not inline, innermost last.
        self.open: dict[str, list[Node]] = defaultdict(list)
        self.blocks = [self.root]

    def read(self, html: str) -> None:
        """Reads the page from start to end; what does not end is text, so nothing is looked at twice."""
        at, missing = 0, set()  # ends that do not occur any more
        while at < len(html):
            start = html.find("<", at)
            if start < 0:
                break
            if start > at:
                self.handle_data(unescape(html[at:start]))
            if html.startswith("<!--", start):
                end = -1 if "-->" in missing else html.find("-->", start + 2)
                if end >= 0:
                    at = end + 3
                    continue
                missing.add("-->")
            after = html[start + 1 : start + 3]
            first = after[1:] if after[:1] == "/" else after[:1]
            is_tag = first.isascii() and first.isalpha()
            if not is_tag and after[:1] not in ("!", "?", "/"):
                self.handle_data("<")
                at = start + 1
                continue
            end = html.find(">", start)
            if end < 0:
                at = start
                break
            at = end + 1
            tag = (TAG.match(html, start, start + LONGEST_QUOTED) or OPEN_TAG.match(html, start)) if is_tag else None
            if tag is None:
                continue
            at, name = tag.end(), tag[2].lower()
            if tag[1]:
                self.handle_endtag(name)
                continue
            attributes = [(m[1].lower(), m[2] and unescape(m[2].strip("\"'"))) for m in ATTRIBUTE.finditer(tag[3])]
            self.handle_starttag(name, attributes)
            if name in RAW and name not in missing:
                close = re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE).search(html, at)
                if close is None:
                    missing.add(name)
                if close or name not in TEXT_IF_OPEN:
                    at = close.start() if close else len(html)
            elif tag[3].endswith("/") and name not in VOID:
                self.handle_endtag(name)
        self.handle_data(unescape(html[at:]))
        while self.at.parent is not None:
            self._leave(self.at)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.open["head"] and tag not in HEAD_TAGS:
            self._leave(self.open["head"][-1])
        if tag in CLOSES_P:
            self._end({"p"}, CLOSES_P - {"p"})
        if tag in SAME_ENDS:
            self._end(SAME_ENDS[tag], SCOPES.get(tag, {"select"}))
        if tag in VOID:
            if tag in ("br", "hr"):
                self.at.children.append("\n")
            return
        if tag in ("html", "body"):
            return
        inside_article = bool(self.open["article"] or self.open["main"])
        node = Node(tag, self.at, is_junk(tag, attrs, inside_article), is_doubtful(tag, attrs))
        if node.doubtful and not node.junk:
            self.doubtful.append(node)
        self.at.children.append(node)
        self.open[tag].append(node)
        if tag not in INLINE:
            self.blocks.append(node)
        self.at = node

    def _innermost(self, tags: set[str] | frozenset[str]) -> Node | None:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), key=lambda n: n.depth, default=None)

    def _end(self, tags: set[str], scopes: set[str] | frozenset[str]) -> None:
        node = self._innermost(tags)
        if node is None:
            return
        scope = self._innermost(scopes - tags)
        if scope is None or scope.depth < node.depth:
            self._leave(node)

    def _leave(self, node: Node, closed: bool = False) -> None:
        while True:
            left = self.at
            self.open[left.tag].pop()
            if self.blocks[-1] is left:
                self.blocks.pop()
            self.at = left.parent
            if left is node:
                break
            self._unclosed(left)
        if not closed:
            self._unclosed(node)

    def _unclosed(self, node: Node) -> None:
        """What a part without its end tag holds may be the rest of the page."""
        if node.junk and node.tag not in OPEN_ENDED and node.tag not in INLINE and node.tag != "head":
            node.junk = False
            self.doubtful.append(node)

    def handle_endtag(self, tag: str) -> None:
        if not self.open.get(tag):
            return
        node = self.open[tag][-1]
        if tag not in INLINE or self.blocks[-1].depth < node.depth:
            self._leave(node, closed=True)

    def handle_data(self, data: str) -> None:
        if self.at.tag == "head" and data.strip():
            self._leave(self.at)
        self.at.children.append(data)


def blocks_of(node: Node) -> list[str]:
    """Texts of the blocks below a node in page order, white space turned into single spaces."""
    found: list[str] = []
    run: list[str] = []

    def close() -> None:
        if text := " ".join("".join(run).split()):
            found.append(text)
        run.clear()

    stack: list = [iter([node])]
    ends: list[bool] = [False]
    while stack:
        for child in stack[-1]:
            if isinstance(child, str):
                run.append(child)
            elif not child.junk:
                block = child.tag not in INLINE
                if block:
                    close()
                stack.append(iter(child.children))
                ends.append(block)
                break
        else:
            stack.pop()
            if ends.pop():
                close()
    close()
    return found


def _ordered(root: Node) -> list[Node]:
    """Nodes that are not junk, parents before children."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        order.append(node)
        stack.extend(c for c in reversed(node.children) if isinstance(c, Node) and not c.junk)
    return order


def _score(order: list[Node]) -> None:
    for node in order:
        node.points, node.chars, node.link_chars, node.held = 0.0, 0, 0, 0.0
    # Length and commas of the text that inline elements pass up to their block.
    passed: dict[int, tuple[int, int]] = {}
    for node in reversed(order):
        own = "".join(c for c in node.children if isinstance(c, str))
        text = " ".join(own.split())
        node.chars += len(text)
        if node.tag == "a":
            node.link_chars = node.chars
        length, commas = passed.pop(id(node), (0, 0))
        length, commas = length + len(text) + 1, commas + text.count(",")
        if node.parent is not None:
            node.parent.chars += node.chars
            node.parent.link_chars += node.link_chars
            if node.tag in INLINE:
                before = passed.get(id(node.parent), (0, 0))
                passed[id(node.parent)] = (before[0] + length, before[1] + commas)
                continue
        # A block's own text, with that of the inline elements in it, is a paragraph if it is long enough.
        if length - 1 < LEAST_PARAGRAPH:
            continue
        points = BASE_POINTS + commas + min((length - 1) / CHARS_A_POINT, MOST_LENGTH_POINTS)
        node.held += points
        if node.tag not in PARAGRAPHS:
            node.points += points
        above, share = node.parent, 1.0
        while above is not None and share > 0.05:
            above.points += points * share
            above, share = above.parent, share / 2
    for node in order:
        node.points *= 1 - node.link_chars / max(1, node.chars)


def _drop_doubtful(tree: Tree) -> None:
    """Parts with a doubtful name become junk, save those that hold over half of the page's paragraph points."""
    if not tree.doubtful:
        return
    order = _ordered(tree.root)
    _score(order)
    for node in reversed(order):
        if node.parent is not None:
            node.parent.held += node.held
    for node in tree.doubtful:
        share = 1 - node.link_chars / max(1, node.chars)
        node.junk = node.held * share <= tree.root.held / 2


def main_text(html: str | None) -> str:
    """The article's blocks in page order, joined by single spaces; '' if there is none."""
    tree = Tree()
    tree.read(html or "")
    _drop_doubtful(tree)
    order = _ordered(tree.root)
    _score(order)
    best = max(order, key=lambda n: n.points)
    if best.points <= 0:
        best = next((n for n in order if n.tag in ("article", "main")), tree.root)
    # Points halve on the way up, but an article or main element around the best container is its whole.
    above = best
    while above is not None:
        if above.tag in ("article", "main"):
            best = above
            break
        above = above.parent
    parts = [best]
    if best.parent is not None and best.tag not in ("article", "main"):
        least = SIBLING_SHARE * best.points
        siblings = [c for c in best.parent.children if isinstance(c, Node) and not c.junk]
        parts = [c for c in siblings if c is best or c.points >= least or _is_paragraph(c)]
    return " ".join(text for part in parts for text in blocks_of(part))


def _is_paragraph(node: Node) -> bool:
    """A heading or a long paragraph beside the best container."""
    if node.tag in ("h1", "h2", "h3"):
        return True
    return node.tag in PARAGRAPHS and node.chars >= 80 and node.link_chars <= 0.25 * node.chars


def extracted(html: Column) -> Column:
    @F.pandas_udf("string")
    def run(pages: pd.Series) -> pd.Series:
        return pd.Series([main_text(h) for h in pages], dtype=object)

    return run(html)


def extract(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """All rows with the main text of ``html`` as ``text``.

    Character references are decoded, white space inside a block becomes one space, blocks are joined by one
    space in page order. A NULL or empty page, or one without article text, gives ''. Pages of any length or
    depth are read whole, each by itself; repeated rows are all returned. Other columns pass through; one
    named like ``text`` is replaced.
    """
    small_batches(pages.sparkSession)
    return pages.withColumn(text, extracted(F.col(html)))
