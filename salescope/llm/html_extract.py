"""Main text of HTML pages by tree scoring.

Each paragraph passes points for its length and commas to its ancestors (all
to the parent, less to those above); a container's points are discounted by
its link density.  The best container and those of its siblings that score
near it, or read like its text, are kept; their blocks are joined in page
order.  Parts that are not article text by their element, role or class name
(menus, headers and footers, sidebars, notices, adverts, forms, comments) are
left out before scoring.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("script style noscript template textarea title iframe noembed noframes xmp".split())
#: Elements that are never article text.
_DROPPED = frozenset(
    "nav aside footer form button select option label fieldset dialog menu svg canvas object audio video head math "
    "script style noscript template textarea title iframe noembed noframes".split()
)
_ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong "
    "sub sup time tt u var wbr img".split()
)
#: Elements whose start ends an open paragraph.
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hgroup hr main menu nav ol p pre section summary table ul li dt dd".split()
)
_SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
_SCOPE = frozenset("ul ol dl table tbody thead tfoot article section div main body html td th tr".split())
#: Words of a class or id that name what is not the article, and words that name the article.
_BAD_NAME = re.compile(
    r"(?:^|[\s_-])(?:ad|ads|advert\w*|sponsor\w*|promo\w*|banner|comments?|commentlist|disqus|replies|respond|sidebar|aside|widget|"
    r"nav|navbar|navigation|menu|breadcrumbs?|pagination|pager|footer|header|masthead|cookies?|consent|gdpr|notice|alert|popup|modal|"
    r"newsletter|subscribe|signup|login|share|sharing|social|related|recommend\w*|outbrain|taboola|toolbar|skip|search|tags|byline)(?=$|[\s_-])",
    re.I,
)
_GOOD_NAME = re.compile(r"(?:^|[\s_-])(?:article|post|entry|content|main|story|body|text|page)(?=$|[\s_-])", re.I)
#: Reader comments; heads (an article's own head is part of it); containers that
#: are named after what lies beside their text; the seams of joined words.
_COMMENT_NAME = re.compile(r"(?:^|[\s_-])(?:comments?|commentlist|disqus|replies|reply)(?=$|[\s_-])", re.I)
_HEAD_NAME = re.compile(r"(?:^|(?<=[\s_-]))(?:header|masthead)(?=$|[\s_-])", re.I)
_LAYOUT = re.compile(r"(?:^|(?<=[\s_-]))(?:has|with|without|no)[_-](?:[a-z]+[_-])?(?:sidebar|aside|widgets?|menu|nav|header|footer|comments?|ads?|banner)(?=$|[\s_-])", re.I)
_HUMP = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_BLANK = re.compile(r"\s+")
_COMMA = re.compile(r"[,،、，]")


class _Node:
    __slots__ = ("tag", "parent", "children", "name", "dropped", "points", "chars", "linked")

    def __init__(self, tag: str, parent: _Node | None, name: str = "", dropped: bool = False):
        self.tag, self.parent, self.name, self.dropped = tag, parent, name, dropped
        self.children: list = []
        self.points, self.chars, self.linked = 0.0, 0, 0


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        found.setdefault(m[1].lower(), entities.unescape(m[2] or m[3] or m[4] or ""))
    return found


def _is_noise(tag: str, source: str, stack: list[_Node], strict: bool) -> tuple[str, bool]:
    """The element's class and id, and whether it is left out.  A word that
    names what is not the article wins over one that names the article, unless
    ``strict`` is off."""
    inside = any(n.tag in ("article", "main") for n in stack)
    if tag in _DROPPED or tag == "header" and not inside:
        return "", True
    if not source.strip():
        return "", False
    found = _attributes(source)
    name = f"{found.get('class', '')} {found.get('id', '')}".strip()
    if tag in ("html", "body", "main"):
        return name, False
    said = _LAYOUT.sub(" ", _HUMP.sub("-", name))
    if tag == "article":
        return name, bool(_COMMENT_NAME.search(said))
    if "hidden" in found or found.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", ""), re.I):
        return name, True
    if inside:
        said = _HEAD_NAME.sub(" ", said)
    bad = bool(_BAD_NAME.search(said)) and (strict or not _GOOD_NAME.search(said))
    return name, found.get("role", "").lower() in _ROLES or bad


def parse(source: str, strict: bool = True) -> _Node:
    """The page's tree; text children are strings.  Unclosed and stray tags
    are accepted as browsers do in the common cases."""
    root = _Node("#root", None)
    stack = [root]
    at, end = 0, len(source)

    def text(piece: str) -> None:
        if piece and not any(n.dropped for n in stack[-1:]):
            stack[-1].children.append(entities.unescape(piece))

    def close(tags: tuple[str, ...], scope: frozenset[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                del stack[i:]
                return
            if stack[i].tag in scope:
                return

    while at < end:
        m = _TOKEN.search(source, at)
        if not m:
            text(source[at:])
            break
        text(source[at : m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
        if not tag:
            if m[0].startswith("<![CDATA["):
                text(m[0][9:].removesuffix("]]>"))
            continue
        tag = tag.lower()
        if closing:
            close((tag,), frozenset() if tag in _SCOPE else frozenset(("td", "th", "body")))
            continue
        if tag in _ENDS_P:
            close(("p",), frozenset(("td", "th", "button", "body", "article", "section", "div", "main")))
        if tag in _SELF_CLOSING:
            close(_SELF_CLOSING[tag], frozenset(("ul", "ol", "dl", "table", "select")))
        name, noise = _is_noise(tag, attributes, stack, strict)
        node = _Node(tag, stack[-1], name, noise or stack[-1].dropped)
        if not node.dropped:
            stack[-1].children.append(node)
        if tag in _RAW:
            stop = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(source, at)
            at = stop.end() if stop else end
        elif tag not in _VOID and not attributes.rstrip().endswith("/"):
            stack.append(node)
    return root


def _measure(root: _Node) -> list[_Node]:
    """All nodes, children before parents, with text and link lengths."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += [c for c in node.children if isinstance(c, _Node)]
    order.reverse()
    for node in order:
        for c in node.children:
            if isinstance(c, str):
                node.chars += len(_BLANK.sub(" ", c).strip())
            else:
                node.chars += c.chars
                node.linked += c.linked
        if node.tag == "a":
            node.linked = node.chars
    return order


def _density(node: _Node) -> float:
    return node.linked / node.chars if node.chars else 0.0


def _words(node: _Node) -> str:
    out, todo = [], [node]
    while todo:
        c = todo.pop()
        if isinstance(c, str):
            out.append(c)
        else:
            todo += reversed(c.children)
    return "".join(out)


def blocks(nodes: list[_Node]) -> list[str]:
    """Texts of the blocks under ``nodes``, in page order."""
    out: list[str] = []
    line: list[str] = []

    def end_block() -> None:
        joined = _BLANK.sub(" ", "".join(line)).strip()
        line.clear()
        if joined:
            out.append(joined)

    todo: list = list(reversed(nodes))
    while todo:
        c = todo.pop()
        if c is None:
            end_block()
        elif isinstance(c, str):
            line.append(c)
        elif c.tag in _INLINE:
            todo += reversed(c.children)
        elif c.tag == "br":
            line.append(" ")
        else:
            end_block()
            todo.append(None)
            todo += reversed(c.children)
    end_block()
    return out


def best_container(root: _Node) -> list[_Node]:
    """The best container with its kept siblings, in page order."""
    order = _measure(root)
    for node in order:
        if node.tag not in ("p", "pre", "td", "blockquote", "li", "dd") and not any(isinstance(c, str) and c.strip() for c in node.children):
            continue
        if node.tag in _INLINE or node.parent is None or not node.chars:
            continue
        said = _words(node) if node.tag != "#root" else ""
        length = len(_BLANK.sub(" ", said).strip())
        if length < 1:
            continue
        points = (1 + len(_COMMA.findall(said)) + min(length / 100, 3)) * (1 - _density(node))
        if length < 25:
            points = points / 4
        share, above = 1.0, node.parent
        level = 0
        while above is not None and level < 4:
            above.points += points * share
            level += 1
            share = 1 / 2 if level == 1 else 1 / (3 * level)
            above = above.parent
    for node in order:
        if node.tag in ("article", "main"):
            node.points += 25
        elif node.tag in ("ul", "ol", "dl", "li", "address"):
            node.points -= 3
        if _GOOD_NAME.search(node.name):
            node.points += 10
        node.points *= 1 - _density(node)
    scored = [n for n in order if n.points > 0 and n.tag not in _INLINE]
    if not scored:
        return [root]
    best = max(reversed(scored), key=lambda n: n.points)
    if best.tag in ("p", "pre", "blockquote", "li", "td") and best.parent is not None:
        best = best.parent
    # what is no noise in an article is part of it, however short
    for wanted in ("article", "main"):
        above, top = best, None
        while above is not None and top is None:
            top, above = (above if above.tag == wanted else None), above.parent
        if top is not None:
            top.points = max(top.points, best.points)
            best = top
            break
    if best.parent is None:
        return [best]
    least = max(10.0, 0.2 * best.points)
    kept = []
    for c in best.parent.children:
        if c is best:
            kept.append(c)
        elif isinstance(c, _Node):
            same = 0.2 * best.points if c.name and c.name == best.name else 0.0
            if c.points + same >= least or c.tag == "p" and c.chars > 80 and _density(c) < 0.25:
                kept.append(c)
    return kept


def extract(source: str) -> str:
    """Main text of one page.  If the names of its elements leave nothing, those
    that also name the article count as article."""
    if not source:
        return ""
    return " ".join(blocks(best_container(parse(source)))) or " ".join(blocks(best_container(parse(source, False))))


def main_text(pages: DataFrame) -> DataFrame:
    """``pages`` (an ``html`` column and any others) with ``text`` and
    ``n_chars`` instead of ``html``.

    Every row is parsed alone and whole, so no row needs another: a narrow map
    with memory bounded by the longest page.  A null page counts as empty; a
    page without text gives an empty string.  The new columns replace columns
    of their names; an empty table stays empty.
    """
    rest = [c for c in pages.columns if c not in ("html", "text", "n_chars")]
    schema = pages.select(*rest).withColumns({"text": F.lit(""), "n_chars": F.lit(0).cast("long")}).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [extract(h) for h in batch.column(len(rest)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(rest)], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names=[*rest, "text", "n_chars"],
            )

    return pages.select(*rest, "html").mapInArrow(run, schema)
