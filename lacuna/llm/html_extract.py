"""Main text of web pages by tree scoring.

Each block of text (paragraph, heading, list item, ...) has points for its length and commas. The points go to its
parent in full and to the ancestors above at falling shares; an element's score is what it received, discounted by
the share of its text that stands in links. The container is the article or main element around the best element, or else
what is around it up to the last level with more of the article; beside the best element, headings and bare text
included, only what consists of links is left out. Elements that by their tag, class or id are menus,
headers, footers, sidebars, notices, adverts, forms, scripts, styles or reader comments take no part, unless the page's
prose is in them: see ``rescue``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame

from lacuna.functions.columns import ref

ROWS = 500

#: HTML element groups.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math xmp noembed noframes".split())
DROPPED = frozenset("head nav header footer aside form button select option dialog menu canvas object audio video map "
                    "label fieldset".split()) | RAW
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer "
                  "form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
                  "thead tr ul caption".split())
CLOSES_P = BLOCK - {"html", "body", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
#: Elements that end an open element of their own group, up to the nearest of the listed containers.
IMPLIED = {"li": ({"li"}, {"ul", "ol", "menu"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
           "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
           "option": ({"option"}, {"select"})}
INLINE_STOP = frozenset("table td th caption button html body article section div aside nav header footer form main li".split())

#: Words in a class or id that tell what an element is, and words that may follow them.
_WORDS = ("ads?|advert[^\\W_]*|adsense|sponsor[^\\W_]*|promo[^\\W_]*|banner|comments?|respond|discuss[^\\W_]*|disqus|replies|sidebar|side|menu|nav|navbar|"
          "navigation|breadcrumbs?|header|masthead|footer|foot|cookies?|notices?|consent|gdpr|popup|modal|newsletter|subscribe|"
          "shar(?:e|ing)|social|related|recommend[^\\W_]*|widget|login|signup|form|toolbar|pager|pagination")
_PARTS = "list|section|area|box|wrap|wrapper|container|block|inner|content|body|text|items?|links?|group|row|slot|unit|bar|left|right|top|bottom|\\d+"
_BEFORE = r"(?:(?!(?:has|with|no|without)[-_])[^\W_]+[-_]+)*?"
_NEGATIVE = re.compile(rf"{_BEFORE}(?P<word>{_WORDS})(?:[-_](?:{_PARTS}))*", re.I)
_COMMENT = re.compile(rf"{_BEFORE}(?P<word>comments?|reply|replies|response)(?:[-_]+[^\W_]+)*", re.I)
#: What never is an article: what cannot hold one, and what holds one only if it has a heading or element of its own for it.
_EMPTY = RAW | frozenset("head button select option canvas object audio video map label".split())
_APART = re.compile(r"nav|menu|navbar|navigation|breadcrumbs?|ads?|advert.*|adsense|sponsor.*|promo.*|comments?|reply|replies|response|respond|"
                    r"discuss.*|disqus|cookies?|consent|gdpr|notices?|newsletter|subscribe|login|signup|alert|search|dialog", re.I)
_WRAPPERS = frozenset(("form", "fieldset", "widget"))  # elements put around anything
LEAST_PROSE, LITTLE_PROSE, MUCH_PROSE = 2.0, 4.0, 4  # points of a text to rescue, of little text, and how much more is much
_ROLE = frozenset(("navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"))
#: A quote opens a value only right behind ``=``; elsewhere it is a character like any other.
_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>=]++|=\s*+(?>\"[^\"]*\"|'[^']*')?+)*+)>", re.S)
_LOOSE_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|$)", re.S)
_ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
_SPACE = re.compile(r"\s+")
_STRONG = frozenset(("article", "main"))
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
LINKS = 0.5  # share of linked text from which something consists of links


class Node:
    __slots__ = ("tag", "parent", "children", "why", "dropped", "score", "chars", "linked", "holder")

    def __init__(self, tag: str, parent: Node | None, why: frozenset[str]) -> None:
        self.tag, self.parent, self.why = tag, parent, why
        self.dropped = bool(why)  # with all that is below it
        self.children: list[Node | str] = []
        self.score, self.chars, self.linked = 0.0, 0, 0
        self.holder: Node = self if parent is None or tag in BLOCK else parent.holder  # the block around an inline element


def _unwanted(tag: str, attributes: str) -> frozenset[str]:
    """What tells that an element is unwanted: its tag, role or words of its class and id; empty for others."""
    why = {tag} if tag in DROPPED else set()
    if tag in _EMPTY or not attributes or tag in ("html", "body"):
        return frozenset(why)
    negative = _COMMENT if tag in _STRONG else _NEGATIVE
    for name, *values in _ATTRIBUTE.findall(attributes):
        value = "".join(values).strip()
        name = name.lower()
        if name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            why.add("hidden")
        elif name == "role" and value.lower() in _ROLE:
            why.add(value.lower())
        elif name in ("class", "id"):
            why.update(m["word"].lower() for word in value.split() if (m := negative.fullmatch(word)))
    return frozenset(why)


def parse(html: str) -> Node:
    """Element tree of a page, however badly and deeply it nests; text stays undecoded."""
    root = Node("html", None, frozenset())
    top, at, end = root, 0, len(html)
    opened = Counter({"html": 1})  # elements that are open, by tag

    def open_(node: Node) -> None:
        nonlocal top
        opened[node.tag] += 1
        top = node

    def close(node: Node) -> None:
        """Close the open elements from the innermost one to ``node``."""
        nonlocal top
        while True:
            opened[top.tag] -= 1
            done, top = top is node, top.parent
            if done:
                return

    def nearest(tags: frozenset | set, stops: frozenset | set) -> Node | None:
        """The nearest open element of ``tags`` below ``stops``; the root is none."""
        if not any(opened[t] for t in tags):
            return None
        n = top
        while n.parent is not None and n.tag not in stops:
            if n.tag in tags:
                return n
            n = n.parent
        return None

    while at < end:
        lt = html.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            top.children.append(html[at:lt])
            at = lt
        if lt == end:
            break
        m = _TOKEN.match(html, lt) or _LOOSE_TAG.match(html, lt)
        if m is None:
            top.children.append("<")
            at = lt + 1
            continue
        at = max(m.end(), lt + 1)
        if not m[2]:
            continue  # comment or declaration
        tag = m[2].lower()
        if m[1]:
            if tag == "p":
                n = nearest({"p"}, INLINE_STOP)
            elif opened[tag]:
                n = top
                while n is not None and n.tag != tag:
                    n = n.parent
            else:
                n = None
            if n is not None and n.parent is not None:
                close(n)
            continue
        if tag == "html" and root.children:
            continue
        if tag in CLOSES_P and (n := nearest({"p"}, INLINE_STOP)) is not None:
            close(n)
        if tag in IMPLIED:
            tags, stops = IMPLIED[tag]
            while (n := nearest(tags, stops)) is not None:
                close(n)
        node = Node(tag, top, _unwanted(tag, m[3] or ""))
        top.children.append(node)
        if tag in RAW:
            stop = re.compile(rf"</{re.escape(tag)}[^>]*>?", re.I).search(html, at)
            at = stop.end() if stop else end
        elif tag not in VOID and not (m[3] or "").endswith("/"):
            open_(node)
    return root


def blocks_of(node: Node) -> list[str]:
    """Text of the blocks below a node in page order, decoded, white space made single."""
    out: list[str] = []
    run: list[str] = []

    def flush() -> None:
        text = _SPACE.sub(" ", unescape("".join(run))).strip()
        if text:
            out.append(text)
        run.clear()

    stack: list[tuple[Node, int]] = [(node, 0)]
    while stack:
        n, k = stack.pop()
        if k == 0 and n.tag in BLOCK:
            flush()
        while k < len(n.children):
            child = n.children[k]
            k += 1
            if isinstance(child, str):
                run.append(child)
            elif child.tag in ("br", "wbr"):
                run.append(" " if child.tag == "br" else "")
            elif not child.dropped:
                stack.append((n, k))
                stack.append((child, 0))
                break
        else:
            if n.tag in BLOCK:
                flush()
    flush()
    return out


def _points(chars: int, commas: int) -> float:
    return min(chars / 100, 30.0) + commas + (1.0 if chars >= 25 else 0.0)


def keep_titles(root: Node) -> None:
    """Keep the header of an article that holds a heading: it is the article's own, with its title, and not the page's."""
    stack: list[tuple[Node, bool, Node | None]] = [(root, False, None)]
    while stack:
        n, inside, header = stack.pop()
        if n.why == {"header"} and inside:
            header = n
        elif n.dropped:
            continue
        elif header is not None and n.tag in _HEADINGS:
            header.dropped = False
        inside = inside or n.tag == "article"
        stack += [(c, inside, header) for c in n.children if not isinstance(c, str)]


def rescue(root: Node) -> None:
    """Keep unwanted-looking elements that hold the article.

    Elements of the same looks are judged together, outermost first, by the points of the unlinked prose in them. Forms and
    widgets are kept if they hold more of it than is left outside of all unwanted elements; others if little is left
    there, and much more is in them; menus, notices, adverts and reader comments also need an article of their own in them.
    """
    while True:
        outside = 0.0
        held: dict[frozenset[str], list] = {}  # points, and whether an article or a first heading is in them
        stack: list[tuple[Node, Node | None]] = [(root, None)]
        while stack:
            n, top = stack.pop()
            if n.tag in _EMPTY or n.tag == "a":
                continue
            if n.dropped:
                if top is None:
                    top = n
                    held.setdefault(n.why, [0.0, False])
                elif any(_APART.fullmatch(w) for w in n.why):
                    continue
            if top is not None and (n.tag in ("h1", "main") or n.tag == "article" and not n.why):
                held[top.why][1] = True
            texts = [c for c in n.children if isinstance(c, str)]
            chars = sum(len(t.strip()) for t in texts)
            if chars >= 25:
                points = _points(chars, sum(t.count(",") for t in texts))
                if top is None:
                    outside += points
                else:
                    held[top.why][0] += points
            stack += [(c, top) for c in n.children if not isinstance(c, str)]
        for why, (points, article) in sorted(held.items(), key=lambda x: (-x[1][0], sorted(x[0]))):
            wrapper = why <= _WRAPPERS
            much = points > outside if wrapper else outside < LITTLE_PROSE and points > MUCH_PROSE * outside
            if points >= LEAST_PROSE and much and (article or not any(_APART.fullmatch(w) for w in why)):
                break
        else:
            return
        nodes = [root]
        while nodes:
            n = nodes.pop()
            if n.why == why:
                n.dropped = False
            nodes += [c for c in n.children if not isinstance(c, str)]


def score(root: Node) -> list[Node]:
    """Give points to every wanted element, children before parents; returns them in page order."""
    order, stack = [], [(root, False)]
    while stack:
        n, linked = stack.pop()
        order.append(n)
        own = 0
        commas = 0
        for child in n.children:
            if isinstance(child, str):
                text = child.strip()
                own += len(text)
                commas += text.count(",")
            elif not child.dropped:
                stack.append((child, linked or child.tag == "a"))
        n.chars, n.linked = own, own if linked else 0
        points = 0.0 if linked or not own else _points(own, commas)
        # Inline elements hand their text's points to the block around them.
        share, up = 1.0, n.holder.parent or n.holder
        while up is not None and points and share > 0.05:
            up.score += points * share
            share *= 0.5 if share == 1.0 else 0.6
            up = up.parent
    for n in reversed(order):
        if n.parent is not None:
            n.parent.chars += n.chars
            n.parent.linked += n.linked
    for n in order:
        if n.tag in _STRONG:
            n.score = n.score * 1.5 + 10
        n.score *= 1 - (n.linked / n.chars if n.chars else 0)
    return order


def main_text(html: str | None) -> str:
    """The page's article: blocks joined by an empty line; empty for NULL, empty and pages without text."""
    if not html:
        return ""
    root = parse(html)
    keep_titles(root)
    rescue(root)
    order = score(root)
    best = max(order, key=lambda n: n.score)
    if best.parent is None or best.tag in ("body", "html") or best.score <= 0:
        return "\n\n".join(blocks_of(best))
    return "\n\n".join(blocks_of(container(best)))


def units(node: Node) -> list[list[Node | str]]:
    """An element's wanted children: blocks alone, inline elements and bare text between two blocks together."""
    out: list[list[Node | str]] = []
    run: list[Node | str] | None = None
    for child in node.children:
        if isinstance(child, str) or child.tag not in BLOCK and not child.dropped:
            if run is None:
                out.append(run := [])
            run.append(child)
        elif not child.dropped:
            out.append([child])
            run = None
    return out


def _chars(unit: list[Node | str]) -> int:
    return sum(len(c.strip()) if isinstance(c, str) else c.chars for c in unit)


def _is_links(unit: list[Node | str]) -> bool:
    return sum(c.linked for c in unit if isinstance(c, Node)) >= LINKS * max(1, _chars(unit))


def _heading(unit: list[Node | str]) -> bool:
    return isinstance(unit[0], Node) and unit[0].tag in _HEADINGS


def _list(unit: list[Node | str]) -> bool:
    return isinstance(unit[0], Node) and unit[0].tag in ("ul", "ol", "dl")


def container(best: Node) -> Node:
    """The element that holds the article's parts, without children beside the best element that consist of links, but for
    lists under a heading.

    The article or main element around the best one is complete. Otherwise it is the first element around it with any other
    text than links, or one further up as long as a score there comes close, or a paragraph is long.
    """
    path = [best]
    while path[-1].parent is not None:
        path.append(path[-1].parent)
    bar = max(5.0, best.score * 0.2)
    parts = {k: units(n) for k, n in enumerate(path) if k}

    def near(unit: list[Node | str]) -> bool:
        n = unit[0]
        return isinstance(n, Node) and (n.score >= bar or n.tag == "p" and n.chars > 80 and n.linked < 0.25 * n.chars)

    last = next((k for k, n in enumerate(path) if n.tag in _STRONG), None)
    if last is None:
        last = 0
        for k in range(1, len(path)):
            beside = [u for u in parts[k] if path[k - 1] not in u and _chars(u)]
            if any(near(u) for u in beside) or not last and not all(map(_is_links, beside)):
                last = k
    for k in range(1, last + 1):
        kept: list[list[Node | str]] = []
        after = False  # whether what follows is kept
        filled = [u for u in parts[k] if _chars(u) or path[k - 1] in u]
        titled = {id(u) for t, u in zip(filled, filled[1:]) if _heading(t) and not _is_links(t) and _list(u)}
        for u in reversed(parts[k]):
            if _chars(u) or path[k - 1] in u:
                # A list of links right under a heading is the article's: its sources, say.
                after = path[k - 1] in u or near(u) or not _is_links(u) or id(u) in titled or _heading(u) and after
            if after:
                kept.append(u)
        path[k].children = [c for u in reversed(kept) for c in u]
    return path[last]


def extract_main_text(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """``id_col``, the ``keep`` columns, text and n_chars (code points) of each page's whole html.

    NULL, empty and text-free pages have the empty text. One row for each row that goes in, NULL and repeated ids
    included; other columns are not read.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, ROWS):
                batch = whole.slice(at, ROWS)
                texts = [main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*batch.schema.names[:-1], "text", "n_chars"])

    names = ["id", *(f"keep_{k}" for k in range(len(keep)))]
    rows = pages.select(*[ref(c).alias(n) for c, n in zip((id_col, *keep), names)], ref(html_col).alias("html"))
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in names)
    return rows.mapInArrow(work, f"{kinds}, text string, n_chars long").withColumnsRenamed(dict(zip(names, (id_col, *keep))))
