"""Main text of web pages through wrappers that are inferred per host.

1. Every page is read into a tree of block elements, each known by its tag, class and role (ids
   are often a page's own, so they are no part of it). Siblings that repeat, alone or in sequences
   of up to three, are folded into repeated groups; what is left is the page's skeleton. Pages of a host share few skeletons.
2. The skeletons of a host are aligned one after the other: elements that agree are merged,
   and what only one side has becomes optional, neighbours of one name a repeated group, and
   places with text become text slots. The outcome is a union-free expression of the host's
   pages, its wrapper; merging partial wrappers gives a wrapper again, so skeletons are
   counted before the shuffle, merged in salted parts and then per host.
3. Every page is laid over its host's wrapper, which gives each block of text its slot. A slot
   that has the same text on all pages of the host that have it, three different ones at
   least, is part of the template; the others hold the pages' own text. Neighbours of one name are
   one group and so one slot, even if only one of them has the same text everywhere.
4. The text is what stands below the common ancestor of the page's articles, in page order;
   all of it but slots of the template outside articles. Without an article, and where the
   articles hold less than half of the page's own text, that is the whole page. A page whose
   slots are all of the template keeps them.

What stands in menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and
comments, by tag, role, class or id, is never part of the text. Names count as whole words,
and never for the page's body, for main and article elements or for an element that holds most
of the page's text while no article stands outside it. ``<br>`` is white space.

Cases: null and empty pages give an empty text; a null or odd url has the host ''; unclosed or
stray tags end where the next block or the page does, and elements may be nested to any depth; repeated pages are each extracted and
count once as pages of a host; an empty table gives an empty result; other
columns are ignored. Pages are read whole whatever their length.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Generator, Iterable
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spark_triples.llm.common import map_batches, ship, table, text_or_empty
from spark_triples.session import stage

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S
)
_NAME = re.compile(r"(?:^|\s)(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
_BLOCKS = set(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup html li main menu nav ol option p pre section select summary "
    "table tbody td tfoot th thead tr ul button".split()
)
#: An element of the key ends where one of the values begins.
_ENDS = {
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "option": {"option"},
    "head": {"body"},
}
_LEFT_OUT = {"nav", "header", "footer", "aside", "form", "head", "button", "select", "menu", "dialog"}
#: A class, id or role leaves an element out if all its parts are of these or stand beside them.
_LEFT_OUT_PARTS = re.compile(
    r"ads?|advert[a-z]*|banner|sponsor[a-z]*|promo[a-z]*|cookies?|consent|notices?|alert|popup|modal|"
    r"sidebar|side|aside|menu|nav|navbar|navigation|breadcrumbs?|comments?|replies|disqus|footer|header|masthead|"
    r"related|share|sharing|social|newsletter|subscribe|widgets?|search|login|complementary|contentinfo",
    re.I,
)
_BESIDE = set(
    "site main primary secondary global top bottom box bar container wrapper wrap list area block slot section links "
    "icons buttons message inner form text unit".split()
)
#: Parts that may also stand beside words of an article.
_ABOUT = set("comments comment replies related share sharing nav navigation breadcrumbs breadcrumb".split())
_OF_ARTICLES = set("post posts entry article articles page".split())
_NEVER = {"", "html", "body", "main", "article"}
_ARTICLE = {"article", "main"}
_ARTICLE_NAMES = re.compile(
    r"(?:^|[-_ ])(?:main|article|content|post|entry|story|body-text)(?:$|[-_ ])", re.I
)
_LONGEST_GROUP = 3
#: Different pages that must agree on a slot's text before it is one of the template.
PAGES = 3
SALTS = 32


class Node:
    """A block element: its name with its id, by which it may be left out, and the name that
    wrappers know it by; its children, whether text stands right in it, and which of the page's
    blocks; in a wrapper, the number of its slot."""

    __slots__ = ("children", "held", "kind", "name", "optional", "repeated", "slot", "text")

    def __init__(self, name: str, kind: str | None = None, text: bool = False) -> None:
        self.name, self.kind, self.text, self.children = name, name if kind is None else kind, text, []
        self.held: list[int] = []
        self.slot = 0
        self.optional = self.repeated = False

    def written(self) -> str:
        out: list[str] = []
        todo: list[Node | str] = [self]
        while todo:
            at = todo.pop()
            if isinstance(at, str):
                out.append(at)
                continue
            out.append(f"{at.kind}(")
            todo.append(")" + "?" * at.optional + "+" * at.repeated)
            for k in range(len(at.children) - 1, -1, -1):
                todo.append(at.children[k])
                if k or at.text:
                    todo.append(" ")
            if at.text:
                todo.append("#")
        return "".join(out)


def _named(tag: str, attributes: str) -> tuple[str, str]:
    """An element's name with the words of its class, id and role, and without those of the id."""
    found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _NAME.finditer(attributes)} if attributes else {}
    if not found:
        return tag, tag

    def with_words(*of: str) -> str:
        words = [w for k in of for w in found.get(k, "").split() if not any(c.isdigit() for c in w)]
        return tag + "." + ".".join(sorted({re.sub(r"[^\w-]", "", w) for w in words})) if words else tag

    return with_words("class", "id", "role"), with_words("class", "role")


def _leaves_out(word: str) -> bool:
    parts = [p for p in re.split("[-_]+", word.lower()) if p]
    listed = {p for p in parts if _LEFT_OUT_PARTS.fullmatch(p)}
    beside = _BESIDE | _OF_ARTICLES if listed and listed <= _ABOUT else _BESIDE
    return bool(listed) and all(p in listed or p in beside for p in parts)


@lru_cache(100_000)
def _left_out(name: str) -> bool:
    """Whether the class, id or role of an element would leave it out."""
    tag, _, words = name.partition(".")
    return tag not in _NEVER and any(_leaves_out(w) for w in words.split(".") if w)


@lru_cache(100_000)
def _article(name: str) -> bool:
    tag, _, words = name.partition(".")
    if tag in ("html", "body"):
        return False
    return tag in _ARTICLE or any(_ARTICLE_NAMES.search(w) for w in words.split(".") if w)


def read_page(page: str) -> tuple[Node, list[str]]:
    """The tree of a page, and its blocks of text."""
    root = Node("")
    stack: list[tuple[str, Node]] = [("", root)]
    blocks: list[str] = []
    parts: list[str] = []

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                blocks.append(text)
                stack[-1][1].text = True
                stack[-1][1].held.append(len(blocks) - 1)

    def close(depth: int) -> None:
        flush()
        del stack[depth:]

    at, size = 0, len(page)
    while at < size:
        m = _TOKEN.search(page, at)
        if m is None:
            parts.append(html.unescape(page[at:]))
            break
        if m.start() > at:
            parts.append(html.unescape(page[at : m.start()]))
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if not m[1]:
            if tag == "br":
                parts.append(" ")
            elif tag == "hr":
                flush()
            elif tag in _RAW:
                if not m[3].endswith("/"):
                    end = re.compile(rf"</{re.escape(tag)}\b[^>]*>", re.I).search(page, at)
                    at = end.end() if end else size
            elif tag in _BLOCKS:
                while len(stack) > 1 and (stack[-1][0] == "p" or tag in _ENDS.get(stack[-1][0], ())):
                    close(len(stack) - 1)
                flush()
                node = Node(*_named(tag, m[3]))
                stack[-1][1].children.append(node)
                stack.append((tag, node))
        elif tag in _BLOCKS:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] == tag:
                    close(depth)
                    break
            else:
                flush()
    close(1)
    return root, blocks


#: What a step of a walk over trees yields are the steps it waits for, so that no depth of
#: nesting meets the interpreter's limit.
Step = Generator["Step", object, object]


def _walk(step: Step):
    """The result of a step."""
    waiting, result = [step], None
    while waiting:
        try:
            waiting.append(waiting[-1].send(result))
            result = None
        except StopIteration as done:
            waiting.pop()
            result = done.value
    return result


def fold(node: Node) -> Node:
    """Fold what repeats among the children, innermost first."""
    return _walk(_fold(node))


def _fold(node: Node) -> Step:
    for child in node.children:
        if child.children:
            yield _fold(child)
    if len(node.children) > 1:
        node.children = yield _folded(node.children)
    return node


def _folded(children: list[Node]) -> Step:
    out: list[Node] = []
    for child in children:
        out.append(child)
        for size in range(1, _LONGEST_GROUP + 1):
            left, right = out[-2 * size : -size], out[-size:]
            if len(left) == size and [n.kind for n in left] == [n.kind for n in right]:
                merged = []
                for a, b in zip(left, right, strict=True):
                    merged.append((yield _merge(a, b)))
                for n in merged:
                    n.repeated = True
                out[-2 * size :] = merged
                break
    return out


def merge(a: Node, b: Node) -> Node:
    """Two trees of one name as one: the children are aligned by name."""
    return _walk(_merge(a, b))


def _merge(a: Node, b: Node) -> Step:
    out = Node(a.kind, text=a.text or b.text)
    out.held = a.held + b.held
    out.optional, out.repeated = a.optional or b.optional, a.repeated or b.repeated
    aligned: list[Node] = []
    for x, y in _aligned(a.children, b.children):
        if x and y:
            aligned.append((yield _merge(x, y)))
        else:
            node = x or y
            node.optional = True
            aligned.append(node)
    out.children = (yield _folded(aligned)) if len(aligned) > 1 else aligned
    return out


def _aligned(x: list[Node], y: list[Node]) -> list[tuple[Node | None, Node | None]]:
    """The children of two nodes in order, side by side where their names agree."""
    if [n.kind for n in x] == [n.kind for n in y]:
        return list(zip(x, y, strict=True))
    common = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
    for i in range(len(x) - 1, -1, -1):
        for j in range(len(y) - 1, -1, -1):
            same = x[i].kind == y[j].kind
            common[i][j] = common[i + 1][j + 1] + 1 if same else max(common[i + 1][j], common[i][j + 1])
    i = j = 0
    out: list[tuple[Node | None, Node | None]] = []
    while i < len(x) or j < len(y):
        if i < len(x) and j < len(y) and x[i].kind == y[j].kind:
            out.append((x[i], y[j]))
            i, j = i + 1, j + 1
        elif j == len(y) or (i < len(x) and common[i + 1][j] >= common[i][j + 1]):
            out.append((x[i], None))
            i += 1
        else:
            out.append((None, y[j]))
            j += 1
    return out


def parse(written: str) -> Node:
    """The tree that ``Node.written`` wrote."""
    root = Node("")
    stack = [root]
    for m in re.finditer(r"([^\s()?+#]*)\(|(#)|(\))(\??)(\+?)", written):
        if m[2]:
            stack[-1].text = True
        elif m[3]:
            node = stack.pop()
            node.optional, node.repeated = bool(m[4]), bool(m[5])
        else:
            stack.append(Node(m[1]))
            stack[-2].children.append(stack[-1])
    return root.children[0]


def wrapper(skeletons: Iterable[str]) -> str:
    """The expression that all these skeletons (or wrappers) are aligned to."""
    out: Node | None = None
    for written in sorted(skeletons):
        out = parse(written) if out is None else merge(out, parse(written))
    return out.written() if out else ""


@lru_cache(1000)
def numbered(written: str) -> Node:
    """The tree of a wrapper with its slots numbered in order."""
    root = parse(written)
    todo, number = [root], 0
    while todo:
        node = todo.pop()
        node.slot, number = number, number + 1
        todo += reversed(node.children)
    return root


def slots(page: Node, expression: Node) -> dict[int, int]:
    """The slot of each of the page's blocks; ``page`` is folded."""
    out: dict[int, int] = {}
    todo = [(page, expression)]
    while todo:
        node, at = todo.pop()
        out.update(dict.fromkeys(node.held, at.slot))
        for x, y in _aligned(node.children, at.children):
            # a group that the wrapper has folded further stands earlier in it
            y = y or next((c for c in at.children if x and c.kind == x.kind), None)
            if x and y:
                todo.append((x, y))
    return out


def content(root: Node, blocks: list[str]) -> tuple[set[int], list[tuple[list[Node], set[int]]]]:
    """The blocks that are not left out, and the outermost articles: the elements from the page
    down to each, and its blocks."""
    order: list[Node] = [root]
    above: dict[int, Node] = {}
    for node in order:
        order += node.children
        above.update((id(c), node) for c in node.children)
    size: dict[int, int] = {}
    told: dict[int, int] = {}
    for node in reversed(order):
        tag = node.name.partition(".")[0]
        if tag in _LEFT_OUT:
            size[id(node)] = told[id(node)] = 0
            continue
        size[id(node)] = sum(len(blocks[k]) for k in node.held) + sum(size[id(c)] for c in node.children)
        whole = _article(node.name) and not _left_out(node.name)
        told[id(node)] = size[id(node)] if whole else sum(told[id(c)] for c in node.children)
    shown: set[int] = set()
    articles: list[tuple[list[Node], set[int]]] = []
    todo: list[tuple[Node, set[int] | None]] = [(root, None)]
    while todo:
        node, inside = todo.pop()
        tag = node.name.partition(".")[0]
        if tag in _LEFT_OUT:
            if inside is None or tag != "header":
                continue
        elif _left_out(node.name):
            most = 2 * size[id(node)] > size[id(root)] and told[id(node)] == told[id(root)]
            if not most:
                continue
        if inside is None and _article(node.name):
            inside, path = set(), [node]
            while path[-1] is not root:
                path.append(above[id(path[-1])])
            articles.append((path[::-1], inside))
        shown.update(node.held)
        if inside is not None:
            inside.update(node.held)
        todo += [(c, inside) for c in node.children]
    return shown, [a for a in articles if a[1]]


def _below(node: Node) -> set[int]:
    out: set[int] = set()
    todo = [node]
    while todo:
        node = todo.pop()
        out.update(node.held)
        todo += node.children
    return out


def text_of(page: str, expression: str | None, template: Iterable[int] = ()) -> str:
    """The text of a page, given its host's wrapper and which slots are of the template."""
    root, blocks = read_page(page)
    shown, articles = content(root, blocks)
    told = set().union(*(a[1] for a in articles))
    region = shown
    if articles:
        shared = [n[0] for n in zip(*(a[0] for a in articles)) if all(x is n[0] for x in n)]
        region = shown & _below(shared[-1])
    fixed: set[int] = set()
    template = set(template)
    if expression and template:
        found = slots(fold(root), numbered(expression))
        fixed = {k for k in shown - told if found.get(k) in template}

    def chars(of: set[int]) -> int:
        return sum(len(blocks[k]) for k in of)

    if 2 * chars(region - fixed) < chars(shown - fixed):
        region = shown
    return "\n".join(blocks[k] for k in sorted(region - fixed or region))


def _host() -> Column:
    host = F.regexp_extract(F.coalesce(F.col("url").cast("string"), F.lit("")), r"^[a-zA-Z][\w+.-]*://([^/?#]*)", 1)
    return F.lower(host)


def _source(pages: DataFrame) -> DataFrame:
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        text_or_empty("html").alias("html"),
        _host().alias("host"),
    )


def observe(pages: DataFrame) -> DataFrame:
    """(host, name, n): skeletons with their pages."""

    def work(rows: dict) -> dict:
        counts: Counter = Counter()
        for host, page in zip(rows["host"], rows["html"], strict=True):
            counts[host, fold(read_page(page)[0]).written()] += 1
        return {"host": [k[0] for k in counts], "name": [k[1] for k in counts], "n": list(counts.values())}

    made = map_batches(_source(pages).select("host", "html"), work, "host string, name string, n long")
    return made.groupBy("host", "name").agg(F.sum("n").alias("n"))


_WRAPPER = "host string, wrapper string"


def wrappers(observed: DataFrame) -> DataFrame:
    """(host, wrapper): one row per host; salted parts are merged first."""
    ship(observed.sparkSession)

    def first(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [wrapper(rows["name"])]})

    def again(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [wrapper(rows["wrapper"])]})

    salted = observed.withColumn("salt", F.pmod(F.xxhash64("name"), F.lit(SALTS)))
    parts = salted.groupBy("host", "salt").applyInPandas(first, _WRAPPER)
    return parts.groupBy("host").applyInPandas(again, _WRAPPER)


def templates(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(host, template): the slots outside articles with one text on all pages that have them."""

    def work(rows: dict) -> dict:
        seen: dict[tuple[str, int], tuple[set[int], set[int]]] = {}
        for host, page, expression in zip(rows["host"], rows["html"], rows["wrapper"], strict=True):
            root, blocks = read_page(page)
            shown, articles = content(root, blocks)
            rest = shown.difference(*(a[1] for a in articles))
            if not rest:
                continue
            at = slots(fold(root), numbered(expression))
            own = _number(page)
            texts: dict[int, list[str]] = {}
            for k in sorted(rest & at.keys()):
                texts.setdefault(at[k], []).append(blocks[k])
            for slot, text in texts.items():
                pages_, values = seen.setdefault((host, slot), (set(), set()))
                # a few of each tell as much as all
                if len(pages_) < PAGES:
                    pages_.add(own)
                if len(values) < 2:
                    values.add(_number("\n".join(text)))
        out = [(h, s, p, min(v), max(v)) for (h, s), (ps, v) in seen.items() for p in ps]
        return dict(zip(("host", "slot", "page", "low", "high"), zip(*out, strict=True) if out else [[]] * 5, strict=True))

    joined = _source(pages).select("host", "html").join(found, "host")
    made = map_batches(joined.select("host", "html", "wrapper"), work, "host string, slot long, page long, low long, high long")
    ends = F.min("low").alias("low"), F.max("high").alias("high")
    once = made.groupBy("host", "slot", "page").agg(*ends).groupBy("host", "slot").agg(F.count("*").alias("n"), *ends)
    fixed = once.filter((F.col("n") >= PAGES) & (F.col("low") == F.col("high")))
    return fixed.groupBy("host").agg(F.collect_list("slot").alias("template"))


def _number(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) >> 1


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    found = stage(wrappers(stage(observe(pages), "skeletons")), "wrappers")
    found = stage(found.join(templates(pages, found), "host", "left"), "templates")

    def work(rows: dict) -> dict:
        text = [text_of(p, w, t or ()) for p, w, t in zip(rows["html"], rows["wrapper"], rows["template"], strict=True)]
        return {"page_id": rows["page_id"], "url": rows["url"], "text": text, "n_chars": [len(t) for t in text]}

    joined = _source(pages).join(found, "host", "left")
    return map_batches(joined, work, "page_id long, url string, text string, n_chars long")


def op4_wrapper_text(spark, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return extract(table(spark, sf_dir, "pages"))
