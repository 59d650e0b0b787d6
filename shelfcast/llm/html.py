"""Main text of web pages by wrappers inferred from the pages of a host.

A page is read as a stream of tags and texts.  Streams of a host are aligned one after another into a union-free
expression: elements met on both sides merge, runs of like siblings become repeated groups, elements met on one side
only become optional, and texts that differ become slots.  Each task folds its pages into one small expression a
host; those merge in two rounds, so all pages count and no host's pages meet in one task.  The expression says where
the article is.  Blocks that recur on half of a host's different pages, of any length, are its constants; they are
counted by host over all pages with partial sums.  What a page holds in the article's region but these is its text.
"""

from __future__ import annotations

import html
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.shared import chunks, map_batches, materialise, ship_code

#: Elements by their role in HTML.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script style noscript template textarea iframe svg math select object canvas"
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br img".split())
NEVER = set(f"{RAW} head nav footer aside form button input dialog menu".split())
#: Words of a class, id or role that mark what is not the article, and those that mark it.
AWAY = set(
    "ad ads advert advertisement banner sponsor sponsored promo cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe signup login "
    "sidebar side widget related recommended share sharing social menu nav navbar navigation breadcrumb breadcrumbs pagination header masthead footer copyright "
    "comment comments reply replies discussion disqus reader readers thoughts responses feedback reviews tags toolbar search skip".split()
)
#: Words that make a class name say how a page is laid out, not what an element holds.
STATES = set("no not has have with without is are enabled disabled hide hidden show shown allow open closed on off".split())
HOME = ("article", "main")
NEAR = set("article content post entry story main body text".split())
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW.replace(' ', '|')})\b[^>]*+>.*?(?:</\1\s*+>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)(/?)>|<[!?/a-zA-Z][^>]*+(?:>|\Z)|([^<]++|<)",
    re.S | re.I,
)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
_WORD = re.compile(r"[a-z]+")
_BLANK = re.compile(r"\s+")
#: Children that an expression keeps apart under one element before they fold into a repeated group, and levels.
WIDTH, DEPTH = 40, 60
#: Share of a host's different pages on which a constant is.
SHARE = 0.5


class Node:
    """An element: its signature (tag and the words of class, id and role), and its children (elements and texts)."""

    __slots__ = ("away", "children", "near", "tag", "words")

    def __init__(self, tag: str, names: str = ""):
        self.tag, self.words = tag, " ".join(dict.fromkeys(_WORD.findall(names.lower())))
        self.away = _is_away(tag, names)
        self.near = bool(set(self.words.split()) & NEAR)
        self.children: list[Node | str] = []

    @property
    def sign(self) -> str:
        return f"{self.tag}|{self.words}|{'-' if self.away else ''}"


def _is_away(tag: str, names: str) -> bool:
    """Whether an element is not of the article, by its tag and its class names, each taken as a whole.

    A name counts that has such a word and none of STATES; beside a name that marks the article only one that has
    nothing but such words.
    """
    if tag in NEVER or tag in ("html", "body", *HOME):
        return tag in NEVER
    each = [set(_WORD.findall(name)) for name in names.lower().split()]
    marked = any(words and words <= NEAR for words in each)
    return any(words & AWAY and not words & STATES and (words <= AWAY or not marked) for words in each)


def parse(source: str) -> Node:
    """The tree of a page; unclosed and misnested tags are taken as browsers mostly do.  Inline tags stay in the text."""
    root = Node("html")
    stack = [root]
    for found in _TOKEN.finditer(source):
        raw, closing, name, rest, _, text = found.groups()
        if text is not None:
            stack[-1].children.append(text)
            continue
        if raw or name is None:
            continue
        tag = name.lower()
        if tag in ("html",):
            continue
        if tag in INLINE:
            if tag in ("br", "img", "wbr"):
                stack[-1].children.append(" ")
            continue
        if closing:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in VOID:
            if tag == "hr":
                stack[-1].children.append(Node("hr"))
            continue
        if tag not in ("td", "th", "tr", "tbody", "thead", "tfoot", "dd", "dt", "li", "option"):
            _close(stack, {"p"}, {"td", "th", "li", "blockquote", "div", "section", "article", "main", "aside"})
        elif tag == "li":
            _close(stack, {"li"}, {"ul", "ol", "menu"})
        elif tag in ("dd", "dt"):
            _close(stack, {"dd", "dt"}, {"dl"})
        elif tag == "tr":
            _close(stack, {"tr"}, {"table"})
        elif tag in ("td", "th"):
            _close(stack, {"td", "th"}, {"tr", "table"})
        if tag == "body" and stack[-1].tag == "head":
            stack.pop()
        node = Node(tag, " ".join(part for group in _NAMES.findall(rest) for part in group if part))
        stack[-1].children.append(node)
        if len(stack) < 500:
            stack.append(node)
    return root


def _close(stack: list[Node], tags: set[str], walls: set[str]) -> None:
    for depth in range(len(stack) - 1, 0, -1):
        if stack[depth].tag in tags:
            del stack[depth:]
            return
        if stack[depth].tag in walls:
            return


def normal(text: str) -> str:
    """A block as it is given out: references decoded, white space as single spaces."""
    return _BLANK.sub(" ", html.unescape(text)).strip()


def digest(text: str) -> str:
    return xxhash.xxh128_hexdigest(text.encode("utf-8", "replace"))


# An expression is a list [sign, pages, repeated, optional, children] for an element and ["#", pages, constant
# (the digest of a long one) or None, characters] for a text slot, plain lists so that it can travel as JSON.
def expression(node: Node, depth: int = 0) -> list:
    """The expression of one page."""
    children, texts = [], []

    def flush() -> None:
        value = normal("".join(texts))
        texts.clear()
        if value:
            children.append(["#", 1, value if len(value) <= 80 else digest(value), len(value)])

    for child in node.children:
        if isinstance(child, str):
            texts.append(child)
        else:
            flush()
            if depth < DEPTH:
                children.append(expression(child, depth + 1))
    flush()
    return [node.sign, 1, False, False, _fold(children, own=True)]


def _both(left: list, right: list, own: bool) -> list:
    """The merger of two like parts: of the same page (a repeated group) or of different pages."""
    pages = max(left[1], right[1]) if own else left[1] + right[1]
    if left[0] == "#":
        return ["#", pages, left[2] if left[2] == right[2] else None, left[3] + right[3]]
    children = _align(left[4], right[4], own)
    return [left[0], pages, own or left[2] or right[2], left[3] or right[3], children]


def _fold(children: list, own: bool) -> list:
    """Runs of like siblings become one repeated group; so do like siblings further apart once there are many."""
    out: list = []
    for child in children:
        if out and out[-1][0] == child[0] and child[0] != "#":
            out[-1] = _both(out[-1], child, True)
        else:
            out.append(child)
    if len(out) > WIDTH:
        first: dict[str, int] = {}
        kept: list = []
        for child in out:
            if child[0] in first:
                kept[first[child[0]]] = _both(kept[first[child[0]]], child, True)
            else:
                first[child[0]] = len(kept)
                kept.append(child)
        out = kept
    if len(out) > 2 * WIDTH:  # names that are a page's own: the rarer ones become one element by tag
        often = set(sorted(range(len(out)), key=lambda at: -out[at][1])[:WIDTH])
        first, kept = {}, []
        for at, child in enumerate(out):
            if at in often or child[0] == "#":
                kept.append(child)
                continue
            plain = [f"{child[0].split('|')[0]}||{child[0].split('|')[2]}", child[1], True, True, child[4]]
            if plain[0] in first:
                kept[first[plain[0]]] = _both(kept[first[plain[0]]], plain, own)
            else:
                first[plain[0]] = len(kept)
                kept.append(plain)
        out = kept
    return out


def _align(left: list, right: list, own: bool) -> list:
    if [part[0] for part in left] == [part[0] for part in right]:
        return [_both(a, b, own) for a, b in zip(left, right, strict=True)]
    out = []
    match = SequenceMatcher(None, [part[0] for part in left], [part[0] for part in right], autojunk=False)
    for kind, a, b, c, d in match.get_opcodes():
        if kind == "equal":
            out.extend(_both(x, y, own) for x, y in zip(left[a:b], right[c:d], strict=True))
        else:
            for part in left[a:b] + right[c:d]:
                out.append(part if part[0] == "#" else [part[0], part[1], part[2], True, part[4]])
    return _fold(out, own)


def merge(left: list | None, right: list) -> list:
    return right if left is None else _both(left, right, own=False)


def _size(part: list) -> tuple[int, int]:
    """Characters of the slots that differ from page to page in paragraphs, and of all slots."""
    if part[0] == "#":
        return (part[3] if part[2] is None else 0), part[3]
    sums = [_size(child) for child in part[4]]
    return sum(s[0] for s in sums), sum(s[1] for s in sums)


def regions(wrapper: list) -> dict:
    """What extraction needs of an expression: signs from the root to the article."""
    best: tuple[float, list[str]] = (0.0, [])

    def walk(part: list, path: list[str], home: float) -> None:
        nonlocal best
        if part[0] == "#":
            return
        tag, words, away = part[0].split("|")
        if away:
            return
        home = max(home, 3.0 if tag == "article" else 2.5 if tag == "main" else 1.5 if set(words.split()) & NEAR else 1.0)
        varying, whole = _size(part)
        inner = max((_size(child)[0] for child in part[4] if child[0] != "#" and child[0].split("|")[0] in ("div", "section", "article", "main", "td", "body")), default=0)
        score = home * (varying + 0.1 * whole) - (0.8 * home * inner if tag not in HOME else 0)
        if score > best[0]:
            best = (score, [*path, part[0]])
        for child in part[4]:
            walk(child, [*path, part[0]], home)

    walk(wrapper, [], 0.0)
    return {"path": best[1]}


def _blocks(node: Node, fixed: set[str], out: list[str]) -> None:
    texts: list[str] = []

    def flush() -> None:
        value = normal("".join(texts))
        texts.clear()
        if value and not (fixed and digest(value) in fixed):
            out.append(value)

    for child in node.children:
        if isinstance(child, str):
            texts.append(child)
        else:
            flush()
            if not child.away:
                _blocks(child, fixed, out)
    flush()


def _homes(node: Node, path: list[str]) -> list[Node]:
    """The elements of a page that the path of its host's expression leads to."""
    level = [node]
    for sign in path[1:]:
        level = [child for parent in level for child in parent.children if isinstance(child, Node) and child.sign == sign]
    return level


def _nearest(node: Node) -> list[Node]:
    """Articles of a page that its host's expression does not know."""
    found = []
    for child in node.children:
        if isinstance(child, Node) and not child.away:
            found.extend([child] if child.tag in HOME else _nearest(child))
    return found


def extract(source: str | None, known: dict | None, fixed: set[str] = frozenset()) -> str:
    """Blocks of the article but the host's constants, joined by an empty line; an empty text if there is none.

    A page that holds nothing but constants keeps them: its article itself recurs.
    """
    if not source:
        return ""
    root = parse(source)
    path = known["path"] if known else []
    homes = _homes(root, path) if len(path) > 1 else []
    if not homes:
        homes = _nearest(root)
    if not homes:
        own = regions(expression(root))["path"]
        homes = _homes(root, own) or [root]
    out: list[str] = []
    for home in homes:
        _blocks(home, fixed, out)
    if not out and fixed:
        for home in homes:
            _blocks(home, set(), out)
    return "\n\n".join(out)


def _host(url: str) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _infer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One expression a host from the pages of a task, handed on early when there are many hosts; and the digests of
    each page's different blocks with that of the page, a row each."""
    part = TaskContext.get().partitionId()
    known: dict[str, list] = {}

    def packed() -> pa.RecordBatch:
        names = list(known)
        nothing = pa.nulls(len(names), pa.string())
        rows = [pa.array(names, pa.string()), pa.array([part % 64] * len(names), pa.int32()), pa.array([json.dumps(known[name]) for name in names], pa.string()), nothing, nothing]
        return pa.record_batch(rows, ["host", "salt", "wrapper", "page", "block"])

    for batch in chunks(batches, "html", 1 << 20):
        hosts, pages, blocks = [], [], []
        for host, source in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
            if source:
                root = parse(source)
                known[host] = merge(known.get(host), expression(root))
                texts: list[str] = []
                _blocks(root, set(), texts)
                each = {digest(text) for text in texts}
                hosts += [host] * len(each)
                pages += [digest(source)] * len(each)
                blocks += each
        nothing = pa.nulls(len(hosts))
        columns = [pa.array(hosts, pa.string()), nothing.cast(pa.int32()), nothing.cast(pa.string()), pa.array(pages, pa.string()), pa.array(blocks, pa.string())]
        yield pa.record_batch(columns, ["host", "salt", "wrapper", "page", "block"])
        if len(known) > 1000:
            yield packed()
            known.clear()
    yield packed()


def constants(blocks: DataFrame) -> DataFrame:
    """(host, fixed): the blocks on at least SHARE of a host's different pages and on two of them, a few times what a
    page holds at most.  ``blocks`` has host, page and block; repeated pages count once."""
    once = blocks.groupBy("host", "page", "block").agg(F.lit(1).alias("one"))
    often = once.groupBy("host", "block").agg(F.count("*").alias("n")).where("n > 1")
    pages = blocks.groupBy("host", "page").agg(F.lit(1).alias("one")).groupBy("host").agg(F.count("*").alias("pages"))
    return often.join(pages, "host").where(F.col("n") >= SHARE * F.col("pages")).groupBy("host").agg(F.sort_array(F.collect_list("block")).alias("fixed"))


def wrappers(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """(host, regions, fixed): the article's place in the pages of each host, as JSON, and the host's constants."""
    ship_code(pages.sparkSession)

    def combine(last: bool):
        def run(rows: pd.DataFrame) -> pd.DataFrame:
            whole = None
            for text in sorted(rows["wrapper"]):
                whole = merge(whole, json.loads(text))
            return pd.DataFrame({"host": [rows["host"].iloc[0]], "wrapper": [json.dumps(regions(whole) if last else whole)]})

        return run

    rows = pages.select(_host(url).alias("host"), F.col(source).alias("html"))
    some = materialise(map_batches(rows, _infer, "host string, salt int, wrapper string, page string, block string"))
    fewer = some.where("wrapper is not null").groupBy("host", "salt").applyInPandas(combine(False), "host string, wrapper string")
    whole = fewer.groupBy("host").applyInPandas(combine(True), "host string, wrapper string").withColumnRenamed("wrapper", "regions")
    return whole.join(constants(some.where("block is not null").select("host", "page", "block")), "host", "left")


def _free(name: str, taken: list[str]) -> str:
    """A column name that a table does not have."""
    while name in {other.lower() for other in taken}:
        name += "_"
    return name


def main_text(pages: DataFrame, url: str = "url", source: str = "html") -> DataFrame:
    """All rows and columns with ``text``, the article of the whole page; a column of that name is replaced.

    A null or empty page, and one without an article, gives an empty text.  A null or odd URL counts as a host of its
    own.  Repeated pages give the same text each.
    """
    found = materialise(wrappers(pages, url, source))  # small: read back, Spark sees its size and picks the join by it
    kept = [name for name in pages.columns if name != "text"]
    host, place, fixed = (_free(name, kept) for name in ("host", "regions", "fixed"))
    rows = pages.select(*kept, _host(url).alias(host)).join(found.toDF(host, place, fixed), host, "left").drop(host)
    schema = ", ".join(f"`{name}` {kind}" for name, kind in pages.select(*kept).dtypes) + ", text string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for batch in chunks(batches, source, 1 << 20):
            texts = []
            for page, region, own in zip(*(batch.column(name).to_pylist() for name in (source, place, fixed)), strict=True):
                if region is not None and region not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[region] = json.loads(region)
                texts.append(extract(page, known.get(region), set(own or ())))
            columns = [batch.column(name) for name in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string())], names=[*kept, "text"])

    return map_batches(rows, run, schema)
