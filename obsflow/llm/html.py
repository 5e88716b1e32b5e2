"""Main text of web pages through wrappers: union-free regular expressions inferred per host and page shape.

Inference: a page's block tags and text slots make a token stream whose nested
repeats are folded. Pages of one host with alike sets of label paths (the
smallest three of the paths' hashes are the page's shape) are aligned one after the other;
tokens that only one side has become optional groups, repeats stay repeated
groups, and text that differs becomes a slot, while text that is the same on
all pages stays a constant of the template, if at least two pages whose main
text differs have it (copies of one page say nothing). Every task aligns its own pages of
a shape first, a shape's parts are then aligned in salted groups and finally
together, so no task holds a host's pages, and pages that have little in common
do not grow one wrapper. The label paths of a host's wrappers are then
brought together by grouping: a constant must be the same in all of them.

Extraction: a page is read along its host's wrapper. Its article is what lies in
article elements (else main elements, else containers named as content), without
the regions that are menus, headers, footers, sidebars, notices, adverts, forms,
comments or not displayed. Words of class and id names never leave out html,
body, main, article or an element around an article or main. Pages without such a container give all slots that are not
mostly links. Of either, the constants of the host's template go: inside an
article, main or container named as content those that all such containers of
the host have, unless they are more than half of the page's blocks there (then
the pages are near copies).

Rules: null html is empty and gives empty text; a null URL belongs to the host
"" (as every URL without a host does); markup cut off by the end of the page is
dropped; br counts as white space; blocks are joined by one newline.
"""

from __future__ import annotations

import hashlib
import html as entities
import json
import re
from collections.abc import Iterator
from difflib import SequenceMatcher
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obsflow.llm.common import shuffle_width, stash, text_slices

# Element names by their role in a page.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong "
             "sub sup time tt u var wbr ruby rb rt rp nobr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript template iframe noframes xmp".split())
SKIPPED = set("nav aside footer form button select option optgroup datalist fieldset label dialog menu head script style "
              "textarea title noscript template iframe noframes svg math canvas object audio video map applet".split())
SKIPPED_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
                    "toolbar tablist status".split())
CLOSED_BY_BLOCK = set("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 "
                      "h5 h6 header hr main menu nav ol p pre section table ul".split())
CLOSES_SAME = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
# Words of class and id names.
BOILERPLATE = set("ad ads adv advert adverts advertisement advertising adsense adsbygoogle sponsor sponsored promo promos "
                  "promotion banner cookie cookies consent gdpr notice notices notification alert popup modal overlay "
                  "lightbox newsletter subscribe subscription signup sidebar sidebars aside widget widgets menu menus nav "
                  "navbar navigation breadcrumb breadcrumbs masthead footer copyright share sharing social related "
                  "recommended recommendations teaser toolbar pagination pager login search hidden tracking form".split())
COMMENTS = set("comment comments reply replies respond disqus discussion".split())
STATES = set("no not without has with open closed".split())  # names like no-sidebar and comments-open name no region
CONTENT = set("article content post entry story articlebody maincontent postcontent".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?>(?:[^>\"'<]|\"[^\"<]*\"|'[^'<]*')*)>|[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"([a-zA-Z_:][-\w:.]*)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
HOST = r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)"
DEPTH = 200
#: Pages of a host whose smallest so many hashes of label paths agree are aligned with each other.
ALIKE = 3


# What leaves a text out: [left out?, the same of the region around it]. A region left out for its name is shown again
# (with those around it) as soon as an article or main starts in it.
SHOWN, HIDDEN = [False, None], [True, None]


class Element:
    """An open element: what its text counts as (``zones``: one bit per zone it stands in), and its tree node."""

    __slots__ = ("tag", "skip", "zones", "node", "link")

    def __init__(self, tag: str, skip: list, zones: int, node: list, link: bool):
        self.tag, self.skip, self.zones, self.node, self.link = tag, skip, zones, node, link


# Tree nodes are lists: label, text (None, a digest, or SLOT), optional, repeated, children, and for a digest the digest
# of the main text of the pages that have it (SLOT if they differ).
SLOT = "#"
LABEL, TEXT, OPTIONAL, REPEATED, CHILDREN, SOURCE = range(6)


def _attributes(raw: str) -> dict[str, str]:
    return {m[1].lower(): next((x for x in m.groups()[1:] if x is not None), "") for m in ATTRIBUTE.finditer(raw)}


def _region_names(attr: dict[str, str]) -> set[str]:
    """Every class and id token whole, and its first and last word."""
    out: set[str] = set()
    for token in f"{attr.get('class', '')} {attr.get('id', '')}".split():
        words = [w.lower() for w in NAME.findall(token)]
        if words and not STATES & {words[0], words[-1]}:
            out |= {words[0], words[-1], "".join(words)}
    return out


def _judge(tag: str, attr: dict[str, str], zones: int) -> tuple[bool, bool, int]:
    """(left out?, left out for its names?, zone): zone 3 article, 2 main, 1 named as content, 0 none.

    ``zones``: bits of those around it.
    """
    role = attr.get("role", "").lower()
    style = attr.get("style", "").replace(" ", "").lower()
    inside = bool(zones & (1 << 2 | 1 << 3))
    skip = (tag in SKIPPED or role in SKIPPED_ROLES or "hidden" in attr or attr.get("aria-hidden") == "true"
            or "display:none" in style or "visibility:hidden" in style or (tag == "header" and not inside))
    if tag == "article":
        return skip or bool(zones >> 3 & 1), False, 3
    if tag == "main" or role == "main":
        return skip, False, 2
    names = _region_names(attr)
    named = tag not in ("html", "body") and bool(names & BOILERPLATE or names & COMMENTS or (not inside and "header" in names))
    words = {w.lower() for k in ("class", "id") for w in NAME.findall(attr.get(k, ""))}
    return skip, named, 1 if words & CONTENT and tag not in INLINE else 0


def _label(tag: str, attr: dict[str, str]) -> str:
    names = sorted({re.sub(r"\d+", "", c) for c in attr.get("class", "").split()} - {""})
    return ".".join([tag, *names])


def read_page(html: str) -> tuple[list[list], list]:
    """(blocks, tree) of a page. A block: [text pieces, zones, skipped?, link characters, label path]."""
    root: list = ["page", None, False, False, [], None]
    stack = [Element("", SHOWN, 0, root, False)]
    opened: dict[str, int] = {}  # open elements by tag, so that a stray end tag costs nothing
    path: list[str] = []
    blocks: list[list] = []
    fresh, at, low = True, 0, html.lower() if html.isascii() else None
    n = len(html)

    def put(text: str) -> None:
        nonlocal fresh
        text = entities.unescape(text)
        if not text or (fresh and not text.strip()):
            return
        top = stack[-1]
        if fresh or blocks[-1][2] is not top.skip:
            blocks.append([[], top.zones, top.skip, 0, tuple(path[:DEPTH]), top.node])
            fresh = False
        blocks[-1][0].append(text)
        if top.link:
            blocks[-1][3] += len(text)

    def close(k: int) -> None:
        nonlocal fresh
        for e in stack[k:]:
            opened[e.tag] -= 1
            if e.tag not in INLINE:
                fresh = True
                if path:
                    path.pop()
        del stack[k:]

    while at < n:
        m = TOKEN.search(html, at)
        put(html[at:m.start() if m else n])
        if not m:
            break
        at = m.end()
        tag = (m[2] or "").lower()
        if not tag:
            continue
        if m[1]:
            if opened.get(tag):
                close(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].tag == tag))
            continue
        if not m[0].endswith(">"):
            break  # cut off by the end of the page
        if tag == "br":
            put(" ")
            continue
        attr = _attributes(m[3])
        if tag in VOID:
            fresh |= tag == "hr"
            continue
        if tag in CLOSED_BY_BLOCK:
            k = next((k for k in range(len(stack) - 1, 0, -1) if stack[k].tag not in INLINE), 0)
            if stack[k].tag == "p":
                close(k)
        if tag in CLOSES_SAME:
            k = len(stack) - 1
            while k and stack[k].tag not in ("ul", "ol", "dl", "table", "select", "datalist", "menu"):
                k -= 1
            first = next((j for j in range(k + 1, len(stack)) if stack[j].tag in CLOSES_SAME[tag]), 0)
            if first:
                close(first)
        top = stack[-1]
        skip, named, zone = _judge(tag, attr, top.zones) if attr or tag not in INLINE else (False, False, 0)
        region = HIDDEN if skip or top.skip is HIDDEN else [True, top.skip] if named else top.skip
        if zone > 1:
            around = region
            while around[0] and around[1]:
                around[0], around = False, around[1]
        node = top.node
        if tag not in INLINE:
            fresh = True
            if len(stack) <= DEPTH:
                node = [_label(tag, attr), None, False, False, [], None]
                top.node[CHILDREN].append(node)
            path.append(_label(tag, attr))
        if tag in RAW:
            close_at = re.compile(rf"</{tag}[\s/>]", re.I).search(html, at) if low is None else None
            if low is not None:
                at = low.find(f"</{tag}", at)
                at = n if at < 0 else at
            else:
                at = close_at.start() if close_at else n
            path.pop()
            continue
        opened[tag] = opened.get(tag, 0) + 1
        stack.append(Element(tag, region, top.zones | 1 << zone, node, top.link or tag == "a"))
    for b in blocks:
        b[0], b[2] = " ".join("".join(b[0]).split()), b[2][0]
        node = b.pop()
        if b[0]:
            node[TEXT] = _digest(b[0], 8) if node[TEXT] is None else SLOT
    blocks = [b for b in blocks if b[0]]
    _fold_tree(root, _digest("\n".join(b[0] for b in _region(blocks)[1]), 4))
    return blocks, root


def _digest(text: str, size: int) -> str:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=size).hexdigest()


def _merge_text(a: str | None, b: str | None) -> str | None:
    return a if a == b else SLOT if a is not None and b is not None else a or b


def _merge_lists(x: list[list], y: list[list]) -> list[list]:
    """Two child lists aligned by their labels; what only one side has becomes optional."""
    out = []
    labels = [[n[LABEL] for n in side] for side in (x, y)]
    for what, a, b, c, d in SequenceMatcher(None, *labels, autojunk=False).get_opcodes():
        if what == "equal":
            out += [merge(p, q) for p, q in zip(x[a:b], y[c:d], strict=True)]
        else:
            out += [[*n[:OPTIONAL], True, *n[REPEATED:]] for n in x[a:b] + y[c:d]]
    return _fold(out)


def merge(a: list, b: list) -> list:
    """The wrapper of two wrappers with the same label."""
    text = _merge_text(a[TEXT], b[TEXT])
    return [a[LABEL], text, a[OPTIONAL] or b[OPTIONAL], a[REPEATED] or b[REPEATED],
            _merge_lists(a[CHILDREN], b[CHILDREN]), None if text == SLOT else _merge_text(a[SOURCE], b[SOURCE])]


def _fold(nodes: list[list]) -> list[list]:
    """Tandem repeats of one to three siblings as repeated groups."""
    out: list[list] = []
    for node in nodes:
        out.append(node)
        for p in (1, 2, 3):
            labels = [x[LABEL] for x in out[-p:]]
            if p > 1 and len(out) > p and out[-p - 1][LABEL] == "(" + " ".join(labels) + ")":
                group = out[-p - 1]
                group[CHILDREN] = [merge(x, y) for x, y in zip(group[CHILDREN], out[-p:], strict=True)]
                del out[-p:]
                break
            if len(out) >= 2 * p and [x[LABEL] for x in out[-2 * p:-p]] == labels:
                both = [merge(x, y) for x, y in zip(out[-2 * p:-p], out[-p:], strict=True)]
                del out[-2 * p:]
                if p == 1:
                    both[0][REPEATED] = True
                    out += both
                else:
                    out.append(["(" + " ".join(labels) + ")", None, False, True, both, None])
                break
    return out


def _fold_tree(root: list, source: str) -> None:
    todo = [root]
    order = []
    while todo:
        order.append(todo.pop())
        todo += order[-1][CHILDREN]
    for node in reversed(order):
        node[CHILDREN] = _fold(node[CHILDREN])
        if node[TEXT] not in (None, SLOT):
            node[SOURCE] = source


def expression(node: list) -> str:
    """The wrapper as a union-free regular expression over tags and # (a text slot; constants are quoted digests)."""
    text = "" if node[TEXT] is None else SLOT if node[TEXT] == SLOT else f"'{node[TEXT]}'"
    inner = text + "".join(expression(c) for c in node[CHILDREN])
    body = inner if node[LABEL].startswith("(") else f"<{node[LABEL]}>{inner}</{node[LABEL].split('.')[0]}>"
    mark = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}[node[OPTIONAL], node[REPEATED]]
    return f"({body}){mark}" if mark else body


def _text_paths(node: list, path: tuple[str, ...], box: tuple[str, ...] | None, out: dict[tuple[str, ...], tuple],
                boxes: set[tuple[str, ...]], always: bool = True) -> None:
    """(text, source, wherever its container is?, container) of all label paths with text, and the containers of content."""
    for c in node[CHILDREN]:
        group = c[LABEL].startswith("(")
        here = path if group else (*path, c[LABEL])
        holder = not group and _is_container(c[LABEL])
        within, every = here if holder else box, holder or (always and not c[OPTIONAL])
        if holder:
            boxes.add(here)
        if c[TEXT] is not None:
            known = out.get(here, (c[TEXT], c[SOURCE], False))
            out[here] = (_merge_text(known[0], c[TEXT]), _merge_text(known[1], c[SOURCE]),
                         known[2] or every or within is None, within)
        _text_paths(c, here, within, out, boxes, every)


def _is_container(label: str) -> bool:
    tag, *names = label.split(".")
    return tag in ("article", "main") or bool(CONTENT & {w.lower() for c in names for w in NAME.findall(c)})


def _region(blocks: list[list]) -> tuple[int, list[list]]:
    """(zone, the shown blocks of the article), zone 0 with all that are not mostly links if nothing names the article."""
    shown = [b for b in blocks if not b[2]]
    for zone in (3, 2, 1):
        inside = [b for b in shown if b[1] >> zone & 1]
        if inside:
            return zone, inside
    return 0, [b for b in shown if 2 * b[3] < len(b[0]) + 1]


def main_text(blocks: list[list]) -> str:
    """The article's blocks joined by newlines, as one page alone tells."""
    return "\n".join(b[0] for b in _region(blocks)[1])


@lru_cache(maxsize=1 << 14)
def _path_key(path: tuple[str, ...]) -> str:
    return _digest("\n".join(path), 8)


def _shape(blocks: list[list]) -> str:
    return "".join(sorted({_path_key(b[4]) for b in blocks})[:ALIKE])


_PARSED = "url string, host string, shape string, zone int, blocks array<struct<text: string, path: string>>, tree string"


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in text_slices(batches, "html"):
        shapes, zones, trees, texts, keys, ends = [], [], [], [], [], [0]
        for html in batch.column(3).to_pylist():
            blocks, tree = read_page(html)
            zone, inside = _region(blocks)
            shapes.append(_shape(blocks))
            zones.append(zone)
            trees.append(json.dumps(tree, separators=(",", ":")))
            texts += [b[0] for b in inside]
            keys += [_path_key(b[4]) for b in inside]
            ends.append(len(texts))
        pairs = pa.StructArray.from_arrays([pa.array(texts, pa.string()), pa.array(keys, pa.string())], ["text", "path"])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:3], pa.array(shapes, pa.string()), pa.array(zones, pa.int32()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs), pa.array(trees, pa.string())],
            ["page_id", "url", "host", "shape", "zone", "blocks", "tree"])


def _parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Every page read once: its host, shape, the blocks of its article with their label paths, and its tree."""
    host = F.lower(F.coalesce(F.regexp_extract(F.col(url_col), HOST, 1), F.lit("")))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"),
                        F.coalesce(F.col(html_col), F.lit("")).alias("html"))
    return stash(rows.mapInArrow(_parse, f"page_id {dict(pages.dtypes)[id_col]}, {_PARSED}"), "html-pages")


_PART = "host string, shape string, pages long, wrapper string"


def _merge_rows(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Rows of ``_PART`` with those of a host and shape aligned; at most ``limit`` wrappers are held at a time."""
    held: dict[tuple[str, str], list] = {}

    def flush() -> pa.RecordBatch:
        rows = [(*key, n, json.dumps(w, separators=(",", ":"))) for key, (n, w) in held.items()]
        held.clear()
        kinds = (pa.string(), pa.string(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                          ["host", "shape", "pages", "wrapper"])
    for batch in batches:
        for host, shape, pages, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            tree, known = json.loads(wrapper), held.get((host, shape))
            if known:
                held[host, shape] = [known[0] + pages, merge(known[1], tree)]
            else:
                if len(held) >= limit:
                    yield flush()
                held[host, shape] = [pages, tree]
    if held:
        yield flush()


def _wrappers(parsed: DataFrame, salts: int) -> DataFrame:
    width = shuffle_width(parsed.sparkSession)
    parts = (parsed.select("host", "shape", F.lit(1).cast("long").alias("pages"), F.col("tree").alias("wrapper"))
             .mapInArrow(lambda batches: _merge_rows(batches, 1000), _PART))
    for keys in (["host", "shape", "salt"], ["host", "shape"]):
        parts = parts.withColumn("salt", F.pmod(F.xxhash64("wrapper", "pages"), F.lit(salts)))
        # sorted by host and shape, so that one wrapper is held at a time
        parts = (parts.repartition(width, *keys).sortWithinPartitions(*keys, "pages", "wrapper")
                 .select("host", "shape", "pages", "wrapper").mapInArrow(lambda batches: _merge_rows(batches, 1), _PART))
    return parts


def wrappers(pages: DataFrame, salts: int = 32, id_col: str = "page_id", url_col: str = "url",
             html_col: str = "html") -> DataFrame:
    """(host, shape, pages, wrapper): one wrapper per host and shape as JSON; ``expression`` writes it as a regular expression."""
    return _wrappers(_parsed(pages, id_col, url_col, html_col), salts)


_PATH = "host string, shape string, path string, box string, text string, source string, always boolean"


def _path_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The label paths with text of every wrapper, and its containers (rows without a path)."""
    for batch in text_slices(batches, "wrapper"):
        rows = []
        for host, shape, wrapper in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            found: dict[tuple[str, ...], tuple] = {}
            boxes: set[tuple[str, ...]] = set()
            _text_paths(json.loads(wrapper), (), None, found, boxes)
            rows += [(host, shape, _path_key(p), _path_key(box) if box else None, text, source, always)
                     for p, (text, source, always, box) in found.items()]
            rows += [(host, shape, None, _path_key(box), None, None, None) for box in boxes]
        kinds = [pa.string()] * 6 + [pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
                                         ["host", "shape", "path", "box", "text", "source", "always"])


def template_constants(learned: DataFrame) -> DataFrame:
    """(host, shape, constants): the label paths whose text is one and the same on pages of the host that differ.

    Inside a container of content, every such container of the host must have it.
    """
    rows = stash(learned.select("host", "shape", "wrapper").mapInArrow(_path_rows, _PATH), "html-paths")
    known = rows.where("path is not null")
    texts = (known.groupBy("host", "path")
             .agg(F.min("text").alias("text"), F.max("text").alias("other"), F.min("source").alias("source"),
                  F.max("source").alias("source2"), F.min("always").alias("always"), F.min("box").alias("box"),
                  F.count(F.lit(1)).alias("n"))
             .where((F.col("text") == F.col("other")) & (F.col("text") != SLOT) & F.col("always")
                    & ((F.col("source") == SLOT) | (F.col("source2") == SLOT) | (F.col("source") != F.col("source2")))))
    boxes = rows.where("path is null").groupBy("host", "box").agg(F.count(F.lit(1)).alias("boxes"))
    constants = (texts.join(boxes, ["host", "box"], "left").where("box is null or n = boxes").select("host", "path"))
    return (known.select("host", "shape", "path").join(constants, ["host", "path"], "left_semi")
            .groupBy("host", "shape").agg(F.collect_set("path").alias("constants")))


def extract_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                 salts: int = 32) -> DataFrame:
    """(page_id, url, text, n_chars) per row of ``pages``."""
    parsed = _parsed(pages, id_col, url_col, html_col)
    constants = stash(template_constants(stash(_wrappers(parsed, salts), "html-wrappers")), "html-constants")
    own = F.filter("blocks", lambda b: ~F.array_contains("constants", b["path"]))
    near_copies = (F.col("zone") > 0) & (2 * F.size(own) < F.size("blocks"))
    shown = F.when(F.col("constants").isNull() | near_copies, F.col("blocks")).otherwise(own)
    return (parsed.drop("tree").join(constants, ["host", "shape"], "left")
            .select("page_id", "url", F.array_join(F.transform(shown, lambda b: b["text"]), "\n").alias("text"))
            .withColumn("n_chars", F.char_length("text").cast("long")))
