"""Main text of web pages by wrapper inference.

Pages of one host are made by one template.  Each page is read as a tree of
block elements whose inline markup is part of the text.  For each host a
union-free regular expression over such trees is inferred: starting from one
page, every further sample page is aligned with the wrapper; elements that
only one side has become optional, neighbouring equal elements (or groups of
them) become repetitions, and differing texts become slots.  A text that is
equal on all pages that have it, and on ``SURE`` different pages at least, is
the template's own.

A page is extracted by aligning it with its host's wrapper.  Where a page marks
its main container (``article`` or ``main``), that mark is taken, and every text
in it stays, also one that all pages share.  Without a main container
all texts that the wrapper knows as the template's own are left out, the others
stay.  Menus, headers and footers of the page, sidebars, notices, adverts,
forms, scripts, styles and reader comments are left out wherever they stand,
also where a page has more than its wrapper: by element name, or by a whole
word of class, role or id; html, body, main, article, headings and the blocks
around the main container are never left out for a word.

All pages of a host are aligned, equal ones once: in buckets of about ``TOGETHER``
by a hash of the page, in the order of the hash, then the wrappers of ``TOGETHER``
buckets at a time, round by round, so that no task needs all of a large host and
the result does not depend on how the rows are dealt.  The wrappers are one row a
host; every page is extracted whole.

Defined results: null or empty html gives an empty text; a wrapper
knows nothing below 150 levels, pages are read and extracted at any depth; pages without a host
form one host of their own; unclosed elements end with their parent; a cut page
ends where it ends; rows repeat as they come; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from itertools import groupby
from math import isqrt

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import SLICE_ROWS, sliced, stored

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[\s/]++|=?[^\s/>=]++(?:\s*+=\s*+(?:"[^"]*+(?:"|\Z)|'[^']*+(?:'|\Z)|(?!["'>])[^\s>]++)?+)?+|=)*+)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""([^\s/>=]++)\s*+=\s*+("[^"]*+"?|'[^']*+'?|[^\s>]++)""")
NAMING = frozenset(["class", "id", "role"])
SPACE = re.compile(r"\s+")

# Fixed sets of HTML element names.
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s samp small span strike "
                   "strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe svg math object select".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav "
                     "ol p pre section table ul figure".split())
SAME_KIND = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}, "thead": {"tr", "td", "th"}, "tbody": {"thead", "tr", "td", "th"}}
HOLDERS = frozenset("ul ol dl table tbody thead article main section div body html nav aside footer header".split())
LEFT_OUT = frozenset("head script style noscript template iframe svg math object nav aside footer form button select "
                     "textarea input menu dialog title".split())
MAIN = frozenset(["article", "main"])
LEFT_OUT_WORDS = frozenset(
    "ad ads advert adverts advertisement sponsor sponsored promo promotion sidebar menu nav navigation navbar footer "
    "masthead topbar cookie cookies consent notice notices banner alert popup modal overlay comment comments replies "
    "disqus share sharing social related recommended newsletter subscribe signup login search breadcrumb breadcrumbs "
    "pagination pager widget skip".split())
#: Never left out for their words; elements whose id is a link target and says nothing about the kind of block.
NEVER_BY_WORD = frozenset("html body main article h1 h2 h3 h4 h5 h6".split())
ID_IS_TARGET = frozenset("section h1 h2 h3 h4 h5 h6".split())
#: Members of a repeated group, different pages that make a text the template's, levels of a wrapper.
GROUP, SURE, DEEPEST = 4, 3, 150
#: Pages or wrappers that are aligned one after another in one round.
TOGETHER = 64
#: Pages that a task remembers to pass on copies of one page only once.
_PAGES_REMEMBERED = 200_000


class Node:
    """A block element: name, words of class, id and role, whether a whole one of them names a
    left-out block, children (texts and nodes)."""
    __slots__ = ("name", "words", "marked", "children")

    def __init__(self, name: str, words: tuple[str, ...], marked: bool = False):
        self.name, self.words, self.marked, self.children = name, words, marked, []

    @property
    def key(self) -> str:
        return ".".join([self.name, *self.words])

    def left_out(self, inside_main: bool, by_word: bool = True) -> bool:
        return self.name in LEFT_OUT or self.name == "header" and not inside_main or by_word and self.marked


def _element(name: str, attributes: str) -> Node:
    found, tokens = set(), set()
    for kind, value in ATTRIBUTE.findall(attributes):
        if kind.lower() not in NAMING or kind.lower() == "id" and name in ID_IS_TARGET:
            continue
        value = entities.unescape(value.strip("\"'")).lower()
        found.update(w for w in re.split(r"[^a-z]+", value) if w)
        tokens.update(value.split())
    return Node(name, tuple(sorted(found)), name not in NEVER_BY_WORD and not LEFT_OUT_WORDS.isdisjoint(tokens))


def parse(page: str | None) -> Node:
    """The page as a tree of blocks; texts decoded, white space as one space."""
    root = Node("#page", ())
    stack, text = [root], []
    opened: Counter[str] = Counter()

    def flush():
        whole = SPACE.sub(" ", entities.unescape("".join(text))).strip()
        text.clear()
        if whole:
            stack[-1].children.append(whole)

    def close_to(depth: int):
        flush()
        opened.subtract(n.name for n in stack[depth:])
        del stack[depth:]

    page, at = page or "", 0
    while at < len(page):
        m = TOKEN.search(page, at)
        if not m:
            text.append(page[at:])
            break
        text.append(page[at:m.start()])
        at = m.end()
        if not m[2]:
            continue                                  # a comment or declaration
        closing, name, attributes = m[1], m[2].lower(), m[3]
        if name in RAW and not closing:
            if not attributes.rstrip().endswith("/"):
                end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(page, at)
                at = end.end() if end else len(page)
            if name not in INLINE:
                text.append(" ")
            continue
        if name == "br":
            text.append(" ")
        elif name in INLINE or name in VOID and name != "hr":
            continue
        elif closing:
            if opened[name]:
                close_to(next(k for k in range(len(stack) - 1, 0, -1) if stack[k].name == name))
        else:
            flush()
            while len(stack) > 1 and (stack[-1].name == "p" and name in CLOSES_P):
                close_to(len(stack) - 1)
            ends = SAME_KIND.get(name)
            if ends:
                k = len(stack) - 1
                while k > 0 and stack[k].name not in HOLDERS - ends and stack[k].name not in ends:
                    k -= 1
                while k > 0 and stack[k].name in ends:
                    close_to(k)
                    k -= 1
            node = _element(name, attributes)
            stack[-1].children.append(node)
            if name != "hr":
                stack.append(node)
                opened[name] += 1
    flush()
    return root


# -- wrappers: items are dicts; "t" a text (None: a slot), "k"/"c" an element, "g" a repeated group; while a wrapper
# -- is inferred, "n" are up to SURE digests of different pages that have the text
def item_key(item: dict) -> str:
    return "#" if "t" in item else item["k"] if "k" in item else "(" + " ".join(map(item_key, item["g"])) + ")"


def digest(text: str) -> str:
    """A text in a wrapper: only its equality counts."""
    return xxhash.xxh3_64_hexdigest(text)


def as_items(node: Node, keep: bool = False, page: int = 0, level: int = 1) -> list[dict]:
    """A page's children as items, neighbouring equal ones folded into repetitions, down to
    ``DEEPEST``; with ``keep`` the page's own nodes and texts stay at the items ("of")."""
    items = []
    for child in node.children:
        item = {"t": digest(child), "n": [page]} if isinstance(child, str) else {
            "k": child.key, "c": [] if keep or level > DEEPEST else as_items(child, page=page, level=level + 1)}
        if keep:
            item["of"] = [child]
        items.append(item)
    return fold(items, keep)


def fold(items: list[dict], keep: bool = False) -> list[dict]:
    for size in range(1, GROUP + 1):
        out, k = [], 0
        keys = [item_key(i) for i in items]
        while k < len(items):
            block, n = items[k:k + size], 1
            while len(block) == size and keys[k + n * size:k + (n + 1) * size] == keys[k:k + size] \
                    and not (size == 1 and keys[k] == "#"):
                n += 1
            if n == 1:
                out.append(items[k])
                k += 1
                continue
            whole = block
            for r in range(1, n):
                whole = [merge_item(a, b, keep) for a, b in zip(whole, items[k + r * size:k + (r + 1) * size])]
            if size == 1:
                out.append(whole[0] | {"rep": True})
            else:
                of = {"of": [x for i in items[k:k + n * size] for x in i["of"]]} if keep else {}
                out.append({"g": whole, "rep": True} | of)
            k += n * size
        items = out
    return items


def merge_item(a: dict, b: dict, keep: bool = False) -> dict:
    """Two items of one key as one: differing texts become a slot."""
    flags = {f: True for f in ("rep", "opt") if a.get(f) or b.get(f)}
    if keep:
        flags["of"] = a["of"] + b["of"]
    if "t" in a:
        same = a["t"] is not None and a["t"] == b["t"]
        return ({"t": a["t"], "n": sorted({*a["n"], *b["n"]})[:SURE]} if same else {"t": None}) | flags
    if "k" in a:
        return {"k": a["k"], "c": [] if keep else align(a["c"], b["c"])} | flags
    return {"g": [merge_item(x, y, keep) for x, y in zip(a["g"], b["g"])]} | flags


def matches(a: list[dict], b: list[dict]) -> list[tuple[int, int]]:
    """A longest common subsequence of the keys, as index pairs.

    Row ``j`` of the table (longest subsequences of the ends of ``a`` with ``b[j:]``) is one
    integer: bit ``n - 1 - i`` is clear where ``a[i]`` makes the subsequence longer.  Every
    ``step``-th row is kept, the rows between are made again, so memory grows with n * sqrt(m) bits."""
    ka, kb = [item_key(i) for i in a], [item_key(i) for i in b]
    n, m = len(ka), len(kb)
    if ka == kb:
        return [(i, i) for i in range(n)]
    places: dict[str, list[int]] = {}
    for i, key in enumerate(ka):
        places.setdefault(key, []).append(n - 1 - i)
    masks = {}
    for key, bits in places.items():
        if len(bits) > 8:                             # few bits are set when they are needed
            mask = bytearray(n // 8 + 1)
            for p in bits:
                mask[p >> 3] |= 1 << (p & 7)
            masks[key] = int.from_bytes(mask, "little")
    full = (1 << n) - 1

    def rows(first: int, last: int, row: int) -> list[int]:
        """Rows ``first`` to ``last - 1``, from row ``last``."""
        out = []
        for j in range(last - 1, first - 1, -1):
            bits = places.get(kb[j])
            if bits:
                mask = masks.get(kb[j]) or sum(1 << p for p in bits)
                both = row & mask
                row = (row + both | row - both) & full
            out.append(row)
        return out[::-1]

    step = max(isqrt(m), 1)
    kept = {m: full}
    for last in range(m, 0, -step):
        kept[max(last - step, 0)] = rows(max(last - step, 0), last, kept[last])[0]
    starts = sorted(kept)
    out, i, j = [], 0, 0
    for first, last in zip(starts, starts[1:]):
        table = rows(first, last, kept[last])
        while i < n and j < last:
            if ka[i] == kb[j]:
                out.append((i, j))
                i, j = i + 1, j + 1
            elif table[j - first] >> (n - 1 - i) & 1:
                i += 1
            else:
                j += 1
    return out


def align(a: list[dict], b: list[dict]) -> list[dict]:
    """The union-free expression of two sequences: what one side lacks is optional."""
    out, i, j = [], 0, 0
    for x, y in [*matches(a, b), (len(a), len(b))]:
        out += [item | {"opt": True} for item in a[i:x] + b[j:y]]
        if x < len(a):
            out.append(merge_item(a[x], b[y]))
        i, j = x + 1, y + 1
    return fold(out)


def infer(pages: list[str | None]) -> list[dict]:
    """The wrapper of some pages of one host: aligned one after another, equal pages once."""
    wrapper: list[dict] | None = None
    for page in dict.fromkeys(pages):
        items = as_items(parse(page), page=xxhash.xxh3_64_intdigest(page or ""))
        wrapper = items if wrapper is None else align(wrapper, items)
    return proven(wrapper or [])


def proven(items: list[dict]) -> list[dict]:
    """The wrapper with texts of fewer than ``SURE`` different pages as slots."""
    out = []
    for i in items:
        known = {"t": i["t"] if len(i.get("n", ())) >= SURE else None} if "t" in i else {
            x: proven(i[x]) for x in ("c", "g") if x in i}
        out.append({x: i[x] for x in i if x != "n"} | known)
    return out


# -- extraction --------------------------------------------------------------------------------------------------
def _blocks_with_main(root: Node, by_word: bool) -> list[Node]:
    """The blocks around the main containers that stand under no left-out block."""
    found, path, listed = [], [(root, iter(root.children))], 0
    while path:
        child = next(path[-1][1], None)
        if child is None:
            path.pop()
            listed = min(listed, len(path))
        elif isinstance(child, Node) and not child.left_out(False, by_word):
            if child.name in MAIN:
                found += [n for n, _ in path[listed:]]
                listed = len(path)
            else:
                path.append((child, iter(child.children)))
    return found


def _free_main(root: Node) -> bool:
    """Whether the page has a main container.  Where each one stands under a word of the list,
    the blocks around them aren't left out."""
    if _blocks_with_main(root, True):
        return True
    around = _blocks_with_main(root, False)
    for node in around:
        node.marked = False
    return bool(around)


def _known(node: Node, wrapper: list[dict]) -> dict[int, dict]:
    """The item of the wrapper for each child of ``node`` that has one."""
    known: dict[int, dict] = {}
    if not wrapper:
        return known
    items = as_items(node, keep=True)
    for i, j in matches(wrapper, items):
        to = wrapper[i]
        members = to["g"] if "g" in to else [to]
        for n, child in enumerate(items[j]["of"]):
            member = members[n % len(members)]
            known[id(child)] = member | {"opt": bool(to.get("opt") or member.get("opt"))}
    return known


def _collect(root: Node, wrapper: list[dict]) -> list[tuple[str, bool, bool]]:
    """Texts of the page, walked along the wrapper: text, whether it stands in a main container,
    whether it is the template's."""
    out, stack = [], [(iter(root.children), _known(root, wrapper), False)]       # children, their items, inside a main container
    while stack:
        children, known, inside = stack[-1]
        child = next(children, None)
        if child is None:
            stack.pop()
            continue
        to = known.get(id(child), {"opt": True})
        if isinstance(child, str):
            out.append((child, inside, to.get("t") == digest(child)))
        elif not child.left_out(inside):
            stack.append((iter(child.children), _known(child, to.get("c", [])), inside or child.name in MAIN))
    return out


def extract(page: str | None, wrapper: list[dict]) -> str:
    root = parse(page)
    has_main = _free_main(root)
    texts = _collect(root, wrapper)
    return "\n".join(text for text, inside, own in texts if (inside if has_main else not own))


@lru_cache(maxsize=256)
def _loaded(text: str | None) -> list[dict]:
    return json.loads(text) if text else []


def host(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _read_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, pages of the host, html -> host, bucket, hash, items (JSON) of every page that is new to the task."""
    seen: set[tuple[str, int]] = set()
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE_ROWS):
            rows = []
            for name, n, page in zip(*(whole.slice(start, SLICE_ROWS).column(k).to_pylist() for k in range(3))):
                h = xxhash.xxh3_64_intdigest(page)
                if (name, h) not in seen:
                    if len(seen) >= _PAGES_REMEMBERED:
                        seen.clear()
                    seen.add((name, h))
                    rows.append((name, h % -(-n // TOGETHER), h - 2 ** 63, json.dumps(as_items(parse(page), page=h))))
            if rows:
                yield _batch(rows)


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Wrappers of one (host, bucket) in the order of their hash as one, equal hashes once."""
    def rows():
        for batch in batches:
            yield from zip(*(batch.column(k).to_pylist() for k in range(4)))

    for (name, bucket), group in groupby(rows(), lambda r: r[:2]):
        wrapper, first, last, count = None, None, None, 0
        for _, _, h, text in group:
            if h == last:
                continue
            if count == 1:
                wrapper = json.loads(wrapper)
            wrapper = text if not count else align(wrapper, json.loads(text))
            first, last, count = h if first is None else first, h, count + 1
        yield _batch([(name, bucket, first, wrapper if count == 1 else json.dumps(wrapper))])


_PARTS = "host string, bucket long, hash long, wrapper string"


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["host", "bucket", "hash", "wrapper"])


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        done = [json.dumps(proven(json.loads(w))) for w in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(done, pa.string())], ["host", "wrapper"])


def infer_wrappers(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, wrapper (JSON): one row per host, from all of its pages."""
    rows = pages.select(host(F.col(url_col)).alias("host"), F.col(html_col).cast("string").alias("html"))
    sizes = stored(rows.groupBy("host").agg(F.count(F.lit(1)).alias("n")), "wrapper-hosts")   # of known size: broadcast if small
    largest = sizes.agg(F.max("n")).first()[0] or 0
    parts = rows.filter("html <> ''").join(sizes, "host").select("host", "n", "html").mapInArrow(_read_pages, _PARTS)
    buckets = -(-largest // TOGETHER)
    while True:
        parts = parts.repartition("host", "bucket").sortWithinPartitions("host", "bucket", "hash").mapInArrow(_merge, _PARTS)
        if buckets <= 1:
            return parts.select("host", "wrapper").mapInArrow(_finish, "host string, wrapper string")
        # the next round takes TOGETHER neighbouring buckets; the number of a bucket keeps their order
        parts = parts.select("host", F.expr(f"bucket div {TOGETHER}").alias("bucket"), F.col("bucket").alias("hash"), "wrapper")
        buckets = -(-buckets // TOGETHER)


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars: one row per row of ``pages``."""
    wrappers = stored(infer_wrappers(pages, url_col, html_col), "wrappers")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).cast("string").alias("html"),
                        host(F.col(url_col)).alias("host")).join(wrappers, "host", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = [extract(p, _loaded(w)) for p, w in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()),
                                              pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    return rows.select("page_id", "url", "html", "wrapper").mapInArrow(
        run, f"page_id {kind}, url string, text string, n_chars long")
