"""Main-text extraction with wrappers inferred from all pages of a host.

A wrapper is a union-free expression over the blocks and tags of a host's pages:
items with the path of open elements (their class, id and role; digits as one
sign), each once, optional or repeated.  A page is a token stream whose runs of
equal groups are folded into repeated ones.  Streams of one shape are merged by
an aggregate; the different shapes of a host are then aligned, at most some 64 by
one task, and their wrappers in further rounds until one is left.  Tokens that
only one side has become optional, or a repeat of the group before them; a
string that differs becomes a text slot.  A string every page with the item has
is a constant, the host's template.

Extraction walks a page once.  Of its elements the one with the most text in
slots is the main one (ties: the most text at all): among marked articles if the
host has a layout with them, else among the containers of paragraphs, lists and
headings, a repeated group counting with all its members.  Everything inside the
main element is kept, constants too; outside it constants are dropped.  Tags and
classes made for menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles and comments are left out, unless the element holds the main one.

Pages with the same longest string and the same smallest string hash count as
one, so copies and near copies do not turn an article into a template.  A host's
wrapper meets its pages in a join that adaptive execution may split, so a host
may have any number of pages.

Edge cases: null or empty html gives an empty text; null urls are one host;
truncated pages, unclosed tags and stray brackets are read as far as they go;
repeated pages give equal texts; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

LEAST_PAGES = 3            # distinct pages that must agree on a string before it counts as template
ARTICLE_SHARE = 0.1        # of a host's distinct pages: marked articles on fewer are no layout
HINT = 0.25                # weight of text below a marked element in the choice of the main one
LONGEST_GROUP = 8          # tokens of a repeated group
FAN_IN = 64                # wrappers one task aligns, about
ALIGN_CELLS = 1 << 22      # not used: pairs of any length are aligned whole; kept for callers that set it

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                    "samp small span strike strong sub sup time tt u var wbr").split())
LEFT_OUT = frozenset(("head title script style noscript template nav header footer aside form button select option "
                      "textarea input iframe object svg canvas dialog menu").split())
CLOSED_BY_BLOCK = frozenset(["p", "h1", "h2", "h3", "h4", "h5", "h6"])
OWN_CLOSE = {"li": "li", "dt": "dt", "dd": "dd", "tr": "tr", "td": "td", "th": "th", "option": "option"}
ARTICLE = ("article", "main")
FLOW = INLINE | frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl li dt dd table blockquote pre figure".split())
NAMED_OUT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisement|banner|cookies?|consent|notice|alert|comments?|replies|reply|sidebar|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|share|sharing|social|related|recommended|promo|"
    r"sponsored|sponsor|popup|modal|newsletter|subscribe|signup|login|search|widget|toolbar|pagination|pager|disclaimer)"
    r"(?:$|[\s_-])", re.I)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|title|textarea|iframe|svg)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<[!?][^>]*>?|</?[a-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>|</?[a-z][^>]*(?:>|\Z)|[^<]+|<", re.S | re.I)
NAME = re.compile(r"</?([a-z][^\s/>]*)", re.I)
MARKS = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)

STREAMS = "host string, page long, article boolean, shape long, skeleton string, strings array<long>"
WRAPPER = "host string, shape long, skeleton string, strings array<long>, counts array<long>"
TEXTS = "page_id long, url string, text string, n_chars long"


_TAGS: dict[str, tuple] = {}


def _tag(token: str) -> tuple[str, bool, str, bool]:
    """(name, whether it closes, key with marks, whether it opens an element), remembered by tag text."""
    got = _TAGS.get(token)
    if got is None:
        name = NAME.match(token).group(1).lower()
        marks = " ".join(filter(None, (x for m in MARKS.findall(token) for x in m))) if "=" in token else ""
        marks = marks.replace("/", "|")
        got = (name, token[1] == "/", f"{name}[{marks}]" if marks else name,
               name not in VOID and not token.endswith("/>"))
        if len(_TAGS) > 20_000:
            _TAGS.clear()
        if len(token) < 200:
            _TAGS[token] = got
    return got


def walk(page: str) -> Iterator[tuple[str, str, str]]:
    """(kind, path, value): 'open' and 'close' with the element, 'text' with its string.
    A path lists the open elements with their class, id and role."""
    stack: list[tuple[str, str, str]] = []       # name, key, path
    path = ""
    for m in TOKEN.finditer(page):
        token = m.group()
        if token[0] != "<" or token == "<":
            yield "text", path, token
            continue
        if m.lastindex or token[1] in "!?":
            continue
        name, closes, key, opens = _tag(token)
        if closes:
            if any(e[0] == name for e in stack):
                while stack.pop()[0] != name:
                    pass
                path = stack[-1][2] if stack else ""
            yield "close", path, name
            continue
        if name not in INLINE and name not in VOID:
            ends = CLOSED_BY_BLOCK if name not in OWN_CLOSE else (OWN_CLOSE[name],)
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in ends:
                    del stack[i:]
                    path = stack[-1][2] if stack else ""
                    break
                if stack[i][0] not in INLINE:
                    break
        if opens:
            path = f"{path}/{key}" if path else key
            stack.append((name, key, path))
        yield "open", path, key


@lru_cache(maxsize=20_000)
def marked(key: str) -> bool:
    """Whether an element's tag or marks say that it is no article."""
    name, _, marks = key.partition("[")
    return name in LEFT_OUT or bool(marks and name not in ("html", "body") and NAMED_OUT.search(marks[:-1]))


@lru_cache(maxsize=50_000)
def left_out(path: str, main: tuple[str, ...] = ()) -> bool:
    """Whether a marked element is open, other than those that hold the main one."""
    holds = len(main) - 1
    for k, key in enumerate(path.split("/")):
        if k < holds and key == main[k]:
            continue
        holds = 0
        if marked(key):
            return True
    return False


def in_article(path: str) -> bool:
    return any(k.partition("[")[0] in ARTICLE for k in path.split("/"))


# --- wrappers: items are [key, string or None for a slot, times, pages that have it], times one of "", "?", "+"


def fold(items: list[list]) -> list[list]:
    """Folds runs of equal groups into one repeated group; strings that differ become slots."""
    for size in range(1, LONGEST_GROUP + 1):
        out: list[list] = []
        i = 0
        while i < len(items):
            keys = [x[0] for x in items[i:i + size]]
            j = i + size
            while len(keys) == size and [x[0] for x in items[j:j + size]] == keys:
                j += size
            if j > i + size and any(k[0] != "text" for k in keys):
                for k in range(size):
                    strings = {items[p][1] for p in range(i + k, j, size)}
                    out.append([keys[k], strings.pop() if len(strings) == 1 else None, "+", 1])
                i = j
            else:
                out.append(items[i])
                i += 1
        items = out
    return items


@lru_cache(maxsize=20_000)
def block_of(path: str) -> str:
    """The path without the inline elements at its end."""
    keys = path.split("/")
    while keys and keys[-1].partition("[")[0] in INLINE:
        keys.pop()
    return "/".join(keys)


def read(page: str) -> tuple[list[tuple[str, str, str, int]], list[tuple[str, str]]]:
    """(events of ``walk``, each text with the number of its block or -1; (path, string) of the blocks)."""
    events, found, inside = [], [], False
    for kind, path, value in walk(page):
        k = -1
        if kind == "text":
            if region(path) is not None and (inside or value.strip()):
                if not inside:
                    found.append((block_of(path), []))
                    inside = True
                found[-1][1].append(value)
                k = len(found) - 1
        else:
            name = value.partition("[")[0]
            if name == "br":
                if inside:
                    found[-1][1].append(" ")
            elif name not in INLINE:
                inside = False
        events.append((kind, path, value, k))
    return events, [(path, " ".join("".join(parts).split())) for path, parts in found]


def stream(events: list[tuple[str, str, str, int]], blocks: list[tuple[str, str]]) -> list[list]:
    """The folded token stream of a page: its blocks and the tags that are neither inline nor left out."""
    out, last = [], -1
    for kind, path, value, k in events:
        if kind == "text":
            if k > last:
                out.append([("text", _place(blocks[k][0])), blocks[k][1], "", 1])
                last = k
            continue
        name = value.partition("[")[0]
        if path and name not in INLINE and name not in VOID and not left_out(path):
            out.append([(kind, _place(path) if kind == "open" else f"{_place(path)}>{name}"), "", "", 1])
    return fold(out)


def tokens(page: str) -> list[list]:
    return stream(*read(page))


def _merge(a: list, b: list) -> list:
    return [a[0], a[1] if a[1] == b[1] else None, "?" if "?" in (a[2], b[2]) else a[2] or b[2], a[3] + b[3]]


class _Runs:
    """Longest common runs of two lists.  ``names[p]`` numbers the runs of 2 ** p items of both, so
    two runs of any length are equal if their first and last halves are (which may overlap)."""

    def __init__(self, mine: list, other: list):
        known: dict = {}
        self.cut = len(mine)
        self.names = [np.array([known.setdefault(x, len(known)) for x in (*mine, *other)], dtype=np.int64)]
        while 2 << len(self.names) - 1 <= min(len(mine), len(other)):
            step = 1 << len(self.names) - 1
            pairs = self.names[-1][:-step] * (len(mine) + len(other)) + self.names[-1][step:]
            self.names.append(np.unique(pairs, return_inverse=True)[1].astype(np.int64))

    def _at(self, i: int, i2: int, size: int) -> np.ndarray:
        """The runs of ``size`` items that lie in i:i2."""
        p = size.bit_length() - 1
        names, last = self.names[p], i2 - size + 1
        return names[i:last] * (self.names[0].size + 1) + names[i + size - (1 << p):last + size - (1 << p)]

    def longest(self, i: int, i2: int, j: int, j2: int, most: int) -> tuple[int, int, int]:
        """(start in the first, start in the second, size <= ``most``) of the longest common run of i:i2
        and j:j2, the earliest in the first and then in the second."""
        found, low, high = (i, j, 0), 1, min(most, i2 - i, j2 - j)
        while low <= high:
            size = low + high >> 1
            a, b = self._at(i, i2, size), self._at(self.cut + j, self.cut + j2, size)
            both = np.isin(a, b)
            at = int(both.argmax())
            if both[at]:
                found, low = (i + at, j + int((b == a[at]).argmax()), size), size + 1
            else:
                high = size - 1
        return found


def _steps(mine: list, other: list) -> list[tuple[str, int, int, int, int]]:
    """The opcodes of ``difflib.SequenceMatcher`` without junk, for lists of any length."""
    runs, blocks = _Runs(mine, other), []
    rest = [(0, len(mine), 0, len(other), len(mine))]
    while rest:
        i, i2, j, j2, most = rest.pop()
        a, b, size = runs.longest(i, i2, j, j2, most)
        if size:
            blocks.append((a, b, size))
            rest += [(i, a, j, b, size), (a + size, i2, b + size, j2, size)]
    out: list[tuple[str, int, int, int, int]] = []
    i = j = 0
    for a, b, size in [*sorted(blocks), (len(mine), len(other), 0)]:
        if i < a or j < b:
            out.append(("replace" if i < a and j < b else "delete" if i < a else "insert", i, a, j, b))
        if size and out and out[-1][0] == "equal":
            out[-1] = ("equal", out[-1][1], a + size, out[-1][3], b + size)
        elif size:
            out.append(("equal", a, a + size, b, b + size))
        i, j = a + size, b + size
    return out


def align(wrapper: list[list], page: list[list]) -> list[list]:
    """The wrapper that also matches ``page``, a page's stream or another wrapper."""
    mine, other = [x[0] for x in wrapper], [x[0] for x in page]
    if mine == other:
        return [_merge(a, b) for a, b in zip(wrapper, page)]
    out: list[list] = []
    for op, i, i2, j, j2 in _steps(mine, other):
        if op == "equal":
            out += [_merge(a, b) for a, b in zip(wrapper[i:i2], page[j:j2])]
            continue
        for extra in (wrapper[i:i2], page[j:j2]):
            keys = [x[0] for x in extra]
            if keys and [x[0] for x in out[-len(keys):]] == keys:       # repeats the group before it
                out[-len(keys):] = [[a[0], a[1] if a[1] == b[1] else None, "+", max(a[3], b[3])]
                                    for a, b in zip(out[-len(keys):], extra)]
            else:
                out += [[k, s, "?", n] for k, s, _, n in extra]
    return out


@lru_cache(maxsize=20_000)
def region(path: str) -> tuple[tuple[str, ...], bool, float] | None:
    """(element, whether it is a marked article, weight) of the element a text may be the main
    text of: its outermost article, else the container of its paragraph.  None if that element
    or one inside it is marked; below a marked one it has less weight."""
    keys = path.split("/")
    names = [k.partition("[")[0] for k in keys]
    article = next((k + 1 for k, n in enumerate(names) if n in ARTICLE), 0)
    size = article or next((k for k, n in enumerate(names) if n in FLOW), len(keys))
    if any(marked(k) for k in keys[max(size - 1, 0):]):
        return None
    return tuple(keys[:size]), bool(article), HINT if any(marked(k) for k in keys[:size]) else 1.0


def _number(*parts: str) -> int:
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


@lru_cache(maxsize=20_000)
def _place(path: str) -> str:
    return re.sub(r"\d+(?=[^/\[]*\])", "0", path)      # in marks, not in the names of elements


def _string(path: str, value: str) -> int:
    return _number(_place(path), value)


def summary(page: str) -> tuple[int, bool, list[list]]:
    """(number of the page, whether a marked article has text, its stream with strings as hashes)."""
    events, blocks = read(page)
    items = [[key, _string(key[1], s) if key[0] == "text" and s is not None else s, times, n]
             for key, s, times, n in stream(events, blocks)]
    longest = max((s for _, s in blocks), key=lambda x: (len(x), x), default="")
    least = min((_string(path, s) for path, s in blocks), default=None)
    return _number(longest, str(least)), any(region(path)[1] for path, _ in blocks), items


def pack(items: list[list]) -> tuple[str, list, list]:
    """(skeleton, strings, counts) of a wrapper; strings and counts of its text items only."""
    texts = [x for x in items if x[0][0] == "text"]
    return json.dumps([[*x[0], x[2]] for x in items]), [x[1] for x in texts], [x[3] for x in texts]


def unpack(skeleton: str, strings: Iterable, counts: Iterable) -> list[list]:
    strings, counts = iter(strings), iter(counts)
    return [[(kind, path), next(strings), times, next(counts)] if kind == "text" else [(kind, path), "", times, 1]
            for kind, path, times in json.loads(skeleton)]


def align_all(wrappers: Iterable[list[list]]) -> list[list]:
    out: list[list] = []
    for w in wrappers:
        out = align(out, w) if out else w
    return out


def constants(strings: Iterable, counts: Iterable) -> list[int]:
    return [s for s, n in zip(strings, counts) if s is not None and n >= LEAST_PAGES]


def infer(pages: list[str]) -> dict:
    """Rules of a host as extraction uses them: whether the host has a layout with marked articles,
    and the constants of its wrapper.  The same as ``wrappers``, of at most FAN_IN shapes in memory."""
    streams: dict[int, tuple] = {}
    for p in pages:
        number, article, items = summary(p)
        skeleton, strings, _ = pack(items)
        mine = (_number(skeleton), skeleton, [(s is not None, s or 0) for s in strings], article, items)
        streams[number] = min(streams.get(number, mine), mine, key=lambda x: x[:4])
    shapes: dict[int, list] = {}
    for shape, _, _, _, items in streams.values():
        shapes[shape] = align(shapes[shape], items) if shape in shapes else items
    _, strings, counts = pack(align_all(shapes[k] for k in sorted(shapes)))
    marked_pages = sum(x[3] for x in streams.values())
    return {"article": 0 < marked_pages >= ARTICLE_SHARE * len(streams), "template": set(constants(strings, counts))}


@lru_cache(maxsize=50_000)
def within(path: str, main: tuple[str, ...]) -> bool:
    return tuple(path.split("/")[:len(main)]) == main


def extract(page: str | None, rules: dict) -> str:
    """Main text of a page: white space folded within blocks, blocks joined by a space."""
    if not page:
        return ""
    template = rules.get("template", ())
    events, blocks = read(page)
    slot = [not template or _string(path, string) not in template for path, string in blocks]
    weight: dict[bool, dict[tuple, list]] = {True: defaultdict(lambda: [0.0, 0.0]), False: defaultdict(lambda: [0.0, 0.0])}
    for (path, string), varies in zip(blocks, slot):
        element, article, share = region(path)
        w = weight[article][element]
        w[0] += len(string) * share * varies
        w[1] += len(string) * share
    for article in (True, False):
        if article and (not weight[True] or rules.get("article") is False):
            continue
        regions = weight[True] if article else {**weight[False], **weight[True]}
        main = max(regions, key=lambda r: (regions[r], r), default=())
        seen = [(kind, path, value) for kind, path, value, k in events
                if article or k < 0 or slot[k] or within(path, main)]
        out = _extract(seen, main, article)
        if out:
            return " ".join(out)
    return ""


def _extract(seen: list[tuple[str, str, str]], main: tuple[str, ...], article: bool) -> list[str]:
    verdict: dict[str, bool] = {}
    out: list[str] = []
    block: list[str] = []

    def finish():
        words = " ".join(entities.unescape("".join(block)).split())
        if words:
            out.append(words)
        block.clear()

    for kind, path, value in seen:
        if kind == "text":
            keep = verdict.get(path)
            if keep is None:
                keep = verdict[path] = not left_out(path, main) and (in_article(path) or not article)
            if keep:
                block.append(value)
        else:
            name = value.partition("[")[0]
            if name == "br":
                block.append(" ")
            elif name not in INLINE:
                finish()
    finish()
    return out


def host_of(url: Column) -> Column:
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def _align_group(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("shape")
    skeleton, strings, counts = pack(align_all(map(unpack, rows["skeleton"], rows["strings"].map(_longs), rows["counts"])))
    return pd.DataFrame({"host": [key[0]], "shape": [key[1]], "skeleton": [skeleton],
                         "strings": [pd.array(strings, "Int64")], "counts": [counts]})


def _longs(strings: Iterable) -> list:
    return [int(s) if s else None for s in strings]


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, rules) inferred from all pages of each host of ``pages`` (host, html)."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = []
            for host, page in zip(b.column("host").to_pylist(), b.column("html")):
                number, article, items = summary(page.as_py())
                skeleton, strings, _ = pack(items)
                rows.append((host, number, article, _number(skeleton), skeleton, strings))
            columns = zip(*rows) if rows else ((),) * 6
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (
                pa.string(), pa.int64(), pa.bool_(), pa.int64(), pa.string(), pa.list_(pa.int64())))],
                names=["host", "page", "article", "shape", "skeleton", "strings"])

    found = pages.where(F.octet_length("html") > 0).select("host", "html").mapInArrow(run, STREAMS)
    distinct, _ = stored(found.groupBy("host", "page").agg(F.min(F.struct("shape", "skeleton", "strings", "article")).alias("s"))
                         .select("host", "s.*"), "wrapper-streams")
    layout = distinct.groupBy("host").agg((F.count_if("article") > 0).alias("any"),
                                          (F.count_if("article") >= ARTICLE_SHARE * F.count("*")).alias("enough"))
    # one wrapper a shape: a string all its pages have is a constant, else null
    items = distinct.select("host", "shape", F.posexplode("strings").alias("pos", "s")).groupBy("host", "shape", "pos").agg(
        F.min("s").alias("least"), F.max("s").alias("most"), F.count("s").alias("m"), F.count("*").alias("n"))
    items = items.select(F.col("host").alias("h"), F.col("shape").alias("k"), F.struct(
        "pos", F.expr("CASE WHEN m = n AND least = most THEN least END").alias("s"), "n").alias("item"))
    items = items.groupBy("h", "k").agg(F.sort_array(F.collect_list("item")).alias("items"))
    shapes = distinct.groupBy("host", "shape").agg(F.min("skeleton").alias("skeleton"))
    w, _ = stored(shapes.join(items, F.expr("host = h AND shape = k")).select(
        "host", "shape", "skeleton", F.expr("items.s").alias("strings"), F.expr("items.n").alias("counts")), "wrapper-shapes")
    while True:
        sizes = w.groupBy(F.col("host").alias("h")).agg(F.count("*").alias("n"))
        most = sizes.agg(F.max("n")).first()[0]
        if most is None or most == 1:
            break
        parts = F.expr(f"pmod(shape, (n + {FAN_IN - 1}) div {FAN_IN})")
        dealt = w.join(sizes, F.expr("host = h")).select("host", "shape", "skeleton", F.transform(
            "strings", lambda s: s.cast("string")).alias("strings"), "counts", parts.alias("part"))
        w, _ = stored(dealt.groupBy("host", "part").applyInPandas(_align_group, WRAPPER), "wrapper-aligned")
    template = F.expr(f"transform(filter(arrays_zip(strings, counts), x -> x.strings IS NOT NULL AND x.counts >= {LEAST_PAGES}), x -> x.strings)")
    rules = w.select(F.col("host").alias("h"), template.alias("template"))
    return layout.join(rules, F.expr("host = h"), "left").select("host", F.to_json(F.struct(
        F.expr("any AND enough").alias("article"),
        F.coalesce("template", F.array().cast("array<long>")).alias("template"))).alias("rules"))


def extract_all(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    rules, _ = stored(wrappers(rows).withColumnRenamed("host", "h"), "wrapper-rules")
    joined = rows.join(rules, F.col("host") == F.col("h"), "left").select("page_id", "url", "html", "rules")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, dict] = {}
        for b in batches:
            texts = []
            for page, raw in zip(b.column("html"), b.column("rules")):
                raw = raw.as_py() or "{}"
                if raw not in known:
                    if len(known) > 1000:
                        known.clear()
                    known[raw] = json.loads(raw)
                    known[raw]["template"] = frozenset(known[raw].get("template", ()))
                texts.append(extract(page.as_py(), known[raw]))
            yield pa.RecordBatch.from_arrays(
                [b.column("page_id"), b.column("url"), pa.array(texts, pa.string()),
                 pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, TEXTS)
