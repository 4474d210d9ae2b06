"""Main text of web pages by markup and nearest-URL page differencing."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from minegrain.functions.ordering import with_row_index
from minegrain.llm.common import row_key, stored
from minegrain.llm.url_rules import with_host_and_path

# Deletions that are sent to every task; more of them are joined by key.
BROADCAST_BYTES = 8_000_000

# Elements that begin a new block.
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td "
    "tfoot th thead title tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# Elements whose content is not text of the page, up to their end tag.
RAW = "script|style|noscript|template|textarea|iframe|svg|math|object|canvas|xmp|noembed|noframes"
# Elements that never hold main text.
BOILER = frozenset("aside button datalist dialog fieldset footer form head label menu nav option search select title".split())
# Words that mark the same, if a class, an id or a role names its element by them.
BOILER_WORDS = frozenset(
    "ad ads advert advertisement advertising banner breadcrumb breadcrumbs comment comments consent contentinfo cookie "
    "cookies disqus footer gdpr masthead menu modal nav navbar navigation newsletter notice notification popup promo "
    "promoted related replies reply search share sharing sidebar signup skip social sponsor sponsored subscribe toolbar "
    "widget".split()
)
# Words before which or after which another word does not name the element, and words that may follow the name.
NOT_AFTER = frozenset("has hide no non not show with without".split())
SIDES = frozenset("bottom left right top".split())
HOLDERS = frozenset("area bar block box container holder inner items item links link list panel post posts section slot unit wrap wrapper".split())
REGION = frozenset(["article", "main"])

_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({RAW})\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:\"[^\"]*\"|'[^']*'|[^'\">])*)>|<[!?][^>]*>|[^<]+|<",
    re.S | re.I,
)
_MARK = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[a-z0-9]+")
_SPACE = re.compile(r"\s+")


def _names(token: str, marks: frozenset[str]) -> bool:
    """Whether a class, an id or a role names its element by one of `marks`: alone, as the last word, or before a holder.

    A word before a side names it only without other words: sidebar-left does, layout-menu-left is a layout.
    """
    words = [w for w in _PART.findall(token.lower()) if not w.isdigit()]
    while len(words) > 1 and words[-1] in HOLDERS and words[-1] not in marks:
        words.pop()
    if not words or NOT_AFTER & set(words):
        return False
    if words[-1] in SIDES:
        rest = [w for w in words if w not in SIDES]
        return bool(rest) and all(w in marks for w in rest)
    return words[-1] in marks


def _by_tag(tag: str, inside: bool) -> bool:
    return tag in BOILER or tag == "header" and not inside


def _by_name(tag: str, attributes: str, inside: bool) -> bool:
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    marks = BOILER_WORDS if inside else BOILER_WORDS | {"header"}
    return any(_names(t, marks) for m in _MARK.finditer(attributes) for t in (m[1] or m[2] or m[3] or "").split())


def blocks_of(page: str | None) -> list[tuple[str, int]]:
    """(text, kind) of each block with text, in page order. kind: 2 in an article or main element, 1 elsewhere, 0 boilerplate.

    Character references are decoded, white space becomes one space, and line breaks inside a block are white space. A name
    makes no element boilerplate that holds most of the plain text, unless an article or main element outside has text.
    """
    out: list[tuple[str, int, frozenset[int]]] = []
    stack: list[tuple[str, bool, bool, frozenset[int]]] = []  # tag, boilerplate by tag, in a region, elements marked by name
    text: list[str] = []
    kind, marks, n_marks = 1, frozenset(), 0

    def close() -> None:
        if text:
            whole = _SPACE.sub(" ", html.unescape("".join(text))).strip()
            text.clear()
            if whole:
                out.append((whole, kind, marks))

    for m in _TOKEN.finditer(page or ""):
        tag = m[3]
        if tag is None:
            token = m[0]
            if token[0] != "<" or token == "<":
                text.append(token)
            continue
        tag = tag.lower()
        if tag == "br":
            text.append(" ")
            continue
        if tag in BLOCK:
            close()
        if m[2]:
            for at in range(len(stack) - 1, -1, -1):
                if stack[at][0] == tag:
                    if any(s[1] or s[3] for s in stack[at:]):
                        close()
                    del stack[at:]
                    break
        elif tag not in VOID:
            boiler, inside, named = stack[-1][1:] if stack else (False, False, frozenset())
            own = _by_tag(tag, inside)
            if not own and _by_name(tag, m[4], inside):
                named, n_marks = named | {n_marks}, n_marks + 1
                close()
            if own:
                close()
            if tag in ("p", "li") and stack and stack[-1][0] == tag:
                stack.pop()
            stack.append((tag, boiler or own, inside or tag in REGION, named))
        marks = stack[-1][3] if stack else frozenset()
        kind = (0 if stack[-1][1] else 2 if stack[-1][2] else 1) if stack else 1
    close()
    plain = sum(len(t) for t, k, _ in out if k)
    held: dict[int, int] = {}
    for t, k, named in out:
        for x in named if k else ():
            held[x] = held.get(x, 0) + len(t)
    most = {x for x, n in held.items() if 2 * n > plain and not any(k == 2 and x not in named for _, k, named in out)}
    return [(t, 0 if named - most else k) for t, k, named in out]


def line_hashes(blocks: list[tuple[str, int]]) -> list[int]:
    return [xxhash.xxh3_64_intdigest(t.encode("utf-8", "replace")) - (1 << 63) for t, _ in blocks]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Positions in `a` of a longest common subsequence with `b`: bit rows of whole numbers, one per line of `b`."""
    where: dict[int, int] = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row, rows = full, []
    for y in b:
        match = where.get(y, 0)
        row = (row + (row & match) | row & ~match) & full
        rows.append(row)
    # A zero bit at i after b[j] says that a[: i + 1] shares one line more with b[: j + 1] than a[:i] does.
    out, i, j = [], len(a) - 1, len(b) - 1
    while i >= 0 and j >= 0:
        if rows[j] >> i & 1:
            i -= 1
        elif j > 0 and not rows[j - 1] >> i & 1:
            j -= 1
        else:
            out.append(i)
            i -= 1
            j -= 1
    return out[::-1]


def _nearest(pages: DataFrame) -> DataFrame:
    """Each page with the lines of the page next to it by (host, path): the neighbour with the longer common path.

    Positions in one global sort give the neighbours, so a host of any size is spread over many tasks.
    """
    indexed = with_row_index(pages, ["host", "path", "key"], "at")
    other = indexed.select("host", F.col("path").alias("path_b"), F.col("lines").alias("lines_b"), "at")
    before = other.select("host", F.col("path_b").alias("path_p"), F.col("lines_b").alias("lines_p"), (F.col("at") + 1).alias("at"))
    after = other.select("host", F.col("path_b").alias("path_n"), F.col("lines_b").alias("lines_n"), (F.col("at") - 1).alias("at"))
    return indexed.join(before, ["at", "host"], "left").join(after, ["at", "host"], "left")


def _same(a: str, b: str) -> int:
    n = 0
    for x, y in zip(a, b):
        if x != y:
            break
        n += 1
    return n


def shared_lines(pages: DataFrame, key: str, url_col: str, html_col: str) -> DataFrame:
    """(key, gone): positions of the plain blocks that a page shares with its nearest page, for pages that have any."""

    @F.pandas_udf("lines array<bigint>, kinds array<int>")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            parsed = [blocks_of(p) for p in b]
            yield pd.DataFrame({"lines": [line_hashes(x) for x in parsed], "kinds": [[k for _, k in x] for x in parsed]})

    rows = with_host_and_path(pages.select(F.col(key).alias("key"), F.col(url_col).alias("__u"), html_col), "__u")
    rows = rows.withColumn("__p", parse(F.col(html_col).cast("string"))).select(
        "key", "host", "path", F.col("__p.lines").alias("lines"), F.col("__p.kinds").alias("kinds")
    )

    @F.pandas_udf("array<int>")
    def align(path: pd.Series, lines: pd.Series, kinds: pd.Series, pp: pd.Series, lp: pd.Series, pn: pd.Series, ln: pd.Series) -> pd.Series:
        out = []
        for p, own, kind, path_p, lines_p, path_n, lines_n in zip(path, lines, kinds, pp, lp, pn, ln):
            own = list(own)
            beside = [(q, list(x)) for q, x in ((path_p, lines_p), (path_n, lines_n)) if q is not None]
            beside = [(_same(p, q), x) for q, x in beside if x != own]
            got = common_lines(own, max(beside, key=lambda b: b[0])[1]) if beside else []
            out.append([i for i in got if kind[i] == 1])
        return pd.Series(out)

    found = _nearest(rows).select(
        "key", align("path", "lines", "kinds", "path_p", "lines_p", "path_n", "lines_n").alias("gone")
    )
    return found.filter(F.size("gone") > 0)


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Per row: id, url, text (blocks joined by an empty line) and n_chars.

    Each page is aligned with the page of its host whose URL path is nearest, by a longest common subsequence of its text
    lines. Shared lines go, unless the page marks them as part of its article: pages do quote the same passages. Blocks in
    elements for menus, headers, footers, sidebars, notices, adverts, forms and comments go as well; if the page has an
    article or main element with text, only its blocks stay.

    Null html is empty and gives an empty text. Null urls have an empty host and pair with each other. Repeated rows get the
    same text. A neighbour with exactly the same lines says nothing; pages without another lose no shared lines. An empty table gives an empty result; other columns are
    ignored.
    """
    rows = pages.select(F.col(id_col).alias("__id"), F.col(url_col).alias("__url"), F.col(html_col).alias("__html"))
    rows = rows.withColumn("__key", row_key("__id", "__url", "__html"))
    gone = shared_lines(rows, "__key", "__url", "__html").dropDuplicates(["key"]).withColumnRenamed("key", "__key")
    gone = stored(gone, "shared-lines")
    size = gone.agg(F.sum(F.size("gone") * 4 + 40)).first()[0] or 0
    gone = F.broadcast(gone) if size <= BROADCAST_BYTES else gone

    @F.pandas_udf("string")
    def keep(page: pd.Series, drop: pd.Series) -> pd.Series:
        out = []
        for p, d in zip(page, drop):
            blocks = blocks_of(p)
            lost = set() if d is None else set(np.asarray(d).tolist())
            left = [(t, k) for i, (t, k) in enumerate(blocks) if k and i not in lost]
            if any(k == 2 for _, k in left):
                left = [x for x in left if x[1] == 2]
            out.append("\n\n".join(t for t, _ in left))
        return pd.Series(out)

    out = rows.join(gone, "__key", "left").withColumn("__t", keep(F.col("__html").cast("string"), "gone"))
    return out.select(
        F.col("__id").alias(id_col),
        F.col("__url").alias(url_col),
        F.col("__t").alias("text"),
        F.length("__t").cast("long").alias("n_chars"),
    )
