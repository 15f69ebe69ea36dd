"""HTML extraction by differencing pages with the nearest URL (operator 9).

Every page is cut into lines (the text of its blocks, in page order). Pages of one host with equal
lines are one content, at the first of their URL paths. Contents are ordered by host and path; each is
compared with the ``SIDE`` nearest on both sides in that order. Lines are aligned with a longest
common subsequence, and lines shared with neighbours are deleted as template, in all copies alike.

The markup is a check on that. A line outside all main markup goes if one neighbour shares it; a line
inside a ``main`` (or an element named so), which may hold template too, if two do; a line inside an
``article``, which is one text, only if at least three neighbours that are not versions of the page do,
and no such neighbour lacks it (so quoted passages stay). Lines inside navigation, header, footer,
sidebar, notice, advert, form, comment and script markup are never main text, even if only one page
has them. A neighbour that shares all lines of a page is a copy, not a witness of the template, and
is not used; one that shares three quarters of them or more is a version.

Order and pairing use narrow rows (host, path, hashes of lines): a global range sort, an index from
partition sizes, and blocks of that index which overlap by ``SIDE``, so a host with a third of all
pages is spread over many tasks.
Pages are cut once for their hashes and again for their lines, which saves storing all lines.

Defined results: null html is an empty page with empty text; a null or odd URL has an empty host
and sorts first; repeated rows each get their row; without a neighbour only the markup decides.
Extra columns are not used.
"""

from __future__ import annotations

import re
from html import unescape

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import staged, table, whole_text

OPEN, MAIN, AROUND, ARTICLE = 0, 1, 2, 3
SIDE = 2                    # neighbours on each side
BLOCK = 256                 # contents that are paired together

_TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|textarea|title|svg|iframe)\b(?:[^>\"']|\"[^\"]*\"|'[^']*')*>.*?(?:</\1\s*>|\Z)"
                    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|</?[a-zA-Z][^<>]*>", re.S | re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr".split())
_AROUND = frozenset("nav header footer aside form menu dialog button select head noscript iframe object".split())
_HINT = re.compile(r"(?:class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
_AROUND_HINT = re.compile(r"(?:^|[\s_-])(?:ads?|advert\w*|banner|sponsor\w*|promo\w*|nav\w*|menu\w*|breadcrumbs?|header|footer|sidebar\w*|side|aside|"
                          r"widgets?|cookies?|consent|notices?|popup|modal|newsletter|subscribe|share|social|related|comments?|replies|reply|disqus|login|search|"
                          r"complementary|contentinfo|navigation|banner)(?:$|[\s_-])", re.I)
_MAIN_HINT = re.compile(r"(?:^|[\s_-])main(?:$|[\s_-])", re.I)
_ARTICLE_HINT = re.compile(r"(?:^|[\s_-])(?:article\w*|post-body|entry-content)(?:$|[\s_-])", re.I)
_SELF_CLOSED_BY = {"p": frozenset("p div ul ol li table article section h1 h2 h3 h4 h5 h6 header footer nav aside form blockquote pre main".split()),
                   "li": frozenset(["li"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]),
                   "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "option": frozenset(["option"])}


def _zone(tag: str, attributes: str, outer: int) -> int:
    """Of the inside of an element; boilerplate inside an article is still boilerplate, not the other way round."""
    if outer == AROUND:
        return AROUND
    hints = " ".join(x.strip("\"'") for x in _HINT.findall(attributes)) if "=" in attributes else ""
    if tag == "header" and outer in (MAIN, ARTICLE):       # an article's own heading
        return outer
    if tag in _AROUND or (hints and tag not in ("body", "html") and _AROUND_HINT.search(hints)):
        return AROUND
    if tag == "article" or (hints and _ARTICLE_HINT.search(hints)):
        return ARTICLE
    if outer == OPEN and (tag == "main" or (hints and _MAIN_HINT.search(hints))):
        return MAIN
    return outer


def lines(html: str) -> list[tuple[str, int]]:
    """(text, zone) of each block with text, in page order."""
    out: list[tuple[str, int]] = []
    stack: list[tuple[str, int]] = []
    parts: list[str] = []
    zone, at = OPEN, 0

    def end_block() -> None:
        text = " ".join(unescape("".join(parts)).split())
        parts.clear()
        if text:
            out.append((text, zone))

    for m in _TOKEN.finditer(html):
        if m.start() > at:
            parts.append(html[at:m.start()])
        at = m.end()
        tag = m[3]
        if tag is None:
            continue
        tag = tag.lower()
        if tag in _INLINE and not ("=" in (m[4] or "") and _AROUND_HINT.search(" ".join(_HINT.findall(m[4])).replace('"', " "))):
            if tag == "br":
                parts.append(" ")
            if not any(tag == t for t, _ in stack):
                continue
        end_block()
        if m[2]:                                # an end tag closes its element and all open inside it
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
        else:
            if stack and tag in _SELF_CLOSED_BY.get(stack[-1][0], ()):
                stack.pop()
            if tag not in _VOID and not (m[4] or "").rstrip().endswith("/"):
                outer = stack[-1][1] if stack else OPEN
                stack.append((tag, _zone(tag, m[4] or "", outer)))
        zone = stack[-1][1] if stack else OPEN
    parts.append(html[at:])
    end_block()
    return out


def shared(own: list[int], other: list[int]) -> list[bool]:
    """Which items of ``own`` a longest common subsequence with ``other`` holds.

    Bit-parallel: a row of the table is one integer, a bit for each item of ``own``."""
    n = len(own)
    out = [False] * n
    where: dict[int, int] = {}
    for i, x in enumerate(own):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << n) - 1
    row, rows = full, [full]
    for y in other:
        hit = row & where.get(y, 0)
        row = ((row + hit) | (row - hit)) & full
        rows.append(row)
    i, j = len(other), n
    while i and j:
        bit = 1 << (j - 1)
        if rows[i] & bit:                       # column j adds nothing here
            j -= 1
        elif not rows[i - 1] & bit:             # row i adds nothing here
            i -= 1
        else:
            out[j - 1] = True
            i, j = i - 1, j - 1
    return out


def deleted(own: list[int], others: list[list[int]]) -> list[bool]:
    """Which lines (hash, and zone in the two low bits) the neighbours show to be template."""
    n, witnesses = len(own), 0
    times, in_others = [0] * n, [0] * n
    for other in others:
        common = shared(own, other)
        if all(common):                         # a copy of the page
            continue
        times = [k + c for k, c in zip(times, common)]
        if 4 * common.count(False) > n:         # else a version of it
            witnesses += 1
            in_others = [k + c for k, c in zip(in_others, common)]
    least = {OPEN: 1, MAIN: 2}
    return [k == witnesses >= 3 if x & 3 == ARTICLE else t >= least[x & 3] for x, t, k in zip(own, times, in_others)]


def _cut(html: str) -> tuple[str, int, list[int]]:
    """The lines that may be text, joined; their items; a hash of these."""
    kept = [(t, z) for t, z in lines(html) if z != AROUND]
    items = [(xxhash.xxh64_intdigest(t) & ~3 | z) - (1 << 63) for t, z in kept]
    return "\n".join(t for t, _ in kept), xxhash.xxh64_intdigest(np.array(items, "<i8").tobytes()) - (1 << 63), items


def _items(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_cut(h)[1:] for h in html], columns=["content", "items"])


def _text(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_cut(h)[:2] for h in html], columns=["text", "content"])


def _deleted(items: pd.Series, others: pd.Series) -> pd.Series:
    return pd.Series([deleted(x.tolist(), [o.tolist() for o in near if o is not None]) for x, near in zip(items, others)], dtype=object)


def neighbours(rows: DataFrame) -> DataFrame:
    """host, content, items, and the items of the nearest other contents by path on the same host: others."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = ["host", "path", "content"]
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    one = rows.where(F.size("items") > 0).groupBy("host", "content").agg(F.min("path").alias("path"), F.first("items").alias("items"))
    by_url = staged(one.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()).withColumn("place", place).drop("path"), "by-url")
    offset, offsets = 0, []
    for r in by_url.groupBy("part").agg(F.count("*").alias("n")).orderBy("part").collect():     # one number a partition
        offsets += [F.lit(r["part"]), F.lit(offset)]
        offset += r["n"]
    start = F.element_at(F.create_map(*offsets), F.col("part")) if offsets else F.lit(0)
    at = by_url.select((start + F.col("place")).cast("long").alias("index"), "host", "content", "items")
    block = lambda step: F.floor((F.col("index") + step) / BLOCK)
    blocks = at.withColumn("block", F.explode(F.array_distinct(F.array(block(-SIDE), block(0), block(SIDE)))))
    w = W.partitionBy("block").orderBy("index")
    steps = [k for k in range(-SIDE, SIDE + 1) if k]
    near = [F.when(F.lag("host", k).over(w) == F.col("host"), F.lag("items", k).over(w)) for k in steps]
    return blocks.withColumn("others", F.array(*near)).where(F.col("block") == block(0)).select("host", "content", "items", "others")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every row of ``pages``. Equal lines on one host get the same text."""
    url = whole_text("url")
    host = F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?[^/?#]*([^?#]*)", 1)
    own = pages.select("page_id", "url", host.alias("host"), path.alias("path"), whole_text("html").alias("html"))
    items, text, find = F.pandas_udf(_items, "content long, items array<long>"), F.pandas_udf(_text, "text string, content long"), F.pandas_udf(_deleted, "array<boolean>")
    paired = neighbours(own.select("host", "path", items("html").alias("cut")).select("host", "path", "cut.*"))
    marks = paired.select("host", "content", find("items", "others").alias("deleted"))
    cut = own.select("page_id", "url", "host", text("html").alias("cut")).select("page_id", "url", "host", "cut.*").join(marks, ["host", "content"], "left")
    left = F.expr("array_join(filter(split(text, '\n'), (t, i) -> not deleted[i]), '\n')")
    return cut.select("page_id", "url", F.when(F.col("text") == "", "").otherwise(left).alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))
