"""Main text of web pages, by nearest-URL page differencing.

A page is cut into text lines (its blocks). Within each host pages with the same lines are taken
as one, and these are sorted by URL path. Neighbours that share BULK percent of their text are a
run of near-copies, which tell nothing about frames; the neighbours of a page are the last of the
run before its own and the first of the run after it. Of the two the one whose path shares the
longer prefix with the page's is aligned with it by their longest common subsequence; lines in it
are the site's frame, not the page's text, and are deleted. Where that would be the bulk of the
page, only lines that the other neighbour shares too are deleted, and none if that leaves
nothing. On a host that has a single run only marked parts are deleted.

Every line of every page is aligned, also those within ``article`` and ``main``. Mark-up then
checks what differencing found. Lines within menus, headers, footers, sidebars, notices, adverts,
forms, scripts, styles and reader comments never are text, nor are lines around a marked article.
Lines within one may be shared because two articles have a sentence in common, so there a deletion
must be confirmed: the same line is deleted from most of the host's runs, and from OFTEN at least.

Pages are sorted over all partitions as hashes of lines, without their text; the few rows at
partition borders find their neighbours in a table of one row per partition. So a host with a
third of all pages is no larger a task than others.

Defined cases: null and empty html give an empty text; a null url and one without host are of
the host "" and take part like others; equal urls are neighbours, in the order of page_id;
repeated rows are extracted one by one; unclosed elements end with the element around them or
with the page; an empty table gives an empty table.
"""

from __future__ import annotations

import bisect
import hashlib
import html as entities
import os.path
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from verdance.llm.common import forget, small_batches, stored

#: Fixed values of the format: elements by what they mean here.
RAW = {"script", "style", "noscript", "template", "iframe", "svg", "textarea", "title", "select", "object", "math"}
FRAME = {"nav", "header", "footer", "aside", "form", "dialog", "menu", "button", "head"}
ARTICLE = {"article", "main"}
CONTAINERS = FRAME | ARTICLE | {"body", "html", "div", "section", "ul", "ol", "dl", "table", "blockquote", "figure", "details", "fieldset"}
BLOCKS = CONTAINERS | {
    "p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "dt", "dd", "tr", "td", "th", "thead", "tbody", "tfoot", "caption",
    "pre", "hr", "br", "address", "figcaption", "summary", "legend", "option", "hgroup", "center", "video", "audio",
}
#: Words in class, id and role that mark frames.
MARKS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "banner", "cookie", "cookies",
    "consent", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup", "nav", "navbar",
    "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar", "footer", "header", "masthead", "comment",
    "comments", "disqus", "replies", "reply", "respond", "share", "sharing", "social", "related", "recommended", "contentinfo",
    "complementary", "search", "login", "toolbar", "widget", "disclaimer", "copyright",
}

#: Percent of a page's text, without what mark-up excludes, from which a shared part is no frame.
BULK = 80
#: Runs of a host from which a line is deleted before it may be one in an article.
OFTEN = 5
#: Bits of the rows of alignment that are held at once.
ROWS_HELD = 1 << 27

_token = re.compile(
    r"<!--.*?(?:--!?>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S
)
_named = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_hidden = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_split = re.compile(r"[^a-z]+")


def _marked(attributes: str) -> bool:
    if not attributes.strip():
        return False
    for m in _named.finditer(attributes):
        if not MARKS.isdisjoint(_split.split((m[1] or m[2] or m[3] or "").lower())):
            return True
    return bool(_hidden.search(attributes))


def lines(html: str | None) -> list[tuple[str, bool, bool]]:
    """(text, in an article, in a marked frame) of each block that has text, in page order."""
    html = html or ""
    out: list[tuple[str, bool, bool]] = []
    stack: list[tuple[str, bool, bool]] = []  # open containers with the state before each
    article = frame = False
    run: list[str] = []
    at = 0

    def close() -> None:
        text = " ".join("".join(run).split())
        if text:
            out.append((text, article, frame))
        run.clear()

    while True:
        m = _token.search(html, at)
        text = html[at : m.start()] if m else html[at:]
        if text:
            run.append(entities.unescape(text))
        if not m:
            break
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        ends, attributes = bool(m[1] or m[4]), m[3] or m[6] or ""
        if name in RAW and not ends:
            if not attributes.endswith("/"):
                stop = re.compile(rf"</{re.escape(name)}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I).search(html, at)
                at = stop.end() if stop else len(html)
            continue
        if name in BLOCKS:
            close()
        if name not in CONTAINERS and not (name in BLOCKS or name in ("span", "a")):
            continue
        if ends:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    if name not in CONTAINERS:
                        close()
                    _, article, frame = stack[i]
                    del stack[i:]
                    break
        elif name in CONTAINERS:
            stack.append((name, article, frame))
            # a header within an article holds its title
            frame = frame or (name in FRAME and not (name == "header" and article)) or (name not in ("body", "html") and name not in ARTICLE and _marked(attributes))
            article = (article or name in ARTICLE) and not frame
        elif name not in ("br", "hr") and _marked(attributes):
            close()
            stack.append((name, article, frame))
            article, frame = False, True
    close()
    return out


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """For each start of ``a`` a number whose bit j is 0 where place j of ``b`` makes the longest
    common subsequence of that start and b[: j + 1] longer than that of b[:j]."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    full = row = (1 << len(b)) - 1
    for x in a:
        met = row & places.get(x, 0)
        row = (row + met | row - met) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Lengths of longest common subsequences of ``a`` and each start of ``b``."""
    row = 0
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def _aligned_rows(a: list[int], b: list[int], at: int) -> Iterator[int]:
    """Places, counted from ``at``, in ``a`` of a longest common subsequence, for lines that
    repeat often. Rows are bits; where they are too many, ``a`` is halved and ``b`` cut to fit."""
    if not a or not b:
        return
    if len(a) > 1 and len(a) * len(b) > ROWS_HELD:
        mid = len(a) // 2
        cut = int(np.argmax(_lengths(a[:mid], b) + _lengths(a[mid:][::-1], b[::-1])[::-1]))
        yield from _aligned_rows(a[:mid], b[:cut], at)
        yield from _aligned_rows(a[mid:], b[cut:], at + mid)
        return
    rows = [(1 << len(b)) - 1, *_rows(a, b)]
    i, j = len(a), len(b) - 1
    while i and j >= 0:
        if rows[i] >> j & 1:
            j -= 1  # the last place of b adds nothing
        elif not rows[i - 1] >> j & 1:
            i -= 1  # it does so without the last line of a
        else:
            yield at + i - 1
            i -= 1
            j -= 1


def common_subsequence(a: list[int], b: list[int]) -> set[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    lead = 0
    while lead < len(a) and lead < len(b) and a[lead] == b[lead]:
        lead += 1
    tail = 0
    while tail < len(a) - lead and tail < len(b) - lead and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    found = set(range(lead)) | set(range(len(a) - tail, len(a)))
    places: dict[int, list[int]] = {}
    for j in range(lead, len(b) - tail):
        places.setdefault(b[j], []).append(j)
    met = [i for i in range(lead, len(a) - tail) if a[i] in places]
    if sum(len(places[a[i]]) for i in met) > 64 * (len(a) + len(b)):
        known = {a[i] for i in met}
        found.update(met[i] for i in _aligned_rows([a[i] for i in met], [x for x in b[lead : len(b) - tail] if x in known], 0))
        return found
    ends: list[int] = []  # smallest place in b at which a subsequence of each length ends
    links: list[tuple] = []
    for i in met:
        for j in reversed(places[a[i]]):
            k = bisect.bisect_left(ends, j)
            link = (i, links[k - 1] if k else None)
            if k == len(ends):
                ends.append(j)
                links.append(link)
            else:
                ends[k], links[k] = j, link
    link = links[-1] if links else None
    while link:
        found.add(link[0])
        link = link[1]
    return found


def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def _may_be_text(every: list[tuple[str, bool, bool]]) -> list[bool]:
    """What mark-up says of each line: in an article where there is one, else in no marked frame."""
    marked = any(article for _, article, _ in every)
    return [article if marked else not frame for _, article, frame in every]


def _outlines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of all lines, their lengths (0 where mark-up excludes them), and whether each is in
    an article."""
    for batch in batches:
        found, weights, inside = [], [], []
        for html in batch.column("html").to_pylist():
            every = lines(html)
            found.append([_hash(t) for t, _, _ in every])
            weights.append([len(t) if may else 0 for (t, _, _), may in zip(every, _may_be_text(every), strict=True)])
            inside.append([article for _, article, _ in every])
        kept = [batch.column(c) for c in ("key", "host", "path", "page_id")]
        made = [pa.array(found, pa.list_(pa.int64())), pa.array(weights, pa.list_(pa.int32())), pa.array(inside, pa.list_(pa.bool_()))]
        yield pa.RecordBatch.from_arrays([*kept, *made], names=["key", "host", "path", "page_id", "outline", "weights", "inside"])


def _weight(row: dict, places: set[int]) -> int:
    return sum(row["weights"][i] for i in places)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whether a page starts a run: it is no near-copy of the one before."""
    for batch in batches:
        starts = []
        for r in batch.select(["host", "outline", "weights", "before"]).to_pylist():
            b = r["before"]
            if b is None or b["host"] != r["host"]:
                starts.append(True)
                continue
            same = _weight(r, common_subsequence(r["outline"], b["outline"]))
            starts.append(100 * same < BULK * max(sum(r["weights"]), sum(b["weights"]), 1))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(starts, pa.bool_())], names=[*batch.schema.names, "starts"])


def _gone(row: dict) -> set[int]:
    """Places of the lines that are the site's frame, told from the neighbours of other runs."""
    sides = [s for s in (row["before"], row["after"]) if s is not None and s["host"] == row["host"]]
    sides.sort(key=lambda s: -len(os.path.commonprefix([s["path"], row["path"]])))
    whole, same = sum(row["weights"]), set()
    for i, side in enumerate(sides):
        shared = common_subsequence(row["outline"], side["outline"])
        same = same & shared if i else shared
        if 100 * _weight(row, same) < BULK * whole:
            return same
    return same if len(sides) > 1 and _weight(row, same) < whole else set()


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of the lines that are deleted; of those in articles also the lines, and of a page
    that starts a run each of these once, as a vote."""
    kind = pa.struct([("place", pa.int32()), ("line", pa.int64())])
    for batch in batches:
        first, second, hosts, places, asked, votes = [], [], [], [], [], []
        for r in batch.to_pylist():
            same = sorted(_gone(r))
            if same:
                first.append(r["o1"])
                second.append(r["o2"])
                hosts.append(r["host"])
                places.append([i for i in same if not r["inside"][i]])
                asked.append([{"place": i, "line": r["outline"][i]} for i in same if r["inside"][i]])
                votes.append(sorted({x["line"] for x in asked[-1]}) if r["starts"] else [])
        made = [pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(hosts, pa.string()), pa.array(places, pa.list_(pa.int32()))]
        made += [pa.array(asked, pa.list_(kind)), pa.array(votes, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(made, names=["o1", "o2", "host", "places", "asked", "votes"])


def _confirmed(found: DataFrame, runs: DataFrame) -> DataFrame:
    """(host, o1, o2, places): deletions outside articles, and those inside that most of the
    host's runs, and OFTEN at least, agree on."""
    of_host = runs.where("starts").groupBy("host").agg(F.count("*").alias("runs"))
    votes = found.select("host", F.explode("votes").alias("line")).groupBy("host", "line").agg(F.count("*").alias("n"))
    agreed = votes.where(F.col("n") >= OFTEN).join(of_host, "host").where("2 * n > runs").select("host", "line")
    page = ["host", "o1", "o2"]
    inside = found.select(*page, F.inline("asked")).join(agreed, ["host", "line"]).groupBy(*page).agg(F.collect_list("place").alias("inside"))
    none = F.array().cast("array<int>")
    every = found.join(inside, page, "left").select(*page, F.concat("places", F.coalesce("inside", none)).alias("places"))
    return every.where(F.size("places") > 0)


def _page_key() -> Column:
    return F.xxhash64("page_id", "url", "html")


def shared_lines(pages: DataFrame) -> DataFrame:
    """(key, places): what differencing deletes of each page that shares lines. Stored."""
    url = F.coalesce("url", F.lit(""))
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)?([^?#]*)", 1)
    src = pages.select(_page_key().alias("key"), host.alias("host"), path.alias("path"), "page_id", "html")
    id_kind = pages.schema["page_id"].dataType.simpleString()
    kind = f"key long, host string, path string, page_id {id_kind}, outline array<long>, weights array<int>, inside array<boolean>"
    outlines = src.mapInArrow(_outlines, kind).where(F.size("outline") > 0)
    same = [F.xxhash64(F.lit(i), "outline", "weights", "inside").alias(f"o{i}") for i in (1, 2)]
    outlines = stored(outlines.select("*", *same), "outlines")
    firsts = [F.any_value(c).alias(c) for c in ("outline", "weights", "inside")]
    distinct = outlines.groupBy("host", "o1", "o2").agg(F.min(F.struct("path", "page_id", "key")).alias("least"), *firsts)
    distinct = distinct.select("host", "o1", "o2", "outline", "weights", "inside", "least.*")
    order = ["host", "path", "page_id", "key"]
    ranged = stored(
        distinct.repartitionByRange(*order).sortWithinPartitions(*order).select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
        "ranged",
    )
    side = F.struct("host", "path", "outline", "weights")
    # one row per partition: its first and last page
    borders = ranged.groupBy("part").agg(F.min("at").alias("lo"), F.max("at").alias("hi"))
    ends = stored(borders.select("lo", F.lag("hi").over(Window.orderBy("part")).alias("earlier")), "ends")
    edge = ranged.select(F.col("at").alias("edge"), side.alias("earlier_side"))
    earlier = ends.join(edge, F.col("earlier") == F.col("edge")).select(F.col("lo").alias("at"), "earlier_side")
    within = Window.partitionBy("part").orderBy("at")
    paired = ranged.select("*", F.lag(side).over(within).alias("b")).join(earlier, "at", "left")
    paired = paired.select(
        "o1", "o2", "host", "path", "outline", "weights", "inside", "part", "at", F.coalesce("b", "earlier_side").alias("before")
    )
    runs = stored(paired.mapInArrow(_runs, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in paired.schema)}, starts boolean"), "runs")
    # wrapped, so that a run at the beginning of all pages is told from none
    last, next_ = F.when(F.col("starts"), F.struct("before")), F.when(F.col("starts"), side)
    # one row per partition: what its last run has before it, and its first page that starts a run
    sums = runs.groupBy("part").agg(F.max_by(last, F.when(F.col("starts"), F.col("at"))).alias("l"), F.min_by(next_, F.when(F.col("starts"), F.col("at"))).alias("n"))
    before_part = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    after_part = Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)
    carried = stored(
        sums.select("part", F.last("l", ignorenulls=True).over(before_part).alias("l"), F.last("n", ignorenulls=True).over(after_part).alias("n")), "carried"
    )
    down = Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    up = Window.partitionBy("part").orderBy(F.desc("at")).rowsBetween(Window.unboundedPreceding, -1)
    seen = runs.select("*", F.last(last, ignorenulls=True).over(down).alias("d"), F.last(next_, ignorenulls=True).over(up).alias("u"))
    faced = seen.join(F.broadcast(carried), "part").select(
        "o1", "o2", "host", "path", "outline", "weights", "inside", "starts", F.coalesce("d", "l")["before"].alias("before"), F.coalesce("u", "n").alias("after")
    )
    kind = "o1 long, o2 long, host string, places array<int>, asked array<struct<place: int, line: long>>, votes array<long>"
    found = stored(faced.mapInArrow(_shared, kind), "found")
    places = stored(_confirmed(found, runs), "places")
    out = stored(outlines.join(places, ["host", "o1", "o2"]).select("key", "places").dropDuplicates(["key"]), "shared")
    forget(outlines, ranged, ends, runs, carried, found, places)
    return out


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, places in zip(batch.column("html").to_pylist(), batch.column("places").to_pylist(), strict=True):
            every, gone = lines(html), set(places or ())
            texts.append(" ".join(t for i, ((t, _, _), may) in enumerate(zip(every, _may_be_text(every), strict=True)) if may and i not in gone))
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string())], names=["page_id", "url", "text"])


def main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of each row of ``pages``."""
    small_batches(pages.sparkSession)
    shared = shared_lines(pages)
    id_kind = pages.schema["page_id"].dataType.simpleString()
    both = pages.select(_page_key().alias("key"), "page_id", "url", "html").join(shared, "key", "left").select("page_id", "url", "html", "places")
    texts = both.mapInArrow(_texts, f"page_id {id_kind}, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("long"))
