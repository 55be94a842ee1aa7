"""Main text of web pages: structure first, then differencing against the nearest page of the same host."""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import discard, materialise, small_batches

#: Elements whose text is never shown as text, with all inside them.
SKIPPED = frozenset("head title script style noscript template iframe object svg canvas annotation button select textarea input".split())
#: Elements that hold no text of the article unless the article itself stands in them.
ASIDE = frozenset("nav footer aside form dialog menu".split())
#: Elements that may stand in a head; any other one ends a head that was never closed.
IN_HEAD = frozenset("title meta link base style script noscript template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements within a line; all others begin and end a block.
INLINE = frozenset("a abbr acronym annotation b bdi bdo big br cite code data del dfn em font i img ins kbd label mark math mfrac mi mn mo mrow ms mspace msqrt mstyle msub msubsup msup mtext q s samp semantics small span strike strong sub sup time tt u var wbr".split())
ARTICLE = frozenset(("article", "main"))
#: Words for parts that aren't the article. A class, id or role speaks for such a part only if it has no other words than these and those of PARTS.
NOISE = frozenset("ad ads advert adverts advertisement advertising breadcrumb breadcrumbs comment comments cookie cookies disqus footer masthead menu nav navbar navigation newsletter replies responses sharedaddy sidebar sponsor sponsored".split())
#: Words that do so alone, beside words of NOISE, or before words of PARTS.
WEAK = frozenset("banner consent contentinfo modal notice popup promo promoted related search share sharing social subscribe toolbar widget".split())
PARTS = frozenset("area articles bar block bottom box button buttons container count form global icon icons inner item items left link links list main outer page panel posts primary reply right row secondary section site slot stories thread tools top unit user wrap wrapper".split())
#: Words before "header" that make it the site's; other headers in an article hold its title.
SITES = frozenset("global main page site top".split())
#: A page that shares so much of its lines with its neighbour may be a near copy; a second neighbour then decides too.
COPY_SHARE = 0.8
#: Neighbours that share so much of the lines of an article decide nothing within it.
ARTICLE_SHARE = 0.5
#: Cells of an alignment that are held at once; larger ones are halved first.
CELLS = 1 << 26


def names_noise(name: str) -> bool:
    """Whether all words of a class, id or role, cut at hyphens, underscores and capitals, tell of a part that isn't the article."""
    words = [w for w in re.split(r"[-_\s]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "-", name).lower()) if w and not w.isdigit()]
    if words and words[-1] == "header":
        return len(words) == 1 or len(words) == 2 and words[0] in SITES
    if words and words[0] in ("comment", "reply"):
        return True
    if not words or any(w not in NOISE | WEAK | PARTS for w in words):
        return False
    return any(w in NOISE for w in words) or words[0] in WEAK


class Part:
    """An element that may be no part of the article: by its tag (firm) or by its names."""

    def __init__(self, firm: bool) -> None:
        self.firm, self.size, self.holds = firm, 0, False

    def is_noise(self, total: int) -> bool:
        """What holds the article or its title is none, nor is what only its names speak against and holds half of the page's text."""
        return not self.holds and (self.firm or 2 * self.size < total)


class Blocks(HTMLParser):
    """The blocks of a page with a flag each: outside the article (0), in it (1), or its title (2)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[tuple[str, bool, bool, Part | None]] = []
        self.skip = self.inside = self.title = 0
        self.parts: list[str] = []
        self.rows: list[tuple[str, int, tuple[Part, ...]]] = []

    def end_block(self) -> None:
        text = " ".join("".join(self.parts).split())
        self.parts.clear()
        if text:
            held = tuple(part for *_, part in self.open if part)
            for part in held:
                part.size += len(text)
            self.rows.append((text, (2 if self.title else 1) if self.inside else 0, held))

    @property
    def found(self) -> list[tuple[str, int]]:
        total = sum(len(text) for text, _, held in self.rows if not any(part.firm and part.is_noise(0) for part in held))
        return [(text, flag) for text, flag, held in self.rows if not any(part.is_noise(total) for part in held)]

    def part_of(self, tag: str, attrs) -> Part | None:
        if tag in ASIDE or tag == "header" and not self.inside:
            return Part(firm=True)
        for name, value in attrs:
            if name in ("class", "id", "role") and value and tag not in ("html", "body", "main", "h1"):
                # Of an article only comments are noise: a post may be "sponsored" or a "widget".
                if any((tag != "article" or x.lower().startswith(("comment", "reply"))) and names_noise(x) for x in value.split()):
                    return Part(firm=False)
        return None

    def handle_starttag(self, tag, attrs) -> None:
        if tag not in INLINE:
            self.end_block()
        elif tag == "br":
            self.parts.append(" ")
        if tag not in IN_HEAD and any(t == "head" for t, *_ in self.open):
            self.leave("head")
        if tag in VOID:
            return
        if tag in ("p", "li"):
            self.end_unclosed(tag)
        for around in ("nav",) if tag == "article" else ("nav", "header", "footer", "aside") if tag == "main" else ():
            if any(t == around for t, *_ in self.open):  # it was never closed
                self.leave(around)
        hidden = any(name == "hidden" or name == "aria-hidden" and (value or "").lower() == "true" for name, value in attrs)
        noise, article, part = tag in SKIPPED or hidden, tag in ARTICLE, self.part_of(tag, attrs)
        if (article or tag == "h1") and not self.skip and not noise and part is None:
            for name, *_, around in self.open:
                # A form may be around the whole page. A small article may be a teaser, and a title in a header the site's.
                if around and (name == "form" or tag != "article" and not around.firm):
                    around.holds = True
        self.open.append((tag, noise, article, part))
        self.skip += noise
        self.inside += article
        self.title += tag == "h1"

    def handle_startendtag(self, tag, attrs) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def end_unclosed(self, tag: str) -> None:
        """A paragraph or item that was never closed ends where the next one begins."""
        for name, *_ in reversed(self.open):
            if name == tag:
                return self.leave(tag)
            if name not in INLINE and not (tag == "li" and name == "p"):
                return None
        return None

    def leave(self, tag: str) -> None:
        while self.open:
            name, noise, article, _ = self.open.pop()
            self.skip -= noise
            self.inside -= article
            self.title -= name == "h1"
            if name == tag:
                return

    def handle_endtag(self, tag) -> None:
        if tag not in INLINE:
            self.end_block()
        if any(t == tag for t, *_ in self.open):
            self.leave(tag)

    def handle_data(self, data) -> None:
        if not self.skip:
            self.parts.append(data)


def blocks(html: str | None) -> list[tuple[str, int]]:
    """Text blocks in page order, white space turned into single spaces, references decoded; structural noise is left out."""
    if not html:
        return []
    parser = Blocks()
    parser.feed(html)
    parser.close()
    parser.end_block()
    return parser.found


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """The rows of the alignment of a and b, bit-parallel: in row i the zeros below j count the length for a[:i] and b[:j]."""
    where: dict[int, int] = {}
    for j, x in enumerate(b):
        where[x] = where.get(x, 0) | 1 << j
    full = v = (1 << len(b)) - 1
    yield v
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
        yield v


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The length of the longest common subsequence of a with each beginning of b."""
    for last in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(last.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def shared_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence of a and b. Equal ends go first; what is large is halved, so memory grows with lines, not their product."""
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    inner, other = a[head : len(a) - tail], b[head : len(b) - tail]
    if len(inner) * len(other) <= CELLS:
        middle = _aligned(inner, other)
    else:
        half = len(inner) // 2
        cut = int(np.argmax(_lengths(inner[:half], other) + _lengths(inner[half:][::-1], other[::-1])[::-1]))
        middle = [*shared_lines(inner[:half], other[:cut]), *(half + i for i in shared_lines(inner[half:], other[cut:]))]
    return [*range(head), *(head + i for i in middle), *range(len(a) - tail, len(a))]


def _aligned(a: list[int], b: list[int]) -> list[int]:
    rows = list(_rows(a, b))
    length = lambda i, j: j - (rows[i] & ((1 << j) - 1)).bit_count()
    out, i, j = [], len(a), len(b)
    while i and j:
        if rows[i] >> (j - 1) & 1:
            j -= 1
        elif length(i - 1, j) == length(i, j):
            i -= 1
        else:
            i, j = i - 1, j - 1
            out.append(i)
    return out[::-1]


def prefixes(url: str | None) -> list[str]:
    """Host, then host and path up to each segment, then the whole path: the longest first."""
    try:
        parts = urlsplit(url or "")
        host = (parts.hostname or "").removeprefix("www.")
    except ValueError:
        host, parts = "", urlsplit("")
    path = [s for s in parts.path.removesuffix(".html").split("/") if s]
    keys = [host, *(f"{host}/" + "/".join(path[: k + 1]) + "/" for k in range(len(path)))]
    keys.append(f"{host}/" + "/".join(path))
    return list(dict.fromkeys(keys))[::-1]


def keep_lines(hashes: list[int], flags: list[int], others: list[list[int]] | None) -> tuple[list[int], int]:
    """Places of the lines that stay, and how many lines the nearest page shares.

    ``others`` are the lines of one or two nearest pages, none a copy. Outside a marked article those lines go that the first
    page shares; where it shares nearly all, only those that the second, if there
    is one, shares too: what a template repeats is in both, what a near copy repeats isn't. In an article
    those go that begin or end it and that both pages share, unless one of them shares half of it; its title stays.
    """
    both = [set(shared_lines(hashes, x)) for x in others or ()]
    if not both:
        return list(range(len(flags))), 0
    gone = both[0]
    if len(both) > 1 and len(gone) >= COPY_SHARE * len(hashes):
        gone = gone & both[1]
    inside = [i for i, f in enumerate(flags) if f == 1]
    framing: set[int] = set()
    if len(both) > 1 and all(2 * sum(i in x for i in inside) < len(inside) for x in both):
        for run in (inside, inside[::-1]):
            for i in run:
                if i not in both[0] or i not in both[1]:
                    break
                framing.add(i)
    return [i for i, f in enumerate(flags) if (i not in framing if f else i not in gone)], len(both[0])


def _hash(line: str) -> int:
    import xxhash

    return xxhash.xxh32_intdigest(line.encode()) - (1 << 31)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``(id, url, text, n_chars, n_shared)`` for each page: its main text, blocks joined by line ends.

    Structure goes first: parts that by element, class, id or role are no article. Then each page is
    paired with pages of its host under the longest common path that has one with other lines: the first two of those with the
    least, the greatest and the second least hash of all their lines, less the page's own, so copies are never paired, and all pages of a
    path with three different ones have two neighbours. Lines are
    aligned by longest common subsequence; shared ones are deleted by ``keep_lines``. Pairing reads hashes only: least and
    greatest pages of a path are combined before the shuffle and meet the path's pages in a join that AQE may split; the lines
    themselves are parsed again on their way to their one shuffle and are never written.
    Null and empty html give an empty text; pages without lines are nobody's neighbour; null and broken urls share the host ''.
    Rows that repeat an id are told apart by their hash; equal rows are one page for pairing, and each is returned.
    """
    spark = pages.sparkSession
    small_batches(spark)
    kind = pages.schema[id_col].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            columns = [
                pa.array([[_hash(t) for t, _ in blocks(h)] for h in batch.column(3).to_pylist()], pa.list_(pa.int32())),
                pa.array([np.array([xxhash.xxh64_intdigest(p.encode("utf-8", "surrogatepass")) for p in prefixes(u)], np.uint64).view(np.int64) for u in batch.column(2).to_pylist()], pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["id", "mark", "hashes", "paths"])

    rows = pages.select(F.col(id_col).alias("id"), F.xxhash64(url_col, html_col).alias("mark"), F.col(url_col).cast("string").alias("url"), F.col(html_col).cast("string").alias("html"))
    keys = rows.mapInArrow(scan, f"id {kind}, mark long, hashes array<int>, paths array<long>").filter("size(hashes) > 0")
    keys = materialise(keys.withColumn("sig", F.xxhash64("hashes")), "page-keys")

    below = keys.select("id", "mark", "sig", F.posexplode("paths").alias("depth", "path"))
    ends = below.groupBy("path").agg(F.min("sig").alias("least"), F.max("sig").alias("greatest"))
    ends = materialise(ends.filter("least <> greatest"), "page-ends")
    third = below.join(ends.hint("merge"), "path").filter("sig <> least and sig <> greatest").groupBy("path").agg(F.min("sig").alias("sig"))
    # The longest path of each page that has a page with other lines, then that path's pages.
    nearest = below.join(ends.select("path").hint("merge"), "path").groupBy("id", "mark", "sig").agg(F.min_by("path", "depth").alias("path"))
    lines_of = keys.groupBy("sig").agg(F.first("hashes").alias("hashes"))
    sides = ends.select("path", F.explode(F.array("least", "greatest")).alias("sig")).union(third).join(lines_of.hint("merge"), "sig")
    sides = sides.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("sig", "hashes"))).alias("sides"))
    # Written, so that the join with the pages of a hot path is dealt anew and can be split.
    sides = materialise(sides, "page-sides")
    nearest = materialise(nearest, "page-nearest")
    met = nearest.join(sides.hint("merge"), "path")
    others = F.slice(F.transform(F.filter("sides", lambda x: x["sig"] != F.col("sig")), lambda x: x["hashes"]), 1, 2)
    met = materialise(met.select(F.col("id").alias("own_id"), F.col("mark").alias("own_mark"), others.alias("others")), "page-neighbours")
    discard(keys, ends, sides, nearest)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [blocks(h) for h in batch.column(3).to_pylist()]
            columns = [pa.array(["\n".join(t for t, _ in b) for b in found], pa.string()), pa.array(["".join(str(f) for _, f in b) for b in found], pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names=["id", "mark", "url", "body", "flags"])

    def difference(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, shared = [], []
            for body, flags, others in zip(*(batch.column(i).to_pylist() for i in range(2, 5)), strict=True):
                lines = body.split("\n") if flags else []
                stay, n = keep_lines([_hash(t) for t in lines] if others else lines, [int(f) for f in flags], others)
                texts.append("\n".join(lines[i] for i in stay))
                shared.append(n)
            columns = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64()), pa.array(shared, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], *columns], names=["id", "url", "text", "n_chars", "n_shared"])

    parsed = rows.mapInArrow(parse, f"id {kind}, mark long, url string, body string, flags string")
    both = parsed.join(met.hint("merge"), F.col("id").eqNullSafe(F.col("own_id")) & (F.col("mark") == F.col("own_mark")), "left")
    out = both.select("id", "url", "body", "flags", "others").mapInArrow(difference, f"id {kind}, url string, text string, n_chars long, n_shared long")
    return out.withColumnsRenamed({"id": id_col, "url": url_col})
