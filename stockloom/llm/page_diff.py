"""Main text of web pages by differencing with the pages of the nearest URLs.

Pages are cut into block lines, menus, headers, footers and adverts among them.
Each page is paired with its neighbours in URL path order within its host, lines
are aligned by a longest common subsequence, and shared lines go: what two pages
of one template repeat is not their text.

Every page is compared with its mate, the nearest page of its host whose text is
neither the same nor nearly the same.  Pages of equal lines are compared once,
and runs of near copies are passed over.  What travels for this are hashes and
lengths of lines; texts are shuffled once, to what is gone from them.

The page's own structure decides what differencing leaves open.  Lines of
navigation, headers, footers, asides and blocks whose class, id or role says
advert, sidebar, notice, comment or the like go even if no mate shares them, unless
such a block (or a form) wraps the page's text; for these lines every neighbour
counts, not the nearest alone.  Scripts, styles and other parts that are no text never become lines.
Where one article (or without articles the main part)
holds most of a page's text, its lines are kept even if the mate shares them;
all other lines, around it too, are kept unless shared.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockloom.llm.common import in_ranges, with_before, with_python
from stockloom.llm.url_filter import url_host, url_path
from stockloom.session import materialise

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hr html legend li main nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
DROPPED = frozenset(
    "button canvas dialog head iframe input noscript object option script select style svg "
    "template textarea title video audio".split())
#: Parts around a page's text.
AROUND = frozenset("aside footer menu nav".split())
#: Words of a class, id or role that mark a block as something else than text.
MARKS = frozenset(
    "ad ads advert advertisement adverts alert banner breadcrumb breadcrumbs comment comments complementary consent "
    "contentinfo cookie cookies dialog disqus footer gdpr header login menu modal nav navbar navigation newsletter notice "
    "notices notification pager pagination popup promo promoted promotion recommended related replies reply search share "
    "sharing sidebar signup social sponsor sponsored subscribe toolbar widget".split())
_WORDS = re.compile(r"[a-z]+")
_CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "li", "dd", "dt"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
_FENCES = {"ul", "ol", "dl", "table", "select"}
MARKED, ELSEWHERE, MAIN, ARTICLE = -1, 0, 1, 2
#: A mate that shares this share of lines and of characters is nearly a copy.
NEAR = 0.8


class Lines(HTMLParser):
    """Block lines of one page with the kind of place each stands in.

    Lines in marked blocks are noted with the blocks; ``page_lines`` decides.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        # tag, dropped, around the text, place, article, marked blocks around
        self.open: list[tuple[str, bool, bool, int, int, tuple[int, ...]]] = []
        self.articles = self.marked = 0
        self.holds_main: set[int] = set()  # marked blocks
        self.count: dict[str, int] = {}
        self.buffer: list[str] = []
        self.lines: list[tuple[str, bool, int, int, tuple[int, ...]]] = []

    def _state(self) -> tuple[bool, bool, int, int, tuple[int, ...]]:
        return self.open[-1][1:] if self.open else (False, False, ELSEWHERE, 0, ())

    def _end_line(self) -> None:
        if self.buffer:
            text = " ".join("".join(self.buffer).split())
            self.buffer.clear()
            if text:
                self.lines.append((text, *self._state()[1:]))

    def _pop_to(self, tag: str) -> None:
        while self.open:
            name = self.open.pop()[0]
            self.count[name] -= 1
            if name == tag:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._end_line()
            if tag in _CLOSES_P and self.count.get("p"):
                self._pop_to("p")
            for sibling in _SIBLINGS.get(tag, ()):
                names = []
                for name, *_ in reversed(self.open):
                    names.append(name)
                    if name == sibling or name in _FENCES:
                        break
                if names and names[-1] == sibling:
                    self._pop_to(sibling)
        if tag == "br":
            self.buffer.append(" ")
        if tag in VOID:
            return
        dropped, beside, place, article, around = self._state()
        if tag == "body":
            dropped = beside = False
        if not dropped and tag not in ("body", "html"):
            own = dict(attrs)
            marks = _WORDS.findall(" ".join(own.get(a) or "" for a in ("class", "id", "role")).lower())
            dropped = tag in DROPPED or "hidden" in own or own.get("aria-hidden") == "true"
            beside = beside or tag in AROUND or (tag == "header" and place == ELSEWHERE)
            inside = not dropped and not beside
            if inside and (tag == "form" or not MARKS.isdisjoint(marks)):
                self.marked += 1
                around = (*around, self.marked)
            own_place = {"article": ARTICLE, "main": MAIN}.get(tag, MAIN if own.get("role") == "main" else ELSEWHERE)
            if inside and own_place == MAIN:
                self.holds_main.update(around)
            if inside and own_place == ARTICLE and place < ARTICLE:  # one in another is a part of it
                self.articles += 1
                article = self.articles
            place = max(place, own_place) if inside else place
        self.open.append((tag, dropped, beside, place, article, around))
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_line()
        if self.count.get(tag):
            self._pop_to(tag)

    def handle_data(self, data: str) -> None:
        if not self._state()[0]:
            self.buffer.append(data)

    def close(self) -> None:
        super().close()
        self._end_line()


def page_lines(html: str | None) -> list[tuple[str, int]]:
    """Lines with their places; only lines of a dominant article are ARTICLE,
    only those of a dominant main part are MAIN, and those around the text or in
    marked blocks are MARKED."""
    parser = Lines()
    parser.feed(html or "")
    parser.close()
    every = parser.lines
    lines = [(t, *rest) for t, beside, *rest in every if not beside]
    total = sum(len(t) for t, *_ in lines)

    def most(found: list[tuple[str, int, int, tuple[int, ...]]], whole: int) -> bool:
        return 2 * sum(len(x[0]) for x in found) >= whole > 0

    # A marked block is the page's wrapper if it holds the main part or most of an
    # article that is most of the page; on pages that mark neither, most of the text.
    open_blocks = set(parser.holds_main)
    marked = any(place for _, place, *_ in lines)
    for block in {b for *_, around in lines for b in around} - open_blocks:
        inside = [x for x in lines if block in x[3]]
        if marked:
            by_article = [[x for x in inside if x[2] == n] for n in {x[2] for x in inside if x[1] == ARTICLE}]
            outside = {x[2] for x in lines if block not in x[3]}
            if any(most(a, total) and a[0][2] not in outside for a in by_article):
                open_blocks.add(block)
        elif most(inside, total):
            open_blocks.add(block)
    lines = [x for x in lines if open_blocks.issuperset(x[3])]
    total = sum(len(t) for t, *_ in lines)
    articles = {x[2]: 0 for x in lines if x[1] == ARTICLE}
    for t, place, n, _ in lines:
        if place == ARTICLE:
            articles[n] += len(t)
    chosen = max(articles, key=lambda n: (articles[n], -n), default=None)
    if chosen is not None and 2 * articles[chosen] < total:
        chosen = None
    main = not articles and most([x for x in lines if x[1] == MAIN], total)

    def of(beside: bool, place: int, n: int, around: tuple[int, ...]) -> int:
        if beside or not open_blocks.issuperset(around):
            return MARKED
        return ARTICLE if place == ARTICLE and n == chosen else MAIN if place == MAIN and main else ELSEWHERE

    return [(t, of(*rest)) for t, *rest in every]


def _last_row(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of a and each prefix of b."""
    where: dict[int, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | (1 << j)
    full = (1 << len(b)) - 1
    v = full
    for x in a:
        u = v & where.get(x, 0)
        v = ((v + u) | (v - u)) & full
    bits = np.unpackbits(np.frombuffer(v.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[:len(b)]
    return np.concatenate([[0], np.cumsum(1 - bits.astype(np.int64))])


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of one longest common subsequence with ``b``.

    Equal ends are matched first and lines that occur on one side only are left
    out; the rest is halved as by Hirschberg, with bit-parallel rows, so memory
    stays linear however long the pages are.
    """
    out: list[int] = []

    def solve(i0: int, i1: int, j0: int, j1: int) -> None:
        while i0 < i1 and j0 < j1 and xs[i0][1] == ys[j0]:
            out.append(xs[i0][0])
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and xs[i1 - 1][1] == ys[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append(xs[i1][0])
        if i0 == i1 or j0 == j1:
            return
        if i1 - i0 == 1:
            if xs[i0][1] in ys[j0:j1]:
                out.append(xs[i0][0])
            return
        mid = (i0 + i1) // 2
        head = _last_row([x for _, x in xs[i0:mid]], ys[j0:j1])
        tail = _last_row([x for _, x in reversed(xs[mid:i1])], ys[j0:j1][::-1])
        cut = j0 + int(np.argmax(head + tail[::-1]))
        solve(i0, mid, j0, cut)
        solve(mid, i1, cut, j1)

    shared = set(a) & set(b)
    xs = [(i, x) for i, x in enumerate(a) if x in shared]
    ys = [y for y in b if y in shared]
    solve(0, len(xs), 0, len(ys))
    return sorted(out)


def near_copy(mine: list[int], mine_chars: list[int], mate: list[int], mate_chars: list[int]) -> bool:
    """Whether two pages share nearly all their lines, both ways; marked lines
    (negative lengths) don't count, where there are others."""
    def own(lines: list[int], chars: list[int]) -> list[tuple[int, int]]:
        return [(x, n) for x, n in zip(lines, chars) if n >= 0] or [(x, -n) for x, n in zip(lines, chars)]

    one, two = own(mine, mine_chars), own(mate, mate_chars)
    for a, b in ((one, {x for x, _ in two}), (two, {x for x, _ in one})):
        shared = [n for x, n in a if x in b]
        if len(shared) < NEAR * len(a) or sum(shared) < NEAR * sum(n for _, n in a):
            return False
    return True


def main_text(lines: list[dict], gone: list[int] | None) -> tuple[str, int, int]:
    """The text of a page given the numbers of its lines that mates share, and how
    many lines went for being shared and for where they stand."""
    shared = set(gone or ())
    kept = [line["text"] for i, line in enumerate(lines) if line["place"] > ELSEWHERE or line["place"] == ELSEWHERE and i not in shared]
    by_mate = sum(line["place"] <= ELSEWHERE and i in shared for i, line in enumerate(lines))
    return "\n".join(kept), by_mate, len(lines) - len(kept) - by_mate


def _hashes(lines: list[tuple[str, int]]) -> list[int]:
    return [xxhash.xxh64_intdigest(t.encode("utf-8", "surrogatepass")) - (1 << 63) for t, _ in lines]


def _digest(hashes: list[int]) -> bytes:
    return xxhash.xxh3_128_digest(np.array(hashes, np.int64).tobytes())


def shared_lines(pages: DataFrame) -> DataFrame:
    """(host, digest, gone): per host and different page, the numbers of its lines
    that its mate shares; pages without a mate are missing.

    ``pages`` has host, path, digest, hashes and chars, one row per page.
    """
    order = ["host", "path", "digest"]
    alike = pages.where("host <> '' and size(hashes) > 0").groupBy("host", "digest", "hashes", "chars").agg(F.min("path").alias("path"))
    full = materialise(alike, "page-hashes")
    placed = materialise(with_before(in_ranges(full.select(*order), order, "page-order"), order, {"at": F.lit(1).cast("long")}), "page-places")
    hosts = placed.groupBy("host").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    ranked = materialise(full.join(placed.select("host", "digest", "at"), ["host", "digest"]), "page-ranked")
    hosts = placed.groupBy("host").agg(F.min("at").alias("low"), F.max("at").alias("high"))
    mates = ranked.select(F.col("at").alias("mate_at"), F.col("path").alias("mate_path"), F.col("hashes").alias("mate_hashes"), F.col("chars").alias("mate_chars"))

    def compare(b: pa.RecordBatch) -> dict[str, list]:
        out = []
        for row in b.select(["hashes", "chars", "mates"]).to_pylist():
            fits = [m for m in row["mates"] if not near_copy(row["hashes"], row["chars"], m["hashes"], m["chars"])]
            gone = [common_lines(row["hashes"], m["hashes"]) for m in fits]
            # Lines that structure marks go if any neighbour has them, others if the nearest has.
            out.append(sorted({*gone[0], *(i for g in gone[1:] for i in g if row["chars"][i] < 0)}) if fits else None)
        return {"gone": out}

    def tried(todo: DataFrame, left: Column, right: Column, name: str) -> DataFrame:
        sides = F.filter(F.array(left, right), lambda p: p.between(F.col("low"), F.col("high")))
        asked = todo.select("at", "path", F.explode(sides).alias("mate_at"))
        near = asked.join(mates, "mate_at").select("at", F.struct(
            F.levenshtein("path", "mate_path").alias("far"), "mate_at", F.col("mate_hashes").alias("hashes"), F.col("mate_chars").alias("chars")).alias("mate"))
        nearest = near.groupBy("at").agg(F.array_sort(F.collect_list("mate")).alias("mates"))  # two at most
        return materialise(with_python(todo.join(nearest, "at"), compare, "gone array<int>", drop=("mates",)), name)

    first = tried(ranked.join(hosts, "host").where("low < high"), F.col("at") - 1, F.col("at") + 1, "page-mates")
    # Pages left stand in runs; the page beside a run is a near copy of its end and
    # has a different page on its other side.
    left = in_ranges(first.where("gone is null").select("at", "host"), ["at"], "page-left")
    runs = materialise(with_before(left, ["at"], {"before": F.lit(1).cast("long")}).withColumn("run", F.col("at") - F.col("before")), "page-runs")
    ends = runs.groupBy("host", "run").agg(F.min("at").alias("start"), F.max("at").alias("end"))
    again = first.where("gone is null").drop("gone").join(runs.join(ends, ["host", "run"]).select("at", "start", "end"), "at")
    second = tried(again, F.col("start") - 2, F.col("end") + 2, "page-far-mates")
    return first.unionByName(second, allowMissingColumns=True).where("gone is not null").select("host", "digest", "gone")


def extract_text(df: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per row of ``df``: id, url, text, n_chars, by_mates and by_structure
    (lines that went for being shared, and for where they stand).

    Null html and pages without text give an empty text.  A page whose url is
    null or has no host, or whose host holds nothing but copies and near copies
    of it, has no mate and keeps all its lines.  Copies in a host share a mate,
    that of the least path among them.  Repeated rows are pages of their own.
    Other columns are ignored.
    """
    def outline(b: pa.RecordBatch) -> dict[str, list]:
        pages = [page_lines(h) for h in b.column("html").to_pylist()]
        hashes = [*map(_hashes, pages)]
        return {"digest": [*map(_digest, hashes)], "hashes": hashes, "chars": [[-len(t) if p == MARKED else len(t) for t, p in page] for page in pages]}

    def parse(b: pa.RecordBatch) -> dict[str, list]:
        pages = [page_lines(h) for h in b.column("html").to_pylist()]
        return {"digest": [_digest(_hashes(page)) for page in pages], "lines": [[{"text": t, "place": p} for t, p in page] for page in pages]}

    def difference(b: pa.RecordBatch) -> dict[str, list]:
        found = [main_text(x, g) for x, g in zip(*(b.column(c).to_pylist() for c in ("lines", "gone")))]
        return {name: [f[i] for f in found] for i, name in enumerate(("text", "by_mates", "by_structure"))}

    raw = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"),
                    F.coalesce(url_host(url_col), F.lit("")).alias("host"))
    outlined = with_python(raw.select("host", F.coalesce(url_path(url_col), F.lit("")).alias("path"), "html"), outline,
                           "digest binary, hashes array<long>, chars array<int>", drop=("html",))
    pages = with_python(raw, parse, "digest binary, lines array<struct<text: string, place: int>>", drop=("html",))
    paired = pages.join(shared_lines(outlined), ["host", "digest"], "left").drop("host", "digest")
    texts = with_python(paired, difference, "text string, by_mates int, by_structure int", drop=("lines", "gone"))
    return texts.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text",
                        F.char_length("text").cast("long").alias("n_chars"), "by_mates", "by_structure")
