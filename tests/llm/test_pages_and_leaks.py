"""Page text and benchmark leaks against plain versions."""

import random
import re

from stockloom.llm import page_diff
from stockloom.llm.decontaminate import contaminated_pairs, drop_contaminated
from stockloom.llm.page_diff import common_lines, extract_text, page_lines

ARTICLE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href=x>Menu</a></ul></nav><!-- <p>no</p> --><div class="cookie-notice">Cookies</div>
<main><article><header><h1>Title &amp; more</h1></header><p>First   line<br>goes&nbsp;on<p>Second &lt;b&gt; <b>bold <i>it</b> end
<ul><li>One<li>Two</ul><div class="ad">Buy</div><form><input><p>Name</p></form><blockquote>Quote</blockquote>
<section id="comments"><p>First!</p></section></article><aside><p>Side</p></aside></main><footer>&copy; x</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, row string")


def texts(spark, rows):
    return sorted((r.page_id or -1, r.text) for r in extract_text(pages(spark, rows)).collect())


def test_structure(spark):
    want = "Title & more\nFirst line goes on\nSecond <b> bold it end\nOne\nTwo\nQuote"
    assert texts(spark, [(1, "http://a/1", ARTICLE), (2, "http://a/2", ARTICLE)]) == [(1, want), (2, want)]


def test_edges(spark):
    html = "<body><p>x</p>tail"
    rows = [(1, None, html), (2, "no scheme", html), (3, "http://a/", None), (4, "http://a/", ""), (5, "http://b/", html), (5, "http://b/", html),
            (6, "http://c/", "<p>" * 20000 + "deep"), (None, "http://d/", "plain &am &amp text &#8364;"), (7, "http://e/", "<div" * 10),
            (8, "http://f/", "<article><p>" + "long " * 200_000 + "</p></article>"), (9, "http://g/", "<nav>menu<article>in</article>")]
    got = texts(spark, rows)
    assert got[:7] == [(-1, "plain &am & text €"), (1, "x\ntail"), (2, "x\ntail"), (3, ""), (4, ""), (5, "x\ntail"), (5, "x\ntail")]
    assert dict(got)[6] == "deep" and dict(got)[8] == ("long " * 200_000).strip()
    assert extract_text(pages(spark, [])).count() == 0


def test_differencing_of_unmarked_pages(spark):
    def page(body):
        return f"<body><div>Top line</div><div>Shop</div>{body}<div>Bottom line</div></body>"

    rows = [(1, "http://a/x/1", page("<p>one</p>")), (2, "http://a/x/2", page("<p>two</p><p>more</p>")), (3, "http://a/y/1", page("<p>three</p>")),
            (4, "http://b/x/1", page("<p>alone</p>")), (5, "http://c/1", page("<p>copy</p>")), (6, "http://c/2", page("<p>copy</p>"))]
    got = dict(texts(spark, rows))
    assert (got[1], got[2], got[3]) == ("one", "two\nmore", "three")
    assert got[4] == "Top line\nShop\nalone\nBottom line" and got[5] == got[6] == "Top line\nShop\ncopy\nBottom line"


def test_structure_is_evidence_only(spark):
    story = "".join(f"<p>Story sentence {{0}} {i} with many plain words in it.</p>" for i in range(6))

    def page(body, n):
        return f"<body><div>Top line</div>{body.format(n)}<div>Bottom line</div></body>"

    told = lambda n: "\n".join(f"Story sentence {n} {i} with many plain words in it." for i in range(6))
    cards = "<article>Teaser A</article><article>Teaser B</article><div>" + story + "</div>"
    around = "<main><h1>Title {0}</h1><article>" + story + "</article><p>Closing words {0}</p></main>"
    wrapped = '<div class="sidebar layout"><form>' + story + "</form></div>"
    wrapped_article = '<div class="header fixed"><article>' + story + "</article></div>"
    rows = [(10 * k + n, f"http://h{k}/{n}", page(body, n)) for k, body in enumerate((cards, around, wrapped, wrapped_article)) for n in (1, 2)]
    got = dict(texts(spark, rows))
    for n in (1, 2):
        assert got[n] == told(n) and got[10 + n] == f"Title {n}\n{told(n)}\nClosing words {n}"
        assert got[20 + n] == told(n) and got[30 + n] == told(n)


def test_boilerplate_of_a_template_goes_by_its_mates(spark):
    """Menus, adverts and footers that a template repeats are found by differencing;
    structure is left with what only one page has."""
    def page(n, body):
        menu = "".join(f"<li>{x}" for x in ("Home", "Shop", f"Only {n}"))
        return (f"<body><nav><ul>{menu}</ul></nav><div class=ad>Buy now</div>{body}<aside><p>Side</p></aside>"
                f"<footer>Shop Ltd</footer></body>")

    rows = [(n, f"http://a/{n}", page(n, f"<article><p>Story {n} in its own words and more</p></article>")) for n in range(1, 7)]
    rows += [(10 + n, f"http://b/{n}", page(n, f"<p>Words {n} without any article</p>")) for n in range(1, 7)]
    rows += [(20, "http://c/1", page(1, "<p>No mate of this page at all</p>"))]
    got = {r.page_id: r for r in extract_text(pages(spark, rows)).collect()}
    for n in range(1, 7):
        assert got[n].text == f"Story {n} in its own words and more" and got[10 + n].text == f"Words {n} without any article"
        assert (got[n].by_mates, got[n].by_structure) == (got[10 + n].by_mates, got[10 + n].by_structure) == (5, 1)
    assert (got[20].text, got[20].by_mates, got[20].by_structure) == ("No mate of this page at all", 0, 6)


def test_menus_that_vary_go_if_any_neighbour_has_them(spark):
    def page(menu, text):
        return f"<body><nav>{menu}</nav><p>{text}</p></body>"

    rows = [(1, "http://a/1", page("odd", "one text")), (2, "http://a/2", page("even", "two text")), (3, "http://a/33", page("even", "three text"))]
    got = {r.page_id: (r.text, r.by_mates) for r in extract_text(pages(spark, rows)).collect()}
    assert got[2] == ("two text", 1)  # the nearest page has the other menu
    assert got[1] == ("one text", 0) and got[3] == ("three text", 1)


def test_mates_are_different_pages(spark):
    """Copies and near copies are passed over, and whole paths are compared."""
    def page(*lines):
        return "<body><div>Top line</div>" + "".join(f"<p>{x}</p>" for x in lines) + "<div>Bottom line</div></body>"

    same = [f"The copied article says {i} and more of it" for i in range(8)]
    near = [[*same[:3], f"changed {n}", *same[4:]] for n in range(40)]
    rows = [(100 + i, f"http://a/n/{i:03d}", page(*(near[i] if i >= 20 else same))) for i in range(40)]
    rows += [(50, "http://a/z", page("Another page with its own words"))]
    long = "/" + "d" * 250
    rows += [(60, f"http://b{long}/aa/x1", page("alpha", "only with beta")), (61, f"http://b{long}/aa/x2", page("beta", "only with beta")),
             (62, f"http://b{long}/zz/long/other", page("gamma"))]
    got = dict(texts(spark, rows))
    assert all(got[100 + i] == "\n".join(near[i] if i >= 20 else same) for i in range(40))
    assert got[50] == "Another page with its own words"
    assert (got[60], got[61], got[62]) == ("alpha", "beta", "gamma")


def test_common_lines_are_longest():
    rng = random.Random(0)
    for _ in range(400):
        k = rng.randint(1, 6)
        a, b = ([rng.randint(0, k) for _ in range(rng.randint(0, 16))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = common_lines(a, b)
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in found)
    long = [rng.randrange(3000) for _ in range(6000)]
    assert common_lines(long, long) == list(range(6000))


def test_given_pages(spark):
    """The article of every given page, cut out by hand."""
    import html as entities

    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = extract_text(df).collect()
    got = {r.page_id: r.text for r in found}
    assert sum(r.by_mates for r in found) > 0  # the given menus change from page to page: most of their lines are on no neighbour
    for r in df.collect():
        article = re.search("<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(entities.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", article)]
        assert got[r.page_id] == "\n".join(b for b in blocks if b)
    assert page_diff.page_lines(None) == page_lines("") == []


def grams(text, n=5):
    w = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def units(text):
    """Runs of letters and digits; ideographs, kana and Hangul one by one."""
    out = []
    for run in re.findall(r"[^\W_]+|[\u2e80-\u9fff\uac00-\ud7af\uf900-\ufaff]", (text or "").lower()):
        rest = ""
        for c in run:
            if "\u2e80" <= c <= "\u9fff" or "\uac00" <= c <= "\ud7af" or "\uf900" <= c <= "\ufaff":
                out += [rest, c] if rest else [c]
                rest = ""
            else:
                rest += c
        out += [rest] if rest else []
    return out


def leak(item, text):
    """(shingles of an item, those that a text holds); an item of fewer words than
    a shingle is one, wherever it stands."""
    words, own = units(text), units(item)
    n = min(5, len(own))
    mine, theirs = ({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if n else set() for w in (own, words))
    return len(mine), len(mine & theirs)


def test_leaks_against_plain(spark, docs):
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(3000)}"
    items = [(i, " ".join(word() for _ in range(rng.choice((1, 3, 5, 9, 30, 60, 400))))) for i in range(60)]
    items += [(60, items[10][1]), (61, None), (62, ""), (63, "!!"), (64, "same same same same same same same"),
              (None, items[11][1]), (None, "北京烤鸭"), (65, "漢"), (66, "two words"), (66, "two words")]
    rows = []
    for i in range(150):
        body = [word() for _ in range(rng.randrange(400))]
        if i % 2:
            passage = (rng.choice(items)[1] or "").split()
            for _ in range(rng.choice((0, 0, 1, 2))):
                if passage:
                    passage[rng.randrange(len(passage))] = "changed"
            at = rng.randrange(len(body) + 1)
            body[at:at] = passage
        rows.append((i, ", ".join(body).upper() if i % 3 else "\n".join(body)))
    rows += [(300, "昨天我们吃了北京烤鸭很好 and two  words"), (301, "北京的烤鸭店, 漢"), (302, "words two"), (303, "two words")]
    rows += [(None, items[30][1] + " tail"), (200, None), (201, ""), (202, "same " * 50), (5, items[31][1]), (5, items[31][1])]
    table = spark.createDataFrame(items, "item_id long, text string")
    want = sorted(((d, i, *found) for d, x in rows for i, t in items for found in [leak(t, x)]
                   if found[0] and 100 * found[1] >= 80 * found[0]), key=repr)
    assert {(300, None), (300, 66), (301, 65), (303, 66)} <= {w[:2] for w in want} and not any(w[0] == 302 for w in want)
    assert len(want) > 40
    df = docs(rows, extra=True)
    for block in (50_000, 7):
        got = contaminated_pairs(df, table, block_items=block, block_bytes=2_000 if block == 7 else 1 << 20).collect()
        assert sorted((tuple(r)[:4] for r in got), key=repr) == want
        clean = drop_contaminated(df, table, block_items=block)
        hit = lambda x: any(n and 100 * k >= 80 * n for n, k in (leak(t, x) for _, t in items))
        assert clean.columns == df.columns and clean.count() == sum(not hit(x) for _, x in rows)
    assert contaminated_pairs(docs([]), table).count() == 0 and drop_contaminated(df, table.limit(0)).count() == len(rows)
