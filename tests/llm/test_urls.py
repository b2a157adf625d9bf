"""URL rules against a plain version."""

import random

import pytest

from stockloom.llm import url_filter
from stockloom.llm.url_filter import DigestArray, url_verdicts

RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"), ("a.b/x", "block"),
         ("b/xyz", "allow"), ("b/xy", "block"), ("both.org/", "block"), ("both.org/", "allow"), ("é.org/ü", "block")]


def plain(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[:min([i for i in (path.find(c) for c in "?#") if i >= 0], default=len(path))]
    best = None
    for rule, verdict in rules:
        h, p = rule.split("/", 1)
        if host and (host == h or host.endswith("." + h)) and path.startswith("/" + p):
            key = (-len(rule), rule, verdict != "block")
            best = min(best or key, key)
    return host, path, best[1] if best else None, ("allow" if best[2] else "block") if best else "allow"


def cases():
    rng = random.Random(0)
    hosts = ["example.net", "m.Example.NET", "x.example.com", "badexample.com", "net", "org", "a.b", "b", "c.a.b", "both.org", "é.org", "..net", "", "net:80"]
    paths = ["", "/", "/en/", "/en", "/de/1", "/fr/?q=/de/", "/x", "/xy", "/xyz/1", "/ü", "?a", "#/en/", "/EN/", "//en/"]
    urls = [f"{s}{h}{p}" for s in ("http://", "https://", "", "x://y://") for h in hosts for p in paths]
    return [None, "", "://", "no scheme", "http://" + "a." * 300 + "net/", "http://net/" + "p" * 20000, "http://net/\nen/", *rng.sample(urls, 300)]


@pytest.mark.parametrize("block_rules", [2_000_000, 3])
def test_against_plain(spark, block_rules):
    urls = cases()
    df = spark.createDataFrame([(i if i else None, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rules = spark.createDataFrame([*RULES, (None, "block"), ("noslash", "block")], "rule string, verdict string")
    got = {r.page_id: tuple(r)[1:] for r in url_verdicts(df, rules, block_rules=block_rules).collect()}
    assert got == {(i if i else None): plain(u, RULES) for i, u in enumerate(urls)}


def test_no_rules_no_rows(spark):
    rules = spark.createDataFrame([], "rule string, verdict string")
    df = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    assert [tuple(r) for r in url_verdicts(df, rules).collect()] == [(1, "a.net", "/", None, "allow")]
    assert url_verdicts(df.limit(0), rules).count() == 0


def test_equal_digests_are_told_apart(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter.xxhash, "xxh64_intdigest", lambda b: len(b))
    (tmp_path / "r").write_bytes(DigestArray.build([("aa/", True), ("bb/", False), ("c/", True)]))
    array = DigestArray(str(tmp_path / "r"))
    found = array.find([b"bb/", b"aa/", b"zz/", b"c/", b"longer/"])
    assert [array.text(i) if i >= 0 else None for i in found] == [b"bb/", b"aa/", None, b"c/", None]
    assert [bool(array.blocked[i]) for i in found if i >= 0] == [False, True, True]
