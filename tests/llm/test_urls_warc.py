"""Operators 1 and 7."""

import gzip
import random

import pytest

from radiolith.llm import url_filter, warc
from radiolith.llm.common import shared_folder

RULES = [
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"), ("block", "a.example.org", ""), ("allow", "example.org", "/es/"), (None, None, None),
]


def _plain(host, path):
    best = None
    for action, rule_host, rule_path in RULES:
        if rule_host and (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            key = (len(rule_host + rule_path), rule_host + rule_path, action)
            best = max(best or key, key)
    return best[1:] if best else (None, "allow")


def test_rules_against_plain_matching(spark):
    rng = random.Random(4)
    urls = [None, "", "no scheme", "http://", "HTTP://ORG", "http://a.b.org?x=/es/", "x://example.org/en/12#f", "http://notorg/"]
    for _ in range(300):
        host = ".".join(rng.choice(["a", "b", "Example", "org", "com", "net"]) for _ in range(rng.randrange(1, 5)))
        urls.append(f"https://{host}{rng.choice(['', '/', '/es/', '/es/1', '/en/1', '/en/19', '/fr/x?q', '/de/#a', '/e'])}")
    rows = [(i, u, "x") for i, u in enumerate(urls)] + [(None, "http://example.org/es/2", "x")] * 2
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string").repartition(4)
    rules = spark.createDataFrame(RULES, "action string, host string, path string")
    got = url_filter.judge_urls(pages, rules).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r["rule"], r["verdict"]) == _plain(r["host"], r["path"]), r
    assert {r["rule"] for r in got if r["page_id"] is None} == {"example.org/es/"}
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    assert {r["rule"] for r in url_filter.judge_urls(pages, rules.limit(0)).collect()} == {None}


def test_url_parts(spark):
    frame = spark.createDataFrame([("http://A.b://c/d?e",), ("x",), ("http://h?a/b",)], "url string")
    got = frame.select(url_filter.url_host(frame.url).alias("h"), url_filter.url_path(frame.url).alias("p")).collect()
    assert [tuple(r) for r in got] == [("a.b:", "//c/d"), ("", ""), ("h", "")]


@pytest.mark.parametrize("least", [0, 4])
def test_archive_round_trip(spark, monkeypatch, least):
    monkeypatch.setattr(warc, "BLOCK_ENTRIES", 3)
    bodies = ["<p>one</p>", "<p>one</p>", None, "", "\r\n\r\nä", "<p>one</p>"] + [f"page {i}" * 50 for i in range(30)]
    rows = [(i, f"http://h{i % 4}.Ex.org/p{i % 7}", b) for i, b in enumerate(bodies)] + [(None, None, "x"), (2, "http://h2.Ex.org/p2", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    folder = shared_folder(spark, "warc-test")
    archive = warc.write_archive(pages, folder, min_revisit_bytes=least)
    got = warc.read_records(spark, folder, warc.lookup(spark, archive, pages)).collect()
    assert len(got) == len(rows)
    top = {}
    for page, _, body in rows:
        if page is not None:
            top[body or ""] = max(page, top.get(body or "", page))
    for r in got:
        body = next((b or "" for p, _, b in rows if p == r["id"]))
        want = top.get(body)
        follows = want is not None and want != r["id"] and len(body.encode()) >= least
        assert (r["record_type"], r["refers_to"]) == (("revisit", want) if follows else ("response", None))
        assert (r["payload_bytes"], r["payload_digest"]) == (len(body.encode()), warc.payload_digest(body.encode()))
        assert follows or r["payload"] == body.encode()
    one = spark.createDataFrame([("http://h1.ex.org/p1",), ("http://nowhere.org/",)], "url string")
    found = warc.read_records(spark, folder, warc.lookup(spark, archive, one)).collect()
    assert {r["id"] for r in found} == {i for i in range(36) if i % 4 == 1 and i % 7 == 1}


def test_empty_archive_and_damage(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = shared_folder(spark, "warc-test")
    archive = warc.write_archive(pages, folder)
    assert archive.shards == [] and warc.lookup(spark, archive, pages).count() == 0
    member = warc._member("response", "1", "u", warc.payload_digest(b"a"), 1, b"b", None)
    with pytest.raises(ValueError):
        warc.read_record(member)
    assert gzip.decompress(member).startswith(b"WARC/1.1\r\n")


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}"])
def test_folders_in_every_form(spark, tmp_path, form):
    from radiolith.llm.common import store_of

    folder = form.format(tmp_path / "archive")
    pages = spark.createDataFrame([(1, "http://a.org/x", "one"), (2, "http://a.org/y", "one"), (3, None, None)], "page_id long, url string, html string")
    archive = warc.write_archive(pages, folder)
    got = warc.read_records(spark, folder, warc.lookup(spark, archive, pages)).collect()
    assert sorted((int(r["id"]), r["record_type"]) for r in got) == [(1, "revisit"), (2, "response"), (3, "response")]
    assert store_of(folder)[1] == str(tmp_path / "archive")
