from __future__ import annotations

import re

from ledgerline.llm import queries, url_templates
from tests.llm.conftest import SMALL

RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3 :]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    return re.sub("[A-Z]", lambda m: m[0].lower(), host), path


def rule(host, path):
    best = None
    for r in RULES:
        domain, _, prefix = r.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix):
            best = r if best is None or len(r) > len(best) else best
    return best


def check(rows, urls):
    got = sorted((str(r["page_id"]), r["host"], r["path"], str(r["rule"])) for r in rows)
    want = sorted((str(i), *parts(u), str(rule(*parts(u)))) for i, u in urls)
    assert got == want
    for r in rows:
        assert r["verdict"] == (RULES[r["rule"]] if r["rule"] else "block" if r["bad_rate"] >= 0.5 else "allow")


def test_rules_on_the_given_pages(spark):
    urls = [tuple(r) for r in spark.read.parquet(f"{SMALL}/pages.parquet").select("page_id", "url").collect()]
    check(queries.op1_url_templates(spark, SMALL).collect(), urls)


def test_awkward_urls(spark):
    urls = [
        (1, None), (2, ""), (3, "no scheme/path"), (4, "http://Example.ORG/en/12?x#y"), (5, "https://a.example.org/en/2"),
        (6, "ftp://org/"), (7, "http://com/de/"), (8, "http://x.com/fr/a/b/c/d/e/f"), (9, "http://xcom/de/1"), (10, "http://x.com?de/"),
        (11, "http://org#/"), (None, "http://m.org/Ä/1"), (12, "a://b://c.com/de/1"), (13, "http://x.org:80/es/"), (13, "http://x.org:80/es/"),
        (14, "http://h.net//es//" + "x" * 30000), (15, "http://h.net/a\nb/c"),
    ]
    pages = spark.createDataFrame([(*u, "x") for u in urls], "page_id long, url string, host string")
    labels = spark.createDataFrame([(1, 0, None), (None, 0, 1), (13, None, None)], "doc_id long, quality int, toxic int")
    check(url_templates.filter_urls(pages, labels).collect(), urls)
    assert url_templates.filter_urls(pages.limit(0), labels).count() == 0
    check(url_templates.filter_urls(pages, labels.limit(0)).collect(), urls)


def test_templates_merge_and_judge(spark):
    """One host: ids become wildcards, /de and /en (alike) merge, /spam (bad) stays apart and is blocked."""
    urls = [(i, f"http://h.net/{('de', 'en', 'spam')[i % 3]}/{1000 + i}") for i in range(300)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 3 != 2 or i % 30 == 2), 0) for i in range(0, 300)], "doc_id long, quality int, toxic int")
    out = url_templates.filter_urls(pages, labels)
    got = {(r["template"], r["verdict"], r["n"]) for r in out.groupBy("template", "verdict").count().withColumnRenamed("count", "n").collect()}
    assert got == {("/de|en/*", "allow", 200), ("/spam/*", "block", 100)}


def test_small_directories_of_a_large_host_stay_literal(spark):
    """60 directories of 25 urls each (under 2% of the host): the one labelled bad is blocked, the others are not."""
    urls = [(i, f"http://h.net/d{i % 60:02}/{1000 + i}") for i in range(1500)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 60 != 7), 0) for i in range(1500)], "doc_id long, quality int, toxic int")
    blocked = url_templates.filter_urls(pages, labels).where("verdict = 'block'").select("template", "path").collect()
    assert len(blocked) == 25 and {r["template"] for r in blocked} == {"/d07/*"} and all(r["path"].startswith("/d07/") for r in blocked)


def test_urls_that_differ_in_a_deep_segment(spark):
    urls = [(i, f"http://h.net/a/b/c/d/{('good', 'spam')[i % 2]}/{1000 + i}") for i in range(200)]
    pages = spark.createDataFrame([*urls, (900, "http://h.net/a/b/c/d/rare/x/y/z")], "page_id long, url string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0), 0) for i in range(200)], "doc_id long, quality int, toxic int")
    out = url_templates.filter_urls(pages, labels)
    got = {(r["template"], r["verdict"], r["n"]) for r in out.groupBy("template", "verdict").count().withColumnRenamed("count", "n").collect()}
    rare = {g for g in got if g[0] == "/a/b/c/d/*/*/*/*"}
    assert got - rare == {("/a/b/c/d/good/*", "allow", 100), ("/a/b/c/d/spam/*", "block", 100)} and len(rare) == 1


def test_no_group_holds_branches_that_differ():
    groups = url_templates.similar_groups([(200, round(200 * (0.02 + 0.08 * i))) for i in range(13)])
    assert groups == sorted(groups) and max(groups) >= 5  # .02 to .98: no chain from .18 to .82
    assert url_templates.similar_groups([(8, 8), (8, 0)]) == [1, 0]
    assert url_templates.similar_groups([(200, 100), (200, 104), (4, 2)]) == [0, 0, 0]
    assert url_templates.similar_groups([(4, 0), (200, 110)]) == [0, 0]
    assert url_templates.similar_groups([(4, 0), (5, 0), (6, 0), (7, 0), (200, 110)])[4] == 1


def test_bad_branch_beside_unlabelled_and_mixed_ones(spark):
    """/bad and /good (8 labels each) stay apart although /none has no label; /casino/new, without any, follows /casino."""
    urls = [(i, f"http://h.net/{('bad', 'good', 'none')[i % 3]}/{i}") for i in range(90)]
    urls += [(100 + i, f"http://h.net/casino/{('old', 'new')[i % 2]}/{i}") for i in range(100)]
    urls += [(1000 + i, f"http://h.net/main/{i}") for i in range(200)]
    pages = spark.createDataFrame(urls, "page_id long, url string")
    known = [(i, int(i % 3 == 1)) for i in range(24) if i % 3 < 2] + [(100 + i, 0) for i in range(0, 100, 2)]
    known += [(1000 + i, 1) for i in range(200)]
    labels = spark.createDataFrame([(i, q, 0) for i, q in known], "doc_id long, quality int, toxic int")
    out = url_templates.filter_urls(pages, labels).selectExpr("split(path, '/')[1] || '/' || split(path, '/')[2] AS p", "verdict", "template")
    got = {(r["p"].split("/")[0] if "casino" not in r["p"] else r["p"], r["template"], r["verdict"]) for r in out.collect()}
    assert {g[2] for g in got if g[0] == "casino/new"} == {"block"} == {g[2] for g in got if g[0] == "casino/old"}
    assert {g[2] for g in got if g[0] == "none"} == {"allow"} and {g[1] for g in got if g[0] == "none"} == {"/none/*"}
    assert {g[1] for g in got if g[0] == "bad"}.isdisjoint(g[1] for g in got if g[0] in ("good", "main"))
