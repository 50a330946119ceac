import random

import duckdb
import pytest
from pyspark.sql import functions as F

import compare
from airsift.llm import url_filter
from airsift.llm.queries import QUERIES, SQL
from conftest import SMALL

PAGES = "page_id long, url string, good boolean, host string, shape string, template string"


def judged(spark, rows):
    table = spark.createDataFrame([(k, url, good, "x", "y", "z") for k, (url, good) in enumerate(rows)], PAGES)
    return {r["page_id"]: r for r in url_filter.judge(table).collect()}


@pytest.mark.parametrize(
    "url, host, path, rule, verdict",
    [
        ("http://Example.COM/en/1", "example.com", "/en/1", "example.com/en/", "block"),
        ("http://www.example.com/en/1?x=/a", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
        ("http://a.www.example.com/en/#top", "a.www.example.com", "/en/", "www.example.com/en/", "allow"),
        ("http://badexample.com/en/1", "badexample.com", "/en/1", "com/", "allow"),
        ("http://x.com", "x.com", "", None, "allow"),
        ("http://x.net/es/", "x.net", "/es/", "net/es/", "block"),
        ("http://x.net/ES/", "x.net", "/ES/", None, "allow"),
        ("http://x.net?u=http://y.net/es/", "x.net", "", None, "allow"),
        ("a://b://c/d", "b:", "//c/d", None, "allow"),
        ("no scheme", "", "", None, "allow"),
        ("", "", "", None, "allow"),
        (None, "", "", None, "allow"),
        ("http://É.net/fr/é\nx", "É.net", "/fr/é\nx", "net/fr/", "block"),
    ],
)
def test_parts_and_rules(spark, url, host, path, rule, verdict):
    got = judged(spark, [(url, None)])[0]
    assert (got["host"], got["path"], got["rule"], got["verdict"]) == (host, path, rule, verdict)


def test_bad_branch_is_rejected_and_similar_ones_merge(spark):
    rows = [(f"http://h.org/{part}/{k}/x{k}", k % 10 > 0) for part in ("a", "b", "c") for k in range(60)]
    rows += [(f"http://h.org/spam/{k}/x{k}", k % 10 == 0) for k in range(60)] + [("http://h.org/spam/999/x999", None), ("http://h.org/a/999/x", None)]
    rows += [("http://h.org/" + "deep/" * 500, None), ("http://h.org/a/1/x1", True), ("http://h.org/a/1/x1", True), (None, False)]
    got = judged(spark, rows)
    assert {got[k]["template"] for k in range(180)} == {"/~8/*/*"} and got[0]["verdict"] == "allow"
    assert {got[k]["template"] for k in range(180, 240)} == {"/~1/*/*"}
    assert {got[k]["verdict"] for k in range(180, 241)} == {"block"}
    assert got[241]["verdict"] == "allow" and got[242]["template"] == "/*" * 500


def test_branches_that_differ_at_any_depth_are_judged_apart(spark):
    rows = []
    for depth in (4, 5, 22):
        start = "http://h.org/" + "/".join(f"d{depth}" for _ in range(depth))
        rows += [(f"{start}/{part}/x{k}", good) for part, good in (("news", True), ("spam", False)) for k in range(30)] + [(f"{start}/spam/x", None), (f"{start}/news/x", None)]
    # Too few labels to differ: a step for each segment.
    rows += [(f"http://few.org/a/b/c/d/{part}/f", good) for part, good in (("p", True), ("q", False))] + [("http://few.org/a/b/c/d/p/f/g", None)]
    got = judged(spark, rows)
    for start in range(0, 186, 62):
        assert {got[start + k]["verdict"] for k in [*range(30), 61]} == {"allow"}
        assert {got[start + k]["verdict"] for k in [*range(30, 61)]} == {"block"}
        assert len({got[start + k]["template"] for k in range(62)}) >= 2
    assert got[186]["template"] == got[187]["template"] == "/*" * 6 and got[188]["template"] == "/*" * 7


def test_empty(spark):
    assert url_filter.judge(spark.createDataFrame([], PAGES)).count() == 0


def test_query_equals_sql(spark):
    assert compare.difference(spark, compare.connect(SMALL), SMALL, QUERIES["op8_url_filter"], SQL["op8_url_filter"]) == ""


def test_query_equals_sql_on_paths_of_up_to_twelve_segments(spark, tmp_path):
    """Common prefixes, branches that differ at any depth, variable and numbered segments, paths that end inside others."""
    rng = random.Random(5)
    urls, marks = [], []
    for number in range(3000):
        host = rng.choice(["a.org", "b.net", "www.example.com", "deep.org"])
        depth = rng.randrange(1, 13)
        parts = ["same", "same"] if host == "deep.org" else []
        while len(parts) < depth:
            parts.append(rng.choice(["news", "spam", "news", "p" if len(parts) % 3 else f"v{rng.randrange(60)}x", f"id{rng.randrange(9)}"]))
        parts = parts[:depth]
        bad = "spam" in parts[depth // 2 :] or host == "deep.org" and parts[-1] == "p"
        urls.append((number, f"http://{host}/{number}/" + "/".join(parts) + rng.choice(["", "/", "?q"])))
        if rng.random() < 0.7:
            marks.append((number, int(bad == (rng.random() < 0.06)), 0))
    urls += [(None, None), (9001, "x"), (9002, "http://a.org"), (9003, "http://deep.org/same/same")]
    folder = str(tmp_path)
    spark.createDataFrame(urls, "page_id long, url string").withColumn("html", F.lit("")).write.parquet(f"{folder}/pages.parquet")
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    connection = duckdb.connect()
    for name in ("pages", "labels"):
        connection.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet/*.parquet')")
    assert compare.difference(spark, connection, folder, QUERIES["op8_url_filter"], SQL["op8_url_filter"]) == ""
    found = QUERIES["op8_url_filter"](spark, folder).select("template").distinct().collect()
    assert any("~" in r.template.rpartition("/")[0][10:] for r in found)


def test_pages_take_the_labels_of_their_documents(spark):
    pages = spark.createDataFrame([(1, "http://a.b/en/7"), (2, "http://a.b/en/" + "9" * 40), (3, None), (None, "http://a.b/8/x"), (4, "http://a.b/x")], "page_id long, url string")
    labels = spark.createDataFrame([(7, 1), (7, 0), (8, 1), (None, 0), (9, None)], "doc_id long, quality int")
    got = {r["page_id"]: r["good"] for r in url_filter.label_pages(pages, labels).collect()}
    assert got == {1: False, 2: None, 3: None, None: True, 4: None}
