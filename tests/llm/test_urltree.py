"""Hosts, paths, rules, templates and verdicts of urls."""

import pytest
from odd_rows import clashing
from pyspark.sql import functions as F
from tessera.llm import urltree as ut

URLS = [
    ("https://A.Example.NET/en/x?q=1", "a.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://a.example.net/de/x#f", "a.example.net", "/de/x", "net/", "block"),
    ("http://net/", "net", "/", "net/", "block"),
    ("http://net", "net", "", None, "allow"),
    ("http://example.net?x=/en/", "example.net", "", None, "allow"),
    ("http://notexample.com/de/1", "notexample.com", "/de/1", None, "allow"),
    ("http://b.example.com/de/", "b.example.com", "/de/", "example.com/de/", "block"),
    ("http://b.example.com/de", "b.example.com", "/de", None, "allow"),
    ("x://org/fr/y://z", "org", "/fr/y://z", "org/fr/", "allow"),
    ("no scheme", "", "", None, "allow"), ("", "", "", None, "allow"), (None, "", "", None, "allow"),
    ("://", "", "", None, "allow"), ("http://É.ORG/Ä", "É.org", "/Ä", None, "allow"),
    ("http://h/a\nb/c", "h", "/a\nb/c", None, "allow"),
]
NO_LABELS = "label_id long, bad long"


def test_host_path_rule_and_default(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id long, url string")
    out = ut.judge_urls(df, spark.createDataFrame([], NO_LABELS)).orderBy("page_id").collect()
    for r, (_, host, path, rule, verdict) in zip(out, URLS):
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict)


def tree(spark):
    rows, labels = [], []
    for i in range(120):
        rows.append((len(rows), f"http://h.test/good/{i}", 0))
        rows.append((len(rows), f"http://h.test/spam/{i}.html", 1))
        rows.append((len(rows), f"http://h.test/slug-{chr(97 + i % 26)}{chr(97 + i // 26)}/page", 0))
        rows.append((len(rows), f"http://other.test/spam/{i}", 0))
    for page, _, bad in rows:
        if page % 3 == 0:
            labels.append((page, bad))
    pages = spark.createDataFrame([(p, u, p) for p, u, _ in rows], "page_id long, url string, doc long")
    return pages, spark.createDataFrame(labels, NO_LABELS), {p: bad for p, _, bad in rows}


def test_templates_generalise_merge_and_reject(spark):
    pages, labels, bad = tree(spark)
    out = ut.judge_urls(pages, labels, label_id="doc").collect()
    assert all((r["verdict"] == "block") == bool(bad[r["page_id"]]) for r in out)
    templates = {r["host"]: set() for r in out}
    for r in out:
        templates[r["host"]].add(r["template"])
    assert templates["other.test"] == {""}                                  # one kind of page: one template
    assert any(t.startswith("/spam") for t in templates["h.test"])


def test_crowded_nodes_become_wildcards(spark):
    counts = spark.createDataFrame(
        [("h", [f"s{i}x", "p"], 1) for i in range(50)] + [("h", ["blog", "p"], 100), ("g", ["a", "b"], 1), ("g", [], 1)],
        "host string, shape array<string>, pages long").withColumn("t", F.lit(""))
    first = ut._one_down(counts, 0)
    got = {(r["host"], tuple(r["shape"])): r["t"] for r in ut._one_down(first.drop("up", "seg"), 1).collect()}
    assert {t for (h, s), t in got.items() if h == "h"} == {"/*/p", "/blog/p"}
    assert got["g", ("a", "b")] == "/a/b" and got["g", ()] == ""


@pytest.mark.parametrize("above", ["", "/a/b/c/d", "/1/b/c/d/e/f/g/h/i/j"])
def test_branches_are_judged_at_any_depth(spark, above):
    rows = [(i, f"http://h{above}/{'spam' if i % 2 else 'good'}/{i}", i % 2) for i in range(400)]
    pages = spark.createDataFrame([r[:2] for r in rows], "page_id long, url string")
    labels = spark.createDataFrame([(i, bad) for i, _, bad in rows if i % 3 == 0], NO_LABELS)
    got = {r["page_id"]: r["verdict"] for r in ut.judge_urls(pages, labels).collect()}
    assert got == {i: "block" if bad else "allow" for i, _, bad in rows}


def test_digits_in_paths(spark):
    df = spark.createDataFrame([(1, "http://h/1/22/x3y/z/deep//er/still")], "page_id long, url string")
    (r,) = df.select(ut._segments(ut.path_of(F.col("url"))).alias("s")).collect()
    assert r["s"] == ["#", "#", "x#y", "z", "deep", "er", "still"]


def test_empty_tables_clashes_and_repeats(spark):
    pages, labels, _ = tree(spark)
    none = pages.limit(0)
    assert ut.judge_urls(none, labels).count() == 0
    twice = clashing(pages.union(pages), "host", "path", "rule", "shape", "fit", "row", "label")
    out = ut.judge_urls(twice, labels, label_id="doc")
    assert out.count() == 2 * pages.count() and {r["fit"] for r in out.collect()} == {"own fit"}


@pytest.mark.parametrize("bad,quality,toxic", [(1, 0, 0), (1, 1, 1), (0, 1, 0), (0, None, None)])
def test_document_labels(spark, bad, quality, toxic):
    labels = spark.createDataFrame([(1, quality, toxic), (1, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert [tuple(r) for r in ut.document_labels(labels).collect()] == [(1, bad)]
