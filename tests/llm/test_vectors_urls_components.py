"""Vectors, urls and components against brute force."""

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tideline.llm import ann_forest, embedding_dedup, url_filter
from tideline.llm.common import among, connected_components
from tideline.llm.queries import op9_url_filter, oracle_sql

SCHEMA = "vec_id long, embedding array<float>, label int, id string, v int, dims int, q int, n int, key string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, la, "x", 1, 2, 3, 4, "k") for i, e, la in rows], SCHEMA)


def small_vectors():
    rng = np.random.default_rng(1)
    rows, n = [], 0
    for g in range(12):
        base = rng.standard_normal(16)
        for c in range(g):
            rows.append((n, (base + 0.05 * rng.standard_normal(16) * (c % 3)).astype(np.float32).tolist(), g % 3))
            n += 1
    rows += [(n + i, rows[50][1], rows[50][2]) for i in range(9)]
    n += 9
    odd = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0] * 8]
    rows += [(n + i, e, 1) for i, e in enumerate(odd)]
    return rows + [(n + 20, [1.0] * 16, None), (n + 21, [1.0] * 16, None)]


def valid(e):
    return bool(e) and all(x is not None and np.isfinite(x) for x in e) and any(e)


def test_embedding_dedup(spark):
    rows = small_vectors()
    got = {r.id: r for r in embedding_dedup.embedding_near_dups(vectors(spark, rows)).collect()}
    links = []
    for i, e, la in rows:
        for j, f, lb in rows:
            if i < j and la is not None and la == lb and valid(e) and valid(f) and len(e) == len(f):
                a, b = np.array(e, float), np.array(f, float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.98:
                    links.append((i, j))
    root = {i: i for i, _, _ in rows}
    for _ in rows:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert len(got) == len(rows)
    for i, _, _ in rows:
        assert got[i].n_links == sum(i in pair for pair in links) and got[i].component_id == root[i]
    assert embedding_dedup.embedding_near_dups(vectors(spark, [])).count() == 0


@pytest.mark.parametrize("shard_rows", [8192, 100])
def test_nearest_recall(spark, shard_rows):
    table = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = table.orderBy("vec_id").collect()
    e = np.array([r.embedding for r in rows], float)
    ids = np.array([r.vec_id for r in rows])
    got = ann_forest.nearest(table, F.col("vec_id") % 20 == 0, shard_rows=shard_rows).collect()
    hits = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        s = e @ e[q]
        s[q] = -np.inf
        best = ids[np.lexsort((ids, -s))[:20]]
        mine = sorted([r for r in got if r.query_id == ids[q]], key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert all(abs(r.score - e[np.searchsorted(ids, r.vec_id)] @ e[q]) < 1e-9 for r in mine)
        assert all((a.score, -a.vec_id) > (b.score, -b.vec_id) for a, b in zip(mine, mine[1:]))
        hits += len({r.vec_id for r in mine} & set(best.tolist()))
        total += 20
    assert hits / total >= 0.9


def test_nearest_ties_lengths_and_odd_rows(spark):
    rows = small_vectors() + [(0 + 1000 + i, (np.ones(16) * (i % 4 + 1)).tolist(), 0) for i in range(40)]
    got = ann_forest.nearest(vectors(spark, rows), F.col("vec_id") == 1000, k=20).collect()
    e = {i: np.array(v, float) for i, v, _ in rows if valid(v) and len(v) == 16}
    want = sorted((-(e[i] @ e[1000]), i) for i in e if i != 1000)[:20]
    assert [(r.rank, r.vec_id) for r in sorted(got, key=lambda r: r.rank)] == [(k + 1, i) for k, (_, i) in enumerate(want)]
    few = vectors(spark, [(0, [1.0, 0.0], 0), (20, [0.0, 1.0], 0), (3, [1.0, 1.0], 0)])
    assert ann_forest.nearest(few, F.col("vec_id") % 20 == 0).count() == 4
    assert ann_forest.nearest(few.limit(0), F.col("vec_id") % 20 == 0).count() == 0


PAGES = [
    (1, "http://Www.Example.COM/en/8?q#f", None), (2, "https://example.com/en/7x", None), (3, "https://a.net/de/1", None), (4, "https://sub.example.net/de/8", None), (5, "http://notcom/en/", None), (6, None, "<html>"), (7, "no scheme", None),
    (8, "http://free.site/a", '<link rel="canonical" href="http://bad.org/es/x">'), (9, "http://free.site/b", "<LINK href=/a rel='canonical'>"), (10, "http://other.site/", '<meta http-equiv="refresh" content="0; url=http://free.site/b#z">'),
    (11, "http://safe.site/p", '<link rel=canonical href="https://example.com/en/7">'), (12, "http://safe.site/q", '<link rel="canonical" href="p"><link rel="canonical" href="http://x.org/es/">'), (13, "http://free.site/c", '<link rel="stylesheet" href="http://bad.org/es/x">'), (13, "http://free.site/c", ""),
]


def test_urls(spark):
    pages = spark.createDataFrame([(*p, "c", 1) for p in PAGES], "page_id long, url string, html string, name string, host int")
    got = {r.page_id: r for r in url_filter.url_verdicts(pages).collect()}
    assert {i: (r.rule, r.verdict) for i, r in got.items()} == {
        1: ("com/en/", "block"), 2: ("example.com/en/7", "allow"), 3: ("net/de/", "block"), 4: ("example.net/de/8", "allow"), 5: (None, "allow"), 6: (None, "allow"), 7: (None, "allow"),
        8: (None, "block"), 9: (None, "block"), 10: (None, "block"), 11: (None, "allow"), 12: (None, "allow"), 13: (None, "allow"),
    }
    assert (got[1].host, got[1].path) == ("www.example.com", "/en/8") and (got[7].host, got[7].path) == ("", "") == (got[6].host, got[6].path)
    more = spark.createDataFrame([("http://free.site/c", "http://z.org/es/")], "src string, dst string")
    assert {r.verdict for r in url_filter.url_verdicts(pages, redirects=more).where("page_id = 13").collect()} == {"block"}
    assert url_filter.url_verdicts(pages).count() == len(PAGES) and url_filter.url_verdicts(pages.limit(0)).count() == 0


def test_urls_by_the_rules_of_the_contract(spark, tmp_path):
    """Each rule's word as in the contract's list; the longest rule wins on subdomains too."""
    rows = [
        (1, "http://a.com/en/x", "com/en/", "block"), (2, "http://example.com/en/71", "example.com/en/7", "allow"), (3, "http://a.net/de/1", "net/de/", "allow"),
        (4, "http://sub.example.net/de/8", "example.net/de/8", "block"), (5, "http://example.net/de/7", "net/de/", "allow"), (6, "http://x.org/es/", "org/es/", "block"), (7, "http://x.org/fr/", None, "allow"),
    ]
    spark.createDataFrame([(i, u, "") for i, u, _, _ in rows], "page_id long, url string, html string").write.parquet(f"file://{tmp_path}/pages.parquet")
    got = sorted((r.page_id, r.rule, r.verdict) for r in op9_url_filter(spark, f"file://{tmp_path}").collect())
    assert got == [(i, rule, verdict) for i, _, rule, verdict in rows]


def test_urls_by_one_name(spark):
    """Host case, default ports, dot segments, an empty path and fragments make no other page."""
    link = '<link rel="canonical" href="{}">'.format
    rows = [
        (1, "https://alias.site/x", link("https://w.org/es/1")), (2, "https://second.site/y", link("HTTPS://Alias.SITE:443/a/.././x#top")), (3, "https://third.site:443/y?q=1", link("https://alias.site/x")),
        (4, "http://root.site", link("http://w.org/es/2")), (5, "http://ROOT.site:80/", None), (6, "https://alias.site/X", None), (2, "https://second.site/y", None), (7, None, link("https://w.org/es/1")),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = sorted((r.page_id, r.verdict) for r in url_filter.url_verdicts(pages).collect())
    assert got == [(1, "block"), (2, "block"), (2, "block"), (3, "block"), (4, "block"), (5, "block"), (6, "allow"), (7, "allow")]
    con = duckdb.connect()
    con.register("pages", pa.Table.from_pylist([dict(zip(("page_id", "url", "html"), r)) for r in rows]))
    assert sorted((r[0], r[4]) for r in con.sql(oracle_sql()["op9_url_filter"]).fetchall()) == got
    names = pages.select(url_filter.name(F.lit("http://a.b/../../c/./d/..")).alias("n")).first().n
    assert names == "http://a.b/c/"


def test_components_of_chains_stars_and_loops(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, i) for i in range(1001, 1400)]
    edges = chain + star + [(5000, 5000), (6000, 6001), (6001, 6000), (None, 3), (7002, 7001), (7001, 7000)]
    got = {r.id: r.component for r in connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    want = {i: 0 for i in range(301)} | {i: 1000 for i in range(1000, 1400)} | {6000: 6000, 6001: 6000} | {7000 + i: 7000 for i in range(3)}
    assert got == want
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_among_keeps_the_rows_of_given_ids(spark):
    ids = [0, 1, 63, 64, 65, 127, -1, -64, -65, 1 << 33, (1 << 62) + 63, 5, 5, None]
    rows = [(i, f"t{i}") for i in [*range(-130, 130), 1 << 33, (1 << 33) + 1, (1 << 62) + 63, (1 << 62) + 62, None, 64, 64]]
    table, wanted = spark.createDataFrame(rows, "row long, text string"), spark.createDataFrame([(i,) for i in ids], "row long")
    want = sorted(r for r in rows if r[0] is not None and r[0] in ids)
    assert sorted(map(tuple, among(table, wanted, "row").collect())) == want
    assert among(table, wanted.limit(0), "row").count() == 0 == among(table.limit(0), wanted, "row").count()


def test_among_scattered_ids_loses_none_and_lets_few_others_through(spark):
    table = spark.range(20000).select(F.xxhash64("id").alias("pid"))
    wanted = spark.range(300).select(F.xxhash64("id").alias("pid"))
    got = {r.pid for r in among(table, wanted, "pid", scattered=True).collect()}
    assert {r.pid for r in wanted.collect()} <= got
    assert len(got) < 300 + 20000 / 10
    assert among(table, wanted.limit(0), "pid", scattered=True).count() == 0
