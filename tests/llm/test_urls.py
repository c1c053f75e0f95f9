"""Host and path, rules and reputation; the query against its SQL."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

from doclake.llm import mixing, queries, urls

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for name in ("documents", "labels", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", list(queries.ORACLES))
def test_query_equals_its_sql(spark, oracle, name):
    result = queries.QUERIES[name](spark, SMALL)
    cursor = oracle.execute(queries.ORACLES[name])
    names = [c[0] for c in cursor.description]
    assert sorted(names) == sorted(result.columns)
    got = sorted((tuple(r[n] for n in names) for r in result.collect()), key=repr)
    assert got and got == sorted(cursor.fetchall(), key=repr)


def test_parts_of_urls(spark):
    rows = [
        ("http://A.Example.COM/En/x?q#f", "a.example.com", "/En/x"),
        ("http://É.com", "É.com", ""),
        ("x://a?b://c/d", "a", ""),
        ("a.com/b", "", ""),
        ("", "", ""),
        (None, "", ""),
        ("://", "", ""),
        ("http://a://b/c", "a:", "//b/c"),
        ("http://h#f/p", "h", ""),
        ("line\n://Host/p\nq?x", "host", "/p\nq"),
    ]
    frame = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)], "i int, url string")
    got = frame.orderBy("i").select(urls.host(F.col("url")), urls.path(F.col("url"))).collect()
    assert [tuple(r) for r in got] == [r[1:] for r in rows]


def test_rules(spark):
    cases = [
        ("com", "/", "com/"),
        ("a.com", "/x", "com/"),
        ("acom", "/x", None),
        ("a.com", "", None),
        ("example.com", "/en/1", "example.com/en/"),
        ("b.example.com", "/en/", "example.com/en/"),
        ("www.example.com", "/en/1", "www.example.com/en/"),
        ("x.www.example.com", "/en/1", "www.example.com/en/"),
        ("a.net", "/es/1", "net/es/"),
        ("a.net", "/es", None),
        ("a.net", "/fr/", "net/fr/"),
        ("", "", None),
    ]
    frame = spark.createDataFrame([(i, *c[:2]) for i, c in enumerate(cases)], "i int, host string, path string")
    text, verdict = urls.matching_rule(F.col("host"), F.col("path"), queries.URL_RULES)
    got = frame.orderBy("i").select(text.alias("t"), verdict.alias("v")).collect()
    assert [r.t for r in got] == [c[2] for c in cases]
    assert {r.t: r.v for r in got} == {None: None, "com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block", "net/fr/": "block"}


def test_reputation_blocks_what_is_surely_bad(spark):
    pages, outcomes, n = [], [], 0
    for host, good, bad, unknown in (("good.a.org", 40, 2, 1), ("bad.b.org", 2, 60, 3), ("new.b.org", 0, 0, 2), ("new.a.org", 0, 0, 2), ("one.c.org", 0, 1, 1)):
        for label in [1] * good + [0] * bad + [None] * unknown:
            pages.append((n, f"http://{host}/p", "x"))
            outcomes.append((n, label))
            n += 1
    pages += [(None, None, "x"), (3, "http://good.a.org/p", "x")]
    frame = spark.createDataFrame(pages, "page_id long, url string, verdict string")
    judged = urls.judge(frame, spark.createDataFrame(outcomes, "page_id long, good int"), [])
    rows = judged.collect()
    assert len(rows) == len(pages)
    verdict = {r.host: r.verdict for r in rows}
    assert verdict == {"good.a.org": "allow", "bad.b.org": "block", "new.b.org": "block", "new.a.org": "allow", "one.c.org": "allow", "": "allow"}
    share = {r.host: r.share for r in rows}
    # No label: between the domain and the suffix; few: drawn to the domain.
    assert share["bad.b.org"] < share["new.b.org"] < share["new.a.org"] < share["good.a.org"]
    assert 0.1 < share["one.c.org"] < share["new.a.org"]


def test_domains_and_suffixes(spark):
    hosts = {
        "a.b.example.com": ("example.com", "com"),
        "a.site.co.uk:8080": ("site.co.uk", "co.uk"),
        "co.uk": ("co.uk", "co.uk"),
        "me.github.io": ("me.github.io", "github.io"),
        "10.0.0.1:80": ("10.0.0.1", "10.0.0.1"),
        "[::1]:80": ("[::1]", "[::1]"),
        "localhost": ("localhost", "localhost"),
        "": ("", ""),
    }
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = {r.host: (r.d, r.s) for r in frame.select("host", *[c.alias(n) for c, n in zip(urls.levels(F.col("host")), "ds", strict=True)]).collect()}
    assert got == hosts


def test_an_id_that_repeats_on_both_sides(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")] * 300 + [(2, "http://b.org/")], "page_id long, url string")
    outcomes = spark.createDataFrame([(1, 1)] * 200 + [(2, 0)], "page_id long, good int")
    counts = {r.host: (r.n, r.good) for r in urls.reputation(pages.select("page_id", urls.host(F.col("url")).alias("host")), outcomes).collect()}
    assert counts == {"a.org": (60000, 60000), "b.org": (1, 0)}


def test_reputation_without_rows_or_labels(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, good int")
    assert [(r.verdict, r.share) for r in urls.judge(pages, none, []).collect()] == [("allow", 0.5)]
    assert urls.judge(pages.limit(0), none, queries.URL_RULES).count() == 0


def test_no_python_in_native_queries(spark):
    for name in ("op5_url_filter", "op7_mix_sources"):
        plan = queries.QUERIES[name](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "InArrow", "Cartesian", "NestedLoop"))


def brute_targets(sizes, weights=(5, 2, 1), budget=1.5, most=2.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[at % len(weights)] for at, s in enumerate(order)}
    held, total = {}, budget * sum(sizes.values())
    while True:
        left = sum(w for s, w in weight.items() if s not in held)
        rate = (total - sum(held.values())) / left if left else 0.0
        above = [s for s in sizes if s not in held and weight[s] * rate > most * sizes[s]]
        if not above:
            return {s: held.get(s, weight[s] * rate) for s in sizes}
        held.update({s: most * sizes[s] for s in above})


def sized(spark, docs):
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string, taken string")
    return mixing.sizes(frame)


def test_mixing(spark):
    docs, n = [], 0
    for source, count, length in (("b", 300, 7), ("a", 40, 50), ("Ä", 5, 3), (None, 10, 11), ("B", 1, 1), ("z", 3, 0)):
        for i in range(count):
            docs.append((n, "w\t" * (length + i % 5 if length > 1 else length), source, "x"))
            n += 1
    docs += [(None, None, "a", "x"), (None, None, "a", "x"), (1, docs[1][1], "b", "x"), (1, docs[1][1], "b", "x")]
    frame = sized(spark, docs)
    rows = mixing.plan(frame, mixing.targets(frame)).collect()
    assert len(rows) == len(docs)
    sizes, taken, target = {}, {}, {}
    for r in rows:
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
        taken[r.source] = taken.get(r.source, 0) + r.taken
        target[r.source] = r.target
        assert 0 <= r.taken <= 2 * r["size"]
        assert r.taken == sum(c.words for c in r.copies)
        assert all(0 <= c.position <= 1 for c in r.copies)
    assert target == pytest.approx(brute_targets(sizes))
    assert taken == {s: round(t) for s, t in target.items()}
    again = mixing.plan(frame.repartition(7), mixing.targets(frame)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, rows))


def test_one_id_is_many_lanes(spark):
    docs = [(7, f"{i} " * (1 + i % 3), "a", None) for i in range(400)] + [(i, "w w", "b", None) for i in range(200)]
    frame = sized(spark, docs)
    rows = mixing.plan(frame, mixing.targets(frame)).collect()
    taken = {s: sum(r.taken for r in rows if r.source == s) for s in "ab"}
    assert taken == {r.source: round(r.target) for r in rows}


CLASHING = ("target", "taken", "copies", "source_size", "position", "words", "row", "size", "tie", "lane", "_row")


def test_mix_keeps_clashing_columns(spark):
    values = [(i, "w " * 10, "ab"[i % 2] if i < 200 else "c", *[f"{c}{i}" for c in CLASHING]) for i in range(300)]
    docs = spark.createDataFrame(values, ["doc_id", "text", "source", *CLASHING])
    rows = mixing.mix(docs).collect()
    assert rows[0].asDict().keys() == set(docs.columns)
    assert all(r[c] == f"{c}{r.doc_id}" for r in rows for c in CLASHING)


def test_curriculum_order(spark):
    docs = [(i, "w " * 10, "ab"[i % 2] if i < 200 else "c", None) for i in range(300)]
    mixed = mixing.mix(spark.createDataFrame(docs, "doc_id long, text string, source string, taken string"))
    rows = mixed.collect()
    frame = sized(spark, docs)
    planned = mixing.plan(frame, mixing.targets(frame)).collect()
    first = {r.doc_id: r.copies[0].position for r in planned if r.copies}
    met = list(dict.fromkeys(r.doc_id for r in rows))
    assert [first[i] for i in met] == sorted(first[i] for i in met)
    early = [r.source for r in rows[: len(rows) // 2]]
    late = [r.source for r in rows[len(rows) // 2 :]]
    # The heavy source fades, the light one rises.
    assert early.count("a") > late.count("a") and early.count("c") < late.count("c")
    copies = {r.doc_id: 0 for r in rows}
    for r in rows:
        copies[r.doc_id] += 1
    for r in planned:
        assert copies.get(r.doc_id, 0) in (r.taken // 10, r.taken // 10 + 1)


def test_mixing_nothing(spark):
    empty = sized(spark, [(1, "a", "a", "x")]).limit(0)
    assert mixing.mix(spark.createDataFrame([], "doc_id long, text string, source string")).count() == 0
    assert mixing.plan(empty, mixing.targets(empty)).count() == 0
    blank = sized(spark, [(1, "", "a", "x"), (2, None, None, "x")])
    assert [(r.taken, r.target) for r in mixing.plan(blank, mixing.targets(blank)).collect()] == [(0, 0.0), (0, 0.0)]
