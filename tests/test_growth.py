"""Work that must grow no faster than its tables."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import functions as F

from doclake.functions import markup
from workload import dates, listings, zones


def _orders(spark, path, rows):
    columns = "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"
    spark.createDataFrame([(k, 1, "O", 1.0, d, "1-URGENT") for k, d in rows], columns).write.parquet(f"{path}/orders.parquet")


def test_open_windows_meet_days_not_orders(spark, tmp_path, monkeypatch):
    orders = [(k, datetime(1995, 1, 1) + timedelta(days=k % 4)) for k in range(200)] + [(None, None), (201, None), (7, datetime(1995, 1, 2))]
    _orders(spark, tmp_path, orders)
    suppliers = [(s, s % 3) for s in range(1, 9)]
    spark.createDataFrame(suppliers, "s_suppkey long, s_nationkey int").write.parquet(f"{tmp_path}/supplier.parquet")
    met, join = [], dates.windows.range_join
    monkeypatch.setattr(dates.windows, "range_join", lambda rows, *more: met.append(rows.count()) or join(rows, *more))
    found = {tuple(r) for r in dates.range_join_open(spark, str(tmp_path)).collect()}

    leap, first, expected = date(1996, 2, 29), date(1992, 1, 1), {}
    for s, nation in suppliers:
        start = first + timedelta(days=s * 37 % 2500)
        end = {0: date(9999, 12, 31), 1: first}.get(s % 4, start + timedelta(days=nation * 9))
        for key, at in orders:
            day = leap if key is not None and key % 3 == 0 else at and at.date()
            if day and start <= day < end:
                hot = int(day == leap)
                n, keys = expected.get((s, hot), (0, 0))
                expected[s, hot] = n + 1, keys + key
    assert found == {(s, hot, n, keys) for (s, hot), (n, keys) in expected.items()} and found
    assert met[0] <= 6  # four days, the leap day, and no day


class _Counting:
    def __init__(self, pattern):
        self.pattern, self.calls = pattern, 0

    def search(self, *a):
        self.calls += 1
        return self.pattern.search(*a)

    def fullmatch(self, *a):
        self.calls += 1
        return self.pattern.fullmatch(*a)


def test_repeated_tags_are_cut_once(monkeypatch):
    token = _Counting(markup._TOKEN)
    monkeypatch.setattr(markup, "_TOKEN", token)
    page = markup.Page('<li class="each-item row"><span title="a>b">x &amp; y</span></li>' * 100)
    assert [e.attrs for e in page.select("span")] == [{"title": "a>b"}] * 100
    assert [page.text(e) for e in page.select("li.each-item")] == ["x & y"] * 100
    # Of the four tags only that with ">" in a value is looked at each time it comes, twice at most.
    assert token.calls <= 2 * 100 + 3


def test_what_is_kept_of_tags_is_bounded():
    markup.Page("".join(f'<a href="/{i}">' for i in range(2 * markup._MOST_READ)) + "<b x='" + "y" * 500 + "'>")
    assert len(markup._cut) <= markup._MOST_READ and all(len(t) <= markup._LONGEST_READ for t in markup._cut)


def test_hostile_listings_are_read_once(spark, tmp_path):
    _orders(spark, tmp_path, [(k, datetime(1995, 1, 1)) for k in range(100)])
    found = listings.hostile_listings(spark, str(tmp_path))
    assert "ArrowEvalPython" not in found._jdf.queryExecution().executedPlan().toString()
    rows = found.collect()
    assert len(rows) == 10 and sum(r.cards for r in rows) == 100 and not any(r.failures for r in rows)


def test_batches_of_pages_are_bounded(spark, tmp_path):
    page = "<html><title>t</title><article>" + "x" * 1000 + "</article></html>"
    frame = spark.range(3).select(F.col("id").alias("page_id"), F.lit("http://a.test/").alias("url"), F.lit(page).alias("html"))
    frame.write.parquet(f"{tmp_path}/pages.parquet")
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r.title for r in zones.page_titles(spark, str(tmp_path)).collect()] == ["t"] * 3
    assert int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= 2000
