from __future__ import annotations

import os
import subprocess
import sys
import textwrap

from conftest import ROOT


def test_page_functions_run_where_the_package_is_not_installed(tmp_path):
    """A driver that finds the package by its own path only, started in another folder."""
    script = textwrap.dedent(
        f"""
        import sys; sys.path.insert(0, {str(ROOT)!r})
        from pyspark.sql import SparkSession, functions as F
        from doclake.functions.pages import clean_page, read_bodies, read_listing
        from doclake.functions.urls import absolute_url
        from doclake.sources.objects import export_objects
        spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
        rows = spark.createDataFrame([("a", b"<main>x</main>")], "file_path string, content binary")
        page = F.col("content")
        print(rows.select(clean_page(page)["container"], F.size(read_bodies(page)), absolute_url(F.lit("http://a.test/"), F.lit("b")),
              F.size(read_listing(page, F.lit("http://a.test"))["cards"])).head()[:])
        print(export_objects(rows, "file://{tmp_path}/out"))
        """
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=180
    )
    assert "('main', 0, 'http://a.test/b', 0)" in done.stdout, done.stderr[-2000:]
    assert "(1, 14)" in done.stdout
