"""Every catalog query against its SQL over the smallest tables."""

from __future__ import annotations

from pathlib import Path

import oracle
import pytest

from lumenframe.catalog_queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no tables")


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_same_rows_as_sql(spark, con, name):
    assert oracle.difference(QUERIES[name](spark, SF), con, ORACLE_SQL[name]) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_without_sql_it_runs(spark, name):
    assert QUERIES[name](spark, SF).count() > 0


def test_html_strip_on_pages_that_were_cut_and_odd_entities(spark, tmp_path):
    texts = ["<p>a &amp; b &am", "a &lt;b&gt; &amp", "x &quot", "&eacute; &#8217; &amp;lt;", "a\u00a0 \t\n b\u2003 c &nbsp; d ", "<a", "", None, "\x1f \x85 z"]
    spark.createDataFrame(list(enumerate(texts)), "page_id long, html string").write.parquet(str(tmp_path / "pages.parquet"))
    con = oracle.duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert oracle.difference(QUERIES["html_strip"](spark, str(tmp_path)), con, ORACLE_SQL["html_strip"]) is None


def test_registry_imports():
    import __spark_entry__

    assert set(ORACLE_SQL) <= set(__spark_entry__.queries())
