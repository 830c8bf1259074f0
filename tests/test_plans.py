"""Plan checks: pruning reaches the scan on link-free paths; the BM25
ranking is a partial top-k (window group limit). The checks for
bad operators over every query live in test_queries."""
import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_sitemap_path_does_not_read_html(spark):
    p = plan(E.queries()["sitemap_urls"](spark, SF))
    for line in p.split("\n"):
        if "ReadSchema" in line or "FileScan" in line:
            assert "html" not in line


def test_topk_is_partial(spark):
    p = plan(E.queries()["corpus_search"](spark, SF))
    assert "WindowGroupLimit" in p
