"""Plan shape checks: column pruning reaches the scan, no cartesian products over rows."""
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

QUERIES = E.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_page_links_reads_two_columns(spark):
    p = plan(QUERIES["page_links"](spark, SF_SMALL))
    assert "ReadSchema: struct<page_id:bigint,html:string>" in p or "struct<page_id:bigint,html:string>" in p


@pytest.mark.parametrize("name", ["late_share_by_carrier", "kruskal_carrier", "dunn_carrier", "mid_ranks",
                                  "upsert_notices_single", "chronological_split", "histogram"])
def test_no_cartesian_product(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    assert "CartesianProduct" not in p


def test_views_read_written_enriched_table(spark):
    p = plan(QUERIES["heatmap_masked"](spark, SF_SMALL))
    assert "tables/enriched" in p and "events.parquet" not in p
