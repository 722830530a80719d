"""Every query of the record engine against its SQL."""

import pytest
from oracle import both

from curata.queries import ORACLE, QUERIES


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert len(QUERIES) == 53


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    sf = "sf0.01" if name == "seeded_sample" else "sf0.001"  # the sample's SQL has literals for one size
    ours, theirs = both(spark, f"/root/testdata/{sf}", QUERIES[name], ORACLE[name])
    assert ours == theirs
    assert ours


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(3).count() == 3
    assert set(e.oracle_sql()) <= set(e.queries())


@pytest.mark.parametrize("name", ["redact_secrets", "nonlinguistic", "record_ids", "label_like"])
def test_text_queries_stay_in_the_jvm(spark, name):
    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_scan_reads_only_what_is_used(spark):
    plan = QUERIES["redact_secrets"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,text:string>" in plan
