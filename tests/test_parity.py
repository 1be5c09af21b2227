import pytest

from parity import compare, tables
from quire import catalogue

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE))
def test_query_equals_sql(spark, name):
    _, wrong = compare(spark, tables(SF_DIR), SF_DIR, name)
    assert not wrong


def test_chain_without_sql(spark):
    """classify_all alone has no SQL: it gives each block of the stripped books one row, in order and with a role."""
    assert set(catalogue.QUERIES) - set(catalogue.ORACLE) == {"classify_all"}
    rows = catalogue.QUERIES["classify_all"](spark, SF_DIR).collect()
    places = sorted((r.doc_id, r.pos) for r in rows)
    assert len(places) == len(set(places)) and all(b == (a[0], a[1] + 1) or b[1] == 0 for a, b in zip(places, places[1:]))
    roles = {r.role for r in rows}
    assert None not in roles and {"chapter_heading", "body_paragraph"} < roles


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scan_needs_no_shuffle(spark):
    plan = catalogue.QUERIES["txt_scan"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_classification_shares_one_shuffle(spark):
    frame = catalogue.QUERIES["c001_landmarks"](spark, SF_DIR)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") <= 2 and "Python" not in plan
