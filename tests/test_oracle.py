"""Every catalogue query against its DuckDB oracle (values, names, types, row count, no Python in the plan)."""

import pytest

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from kiln.plans.catalog import REGISTRY
from kiln.plans.inspect import plan_text
from oracle_compare import compare, duck

NAMES = sorted(REGISTRY)


def test_every_query_has_an_oracle():
    assert set(REGISTRY) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["l_returnflag", "l_suppkey", "supplied", "place"]
    assert len(rows) > 0


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle_small(spark, con_small, name):
    df = E.queries()[name](spark, SF_SMALL)
    text = plan_text(df, "formatted")
    assert "EvalPython" not in text and "InPandas" not in text, "Python in the plan"
    problems, _, _ = compare(spark, SF_SMALL, name, lambda s, d: df, E.oracle_sql()[name], con_small)
    assert not problems, problems


# A few cheap queries again at the driver's correctness scale.
@pytest.mark.parametrize("name", ["group_sum_desc", "pivot_sql", "top_per_group_df", "table_delete"])
def test_query_matches_oracle_sf001(spark, name):
    if name not in E.queries():
        pytest.skip("not registered")
    problems, _, _ = compare(spark, SF_ORACLE, name, E.queries()[name], E.oracle_sql()[name])
    assert not problems, problems


def test_every_query_names_its_survey_ids():
    import re

    for name, fn in REGISTRY.items():
        doc = fn.__doc__ or ""
        m = re.match(r"\[([A-Z]\d+(?:-R?\d+)?(?:, [A-Z]\d+(?:-R?\d+)?)*)\]", doc)
        assert m, f"{name} lacks its operator ids"
