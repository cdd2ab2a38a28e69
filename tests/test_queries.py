"""Every registered query against its SQL, and the shape of every plan."""

import os

import pytest
from oracle import connect, differences

from larkspur.plans import REGISTRY

FOLDER = os.environ.get("LARKSPUR_TABLES", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return connect(FOLDER)


@pytest.mark.parametrize("name", REGISTRY)
def test_query(spark, con, name):
    entry = REGISTRY[name]
    df = entry.run(spark, FOLDER)
    problems, _ = differences(df, con, entry.oracle)
    assert not problems
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan
    if name != "udf_scalar":
        assert "ArrowEvalPython" not in plan and "PythonUDF" not in plan


def test_scans_read_only_what_is_needed(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    plan = REGISTRY["flt_conjunction"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    for pushed in ("EqualTo(l_returnflag,R)", "EqualTo(l_linestatus,O)", "EqualTo(l_quantity,24.0)"):
        assert pushed in plan
    chained = REGISTRY["flt_chained"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert chained.count("Filter (") == 1 and "EqualTo(l_quantity,24.0)" in chained
    grouped = REGISTRY["agg_group_count_1"].run(spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_returnflag:string>" in grouped and "partial_count" in grouped


def test_entry_points(spark):
    import __spark_entry__ as contract

    assert set(contract.oracle_sql()) >= set(REGISTRY) and set(contract.queries()) >= set(REGISTRY)
    assert set(contract.queries()) >= set(contract.oracle_sql())
    flagship = contract.entry(spark)
    assert flagship.columns == ["n_name", "count"] and flagship.count() > 1
