"""What is dear is made once for a row, however often a plan names it."""

from evigrade.operators import validate
from evigrade.plans import catalogue

SMALL = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_triage_summary_makes_states_once(spark):
    plan = _plan(catalogue.triage_summary(spark, SMALL))
    assert plan.count("[^a-z0-9]+") == 1
    assert plan.count("[^0-9]+") == 1


def test_summary_counts_equal_rows_first(spark):
    rows = spark.createDataFrame([("a", None), ("a", "x"), ("b", "x")], "p string, q string")
    found = {tuple(r) for r in validate.triage_summary(rows, ("p", "q")).collect()}
    assert found == {("p", "a", 2), ("p", "b", 1), ("q", "", 1), ("q", "x", 2)}
    assert "count(1)" in _plan(validate.triage_summary(rows, ("p", "q"))).split("Generate")[1]
