"""Costly parts of a row's work are done once, not once for each class or field."""

from pyspark.sql import functions as F

from corpusmill.functions import text
from corpusmill.operators import validate


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_multihot_casts_each_number_once(spark):
    cells = [["1", "junk", "3"], None, ["2", None], [str(k % 2) for k in range(19)], [None] + ["1"] * 18, [], [" 4\t", "+5", "6.0", "99999999999", "-1", "x7"]]
    hot = spark.createDataFrame([(c,) for c in cells], "c array<string>").select(text.multihot(F.col("c")).alias("hot"))
    assert plan(hot).count("cast") <= 2
    on = [{k for k, v in enumerate(r.hot) if v} for r in hot.collect()]
    assert on == [{1, 3}, set(), {2}, set(range(1, 19, 2)), {1}, set(), {4, 5}]


def test_lines_look_for_keys_once(spark):
    df = spark.createDataFrame([(1, '{"id": 5}'), (2, "no"), (3, " ")], "line_no int, line string")
    judged = validate.lines(df)
    assert plan(judged).lower().count("jsonobjectkeys") == 1
    found = {r.line_no: r.errors for r in judged.collect()}
    assert found[2] == ["JSON parse error"] and len(found[1]) == 11 and set(found) == {1, 2}
