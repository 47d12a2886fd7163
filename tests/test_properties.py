"""Randomised properties of the rewrites (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rumbo.operators import dedupe, joins

models = st.sampled_from(["M1", "M2", "M3"])
score = st.one_of(st.none(), st.floats(0, 1, allow_nan=False).map(lambda x: round(x, 2)))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 9), models, score), max_size=25),
       st.lists(st.tuples(models, score), max_size=8))
def test_min_threshold_join_equals_theta_join(spark, scores, thresholds):
    s = spark.createDataFrame(scores, "id int, m string, s double")
    t = spark.createDataFrame(thresholds, "m string, t double")
    got = sorted(r.id for r in joins.passing_ids(s, t, "id", "m", "s", "m", "t", models=["M1", "M2"]).collect())
    theta = s.alias("a").join(t.alias("b"), (F.col("a.m") == F.col("b.m")) & (F.col("a.s") >= F.col("b.t")))
    want = sorted({r.id for r in theta.filter(F.col("a.m").isin("M1", "M2")).select("a.id").collect()})
    assert got == want


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 5), st.integers(0, 3)), min_size=1, max_size=40),
       st.integers(1, 6))
def test_top1_does_not_depend_on_partitioning(spark, rows, parts):
    df = spark.createDataFrame(rows, "k int, d int, v int")
    order = [F.col("d").desc(), F.col("v").asc()]
    a = sorted(tuple(r) for r in dedupe.first_row_per_key(df, ["k"], order).collect())
    b = sorted(tuple(r) for r in dedupe.first_row_per_key(df.repartition(parts), ["k"], order).collect())
    assert a == b
    best = {}
    for k, d, v in rows:
        if k not in best or (d, -v) > (best[k][0], -best[k][1]):
            best[k] = (d, v)
    assert a == sorted((k, d, v) for k, (d, v) in best.items())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.integers(0, 9)), max_size=20),
       st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 9)), max_size=30))
def test_skew_safe_left_join_equals_left_join(spark, left_rows, right_rows):
    left = spark.createDataFrame(left_rows, "k int, x int")
    right = spark.createDataFrame(right_rows, "rk int, y int")
    key = lambda t: tuple((v is None, v if v is not None else 0) for v in t)
    got = sorted((tuple(r) for r in joins.left_join_skew_safe(left, right, [("k", "rk")]).collect()), key=key)
    want = sorted((tuple(r) for r in left.join(right, left.k == right.rk, "left").collect()), key=key)
    assert got == want
