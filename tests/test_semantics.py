"""Rule semantics on tiny literal frames (the odd cases of the source rules)."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from rumbo import functions as R
from rumbo.operators import agg, control, dedupe, joins


def one(spark, expr, schema="x string", rows=(("a",),)):
    return spark.createDataFrame(list(rows), schema).select(expr.alias("v")).collect()


def test_strip_leading_zeros(spark):
    rows = spark.createDataFrame([("0020",), ("20",), ("000",), (None,)], "c string").select(
        R.strip_leading_zeros("c").alias("v")).collect()
    assert [r.v for r in rows] == ["20", "20", "", None]


def test_concat_key_null_propagates(spark):
    rows = spark.createDataFrame([(1, "a"), (2, None)], "a int, b string").select(
        R.concat_key("a", "b").alias("v"), R.account_hash("a", "b").alias("h")).collect()
    assert rows[0].v == "1a" and rows[1].v is None and rows[1].h is None
    assert rows[0].h == hashlib.md5(b"1a").hexdigest()


def test_language_label(spark):
    rows = spark.createDataFrame([("2",), ("42",), (None,), ("9",)], "c string").select(
        R.language_label("c").alias("v")).collect()
    assert [r.v for r in rows] == ["GL", "ES", "ES", "PT"]


def test_add_months_month_end_rules(spark):
    df = spark.createDataFrame([(dt.date(2019, 2, 28),), (dt.date(2019, 1, 31),)], "d date")
    clamp = [r.v for r in df.select(R.add_months("d", 12, "clamp").alias("v")).collect()]
    last = [r.v for r in df.select(R.add_months("d", 12, "last_day").alias("v")).collect()]
    assert clamp == [dt.date(2020, 2, 28), dt.date(2020, 1, 31)]
    assert last == [dt.date(2020, 2, 29), dt.date(2020, 1, 31)]


def test_like_is_case_sensitive_and_exact_without_wildcard(spark):
    texts = ["SEGURO HOGAR PISO", "seguro hogar piso", "HOGAR AUTO", "VIDA", "Hogar x", "MULTIRRIESGO CASA"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(
        R.home_receipt_label("t").alias("v")).collect()
    assert [r.v for r in rows] == ["AUTO", "AUTO", None, None, None, "AUTO"]


def test_priority_order_contracting_not_first(spark):
    hits = [(1, "contratacion", "x", 1), (1, "abc", "x", 2), (1, "", "x", 3), (1, None, "x", 4),
            (2, "", "b", 1), (2, "", "", 2), (2, "", "a", 3)]
    df = spark.createDataFrame(hits, "k int, p string, s string, id int")
    top = dedupe.first_row_per_key(df, ["k"], dedupe.priority_order("p", "s", "contratacion", [F.col("id")]))
    got = {r.k: r.id for r in top.collect()}
    # NULL process sorts first (NULLS FIRST); 'abc' beats 'contratacion'; '' is last.
    assert got[1] == 4
    # among equal processes: non-empty sections first, descending
    assert got[2] == 1


def test_count_distinct_skips_null_pairs(spark):
    df = spark.createDataFrame([(1, 10, "a"), (1, 10, None), (1, None, "b"), (1, 10, "a"), (1, 11, "a")],
                               "k int, p int, a string")
    df = df.select("*", R.flag(F.col("p") == 10).alias("on"), F.lit(0).alias("young"),
                   F.lit(0).alias("easy"), F.lit(1).alias("tot"))
    r = agg.account_mix(df, ["k"], "p", "a", "on", "young", "easy", "tot").collect()[0]
    assert r.NUMERO_CUENTAS == 2 and r.NUMERO_CUENTAS_ON == 3 and r.INDICADOR_TODAS_ONJOVEN == 0


def test_keep_newest_modes_agree(spark):
    df = spark.createDataFrame([(1, "20240101"), (2, "20240103"), (3, "20240103")], "i int, d string")
    for mode in ("subquery", "join", "literal"):
        assert sorted(r.i for r in control.keep_newest(df, "d", mode=mode).collect()) == [2, 3]


def test_control_table_casts_mixed_types(spark):
    a = spark.createDataFrame([(20240101,), (20240105,)], "d int")
    b = spark.createDataFrame([("2024-01-03",)], "d string")
    c = control.control_table([("a", a.select(F.to_date(F.col("d").cast("string"), "yyyyMMdd").alias("d")), "d"),
                               ("b", b, "d")])
    got = {r.C1: r.C2 for r in c.collect()}
    assert got == {"a": dt.date(2024, 1, 5), "b": dt.date(2024, 1, 3)}


def test_passing_ids_equals_theta_join(spark):
    scores = spark.createDataFrame([(1, "M1", 0.5), (2, "M1", 0.3), (3, "M2", 0.9), (4, "M3", 0.99), (5, "M1", None)],
                                   "id int, m string, s double")
    thr = spark.createDataFrame([("M1", 0.4), ("M1", 0.6), ("M2", 0.95), ("M2", None), ("M3", 0.1)],
                                "m string, t double")
    got = sorted(r.id for r in joins.passing_ids(scores, thr, "id", "m", "s", "m", "t", models=["M1", "M2"]).collect())
    theta = scores.alias("a").join(thr.alias("b"), (F.col("a.m") == F.col("b.m")) & (F.col("a.s") >= F.col("b.t")))
    want = sorted({r.id for r in theta.filter(F.col("a.m").isin("M1", "M2")).select("a.id").collect()})
    assert got == want == [1]


def test_presence_does_not_multiply_rows(spark):
    left = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,)], "k2 int")
    out = joins.with_presence(left, right, "k", "k2", "f").orderBy("k").collect()
    assert [(r.k, r.f) for r in out] == [(1, 1), (2, 0), (3, 1)]


def test_semi_and_anti_partition_input(spark):
    left = spark.createDataFrame([(i, i % 3) for i in range(30)], "i int, g int")
    right = spark.createDataFrame([(0,), (2,), (2,)], "g int")
    s, a = joins.semi(left, right, ["g"]), joins.anti(left, right, ["g"])
    assert s.count() + a.count() == 30 and s.intersect(a).count() == 0


def test_latest_row_independent_of_partitioning(spark):
    rows = [(k, dt.date(2024, 1, 1 + (i % 3)), i) for k in range(20) for i in range(9)]
    df = spark.createDataFrame(rows, "k int, d date, i int")
    ref = None
    for n in (1, 3, 7):
        got = sorted(tuple(r) for r in dedupe.latest_row_per_key(df.repartition(n), ["k"], "d",
                                                                [F.col("i").desc()]).collect())
        ref = ref or got
        assert got == ref
    assert all(r[2] in (8, 5, 2) and r[1] == dt.date(2024, 1, 3) for r in ref)


def test_pivot_max_fixed_schema(spark):
    df = spark.createDataFrame([(1, "A", 0.2), (1, "A", 0.4), (1, "B", 0.1), (2, "C", 0.9)],
                               "k int, m string, p double")
    out = {r.k: (r.a, r.b) for r in agg.pivot_max(df, "k", "m", "p", {"A": "a", "B": "b"}, 0.0).collect()}
    assert out == {1: (0.4, 0.1), 2: (0.0, 0.0)}


def test_birthday_by_parts_december_branch_never_fires(spark):
    from rumbo.operators.people import birthday_by_parts
    df = spark.createDataFrame([(dt.date(1998, 1, 15),), (dt.date(1998, 12, 15),)], "b date")
    # run in December: the January birthday (due next month) is never selected
    got = df.filter(birthday_by_parts("b", dt.date(2024, 12, 15), 26)).count()
    assert got == 0
    got = df.filter(birthday_by_parts("b", dt.date(2024, 11, 15), 26)).collect()
    assert [r.b for r in got] == [dt.date(1998, 12, 15)]


def test_left_join_skew_safe_equals_left_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (3, "d")], "k int, x string")
    right = spark.createDataFrame([(1, 10), (1, 11), (3, 30), (4, 40), (None, 50)], "rk int, y int")
    key = lambda t: tuple((v is None, v if v is not None else 0) for v in t)
    got = sorted((tuple(r) for r in joins.left_join_skew_safe(left, right, [("k", "rk")]).collect()), key=key)
    want = sorted((tuple(r) for r in left.join(right, left.k == right.rk, "left").collect()), key=key)
    assert got == want and len(got) == 5
