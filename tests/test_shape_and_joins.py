import datetime
import itertools
import random

import pytest
from pyspark.sql import functions as F

from kinfold import fixed
from kinfold.functions.attributes import is_registered, map_attributes
from kinfold.operators import joins, serve, shape


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_golden_record_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "b"), (None, 5, "a"), (1, 2, None), (1, 1, "z")],
                               "k int, a int, b string")
    assert rows(shape.golden_record(df, "k")) == rows(
        spark.createDataFrame([(None, 5, "b"), (1, 2, "z")], df.schema))
    assert shape.golden_record(df, "k", "keep").count() == 3
    assert rows(shape.golden_record(df, "k", "drop")) == [(1, 2, "z")]


def test_fold_last_wins_and_null_code(spark):
    df = spark.createDataFrame(
        [(1, "P", "old", 1), (1, "P", "new", 2), (1, "W", None, 1), (1, None, "x", 1), (2, "P", "y", 1)],
        "k int, code string, v string, seq int")
    got = {r["k"]: r["v"] for r in
           shape.fold_code_values(df, "k", "code", ["v"], ["seq"]).collect()}
    assert got == {1: {"P": "new", "W": None}, 2: {"P": "y"}}


def test_fold_without_order_takes_greatest_row(spark):
    df = spark.createDataFrame([(1, "P", "a", "z"), (1, "P", "b", "y")],
                               "k int, code string, v string, w string")
    assert shape.fold_code_values(df, "k", "code").first().asDict() == \
        {"k": 1, "v": {"P": "b"}, "w": {"P": "y"}}


def test_ordered_path(spark):
    df = spark.createDataFrame(
        [(1, 2, "B"), (1, 1, "A"), (1, 2, "B"), (1, 3, None), (2, 1, None), (3, 9, "X")],
        "k int, seq int, v string")
    assert rows(shape.ordered_path(df, "k", ["seq"], "v")) == [(1, "A_B"), (2, ""), (3, "X")]


def test_dedup_is_deterministic(spark):
    data = [(1, "b", 2), (1, "a", 9), (1, "a", 3), (2, None, 1), (None, "q", 1), (None, "p", 7)]
    for order in itertools.islice(itertools.permutations(data), 0, 700, 97):
        df = spark.createDataFrame(list(order), "k int, v string, n int")
        assert rows(shape.dedup_by_key(df, "k")) == \
            sorted([(1, "a", 3), (2, None, 1), (None, "p", 7)], key=repr)


def test_defaults(spark):
    df = spark.createDataFrame([(None, None, None), ("x", 0, 1.5)], "s string, i int, d double")
    filled = shape.fill_defaults(df, {"s": "Unknown", "i": 0, "d": "text", "absent": 1})
    assert rows(filled) == [("Unknown", 0, None), ("x", 0, 1.5)]
    back = shape.restore_defaults(filled, {"s": "Unknown", "i": 0})
    assert rows(back) == [(fixed.NULL_TOKEN, fixed.NULL_TOKEN, None), ("x", fixed.NULL_TOKEN, 1.5)]


def skewed(spark, seed=3):
    random.seed(seed)
    left = [(i, "hot" if random.random() < 0.6 else random.choice(["a", "b", None, "only_left"]))
            for i in range(5000)]
    right = [("hot", 1), ("hot", 2), ("a", 3), (None, 4), ("only_right", 5)]
    return (left, right, spark.createDataFrame(left, "i int, lk string"),
            spark.createDataFrame(right, "rk string, r int"))


@pytest.mark.parametrize("how", ["inner", "left", "full"])
@pytest.mark.parametrize("null_safe", [False, True])
def test_salted_join_equals_plain(spark, how, null_safe):
    _, _, left, right = skewed(spark)
    cond = F.col("lk").eqNullSafe(F.col("rk")) if null_safe else F.col("lk") == F.col("rk")
    plain = left.join(right, cond, how)
    salted = joins.salted_join(left, right, "lk", "rk", how, null_safe=null_safe, rows_per_salt=100)
    assert rows(salted) == rows(plain.select(salted.columns))


def test_salted_full_without_null_keys(spark):
    left, right, l_df, r_df = skewed(spark)
    got = joins.salted_join(l_df, r_df, "lk", "rk", "full", drop_null_keys=True)
    want = sum(sum(1 for k, _ in right if k == key) or 1 for _, key in left if key is not None) + 1
    assert got.count() == want
    assert got.filter("lk IS NULL AND rk IS NULL").count() == 0


def test_salted_join_spreads_hot_key(spark):
    _, _, left, right = skewed(spark)
    plan = joins.salted_join(left, right, "lk", "rk", rows_per_salt=100)._jdf.queryExecution()
    assert "_salt" in plan.toString() and "CartesianProduct" not in plan.toString()


def test_star_join_matches_null_to_null(spark):
    base = spark.createDataFrame([(1, 10), (2, None)], "id int, k int")
    dim = spark.createDataFrame([(10, "ten"), (None, "none"), (None, "nil")], "dk int, name string")
    assert rows(joins.star_join(base, [(dim, "k", "dk")])) == \
        [(1, 10, 10, "ten"), (2, None, None, "nil"), (2, None, None, "none")]
    assert joins.star_join(base, [(dim, "k", "dk")], null_safe=False).count() == 2


def test_asof_boundaries(spark):
    def ts(s):
        return datetime.datetime.fromisoformat(s)
    versions = spark.createDataFrame([
        ("USD", ts("2024-01-10T05:00"), 1.0), ("USD", ts("2024-01-10T09:00"), 2.0),
        ("USD", ts("2024-01-20T00:00"), 3.0), ("EUR", ts("2024-01-05T23:59"), 7.0)],
        "cur string, start timestamp, rate double")
    facts = spark.createDataFrame([
        (1, "USD", "2024-01-09"), (2, "USD", "2024-01-10"), (3, "USD", "2024-01-19"),
        (4, "USD", "2024-01-20"), (5, "EUR", "2030-01-01"), (6, "XXX", "2024-01-10"),
        (7, None, "2024-01-10"), (8, "USD", None)],
        "id int, cur string, d string").withColumn("d", F.col("d").cast("date"))
    out = joins.asof_rate_join(facts, versions, "cur", "d", "start", ["rate"])
    got = {r["id"]: (r["rate"], str(r["effective_end"])) for r in out.collect()}
    assert got == {1: (None, "None"), 2: (2.0, "2024-01-20 00:00:00"), 3: (2.0, "2024-01-20 00:00:00"),
                   4: (3.0, "None"), 5: (7.0, "None"), 6: (None, "None"), 7: (None, "None"),
                   8: (None, "None")}


def test_flag_never_fans_out(spark):
    df = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    keys = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    assert rows(joins.flag_by_key(df, keys, "k", "f")) == [(1, "yes"), (2, "no"), (None, "no")]


def test_impute(spark):
    df = spark.createDataFrame([("a", "1950-01-01"), ("a", "2024-05-05"), ("a", None), ("b", "1900-01-01"),
                                ("b", None), ("c", None)], "n string, dob string")
    ok = (F.col("dob") >= "1947-01-01") & (F.col("dob") < "2023-12-12")
    assert rows(joins.impute_by_group(df, "n", "dob", ok).filter("n != 'a' OR dob < '2000'")) == \
        rows(spark.createDataFrame([("a", "1950-01-01"), ("a", "1950-01-01"), ("b", "1900-01-01"),
                                    ("b", "1900-01-01"), ("c", None)], df.schema))


REGISTERED = [
    ((None, None, None, None), "No"), ((None, None, "x", None), "Yes"), ((None, None, "x", "y"), "Yes"),
    (("x", "y", "x", "y"), "Yes"), (("x", "y", "x", "z"), "No"), (("x", "y", "p", "q"), "No"),
    (("x", "y", None, None), "No"), (("x", None, "x", None), "No"), (("x", None, "x", "y"), "No")]


def test_registered_switch(spark):
    df = spark.createDataFrame([r[0] for r in REGISTERED], "a string, b string, c string, d string")
    flags = df.select(is_registered(*[F.col(c) for c in "abcd"])).collect()
    assert [f[0] for f in flags] == [r[1] for r in REGISTERED]


def test_map_phone_of_empty_map(spark):
    df = spark.sql("SELECT 'x' AS e_p, map() AS m_p, 'k' AS f_a, 'k' AS f_b")
    source = [{"entityName": "f", "columnName": c} for c in "abab"]
    rules = [{"attributeName": "Phone", "transformationFunction": "GetDetailsPhone",
              "sourceColumns": [{"entityName": "e", "columnName": "p"}, {"entityName": "m", "columnName": "p"}]},
             {"attributeName": "IsRegistered", "transformationFunction": "GetIsRegistered",
              "sourceColumns": source}]
    df = df.withColumn("m_p", F.col("m_p").cast("map<string,string>"))
    assert map_attributes(df, rules).first()["Phone"] is None


def test_pivot_names_nulls_and_collisions(spark):
    df = spark.createDataFrame([(1, "a b"), (1, "it's"), (1, None), (2, "x-(y)")], "k int, v string")
    vocab = serve.vocabulary(df, ["v"])
    out = df.groupBy("k").agg(*serve.indicator_columns(vocab))
    assert set(out.columns) == {"k", "v_separator_a_space1_b", "v_separator_it's",
                                "v_separator_x_space2__space3_y_space4_"}
    with pytest.raises(ValueError):
        serve.indicator_columns({"v": ["a b", "a_space1_b"]})
    with pytest.raises(ValueError):
        serve.vocabulary(df, ["v"], limit=2)


def test_histogram_cap_keeps_most_frequent(spark):
    data = [(1, v) for v in ["a"] * 3 + ["b"] * 2 + ["c"] * 2 + [""] * 5 + [None]]
    df = spark.createDataFrame(data, "k int, v string")
    assert serve.histogram_json(df, "k", ["v"], cap=3).first()["v"] == '{"Unknown":5,"a":3,"b":2}'
    assert serve.histogram_json(df, "k", ["v"], None, "Unknown").first()["v"] == \
        '{"Unknown":6,"a":3,"b":2,"c":2}'


def test_timeline_cap_and_order(spark):
    df = spark.range(1000).select(F.lit(1).alias("k"), F.col("id"),
                                  F.format_string("%05d", "id").alias("d"))
    out = serve.timeline_json(df, "k", {"id": F.col("id")}, "d", ["id"], 250).first()["Details"]
    import json
    line = json.loads(out)
    assert list(line) == [str(i) for i in range(250)]
    assert line["0"] == {"id": "999"} and line["249"] == {"id": "750"}


def test_frequent_keys_equals_heavy_keys(spark, monkeypatch):
    # a third of the rows null, some frequent keys, all others once
    df = spark.range(60_000).select(
        F.when(F.col("id") % 3 == 0, None).when(F.col("id") % 3 == 1, F.col("id") % 70)
        .otherwise(-F.col("id")).alias("k"), (F.col("id") % 2).alias("j"))
    want = rows(joins.heavy_keys(df, ["k", "j"], 20))
    slow = []
    whole = joins.heavy_keys
    monkeypatch.setattr(joins, "heavy_keys", lambda *a: slow.append(a) or whole(*a))
    assert rows(joins.frequent_keys(df, ["k", "j"], 20)) == want
    assert len(slow) == 1                               # candidates only
    assert rows(joins.frequent_keys(df, ["k", "j"], 500, min_rows=100)) == \
        rows(whole(df, ["k", "j"], 500, 100))
    assert len(slow) == 2
    # the 200th key is one of many single rows: no sketch can tell
    assert rows(joins.frequent_keys(df, ["k", "j"], 200)) == rows(whole(df, ["k", "j"], 200))
    assert len(slow) == 4
    assert joins.frequent_keys(df.limit(0), "k", 5).count() == 0


def test_milestone_sketches_merge(spark):
    df = spark.range(40_000).select((F.col("id") % 4).alias("day"), (F.col("id") % 9000).alias("who"),
                                    F.when(F.col("id") % 4 == 0, F.col("id")).alias("rare"))
    sketches = serve.milestone_sketches(df, "day", {"people": "who", "rare": "rare"})
    assert sketches.count() == 4
    one = serve.milestones_of(sketches, ["people", "rare"]).first()
    assert abs(one["people"] - 9000) < 9000 * 0.03 and abs(one["rare"] - 10_000) < 10_000 * 0.03
    by_day = {r["day"]: r["rare"] for r in serve.milestones_of(sketches, ["rare"], "day").collect()}
    assert by_day[1] == by_day[2] == by_day[3] == 0 and by_day[0] == one["rare"]


def test_parts_join_to_the_whole_text(spark):
    # a third of the rows in one key, another under null; dates tie and are null
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.col("id"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 100).cast("string")).alias("d"),
        (F.col("id") % 400).cast("string").alias("v"))
    fields = {"id": F.col("id"), "d": F.col("d")}

    def whole(parts, keys, name):
        texts = {}
        for r in parts.orderBy("part").collect():
            key = tuple(r[k] for k in keys)
            assert r["part"] == len(texts.setdefault(key, []))
            texts[key].append((r["n_parts"], r[name]))
        assert all(n == len(t) for t in texts.values() for n, _ in t)
        return {k: "".join(x for _, x in t) for k, t in texts.items()}

    line = serve.timeline_parts(df, "k", fields, "d", ["id"], per_part=30, slices=16)
    want = serve.timeline_json(df, "k", fields, "d", ["id"], None)
    assert whole(line, ["k"], "Details") == {(r["k"],): r["Details"] for r in want.collect()}
    ranked = serve.rank_in_slices(df, "k", [F.col("id")], 16)
    assert ranked.filter("k = 'hot'").agg(F.max("row_num"), F.max("n_rows")).first()[:] == (1000, 1000)

    parts = serve.histogram_parts(df, "k", ["v", "d"], per_part=30, slices=16)
    want = serve.histogram_json(df, "k", ["v", "d"])
    assert whole(parts, ["k", "column"], "json") == {
        (r["k"], c): r[c] for r in want.collect() for c in ("v", "d")}
    assert serve.timeline_parts(df.limit(0), "k", fields, "d", ["id"]).count() == 0


def _join_depth(plan):
    below = max([0] + [_join_depth(plan.children().apply(i)) for i in range(plan.children().size())])
    return below + (plan.nodeName() == "Join")


def test_merge_dimensions_in_pairs(spark):
    """Eight dimensions with null and repeated keys: left joins one by one, but three joins deep."""
    dims = [(spark.createDataFrame([(k, f"{i}{k}{n}") for k in (1, 2, None) for n in range(1 + (i + (k or 0)) % 2)]
                                   + [(10 + i, "own")], f"k{i} int, v{i} string").filter(f"k{i} <=> null or k{i} != {i % 3}"),
             f"k{i}") for i in range(8)]
    merged = joins.merge_dimensions(dims, "key")
    assert _join_depth(merged._jdf.queryExecution().optimizedPlan()) == 3
    want = spark.createDataFrame([(k,) for k in [None, 1, 2, *range(10, 18)]], "key int")
    for dim, own in dims:
        want = want.join(dim, want["key"].eqNullSafe(dim[own]), "left")
    columns = ["key", *[f"v{i}" for i in range(8)]]
    assert rows(merged.select(columns)) == rows(want.select(columns))


def test_whole_rows_move_once(spark):
    """An order that holds the whole row is the row: no second copy beside it."""
    df = spark.createDataFrame([(1, "b", 2), (1, "a", 9), (1, "a", 3), (1, None, 5), (2, None, None), (None, "x", 1)],
                               "k int, a string, b int")
    first, last = (shape.dedup_by_key(df, "k", ["b"], descending=d) for d in (False, True))
    folded = shape.fold_rows(df, "k", "a", ["b", "k"])
    for out in (first, last, folded):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "min_by" not in plan and "max_by" not in plan
    assert rows(first) == rows(spark.createDataFrame([(1, "b", 2), (2, None, None), (None, "x", 1)], df.schema))
    assert rows(last) == rows(spark.createDataFrame([(1, "a", 9), (2, None, None), (None, "x", 1)], df.schema))
