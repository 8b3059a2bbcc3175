import math
import random

from starflow.operators.profiles import merge_states, null_trend, profile_state, read_profile

SCHEMA = "n double, label string"


def rows(seed, count):
    rnd = random.Random(seed)
    return [(None if i % 10 == seed else rnd.random() * 1000, f"v{rnd.randrange(3000)}") for i in range(count)]


def report(states):
    return {r["column"]: r for r in read_profile(merge_states(states)).collect()}


def test_merged_profile_is_that_of_all_rows(spark):
    one, two = rows(1, 4000), rows(2, 6000)
    frames = [spark.createDataFrame(r, SCHEMA) for r in (one, two)]
    states = profile_state(frames[0], 1).unionByName(profile_state(frames[1], 2))
    merged, whole = report(states), report(profile_state(frames[0].union(frames[1]), 0))
    for column in ("n", "label"):
        exact = [c for c in merged[column].asDict() if c not in ("distinct_values", "quantiles")]
        assert {c: merged[column][c] for c in exact} == {c: whole[column][c] for c in exact}
        distinct = len({r[column == "label"] for r in one + two} - {None})
        assert abs(merged[column]["distinct_values"] - distinct) <= 0.07 * distinct
    assert merged["n"]["null_count"] == 1000 and merged["n"]["breach"] and not merged["label"]["breach"]
    values = sorted(r[0] for r in one + two if r[0] is not None)
    for q, value in zip((0.25, 0.5, 0.75), merged["n"]["quantiles"]):
        rank = sum(v <= value for v in values) / len(values)
        assert abs(rank - q) <= 0.04
    assert merged["label"]["quantiles"] is None


def test_odd_batches(spark):
    empty = spark.createDataFrame([], SCHEMA)
    nothing = spark.createDataFrame([(None, None)] * 3 + [(math.nan, "")], SCHEMA)
    found = report(profile_state(empty, "a"))
    assert (found["n"]["rows"], found["n"]["null_pct"], found["n"]["min_number"]) == (0, 0.0, None)
    assert found["n"]["distinct_values"] == 0 and found["n"]["quantiles"] is None
    found = report(profile_state(empty, "a").unionByName(profile_state(nothing, "b")))
    assert (found["n"]["rows"], found["n"]["null_count"], found["n"]["quantiles"]) == (4, 3, None)
    assert found["label"]["min_length"] == 0


def test_clashing_names(spark):
    df = spark.createDataFrame([(1, None)], "`rows` int, `a.b column` string")
    assert {r["column"]: r["null_count"] for r in profile_state(df, 1).collect()} == {"rows": 0, "a.b column": 1}


def test_trend_marks_a_rise(spark):
    def batch(nulls):
        return spark.createDataFrame([(None, "x")] * nulls + [(1.0, "x")] * (100 - nulls), SCHEMA)

    states = [profile_state(batch(n), i) for i, n in enumerate((1, 2, 4, 9))]
    all_states = states[0].unionByName(states[1]).unionByName(states[2]).unionByName(states[3])
    trend = null_trend(all_states, max_null_pct=5.0, max_rise=1.0).where("column = 'n'").orderBy("batch")
    found = [(r["null_pct"], r["null_pct_before"], r["alarm"]) for r in trend.collect()]
    assert found == [(1.0, None, False), (2.0, 1.0, False), (4.0, 2.0, True), (9.0, 4.0, True)]
