import random
from datetime import date, datetime, timedelta

import pytest

from starflow.operators import history
from starflow.operators.history import HistorySpec, attach_as_of, build_history

SPEC = HistorySpec("dim", "dim_key", ("id",), ("color", "size"), "at")
SCHEMA = "id string, color string, size int, at int, other string"


def brute_history(rows):
    """{id: [(from, to, color, size)]} by walking through the sorted states."""
    states = {}
    for i, color, size, at, _ in rows:
        if at is not None:
            states.setdefault(i, {}).setdefault(at, []).append((color, size))
    out = {}
    for i, by_time in states.items():
        versions = []
        for at in sorted(by_time):
            state = tuple(min((s[k] for s in by_time[at] if s[k] is not None), default=None) for k in (0, 1))
            if not versions or versions[-1][1] != state:
                versions.append((at, state))
        ends = [v[0] for v in versions[1:]] + [None]
        out[i] = [(at, end, *state) for (at, state), end in zip(versions, ends)]
    return out


def rows_of(df):
    out = {}
    for r in df.orderBy("version").collect():
        assert r["is_current"] == (r["valid_to"] is None)
        out.setdefault(r["id"], []).append((r["valid_from"], r["valid_to"], r["color"], r["size"]))
    return out


def observations(rnd, n, members, times=30):
    return [
        (rnd.choice(members), rnd.choice(["red", "blue", None]), rnd.choice([1, None]), rnd.choice([*range(times), None]), "x")
        for _ in range(n)
    ]


@pytest.mark.parametrize("stretches, hot", [(256, 10_000), (5, 3)])
def test_versions(spark, workspace, monkeypatch, stretches, hot):
    monkeypatch.setattr(history, "STRETCHES", stretches)
    monkeypatch.setattr(history.stretches, "__defaults__", (hot,))
    rows = observations(random.Random(1), 400, ["a", "a", "a", "b", "c", None])
    rows += rows[:50] + [("one", "red", 1, 5, "x")]
    df = build_history(spark.createDataFrame(rows, SCHEMA), SPEC, workspace)
    assert df.columns == SPEC.columns
    assert rows_of(df) == brute_history(rows)
    keys = [r["dim_key"] for r in df.collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
    # Neither gaps nor overlaps: every version starts where the one before it ends.
    for versions in rows_of(df).values():
        assert all(a[1] == b[0] and a[0] < a[1] for a, b in zip(versions, versions[1:]))


def test_keys_do_not_depend_on_the_layout(spark, workspace):
    rows = observations(random.Random(2), 300, list("abcdef"))
    df = spark.createDataFrame(rows, SCHEMA)
    one = build_history(df.repartition(1), SPEC, workspace).collect()
    many = build_history(df.repartition(13, "other", "at"), SPEC, workspace).collect()
    assert sorted(one, key=str) == sorted(many, key=str)


def test_empty_and_times(spark, workspace):
    empty = spark.createDataFrame([], SCHEMA)
    assert build_history(empty, SPEC, workspace).collect() == []
    dated = [("a", "red", 1, date(2024, 1, d), "x") for d in (1, 2, 5)] + [("a", "blue", 1, date(2024, 1, 3), "x")]
    df = spark.createDataFrame(dated, SCHEMA.replace("at int", "at date"))
    assert [r[0].day for r in rows_of(build_history(df, SPEC, workspace))["a"]] == [1, 3, 5]


def brute_as_of(rows, versions):
    out = []
    for i, at, note in rows:
        found = [v for v in versions if v[0] == i and at is not None and v[1] <= at]
        out.append((i, at, note, *(max(found, key=lambda v: v[1])[2:] if found else (None, None))))
    return sorted(out, key=str)


@pytest.mark.parametrize("stretches, hot", [(256, 10_000), (7, 4), (1, 2)])
def test_as_of(spark, workspace, monkeypatch, stretches, hot):
    monkeypatch.setattr(history, "STRETCHES", stretches)
    rnd = random.Random(3)
    members = ["hot"] * 6 + ["a", "b", "c", None]
    rows = [(rnd.choice(members), rnd.choice([*range(-5, 100), None]), str(rnd.randrange(3))) for _ in range(800)]
    rows += rows[:100] + [("none", 3, "n")]
    starts = {(rnd.choice(members), rnd.randrange(100)) for _ in range(60)}
    versions = [(i, at, k, None if k % 5 == 0 else f"v{k}") for k, (i, at) in enumerate(sorted(starts, key=str))]
    df = spark.createDataFrame(rows, "id string, at int, note string")
    known = spark.createDataFrame(versions, "id string, valid_from int, ver int, label string")
    got = attach_as_of(df, known, ["id"], "at", ["ver", "label"], hot_keys=hot, workspace=workspace)
    assert got.columns == ["id", "at", "note", "ver", "label"]
    assert sorted(map(tuple, got.collect()), key=str) == brute_as_of(rows, versions)


def test_as_of_nothing(spark, workspace):
    df = spark.createDataFrame([("a", 1, "x")], "id string, at int, note string")
    known = spark.createDataFrame([], "id string, valid_from int, ver int")
    assert attach_as_of(df, known, ["id"], "at", ["ver"], workspace=workspace).first()["ver"] is None
    assert attach_as_of(df.limit(0), known, ["id"], "at", ["ver"], workspace=workspace).collect() == []
    with pytest.raises(ValueError, match="not found"):
        attach_as_of(df, known, ["id"], "when", ["ver"], workspace=workspace)


@pytest.mark.parametrize("same_time", [False, True])
def test_no_task_gets_a_hot_member(spark, workspace, same_time):
    """Two thirds of 60,000 rows on one member: its rows are dealt over many groups."""
    start = datetime(2024, 1, 1)
    rows = spark.range(60_000).selectExpr(
        "if(id % 3 < 2, 'hot', concat('m', id % 500)) AS id",
        f"timestamp '2024-01-01' + make_interval(0, 0, 0, 0, 0, 0, {'7' if same_time else 'id'}) AS at", "id AS note",
    )
    versions = [("hot", start + timedelta(seconds=s), s) for s in range(0, 60_000, 600)]
    known = spark.createDataFrame(versions, "id string, valid_from timestamp, ver int")
    got = attach_as_of(rows, known, ["id"], "at", ["ver"], workspace=workspace)
    late = got.where("id = 'hot' AND ver <> floor((unix_seconds(at) - unix_seconds(timestamp '2024-01-01')) / 600) * 600")
    assert got.count() == 60_000 and late.isEmpty()
    bounds = history._bounds(rows, ["id"], "at", workspace, 10_000)
    dealt = history._in_stretch(rows, bounds, ["id"], "at", "_stretch").selectExpr(
        "id", "_stretch", "pmod(xxhash64(id, at, note), _salts) AS salt"
    )
    largest = dealt.groupBy("id", "_stretch", "salt").count().agg({"count": "max"}).first()[0]
    assert largest < 60_000 / 40
