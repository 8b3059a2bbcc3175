import zlib

import numpy as np
import pytest

from starflow.llm import token_files as tf
from starflow.llm.perfect_hash import PerfectHash
from starflow.llm.tokens import encoder, tokenizer_path


@pytest.mark.parametrize("n", [0, 1, 2, 17, 5000])
def test_perfect_hash_is_minimal_and_survives_storage(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(0, 2**64, n, dtype=np.uint64, endpoint=False))
    function = PerfectHash.build(keys)
    assert sorted(function.slots(keys)) == list(range(len(keys)))
    again, used = PerfectHash.from_bytes(function.to_bytes() + b"more")
    assert used == len(function.to_bytes())
    assert list(again.slots(keys)) == list(function.slots(keys))


def test_keys_that_no_level_settles_are_kept_apart(monkeypatch):
    monkeypatch.setattr("starflow.llm.perfect_hash._MOST_LEVELS", 1)
    keys = np.arange(1, 500, dtype=np.uint64) * np.uint64(7919)
    function = PerfectHash.build(keys)
    assert len(function.rest) and sorted(function.slots(keys)) == list(range(len(keys)))


def brute(rows, end=2):
    encode = encoder(tokenizer_path()).encode
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out, start = [], 0
    for i, t, _ in order:
        ids = encode(t or "") + end.to_bytes(4, "little")
        out.append((i, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


CASES = {
    "empty table": [],
    "nulls": [(2, None, "s"), (1, "", "s"), (None, "a b", "s")],
    "long": [(1, "one two three. " * 20_000, "s"), (0, "four", "s")],
    "many": [(i * 7 % 401, f"text {i} " * (i % 30), "s") for i in range(401)],
}


@pytest.mark.parametrize("name", CASES)
def test_report_reads_back_what_was_written(documents, name):
    got = tf.token_file_report(documents(CASES[name]).repartition(4)).collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted(map(tuple, got), key=key) == brute(CASES[name])


def test_repeated_ids_are_all_there(documents):
    rows = [(5, "a b", "s"), (5, "a b", "s"), (5, "c", "s"), (6, "d", "s")]
    got = sorted(tuple(r) for r in tf.token_file_report(documents(rows)).collect())
    assert sorted((i, n, c) for i, _, n, c in got) == sorted((i, n, c) for i, _, n, c in brute(rows))
    starts = sorted((s, n) for _, s, n, _ in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:])) and starts[0][0] == 0


def test_keyed_access_returns_ids_and_notices_foreign_keys(spark, documents, workspace, tmp_path):
    rows = CASES["many"]
    folder = str(tmp_path / "ids")
    directory = tf.write_token_files(documents(rows), folder, workspace=workspace)
    parts = directory.select("shard").distinct().count()
    keys = spark.createDataFrame([(3, 0), (400, 0), (99_999, 0), (3, 1), (None, 0)], "id bigint, repeat int")
    found = tf.look_up(keys, folder, parts)
    known = {(r["id"], r["repeat"]): r["shard"] is not None for r in found.collect()}
    assert known == {(3, 0): True, (400, 0): True, (99_999, 0): False, (3, 1): False, (None, 0): False}
    encode = encoder(tokenizer_path()).encode
    texts = {i: t for i, t, _ in rows}
    for r in tf.read_documents(found, folder, with_ids=True).collect():
        assert bytes(r["ids"]) == encode(texts[r["id"]]) + (2).to_bytes(4, "little")


def test_a_repeated_task_replaces_its_file(documents, workspace, tmp_path):
    rows = CASES["many"]
    folder = tmp_path / "ids"
    tf.write_token_files(documents(rows), str(folder), workspace=workspace)
    first = {p.name: p.read_bytes() for p in folder.iterdir()}
    tf.write_token_files(documents(rows), str(folder), workspace=workspace)
    assert {p.name: p.read_bytes() for p in folder.iterdir()} == first
    assert all(n.endswith((".ids", ".mph")) for n in first)


def test_four_bytes_per_id(documents, workspace, tmp_path):
    rows = CASES["nulls"]
    folder = str(tmp_path / "ids")
    directory = tf.write_token_files(documents(rows), folder, id_bytes=4, workspace=workspace)
    found = tf.look_up(directory, folder, directory.select("shard").distinct().count())
    got = {r["id"]: r["ids_crc32"] for r in tf.read_documents(found, folder).collect()}
    assert got == {i: c for i, _, _, c in brute(rows)}
