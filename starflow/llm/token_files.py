"""Token-id files with a minimal perfect hash index.

``shard-00000.ids`` holds nothing but the ids of its documents, in ascending id order over all
shards, as little-endian unsigned numbers of 2 bytes (4 if the vocabulary needs it), and a
footer of 32 bytes (magic, bytes per id, documents, ids). A task writes the shard of its range of
ids under a name of its own and renames it when it is whole, so a repeated task only
replaces a file by the same file.

``index-00000.mph`` covers the document keys of one hash part: a minimal perfect hash gives a
key's slot, and the slot holds a fingerprint of the key (so that a foreign key is noticed), the
shard, the position there and the number of ids. A look-up therefore opens one index part
and reads one stretch of one shard, however many documents there are.

The key of a document is its id and, since ids may repeat, its place among equal ids (0 as a
rule). Ids that repeat are in one shard, in the order of their texts' hashes.

Defined results: NULL text is empty; NULL ids come first and are a key of their own. An empty
table writes no files and reads back as an empty table. Other columns are ignored.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starflow.llm.perfect_hash import PerfectHash
from starflow.llm.rows import pick, slices
from starflow.llm.tokens import encoder, tokenizer_path
from starflow.sources.workspace import Workspace

END_ID = 2
READ_BYTES = 1024 * 1024  # neighbouring documents are read together up to this size
_MAGIC = b"IDSHARD1"
_FOOTER = 32
_SLOT = np.dtype([("mark", "<u4"), ("shard", "<u4"), ("at", "<u8"), ("n", "<u4")])


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path, local or any that Arrow knows."""
    return fs.FileSystem.from_uri(uri)


def _publish(store: fs.FileSystem, part: str, path: str) -> None:
    """Give a finished file its name; a file of an earlier attempt is replaced."""
    if store.get_file_info(path).type != fs.FileType.NotFound and store.type_name != "local":
        store.delete_file(path)
    store.move(part, path)


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/shard-{shard:05d}.ids"


def index_path(folder: str, part: int) -> str:
    return f"{folder}/index-{part:05d}.mph"


def key_hash(doc_id, repeat: int) -> int:
    return xxhash.xxh64_intdigest(f"{doc_id}#{repeat}".encode(), 1)


def key_mark(doc_id, repeat: int) -> int:
    """The stored fingerprint, independent of ``key_hash``."""
    return xxhash.xxh32_intdigest(f"{doc_id}#{repeat}".encode(), 2)


def write_token_files(
    docs: DataFrame,
    folder: str,
    doc_id: str = "doc_id",
    text: str = "text",
    *,
    end_id: int = END_ID,
    id_bytes: int = 2,
    tokenizer: str | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Write shards and index; returns their directory, one row per document.

    The directory (id, repeat, hash, mark, shard, at, n) is narrow; ids themselves go to the
    files only.
    """
    spark = docs.sparkSession
    workspace = workspace or Workspace(spark)
    path = tokenizer or tokenizer_path()
    rows = pick(docs, id=doc_id, text=text)
    kind = rows.schema["id"].dataType.simpleString()
    ranged = rows.repartitionByRange(F.col("id").asc_nulls_first()).sortWithinPartitions(
        F.col("id").asc_nulls_first(), F.xxhash64("text")
    )
    end = end_id.to_bytes(id_bytes, "little")
    schema = f"id {kind}, repeat int, hash bigint, mark bigint, shard int, at bigint, n bigint"

    def write(batches) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        encode = encoder(path).encode
        store, target = _open(shard_path(folder, shard))
        part = f"{target}.{uuid.uuid4().hex}"
        out, at, count, last, repeat = None, 0, 0, (), 0
        for batch in slices(batches):
            if out is None:
                store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                out = store.open_output_stream(part)
            repeats, starts, sizes = [], [], []
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(content or "")
                if id_bytes == 2:
                    ids = np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()
                out.write(ids + end)
                repeat = repeat + 1 if (name,) == last else 0
                last = (name,)
                n = len(ids) // id_bytes + 1
                repeats.append(repeat)
                starts.append(at)
                sizes.append(n)
                at += n
                count += 1
            hashes, marks = _hashed(batch.column(0).to_pylist(), repeats)
            columns = [
                batch.column(0),
                pa.array(repeats, pa.int32()),
                hashes,
                marks,
                pa.array([shard] * len(sizes), pa.int32()),
                pa.array(starts, pa.int64()),
                pa.array(sizes, pa.int64()),
            ]
            names = ["id", "repeat", "hash", "mark", "shard", "at", "n"]
            yield pa.RecordBatch.from_arrays(columns, names)
        if out is not None:
            out.write(_MAGIC + np.array([id_bytes, count, at], dtype="<u8").tobytes())
            out.close()
            _publish(store, part, target)

    directory = workspace.store(ranged.mapInArrow(write, schema), "directory")
    parts = directory.select("shard").distinct().count()
    _write_index(directory, folder, parts, workspace)
    return directory


def _hashed(ids: list, repeats: list[int]) -> tuple[pa.Array, pa.Array]:
    """Hashes (signed, as Spark has them) and marks of keys."""
    keys = list(zip(ids, repeats))
    hashes = np.array([key_hash(*k) for k in keys], dtype=np.uint64).view(np.int64)
    return pa.array(hashes, pa.int64()), pa.array([key_mark(*k) for k in keys], pa.int64())


def with_hashes(keys: DataFrame) -> DataFrame:
    """(id, repeat) with hash and mark."""
    kind = keys.schema["id"].dataType.simpleString()

    def add(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            both = _hashed(batch.column(0).to_pylist(), batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, *both], ["id", "repeat", "hash", "mark"])

    keys = keys.select("id", F.col("repeat").cast("int").alias("repeat"))
    return keys.mapInArrow(add, f"id {kind}, repeat int, hash bigint, mark bigint")


def _part(parts: int):
    return F.pmod(F.col("hash"), F.lit(parts)).cast("int").alias("part")


def _write_index(directory: DataFrame, folder: str, parts: int, workspace: Workspace) -> None:
    """One index file per part; a part has as many keys as a shard has documents."""
    if not parts:
        return

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        part = key[0].as_py()
        hashes = table["hash"].to_numpy().view(np.uint64)
        function = PerfectHash.build(hashes)
        slots = np.zeros(len(hashes), dtype=_SLOT)
        at = function.slots(hashes)
        for name, column in (("mark", "mark"), ("shard", "shard"), ("at", "at"), ("n", "n")):
            slots[name][at] = table[column].to_numpy()
        store, target = _open(index_path(folder, part))
        mine = f"{target}.{uuid.uuid4().hex}"
        with store.open_output_stream(mine) as out:
            out.write(function.to_bytes() + slots.tobytes())
        _publish(store, mine, target)
        return pa.table({"part": pa.array([part], pa.int32()), "keys": pa.array([len(slots)], pa.int64())})

    built = directory.groupBy(_part(parts)).applyInArrow(build, "part int, keys bigint")
    workspace.store(built, "index")


def look_up(keys: DataFrame, folder: str, parts: int) -> DataFrame:
    """Keyed access: (id, repeat) to (id, repeat, shard, at, n) by the index files.

    Keys that carry hash and mark, as the directory's do, are not hashed again. A key that was never written comes back with NULL, as its fingerprint tells.
    """
    kind = keys.schema["id"].dataType.simpleString()
    schema = f"id {kind}, repeat int, shard int, at bigint, n bigint"
    if not parts:
        return keys.sparkSession.createDataFrame([], schema)

    def find(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        store, path = _open(index_path(folder, key[0].as_py()))
        if store.get_file_info(path).type == fs.FileType.NotFound:
            known, entry = np.zeros(table.num_rows, dtype=bool), np.zeros(table.num_rows, dtype=_SLOT)
        else:
            with store.open_input_file(path) as file:
                data = file.read()
            function, used = PerfectHash.from_bytes(data)
            slots = np.frombuffer(data, dtype=_SLOT, offset=used)
            at = function.slots(table["hash"].to_numpy().view(np.uint64))
            entry = slots[np.maximum(at, 0)]
            known = (at >= 0) & (entry["mark"] == table["mark"].to_numpy())
        return pa.table({
            "id": table["id"],
            "repeat": table["repeat"],
            "shard": pa.array(entry["shard"].astype(np.int32), mask=~known),
            "at": pa.array(entry["at"].astype(np.int64), mask=~known),
            "n": pa.array(entry["n"].astype(np.int64), mask=~known),
        })

    if "hash" not in keys.columns:
        keys = with_hashes(keys)
    return keys.select("id", "repeat", "hash", "mark").groupBy(_part(parts)).applyInArrow(find, schema)


def _shard(folder: str, shard: int):
    """An open shard, its bytes per id, and its counts of documents and ids."""
    store, path = _open(shard_path(folder, shard))
    file = store.open_input_file(path)
    tail = file.read_at(_FOOTER, file.size() - _FOOTER)
    if tail[:8] != _MAGIC:
        raise ValueError(f"not a token-id file: {path}")
    id_bytes, documents, ids = (int(x) for x in np.frombuffer(tail, dtype="<u8", offset=8))
    return file, id_bytes, documents, ids


def shard_starts(shards: DataFrame, folder: str) -> DataFrame:
    """(shard, first): the ids in all shards before it, from the files' own counts.

    One number per shard, so per task that wrote one, reaches the driver.
    """

    def count(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = []
            for shard in batch.column(0).to_pylist():
                file, _, _, n = _shard(folder, shard)
                file.close()
                ids.append(n)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.int64())], ["shard", "ids"])

    before, rows = 0, []
    for shard, ids in sorted(shards.mapInArrow(count, "shard int, ids bigint").collect()):
        rows.append((shard, before))
        before += ids
    return shards.sparkSession.createDataFrame(rows, "shard int, first bigint")


def _stretches(file, starts: list[int], sizes: list[int], id_bytes: int) -> Iterator[bytes]:
    """The raw ids of each document; neighbours in the file are read together."""
    i = 0
    while i < len(starts):
        j, end = i, starts[i]
        while j < len(starts) and starts[j] == end and (end - starts[i]) * id_bytes < READ_BYTES:
            end += sizes[j]
            j += 1
        data = memoryview(file.read_at((end - starts[i]) * id_bytes, starts[i] * id_bytes))
        for k in range(i, j):
            at = (starts[k] - starts[i]) * id_bytes
            yield bytes(data[at : at + sizes[k] * id_bytes])
        i = j


def read_documents(found: DataFrame, folder: str, *, with_ids: bool = False) -> DataFrame:
    """What the shards hold at the places ``look_up`` gave: (id, repeat, shard, at, n, ids_crc32[, ids])."""
    kind = found.schema["id"].dataType.simpleString()
    schema = f"id {kind}, repeat int, shard int, at bigint, n bigint, ids_crc32 bigint"

    def read(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        file, id_bytes, _, _ = _shard(folder, key[0].as_py())
        table = table.sort_by("at")
        crc, ids = [], []
        with file:
            for raw in _stretches(file, table["at"].to_pylist(), table["n"].to_pylist(), id_bytes):
                if id_bytes != 4:
                    raw = np.frombuffer(raw, dtype=f"<u{id_bytes}").astype("<u4").tobytes()
                crc.append(zlib.crc32(raw))
                if with_ids:
                    ids.append(raw)
        table = table.append_column("ids_crc32", pa.array(crc, pa.int64()))
        return table.append_column("ids", pa.array(ids, pa.binary())) if with_ids else table

    known = found.where(F.col("shard").isNotNull())
    return known.groupBy("shard").applyInArrow(read, schema + (", ids binary" if with_ids else ""))


def token_file_report(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Write the files, then read every document back through the index.

    (id, start, n_tokens, ids_crc32): the ids before the document, its ids with the end id.
    """
    spark = docs.sparkSession
    workspace = Workspace(spark)
    folder = workspace.folder("ids")
    directory = write_token_files(docs, folder, doc_id, text, workspace=workspace, **options)
    shards = directory.select("shard").distinct()
    found = look_up(directory, folder, shards.count())
    read = read_documents(found, folder)
    starts = shard_starts(shards, folder)
    return read.join(F.broadcast(starts), "shard").select(
        F.col("id").alias(doc_id),
        (F.col("first") + F.col("at")).alias("start"),
        F.col("n").alias("n_tokens"),
        "ids_crc32",
    )
