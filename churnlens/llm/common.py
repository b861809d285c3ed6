"""Helpers shared by the operators: tables, shared folder, Arrow batches, sums of arrays."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text handed to one numpy step; long texts are never cut, a single one may exceed it.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    A local folder is made only where none is named and the master is
    ``local[...]``, as in tests; elsewhere a missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("spark.checkpoint.dir names no folder that the executors share")
    made = tempfile.mkdtemp(prefix="churnlens-llm-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Cuts the lineage: a lost executor costs only the tasks that it ran, and
    later passes read the same rows.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    with shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Spark's setting to remove a query's shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Queries made here leave no shuffle files behind; the session keeps its setting.

    Spark else removes them when the driver happens to collect its garbage, so the
    files of all steps would lie on the disks at once.
    """
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


class Growing:
    """A table in the shared folder to which several steps add rows of the schema of ``empty``."""

    def __init__(self, empty: DataFrame, name: str):
        self.spark, self.schema = empty.sparkSession, empty.schema
        self.path = f"{shared_dir(self.spark)}/llm/{name}-{uuid.uuid4().hex}"
        empty.write.parquet(self.path)

    def add(self, rows: DataFrame) -> None:
        with shuffles_removed(self.spark):
            rows.select(*self.schema.names).write.mode("append").parquet(self.path)

    def table(self) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.path)


def row_key(id_col: str, text_col: str) -> Column:
    """``struct<id, sign>``: names a row by its id and a hash of its text.

    Ids may be null or repeated; rows with the same id and the same text are
    copies that every operator treats alike.
    """
    return F.struct(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("sign"))


def key_kind(docs: DataFrame, id_col: str) -> str:
    """The type of ``row_key`` in a schema string."""
    return f"struct<id:{docs.schema[id_col].dataType.simpleString()},sign:bigint>"


def same_row(id_col: str, text_col: str, id_: Column, sign: Column) -> Column:
    """A join condition: the row of a document that the key names."""
    return F.col(f"`{id_col}`").eqNullSafe(id_) & (F.xxhash64(F.col(f"`{text_col}`").cast("string")) == sign)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches by rows so that the texts of one piece stay near ``most`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        size = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            done = size[at - 1] if at else 0
            to = max(at + 1, int(np.searchsorted(size, done + most, "right")))
            yield batch.slice(at, to - at)
            at = to


def words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of each text (null: none).

    Returns the code of every word in order, the number of words of each text,
    and the distinct words by code.
    """
    texts = pc.fill_null(texts, "")
    if lower:
        texts = pc.ascii_lower(texts)
    parts = pc.ascii_split_whitespace(texts)
    flat = parts.flatten()
    if isinstance(flat, pa.ChunkedArray):
        flat = flat.combine_chunks()
    coded = flat.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    known = coded.dictionary.to_pylist()
    n = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    if "" in known:
        drop = codes == known.index("")
        owner = np.repeat(np.arange(len(n)), n)
        n = n - np.bincount(owner[drop], minlength=len(n))
        codes = codes[~drop]
    return codes, n, known


def text_batch(schema: pa.Schema, **columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], (pa.Array, pa.ChunkedArray)) else columns[f.name].cast(f.type) for f in schema], schema=schema)


def summed(df: DataFrame, chunks: int) -> dict[tuple[int, int], np.ndarray]:
    """Add up arrays that tasks have gathered: rows ``(kind int, chunk int, payload binary)``.

    Each payload is a zlib-compressed int64 array; arrays with the same
    ``(kind, chunk)`` are added.  Rows are dealt by chunk and added one batch
    after another, so a task holds one array per key whatever the number of
    rows.  The caller bounds the number and the length of the arrays, and so
    what reaches the driver.
    """

    def add(batches):
        total: dict[tuple[int, int], np.ndarray] = {}
        for b in batches:
            for kind, chunk, payload in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                x = np.frombuffer(zlib.decompress(payload), dtype=np.int64)
                total[kind, chunk] = total[kind, chunk] + x if (kind, chunk) in total else x
        if total:
            yield pa.RecordBatch.from_pydict({"kind": pa.array([k for k, _ in total], pa.int32()), "chunk": pa.array([c for _, c in total], pa.int32()), "payload": pa.array([zlib.compress(x.tobytes(), 1) for x in total.values()], pa.binary())})

    with shuffles_removed(df.sparkSession):
        rows = df.repartition(chunks, "chunk").mapInArrow(add, df.schema).collect()
    return {(r["kind"], r["chunk"]): np.frombuffer(zlib.decompress(bytes(r["payload"])), dtype=np.int64) for r in rows}


def payloads(kind: int, x: np.ndarray, chunks: int) -> Iterator[pa.RecordBatch]:
    """The rows for ``summed`` of one long array, without its empty chunks."""
    for c, part in enumerate(np.array_split(x.astype(np.int64), chunks)):
        if part.any():
            yield pa.RecordBatch.from_pydict({"kind": pa.array([kind], pa.int32()), "chunk": pa.array([c], pa.int32()), "payload": pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())})


PAYLOAD = "kind int, chunk int, payload binary"


def joined(sums: dict[tuple[int, int], np.ndarray], kind: int, length: int, chunks: int) -> np.ndarray:
    """The whole array of a kind; chunks that no task has sent are zero."""
    sizes = [len(p) for p in np.array_split(np.zeros(length, np.int8), chunks)]
    return np.concatenate([sums.get((kind, c), np.zeros(s, np.int64)) for c, s in enumerate(sizes)])


def connected(edges: DataFrame, name: str = "cc") -> DataFrame:
    """Connected components of the undirected ``edges(a long, b long)``.

    Returns ``(node, root)`` for every node of an edge; the root is the
    smallest node of its component.  Smallest labels spread over the edges and
    are then replaced by their own labels (pointer jumping), so the number of
    rounds grows with the logarithm of a component's width.  Each round is
    written to the shared folder; only a count reaches the driver.
    """
    both = stored(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct(), f"{name}-edges")
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), f"{name}-labels")
    while True:
        heard = both.join(labels.withColumnRenamed("node", "a"), "a").groupBy(F.col("b").alias("node")).agg(F.min("root").alias("heard"))
        near = labels.join(heard, "node").select("node", F.col("root").alias("old"), F.least("root", "heard").alias("root"))
        far = labels.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = stored(near.join(far, "root").select("node", F.least("root", "further").alias("root"), F.col("old")), f"{name}-labels")
        if new.where("root <> old").isEmpty():
            return new.select("node", "root")
        labels = new.select("node", "root")
