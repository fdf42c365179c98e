"""Token files: whole texts as ids in ascending document order, in patched frame-of-reference files.

Documents are dealt by ranges of their id; each task writes the files of its
range into the shared folder, a few million ids each, under a name that a retry
of the task writes again. The files are read back by Spark's binary reader.

Results in odd cases: null ids come first; equal ids stand in order of their
text; a null or empty text is its end id alone; an empty table writes no file
and reads back no row; extra columns are not looked at.
"""

from __future__ import annotations

import uuid
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wayfare.llm.common import saved, slices, table
from wayfare.llm.frames import BLOCK, PERCENTILE, TokenFile, write_file
from wayfare.llm.tokens import encoder
from wayfare.session import scratch_path

END_ID = 0
#: A file is closed once it holds this many ids; a single longer document has a file of its own.
FILE_IDS = 2_000_000
SUFFIX = ".tpf"


def _put(folder: str, name: str, data: bytes) -> None:
    """Write under a name of this attempt, then rename: readers see whole files only."""
    from pyarrow import fs

    store, base = fs.FileSystem.from_uri(folder)
    store.create_dir(base, recursive=True)
    own = f"{base}/_{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(own) as out:
        out.write(data)
    store.move(own, f"{base}/{name}")


def write(docs: DataFrame, folder: str, end_id: int = END_ID, tokenizer: str | None = None, file_ids: int = FILE_IDS,
          block: int = BLOCK, percentile: int = PERCENTILE) -> DataFrame:
    """Write the files below ``folder``; returns their list (part, number, file, n_docs, n_ids), in order of both."""
    dealt = docs.select("doc_id", "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first())
    schema = pa.schema([("part", pa.int64()), ("number", pa.int64()), ("file", pa.string()), ("n_docs", pa.int64()), ("n_ids", pa.int64())])

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        names: list[int | None] = []
        each: list[np.ndarray] = []
        held = 0

        def close():
            name = f"part-{part:06d}-{number:06d}{SUFFIX}"
            _put(folder, name, write_file(names, each, block, percentile))
            return pa.RecordBatch.from_pydict(
                {"part": [part], "number": [number], "file": [name], "n_docs": [len(each)], "n_ids": [held]}, schema=schema)

        for batch in slices(batches, 1024):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encoder(tokenizer).encode(batch.column(1).to_pylist(), end_id)):
                if held and held + len(ids) > file_ids:
                    yield close()
                    number, names, each, held = number + 1, [], [], 0
                names.append(doc_id)
                each.append(ids)
                held += len(ids)
        if held:
            yield close()

    return saved(dealt.mapInArrow(run, "part long, number long, file string, n_docs long, n_ids long"), "token-files")


def read(spark: SparkSession, folder: str, listed: DataFrame, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document, from the files; start counts over all files."""
    inside = Window.partitionBy("part").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    parts = listed.groupBy("part").agg(F.sum("n_ids").alias("__n"))  # a row per writing task
    over = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("__n").over(over), F.lit(0)).alias("__part"))
    base = listed.withColumn("__in", F.coalesce(F.sum("n_ids").over(inside), F.lit(0))).join(parts, "part").select(
        "file", (F.col("__in") + F.col("__part")).alias("__base"))

    def run(batches):
        for batch in slices(batches, 1):
            name, data = batch.column(0)[0].as_py(), batch.column(1)[0].as_py()
            rows = [(name, d, s, len(ids), crc32(ids.astype("<u4").tobytes()), ids.tolist() if with_ids else None)
                    for d, s, ids in TokenFile(data).documents()]
            columns = list(zip(*rows)) or [[]] * 6
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
            names = ("file", "doc_id", "__start", "n_tokens", "ids_crc32", "ids")
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)][:5 + with_ids], names=names[:5 + with_ids])

    if listed.isEmpty():
        files = spark.createDataFrame([], "path string, content binary")
    else:
        files = spark.read.format("binaryFile").option("pathGlobFilter", f"*{SUFFIX}").load(folder).select("path", "content")
    found = files.select(F.element_at(F.split("path", "/"), -1), "content").mapInArrow(
        run, "file string, doc_id long, __start long, n_tokens long, ids_crc32 long" + ", ids array<int>" * with_ids)
    return found.join(base, "file").select(
        "doc_id", (F.col("__base") + F.col("__start")).alias("start"), "n_tokens", "ids_crc32", *["ids"] * with_ids)


def op6_token_files(spark, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "tokens")
    return read(spark, folder, write(table(spark, sf_dir, "documents"), folder))
