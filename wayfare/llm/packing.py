"""Best-fit packing of token pieces into sequences of bounded length.

Documents become token ids with an end id; those longer than a sequence are cut
into full pieces, the first one taking the remainder. A configuration linear
program over the histogram of lengths (``configurations``) says which lengths
share a sequence; pieces then take the slots of their length by rank.

Results in odd cases: a null or empty text is one piece with the end id alone;
an empty table packs into nothing; repeated rows are packed as often as they
stand there; extra columns are not looked at.
"""

from __future__ import annotations

from zlib import crc32

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wayfare.llm.common import arrow_map, saved, table
from wayfare.llm.configurations import Configuration, solve
from wayfare.llm.tokens import encoder

CAPACITY = 1024
END_ID = 2
#: Pieces of texts that a worker's encoder keeps; workers of the pipeline hold memory of the stages before as well.
KEPT_PIECES = 600_000
PIECE = {"doc_id": "long", "piece": "int", "start": "long", "length": "long", "ids_crc32": "long"}


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens; only the first may be shorter than the capacity."""
    if n <= capacity:
        return [(0, n)]
    first = n % capacity or capacity
    return [(0, first), *((s, capacity) for s in range(first, n, capacity))]


def pieces(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
           with_ids: bool = False) -> DataFrame:
    """All pieces of all documents; the ids themselves only if asked for."""

    def run(doc_ids, texts):
        out = {c: [] for c in (*PIECE, "ids")}
        for doc_id, ids in zip(doc_ids, encoder(tokenizer, KEPT_PIECES).encode(texts, end_id)):
            ids = ids.astype("<u4")
            for i, (start, length) in enumerate(cuts(len(ids), capacity)):
                part = ids[start:start + length]
                for column, value in zip(out, (doc_id, i, start, length, crc32(part.tobytes()), part.tolist() if with_ids else None)):
                    out[column].append(value)
        return out

    schema = PIECE | ({"ids": "array<int>"} if with_ids else {})
    return arrow_map(docs.select("doc_id", "text"), run, schema, rows=1024)


def _slots(plan: list[tuple[Configuration, int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: the first rank, first sequence, slots a sequence, and first offset of each run of slots."""
    runs: dict[int, list[tuple[int, int, int, int]]] = {}
    ranks: dict[int, int] = {}
    sequence = 0
    for configuration, times in plan:
        offset = 0
        for length, often in configuration:
            runs.setdefault(length, []).append((ranks.get(length, 0), sequence, often, offset))
            ranks[length] = ranks.get(length, 0) + often * times
            offset += length * often
        sequence += times
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows)) for length, rows in runs.items()}


def place(parts: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``parts`` (with a length column) with sequence_id and offset.

    The histogram has at most ``capacity`` entries and alone goes to the
    driver. The rank of a piece among those of its length is its number in a
    salted share of them plus the sizes of the shares before, so that a length
    which most pieces have is not ranked in one task.
    """
    spark = parts.sparkSession
    # As many shares of a length as there are shuffle partitions; the result does not depend on it but for numbering.
    shares = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    names = list(parts.columns)
    keyed = parts.withColumn("__share", F.pmod(F.xxhash64(*names), F.lit(shares)))
    sizes = saved(keyed.groupBy("length", "__share").agg(F.count("*").alias("__n")), "shares")
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("__n").alias("n")).collect()}
    slots = _slots(solve(counts, capacity))
    before = Window.partitionBy("length").orderBy("__share").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("length", "__share", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("length", "__share").orderBy(*(F.col(c) for c in names))
    ranked = keyed.withColumn("__rank", F.row_number().over(inside).cast("long")).join(sizes, ["length", "__share"])
    ranked = ranked.select(*names, (F.col("__rank") - 1 + F.col("__before")).alias("__rank"))
    at_length, at_rank = names.index("length"), len(names)

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            length, rank = (np.asarray(batch.column(i)) for i in (at_length, at_rank))
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for n in np.unique(length):
                rows = np.flatnonzero(length == n)
                first, base, often, start = slots[int(n)]
                k = np.searchsorted(first, rank[rows], side="right") - 1
                inner = rank[rows] - first[k]
                sequence[rows] = base[k] + inner // often[k]
                offset[rows] = start[k] + inner % often[k] * n
            columns = [*batch.columns[:at_rank], pa.array(sequence), pa.array(offset)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parts.schema)
    return ranked.mapInArrow(run, f"{schema}, sequence_id long, offset long")


def pack(docs: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, tokenizer: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their places."""
    return place(saved(pieces(docs, capacity, end_id, tokenizer, with_ids), "pieces"), capacity)


def op2_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))
