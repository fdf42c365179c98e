"""Embedding near-duplicates: spherical-cap filters, joined on, then verified in double precision.

Equal vectors of a label are one class from the start. Classes meet in the
filters they share; filters with the same members count once. A filter with
many members is cut into blocks, and a task meets one pair of blocks, so a
group of near copies is compared in parallel without writing out its pairs.
Each pair is counted at the first filter it shares.

Results in odd cases: vectors that are null, empty, zero, or hold null or
non-finite components, and rows without a label, link with nothing; vectors of
different lengths link with nothing; repeated rows are copies of each other;
rows that share a vec_id count as one vector with the links of all of them; a
row without vec_id has no links, a null component, and is kept; an empty table
gives an empty result. Extra columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import arrow_map, components, in_blocks, runs, saved, table
from wayfare.llm.filters import code_words, decode, height

COSINE = 0.93
#: Members of one block of a filter, about; a task holds two blocks at a time.
BLOCK = 256


def unit(rows) -> np.ndarray:
    x = np.array(rows, np.float64)
    x /= np.abs(x).max(axis=1, keepdims=True)  # so that no square leaves the range of numbers
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def compare(reps, many, vectors, lists, at, sides, cosine):
    """Links within one filter, or across two of its blocks.

    Returns how many rows each member links with for the first time at filter
    ``at``, and each linked member with the smallest one its links reach here.
    """
    x = unit(vectors)
    ok = x @ x.T >= cosine
    np.fill_diagonal(ok, False)
    if sides is not None:
        ok &= sides[:, None] != sides[None, :]
    linked = np.flatnonzero(ok.any(axis=1))
    if not len(linked):
        return np.zeros(len(reps), np.int64), linked, linked
    ok = ok[np.ix_(linked, linked)]
    before = [[f for f in lists[i] if f < at] for i in linked]
    names = {f: k for k, f in enumerate(sorted({f for fs in before for f in fs}))}
    seen = np.zeros((len(linked), len(names)), np.float32)
    for i, fs in enumerate(before):
        seen[i, [names[f] for f in fs]] = 1
    fresh = ok & ~(seen @ seen.T > 0)
    links = np.zeros(len(reps), np.int64)
    links[linked] = fresh @ many[linked]
    label = reps[linked]
    while True:
        lower = np.minimum(label, np.where(ok, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (lower == label).all():
            return links, linked, label
        label = lower


def _compared(batches, cosine):
    """Compares each pair of blocks, given as rows sorted by (bucket, left, right)."""
    out: list[tuple] = []
    size = 0
    for held in runs(batches, ("bucket", "left", "right")):
        reps, many = np.array(held["rep"], np.int64), np.array(held["many"], np.int64)
        sides = None if held["left"][0] == held["right"][0] else np.array(held["block"])
        links, linked, label = compare(reps, many, held["vector"], held["buckets"], held["bucket"][0], sides, cosine)
        out.append((reps[linked], label, links[linked]))
        size += len(linked)
        if size > 20_000:
            yield _rows(out)
            out, size = [], 0
    yield _rows(out)


def _rows(out) -> pa.RecordBatch:
    columns = [np.concatenate(c) if out else np.zeros(0, np.int64) for c in (zip(*out) if out else [()] * 3)]
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["rep", "low", "links"])


def classes_of(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(classes with rep, many; rows with rep) of comparable rows, by label and vector."""
    classes = saved(rows.groupBy("label", "embedding").agg(F.min("vec_id").alias("rep"), F.count("*").alias("many")), "classes")
    members = rows.join(classes, ["label", "embedding"]).select("vec_id", "rep", "many")
    return classes, saved(members, "members")


def groups(vectors: DataFrame, cosine: float = COSINE, block: int = BLOCK) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row."""
    vectors = vectors.select("vec_id", "embedding", F.col("label"))
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & fine & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows, other = vectors.where(usable), vectors.where(~usable)
    classes, members = classes_of(rows)
    words = code_words(classes.count())

    def decoded(reps, lists):
        found = [None] * len(reps)
        by_size: dict[int, list[int]] = {}
        for i, v in enumerate(lists):
            by_size.setdefault(len(v), []).append(i)
        for size, at in by_size.items():
            each = decode(unit([lists[i] for i in at]), words, height(size, words, cosine))
            for i, filters in zip(at, each):
                found[i] = filters.tolist()
        return {"rep": reps, "filters": found}

    codes = arrow_map(classes.select("rep", "embedding"), decoded, {"rep": "long", "filters": "array<long>"})
    known = classes.select("rep", F.xxhash64("label", F.size("embedding")).alias("side"))
    codes = saved(codes.select("rep", F.explode("filters").alias("filter")).join(known, "rep"), "codes")
    # A filter's members as digests: filters with the same members are one bucket, named after the first of them.
    held = codes.groupBy("side", "filter").agg(
        F.count("*").alias("size"), F.bit_xor(F.xxhash64("rep")).alias("h"),
        F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("i")).where("size > 1")
    once = held.groupBy("side", "size", "h", "i").agg(F.min("filter").alias("filter")).select("side", "filter", "size")
    once = saved(once.withColumn("bucket", F.xxhash64("side", "filter")), "buckets")
    met = saved(codes.join(once, ["side", "filter"]).select("rep", "bucket", "size"), "met")
    lists = met.groupBy("rep").agg(F.sort_array(F.collect_set("bucket")).alias("buckets"))  # as many as a vector has filters

    wide = met.join(classes.select("rep", "many", F.col("embedding").cast("array<double>").alias("vector")), "rep").join(lists, "rep")
    wide = in_blocks(wide, "bucket", "size", "rep", block)
    found = saved(wide.mapInArrow(lambda batches: _compared(batches, cosine), "rep long, low long, links long"), "links")

    counts = found.groupBy("rep").agg(F.sum("links").alias("links"))
    apart = members.groupBy("vec_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")
    roots = components(found.select(F.col("rep").alias("a"), F.col("low").alias("b")).unionByName(apart))
    placed = members.join(counts, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left").select(
        "vec_id", (F.coalesce("links", F.lit(0)) + F.col("many") - 1).alias("n_links"),
        F.coalesce("root", "rep").alias("component_id"))
    alone = other.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return placed.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op4_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "embeddings"))
