"""MinHash near-duplicates: circulant signatures, bands, exact Jaccard on full shingle sets, components.

Documents with one shingle set are one class from the start. Classes that share
a band key are candidates, and links are confirmed on the full sets, in three
steps that together lose no link between members of different components:

1. the members of each bucket with its smallest one (a star, not all pairs);
2. where a bucket still spans components, the pairs that a sketch says are
   most alike and would join two of them (a forest, not all pairs);
3. all pairs of what is left that stand in different components, share no
   earlier bucket, and are not ruled out by size or sketch.

Steps 2 and 3 look at buckets in blocks inside tasks, so the pairs of a large
group are looked at where they are and only those worth a check are written.

Results in odd cases: a null or blank text has an empty set and links with
nothing; rows that share a doc_id are one document; a row without doc_id is its
own, with a null component, and kept; an empty table gives an empty result.
Extra columns are not looked at (``groups``) or kept (``deduplicate``).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import arrow_map, components, in_blocks, runs, saved, table
from wayfare.llm.shingles import BANDS, MARGIN, alike, band_keys, digest, estimates, shingle_set, signatures

PERCENT = 75
#: Members of one block of a bucket, about; a task holds two blocks at a time.
BLOCK = 512


def prints(docs: DataFrame) -> DataFrame:
    """Per document: size and digest of its set, its band keys, and what steps 2 and 3 look at.

    ``marks`` are 4 bytes of each band key, ``sketch`` one byte of each coordinate.
    """

    def run(ids, texts):
        sets = [shingle_set(t) for t in texts]
        full = [s for s in sets if len(s)]
        signed = signatures(full)
        keys = band_keys(signed)
        marks, sketch = keys.astype(np.uint32), signed.astype(np.uint8)
        at = iter(range(len(full)))
        place = [next(at) if len(s) else None for s in sets]
        return {"doc_id": ids, "n_shingles": [len(s) for s in sets],
                "digest": [None if p is None else digest(s) for p, s in zip(place, sets)],
                "keys": [None if p is None else keys[p] for p in place],
                "marks": [None if p is None else marks[p].tobytes() for p in place],
                "sketch": [None if p is None else sketch[p].tobytes() for p in place]}

    return arrow_map(docs.select("doc_id", "text"), run, {
        "doc_id": "long", "n_shingles": "long", "digest": "binary", "keys": "array<long>", "marks": "binary", "sketch": "binary"})


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those (a, b) whose sets are alike enough; the sets are joined to the pairs, never gathered."""
    met = pairs.join(sets.select(F.col("rep").alias("b"), F.col("members").alias("set_b")), "b")
    met = met.join(sets.select(F.col("rep").alias("a"), F.col("members").alias("set_a")), "a")

    def run(a, b, set_a, set_b):
        fine = [alike(x, y, percent) for x, y in zip(set_a, set_b)]
        return {"a": [v for v, ok in zip(a, fine) if ok], "b": [v for v, ok in zip(b, fine) if ok]}

    return saved(arrow_map(met.select("a", "b", "set_a", "set_b"), run, {"a": "long", "b": "long"}), "links")


def merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(rep, comp) after adding links between nodes of the current components."""
    if labels is None:
        return saved(components(links).select(F.col("node").alias("rep"), F.col("root").alias("comp")), "components")
    lifted = relabelled(relabelled(links, labels, "a"), labels, "b")
    roots = components(lifted)
    old = labels.join(roots, labels["comp"] == roots["node"], "left").select(
        "rep", F.coalesce("root", "comp").alias("comp"))
    new = roots.join(labels, roots["node"] == labels["rep"], "left_anti").select(
        F.col("node").alias("rep"), F.col("root").alias("comp"))
    return saved(old.unionByName(new), "components")


def relabelled(pairs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """``pairs`` with ``column`` replaced by its component."""
    named = labels.select(F.col("rep").alias(column), F.col("comp").alias("__comp"))
    return pairs.join(named, column, "left").withColumn(column, F.coalesce("__comp", column)).drop("__comp")


def unresolved(live: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that still span several components, with their component and the bucket's size."""
    placed = live.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    spans = placed.groupBy("key").agg(F.min("comp").alias("__l"), F.max("comp").alias("__h"), F.count("*").alias("size"))
    return placed.join(spans.where("__l < __h").select("key", "size"), "key")


def forest(a, b, comps, alike_by):
    """Of the pairs (a, b), the most alike ones that join two components each; a spanning forest of the components."""
    root: dict[int, int] = {}

    def find(n):
        while root.get(n, n) != n:
            root[n] = root.get(root[n], root[n])
            n = root[n]
        return n

    kept = []
    for i in np.argsort(-alike_by, kind="stable").tolist():
        x, y = find(int(comps[a[i]])), find(int(comps[b[i]]))
        if x != y:
            root[max(x, y)] = min(x, y)
            kept.append(i)
    return np.array(kept, np.int64)


def _candidates(batches, percent: int, spanning: bool):
    """(a, b) of rows sorted by (key, left, right): pairs of members in different components that may be alike."""
    for held in runs(batches, ("key", "left", "right")):
        reps, comps, n = (np.array(held[c], np.int64) for c in ("rep", "comp", "n"))
        marks = np.frombuffer(b"".join(held["marks"]), np.uint32).reshape(-1, BANDS)
        sketches = np.frombuffer(b"".join(held["sketch"]), np.uint8).reshape(len(reps), -1)
        open_pairs = np.triu(comps[:, None] != comps[None, :], 1)
        if held["left"][0] != held["right"][0]:
            side = np.array(held["block"])
            open_pairs &= side[:, None] != side[None, :]
        open_pairs &= 100 * np.minimum(n[:, None], n[None, :]) >= percent * np.maximum(n[:, None], n[None, :])
        if not spanning:
            for earlier in range(held["band"][0]):
                open_pairs &= marks[:, None, earlier] != marks[None, :, earlier]
        a, b = np.nonzero(open_pairs)
        alike_by = estimates(sketches, a, b)
        near = np.flatnonzero(alike_by >= (percent / 100 + 0.02 if spanning else percent / 100 - MARGIN))
        a, b = a[near], b[near]
        if spanning and len(near):
            kept = forest(a, b, comps, alike_by[near])
            a, b = a[kept], b[kept]
        if len(a):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.minimum(reps[a], reps[b])), pa.array(np.maximum(reps[a], reps[b]))], names=["a", "b"])


def candidates(live: DataFrame, labels: DataFrame, looks: DataFrame, percent: int, spanning: bool) -> DataFrame:
    left = unresolved(live, labels).join(looks, "rep")
    dealt = in_blocks(left, "key", "size", "rep", BLOCK)
    return dealt.mapInArrow(lambda batches: _candidates(batches, percent, spanning), "a long, b long").distinct()


def groups(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document; bands and sketch margin are made for ``PERCENT`` and above."""
    if not PERCENT <= percent <= 100:
        raise ValueError(f"percent is {percent}: below {PERCENT} the bands would miss pairs, above 100 there are none")
    docs = docs.select("doc_id", "text")
    marks = saved(prints(docs), "prints")
    named = marks.where("doc_id IS NOT NULL AND digest IS NOT NULL")
    classes = named.groupBy("digest").agg(F.min("doc_id").alias("rep"))
    member = saved(named.select("doc_id", "n_shingles", "digest").join(classes, "digest").drop("digest"), "classes")
    # Rows that share a doc_id are one document: the smallest class of the id stands for all its classes.
    apart = member.groupBy("doc_id").agg(F.min("rep").alias("a"), F.max("rep").alias("b")).where("a < b").select("a", "b")

    first = named.join(classes.select(F.col("rep").alias("doc_id"), "digest"), ["doc_id", "digest"], "left_semi").select(
        F.col("doc_id").alias("rep"), F.col("n_shingles").alias("n"), "keys", "marks", "sketch")
    first = saved(first.dropDuplicates(["rep", "n", "marks"]), "firsts")
    bands = first.select("rep", "n", F.posexplode("keys").alias("band", "key"))
    buckets = bands.groupBy("key").agg(F.min("rep").alias("hub"), F.max("rep").alias("top")).where("hub < top")
    live = saved(bands.join(buckets.select("key", "hub"), "key"), "buckets")
    involved = live.select(F.col("rep").alias("doc_id")).distinct()

    def run(ids, texts):
        return {"rep": ids, "members": [shingle_set(t).tobytes() for t in texts]}

    sets = saved(arrow_map(docs.join(involved, "doc_id", "left_semi"), run, {"rep": "long", "members": "binary"}), "sets")
    looks = first.select("rep", "marks", "sketch")

    stars = live.where("rep <> hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct()
    labels = merged(None, verified(stars, sets, percent).unionByName(apart))
    live = live.drop("hub")
    for spanning in (True, False):
        labels = merged(labels, verified(candidates(live, labels, looks, percent, spanning), sets, percent))

    placed = member.join(labels, "rep", "left").select(
        "doc_id", "n_shingles", F.coalesce("comp", "rep").alias("component_id"))
    other = marks.where("doc_id IS NULL OR digest IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return placed.unionByName(other).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay: one document of each group, with its columns as they are."""
    gone = groups(docs, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


def op5_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "documents"))
