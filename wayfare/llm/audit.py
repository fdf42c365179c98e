"""How filters interact: what each of them removes at each place of each order.

Every task puts the whole texts of its rows into compressed tries, which merge
equal texts there and then; a trie is emptied once it holds ``HELD_BYTES``. Rows
above their text's smallest id in the task are duplicates already. The others
go on with their text: dealt by ranges of adaptive text prefixes into tries of a
prefix each, which hold the smallest id of all at each text's end. From then on
a document is a mask of the filters it fails, and masks are summed per part; all
orders and steps follow from 32 sums per part, the documents that pass a set of
filters, without opening documents by order.

Results in odd cases: a null text is an empty one; a null part is the empty
string; a null id is larger than every other, equal ids are not smaller than each
other, so repeated rows alone are no duplicates; a document with several
labels has the largest of each, a null label is 0; ids without documents are not
looked at; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial, inf

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import slices, table
from wayfare.llm.tries import Trie
from wayfare.session import scratch_path

FILTERS = "ABCDE"
DUPLICATE = 1 << FILTERS.index("E")
EVERY = (1 << len(FILTERS)) - 1
_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_SIGNS = b"#$%&*|"
_TAILS = bytes(range(0x80, 0xC0))  # bytes that continue a character

#: A task's trie is emptied once it holds so many bytes of text, or rows.
HELD_BYTES = 32 << 20
HELD_ROWS = 200_000
#: Prefixes that hold more than one byte in so many are extended; there are fewer of them than this at each length.
HEAVY_PART = 10_000
#: Prefixes with fewer bytes than this are never extended.
LEAST_HEAVY = 64 << 10
#: Characters of the first prefix; each extension is longer by this factor.
PREFIX, LONGER = 16, 4


def failures(text: bytes) -> int:
    """Mask of the conditions A to D that a text in UTF-8 meets."""
    words = text.split()
    n = len(words)
    upper = len(text) - len(text.translate(None, _UPPER))
    points = len(text) - (0 if text.isascii() else len(text) - len(text.translate(None, _TAILS)))
    signs = len(text.translate(None, _SIGNS)) < len(text)
    return (n < 50) | (100 * len(set(words)) < 65 * n) << 1 | (100 * upper > 5 * points) << 2 | signs << 3


_SCHEMA = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("mask", pa.int32()), ("n", pa.int64()), ("text", pa.binary())])
_DDL = "doc_id long, part string, mask int, n long, text binary"


def _emptied(trie: Trie, known: bool) -> Iterator[pa.RecordBatch]:
    """Rows of a trie. ``known``: its ids are final; else rows that may still be duplicates keep their text."""
    held: list[tuple] = []
    size = 0
    for text, end in trie.ends():
        for (doc_id, part), n in end.rows.items():
            twin = (inf if doc_id is None else doc_id) > end.least
            held.append((doc_id, part, end.note | (DUPLICATE if twin else 0), n, None if twin or known else text))
            size += 0 if held[-1][4] is None else len(text)
            if len(held) == 4096 or size > 8 << 20:
                yield _batch(held)
                held, size = [], 0
    if held:
        yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)


def merged(docs: DataFrame, part: str = "source", held_bytes: int = HELD_BYTES) -> DataFrame:
    """(doc_id, part, mask, n, text) with equal texts of a task merged; a text only where a smaller id may exist elsewhere."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("text"))

    def run(batches):
        trie = Trie()
        for batch in slices(batches):
            for doc_id, name, text in zip(*(c.to_pylist() for c in batch.columns)):
                end = trie.end_of(text)
                if end.note is None:
                    end.note = failures(text)
                trie.add(end, inf if doc_id is None else doc_id, (doc_id, name), 1)
            if trie.n_bytes > held_bytes or trie.n_rows > HELD_ROWS:
                yield from _emptied(trie, False)
                trie = Trie()
        yield from _emptied(trie, False)

    path = scratch_path(docs.sparkSession, "merged")
    rows.mapInArrow(run, _DDL).write.option("compression", "zstd").parquet(path)
    return docs.sparkSession.read.schema(_DDL).parquet(path)


def _divergence(batches):
    """Characters that all texts of a prefix share, from the smallest and the largest of them."""
    schema = pa.schema([("mark", pa.int64()), ("shared", pa.int32()), ("same", pa.bool_())])
    for batch in slices(batches, 4):
        marks, lows, highs = (c.to_pylist() for c in batch.columns)
        shared = []
        for low, high in zip(lows, highs):
            at, end = 0, min(len(low), len(high))
            while at < end and low[at:at + 4096] == high[at:at + 4096]:
                at += 4096
            at = min(at, end)
            while at < end and low[at] == high[at]:
                at += 1
            shared.append(at)
        yield pa.RecordBatch.from_arrays(
            [pa.array(marks, pa.int64()), pa.array(shared, pa.int32()), pa.array([a == b for a, b in zip(lows, highs)])], schema=schema)


def prefixed(texts: DataFrame) -> DataFrame:
    """``texts`` with a column ``key``: a prefix of the text, extended where many bytes begin alike.

    The first prefix has ``PREFIX`` characters. Texts of a prefix with too
    many bytes get what follows the characters they all share, and so on; a
    prefix whose texts are all equal needs none. Equal texts have equal keys.
    At most ``HEAVY_PART`` prefixes are extended at a time, known by a digest.
    """
    spark = texts.sparkSession
    shown = F.col("text").cast("string")
    texts = texts.withColumn("key", F.substring(shown, 1, PREFIX))
    total = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    limit, length = max(total / HEAVY_PART, LEAST_HEAVY), PREFIX
    while True:
        mark = F.xxhash64("key")
        heavy = texts.groupBy(mark.alias("mark")).agg(F.sum(F.octet_length("text")).alias("size")).where(F.col("size") > limit)
        heavy = F.broadcast(heavy.select("mark"))
        ends = texts.withColumn("mark", mark).join(heavy, "mark").groupBy("mark").agg(F.min(shown).alias("low"), F.max(shown).alias("high"))
        found = ends.mapInArrow(_divergence, "mark long, shared int, same boolean").collect()
        open_ = [(r.mark, r.shared) for r in found if not r.same and r.shared + length < 2 ** 30]
        if not open_:
            return texts
        length *= LONGER
        more = spark.createDataFrame(open_, "mark long, shared int")
        texts = texts.withColumn("mark", mark).join(F.broadcast(more), "mark", "left").drop("mark").withColumn(
            "key", F.when(F.col("shared").isNull(), F.col("key")).otherwise(
                F.concat_ws("\x00", "key", F.substring(shown, F.col("shared") + 1, F.lit(length))))).drop("shared")


def masks(docs: DataFrame, part: str = "source", held_bytes: int = HELD_BYTES) -> DataFrame:
    """(doc_id, part, mask, n): the filters that each document fails, n of them where rows are equal."""
    rows = merged(docs, part, held_bytes)
    keyed = prefixed(rows.where("text IS NOT NULL")).repartitionByRange("key").sortWithinPartitions("key")

    def run(batches):
        trie, last = Trie(), None
        for batch in slices(batches):
            *columns, keys = (c.to_pylist() for c in batch.columns)
            for doc_id, name, mask, n, text, key in zip(*columns, keys):
                if key != last:
                    yield from _emptied(trie, True)
                    trie, last = Trie(), key
                end = trie.end_of(text)
                end.note = mask
                trie.add(end, inf if doc_id is None else doc_id, (doc_id, name), n)
        yield from _emptied(trie, True)

    known = keyed.select("doc_id", "part", "mask", "n", "text", "key").mapInArrow(run, _DDL).drop("text")
    return known.unionByName(rows.where("text IS NULL").drop("text"))


def passing(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, passed): a map from each set of filters to the documents that fail none of the set, where there are any."""
    flags = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce((F.col("quality") == 1).cast("long"), F.lit(0).cast("long"))).alias("good"),
        F.max(F.coalesce((F.col("toxic") == 1).cast("long"), F.lit(0).cast("long"))).alias("toxic"))
    sums = rows.join(flags, "doc_id", "left").groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *(F.sum(F.when(F.col(name) == 1, F.col("n")).otherwise(0)).alias(name) for name in ("good", "toxic")))
    sets = F.filter(F.sequence(F.lit(0), F.lit(EVERY)), lambda s: s.bitwiseAND(F.col("mask")) == 0)
    sums = sums.withColumn("set", F.explode(sets)).groupBy("part", "set").agg(*(F.sum(c).alias(c) for c in ("n", "good", "toxic")))
    return sums.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("set", F.struct("n", "good", "toxic")))).alias("passed"))


def _constant(rows: list[dict], kind: str) -> Column:
    """A small table as one literal array."""
    return F.from_json(F.lit(json.dumps(rows)), f"array<struct<{kind}>>")


def interactions(passed: DataFrame) -> DataFrame:
    """A row per part, order and step, zeros included.

    A filter's Shapley sum counts each set of other filters as often as an
    order puts just that set before it.
    """
    size = len(FILTERS)
    steps = [
        {"filter_order": "".join(order), "step": step, "before": sum(1 << FILTERS.index(x) for x in order[:step - 1]),
         "bit": 1 << FILTERS.index(order[step - 1])}
        for order in permutations(FILTERS) for step in range(1, size + 1)]
    sets = [{"set": s, "orders": factorial(s.bit_count()) * factorial(size - 1 - s.bit_count())} for s in range(EVERY)]
    rows = passed.withColumn("at", F.explode(_constant(steps, "filter_order: string, step: int, before: int, bit: int"))).select("*", "at.*")

    def held(name: str, bits: Column) -> Column:
        return F.coalesce(F.col("passed")[bits][name], F.lit(0).cast("long"))

    before, bit = F.col("before"), F.col("bit")
    after, others = before.bitwiseOR(bit), F.lit(EVERY) - bit
    removed = held("n", before) - held("n", after)
    shapley = F.aggregate(
        F.filter(_constant(sets, "set: int, orders: bigint"), lambda s: s["set"].bitwiseAND(bit) == 0), F.lit(0).cast("long"),
        lambda total, s: total + (held("n", s["set"]) - held("n", s["set"].bitwiseOR(bit))) * s["orders"])
    return rows.select(
        "part", "filter_order", "step", held("n", after).alias("kept"), removed.alias("removed"),
        (held("n", F.lit(0)) - held("n", bit) - removed).alias("redundant"),
        (held("n", others) - held("n", F.lit(EVERY))).alias("unique_fails"),
        (held("good", before) - held("good", after)).alias("good_lost"),
        (held("toxic", before) - held("toxic", after)).alias("toxic_lost"), shapley.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    return interactions(passing(masks(docs, part), labels))


def op13_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH t AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS least
  FROM documents),
l AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
d AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(words) < 50 THEN 'A' ELSE '' END
         || CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 'B' ELSE '' END
         || CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END
         || CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END
         || CASE WHEN doc_id > least OR (doc_id IS NULL AND least IS NOT NULL) THEN 'E' ELSE '' END AS fails
  FROM t LEFT JOIN l USING (doc_id)),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY ALL),
f AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM f a, f b, f c, f d, f e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, unnest([1, 2, 3, 4, 5]) AS step FROM o),
p AS (
  SELECT *, substr(filter_order, step, 1) AS own, left(filter_order, step - 1) AS before FROM s),
r AS (
  SELECT part, filter_order, step, own,
         sum(n) FILTER (WHERE translate(fails, before || own, '') = fails) AS kept,
         sum(n) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') = fails) AS removed,
         sum(n) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') <> fails) AS redundant,
         sum(n) FILTER (WHERE fails = own) AS unique_fails,
         sum(good) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') = fails) AS good_lost,
         sum(toxic) FILTER (WHERE contains(fails, own) AND translate(fails, before, '') = fails) AS toxic_lost
  FROM m, p GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
       coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       (sum(coalesce(removed, 0)) OVER (PARTITION BY part, own))::BIGINT AS shapley
FROM r
"""
