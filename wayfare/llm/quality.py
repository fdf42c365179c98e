"""Quality rules: boosted trees over document statistics, after two fixed rules.

The trees are trained here on a bounded sample of labelled documents and
shipped to the tasks as flat node arrays. More signs, repeated lines or
shouting can only lower a document's score, by monotonic constraints.

Results in odd cases: a null or empty text has no words and fails the fixed
rule; without labels the trees are empty and keep everything the fixed rules
keep; repeated rows give repeated results; rows without a label, or with
conflicting labels, train nothing or both ways; extra columns are not looked at
(``judge``) or kept (``keep``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfare.llm.common import arrow_map, slices, table
from wayfare.llm.trees import Forest, train

#: Labelled rows that training takes at most: the first by a digest of their id. Bounds what is broadcast and collected.
SAMPLE_ROWS = 6000
#: A document goes when the trees give it less than this chance of being good.
KEEP_FROM = 0.5
LEAST_WORDS = 50
MOST_REPEAT_PERCENT = 50

FEATURES = ("words_log", "word_length", "symbols_per_word", "dup_line_share", "repeat_share", "upper_share",
            "digit_share", "bang_share", "short_word_share", "distinct_share", "lines_log", "line_words")
#: Feature -> direction in which the chance of being good may move.
MONOTONE = {"symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1, "upper_share": -1, "bang_share": -1}

_SYMBOLS = np.isin(np.arange(256), list(b"#*$%&|<>"))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_LOWER = (np.arange(256) >= 97) & (np.arange(256) <= 122)
_DIGIT = (np.arange(256) >= 48) & (np.arange(256) <= 57)
_BREAKS = b"\t\n\x0b\x0c\r "


def repeat_words(numbers: np.ndarray) -> int:
    """Words inside a 3-word window that the text holds twice or more."""
    if len(numbers) < 4:
        return 0
    n = int(numbers.max()) + 1
    pairs = numbers[:-1] * n + numbers[1:]
    if n >= 1 << 20:
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * n + numbers[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(len(windows), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(numbers), bool)
    for j in range(3):
        covered[j:j + len(windows)] |= twice
    return int(covered.sum())


def statistics(text: str | None) -> tuple[list[int], list[float]]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) and the trees' features of one text."""
    data = (text or "").encode()
    words = data.split()
    n = len(words)
    shown = np.frombuffer(data, np.uint8)
    counts = np.bincount(shown, minlength=256)
    lead = int(counts[:128].sum() + counts[192:].sum())  # code points: bytes that begin a character
    word_chars = lead - int(counts[list(_BREAKS)].sum())
    symbols = int(counts[_SYMBOLS].sum())
    seen: set[bytes] = set()
    lines = repeated = 0
    for line in data.split(b"\n"):
        if line and not line.isspace():
            lines += 1
            repeated += line in seen
            seen.add(line)
    index: dict[bytes, int] = {}
    numbers = np.fromiter((index.setdefault(w, len(index)) for w in words), np.int64, n)
    again = repeat_words(numbers)
    sizes = np.fromiter(map(len, words), np.int64, n)
    letters = max(1, int(counts[_UPPER].sum() + counts[_LOWER].sum()))
    many = max(1, n)
    features = [
        np.log1p(n), word_chars / many, symbols / many, repeated / max(1, lines), again / many,
        counts[_UPPER].sum() / letters, counts[_DIGIT].sum() / max(1, word_chars), counts[33] / many,
        float((sizes <= 3).sum()) / many, len(index) / many, np.log1p(lines), n / max(1, lines),
    ]
    return [n, word_chars, symbols, repeated, again], [float(f) for f in features]


def base_failed(n_words: int, n_repeat: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat > MOST_REPEAT_PERCENT * n_words


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Forest:
    """Trees from at most ``sample_rows`` labelled documents."""
    named = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").select("doc_id", "quality")
    # The sample has at most sample_rows rows of 12 bytes: small enough to broadcast at any size of the corpus.
    chosen = named.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(sample_rows)
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")

    def run(ids, texts, good):
        return {"quality": good, "doc_id": ids, "features": [statistics(t)[1] for t in texts]}

    rows = arrow_map(met.select("doc_id", "text", F.col("quality").cast("long")), run,
                     {"quality": "long", "doc_id": "long", "features": "array<double>"})
    # Documents of one id could be many: the sample's bound holds for the rows that reach the driver, too.
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "features", "quality").limit(sample_rows).collect()
    x = np.array([r.features for r in rows], float).reshape(len(rows), len(FEATURES))
    y = np.array([r.quality > 0 for r in rows], float)
    return train(x, y, {FEATURES.index(name): sign for name, sign in MONOTONE.items()})


def verdicts(forest: Forest, texts, keep_from: float = KEEP_FROM):
    """Statistics, base_failed, chance and kept of each text."""
    found = [statistics(t) for t in texts]
    chance = 1 / (1 + np.exp(-forest.score(np.array([f[1] for f in found]).reshape(len(found), len(FEATURES)))))
    if not len(forest.roots):
        chance = np.ones(len(found))
    failed = [base_failed(f[0][0], f[0][4]) for f in found]
    return [f[0] for f in found], failed, chance, [not b and bool(c >= keep_from) for b, c in zip(failed, chance)]


def judge(docs: DataFrame, forest: Forest, keep_from: float = KEEP_FROM) -> DataFrame:
    """Statistics and verdict per document."""
    counted = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(ids, texts):
        numbers, failed, chance, kept = verdicts(forest, texts, keep_from)
        return {"doc_id": ids, **{c: [r[i] for r in numbers] for i, c in enumerate(counted)},
                "base_failed": failed, "chance": chance, "kept": kept}

    return arrow_map(docs.select("doc_id", "text"), run, {
        "doc_id": "long", **{c: "long" for c in counted}, "base_failed": "boolean", "chance": "double", "kept": "boolean"})


def keep(docs: DataFrame, forest: Forest, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that pass, as they are."""
    at = docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        for part in slices(batches):
            yield part.filter(pa.array(verdicts(forest, part.column(at).to_pylist(), keep_from)[3], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op9_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    forest = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, forest).drop("chance")
