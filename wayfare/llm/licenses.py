"""License scans: ordered signature rules behind a keyword filter, overlaps settled by priority and containment.

Some hundreds of patterns are spelled out from license names and the ways a
notice is worded. A text meets a rule's pattern only if it holds one of the
rule's keywords (one pass of an Aho-Corasick automaton finds them all). Rules
are in order: a detection inside, or overlapping, one of a rule before it is
suppressed, and of the same rule the longer one stays.

Texts are compared with A-Z lower-cased, as words: runs of ASCII letters and
digits and of all characters beyond ASCII.

Results in odd cases: a null or empty text has no words, no labels and score 0;
repeated rows give repeated results; extra columns are not looked at.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from wayfare.llm.common import arrow_map, table

# The phrases of the given task and their labels.
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

# License families: label, names as they are written (patterns over words), versions.
FAMILIES = (
    ("apache", ("apache", "apache software"), ("1 0", "1 1", "2 0")),
    ("mit", ("mit", "expat"), ()),
    ("bsd", ("bsd", "bsd [234] clause", "[234] clause bsd", "simplified bsd", "modified bsd", "new bsd"), ()),
    ("gpl", ("gpl", "gnu gpl", "gnu general public", "general public"), ("1", "2", "2 0", "3", "3 0")),
    ("lgpl", ("lgpl", "gnu lgpl", "gnu lesser general public", "lesser general public", "library general public"),
     ("2", "2 0", "2 1", "3", "3 0")),
    ("agpl", ("agpl", "gnu agpl", "affero general public", "gnu affero general public"), ("1", "3", "3 0")),
    ("mpl", ("mpl", "mozilla public"), ("1 0", "1 1", "2 0")),
    ("epl", ("epl", "eclipse public"), ("1 0", "2 0")),
    ("cddl", ("cddl", "common development and distribution"), ("1 0", "1 1")),
    ("eupl", ("eupl", "european union public"), ("1 0", "1 1", "1 2")),
    ("artistic", ("artistic", "perl artistic"), ("1 0", "2 0")),
    ("isc", ("isc",), ()),
    ("zlib", ("zlib", "zlib libpng"), ()),
    ("boost", ("boost", "boost software", "bsl"), ("1 0",)),
    ("unlicense", ("unlicense", "the unlicense"), ()),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public"), ("1", "2")),
    ("ofl", ("ofl", "sil open font", "open font"), ("1 0", "1 1")),
    ("psf", ("psf", "python software foundation"), ("2",)),
    ("php", ("php",), ("3 0", "3 01")),
    ("ms-pl", ("ms pl", "microsoft public"), ()),
    ("cc0", ("cc0", "creative commons zero"), ("1 0",)),
    ("cc-by", ("cc by", "creative commons attribution"), ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", ("cc by sa", "creative commons attribution sharealike", "creative commons attribution share alike"),
     ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", ("cc by nc", "creative commons attribution noncommercial", "creative commons attribution non commercial"),
     ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", ("cc by nd", "creative commons attribution noderivs", "creative commons attribution no derivatives"),
     ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", ("cc by nc sa", "creative commons attribution noncommercial sharealike"), ("2 0", "3 0", "4 0")),
    ("cc-by-nc-nd", ("cc by nc nd", "creative commons attribution noncommercial noderivs"), ("2 0", "3 0", "4 0")),
    ("odbl", ("odbl", "open database"), ("1 0",)),
)
# Ways a notice is worded; {n} is the name. Each has a confidence; the order is the rules' priority.
NOTICES = (
    (r"spdx license identifier {n}", 1.0),
    (r"(?:re)?licensed (?:to you )?under (?:the )?(?:terms of )?(?:the )?{n}(?: licen[sc]e)?", 0.95),
    (r"(?:released|distributed|available|published|provided|redistributed) under (?:the )?(?:terms of )?(?:the )?{n}"
     r"(?: licen[sc]e)?", 0.9),
    (r"(?:covered|governed) by (?:the )?(?:terms of )?(?:the )?{n}(?: licen[sc]e)?", 0.85),
    (r"{n} licen[sc]e", 0.7),
    (r"licen[sc]e {n}", 0.6),
)
# Notices that name no family.
OTHERS = (
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", 0.6, "copyright"),
    ("copyright", r"copyright (?:c )?by [a-z]+", 0.5, "copyright"),
    ("public-domain", r"(?:in|into|to) the public domain", 0.7, "public domain"),
    ("public-domain", r"public domain dedication", 0.8, "public domain"),
    ("proprietary", r"proprietary and confidential", 0.8, "proprietary"),
    ("proprietary", r"may not be (?:reproduced|copied|distributed|redistributed)", 0.7, "may not be"),
    ("proprietary", r"without (?:the )?(?:prior )?(?:written )?permission of", 0.6, "permission of"),
    ("no-commercial", r"for non ?commercial (?:use|purposes) only", 0.7, "commercial"),
    ("reserved", r"all rights reserved", 0.6, "rights reserved"),
    ("reserved", r"some rights reserved", 0.6, "rights reserved"),
    ("mit", r"permission is hereby granted free of charge", 0.8, "hereby granted"),
    ("bsd", r"redistribution and use in source and binary forms", 0.8, "redistribution"),
)
_KEEP = {ord(c) for c in "0123456789abcdefghijklmnopqrstuvwxyz"} | set(range(128, 256))
_WORD_BYTE = np.array([b in _KEEP or chr(b).isascii() and chr(b).isupper() for b in range(256)])
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b in _KEEP else 32 for b in range(256))


class Rule:
    def __init__(self, label: str, pattern: str, confidence: float, keyword: str):
        self.label, self.confidence, self.keyword = label, confidence, keyword.encode()
        self.pattern = re.compile(rb"(?<![^ ])" + pattern.encode() + rb"(?![^ ])")


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules by priority: wording first, then the longest name, with a version before without."""
    made = []
    for text, confidence in NOTICES:
        for label, names, versions in sorted(FAMILIES, key=lambda f: -max(map(len, f[1]))):
            for name in sorted(names, key=len, reverse=True):
                keyword = max(re.sub(r"\[.*?\]", "|", name).split("|"), key=len).strip()
                for version in (*sorted(versions, key=len, reverse=True), None):
                    said = name if version is None else f"{name}(?: licen[sc]e)?(?: version| v)? ?v?{version}(?: only| or later)?"
                    tag = label if version is None else f"{label}-{version.replace(' ', '.')}"
                    made.append(Rule(tag, text.format(n=said), confidence, keyword))
    made += [Rule(*other) for other in OTHERS]
    return tuple(made)


@lru_cache(maxsize=1)
def _automaton():
    """Keyword -> rules; one pass over a text tells which rules to try."""
    import ahocorasick

    found = ahocorasick.Automaton()
    by: dict[str, list[int]] = {}
    for i, rule in enumerate(rules()):
        by.setdefault(rule.keyword.decode(), []).append(i)
    for keyword, numbers in by.items():
        found.add_word(keyword, numbers)
    found.make_automaton()
    return found


#: Each rule needs one of these; texts without any are done after counting their words.
GATES = (b"licen", b"copyright", b"public domain", b"proprietary", b"may not be", b"permission", b"commercial",
         b"rights reserved", b"redistribution", b" under ", b"cc by", b"general public", b"governed by", b"covered by")
#: First word of each gate: texts without any hold no gate, whatever stands between their words.
FIRST_WORDS = tuple(gate.split()[0] for gate in GATES)


def detections(words: bytes) -> list[tuple[int, int, Rule]]:
    """What the rules find in blank-joined words, after suppression, as (start, end, rule)."""
    text = words.decode("latin-1")
    tried = sorted({i for _, numbers in _automaton().iter(text) for i in numbers})
    kept: list[tuple[int, int, Rule]] = []
    book = rules()
    for i in tried:
        for m in book[i].pattern.finditer(words):
            if not any(m.start() < end and start < m.end() for start, end, _ in kept):
                kept.append((m.start(), m.end(), book[i]))
    return sorted(kept, key=lambda k: k[:2])


def scan(text: str | None) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score, spans) of one text."""
    data = (text or "").encode()
    kept = _WORD_BYTE[np.frombuffer(data, np.uint8)]
    n_words = int(kept[:1].sum() + (kept[1:] & ~kept[:-1]).sum())
    lowered = data.translate(_TO_WORDS)
    if not any(word in lowered for word in FIRST_WORDS):
        return n_words, 0, None, None, "", "", 0.0, []
    words = b" ".join(lowered.split())
    starts, base, confidence = [], set(), 0.0
    for phrase, label in BASE:
        at = words.find(phrase.encode())
        while at >= 0:
            end = at + len(phrase)
            if (at == 0 or words[at - 1] == 32) and (end == len(words) or words[end] == 32):
                starts.append(at)
                base.add(label)
                confidence = max(confidence, 0.5)
            at = words.find(phrase.encode(), at + 1)
    found = detections(words) if any(gate in words for gate in GATES) else []
    labels = base | {rule.label for _, _, rule in found}
    number = [words.count(b" ", 0, at) for at in (min(starts), max(starts))] if starts else [None, None]
    spans = [f"{rule.label}:{words.count(b' ', 0, s)}:{words.count(b' ', 0, e) + 1}" for s, e, rule in found]
    confidence = max([confidence, *(rule.confidence for _, _, rule in found)])
    return n_words, len(starts), *number, ",".join(sorted(base)), ",".join(sorted(labels)), confidence, spans


def find(docs: DataFrame) -> DataFrame:
    """Word counts, base phrases, labels, score and the detections (label:first word:end word) per document."""
    names = {"n_words": "long", "n_base": "long", "first_word": "long", "last_word": "long", "base_labels": "string",
             "labels": "string", "score": "double", "detections": "string"}

    def run(ids, texts):
        rows = [scan(t) for t in texts]
        columns = list(zip(*rows)) or [[]] * len(names)
        return {"doc_id": ids} | dict(zip(names, [*columns[:7], [",".join(r[7]) for r in rows]]))

    return arrow_map(docs.select("doc_id", "text"), run, {"doc_id": "long"} | names)


def op7_license_scan(spark, sf_dir: str) -> DataFrame:
    return find(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
