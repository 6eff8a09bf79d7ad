"""Licence scans: an Aho-Corasick automaton finds notice phrases and identifier tags,
and a shunting-yard parser evaluates the expression behind a tag.

A text is reduced to its words (A-Z lower-cased; runs of letters, digits and
anything beyond ASCII) joined by single blanks, so a phrase is found wherever its words stand
consecutively. Behind ``SPDX-License-Identifier:`` an expression of
identifiers, AND, OR, WITH and brackets is put into postfix form and evaluated to
its licences and whether it allows closed use: AND needs both sides, OR either.

``score`` is the evidence: 1 for a well-formed tag, 0.9 for a phrase that only a notice
uses, 0.6 for a bare licence name, 0.3 for a tag whose expression is malformed, else 0.

Edge cases: a NULL text has no words, counts of 0, empty labels and score 0. Repeated
ids and rows are judged row by row. A malformed or over-deep expression gives
the label ``unparsed`` and no error. Extra columns are ignored.
"""

from __future__ import annotations

import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_texts

# Phrases that name a licence, and their labels.
BASE_PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
NOTICE_PHRASES = {
    "bsd license": "bsd",
    "mozilla public license": "mpl",
    "lesser general public license": "lgpl",
    "affero general public license": "agpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "permission is hereby granted free of charge": "mit",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under the apache license version 2 0": "apache",
    "this program is free software": "gpl",
    "all rights reserved": "proprietary",
}
STRONG = frozenset(
    [
        "permission is hereby granted free of charge",
        "redistribution and use in source and binary forms",
        "licensed under the apache license version 2 0",
        "this program is free software",
    ]
)
TAG = "spdx license identifier"
FAMILIES = ("mit", "apache", "lgpl", "agpl", "gpl", "bsd", "mpl", "epl", "cc-by", "isc", "unlicense")
OPEN_USE = frozenset(["mit", "apache", "bsd", "isc", "unlicense", "cc-by"])

_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
_TAG_LINE = re.compile(r"SPDX-License-Identifier:[\x20\t]*([^\r\n]*)", re.IGNORECASE)
_TOKEN = re.compile(r"\(|\)|[A-Za-z0-9.+:-]+")
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}


def family(identifier: str) -> str:
    low = identifier.lower()
    return next((f for f in FAMILIES if low == f or low.startswith((f + "-", f + "+"))), low)


def postfix(expression: str) -> list[str] | None:
    """The expression in postfix order, or None if it is malformed; text after it is ignored."""
    out, stack, want = [], [], True
    for token in _TOKEN.findall(expression):
        low = token.lower()
        if low in _PRECEDENCE:
            if want:
                return None
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            want = True
        elif token == "(":
            if not want:
                break
            stack.append(token)
        elif token == ")":
            if want:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                break
            stack.pop()
        else:
            if not want:
                break
            out.append(token)
            want = False
    if want or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(expression: str) -> tuple[list[str], bool] | None:
    """Licence families an expression names, and whether it allows closed use; None if malformed."""
    order = postfix(expression)
    if order is None:
        return None
    stack: list[tuple[set[str], bool]] = []
    for token in order:
        if token in _PRECEDENCE:
            right, left = stack.pop(), stack.pop()
            if token == "with":
                stack.append((left[0], left[1]))
            else:
                either = left[1] or right[1] if token == "or" else left[1] and right[1]
                stack.append((left[0] | right[0], either))
        else:
            name = family(token)
            stack.append(({name}, name in OPEN_USE))
    labels, allowed = stack.pop()
    return sorted(labels), allowed


def _automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for phrase in [*BASE_PHRASES, *NOTICE_PHRASES, TAG]:
        found.add_word(f" {phrase} ", phrase)
    found.make_automaton()
    return found


def scan(text: str | None, automaton: ahocorasick.Automaton) -> tuple:
    """n_words, n_base, first_word, last_word, base labels, all labels, expressions, closed use, score."""
    words = (text or "").encode().translate(_WORD_BYTES).split()
    joined = (b" " + b" ".join(words) + b" ").decode()
    starts, base, labels, score, tagged = [], set(), set(), 0.0, False
    at, counted = 0, 0
    for end, phrase in automaton.iter(joined):
        start = end - len(phrase) - 1
        if phrase == TAG:
            tagged = True
            continue
        if phrase in BASE_PHRASES:
            if start >= at:
                counted += joined.count(" ", at, start)
                at = start
                place = counted
            else:
                place = joined.count(" ", 0, start)
            starts.append(place)
            base.add(BASE_PHRASES[phrase])
        else:
            labels.add(NOTICE_PHRASES[phrase])
        score = max(score, 0.9 if phrase in STRONG else 0.6)
    expressions, allowed = [], None
    for m in _TAG_LINE.finditer(text) if tagged else ():
        result = evaluate(m[1])
        expressions.append(m[1].strip())
        if result is None:
            labels.add("unparsed")
            score = max(score, 0.3)
        else:
            labels.update(result[0])
            allowed = result[1] if allowed is None else allowed and result[1]
            score = 1.0
    return (
        len(words),
        len(starts),
        min(starts) if starts else None,
        max(starts) if starts else None,
        sorted(base),
        sorted(base | labels),
        expressions,
        allowed,
        score,
    )


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: places of base phrases, labels, tag expressions and evidence."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = source.schema["doc_id"].dataType.simpleString()
    fields = [
        ("n_words", pa.int64()),
        ("n_base", pa.int64()),
        ("first_word", pa.int64()),
        ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())),
        ("labels", pa.list_(pa.string())),
        ("expressions", pa.list_(pa.string())),
        ("closed_use", pa.bool_()),
        ("score", pa.float64()),
    ]

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        automaton = _automaton()
        rows = [scan(t, automaton) for t in batch.column(1).to_pylist()]
        columns = [pa.array([r[i] for r in rows], t) for i, (_, t) in enumerate(fields)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *(n for n, _ in fields)])

    return map_texts(
        source,
        "text",
        run,
        f"doc_id {kind}, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels array<string>, "
        "labels array<string>, expressions array<string>, closed_use boolean, score double",
    )
