"""License scans: one Aho-Corasick pass over the words of a text finds notice
phrases and identifier tags; the expressions after tags are parsed with a
shunting yard and evaluated (AND, OR, WITH)."""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import pieces

# Phrases of the contract and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases and their labels.
NOTICE_PHRASES = {
    "gnu affero general public license": "agpl",
    "gnu general public license": "gpl",
    "gnu lesser general public license": "lgpl",
    "mozilla public license": "mpl",
    "eclipse public license": "epl",
    "creative commons attribution": "cc-by",
    "creative commons zero": "cc0",
    "bsd 2 clause license": "bsd-2-clause",
    "bsd 3 clause license": "bsd-3-clause",
    "boost software license": "bsl",
    "isc license": "isc",
    "the unlicense": "unlicense",
    "dedicated to the public domain": "public-domain",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "all rights reserved": "proprietary",
}
# Identifier tags, as words.
TAGS = ("spdx license identifier", "license expression")
TAG_LINE = re.compile(rb"(?:spdx-license-identifier|license-expression)[ \t]*:[ \t]*([^\r\n]*)", re.I)
# Identifiers that have a label of their own.
ALIASES = {"apache-2.0": "apache-2", "cc-by-nc-4.0": "cc-by-nc", "cc-by-nc-3.0": "cc-by-nc", "mit-0": "mit"}
# How far a family of licenses restricts use, by the start of its label.
RESTRICTION = {
    "agpl": 0.8, "apache": 0.1, "bsd": 0.1, "bsl": 0.1, "cc-by": 0.2, "cc-by-nc": 0.9, "cc-by-nd": 0.9, "cc0": 0.0,
    "epl": 0.5, "gpl": 0.7, "isc": 0.1, "lgpl": 0.5, "mit": 0.1, "mpl": 0.4, "proprietary": 1.0, "public-domain": 0.0,
    "unlicense": 0.0,
}
UNKNOWN = 0.6
BINDS = {"or": 1, "and": 2, "with": 3}
TOKEN = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
#: Bytes that separate words become spaces, A-Z becomes a-z.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def restriction(label: str) -> float:
    best = max((k for k in RESTRICTION if label.startswith(k)), key=len, default=None)
    return UNKNOWN if best is None else RESTRICTION[best]


def to_postfix(expression: str) -> list[str] | None:
    """Shunting yard; None if the expression is not well formed. Text after a
    complete expression (a comment's end, say) is left out."""
    out: list[str] = []
    operators: list[str] = []
    operand = False  # whether the last token ended an operand
    for token in TOKEN.findall(expression):
        word = token.lower()
        if word in BINDS:
            if not operand:
                return None
            while operators and operators[-1] != "(" and BINDS[operators[-1]] >= BINDS[word]:
                out.append(operators.pop())
            operators.append(word)
            operand = False
        elif token == "(":
            if operand:
                break
            operators.append(token)
        elif token == ")":
            if not operand or "(" not in operators:
                break
            while operators[-1] != "(":
                out.append(operators.pop())
            operators.pop()
        elif operand:
            break
        else:
            out.append(word)
            operand = True
    if not operand or "(" in operators:
        return None
    return out + operators[::-1]


def evaluate(postfix: list[str]) -> tuple[frozenset[str], float]:
    """(labels, restriction): AND binds to both sides, OR lets the user choose
    the freer one, WITH an exception halves the restriction."""
    stack: list[tuple[frozenset[str], float, str]] = []
    for token in postfix:
        if token not in BINDS:
            label = ALIASES.get(token, token)
            stack.append((frozenset([label]), restriction(label), token))
            continue
        (left, a, _), (right, b, _) = stack[-2], stack[-1]
        del stack[-2:]
        if token == "with":
            stack.append((left, a / 2, ""))
        else:
            stack.append((left | right, max(a, b) if token == "and" else min(a, b), ""))
    return stack[0][:2]


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    for kind, phrases in (("notice", NOTICE_PHRASES), ("base", BASE_PHRASES), ("tag", dict.fromkeys(TAGS))):
        for phrase, label in phrases.items():
            found.add_word(f" {phrase} ", (kind, label, len(phrase) + 2))
    found.make_automaton()
    return found


def scan(text: bytes, matcher: ahocorasick.Automaton) -> tuple:
    """(n_words, n_base, first_word, last_word, base_labels, labels, score,
    restriction) of a text."""
    words = text.translate(WORDS).split()
    plain = (b" " + b" ".join(words) + b" ").decode("latin-1")
    starts: list[int] = []
    base: set[str] = set()
    labels: set[str] = set()
    notices, tags, most = 0, 0, 0.0
    at = index = 0  # words before position ``at``; starts of one length come in order
    for end, (kind, label, length) in matcher.iter(plain):
        if kind == "tag":
            tags = 1
            continue
        labels.add(label)
        most = max(most, restriction(label))
        notices += 1
        if kind == "base":
            base.add(label)
            start = end + 1 - length
            index += plain.count(" ", at, start) if start >= at else -plain.count(" ", start, at)
            at = start
            starts.append(index)
    if tags:
        tags = 0
        for line in TAG_LINE.findall(text):
            postfix = to_postfix(line.decode("utf-8", "replace"))
            if postfix:
                found, held = evaluate(postfix)
                labels |= found
                most = max(most, held)
                tags += 1
    score = 1.0 - 0.5 ** min(notices, 50) * 0.1 ** min(tags, 15)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, most)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, restriction.

    Words: A-Z lower-cased, runs of digits, a-z and non-ASCII characters.
    ``base_*`` and word places come from the base phrases; ``labels`` adds
    further notices and the identifiers of SPDX expressions. ``score``: how
    sure it is that the text states a license (0: nothing found);
    ``restriction``: the most that a found statement restricts use, after its
    expression is evaluated. Null text is empty: no words, no labels, score 0.
    Ill-formed expressions give no label. Repeated rows and null ids come
    back as they are; no rows: no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()),
                        ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()),
                        ("score", pa.float64()), ("restriction", pa.float64())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = automaton()
        for batch in batches:
            for part, texts in pieces(batch, 1):
                columns = list(zip(*(scan(t, matcher) for t in texts), strict=True))
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(c, schema.field(i + 1).type) for i, c in enumerate(columns))], schema=schema)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(task, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                                 "base_labels string, labels string, score double, restriction double")
