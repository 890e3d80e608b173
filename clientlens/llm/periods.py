"""Periodic runs of words, found from Lyndon roots.

A run is a maximal stretch of words with a smallest period q. By the runs
theorem its Lyndon root is, under one of the two orders of the words, the
longest Lyndon word that starts at the root's place. So, for each document:

1. words become numbers, and stretches that cannot hold a run are left out:
   in a run of ``max(SHORTEST, REPEATS * q)`` words each run of GRAM words
   starts again q words on, so a place whose GRAM words the document has only
   once is in no run;
2. phase one of Baier's suffix sorter groups the places of a stretch by the
   words that their suffixes start with, from the greatest group down; when
   no group is left, the length of a place's group context is its Lyndon
   array value. This is done under the order of the numbers and its reverse;
3. a root with the same root after it is extended to both sides by the longest
   common extensions of its place and the place one period on. Words
   are compared themselves, so the runs are exact.

Everything happens inside one document, so nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, groupby
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import as_text, pieces

SHORTEST = 24
REPEATS = 3
#: Words of a place that must occur again in the document: with L >= 24 and
#: L >= 3q, the L - 7 places of a run hold each of its 8-word rows twice.
GRAM = 8

Run = tuple[int, int, int]


def lyndon_array(text: list[int]) -> list[int]:
    """The length of the longest Lyndon word from each place: Baier's phase one.

    Groups are linked from the lowest to the greatest; the greatest group not
    yet seen is taken, and the next places to the left that are in lower
    groups move to new groups right above their own: their contexts grow by
    the taken group's, once for each place of it that points to them.
    """
    n = len(text)
    number = {c: g for g, c in enumerate(sorted(set(text)))}
    group = [number[c] for c in text]
    members: list[list[int]] = [[] for _ in number]
    for i, g in enumerate(group):
        members[g].append(i)
    context = [1] * len(number)
    below = list(range(-1, len(number) - 1))
    above = list(range(1, len(number) + 1))
    # places of groups not yet taken, linked; place i is at i + 1
    left, right = list(range(-1, n + 1)), list(range(1, n + 3))
    out = [0] * n
    taken = len(number) - 1
    while taken >= 0:
        size, pointed = context[taken], []
        for i in members[taken]:
            if group[i] == taken:
                out[i] = size
                before, after = left[i + 1], right[i + 1]
                right[before] = after
                left[after] = before
                pointed.append(before - 1)
        members[taken] = []
        moved: dict[tuple[int, int], list[int]] = {}
        for i, same in groupby(pointed):
            if i >= 0:
                moved.setdefault((-sum(1 for _ in same), group[i]), []).append(i)
        for times, old in sorted(moved):
            new = len(members)
            members.append(moved[times, old])
            context.append(context[old] - times * size)
            up = above[old]
            below.append(old)
            above.append(up)
            above[old] = new
            below[up] = new  # the taken group or one between it and the old one
            for i in moved[times, old]:
                group[i] = new
        taken = below[taken]
    return out


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """The length of the longest common prefix."""
    n, at, step = min(len(a), len(b)), 0, 64
    while at < n:
        end = min(at + step, n)
        other = a[at:end] != b[at:end]
        if other.any():
            return at + int(other.argmax())
        at, step = end, 2 * step
    return n


def runs_of(words: np.ndarray, shortest: int = SHORTEST, repeats: int = REPEATS) -> list[Run]:
    """(start, length, smallest period) of the maximal runs of a sequence of
    numbers that have ``shortest`` places and ``repeats`` periods (2 or more)
    at least, by start and period."""
    n, found = len(words), set()
    if n < repeats:
        return []
    for order in (words, -words):
        period = np.array(lyndon_array(order.tolist()), np.int64)
        at = np.arange(n)
        then = np.minimum(at + period, n - 1)
        root = (at + period < n) & (repeats * period <= n) & (words[then] == words)
        if repeats > 2:  # the leftmost root has another one after it, whole
            root &= period[then] == period
        at = np.flatnonzero(root)
        at = at[np.argsort(period[at], kind="stable")]
        lengths = period[at]
        ends = np.append(np.flatnonzero(np.diff(lengths)) + 1, len(at)) if len(at) else []
        begin = 0
        for end in map(int, ends):
            p, same, k = int(lengths[begin]), at[begin:end], 0
            while k < len(same):
                i = int(same[k])
                stop = i + p + _agree(words[i:], words[i + p:])
                start = i - _agree(words[:i][::-1], words[:i + p][::-1])
                if stop - start >= max(shortest, repeats * p):
                    found.add((start, stop - start, p))
                k = max(k + 1, int(np.searchsorted(same, stop - 2 * p + 1)))  # the run's other roots
            begin = end
    return sorted(found)


def _stretches(words: np.ndarray, text: np.ndarray) -> list[tuple[int, int]]:
    """(first, end) of the stretches of SHORTEST words or more of one text whose
    rows of GRAM words all occur twice in the text (a hash collision only adds some)."""
    n = len(words) - GRAM + 1
    if n <= SHORTEST - GRAM:
        return []
    mixed = (words.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(32)
    rolled = np.zeros(n, np.uint64)
    for j in range(GRAM):
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
        rolled += mixed[j:n + j]
    rolled ^= rolled >> np.uint64(31)
    rolled += text[:n].astype(np.uint64) * np.uint64(0x94D049BB133111EB)
    inside = text[:n] == text[GRAM - 1:]
    order = np.argsort(rolled)
    same = rolled[order[1:]] == rolled[order[:-1]]
    again = np.zeros(n + 1, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    again[:n] &= inside
    step = np.diff(again.astype(np.int8), prepend=0)
    first, end = np.flatnonzero(step == 1), np.flatnonzero(step == -1)
    long = end - first > SHORTEST - GRAM
    return list(zip(first[long].tolist(), (end[long] + GRAM - 1).tolist(), strict=True))


def _find(texts: list[list[bytes]]) -> list[list[Run]]:
    """The runs of each text's words."""
    counts = np.fromiter(map(len, texts), np.int64, len(texts))
    numbers = {w: i for i, w in enumerate(dict.fromkeys(chain.from_iterable(texts)))}
    words = np.fromiter(map(numbers.__getitem__, chain.from_iterable(texts)), np.int64, int(counts.sum()))
    begin = np.cumsum(counts) - counts
    text = np.repeat(np.arange(len(texts)), counts)
    out: list[list[Run]] = [[] for _ in texts]
    for first, end in _stretches(words, text):
        k = int(text[first])
        shift = first - int(begin[k])
        out[k] += [(start + shift, length, period) for start, length, period in runs_of(words[first:end])]
    return out


def _run_rows(batches: Iterator[pa.RecordBatch], text_col: str) -> Iterator[pa.RecordBatch]:
    """(row) -> (row, n_words, runs, collapsed)."""
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    for batch in batches:
        for part, texts in pieces(batch, 0, field=text_col):
            texts = [t.split() for t in texts]
            totals = list(map(len, texts))
            found = _find(texts)
            for words, runs in zip(texts, found, strict=True):
                if runs:
                    step = np.zeros(len(words) + 1, np.int64)
                    for start, length, period in runs:
                        step[start + period] += 1
                        step[start + length] -= 1
                    words[:] = [w for w, drop in zip(words, np.cumsum(step).tolist(), strict=False) if not drop]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(totals, pa.int64()),
                 pa.array([[dict(zip(("start", "length", "period"), r, strict=True)) for r in runs] for runs in found], pa.list_(run)),
                 as_text([b" ".join(words) for words in texts])], names=["row", "n_words", "runs", "collapsed"])


def periodic_runs(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Documents -> (row: all their columns as a struct, n_words, runs: array of
    (start, length, period) by start and period, collapsed: the words joined
    by one space, of each run only the first period).

    Words are runs of other characters than space and U+0009 to U+000D,
    numbered from 0. A run has SHORTEST words and REPEATS of its smallest
    period at least; overlapping runs all count, and a word goes if any run
    has it after its first period. A null or empty text has no words, no runs
    and an empty ``collapsed``; repeated rows, null ids and ids that several
    rows share are rows of their own; no rows: no rows.
    """
    row = docs.select(F.struct("*").alias("row"))
    kind = row.schema["row"].dataType.simpleString()
    return row.mapInArrow(lambda it: _run_rows(it, text_col),
                          f"row {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string")


def best_run(runs):
    """Column: the run of greatest length / period, the first of equals; null if none."""
    return F.aggregate(runs, F.get(runs, 0), lambda best, r: F.when(
        r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best))


def _loop_rows(batches: Iterator[pa.RecordBatch], id_at: int, text_at: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part, texts in pieces(batch, text_at):
            for i, (did, text) in enumerate(zip(part.column(id_at).to_pylist(), texts, strict=True)):
                h = crc32(b"" if did is None else b"%d" % did)
                if h % 10 == 0 and (words := text.split()):
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[i] = b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])
            columns = part.columns
            columns[text_at] = as_text(texts)
            yield pa.RecordBatch.from_arrays(columns, names=part.schema.names)


def with_loops(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with loops planted by a rule of their id alone: every tenth
    id's words from one place on repeat with one period (whitespace of such a
    text becomes one space). A null id counts as the empty text."""
    at = docs.columns.index(id_col), docs.columns.index(text_col)
    return docs.mapInArrow(lambda it: _loop_rows(it, *at), docs.schema)
