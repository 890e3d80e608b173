"""Spelling variants: words one edit apart, found in a relational trie.

The trie is a table of edges (node, first, label, child, word): a node is the
hash of a prefix, and chains without a branch are one edge, so a walk has as
many steps as branches. Words are walked from both ends, as prefixes and as
reversed words: of two words one edit apart, either the first half or the
rest of a word is whole, so a walk may start below its untouched half, where
a node has few children.

The frontier is a table of states (word, position, node, edits). Each level
joins it with the edges: a state without an edit meets all children of its
node and goes on along a label that agrees, or differs by one inserted,
deleted or replaced character; a state with an edit meets only the child whose
label goes on as the word does. States that end with the word at the end of another
word are neighbours.

Nothing is quadratic in words that share a prefix: a state makes at most one
row per child, one for each character that can follow.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import LOWER, cut, pieces

LEAST_LENGTH = 6
LEAST_COUNT = 5
#: A form's count must be so many times the word's.
FORM = 5
#: Trie nodes start at this depth: half of the shortest word is never edited.
ROOT = LEAST_LENGTH // 2
#: A deleted code point for one in so many runs (see ``with_slips``).
SLIP = 199
#: Words that a task counts before it hands them on.
HELD = 400_000
_RUN = re.compile("[a-zÀ-ÿ]{%d,}" % LEAST_LENGTH)


def slipped(prefix: bytes, run: str) -> str:
    """The run, without one code point if the crc32 of the document's prefix
    and the run says so."""
    h = crc32(run.encode(), crc32(prefix))
    if h % SLIP:
        return run
    k = h % len(run)
    return run[:k] + run[k + 1:]


def _count_words(batches: Iterator[pa.RecordBatch], slips: bool) -> Iterator[pa.RecordBatch]:
    """(id, text) -> (word, n), a word once for each part of a task at most."""
    total: Counter[str] = Counter()

    def hand_on() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"])

    for batch in batches:
        for part, texts in pieces(batch, 1):
            for did, text in zip(part.column(0).to_pylist(), texts, strict=True):
                prefix = b":" if did is None else b"%d:" % did
                for run, n in Counter(_RUN.findall(text.translate(LOWER).decode("utf-8", "replace"))).items():
                    if slips:
                        run = slipped(prefix, run)
                        if len(run) < LEAST_LENGTH:
                            continue
                    total[run] += n
            if len(total) >= HELD:
                yield hand_on()
                total.clear()
    if total:
        yield hand_on()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slips: bool = False) -> DataFrame:
    """(word, n): runs of A-Z, a-z and U+00C0 to U+00FF in small letters (A-Z
    alone change), of LEAST_LENGTH code points and LEAST_COUNT occurrences or more.
    ``slips``: some runs lose a code point first, by a rule of id and run (a
    null id counts as the empty text). Null and empty texts have no words."""
    counts = docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(
        lambda it: _count_words(it, slips), "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST_COUNT)


def _walks(words: DataFrame) -> DataFrame:
    """(word) -> (word, walk, back, whole): each word forwards and backwards,
    and the length of the part that this walk's edits leave whole."""
    half = F.floor(F.length("word") / 2).cast("int")
    ways = F.array(F.struct(F.col("word").alias("walk"), F.lit(False).alias("back"), half.alias("whole")),
                   F.struct(F.reverse("word").alias("walk"), F.lit(True).alias("back"), (F.length("word") - half).alias("whole")))
    return words.select("word", F.explode(ways).alias("w")).select("word", "w.*")


def _node(walk: Column, depth: Column, back: Column) -> Column:
    return F.xxhash64(F.substring(walk, F.lit(1), depth), back)


def _stops(walks: DataFrame) -> DataFrame:
    """(word, walk, back, whole, stops: depths of the nodes on the word's way
    that are the root, its end, or have another way on)."""
    depths = F.sequence(F.lit(ROOT), F.length("walk"))
    nodes = walks.select("word", "back", F.posexplode(F.transform(depths, lambda d: _node(F.col("walk"), d, F.col("back")))).alias("k", "node"))
    passed = nodes.groupBy("node").agg(F.count("*").alias("words"))
    counts = nodes.join(passed, "node").groupBy("word", "back").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("k", "words"))), lambda x: x["words"]).alias("counts"))
    last = F.size("counts") - 1
    keep = F.filter(F.sequence(F.lit(0), last), lambda k: (k == 0) | (k == last) | (F.get("counts", k) != F.get("counts", k + 1)))
    return walks.join(counts.select("word", "back", F.transform(keep, lambda k: k + ROOT).alias("stops")), ["word", "back"])


def _edges(walks: DataFrame) -> DataFrame:
    """(node, first, label, child, end): ``end`` is the word that ends at the child, if one does."""
    walk, back = F.col("walk"), F.col("back")
    steps = F.zip_with("stops", F.slice("stops", F.lit(2), F.size("stops")), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    edges = walks.select("word", "walk", "back", F.explode(F.filter(steps, lambda s: s["b"].isNotNull())).alias("s"))
    edges = edges.select(_node(walk, F.col("s.a"), back).alias("node"), F.substring(walk, F.col("s.a") + 1, F.col("s.b") - F.col("s.a")).alias("label"),
                         _node(walk, F.col("s.b"), back).alias("child"), F.when(F.col("s.b") == F.length(walk), F.col("word")).alias("end"))
    return edges.groupBy("node", "label", "child").agg(F.max("end").alias("end")).select(
        "node", F.substring("label", 1, 1).alias("first"), "label", "child", "end")


def _step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """The states of the next level, with the word that ends where they are."""
    size = F.length("label")

    def ahead(more: int) -> Column:
        return F.substring("walk", F.col("pos") + 1, size + more)

    def after(more: int, edits: int) -> Column:
        return F.struct((F.col("pos") + size + more).alias("pos"), F.lit(edits).alias("edits"))

    fresh = frontier.where("edits = 0").join(edges.drop("first"), "node")
    ways = [F.when((F.length(ahead(more)) == size + more) & (F.levenshtein(ahead(more), "label", 1) == 1), after(more, 1)) for more in (-1, 0, 1)]
    ways.append(F.when(ahead(0) == F.col("label"), after(0, 0)))
    fresh = fresh.select("word", "walk", F.col("child").alias("node"), "end", F.explode(F.filter(F.array(*ways), F.isnotnull)).alias("x")).select(
        "word", "walk", "x.pos", "node", "x.edits", "end")
    edited = frontier.where("edits = 1 and pos < length(walk)").withColumn("first", F.substring("walk", F.col("pos") + 1, F.lit(1)))
    edited = edited.join(edges, ["node", "first"]).where(ahead(0) == F.col("label")).select(
        "word", "walk", (F.col("pos") + size).alias("pos"), F.col("child").alias("node"), "edits", "end")
    return fresh.unionByName(edited)


def neighbours(words: DataFrame) -> DataFrame:
    """``words`` (word: distinct, of LEAST_LENGTH code points or more) ->
    (word, near): all ordered pairs that differ by exactly one inserted,
    deleted or replaced code point.

    One job per level of the trie's branches, each checkpointed in the shared
    folder. Words without a neighbour have no row; no words: no rows.
    """
    walks = cut(_stops(_walks(words.select("word"))))
    edges = cut(_edges(walks))
    start = F.array_max(F.filter("stops", lambda d: d <= F.col("whole")))
    frontier = walks.select("word", "walk", start.alias("pos"), _node(F.col("walk"), start, F.col("back")).alias("node"), F.lit(0).alias("edits"))
    found: DataFrame | None = None
    while True:
        states = cut(_step(frontier, edges))
        if states.isEmpty():
            break
        ended = states.where((F.col("edits") == 1) & (F.col("pos") == F.length("walk")) & (F.levenshtein("word", "end", 1) == 1))
        ended = ended.select("word", F.col("end").alias("near"))
        found = ended if found is None else found.unionByName(ended)
        frontier = states.drop("end")
    if found is None:
        return words.select("word", F.col("word").alias("near")).where("false")
    return found.distinct()


def _roots(forms: DataFrame, longest: int) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, by doubling.
    A form is FORM times as frequent, so ``longest`` steps follow from the greatest count."""
    roots = cut(forms.select("word", F.col("form").alias("root")))
    for _ in range(max(0, math.ceil(math.log2(max(1, longest))))):
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("on"))
        roots = cut(roots.join(on, "root", "left").select("word", F.coalesce("on", "root").alias("root")))
    return roots


def variant_groups(counts: DataFrame) -> DataFrame:
    """(word, n) -> (word, form, root, n, n_near, form_n).

    ``form`` is the near word of largest n (the first in code-point order of
    equals) if that is FORM times the word's n, else null; ``root`` is where
    following forms ends, the word itself if it has none. No words: no rows.
    """
    counts = cut(counts.select("word", "n"))
    near = neighbours(counts).join(counts.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    good = -F.col("best.less") >= FORM * F.col("n")
    out = cut(counts.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n")))
    largest = counts.agg(F.max("n")).first()[0] or 0
    longest = 1 + int(math.log(max(1, largest / LEAST_COUNT), FORM)) + 1
    roots = _roots(out.where("form is not null").select("word", "form"), longest)
    return out.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
