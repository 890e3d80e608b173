"""URL filters as a sort-merge range join.

A host is turned round by its labels (``www.example.org`` to
``org.example.www.``), so a rule for a host and its subdomains covers an
interval of sorted keys. URLs are range-partitioned and sorted by key; each
task merges them with the sorted rules and keeps a stack of the rules whose
interval it is in. Intervals are nested or apart, so rules are pushed and
popped once per task. The path of a URL is held against the paths of the
rules on the stack.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rules that one pass holds in a task; longer lists take several passes.
PASS = 50_000


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str


# The rules of the contract.
RULES = (
    Rule("allow", "org", "/"),
    Rule("block", "example.org", "/es/"),
    Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"),
    Rule("block", "com", "/de/"),
)
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) of a URL; both empty for null or no ``://``."""
    cut_at = F.instr(url, "://")
    rest = F.when(cut_at > 0, F.substring(url, cut_at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def host_key(host: str) -> str:
    return "".join(f"{x}." for x in reversed(host.split(".")))


def _sweep(batches: Iterator[pa.RecordBatch], rules: list[tuple[str, Rule]]) -> Iterator[pa.RecordBatch]:
    """Rows (key, path, id, host, rule, verdict) sorted by key, merged with
    the rules sorted by key; a longer rule than the row's replaces it."""
    stack: list[tuple[str, list[Rule]]] = []
    at = 0
    for batch in batches:
        keys, paths, best, verdicts = (batch.column(i).to_pylist() for i in (0, 1, 4, 5))
        for i, (key, path) in enumerate(zip(keys, paths, strict=True)):
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            while at < len(rules) and rules[at][0] <= key:
                start, rule = rules[at]
                at += 1
                if key.startswith(start):
                    if stack and stack[-1][0] == start:
                        stack[-1][1].append(rule)
                    else:
                        stack.append((start, [rule]))
            fits = [r for _, own in stack for r in own if path.startswith(r.path)]
            if fits:
                longest = max(fits, key=lambda r: (len(r.host) + len(r.path), len(r.host)))
                if best[i] is None or len(longest.host) + len(longest.path) > len(best[i]):
                    best[i], verdicts[i] = longest.host + longest.path, longest.verdict
        yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(best, pa.string()), pa.array(verdicts, pa.string())],
                                         names=["key", "path", "id", "host", "rule", "verdict"])


def judge_urls(pages: DataFrame, rules: tuple[Rule, ...] = RULES, default: str = DEFAULT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict.

    A rule fits its host and all subdomains if the path starts with the
    rule's; the longest rule (host and path) wins, then the longer host, then
    the one listed first. No rule: null and ``default``. Null URLs and those
    without ``://`` have an empty host and path and fit no rule. Repeated rows
    and null ids come back as they are; no rows: no rows. Rules are a
    parameter, never a table that grows with the pages; a task holds ``PASS``
    of them at once and longer lists are swept in several passes over the
    same sorted rows.
    """
    host, path = url_parts(F.col(url_col))
    rows = pages.select(F.col(id_col).cast("long").alias("id"), host.alias("host"), path.alias("path"))
    key = F.concat(F.array_join(F.reverse(F.split("host", r"\.")), "."), F.lit("."))
    rows = (rows.select(key.alias("key"), "path", "id", "host", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
            .repartitionByRange("key", "path", "id").sortWithinPartitions("key", "path"))
    ordered = sorted(((host_key(r.host), r) for r in rules), key=lambda x: x[0])
    for i in range(0, len(ordered), PASS):
        part = ordered[i:i + PASS]
        rows = rows.mapInArrow(lambda it, part=part: _sweep(it, part), rows.schema)
    return rows.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")
