"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.llm import (
    decontaminate, html_text, licenses, minhash, mixing, periods, quality, simhash, spelling, substring, toxicity, urls, wavelet,
)
from clientlens.llm.common import read
from clientlens.session import scratch_path


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(read(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.classify(docs).select(F.col("row.doc_id").alias("doc_id"), "votes", "posterior", "score", "keep")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")).drop("tid")


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages"))


def op7_simhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    sizes = mixing.word_counts(docs).select(F.col("row.doc_id").alias("id"), F.col("row.source").alias("source"), "size")
    return mixing.mix(sizes).select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                                    (F.col("copies") * F.col("size")).alias("taken"))


def op9_minhash_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.neighbour_fingerprints(read(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.remove_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variant_groups(spelling.word_counts(read(spark, sf_dir, "documents"), slips=True))


def op12_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token_shards")
    wavelet.write_shards(read(spark, sf_dir, "documents"), path, public_tokenizer("word_bpe_49k.json"), end_id=1)
    return wavelet.read_documents(spark, path)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periods.with_loops(read(spark, sf_dir, "documents").select("doc_id", "text"))
    best = F.col("best")
    line = F.concat_ws("", F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    return periods.periodic_runs(docs).withColumn("best", periods.best_run(F.col("runs"))).select(
        F.col("row.doc_id").alias("doc_id"), F.size("runs").cast("long").alias("n_runs"), *(best[c].alias(c) for c in ("start", "length", "period")),
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(line, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


def public_tokenizer(name: str) -> str:
    """The JSON of a public tokenizer file, read on the driver and sent with the job."""
    import public_tokenizers

    with open(public_tokenizers.path(name), encoding="utf-8") as f:
        return f.read()


QUERIES = {f.__name__: f for f in (
    op1_license_scan, op2_toxicity, op3_quality, op4_html_text, op5_decontaminate, op6_url_filter,
    op7_simhash_neardup, op8_mix_sources, op9_minhash_fingerprint, op10_substring_dedup,
    op11_spelling_variants, op12_token_shards, op13_periodic_runs)}

#: From texts to tokens of templates, values of placeholders and plain words, for documents and items alike.
_TEMPLATES = r"""
        raw AS (SELECT 'd' AS side, row_number() OVER () AS n, id, text FROM (SELECT DISTINCT doc_id AS id, text FROM documents)
                UNION ALL SELECT 'b', row_number() OVER (), id, text
                FROM (SELECT DISTINCT item_id AS id, text FROM benchmark WHERE item_id IS NOT NULL)),
        spaced AS (SELECT side, n, id, regexp_replace(translate(coalesce(text, ''), chr(1) || chr(2) || chr(3), '   '), '{unspaced}', ' \1 ', 'g') AS text FROM raw),
        a AS (SELECT side, n, id, regexp_replace(text, '{space}', ' ', 'g') AS text FROM spaced),
        b AS (SELECT *, regexp_replace(text, '{name}', '\1 ' || chr(2) || ' ', 'g') AS named FROM a),
        c AS (SELECT *, lower(regexp_replace(named, '{number}', ' ' || chr(1) || ' ', 'g')) AS low FROM b),
        t AS (SELECT side, n, id, regexp_extract_all(lower(text), '{word}') AS words,
                     regexp_extract_all(regexp_replace(low, '{unit}', '\1 ' || chr(3) || ' \3', 'g'), '[\p{{L}}\p{{M}}\x01-\x03]+') AS tokens,
                     regexp_extract_all(named, '{number}') AS numbers,
                     list_transform(regexp_extract_all(text, '{name}', 2), lambda x: lower(x)) AS names,
                     regexp_extract_all(low, '{unit}', 2) AS units FROM c)""".format(
    name=decontaminate.NAME, number=decontaminate.NUMBER, unit=decontaminate.UNIT.replace(decontaminate.NUMBER_MARK, r"\x01"),
    word=decontaminate.WORD, space=decontaminate.SPACE, unspaced=decontaminate.UNSPACED.replace("{Is", "{"))

SQL: dict[str, str] = {
    "op5_decontaminate": "WITH" + _TEMPLATES + r""",
        toks AS (SELECT side, n, i AS pos, tokens[i] AS tok, numbers, names, units FROM t, unnest(range(1, len(tokens) + 1)) AS u(i)),
        slots AS (SELECT side, n, pos, ascii(tok) AS kind,
                         CASE ascii(tok) WHEN 1 THEN numbers[k] WHEN 2 THEN names[k] ELSE units[k] END AS value
                  FROM (SELECT *, row_number() OVER (PARTITION BY side, n, tok ORDER BY pos) AS k FROM toks
                        WHERE tok IN (chr(1), chr(2), chr(3)))),
        -- templates: five tokens; the item's with three literal ones or more
        w AS (SELECT side, n, id, i AS pos, array_to_string(list_slice(tokens, i, i + 4), ' ') AS k,
                     len(list_filter(list_slice(tokens, i, i + 4), lambda x: x NOT IN (chr(1), chr(2), chr(3)))) AS literal
              FROM t, unnest(range(1, len(tokens) - 3)) AS u(i)),
        wanted AS (SELECT n AS bn, id AS item_id, pos AS ipos, k FROM w WHERE side = 'b' AND literal >= 3),
        pairs AS (SELECT d.n AS dn, bn, ipos, d.pos - ipos AS shift FROM w d JOIN wanted USING (k) WHERE d.side = 'd'),
        filled AS (SELECT DISTINCT dn, bn, shift, s.pos, s.kind, s.value, f.value AS other
                   FROM pairs JOIN slots s ON s.side = 'b' AND s.n = bn AND s.pos BETWEEN ipos AND ipos + 4
                   JOIN slots f ON f.side = 'd' AND f.n = dn AND f.pos = s.pos + shift),
        bad AS (SELECT dn, bn, shift, pos FROM filled
                WINDOW v AS (PARTITION BY dn, bn, shift, kind, value), o AS (PARTITION BY dn, bn, shift, kind, other)
                QUALIFY min(other) OVER v <> max(other) OVER v OR min(value) OVER o <> max(value) OVER o),
        good AS (SELECT dn, bn, ipos FROM pairs p WHERE NOT EXISTS (
                 SELECT 1 FROM bad x WHERE x.dn = p.dn AND x.bn = p.bn AND x.shift = p.shift AND x.pos BETWEEN p.ipos AND p.ipos + 4)),
        -- plain words: where each token of an item lies among its words, by characters
        tc AS (SELECT n, pos, sum(len) OVER (PARTITION BY n ORDER BY pos) AS stop, len FROM (
               SELECT k.n, k.pos, length(replace(coalesce(value, tok), ' ', '')) AS len
               FROM toks k LEFT JOIN slots s ON s.side = 'b' AND s.n = k.n AND s.pos = k.pos WHERE k.side = 'b')),
        wc AS (SELECT n, i AS pos, length(words[i]) AS len, sum(length(words[i])) OVER (PARTITION BY n ORDER BY i) AS stop
               FROM t, unnest(range(1, len(words) + 1)) AS u(i) WHERE side = 'b'),
        place AS (SELECT tc.n, tc.pos, min(wc.pos) AS first, max(wc.pos) AS last FROM tc JOIN wc
                  ON tc.n = wc.n AND wc.stop > tc.stop - tc.len AND wc.stop - wc.len < tc.stop GROUP BY ALL),
        whole AS (SELECT n AS bn, len(words) AS m FROM t WHERE side = 'b' AND len(words) > 0 AND n NOT IN (SELECT bn FROM wanted)),
        spans AS (SELECT bn, ipos, x.first, y.last - x.first + 1 AS m FROM wanted
                  JOIN place x ON x.n = bn AND x.pos = ipos JOIN place y ON y.n = bn AND y.pos = ipos + 4
                  UNION ALL SELECT bn, 0, 1, m FROM whole),
        sized AS (SELECT *, CASE WHEN m >= 5 THEN 5 WHEN m >= 2 THEN 2 ELSE 1 END AS size FROM spans),
        parts AS (SELECT bn, ipos, size, i AS pos, m - size + 1 AS need FROM sized, unnest(range(first, first + m - size + 1)) AS u(i)),
        p AS (SELECT side, n, size, i AS pos, array_to_string(list_slice(words, i, i + size - 1), ' ') AS k
              FROM t, unnest([5, 2, 1]) AS z(size), unnest(range(1, len(words) - size + 2)) AS u(i)
              WHERE side = 'b' OR size > 1 OR len(words) = 1),
        met AS (SELECT DISTINCT d.n AS dn, b.n AS bn, size, b.pos, d.pos - b.pos AS shift
                FROM p d JOIN p b USING (size, k) JOIN (SELECT DISTINCT bn, size, pos FROM parts) s ON s.bn = b.n AND s.size = d.size AND s.pos = b.pos
                WHERE d.side = 'd' AND b.side = 'b'),
        same AS (SELECT dn, bn, ipos FROM met JOIN parts USING (bn, size, pos) GROUP BY dn, bn, shift, ipos, need HAVING count(*) = need),
        found AS (SELECT dn, bn, count(DISTINCT ipos) AS n_windows FROM (FROM good UNION ALL FROM same) GROUP BY ALL),
        total AS (SELECT bn, count(*) AS total FROM (SELECT bn FROM wanted UNION ALL SELECT bn FROM whole) GROUP BY bn)
        SELECT d.id AS doc_id, b.id AS item_id, max(n_windows) AS n_windows, max(n_windows / total) AS share
        FROM found JOIN total USING (bn) JOIN t d ON d.side = 'd' AND d.n = dn JOIN t b ON b.side = 'b' AND b.n = bn
        WHERE n_windows / total >= 0.4 GROUP BY dn, d.id, b.id""",
    "op6_url_filter": r"""
        WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
                   FROM pages),
        p AS (SELECT row_number() OVER () AS n, page_id,
                     translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                     regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
        r(h, s, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
                              ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
        f AS (SELECT n, h || s AS rule, v FROM p JOIN r
                  ON (p.host = r.h OR suffix(p.host, '.' || r.h)) AND starts_with(p.path, r.s)
              QUALIFY row_number() OVER (PARTITION BY n ORDER BY length(h || s) DESC) = 1)
        SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM p LEFT JOIN f USING (n)""",
    "op10_substring_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        wins AS (SELECT doc_id, i, array_to_string(list_slice(w, i, i + 19), ' ') AS k
                 FROM n, unnest(range(1, len(w) - 18)) AS t(i)),
        again AS (SELECT doc_id, i FROM wins QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
        gone AS (SELECT DISTINCT doc_id, p FROM again, unnest(range(i, i + 20)) AS t(p)),
        words AS (SELECT doc_id, p, w[p] AS word FROM n, unnest(range(1, len(w) + 1)) AS t(p)),
        kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n_kept
                 FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
        SELECT n.doc_id, len(w) AS n_words, len(w) - coalesce(n_kept, 0) AS n_removed,
               sha256(coalesce(kept, '')) AS kept_sha256
        FROM n LEFT JOIN kept USING (doc_id)""",
}
