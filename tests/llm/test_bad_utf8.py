"""Texts whose bytes are not UTF-8 crash no operator."""
from pyspark.sql import functions as F

from clientlens.llm import decontaminate, html_text, licenses, minhash, mixing, quality, simhash, substring


def test_bytes_that_are_no_text(spark):
    rows = [(i, bytes([255, 32, 65, 254]) * (15 + i), "s") for i in range(6)] + [(9, b"plain words here", "s")]
    docs = spark.createDataFrame(rows, "doc_id long, raw binary, source string").select("doc_id", F.col("raw").cast("string").alias("text"), "source")
    path_docs = docs.select("doc_id", "text")
    assert len(simhash.simhash_components(path_docs).collect()) == 7
    assert substring.remove_repeats(path_docs).select("n_words", "n_removed").count() == 7
    assert minhash.neighbour_fingerprints(path_docs).select("near_next").count() == 7
    assert quality.classify(path_docs).select("keep").count() == 7
    assert licenses.scan_licenses(path_docs).count() == 7
    assert mixing.word_counts(docs).select("size").count() == 7
    assert html_text.extract_text(docs.select(F.col("doc_id").alias("page_id"), F.lit("u").alias("url"), F.col("text").alias("html"))).count() == 7
    items = spark.createDataFrame([(1, "a b c d e f g")], "item_id long, text string")
    assert decontaminate.leaks(path_docs, items).count() == 0
