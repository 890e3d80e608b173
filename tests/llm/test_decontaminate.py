"""Template decontamination: planted passages and re-parameterised questions."""
import random

import duckdb

from clientlens.llm import decontaminate, queries

DOCS = "doc_id long, text string, tokens string, window long, item_id long"
ITEMS = "item_id long, text string, windows string, doc_id long"


def words(r, n):
    return " ".join(r.choice(["the", "of", *(f"wo{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(300))]) for _ in range(n))


def found(spark, docs, items, twin=True):
    """(document, item) pairs; the SQL twin must give the same rows (it is slow on a very long text)."""
    docs, items = spark.createDataFrame([(d, t, "t", 1, 2) for d, t in docs], DOCS), spark.createDataFrame([(i, t, "w", 3) for i, t in items], ITEMS)
    out = decontaminate.leaks(docs, items).drop("tid").collect()
    if not twin:
        return {(r.doc_id, r.item_id) for r in out}
    with duckdb.connect() as c:
        c.register("documents", docs.toArrow())
        c.register("benchmark", items.toArrow())
        names = ("doc_id", "item_id", "n_windows", "share")
        rows = c.sql(queries.SQL["op5_decontaminate"]).select(*names).fetchall()
    assert sorted(map(tuple, out), key=str) == sorted(rows, key=str)
    return {(r.doc_id, r.item_id) for r in out}


def test_planted_and_edited_passages(spark):
    r = random.Random(6)
    items = [(i, words(r, r.randint(15, 60)).capitalize() + ".") for i in range(20)]
    docs, want = [], set()
    for d in range(200):
        text = words(r, r.randint(0, 400))
        if d % 4 == 0:
            i, t = r.choice(items)
            if d % 8 == 0:
                t = t.upper().replace(" ", "\n", 3)
            if d % 12 == 0:
                parts = t.split()
                parts[len(parts) // 2] = "edited"
                t = " ".join(parts)
            text = f"{text} {t} {words(r, 20)}"
            want.add((d, i))
        docs.append((d, text))
    assert found(spark, docs, items) == want


QUESTION = "A train leaves with 120 people and, after Alice gives 12 apples to Bob, stops 5 km later; how many apples does Alice keep of 12?"


def test_reparameterised_question_needs_consistent_slots(spark):
    same = QUESTION.replace("120", "340").replace("12 ", "77 ").replace("12?", "77?").replace("Alice", "Carol").replace("Bob", "Dave").replace("5 km", "9 miles")
    mixed = QUESTION.replace("12 apples", "77 apples").replace("Alice gives", "Carol gives").replace("Alice keep", "Erin keep")
    other = "Some text about a train that leaves with 120 people and nothing else of the kind."
    docs = [(1, "intro. " + same + " outro"), (2, mixed), (3, other), (4, QUESTION), (5, QUESTION.lower().replace("alice", "x").replace("bob", "y"))]
    assert found(spark, docs, [(1, QUESTION)]) == {(1, 1), (2, 1), (4, 1), (5, 1)}


def test_a_conflict_cancels_only_its_own_windows(spark):
    docs = [(1, QUESTION.replace("12 apples", "77 apples")), (2, QUESTION.replace("120", "12")), (3, QUESTION.lower().replace("12 apples", "77 apples")),
            (4, "Give 3 to 4 and 3 to 3 then 4 to 5 and 9 to 1.")]
    assert found(spark, docs, [(1, QUESTION), (2, "Give 1 to 2 and 1 to 2 then 3 to 4 and 5 to 6.")]) >= {(1, 1), (2, 1), (3, 1)}


def test_items_of_one_word_meet_only_a_text_of_that_word(spark):
    docs = [(1, "Yes, of course."), (2, "yes"), (3, " YES! "), (4, "no"), (5, "yes yes"), (6, None)]
    assert found(spark, docs, [(1, "Yes."), (2, "Yes indeed.")]) == {(2, 1), (3, 1)}


def test_random_texts_agree_with_the_twin(spark):
    r = random.Random(12)
    vocabulary = ["Alice", "Bob", "the", "of", "12", "7", "3.5", "km", "dollars", "apples", "gives", "to", "and", "then,", "Mary Ann", "x9", "中国", "ön", "stops."]
    items = [(i, " ".join(r.choice(vocabulary) for _ in range(r.choice([1, 2, 3, 4, 5, 6, 12, 20])))) for i in range(40)]
    docs = []
    for d in range(150):
        parts = []
        for _ in range(r.randint(0, 4)):
            t = r.choice(items)[1].split()
            for _ in range(r.randint(0, 2)):
                t[r.randrange(len(t))] = r.choice(vocabulary)
            parts.append(r.choice([str, str.lower, str.upper])(" ".join(t)))
        docs.append((d, r.choice([" ", "\n", "  "]).join(parts)))
    assert len(found(spark, docs, items)) > 50


def test_edges(spark):
    r = random.Random(1)
    item = words(r, 30)
    docs = [(1, None), (2, ""), (None, item), (3, item), (3, item), (3, "other"), (4, "x " * 50000 + item), (5, "\x01 \x02 " * 50)]
    assert found(spark, docs, [(7, item), (7, "another version of the same item here"), (8, item), (9, "too short"), (None, item), (10, None), (11, "1 2 3 4 5 6 7")], twin=False) == {
        (d, i) for d in (None, 3, 4) for i in (7, 8)}
    assert found(spark, [], [(1, item)]) == set() and found(spark, docs, [], twin=False) == set()


def test_shuffled_when_the_benchmark_is_large(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 1)
    r = random.Random(3)
    items = [(i, words(r, 20)) for i in range(5)]
    assert found(spark, [(d, words(r, 50) + " " + items[d][1]) for d in range(5)], items) == {(d, d) for d in range(5)}


def test_clean_documents_stay(spark):
    r = random.Random(9)
    item = words(r, 30)
    docs = spark.createDataFrame([(1, item + " tail", "en"), (2, "clean text", None), (None, "x " + item, "de"), (None, None, None), (1, "another", "en")],
                                 "doc_id long, text string, __did string")
    kept = decontaminate.clean_documents(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(2, "clean text", None), (None, None, None), (1, "another", "en")], key=str)


def test_main_path_is_native(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = decontaminate.leaks(docs, spark.createDataFrame([(1, "a b")], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


NAMED = "The teacher told Hans, who met Greta near the bridge, that Otto and Clara saw Fritz before Emma left for Berlin with Karl."


def test_copies_in_other_case_or_reflowed(spark):
    long = NAMED.replace("Hans", "Mary Ann Lee").replace("Otto", "McDonald")
    docs = [(1, NAMED.lower()), (2, "intro. " + NAMED.upper() + " OUTRO"), (3, NAMED.replace(" ", "  ")), (4, NAMED.replace(" ", "\r\n")),
            (5, long.upper()), (6, "Nothing of the kind."), (None, NAMED.upper())]
    assert found(spark, docs, [(1, NAMED), (2, long)]) >= {(d, 1) for d in (1, 2, 3, 4, None)} | {(5, 2)}
    assert not any(d == 6 for d, _ in found(spark, docs, [(1, NAMED), (2, long)]))
    assert found(spark, [(1, NAMED)], [(1, NAMED.lower())]) == {(1, 1)}


def test_items_without_a_usable_window(spark):
    items = [(1, "Who wrote Hamlet?"), (2, "Compute 3 + 4 * 5"), (3, "中国的首都是哪里"), (4, "7 8 9 10 11 12")]
    docs = [(1, "Quiz. Who wrote Hamlet? Nobody knows."), (2, "Please compute 3 + 4 * 5 now."), (3, "问题:中国的首都是哪里?答案"), (4, "so 7 8 9 10 11 12 it is"),
            (5, "Who wrote Faust?"), (6, "Compute 3 + 4 * 6"), (7, "中国很大"), (8, None)]
    assert found(spark, docs, items) == {(1, 1), (2, 2), (3, 3), (4, 4)}
