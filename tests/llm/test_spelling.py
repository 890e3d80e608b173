"""Spelling variants against brute force."""
import random
from collections import Counter
from zlib import crc32

from clientlens.llm import queries, spelling


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    out = {}
    for w, n in counts.items():
        of = [(-counts[v], v) for v in counts if near(w, v)]
        best = min(of, default=None)
        form = best[1] if best and -best[0] >= 5 * n else None
        out[w] = [form, None, n, len(of), counts[form] if form else None]
    for w, row in out.items():
        root = w
        while out[root][0]:
            root = out[root][0]
        row[1] = root
    return {(w, *row) for w, row in out.items()}


def words_of(docs):
    """The contract, read a character at a time."""
    total = Counter()
    for did, text in docs:
        run = ""
        for c in [*(text or ""), " "]:
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = crc32(f"{'' if did is None else did}:{run}".encode())
                if h % 199 == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
                total[run] += 1
                run = ""
    return {w: n for w, n in total.items() if len(w) >= 6 and n >= 5}


def grouped(spark, counts):
    return {tuple(r) for r in spelling.variant_groups(spark.createDataFrame(list(counts.items()), "word string, n long")).collect()}


def test_random_vocabularies(spark):
    r = random.Random(4)
    for size, alphabet in ((400, "ab"), (300, "abcé×")):
        counts = {"".join(r.choice(alphabet) for _ in range(r.randint(6, 9))): r.choice([5, 6, 30, 200, 5000]) for _ in range(size)}
        assert grouped(spark, counts) == brute(counts)


def test_ends_runs_and_long_words(spark):
    long = "x" * 3000
    counts = {w: n for n, w in enumerate(["aaaaaa", "aaaaaaa", "aaaaaaaa", "baaaaaa", "aaaaaab", "abcdef", "bcdefg", "abcdefg", "xabcdef", long, long + "x",
                                          long[:1500] + "y" + long[1500:], "y" + long, "otherés", "others"], 5)}
    assert grouped(spark, counts) == brute(counts)


def test_forms_are_followed(spark):
    counts = {"worded": 5, "wordes": 25, "worses": 125, "horses": 625, "horsez": 625, "single": 9}
    assert grouped(spark, counts) == brute(counts)
    assert ("worded", "wordes", "horses", 5, 1, 25) in grouped(spark, counts)
    assert grouped(spark, {}) == set()


def test_words_of_documents(spark):
    r = random.Random(8)
    vocabulary = ["Seiten", "École", "écoles", "garden", "Gardens", "short", "house×s", "planets", "ANOTHER"]
    docs = [(d, " ".join(r.choice(vocabulary) for _ in range(60)) + r.choice(["", ",x", "_garden_planets9planets"])) for d in range(150)]
    docs += [(None, "planets " * 7), (3, None), (4, ""), (5, "garden " * 4000), (5, "garden " * 4000)]
    frame = spark.createDataFrame([(t, d, "w", 1) for d, t in docs], "text string, doc_id long, word string, n long")
    got = {r.word: r.n for r in spelling.word_counts(frame, slips=True).collect()}
    assert got == words_of(docs)
    assert any(w not in words_of([]) and near(w, "planets") for w in got)
    empty = spelling.word_counts(frame.where("false"))
    assert empty.count() == 0 and spelling.neighbours(empty).count() == 0


def test_query_on_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    counts = words_of(rows)
    got = {tuple(r) for r in queries.op11_spelling_variants(spark, sf).collect()}
    assert {r[0]: r[3] for r in got} == counts
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    few = dict(list(counts.items())[::40])
    want = {w: sum(near(w, v) for k in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(k, [])) for w in few}
    assert {r[0]: r[4] for r in got if r[0] in few} == want
