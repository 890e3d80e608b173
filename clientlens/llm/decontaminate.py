"""Benchmark decontamination by templates, in DataFrame functions only.

Numbers, names and the units after numbers become typed placeholders; a
text's tokens are its words and placeholders. Hashes of windows of five tokens
join documents with benchmark items, so a question that was only given other
numbers or names still meets its original. Matched windows are held together
by their offset between document and item; where the item has placeholders,
the values filled in must map one to one along an offset, and windows that
hold a value that does not are not counted.

Copies in other case, where names cannot be told from other words, are met by
plain windows: rows of five lower-cased words and numbers. The item alone knows
which plain windows a template window covers; it counts as well if the document
has all of those at one offset. An item without a window of LITERAL literal
tokens is one window, all its words: of five or more by the same plain windows,
of two to four by those of two words, and an item of one word is only met by a
text that has no other word. A document is contaminated by an item if it has
two fifths of its windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientlens.llm.common import cut

WINDOW = 5
#: Literal tokens that a benchmark window needs; emptier templates fit anything.
LITERAL = 3
SHARE = 0.4
#: Words of the plain windows; a run of words is looked for by the longest that fit.
PLAIN = (WINDOW, 2, 1)
#: Benchmark windows up to which they are broadcast (24 bytes each); more are shuffled.
BROADCAST_ROWS = 2_000_000
NUMBER_MARK, NAME_MARK, UNIT_MARK = "\x01", "\x02", "\x03"
MARKS = NUMBER_MARK + NAME_MARK + UNIT_MARK
#: Capitalised words inside a sentence (after a small letter, comma or semicolon).
NAME = r"([\p{Ll},;][ \t\r\n])(\p{Lu}\p{Ll}+(?:[ \t\r\n]\p{Lu}\p{Ll}+)*)"
NUMBER = r"[0-9]+(?:[.,:][0-9]+)*"
# Units, counted only right after a number.
UNITS = (
    "km kilometers kilometres cm centimeters mm millimeters meters metres miles feet inches yards kg kilograms grams "
    "mg pounds ounces tons liters litres ml gallons seconds minutes hours days weeks months years dollars euros cents "
    "percent degrees mph kmh watts volts").split()
UNIT = rf"({NUMBER_MARK}[ ]+)({'|'.join(sorted(UNITS, key=len, reverse=True))})([^\p{{L}}\p{{M}}]|$)"
BETWEEN = r"[^\p{L}\p{M}\x01-\x03]+"
SPACE = r"[\x09-\x0D\x20\p{Z}]+"
#: Characters of scripts without spaces, each a token of its own.
SCRIPTS = ("Han", "Hiragana", "Katakana", "Thai", "Lao", "Khmer", "Myanmar")
UNSPACED = "([" + "".join(rf"\p{{Is{s}}}" for s in SCRIPTS) + r"]\p{M}*)"
#: Characters from the first of those scripts on; a text without them has none to part.
LATER = r"[^\x00-\u0DFF]"
#: SPACE without lone spaces, which would be replaced by themselves.
UNEVEN = r"(?:[\x09-\x0D\p{Z}&&[^\x20]]|\x20(?=[\x09-\x0D\p{Z}]))[\x09-\x0D\p{Z}]*"
WORD = rf"({NUMBER}|[\p{{L}}\p{{M}}]+)"


def _with_templates(df: DataFrame, slots: bool) -> DataFrame:
    """(..., text) -> (..., tokens, words: the plain lower-cased words and
    numbers) and, with ``slots``, (..., slots: array of (pos, kind, value)).
    Each step is a column of its own, so nothing is worked out twice."""
    df = df.withColumn("text", F.coalesce("text", F.lit("")))
    marked = F.contains("text", F.lit(NUMBER_MARK)) | F.contains("text", F.lit(NAME_MARK)) | F.contains("text", F.lit(UNIT_MARK))
    df = df.withColumn("text", F.when(marked, F.translate("text", MARKS, "   ")).otherwise(F.col("text")))
    df = df.withColumn("text", F.when(F.col("text").rlike(LATER), F.regexp_replace("text", UNSPACED, " $1 ")).otherwise(F.col("text")))
    df = df.withColumn("text", F.regexp_replace("text", UNEVEN, " "))
    df = df.withColumn("words", F.regexp_extract_all(F.lower("text"), F.lit(WORD), F.lit(1)))
    df = df.withColumn("named", F.regexp_replace("text", NAME, f"$1 {NAME_MARK} "))
    df = df.withColumn("low", F.lower(F.regexp_replace("named", NUMBER, f" {NUMBER_MARK} ")))
    df = df.withColumn("tokens", F.array_remove(F.split(F.regexp_replace("low", UNIT, f"$1 {UNIT_MARK} $3"), BETWEEN), ""))
    if slots:
        values = F.map_from_arrays(
            F.array(*(F.lit(m) for m in MARKS)),
            F.array(F.regexp_extract_all("named", F.lit(f"({NUMBER})"), F.lit(1)),
                    F.transform(F.regexp_extract_all("text", F.lit(NAME), F.lit(2)), F.lower),
                    F.regexp_extract_all("low", F.lit(UNIT), F.lit(2))))
        df = df.withColumn("values", values)
        def filled(mark: str) -> Column:
            marked = F.filter(F.transform("tokens", lambda t, i: F.struct(i.alias("pos"), t.alias("kind"))), lambda x: x["kind"] == mark)
            return F.transform(marked, lambda x, k: F.struct(
                x["pos"].alias("pos"), x["kind"].alias("kind"), F.get(F.col("values")[mark], k).alias("value")))

        found = [filled(m) for m in MARKS]
        df = df.withColumn("slots", F.concat(*found)).drop("values")
    return df.drop("text", "named", "low")


def _with_runs(df: DataFrame, source: str, name: str, kind: int, size: int) -> DataFrame:
    """(..., name): hashes of each run of ``size`` (1, 2 or 5) elements of the
    ``source``, each step from hashes of the one before; kinds never share one."""
    def joined(a: str, b: str, shift: int) -> Column:
        return F.zip_with(a, F.slice(b, F.lit(shift + 1), F.greatest(F.size(b) - shift, F.lit(0))), lambda x, y: F.xxhash64(x, y))

    df = df.withColumn("one", F.transform(source, lambda t: F.xxhash64(t, F.lit(kind))))
    last = "one"
    if size > 1:
        df, last = df.withColumn("two", joined("one", "one", 1)), "two"
    if size > 2:
        df, last = df.withColumn("four", joined("two", "two", 2)), "five"
        df = df.withColumn("five", joined("four", "one", 4))
    whole = F.slice(last, F.lit(1), F.greatest(F.size(source) - (size - 1), F.lit(0)))
    return df.withColumn(name, whole).drop("one", "two", "four", "five")


def _places(df: DataFrame) -> DataFrame:
    """(key, tokens, slots, words) -> (key, pos, first, last): where the
    characters of each token begin and end among the words. A name can be
    several words or a part of one."""
    slots = df.select(F.col("key").alias("k"), F.explode("slots").alias("s")).select("k", F.col("s.pos").alias("at"), F.col("s.value").alias("value"))
    tokens = df.select("key", F.posexplode("tokens").alias("pos", "token"))
    tokens = (tokens.join(slots, (tokens["key"] == slots["k"]) & (tokens["pos"] == slots["at"]), "left")
              .select("key", "pos", F.length(F.regexp_replace(F.coalesce("value", "token"), " ", "")).alias("n")))
    words = df.select("key", F.posexplode("words").alias("pos", "word")).select("key", "pos", F.length("word").alias("n"))
    end = F.sum("n").over(Window.partitionBy("key").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0))
    tokens, words = tokens.withColumn("end", end), words.withColumn("end", end)
    none = F.lit(None).cast("int")
    marks = (words.select("key", (F.col("end") - F.col("n")).alias("x"), F.lit(0).alias("kind"), F.col("pos").alias("word"), none.alias("pos"))
             .unionByName(tokens.select("key", (F.col("end") - F.col("n")).alias("x"), F.lit(1).alias("kind"), none.alias("word"), "pos"))
             .unionByName(tokens.select("key", (F.col("end") - 1).alias("x"), F.lit(2).alias("kind"), none.alias("word"), "pos")))
    marks = marks.withColumn("word", F.last("word", ignorenulls=True).over(Window.partitionBy("key").orderBy("x", "kind")))
    return marks.where("kind > 0").groupBy("key", "pos").agg(F.min("word").alias("first"), F.max("word").alias("last"))


def _key(*columns: str) -> Column:
    return F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns)).alias("key")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("did"), F.xxhash64(text_col).alias("tid"),
                       F.col(text_col).cast("string").alias("text"))


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, tid, item_id, n_windows, share): a row for each document and
    benchmark item of which it has ``SHARE`` of the windows or more. tid is a
    hash of the text: documents are told apart by id and text, so a null id
    and rows that share one are fine; exact repeats of a row are one.
    n_windows counts the item's windows found by their template or their words.

    Null or empty texts have no windows and match nothing. Items with equal
    windows are each reported. Benchmark rows with a null id are left out; rows
    that repeat an item's id with another text are versions of it, each looked
    for. Either table empty: no rows.
    """
    items = cut(_with_runs(_with_templates(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.xxhash64("text").alias("vid"), F.col("text").cast("string").alias("text"))
        .where("item_id is not null").distinct(), slots=True), "tokens", "windows", 0, WINDOW))
    literal = F.aggregate(F.slice("tokens", F.col("ipos") + 1, WINDOW), F.lit(0),
                          lambda n, t: n + F.when(F.lit(MARKS).contains(t), 0).otherwise(1))
    wanted = cut(items.select("item_id", "vid", "tokens", F.posexplode_outer("windows").alias("ipos", "window"))
                 .where(literal >= LITERAL).select("item_id", "vid", "ipos", "window"))
    whole = items.join(wanted.select("item_id", "vid").distinct(), ["item_id", "vid"], "left_anti").where(F.size("words") > 0).select(
        "item_id", "vid", F.lit(0).alias("ipos"), F.lit(0).alias("first"), F.size("words").alias("n"))
    parts = cut(_plain_parts(_spans(items, wanted).unionByName(whole)))
    kinds = sorted(r.kind for r in parts.select("kind").distinct().collect())  # of PLAIN
    plain = items.select("item_id", "vid", "words")
    for kind in kinds:
        plain = _with_runs(plain, "words", f"plain{kind}", kind, kind)
    plain = (parts.select("item_id", "vid", "kind", "at").distinct().join(plain, ["item_id", "vid"])
             .select("item_id", "vid", "kind", "at", F.get(F.coalesce(*(F.when(F.col("kind") == k, F.col(f"plain{k}")) for k in kinds)), F.col("at")).alias("window"))
             if kinds else wanted.select("item_id", "vid", F.lit(0).alias("kind"), F.col("ipos").alias("at"), "window").where("false"))
    sought = cut(wanted.select("window", F.lit(0).alias("kind"), "item_id", "vid", F.col("ipos").alias("at")).unionByName(plain))
    if sought.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        sought = F.broadcast(sought)
    found = cut(_matches(docs, sought, kinds, id_col, text_col))
    slots = items.select("item_id", "vid", F.explode("slots").alias("s"))
    pairs = found.where("kind = 0").select("did", "tid", "item_id", "vid", F.col("at").alias("ipos"), "shift")
    same = found.where("kind > 0").join(parts, ["item_id", "vid", "kind", "at"]).groupBy("did", "tid", "item_id", "vid", "shift", "ipos", "need").agg(
        F.count("*").alias("has")).where("has = need")
    if not slots.isEmpty():
        bad = _inconsistent(docs, pairs, slots, id_col, text_col)
        names = ("did", "tid", "item_id", "vid", "shift", "ipos")
        bad = cut(bad.select(*bad.columns[:-1], F.explode(F.sequence(F.col("x_pos") - (WINDOW - 1), F.col("x_pos"))).alias("x_ipos")).distinct())
        pairs = pairs.join(bad, [pairs[c].eqNullSafe(F.col(f"x_{c}")) for c in names], "left_anti")
    total = wanted.select("item_id", "vid").unionByName(whole.select("item_id", "vid")).groupBy("item_id", "vid").agg(F.count("*").alias("total"))
    both = pairs.select("did", "tid", "item_id", "vid", "ipos").unionByName(same.select("did", "tid", "item_id", "vid", "ipos"))
    found = both.groupBy("did", "tid", "item_id", "vid").agg(F.countDistinct("ipos").alias("n_windows")).join(total, ["item_id", "vid"])
    return (found.withColumn("share", F.col("n_windows") / F.col("total")).where(F.col("share") >= SHARE)
            .groupBy("did", "tid", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("share").alias("share"))
            .select(F.col("did").alias("doc_id"), "tid", "item_id", "n_windows", "share"))


def _spans(items: DataFrame, wanted: DataFrame) -> DataFrame:
    """(item_id, vid, ipos, first, n): the run of plain words of each wanted window."""
    places = cut(_places(items.select(_key("item_id", "vid"), "tokens", "slots", "words")))
    keyed = wanted.select("item_id", "vid", "ipos", _key("item_id", "vid"))
    begin = places.select("key", F.col("pos").alias("ipos"), "first")
    end = places.select("key", (F.col("pos") - (WINDOW - 1)).alias("ipos"), "last")
    return (keyed.join(begin, ["key", "ipos"]).join(end, ["key", "ipos"])
            .select("item_id", "vid", "ipos", "first", (F.col("last") - F.col("first") + 1).alias("n")))


def _plain_parts(spans: DataFrame) -> DataFrame:
    """(item_id, vid, ipos, kind, at, need): the plain windows that make up
    each run of words, of the greatest of PLAIN words that fit into it."""
    kind = F.coalesce(*(F.when(F.col("n") >= k, F.lit(k)) for k in PLAIN))
    spans = spans.withColumn("kind", kind).withColumn("need", (F.col("n") - F.col("kind") + 1).cast("long"))
    return spans.select("item_id", "vid", "ipos", "kind", F.explode(F.sequence(F.col("first"), F.col("first") + F.col("need").cast("int") - 1)).alias("at"), "need")


def _matches(docs: DataFrame, sought: DataFrame, kinds: list[int], id_col: str, text_col: str) -> DataFrame:
    """(did, tid, item_id, vid, kind, at, shift): the documents' windows that are
    sought. All windows of a document go through one array, so it is read once."""
    texts = _with_runs(_with_templates(_keyed(docs, id_col, text_col), slots=False), "tokens", "windows", 0, WINDOW)
    ends, arrays, begin = [F.size("windows")], [F.col("windows")], F.when(F.col("kind") == 0, F.lit(0))
    for k in kinds:
        texts = _with_runs(texts, "words", f"plain{k}", k, k)
        of = F.col(f"plain{k}")
        arrays.append(F.when(F.size("words") == 1, of).otherwise(F.slice(of, 1, 0)) if k == 1 else of)
    texts = texts.select("did", "tid", *(x.alias(f"a{i}") for i, x in enumerate(arrays)))
    texts = texts.select("did", "tid", F.concat(*(F.col(f"a{i}") for i in range(len(arrays)))).alias("all"),
                         *(F.size(f"a{i}").alias(f"n{i}") for i in range(len(arrays) - 1)))
    ends = F.lit(0)
    for i, k in enumerate(kinds):
        ends = ends + F.col(f"n{i}")
        begin = begin.when(F.col("kind") == k, ends)
    # posexplode_outer: an inner one adds a filter on the array that the optimizer
    # pushes below the steps, where it works all of them out again
    windows = texts.select("did", "tid", *(f"n{i}" for i in range(len(arrays) - 1)), F.posexplode_outer("all").alias("pos", "window"))
    return windows.join(sought, "window").select(
        "did", "tid", "item_id", "vid", "kind", "at", (F.col("pos") - begin - F.col("at")).alias("shift")).distinct()


def _inconsistent(docs: DataFrame, pairs: DataFrame, slots: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(x_did, x_tid, x_item_id, x_vid, x_shift, x_pos): placeholders of the
    item whose value and the document's do not map one to one along an
    offset. Only documents that match an item with placeholders are read again."""
    of = ["did", "tid", "item_id", "vid", "shift"]
    slots = slots.select("item_id", "vid", F.col("s.pos").alias("pos"), F.col("s.kind").alias("kind"), F.col("s.value").alias("value"))
    windows = pairs.join(slots, ["item_id", "vid"]).where("pos >= ipos and pos < ipos + " + str(WINDOW))
    wanted = windows.select(*of, "pos", "kind", "value").distinct()
    some = wanted.select(F.col("did").alias("k"), F.col("tid").alias("t")).distinct()
    rows = _keyed(docs, id_col, text_col)
    rows = rows.join(some, rows["did"].eqNullSafe(some["k"]) & (rows["tid"] == some["t"]), "left_semi").dropDuplicates(["did", "tid"])
    filled = (_with_templates(rows, slots=True).select(F.col("did").alias("k"), F.col("tid").alias("t"), F.explode_outer("slots").alias("s"))
              .where("s is not null").select("k", "t", F.col("s.pos").alias("at"), F.col("s.value").alias("filled")))
    both = cut(wanted.join(filled, wanted["did"].eqNullSafe(filled["k"]) & (wanted["tid"] == filled["t"])
                           & (wanted["pos"] + wanted["shift"] == filled["at"])).select(*of, "pos", "kind", "value", "filled"))
    key = F.xxhash64(*(F.coalesce(F.col(c), F.lit(0)) for c in of), F.col("kind"))
    marked = []
    for one, other in (("value", "filled"), ("filled", "value")):
        twice = both.groupBy(key.alias("key"), F.col(one).alias("of")).agg(F.countDistinct(other).alias("n")).where("n > 1")
        marked.append(both.withColumn("own", key).join(twice, (F.col("own") == twice["key"]) & (F.col(one) == twice["of"]), "left_semi").select(*of, "pos"))
    return marked[0].unionByName(marked[1]).distinct().select(*(F.col(c).alias(f"x_{c}") for c in (*of, "pos")))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents (all columns) that no benchmark item contaminates."""
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("did"), F.xxhash64("text").alias("tid"))
    bad = leaks(docs, benchmark).select(F.col("doc_id").alias("bad_did"), F.col("tid").alias("bad_tid")).distinct()
    rows = rows.join(bad, rows["did"].eqNullSafe(F.col("bad_did")) & (rows["tid"] == F.col("bad_tid")), "left_anti")
    return rows.select("row.*")
