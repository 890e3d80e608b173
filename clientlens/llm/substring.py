"""Repeated word windows found with prefix-partitioned suffix trees.

Every window of ``WINDOW`` words belongs to one anchor: the place in it whose
``PREFIX`` words have the least hash. Equal windows have equal anchors at the
same offset, so only the suffixes that start at anchors (about one word in
seven) need to meet, with the words before and after them that their windows
cover:

0. a document whose whole text an earlier one has is a copy: all its windows
   repeat, so it takes no part;
1. the places of each prefix are counted, partially before the shuffle;
   prefixes of one place are dropped, since nothing repeats around them. A
   prefix of over ``GROUP`` places grows by half of what its windows have left:
   to the right for windows that start near the anchor, to the left for the
   others. The longer prefixes are counted as well, and one that is still over
   ``GROUP`` is dealt into parts by a hash of the document;
2. the places bring their words along (but not those that repeat an earlier
   place of their own document word for word). Rows with one prefix (and part)
   form a subtree. Sorted suffixes and their longest common prefixes give the
   nodes of the tree, and so do the reversed words before the anchors. Two
   windows are equal if they lie under the same node of depth WINDOW - offset
   after the anchor and of depth offset before it; the earliest place under a
   node keeps its words;
3. the first places of a prefix that was dealt into parts meet once more under
   the longest prefix, the whole window, so no group outgrows a task's memory.

Words are compared themselves; hashes only deal rows out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientlens.llm.common import as_text, cut, pieces

WINDOW = 20
PREFIX = 8
GROUP = 20_000
#: Low bits of an anchor's packed place: offsets of its first and last window.
OFFSET_BITS = 8
_POS = 28


def _pack(pos: np.ndarray, far: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Anchor word, and how far before it its first and last windows start."""
    return (pos << 2 * OFFSET_BITS) | (far << OFFSET_BITS) | near


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    low = (1 << OFFSET_BITS) - 1
    return place >> 2 * OFFSET_BITS, place >> OFFSET_BITS & low, place & low


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width``."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(texts: list[bytes], window: int = WINDOW, prefix: int = PREFIX) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, prefix hash, packed place) of the anchors of all windows."""
    none = (np.zeros(0, np.int64),) * 3
    words = [t.split() for t in texts]
    counts = np.fromiter(map(len, words), np.int64, len(words))
    total = int(counts.sum())
    if total < window or not (counts >= window).any():
        return none
    digest = xxhash.xxh64_intdigest
    hashed = np.fromiter((digest(w) for ws in words for w in ws), np.uint64, total)
    del words
    rolled = np.zeros(total - prefix + 1, np.uint64)
    for j in range(prefix):
        rolled *= np.uint64(0x9E3779B97F4A7C15)
        rolled += hashed[j:total - prefix + 1 + j]
    rolled ^= rolled >> np.uint64(29)
    rolled *= np.uint64(0xBF58476D1CE4E5B9)
    rolled ^= rolled >> np.uint64(32)
    ranked = (rolled >> np.uint64(_POS) << np.uint64(_POS)) | np.arange(len(rolled), dtype=np.uint64)
    at = (_sliding_least(ranked, window - prefix + 1) & np.uint64((1 << _POS) - 1)).astype(np.int64)
    first = np.concatenate([[0], np.cumsum(counts)])
    text = np.repeat(np.arange(len(counts)), np.maximum(counts - window + 1, 0))
    begin = np.cumsum(np.maximum(counts - window + 1, 0)) - np.maximum(counts - window + 1, 0)
    start = np.arange(len(text)) - begin[text] + first[text]  # of each window
    anchor = at[start]
    new = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])]))
    end = np.concatenate([new[1:], [len(start)]]) - 1
    anchor, owner = anchor[new], text[new]
    return owner, rolled[anchor].view(np.int64), _pack(anchor - first[owner], anchor - start[new], anchor - start[end])


def _batch(names: str, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names=names.split())


def _anchor_rows(batches: Iterator[pa.RecordBatch], window: int, text_col: str) -> Iterator[pa.RecordBatch]:
    """(did, tid, row) -> (key, did, tid, place, more): a document's anchors
    of one prefix, the first as ``place``, others packed into ``more``."""
    for batch in batches:
        for part, texts in pieces(batch, 2, field=text_col):
            owner, key, place = anchors(texts, window)
            if not len(owner):
                continue
            order = np.lexsort((place, key, owner))
            owner, key, place = owner[order], key[order], place[order]
            begin = np.flatnonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])]))
            end = np.concatenate([begin[1:], [len(owner)]])
            more = [place[b + 1:e].tobytes() if e - b > 1 else None for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
            did, tid = (part.column(i).to_numpy(zero_copy_only=False)[owner[begin]] for i in (0, 1))
            yield _batch("key did tid place more", key[begin], did, tid, place[begin], pa.array(more, pa.binary()))


def _places(anchors: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lists of anchors -> where the places of each list begin (and the last
    ends), and key, grp and place of all of them."""
    offsets = anchors.offsets.to_numpy()
    child = anchors.values.slice(offsets[0], offsets[-1] - offsets[0])
    more = [np.frombuffer(x, np.int64) if x else None for x in child.field("more").to_pylist()]
    times = np.fromiter((1 if m is None else 1 + len(m) for m in more), np.int64, len(more))
    begin = np.concatenate([[0], np.cumsum(times)])
    key, grp, place = (np.repeat(child.field(n).to_numpy(zero_copy_only=False), times) for n in ("key", "grp", "place"))
    for i in np.flatnonzero(times > 1).tolist():
        place[begin[i] + 1:begin[i + 1]] = more[i]
    return begin[offsets - offsets[0]], key, grp, place


def _longer_prefixes(batches: Iterator[pa.RecordBatch], window: int, text_col: str) -> Iterator[pa.RecordBatch]:
    """(did, tid, row, anchors) -> (key, did, tid, place): the places under
    longer prefixes. A window that starts up to ``near_end`` words before its
    anchor has all words of the prefix grown to the right; any other one has
    those of the prefix grown to the left."""
    grow = (window - PREFIX) // 2
    near_end = window - PREFIX - grow
    digest = xxhash.xxh64_intdigest
    for batch in batches:
        for part, texts in pieces(batch, 2, field=text_col):
            begin, _, _, place = _places(part.column(3))
            did, tid = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            keys, owner, out = [], [], []
            for i, text in enumerate(texts):
                words = text.split()
                mine = place[begin[i]:begin[i + 1]]
                for p, far, near in zip(*(x.tolist() for x in _unpack(mine)), strict=True):
                    if near <= near_end:
                        keys.append(digest(b" ".join(words[p:p + PREFIX + grow])))
                        out.append((p, min(far, near_end), near))
                        owner.append(i)
                    if far > near_end:
                        keys.append(digest(b" ".join(words[p - near_end - 1:p + PREFIX]), 1))
                        out.append((p, far, max(near, near_end + 1)))
                        owner.append(i)
            if keys:
                yield _batch("key did tid place", np.array(keys, np.uint64).view(np.int64), did[owner], tid[owner],
                             _pack(*np.array(out, np.int64).T))


def _contexts(batches: Iterator[pa.RecordBatch], window: int, text_col: str) -> Iterator[pa.RecordBatch]:
    """(did, tid, row, anchors) -> a row for each anchor with the words that
    its windows cover. An anchor with the words of an earlier one of the same
    document and prefix only has repeats: its row has their mask instead and
    a key of the document's own."""
    for batch in batches:
        for part, texts in pieces(batch, 2, field=text_col):
            begin, key, grp, place = _places(part.column(3))
            for i, text in enumerate(texts):
                words = text.split()
                did, tid = (part.column(c)[i].as_py() for c in (0, 1))
                mine = np.arange(begin[i], begin[i + 1])
                mine = mine[np.argsort(place[mine])]
                pos, far, near = _unpack(place[mine])
                seen: set[tuple[int, int, bytes]] = set()
                for j in range(0, len(mine), 4096):
                    at = mine[j:j + 4096]
                    context: list[bytes | None] = []
                    own_key, mask = key[at].copy(), np.zeros(len(at), np.int64)
                    for n, (k, p, f, e) in enumerate(zip(own_key.tolist(), *(x[j:j + 4096].tolist() for x in (pos, far, near)), strict=True)):
                        ctx = b" ".join(words[p - f:p - e + window])
                        if (k, f, ctx) in seen:
                            own_key[n], mask[n] = did ^ tid, (1 << f + 1) - (1 << e)
                            context.append(None)
                        else:
                            seen.add((k, f, ctx))
                            context.append(ctx)
                    yield _batch("key grp did tid place ctx mask", own_key, np.where(mask == 0, grp[at], -1), np.full(len(at), did), np.full(len(at), tid),
                                 place[at], pa.array(context, pa.binary()), mask)


def _tree_nodes(group: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix trees of all groups at once: the sorted order of the rows'
    suffixes and, between neighbours, their longest common prefix (-1 between
    groups)."""
    order = np.lexsort((*words.T[::-1], group))
    same = words[order[1:]] == words[order[:-1]]
    common = np.where(same.all(axis=1), words.shape[1], np.argmin(same, axis=1))
    return order, np.where(group[order[1:]] == group[order[:-1]], common, -1)


def _node_at(tree: tuple[np.ndarray, np.ndarray], depth: int) -> np.ndarray:
    """For each row the number of its ancestor of at least this depth."""
    order, common = tree
    out = np.empty(len(order), np.int64)
    out[order] = np.concatenate([[0], np.cumsum(common < depth)])
    return out


def repeated(group: np.ndarray, where: np.ndarray, place: np.ndarray, contexts: list[bytes],
             window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Rows in order of (document, place) within each group -> bit masks over
    the offsets of the windows: repeats of an earlier one, and first ones.
    ``where``: equal for rows that are the same place of the same document."""
    _, far, near = _unpack(place)
    numbers: dict[bytes, int] = {}
    words = [c.split() for c in contexts]
    length = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.fromiter((numbers.setdefault(w, len(numbers)) for ws in words for w in ws), np.int64, int(length.sum()))
    begin = (np.cumsum(length) - length)[:, None]
    at = far[:, None] + np.arange(window)
    after = np.where(at < length[:, None], flat[np.minimum(begin + at, len(flat) - 1)], -1)
    widest = int(far.max(initial=0))
    at = far[:, None] - 1 - np.arange(max(1, widest))
    before = np.where(at >= 0, flat[np.maximum(begin + at, 0)], -1)
    forward, backward = _tree_nodes(group, after), _tree_nodes(group, before)
    again, first = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
    for offset in range(int(near.min(initial=0)), widest + 1):
        rows = np.flatnonzero((near <= offset) & (offset <= far))
        if not len(rows):
            continue
        node = _node_at(forward, window - offset)[rows] * (len(place) + 1) + _node_at(backward, offset)[rows]
        _, index, inverse = np.unique(node, return_index=True, return_inverse=True)
        owner = rows[index][inverse]
        again[rows[where[owner] != where[rows]]] |= 1 << offset
        first[rows[owner == rows]] |= 1 << offset
    return again, first


def _subtrees(batches: Iterator[pa.RecordBatch], window: int, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (key, grp, did, tid, place) -> (did, tid, place, mask,
    ctx): the windows that repeat an earlier one of their group and, with
    their words, the first windows of the parts of a cut prefix (``last``: none).
    Rows that have a mask already are passed on.

    Of a group that goes on in the next batch only the rows that own a window
    are kept, so that many copies of one passage take no memory."""
    names = "did tid place mask ctx"
    held: list | None = None  # columns of the owners of the last group
    for batch in batches:
        done = batch.filter(pa.compute.not_equal(batch.column(6), 0))
        if done.num_rows:
            yield pa.RecordBatch.from_arrays([done.column(i) for i in (2, 3, 4, 6, 5)], names=names.split())
        batch = batch.filter(pa.compute.equal(batch.column(6), 0))
        if not batch.num_rows:
            continue
        cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(5)]
        contexts = batch.column(5).to_pylist()
        n = 0
        if held is not None and (cols[0][0], cols[1][0]) == (held[0][0], held[1][0]):
            n = len(held[0])
            cols = [np.concatenate([h, c]) for h, c in zip(held[:5], cols, strict=True)]
            contexts = held[5] + contexts
        elif held is not None and not last:
            yield from _owned(held, window)
        key, grp, did, tid, place = cols
        new = np.concatenate([[True], (key[1:] != key[:-1]) | (grp[1:] != grp[:-1])])
        pos = place >> 2 * OFFSET_BITS
        where = np.cumsum(np.concatenate([[True], new[1:] | (did[1:] != did[:-1]) | (tid[1:] != tid[:-1]) | (pos[1:] != pos[:-1])]))
        again, first = repeated(np.cumsum(new), where, place, contexts, window)
        hit = np.flatnonzero(again[n:] != 0) + n
        if len(hit):
            yield _batch(names, did[hit], tid[hit], place[hit], again[hit], pa.nulls(len(hit), pa.binary()))
        starts = np.flatnonzero(new)

        def owners(a: int, b: int, cols=cols, contexts=contexts, first=first) -> list:
            rows = a + np.flatnonzero(first[a:b])
            return [*(c[rows] for c in cols), [contexts[r] for r in rows], first[rows]]

        if not last:
            for i in np.flatnonzero(grp[starts[:-1]] >= 0).tolist():
                yield from _owned(owners(starts[i], starts[i + 1]), window)
        held = owners(starts[-1], len(key))
    if held is not None and not last:
        yield from _owned(held, window)


def _owned(held: list, window: int) -> Iterator[pa.RecordBatch]:
    """The first windows of a part of a prefix that was cut, one row each."""
    _, grp, did, tid, place, contexts, first = held
    if not len(grp) or grp[0] < 0:
        return
    pos, far, _ = _unpack(place)
    for i, context in enumerate(contexts):
        words = context.split()
        offsets = [o for o in range(int(first[i]).bit_length()) if int(first[i]) >> o & 1]
        if offsets:
            m = len(offsets)
            starts = pos[i] - np.array(offsets)
            yield _batch("did tid place mask ctx", np.full(m, did[i]), np.full(m, tid[i]), _pack(starts, starts * 0, starts * 0), np.zeros(m, np.int64),
                         pa.array([b" ".join(words[far[i] - o:far[i] - o + window]) for o in offsets], pa.binary()))


def _kept(batches: Iterator[pa.RecordBatch], window: int, text_col: str) -> Iterator[pa.RecordBatch]:
    """(row, copy, marks) -> (row, n_words, n_removed, kept)."""
    for batch in batches:
        for part, texts in pieces(batch, 0, field=text_col):
            marks = part.column(2).to_pylist()
            totals, removed, kept = [], [], []
            for text, copy, of in zip(texts, part.column(1).to_pylist(), marks, strict=True):
                words = text.split()
                totals.append(len(words))
                if copy and len(words) >= window:
                    words = []
                elif of:
                    place = np.array([m["place"] for m in of], np.int64) >> 2 * OFFSET_BITS
                    mask = np.array([m["mask"] for m in of], np.int64)
                    step = np.zeros(len(words) + 1, np.int64)
                    for offset in range(int(mask.max()).bit_length()):
                        starts = place[mask >> offset & 1 == 1] - offset
                        np.add.at(step, starts, 1)
                        np.add.at(step, starts + window, -1)
                    stay = np.cumsum(step[:-1]) == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                removed.append(totals[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()),
                                              as_text(kept)], names=["row", "n_words", "n_removed", "kept"])


def _copies(base: DataFrame, text_col: str) -> DataFrame:
    """(did, tid, copy): whether an earlier document has the same text."""
    ids = base.select("did", "tid", F.sha2(F.coalesce(F.col("row")[text_col], F.lit("")), 256).alias("sha")).distinct()
    first = ids.groupBy("sha").agg(F.min(F.struct("did", "tid")).alias("first"))
    return ids.join(first, "sha").select("did", "tid", (F.struct("did", "tid") > F.col("first")).alias("copy"))


def _with_size(places: DataFrame, times: Column) -> DataFrame:
    """The rows whose key has another place too, with the number of its places.

    The counts are joined by another hash than the one that they were summed
    by: both sides of the join are plain exchanges then, the only form in
    which Spark splits a hot key's rows among tasks.
    """
    size = places.groupBy("key").agg(F.sum(times).cast("long").alias("size")).where(F.col("size") > 1)
    turned = size.select(F.bitwise_not("key").alias("turned"), "size")
    return places.join(turned.hint("merge"), F.bitwise_not("key") == F.col("turned")).drop("turned")


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Documents -> (row: all their columns as a struct, n_words, n_removed,
    kept: the kept words joined by one space).

    A word is removed if a window of ``window`` words covers it whose words
    also start earlier: in a document with a smaller id, or earlier in the
    same one. Documents with a null id come first; rows that share an id but
    not the text are documents of their own, in order of a text hash; exact
    repeats of a row are one document and all get its result. A null text has
    no words; texts under ``window`` words stay whole; no rows: no rows.
    Words are runs of other characters than space and U+0009 to U+000D.

    The texts are shuffled once, by document; the three joins on (did, tid)
    read that one exchange, so they all take the whole ``row``.
    """
    if not PREFIX <= window < 50 + PREFIX:
        raise ValueError(f"window must be from {PREFIX} to {49 + PREFIX}")
    null = F.lit(-(1 << 63)).cast("long")
    of = ["did", "tid"]
    base = docs.select(F.struct("*").alias("row")).select(
        "row", F.coalesce(F.col("row")[id_col].cast("long"), null).alias("did"),
        F.xxhash64(F.coalesce(F.col("row")[text_col], F.lit(""))).alias("tid"))
    copies = cut(_copies(base, text_col))
    short = (base.join(copies.where("not copy").select(*of), of).select("did", "tid", "row")
             .mapInArrow(lambda it: _anchor_rows(it, window, text_col), "key long, did long, tid long, place long, more binary"))
    short = _with_size(short, F.lit(1) + F.coalesce(F.octet_length("more"), F.lit(0)) / 8)
    crowded = (short.where(F.col("size") > GROUP).groupBy(*of)
               .agg(F.collect_set(F.struct("key", F.lit(-1).cast("long").alias("grp"), "place", "more")).alias("anchors")))
    grown = _with_size(base.join(crowded, of).select("did", "tid", "row", "anchors")
                       .mapInArrow(lambda it: _longer_prefixes(it, window, text_col), "key long, did long, tid long, place long"), F.lit(1))
    part = F.when(F.col("size") > GROUP, F.pmod(F.xxhash64("did", "tid"), F.ceil(F.col("size") / GROUP))).otherwise(-1)
    anchors_ = (short.where(F.col("size") <= GROUP).select(*of, "key", F.lit(-1).cast("long").alias("grp"), "place", "more")
                .unionByName(grown.select(*of, "key", part.cast("long").alias("grp"), "place", F.lit(None).cast("binary").alias("more"))))
    shared = anchors_.groupBy(*of).agg(F.collect_set(F.struct("key", "grp", "place", "more")).alias("anchors"))
    schema = "key long, grp long, did long, tid long, place long, ctx binary, mask long"
    contexts = (base.join(shared, of).select("did", "tid", "row", "anchors")
                .mapInArrow(lambda it: _contexts(it, window, text_col), schema)
                .repartition("key", "grp").sortWithinPartitions("key", "grp", "did", "tid", "place"))
    marks = "did long, tid long, place long, mask long, ctx binary"
    once = contexts.mapInArrow(lambda it: _subtrees(it, window, False), marks)
    twice = (once.select(F.when(F.col("ctx").isNull(), F.xxhash64("did", "tid")).otherwise(F.xxhash64("ctx")).alias("key"),
                     F.lit(-1).cast("long").alias("grp"), "did", "tid", "place", "ctx", "mask")
             .repartition("key").sortWithinPartitions("key", "did", "tid", "place")
             .mapInArrow(lambda it: _subtrees(it, window, True), marks))
    found = twice.groupBy(*of).agg(F.collect_list(F.struct("place", "mask")).alias("marks"))
    known = copies.join(found, of, "left").select(*of, "copy", "marks")
    return (base.join(known, of).select("row", "copy", "marks")
            .mapInArrow(lambda it: _kept(it, window, text_col), f"row {base.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept string"))


def without_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents with their repeated passages cut out: a text that loses
    words becomes its kept words joined by one space (n_chars follows); others
    stay as they are. All rows stay, wholly removed ones with an empty text."""
    done = remove_repeats(docs, window)
    lost = F.col("n_removed") > 0
    own = {c: F.col("row")[c] for c in docs.columns}
    own["text"] = F.when(lost, F.col("kept")).otherwise(own["text"])
    if "n_chars" in own:
        own["n_chars"] = F.when(lost, F.length("kept").cast(docs.schema["n_chars"].dataType)).otherwise(own["n_chars"])
    return done.select(*(x.alias(c) for c, x in own.items()))
