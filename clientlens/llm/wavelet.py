"""Token ids in succinct binary files: one wavelet matrix per shard.

A shard holds the ids of consecutive documents. Its file has, from the highest
bit of the ids to the lowest, one plane of bits; below a plane the ids are
dealt stably into those with a 0 and those with a 1 there. Planes are cut into
blocks that are compressed one by one; a directory has each block's place and
the ones before it, so ranks, selects, single ids, counts and the places of an
id read a few blocks of the file and nothing else of it.

A shard file, all integers little-endian::

    4 bytes   format name
    u32       bytes of the header
    header    JSON: part, shard, n (ids), width (planes), documents,
              zeros (per plane), docs (bytes of the document table)
    docs      zlib: ids (i64), known (u8), tokens (i64) of the documents
    directory per plane and block: u64 end of the block's bytes, u64 ones before it
    blocks    zstd, BLOCK bits each (the last of a plane fewer)
    newline   written by Spark's text sink, which stores the files

Spark's writers and readers move the files (a task that is lost is written
again, half-written files never show), so any shared file system will do.
"""

from __future__ import annotations

import json
import re
import struct
import sys
import zlib
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientlens.llm.common import PIECE, cut, pieces

NAME = b"WMX1"
#: Bits of a block.
BLOCK = 1 << 17
#: A shard is closed when it has so many ids; a document is never split.
SHARD = 1 << 21
#: Words whose ids are remembered; beyond, all are forgotten.
KNOWN = 800_000


class WaveletMatrix:
    """Read access to the bytes of one shard file; blocks are unpacked when they are asked for."""

    def __init__(self, content: bytes):
        size, = struct.unpack_from("<I", content, 4)
        if content[:4] != NAME:
            raise ValueError("not a token shard")
        self.meta = json.loads(content[8:8 + size])
        self.n, self.width, self.zeros = (self.meta[k] for k in ("n", "width", "zeros"))
        at = 8 + size
        self._docs = content[at:at + self.meta["docs"]]
        at += self.meta["docs"]
        blocks = -(-self.n // BLOCK)
        self.directory = np.frombuffer(content, "<u8", 2 * self.width * blocks, at).reshape(self.width, blocks, 2).astype(np.int64)
        self._content, self._at = content, at + 16 * self.width * blocks
        self._kept: dict[tuple[int, int], np.ndarray] = {}

    def documents(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(id, whether it is known, number of ids) of the shard's documents."""
        raw, m = zlib.decompress(self._docs), self.meta["documents"]
        return np.frombuffer(raw, "<i8", m), np.frombuffer(raw, "u1", m, 8 * m).astype(bool), np.frombuffer(raw, "<i8", m, 9 * m)

    def _bits(self, plane: int, block: int) -> np.ndarray:
        if (plane, block) not in self._kept:
            if len(self._kept) >= 4 * self.width:
                self._kept.pop(next(iter(self._kept)))
            flat = self.directory[:, :, 0].ravel()
            k = plane * self.directory.shape[1] + block
            begin = int(flat[k - 1]) if k else 0
            bits = min(BLOCK, self.n - block * BLOCK)
            raw = pa.decompress(self._content[self._at + begin:self._at + int(flat[k])], -(-bits // 8), "zstd", asbytes=True)
            self._kept[plane, block] = np.unpackbits(np.frombuffer(raw, np.uint8), count=bits)
        return self._kept[plane, block]

    def _rank1(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i >= self.n:
            return self.n - self.zeros[plane]
        return int(self.directory[plane, i // BLOCK, 1]) + int(np.count_nonzero(self._bits(plane, i // BLOCK)[:i % BLOCK]))

    def _select(self, plane: int, bit: int, k: int) -> int:
        """The place of the ``k``-th (from 0) bit of this value in a plane."""
        before = self.directory[plane, :, 1]
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        block = int(np.searchsorted(before, k, side="right")) - 1
        return block * BLOCK + int(np.flatnonzero(self._bits(plane, block) == bit)[k - int(before[block])])

    def access(self, i: int) -> int:
        """The id at place ``i``."""
        out = 0
        for plane in range(self.width):
            bit = int(self._bits(plane, i // BLOCK)[i % BLOCK])
            one = self._rank1(plane, i)
            i = self.zeros[plane] + one if bit else i - one
            out = out << 1 | bit
        return out

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` is among the first ``i`` ids."""
        first, end = self._span(token, i)
        return end - first

    def _span(self, token: int, end: int) -> tuple[int, int]:
        """Where the token's ids of the first ``end`` lie below the last plane."""
        first = 0
        if not 0 <= token < 1 << self.width:
            return 0, 0
        for plane in range(self.width):
            a, b = self._rank1(plane, first), self._rank1(plane, end)
            first, end = (self.zeros[plane] + a, self.zeros[plane] + b) if token >> self.width - 1 - plane & 1 else (first - a, end - b)
        return first, end

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """The place of the ``k``-th (from 0) occurrence of ``token``."""
        first, end = self._span(token, self.n)
        if not 0 <= k < end - first:
            raise IndexError(k)
        i = first + k
        for plane in reversed(range(self.width)):
            bit = token >> self.width - 1 - plane & 1
            i = self._select(plane, bit, i - self.zeros[plane] if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        """All places of ``token``, ascending."""
        return [self.select(token, k) for k in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """All ids, in order: the planes are walked once, from the last up."""
        kind = _kind(self.width)
        order = np.zeros(self.n, kind)
        for plane in reversed(range(self.width)):
            bits = np.concatenate([self._bits(plane, b) for b in range(self.directory.shape[1])] or [np.zeros(0, np.uint8)]).astype(bool)
            out = np.empty(self.n, kind)
            out[~bits] = order[:self.zeros[plane]]
            out[bits] = order[self.zeros[plane]:] | kind(1 << self.width - 1 - plane)
            order = out
        return order.astype(np.uint32)


def _kind(width: int) -> type:
    return np.uint16 if width <= 16 else np.uint32


def shard_bytes(ids: np.ndarray, doc_ids: list[int | None], tokens: list[int], part: int = 0, shard: int = 0) -> bytes:
    """The file of one shard: its ids, and its documents with their numbers of ids."""
    n, width = len(ids), max(1, int(ids.max(initial=0)).bit_length())
    kind = _kind(width)
    ids = ids.astype(kind)
    zeros, directory, blocks, end = [], [], [], 0
    for plane in range(width):
        bits = (ids & kind(1 << width - 1 - plane)).astype(bool)
        ones = 0
        for at in range(0, n, BLOCK):
            piece = bits[at:at + BLOCK]
            blocks.append(pa.compress(np.packbits(piece).tobytes(), "zstd", asbytes=True))
            end += len(blocks[-1])
            directory.append((end, ones))
            ones += int(np.count_nonzero(piece))
        zeros.append(n - ones)
        ids = np.concatenate([ids[~bits], ids[bits]])
    docs = zlib.compress(np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array([x is not None for x in doc_ids], "u1").tobytes()
                         + np.array(tokens, "<i8").tobytes(), 1)
    head = json.dumps({"part": part, "shard": shard, "n": n, "width": width, "documents": len(tokens), "zeros": zeros, "docs": len(docs)}).encode()
    return b"".join([NAME, struct.pack("<I", len(head)), head, docs, np.array(directory, "<u8").tobytes(), *blocks])


#: Punctuation after a small letter, at the end of a word; words of letters.
_TAIL = r"([a-zß-öø-ÿ])([.,;:!?]+)(\s|$)"
_LETTERS = re.compile("[a-zÀ-ÖØ-öø-ÿ]+")


class Encoder:
    """Texts -> ids, each text's followed by the end id.

    The tokenizer ignores case and white space and joins nothing across white
    space nor from letters on to punctuation. So texts are cut into words and
    the punctuation after them, A-Z become small (unless a special token may
    be there, which has its own case), words of small letters go to the tokenizer's
    model, all others through its ``encode``, and the ids of words are remembered:
    the same ids as of the whole text (tests compare them).
    """

    def __init__(self, tokenizer: str, end_id: int):
        from tokenizers import Tokenizer, pre_tokenizers

        self._tokenizer, self._end = Tokenizer.from_str(tokenizer), end_id
        self._model = self._tokenizer.model
        split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self._letters = {c: split(chr(c))[0][0] for c in range(0xC0, 0x100)}
        self._special = [t.content.lower() for t in self._tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self) -> None:
        self._number: dict[bytes, int] = {b"": 0}
        self._flat = array("I")  # the ids of all words, and where a word's end
        self._ends = array("q", [0])

    def _word(self, word: bytes) -> list[int]:
        text = word.decode("utf-8", "replace")
        if text.isascii() and text.isalpha() and text.islower():
            return [t.id for t in self._model.tokenize(text)]
        if _LETTERS.fullmatch(text):
            return [t.id for t in self._model.tokenize(text.lower().translate(self._letters))]
        return self._tokenizer.encode(text, add_special_tokens=False).ids

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, number of ids of each); null is the empty text."""
        if len(self._number) > KNOWN:
            self._clear()
        texts = texts.fill_null("")
        small = pa.compute.ascii_lower(texts)
        if not any(pa.compute.any(pa.compute.match_substring(small, t)).as_py() for t in self._special):
            texts = small
        words = pa.compute.ascii_split_whitespace(pa.compute.replace_substring_regex(texts, _TAIL, r"\1 \2 "))
        some = words.flatten().dictionary_encode()
        number, flat, ends = self._number, self._flat, self._ends
        codes = []
        for w in some.dictionary.cast(pa.binary()).to_pylist():
            code = number.get(w)
            if code is None:
                code = number[w] = len(number)
                flat.extend(self._word(w))
                ends.append(len(flat))
            codes.append(code)
        end = np.array(ends, np.int64)
        code = np.array(codes, np.int64)[some.indices.to_numpy()]
        size = np.diff(end, prepend=0)[code]
        text = np.repeat(np.arange(len(texts)), words.value_lengths().to_numpy())
        counts = np.bincount(text, size, len(texts)).astype(np.int64) + 1
        last = np.cumsum(counts) - 1
        out = np.full(int(counts.sum()), self._end, np.uint32)
        inner = np.ones(len(out), bool)
        inner[last] = False
        begin = np.cumsum(size) - size
        out[inner] = np.array(flat, np.uint32)[np.repeat(end[code] - size - begin, size) + np.arange(int(size.sum()))]
        return out, counts


def _worker_encoder(tokenizer: str, end_id: int) -> Encoder:
    """The encoder of this worker process: it outlives a task, so the next one
    neither reads the tokenizer again nor starts without words."""
    kept = vars(sys.modules.setdefault("token_encoders", ModuleType("token_encoders")))
    key = f"{zlib.crc32(tokenizer.encode())}-{len(tokenizer)}-{end_id}"
    if key not in kept:
        kept[key] = Encoder(tokenizer, end_id)
    return kept[key]


def _shards(batches: Iterator[pa.RecordBatch], tokenizer: str, end_id: int, size: int) -> Iterator[pa.RecordBatch]:
    """Sorted (id, text) rows of a partition -> (content): its shard files."""
    encoder, part, shard = _worker_encoder(tokenizer, end_id), TaskContext.get().partitionId(), 0
    ids: list[np.ndarray] = []
    names: list[int | None] = []
    tokens: list[int] = []
    held = 0

    def close() -> pa.RecordBatch:
        content = shard_bytes(np.concatenate(ids), names, tokens, part, shard)
        return pa.RecordBatch.from_arrays([pa.array([content], pa.binary())], names=["content"])

    for batch in batches:
        for rows, _ in pieces(batch, 1, 4 * PIECE):
            found, counts = encoder.encode(rows.column(1))
            dids, ends, k = rows.column(0).to_pylist(), np.cumsum(counts), 0
            while k < len(dids):
                begin = int(ends[k - 1]) if k else 0
                stop = min(len(dids), 1 + int(np.searchsorted(ends, begin + size - held)))
                ids.append(found[begin:int(ends[stop - 1])])
                names += dids[k:stop]
                tokens += counts[k:stop].tolist()
                held += len(ids[-1])
                k = stop
                if held >= size:
                    yield close()
                    ids, names, tokens, held, shard = [], [], [], 0, shard + 1
    if names:
        yield close()


def write_shards(docs: DataFrame, path: str, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", size: int = SHARD) -> None:
    """Write the ids of all documents' texts, each followed by ``end_id``, as
    shard files under ``path``, in ascending order of the id.

    ``tokenizer``: the JSON of a tokenizer of the tokenizers library that drops
    white space. A null id comes first; rows of one id follow in order of a
    hash of their text, equal rows anyhow; a null or empty text has the end
    id alone. No rows: no files (or empty ones, read as none).
    """
    # the row's number keeps equal rows, however many, from being one range
    rows = docs.select(F.col(id_col).cast("long").alias("did"), F.col(text_col).cast("string").alias("text")).select(
        "did", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("tid"), F.monotonically_increasing_id().alias("n"))
    order = ["did", "tid", "n"]
    (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("did", "text")
     .mapInArrow(lambda it: _shards(it, tokenizer, end_id, size), "content binary")
     .select(F.col("content").cast("string")).write.option("maxRecordsPerFile", 1).text(path))


def _files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).where("length > 0").select("content")


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content in batch.column(0):
            wm = WaveletMatrix(content.as_py())
            did, known, tokens = wm.documents()
            ids = wm.ids().astype("<u4")
            start = np.cumsum(tokens) - tokens
            crc = [zlib.crc32(ids[a:a + n]) for a, n in zip(start.tolist(), tokens.tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(did), wm.meta[k])) for k in ("part", "shard")]
                + [pa.array(did, mask=~known), pa.array(start), pa.array(tokens), pa.array(crc, pa.int64())],
                names=["part", "shard", "doc_id", "at", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of
    ``path``: ids before it in the whole collection, its ids, and the crc32 of
    them as little-endian u32. The driver gets one number per partition that
    was written, not per document or file."""
    docs = cut(_files(spark, path).mapInArrow(_documents, "part long, shard long, doc_id long, at long, n_tokens long, ids_crc32 long"))
    shards = docs.groupBy("part", "shard").agg(F.sum("n_tokens").alias("n"))
    before, total = [], 0
    for r in sorted(shards.groupBy("part").agg(F.sum("n").alias("n")).collect()):
        before.append((r.part, total))
        total += r.n
    parts = spark.createDataFrame(before, "part long, before long")
    earlier = shards.alias("a").join(shards.alias("b"), F.expr("a.part = b.part and b.shard < a.shard"), "left").groupBy(
        F.col("a.part").alias("part"), F.col("a.shard").alias("shard")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("inside"))
    starts = earlier.join(parts, "part").select("part", "shard", (F.col("before") + F.col("inside")).alias("first"))
    return docs.join(starts, ["part", "shard"]).select(
        "doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")


def find_tokens(spark: SparkSession, path: str, tokens: list[int], places: bool = False) -> DataFrame:
    """(token, part, shard, n) for each shard that has the token, by rank; with
    ``places`` also (places: array of places in the shard), by select."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                wm = WaveletMatrix(content.as_py())
                rows = [{"token": t, "part": wm.meta["part"], "shard": wm.meta["shard"], "n": n, "places": wm.occurrences(t) if places else None}
                        for t in tokens if (n := wm.count(t))]
                yield pa.RecordBatch.from_pylist(rows, schema=schema)

    schema = pa.schema([*((c, pa.int64()) for c in ("token", "part", "shard", "n")), ("places", pa.list_(pa.int64()))])
    out = _files(spark, path).mapInArrow(look, "token long, part long, shard long, n long, places array<long>")
    return out if places else out.drop("places")
