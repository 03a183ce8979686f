"""Operator 3: token ids in files of directly addressable codes.

A segment holds the ids of some whole documents.  Each id is cut into chunks of ``CHUNK_BITS`` bits, lowest first.  Level 0
has the first chunk of every id and a bitmap telling which ids go on; level k has the next chunk of those that do.  A rank
directory counts the set bits before each block of a bitmap, so the place of an id's next chunk is one directory entry and
the bits of one block: any id is read without decoding those around it.

A file is a table of segments.  Documents are range-partitioned and sorted by id, so segments follow each other in
ascending doc_id.  Where each document starts among all ids comes from the segments' counts: sums per part, of which there
are as many as partitions, and a running sum within a part.
"""

from __future__ import annotations

import os
import re
import string
import struct
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.sources.workdir import new_folder

CHUNK_BITS = 8
RANK_BLOCK = 512
MAGIC = b"DAC1"
#: A segment is closed once it holds so many ids; a longer document has one of its own.
SEGMENT_IDS = 1 << 20
#: Words a worker remembers.
MEMORY = 1_200_000
#: Documents coded together, and words that go to the library together.
BATCH_DOCS, TOGETHER = 1000, 256
SEGMENTS = "part int, segment long, first_doc long, last_doc long, n_docs long, n_ids long, doc_ids binary, doc_ends binary, codes binary"


class DirectCodes:
    """A sequence of unsigned integers with random access to each."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @classmethod
    def build(cls, values: np.ndarray) -> DirectCodes:
        rest, levels = values.astype(np.uint64), []
        while True:
            chunk = (rest & np.uint64((1 << CHUNK_BITS) - 1)).astype(np.uint8)
            rest = rest >> np.uint64(CHUNK_BITS)
            goes_on = rest != 0
            bits = np.packbits(goes_on, bitorder="little")
            levels.append((chunk, bits, cls._directory(bits)))
            if not goes_on.any():
                return cls(levels)
            rest = rest[goes_on]

    @staticmethod
    def _directory(bits: np.ndarray) -> np.ndarray:
        """Set bits before each block."""
        step = RANK_BLOCK // 8
        padded = np.zeros(-(-len(bits) // step) * step, np.uint8)
        padded[: len(bits)] = bits
        per_block = np.bitwise_count(padded).reshape(-1, step).sum(1, dtype=np.uint32)
        return np.concatenate([[0], np.cumsum(per_block)]).astype(np.uint32)

    def __len__(self) -> int:
        return len(self.levels[0][0])

    def __getitem__(self, i: int) -> int:
        """One id, from one chunk, one directory entry and part of one block per level."""
        value = 0
        for k, (chunk, bits, directory) in enumerate(self.levels):
            value |= int(chunk[i]) << (k * CHUNK_BITS)
            if not bits[i >> 3] >> (i & 7) & 1:
                break
            block = i // RANK_BLOCK
            before = int.from_bytes(bits[block * RANK_BLOCK // 8 : (i >> 3) + 1].tobytes(), "little")
            i = int(directory[block]) + (before & ((1 << (i - block * RANK_BLOCK)) - 1)).bit_count()
        return value

    def all(self) -> np.ndarray:
        """Every id, level by level."""
        out = self.levels[0][0].astype(np.uint32)
        place = np.arange(len(out))
        for k, (_, bits, _) in enumerate(self.levels[:-1]):
            place = place[np.unpackbits(bits, count=len(place), bitorder="little").astype(bool)]
            out[place] |= self.levels[k + 1][0].astype(np.uint32) << np.uint32((k + 1) * CHUNK_BITS)
        return out

    def to_bytes(self) -> bytes:
        out = [MAGIC, struct.pack("<BBHI", CHUNK_BITS, len(self.levels), RANK_BLOCK, len(self))]
        for chunk, bits, directory in self.levels:
            out += [struct.pack("<III", len(chunk), len(bits), len(directory)), chunk.tobytes(), bits.tobytes(), directory.tobytes()]
        return b"".join(out)

    @classmethod
    def from_bytes(cls, data: bytes) -> DirectCodes:
        if data[:4] != MAGIC:
            raise ValueError("no file of directly addressable codes")
        _, n_levels, _, _ = struct.unpack_from("<BBHI", data, 4)
        at, levels = 12, []
        for _ in range(n_levels):
            sizes = struct.unpack_from("<III", data, at)
            at += 12
            level = []
            for kind, n in zip((np.uint8, np.uint8, np.uint32), sizes, strict=True):
                level.append(np.frombuffer(data, kind, n, at))
                at += n * np.dtype(kind).itemsize
            levels.append(tuple(level))
        return cls(levels)


class WordCoder:
    """Ids of whole texts by the tokenizers library, asked once per distinct word between ASCII white space.

    The vocabulary's normaliser and pattern treat white space as a separator, so the ids of a text are those of its chunks.
    Chunks of ASCII and Latin-1 letters are in normal form and share the ids of their lower case; ASCII punctuation at a
    chunk's end, behind such a letter, is a word of its own, so the chunk shares the rest with the plain word.  Arrow cuts a
    batch into chunks and finds the distinct words; their ids lie one behind the other in one array, from which numpy gathers
    those of every text.  Unseen words go to the library together.  Words of letters end where an id of the vocabulary's
    final pieces is, if there are as many as words; others have a digit between them to find their ends (digits are words of
    their own too).  Texts that may hold a special token's string go to it whole.
    """

    MARK, FINAL = "0", "</w>"
    LETTERS, PUNCTUATION = "A-Za-zÀ-ÖØ-öø-ÿ", string.punctuation
    PLAIN = rf"^[\x00-\x7f{LETTERS}]*$"
    TAIL = rf"(?P<tail>[{re.escape(PUNCTUATION)}]+)$"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self.library = Tokenizer.from_file(path)
        self.mark_id = int(self._ids(self.MARK)[0])
        vocabulary = self.library.get_vocab()
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for piece, i in vocabulary.items() if piece.endswith(self.FINAL)]] = True
        self._restart()

    def _restart(self) -> None:
        self.codes: dict[str, int] = {"": 0}
        self.ends, self.ids = array("q", [0, 0]), array("I")

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")

    def _remember(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        first = len(self.codes)
        self.codes.update(zip(words, range(first, first + len(words)), strict=True))
        self.ends.frombytes((ends + len(self.ids)).astype(np.int64).tobytes())
        self.ids.frombytes(ids.astype(np.uint32).tobytes())

    def _learn(self, words: list[str]) -> list[int]:
        letters, plain = [w for w in words if w.isalpha()], [w for w in words if not w.isalpha() and self.MARK not in w]
        for k in range(0, len(letters), TOGETHER):
            block = letters[k : k + TOGETHER]
            coded = self._ids(" ".join(block))
            ends = np.flatnonzero(self.final[coded]) + 1
            if len(ends) == len(block):
                self._remember(block, coded, ends)
            else:
                plain += block
        for k in range(0, len(plain), TOGETHER):
            block = plain[k : k + TOGETHER]
            coded = self._ids(f" {self.MARK} ".join(block))
            marks = np.flatnonzero(coded == self.mark_id)
            self._remember(block, np.delete(coded, marks), np.r_[marks - np.arange(len(marks)), len(coded) - len(marks)])
        for word in words:
            if self.MARK in word:
                ids = self._ids(word)
                self._remember([word], ids, np.array([len(ids)]))
        return [self.codes[w] for w in words]

    def _codes(self, words: pa.Array) -> np.ndarray:
        """The code of each word; unseen ones are learned."""
        encoded = words.dictionary_encode()
        names = encoded.dictionary.to_numpy(zero_copy_only=False)
        codes = np.fromiter(map(self.codes.get, names, repeat(-1)), np.int64, len(names))
        unseen = np.flatnonzero(codes < 0)
        codes[unseen] = self._learn(names[unseen].tolist())
        return codes[encoded.indices.to_numpy()]

    def _words(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Two codes a chunk, of the word and of the punctuation behind it, and the bounds of each text's chunks."""
        cut = pc.ascii_split_whitespace(texts)
        chunks = cut.flatten().dictionary_encode()
        distinct = chunks.dictionary
        distinct = pc.if_else(pc.match_substring_regex(distinct, self.PLAIN), pc.utf8_lower(distinct), distinct)
        tailed = pc.match_substring_regex(distinct, f"[{self.LETTERS}]{self.TAIL}")
        tails = pc.struct_field(pc.extract_regex(distinct.filter(tailed), self.TAIL), "tail")
        codes = np.zeros((len(distinct), 2), np.int64)
        codes[:, 0] = self._codes(pc.if_else(tailed, pc.utf8_rtrim(distinct, self.PUNCTUATION), distinct))
        codes[tailed.to_numpy(zero_copy_only=False), 1] = self._codes(tails)
        at = chunks.indices.to_numpy()
        bounds = cut.offsets.to_numpy().astype(np.int64)
        return codes[at].ravel(), 2 * (bounds - bounds[0])

    def encode(self, texts: list[bytes], end_id: int) -> list[bytes]:
        """Packed little-endian 32-bit ids of each text, with the end id."""
        ids, ends = self.encode_batch(pa.array(texts, pa.large_binary()).cast(pa.large_string()), end_id)
        return [own.astype("<u4").tobytes() for own in np.split(ids, ends[:-1])] if texts else []

    def encode_batch(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, an end id behind each text's, and where each text's ids end."""
        if len(self.codes) > MEMORY:
            self._restart()
        whole = np.flatnonzero(pc.match_substring(texts, "<|").to_numpy(zero_copy_only=False))
        apart = {i: self._ids(texts[i].as_py()) for i in whole.tolist()}
        if apart:
            texts = pc.if_else(pc.match_substring(texts, "<|"), "", texts)
        codes, bounds = self._words(texts)
        ends = np.frombuffer(self.ends, np.int64).copy()
        first, n = ends[codes], ends[codes + 1] - ends[codes]
        upto = np.r_[0, np.cumsum(n)]
        ids = np.frombuffer(self.ids, np.uint32)[np.repeat(first - upto[:-1], n) + np.arange(upto[-1])]
        sizes = np.diff(upto[bounds])
        for i, own in apart.items():
            at = upto[bounds[i]] + sum(len(apart[j]) for j in apart if j < i)
            ids, sizes[i] = np.insert(ids, at, own), len(own)
        return np.insert(ids, np.cumsum(sizes), end_id), np.cumsum(sizes + 1)


@lru_cache(maxsize=2)
def coder(path: str) -> WordCoder:
    return WordCoder(path)


def _segments(batches: Iterator[pa.RecordBatch], tokenizer_path: str, end_id: int) -> Iterator[pa.RecordBatch]:
    part, number = TaskContext.get().partitionId(), 0
    held: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []  # document ids, token ids, how many each document has

    def close() -> pa.RecordBatch:
        doc_ids = pa.chunked_array([h[0] for h in held])
        values, sizes = np.concatenate([h[1] for h in held]), np.concatenate([h[2] for h in held])
        known = doc_ids.drop_null()
        # a null id is written as the smallest long, with which no document is numbered
        ids = doc_ids.fill_null(np.iinfo(np.int64).min).to_numpy()
        row = {
            "part": part, "segment": number, "first_doc": known[0].as_py() if len(known) else None, "last_doc": known[-1].as_py() if len(known) else None,
            "n_docs": len(ids), "n_ids": len(values), "doc_ids": ids.astype("<i8").tobytes(), "doc_ends": np.cumsum(sizes).astype("<i8").tobytes(),
            "codes": DirectCodes.build(values).to_bytes(),
        }
        kinds = (pa.int32(), *[pa.int64()] * 5, *[pa.binary()] * 3)
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row.values(), kinds, strict=True)], names=list(row))

    for batch in batches:
        texts = batch.column(1).cast(pa.large_string()).fill_null("")
        for k in range(0, batch.num_rows, BATCH_DOCS):
            doc_ids = batch.column(0)[k : k + BATCH_DOCS]
            values, ends = coder(tokenizer_path).encode_batch(texts[k : k + BATCH_DOCS], end_id)
            first = 0
            while first < len(ends):
                start = int(ends[first - 1]) if first else 0
                room = SEGMENT_IDS - sum(len(h[1]) for h in held)
                last = min(int(np.searchsorted(ends, start + room)) + 1, len(ends))
                held.append((doc_ids[first:last], values[start : ends[last - 1]], np.diff(ends[first:last], prepend=start)))
                if ends[last - 1] - start >= room:
                    yield close()
                    held, number = [], number + 1
                first = last
    if held:
        yield close()


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int = 2, doc_id: str = "doc_id", text: str = "text") -> None:
    """Writes the ids of every whole text, an end id behind each, in ascending doc_id order.

    Null and empty texts have the end id alone.  Rows with equal ids all stay, ordered by their text's hash; rows with a
    null id come first.  An empty table gives an empty file.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.repartitionByRange("doc_id", F.xxhash64("text")).sortWithinPartitions("doc_id", F.xxhash64("text"))
    rows.mapInArrow(lambda it: _segments(it, tokenizer_path, end_id), SEGMENTS).write.parquet(path)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SEGMENTS).parquet(path)


def segment_starts(segments: DataFrame) -> DataFrame:
    """(part, segment, base): ids before each segment.  One row per part reaches the driver."""
    spark = segments.sparkSession
    counts = segments.select("part", "segment", "n_ids")
    base, bases = 0, []
    for r in sorted(counts.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()):
        bases.append((r.part, base))
        base += r.n
    before = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    parts = spark.createDataFrame(bases, "part int, part_base long")
    within = counts.withColumn("within", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
    return within.join(parts, "part").select("part", "segment", (F.col("part_base") + F.col("within")).alias("base"))


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    smallest = np.iinfo(np.int64).min
    for batch in batches:
        for row in range(batch.num_rows):
            get = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
            values = np.ascontiguousarray(DirectCodes.from_bytes(get["codes"]).all().astype("<u4"))
            ids, ends = np.frombuffer(get["doc_ids"], "<i8"), np.frombuffer(get["doc_ends"], "<i8")
            starts = np.concatenate([[0], ends[:-1]])
            crcs = [zlib.crc32(values[a:b]) for a, b in zip(starts, ends, strict=True)]
            n = len(ids)
            arrays = [
                pa.array(ids, mask=ids == smallest), pa.array(np.full(n, get["part"], np.int32)), pa.array(np.full(n, get["segment"])),
                pa.array(starts), pa.array(ends - starts), pa.array(crcs, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "part", "segment", "local", "n_tokens", "ids_crc32"])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document, from the files: start among all ids, number of ids, checksum of the ids."""
    segments = read_segments(spark, path)
    wanted = segments.select("part", "segment", "doc_ids", "doc_ends", "codes")
    docs = wanted.mapInArrow(_documents, "doc_id long, part int, segment long, local long, n_tokens long, ids_crc32 long")
    return docs.join(segment_starts(segments), ["part", "segment"]).select(
        "doc_id", (F.col("base") + F.col("local")).alias("start"), "n_tokens", "ids_crc32"
    )


def token_file_digests(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Writes the files under the shared folder, then describes every document from them."""
    path = new_folder(docs.sparkSession, "token-files")
    write_token_files(docs, path, tokenizer_path)
    return read_documents(docs.sparkSession, path)
