"""Operator 12: cross-tokenizer alignment by external spill counting.

Vocabulary A is byte-level BPE over a space and the text, vocabulary B a piece model that puts that space in front itself, so
both cut the same bytes.  Where ends of both meet, a group closes; overlapping tokens of a group are links.

A word behind a space, or behind a line break, is tokenised alike wherever it stands, as neither vocabulary merges across
those places, so each distinct chunk is asked from the libraries once per worker, with its links and groups.

Counting spills.  Tasks gather records (pair, document, links of the pair in it) into runs of bounded size; a full run is
dealt by the low bits of the A id into parts, each sorted side-major (A id, then B id, then document) and written as two zstd
frames: a head with every pair and the number of its documents, and a body with the records.  Heads of a part are merged by
a heap, a bounded number of runs at a time and in as many levels as that takes; the last level meets the pairs of an A id
together, so the highest count of the id is known when the next begins.  Then bodies stream past their part's counts, each
run in any task, and send every document's sums back.  A pair that all documents hold is one head entry per run, and its
records stay spread over the runs that hold them.
"""

from __future__ import annotations

import hashlib
import heapq
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallyhouse.sources.workdir import settle

SPACE = "▁"
#: Bits of a B id in a pair's number.
B_BITS = 16
#: Parts that pairs are dealt to; all pairs of an A id are in one.
PARTS = 16
#: Records and documents of a run, and runs merged by one heap or held against one copy of a part's counts.
RUN_RECORDS, RUN_DOCS, FAN_IN, RUNS_PER_COPY = 1 << 20, 1 << 15, 256, 64
#: Chunks, and links of chunks, that a worker remembers.
MEMORY, MEMORY_LINKS = 300_000, 6_000_000
#: Pairs of one row of counts.
COUNT_ROW = 1 << 17
BATCH_DOCS = 256
#: Words that go to the libraries together.
TOGETHER = 2000

#: Where both vocabularies start anew: a single space or line break between other characters.
CHUNK = re.compile(r"(?<=\S)(?=[ \n]\S)")
WHITE = re.compile(r"\s")
RUNS = (
    "kind int, run long, ordinal int, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "part int, n_docs int, head binary, body binary"
)


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte in byte-level vocabularies: itself where printable, else the next above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Aligner:
    """Tokens of both vocabularies for chunks of text, with their links and groups; remembers chunks."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        vocabulary = {i: bytes(alphabet.get(c, 0) for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()}
        self.a_bytes = [vocabulary.get(i, b"") for i in range(max(vocabulary) + 1)]
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if len(pieces) > 1 << B_BITS:
            raise ValueError(f"a pair's number holds {B_BITS} bits of an id")
        if any(re.search(f"[^{SPACE}]{SPACE}|.\n|\n.", p, re.S) for i, p in enumerate(pieces) if not self.b.is_control(i)):
            raise ValueError("the model has pieces that cross a word's start; chunks would not be independent")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(pieces)]
        self.mark = self.b.piece_to_id(SPACE)
        self.a_sizes, self.b_sizes = (np.array([len(t) for t in of]) for of in (self.a_bytes, self.b_bytes))
        # an id as text, within and at the end of its side of a group
        self.a_names, self.b_names = (np.array([[f"{i}{c}" for i in range(len(of))] for c in "," + end], object) for of, end in ((self.a_bytes, "|"), (self.b_bytes, ";")))
        self.restart()

    def restart(self) -> None:
        self.known: dict[str, int] = {}
        self.groups: dict[str, str] = {}  # a chunk's groups, a semicolon behind each
        self.counts = array("q")  # n_a, n_b, n_groups, n_links of each chunk; n_a is -1 where bytes differ
        self.ends = array("q", [0])
        self.pairs = array("Q")

    def full(self) -> bool:
        return len(self.known) > MEMORY or len(self.pairs) > MEMORY_LINKS

    def keys(self, text: str) -> list[str]:
        """Chunks of a space and the text.  A word behind a single space goes by its name, any other chunk as it is."""
        words = text.split()
        if " ".join(words) == text.replace("\n", " "):
            return text.replace("\n", " \n").split(" ") if "\n" in text else words
        return [c[1:] if c[0] == " " and not c[1:2].isspace() and len(c) > 1 else c for c in CHUNK.split(" " + text)]

    def learn(self, keys: set[str]) -> None:
        """Remembers chunks.  Words go to the libraries many at a time; other chunks, and words whose bytes change, alone."""
        fresh = [k for k in keys if k not in self.known]
        words = [k for k in fresh if not WHITE.search(k, k[0] == "\n")]
        for k in range(0, len(words), TOGETHER):
            self._learn_words(words[k : k + TOGETHER])
        for key in fresh:
            if key not in self.known:
                chunk = key if key[0] in " \n" else " " + key
                self._remember([key], [chunk.encode()], *self._ids(chunk))

    def _ids(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Ids of both vocabularies for a text that starts with white space."""
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:] if text[0] == " " else text, num_threads=1)
        if text[0] != " ":  # a mark that stands for no byte of the text is put in front
            if b[0] != self.mark:
                raise ValueError("the model merges its first mark with a line break")
            b = b[1:]
        return np.array(a, np.int64), np.array(b, np.int64)

    def _learn_words(self, words: list[str]) -> None:
        chunks = [" a", *(w if w[0] == "\n" else " " + w for w in words)]
        a, b = self._ids("".join(chunks))
        raw = [c.encode() for c in chunks]
        joined = b"".join(raw)
        if all(b"".join(map(of.__getitem__, ids.tolist())) == joined for of, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            # the first word, which keeps a line break from the start, is left out
            self._remember(words, raw[1:], a[np.cumsum(self.a_sizes[a]) > 2], b[np.cumsum(self.b_sizes[b]) > 2])

    def _remember(self, keys: list[str], raw: list[bytes], a: np.ndarray, b: np.ndarray) -> None:
        """Aligns chunks that follow each other; token ends meet at their bounds.

        Between two neighbouring ends of either side lies one link: of the token of A and that of B that reach over it.
        """
        if len(raw) == 1 and any(b"".join(map(of.__getitem__, ids.tolist())) != raw[0] for of, ids in ((self.a_bytes, a), (self.b_bytes, b))):
            counts, strings, ends, pairs = np.array([[-1, 0, 0, 0]]), [""], np.zeros(1, np.int64), np.zeros(0, np.uint64)
        else:
            bounds = np.cumsum([len(r) for r in raw])
            a_ends, b_ends = np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])
            meet = np.intersect1d(a_ends, b_ends, assume_unique=True)
            reach = np.union1d(a_ends, b_ends)
            pairs = (a[np.searchsorted(a_ends, reach)] << B_BITS | b[np.searchsorted(b_ends, reach)]).astype(np.uint64)
            upto = [np.r_[0, np.searchsorted(x, bounds, "right")] for x in (a_ends, b_ends, meet, reach)]
            counts, ends = np.stack([np.diff(u) for u in upto], axis=1), upto[3][1:]
            a_group, b_group = np.searchsorted(meet, a_ends), np.searchsorted(meet, b_ends)
            names = np.concatenate([self.a_names[np.isin(a_ends, meet).astype(int), a], self.b_names[np.isin(b_ends, meet).astype(int), b]])
            names = names[np.argsort(np.concatenate([2 * a_group, 2 * b_group + 1]), kind="stable")].tolist()
            cuts = (upto[0] + upto[1]).tolist()
            strings = ["".join(names[x:y]) for x, y in zip(cuts[:-1], cuts[1:], strict=True)]
        start = len(self.known)
        self.known.update(zip(keys, range(start, start + len(keys)), strict=True))
        self.groups.update(zip(keys, strings, strict=True))
        self.counts.frombytes(counts.astype(np.int64).tobytes())
        self.ends.frombytes((ends + len(self.pairs)).astype(np.int64).tobytes())
        self.pairs.frombytes(pairs.tobytes())

    def batch(self, texts: list[str | None]) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """Of some texts: their four counts, their groups' digests, and records (text, pair, links) in order of text and pair."""
        if self.full():
            self.restart()
        keys = [self.keys(t) if t else [] for t in texts]
        self.learn(set().union(*keys))
        sizes = [len(k) for k in keys]
        flat = np.fromiter(map(self.known.__getitem__, chain.from_iterable(keys)), np.int64, sum(sizes))
        owner = np.repeat(np.arange(len(texts)), sizes)
        counts = np.frombuffer(self.counts, np.int64).reshape(-1, 4).copy()
        bad = np.zeros(len(texts), bool)
        bad[owner[counts[flat, 0] < 0]] = True
        flat, owner = flat[~bad[owner]], owner[~bad[owner]]
        sums = np.stack([np.bincount(owner, counts[flat, k], len(texts)) for k in range(4)]).astype(np.int64)
        digests = [
            "" if lost or not own else hashlib.sha256("".join(map(self.groups.__getitem__, own))[:-1].encode()).hexdigest()
            for lost, own in zip(bad, keys, strict=True)
        ]
        chunk, times = np.unique(owner << 32 | flat, return_counts=True)
        owner, chunk = chunk >> 32, chunk & 0xFFFFFFFF
        ends = np.frombuffer(self.ends, np.int64).copy()
        n = ends[chunk + 1] - ends[chunk]
        at = np.repeat(ends[chunk] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        record = np.repeat(owner, n).astype(np.uint64) << np.uint64(40) | np.frombuffer(self.pairs, np.uint64)[at]
        order = np.argsort(record, kind="stable")
        record, times = record[order], np.repeat(times, n)[order]
        first = np.flatnonzero(np.r_[True, record[1:] != record[:-1]]) if len(record) else np.zeros(0, np.int64)
        links = np.add.reduceat(times, first) if len(first) else times
        record = record[first]
        return sums, digests, (record >> np.uint64(40)).astype(np.int64), (record & np.uint64((1 << 40) - 1)).astype(np.int64), links


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


def _frame(*arrays: np.ndarray) -> bytes:
    """Arrays of one length as a zstd frame, each behind the other."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(a.tobytes() for a in arrays))


def _columns(frame: bytes, *kinds: str) -> list[np.ndarray]:
    data = zstandard.ZstdDecompressor().decompress(frame)
    n = len(data) // sum(np.dtype(k).itemsize for k in kinds)
    out, at = [], 0
    for kind in kinds:
        out.append(np.frombuffer(data, kind, n, at))
        at += n * np.dtype(kind).itemsize
    return out


def _batch(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def spill_runs(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Rows of two kinds: 0, a document with its counts; 1, a part of a run with its head and body.  A run is of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        held: list[tuple[np.ndarray, ...]] = []
        records = 0

        def close() -> pa.RecordBatch:
            doc, pair, links = (np.concatenate(c) for c in zip(*held, strict=True))
            part = (pair >> B_BITS) % PARTS
            order = np.lexsort((doc, pair, part))
            doc, pair, links, part = doc[order], pair[order], links[order], part[order]
            cuts = np.searchsorted(part, np.arange(PARTS + 1))
            for p, (x, y) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                if x < y:
                    pairs, n = np.unique(pair[x:y], return_counts=True)
                    head, body = _frame(pairs.astype("<i8"), n.astype("<i8")), _frame(doc[x:y].astype("<u4"), links[x:y].astype("<u4"))
                    rows.append((1, number, *[None] * 7, p, int(doc[-1]) + 1 if x < y else 0, head, body))
            n_docs = sum(r[0] == 0 for r in rows)
            return _batch(RUNS, [(*r[:10], n_docs, *r[11:]) if r[0] else r for r in rows])

        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for k in range(0, len(ids), BATCH_DOCS):
                some = texts[k : k + BATCH_DOCS].to_pylist()
                sums, digests, doc, pair, links = aligner(a_path, b_path).batch(some)
                base = sum(r[0] == 0 for r in rows)
                rows += [(0, number, base + i, ids[k + i], *sums[:, i].tolist(), digests[i], *[None] * 4) for i in range(len(some))]
                held.append((doc + base, pair, links))
                records += len(pair)
                if records >= RUN_RECORDS or base + len(some) >= RUN_DOCS:
                    yield close()
                    rows, held, records, number = [], [], 0, number + 1
        if rows:
            yield close()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, RUNS)


def _merged(heads: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of several sorted heads with their summed counts, by a heap over the heads."""
    streams = [zip(*(c.tolist() for c in _columns(h, "<i8", "<i8")), strict=True) for h in heads]
    pairs, counts = array("q"), array("q")
    for pair, same in groupby(heapq.merge(*streams), key=itemgetter(0)):
        pairs.append(pair)
        counts.append(sum(n for _, n in same))
    return np.frombuffer(pairs, np.int64), np.frombuffer(counts, np.int64)


def _by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list]]:
    """Consecutive rows with equal leading columns, each as its remaining values; rows of a group are held together."""
    rows = (tuple(c[k].as_py() for c in batch.columns) for batch in batches for k in range(batch.num_rows))
    for key, same in groupby(rows, key=lambda r: r[:keys]):
        yield key, (r[keys:] for r in same)


def pair_counts(runs: DataFrame) -> DataFrame:
    """(part, chunk, pairs, counts, best): documents that hold each pair linked, and whether no pair of the A id has more."""
    heads = runs.filter("kind = 1").selectExpr("part", "run as piece", "head")
    pieces = heads.select("piece").distinct().count()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part, share), rows in _by_group(batches, 2):
            yield _batch("part int, piece long, head binary", [(part, share, _frame(*_merged([h for (h,) in rows])))])

    while pieces > FAN_IN:
        shares = -(-pieces // FAN_IN)
        dealt = heads.selectExpr("part", f"pmod(xxhash64(piece), {shares}) as share", "head")
        dealt = dealt.repartition("part", "share").sortWithinPartitions("part", "share")
        heads, pieces = settle(dealt.mapInArrow(merge, "part int, piece long, head binary"), "merged-heads"), shares

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (part,), rows in _by_group(batches, 1):
            pairs, counts = _merged([h for (h,) in rows])
            starts = np.flatnonzero(np.r_[True, (pairs[1:] >> B_BITS) != (pairs[:-1] >> B_BITS)])
            highest = np.repeat(np.maximum.reduceat(counts, starts), np.diff(np.r_[starts, len(pairs)]))
            best = counts == highest
            for k in range(0, len(pairs), COUNT_ROW):
                cut = slice(k, k + COUNT_ROW)
                row = (part, k // COUNT_ROW, *(_frame(c[cut]) for c in (pairs.astype("<i8"), counts.astype("<i8"), best.astype("u1"))))
                yield _batch("part int, chunk int, pairs binary, counts binary, best binary", [row])

    last = heads.select("part", "head").repartition("part").sortWithinPartitions("part")
    return last.mapInArrow(finish, "part int, chunk int, pairs binary, counts binary, best binary")


def alignment_table(counts: DataFrame) -> DataFrame:
    """(a_id, b_id, n_docs, best): the corpus-wide alignment of the two vocabularies, from ``pair_counts``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frames in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                (pairs,), (n,), (best,) = (_columns(f, k) for f, k in zip(frames, ("<i8", "<i8", "u1"), strict=True))
                columns = (pairs >> B_BITS, pairs & ((1 << B_BITS) - 1), n, best.astype(bool))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["a_id", "b_id", "n_docs", "best"])

    return counts.select("pairs", "counts", "best").mapInArrow(run, "a_id long, b_id long, n_docs long, best boolean")


def _contributions(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """(run, sums): per run and part the sums of counts, and of best links, of the run's documents."""
    bodies = runs.filter("kind = 1")
    copies = -(-bodies.select("run").distinct().count() // RUNS_PER_COPY) or 1
    tables = counts.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    tables = tables.selectExpr("part", "copy", "0 as kind", "bigint(chunk) as place", "pairs as x", "counts as y", "best as z", "0 as n_docs")
    own = bodies.selectExpr("part", f"int(pmod(xxhash64(run), {copies})) as copy", "1 as kind", "run as place", "head as x", "body as y", "binary('') as z", "n_docs")
    both = tables.unionByName(own).repartition("part", "copy").sortWithinPartitions("part", "copy", "kind", "place")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_group(batches, 2):
            table: list[tuple] = []
            pairs = n_of = best_of = None
            for kind, place, x, y, z, n_docs in rows:
                if kind == 0:
                    table.append((*_columns(x, "<i8"), *_columns(y, "<i8"), *_columns(z, "u1")))
                    continue
                if pairs is None:
                    pairs, n_of, best_of = (np.concatenate(c) for c in zip(*table, strict=True))
                held, n = _columns(x, "<i8", "<i8")
                doc, links = _columns(y, "<u4", "<u4")
                at = np.repeat(np.searchsorted(pairs, held), n)
                links = links.astype(np.int64)
                sums = np.zeros((2, n_docs), np.int64)
                np.add.at(sums[0], doc, links * n_of[at])
                np.add.at(sums[1], doc, links * best_of[at])
                yield _batch("run long, sums binary", [(place, _frame(sums))])

    return both.mapInArrow(run, "run long, sums binary")


def _document_sums(parts: DataFrame) -> DataFrame:
    """(run, ordinal, n_best, count_sum), the parts of a run added."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (number,), rows in _by_group(batches, 1):
            total = None
            for (frame,) in rows:
                (flat,) = _columns(frame, "<i8")
                total = flat.copy() if total is None else total + flat
            counts, best = total.reshape(2, -1)
            columns = (np.full(len(best), number), np.arange(len(best), dtype=np.int32), best, counts)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["run", "ordinal", "n_best", "count_sum"])

    return parts.repartition("run").sortWithinPartitions("run").mapInArrow(run, "run long, ordinal int, n_best long, count_sum long")


def align_tokens(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Per document row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256.

    A null or empty text, or one whose pieces do not give its bytes back, has no tokens: zeros and an empty digest.  Strings of
    special tokens are plain text.  Every row counts as a document, repeated ones and those without an id too; further columns
    are not read.  An empty table gives an empty one.  Memory follows the run and the longest text.
    """
    runs = settle(spill_runs(docs, a_path, b_path), "token-runs")
    counts = settle(pair_counts(runs), "pair-counts")
    sums = _document_sums(settle(_contributions(runs, counts), "pair-sums"))
    rows = runs.filter("kind = 0").select("run", "ordinal", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")
    zero = F.lit(0).cast("long")
    return rows.join(sums, ["run", "ordinal"], "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256"
    )
