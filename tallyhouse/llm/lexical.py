"""Operator 13: ranked lexical search by Block-Max MaxScore.

Tasks cut their documents into segments of bounded size, each with an inverted list per term, in blocks of ``BLOCK`` postings
packed to the least bytes.  A block keeps, unpacked, its last document and its competitive (occurrences, length) pairs, those
that no other pair of the block beats in both.  The largest score of a block or a list is then known for any counts of the
corpus, so texts are read once, and the counts (documents, terms, documents of each term) are summed from the segments.

A query walks a segment in windows of documents.  Its terms are ordered by the largest score of their lists.  Those whose
sum stays below the worst of the best scores so far are not essential: a document that has no other term can't enter.
Essential lists are unpacked and scored; on the others, from the largest down, the largest score of the block a candidate
would be in rejects it before that block is unpacked.  Segments are grouped, a group's heap goes on from segment to segment,
and the groups' heaps are merged per query.  All scores are integers, so bounds are exact and ties are kept.

Terms are told apart by 64-bit hashes: of V different terms, two fall together with a chance of V^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm import bytetext
from tallyhouse.llm.columns import unused
from tallyhouse.sources.workdir import settle

NEAREST = 10
#: Postings of a block, of a segment and of the segments that share a heap; documents of a segment; queries of a block.
BLOCK, SEGMENT_POSTINGS, GROUP_POSTINGS, SEGMENT_DOCS, QUERY_BLOCK = 128, 1 << 20, 1 << 21, 1 << 16, 256
#: Documents of a walk's first and of its largest window.
FIRST_WINDOW, LAST_WINDOW = 512, 8192
#: Distinct terms of the queries up to which tasks get them with the job; beyond it lists of all terms are kept.
TERM_FILTER = 1_000_000

#: Bytes of words: ASCII letters and digits, and all that is not ASCII.
SEPARATORS = np.ones(256, bool)
SEPARATORS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False

ARRAYS = {
    "docs": "<i8", "no_id": "u1", "lengths": "<i8", "terms": "<u8", "df": "<i8", "first_block": "<i8",
    "last_doc": "<i4", "at": "<i8", "widths": "u1", "pair_ends": "<i8", "pair_tf": "<i8", "pair_n": "<i8", "data": "u1",
}
SEGMENT = "segment long, n_docs long, n_words long, n_postings long, " + ", ".join(f"{name} binary" for name in ARRAYS)
KINDS = np.array(["u1", "<u2", "<u4"])


def _width(most: np.ndarray) -> np.ndarray:
    """Which of ``KINDS`` holds the numbers."""
    return (most > 0xFF).astype(np.uint8) + (most > 0xFFFF)


def build_segment(docs: list, lengths: np.ndarray, terms: np.ndarray, owner: np.ndarray, tf: np.ndarray) -> dict[str, np.ndarray]:
    """The arrays of a segment from documents and their postings (term, document number, occurrences)."""
    ids = np.array([0 if d is None else d for d in docs], np.int64)
    no_id = np.array([d is None for d in docs], bool)
    order = np.lexsort((ids, no_id))  # documents in the order in which ties are broken
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    ids, no_id, lengths = ids[order], no_id[order], lengths[order]
    by_term = np.lexsort((number[owner], terms))
    terms, owner, tf = terms[by_term], number[owner][by_term], tf[by_term]
    starts = np.flatnonzero(np.r_[True, terms[1:] != terms[:-1]]) if len(terms) else np.zeros(0, np.int64)
    df = np.diff(np.r_[starts, len(terms)])
    blocks = -(-df // BLOCK)
    first_block = np.r_[0, np.cumsum(blocks)]
    within = np.arange(first_block[-1]) - np.repeat(first_block[:-1], blocks)
    lo = np.repeat(starts, blocks) + within * BLOCK
    hi = np.minimum(lo + BLOCK, np.repeat(starts + df, blocks))
    gaps = np.diff(owner, prepend=-1)
    gaps[starts] = owner[starts] + 1
    last_doc = owner[hi - 1] if len(hi) else np.zeros(0, np.int64)
    widths = np.stack([_width(np.maximum.reduceat(gaps, lo)), _width(np.maximum.reduceat(tf, lo))], 1) if len(lo) else np.zeros((0, 2), np.uint8)
    data, at, pairs, pair_ends = [], [0], [], []
    n_pairs = 0
    for x, y, (gap_kind, tf_kind) in zip(lo.tolist(), hi.tolist(), widths.tolist(), strict=True):
        packed = gaps[x:y].astype(KINDS[gap_kind]).tobytes() + tf[x:y].astype(KINDS[tf_kind]).tobytes()
        data.append(packed)
        at.append(at[-1] + len(packed))
        n, count = lengths[owner[x:y]], tf[x:y]
        rank = np.lexsort((-count, n))
        count, n = count[rank], n[rank]
        beats = count > np.r_[0, np.maximum.accumulate(count)[:-1]]  # more occurrences than any shorter document
        pairs.append((count[beats], n[beats]))
        n_pairs += int(beats.sum())
        pair_ends.append(n_pairs)
    empty = np.zeros(0, np.int64)
    return {
        "docs": ids, "no_id": no_id, "lengths": lengths, "terms": terms[starts], "df": df, "first_block": first_block, "last_doc": last_doc,
        "at": np.array(at), "widths": widths.ravel(), "pair_ends": np.array(pair_ends, np.int64), "pair_tf": np.concatenate([p[0] for p in pairs] or [empty]),
        "pair_n": np.concatenate([p[1] for p in pairs] or [empty]), "data": np.frombuffer(b"".join(data), np.uint8),
    }


class Segment:
    """A segment under the counts of the whole corpus."""

    def __init__(self, arrays: dict[str, np.ndarray], n_docs: int, n_words: int):
        self.__dict__.update(arrays)
        self.widths = self.widths.reshape(-1, 2)
        self.m = self._norm(self.lengths, n_docs, n_words)
        if len(self.at) > 1:
            part = self._part(self.pair_tf, self._norm(self.pair_n, n_docs, n_words))
            self.block_most = np.maximum.reduceat(part, np.r_[0, self.pair_ends[:-1]])
            self.list_most = np.maximum.reduceat(self.block_most, self.first_block[:-1])
        else:
            self.block_most = self.list_most = np.zeros(0, np.int64)

    @staticmethod
    def _norm(n: np.ndarray, n_docs: int, n_words: int) -> np.ndarray:
        return 10 + 90 * n * n_docs // n_words

    @staticmethod
    def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        """What a document's occurrences of a term count for, before the term's weight; grows with tf, falls with m."""
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)

    def unpack(self, block: int, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Documents and occurrences of a block; ``first`` of its list."""
        gap_kind, tf_kind = (KINDS[k] for k in self.widths[block])
        x, y = int(self.at[block]), int(self.at[block + 1])
        n = (y - x) // (np.dtype(gap_kind).itemsize + np.dtype(tf_kind).itemsize)
        gaps = np.frombuffer(self.data, gap_kind, n, x)
        tf = np.frombuffer(self.data, tf_kind, n, x + gaps.nbytes)
        return np.cumsum(gaps, dtype=np.int64) + (-1 if first else int(self.last_doc[block - 1])), tf.astype(np.int64)

    def search(self, terms: np.ndarray, weights: np.ndarray, best: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> None:
        """Takes the segment's documents into ``best``: scores, ids and whether the id is missing, best first."""
        at = np.searchsorted(self.terms, terms)
        here = at < len(self.terms)
        here[here] = self.terms[at[here]] == terms[here]
        at, weights = at[here], weights[here]
        most = weights * self.list_most[at]
        order = np.argsort(most, kind="stable")
        order = order[most[order] > 0]
        lists = [(int(self.first_block[t]), int(self.first_block[t + 1]), int(w)) for t, w in zip(at[order], weights[order], strict=True)]
        if not lists:
            return
        upto = np.r_[0, np.cumsum(most[order])]
        n, lo, size = len(self.docs), 0, FIRST_WINDOW
        while lo < n:
            hi = min(lo + size, n)
            worst = int(best[0][0][k - 1]) if len(best[0][0]) >= k else 1
            essential = int(np.searchsorted(upto, worst, "left")) - 1  # lists before it can't reach ``worst`` together
            essential = max(essential, 0)
            if essential >= len(lists):
                return  # nothing in this segment can
            score = np.zeros(hi - lo, np.int64)
            for first, end, w in lists[essential:]:
                x = first + int(np.searchsorted(self.last_doc[first:end], lo))
                y = min(first + int(np.searchsorted(self.last_doc[first:end], hi - 1)) + 1, end)
                for b in range(x, y):
                    docs, tf = self.unpack(b, b == first)
                    inside = slice(int(np.searchsorted(docs, lo)), int(np.searchsorted(docs, hi)))
                    docs = docs[inside]
                    score[docs - lo] += w * self._part(tf[inside], self.m[docs])
            found = np.flatnonzero((score > 0) & (score + upto[essential] >= worst))
            score, found = score[found], found + lo
            for number in range(essential - 1, -1, -1):
                if not len(found):
                    break
                first, end, w = lists[number]
                block = first + np.searchsorted(self.last_doc[first:end], found)
                bound = np.where(block < end, w * self.block_most[np.minimum(block, end - 1)], 0)
                stays = score + bound + upto[number] >= worst
                found, score, block = found[stays], score[stays], block[stays]
                for b in np.unique(block[block < end]).tolist():
                    docs, tf = self.unpack(b, b == first)
                    mine = np.flatnonzero(block == b)
                    place = np.searchsorted(docs, found[mine])
                    hit = docs[place] == found[mine]
                    mine, place = mine[hit], place[hit]
                    score[mine] += w * self._part(tf[place], self.m[docs[place]])
                stays = score + upto[number] >= worst
                found, score = found[stays], score[stays]
            if len(found):
                score, ids, no_id = (np.concatenate(c) for c in zip(best[0], (score, self.docs[found], self.no_id[found].astype(bool)), strict=True))
                top = np.lexsort((ids, no_id, -score))[:k]
                best[0] = (score[top], ids[top], no_id[top])
            lo, size = hi, min(2 * size, LAST_WINDOW)


def query_terms(queries: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item, query_key, terms): the distinct terms of each query with any; equal rows are one query."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in bytetext.runs(batch.column(2)):
                w = bytetext.words(r, SEPARATORS)
                own = [np.unique(w.hashes[x:y]).view(np.int64) for x, y in zip(w.first[:-1], w.first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[r.first : r.last], batch.column(1)[r.first : r.last], pa.array(own, pa.list_(pa.int64()))], names=["item", "query_key", "terms"]
                )

    rows = queries.select(F.col(item).alias("item"), F.xxhash64(text).alias("query_key"), F.col(text).alias("text")).distinct()
    kind = rows.schema["item"].dataType.simpleString()
    return rows.mapInArrow(run, f"item {kind}, query_key long, terms array<long>").filter("size(terms) > 0")


def build_index(docs: DataFrame, only: np.ndarray | None = None) -> DataFrame:
    """Segments of all documents with a term; lists of the terms in ``only`` (ascending hashes), or of all terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        parts: list[tuple[np.ndarray, ...]] = []
        held = 0

        def close() -> pa.RecordBatch:
            lengths, terms, owner, tf = (np.concatenate(c) for c in zip(*parts, strict=True))
            arrays = build_segment(ids, lengths, terms, owner, tf)
            row = [number, len(ids), int(lengths.sum()), len(terms), *(np.ascontiguousarray(arrays[k].astype(t)).tobytes() for k, t in ARRAYS.items())]
            kinds = [pa.int64()] * 4 + [pa.binary()] * len(ARRAYS)
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names=["segment", "n_docs", "n_words", "n_postings", *ARRAYS])

        for batch in batches:
            doc_ids = batch.column(0).to_pylist()
            for r in bytetext.runs(batch.column(1)):
                w = bytetext.words(r, SEPARATORS)
                lengths = np.diff(w.first)
                with_words = np.flatnonzero(lengths)
                if not len(with_words):
                    continue
                place = np.cumsum(lengths > 0) - 1 + len(ids)
                owner, terms = place[w.text_of()], w.hashes
                if only is not None:
                    at = np.minimum(np.searchsorted(only, terms), len(only) - 1) if len(only) else np.zeros(len(terms), np.int64)
                    wanted = only[at] == terms if len(only) else np.zeros(len(terms), bool)
                    owner, terms = owner[wanted], terms[wanted]
                order = np.lexsort((terms, owner))
                owner, terms = owner[order], terms[order]
                first = np.flatnonzero(np.r_[True, (owner[1:] != owner[:-1]) | (terms[1:] != terms[:-1])]) if len(terms) else np.zeros(0, np.int64)
                parts.append((lengths[with_words], terms[first], owner[first], np.diff(np.r_[first, len(terms)])))
                ids += [doc_ids[r.first + i] for i in with_words.tolist()]
                held += len(first)
                if held >= SEGMENT_POSTINGS or len(ids) >= SEGMENT_DOCS:
                    yield close()
                    ids, parts, held, number = [], [], 0, number + 1
        if ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return settle(rows.mapInArrow(run, SEGMENT), "lexical-index")


def term_counts(index: DataFrame) -> DataFrame:
    """(term, df): documents that hold each listed term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for terms, df in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(terms, "<i8")), pa.array(np.frombuffer(df, "<i8"))], names=["term", "df"])

    return index.select("terms", "df").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))


def search(index: DataFrame, queries: DataFrame, k: int = NEAREST) -> DataFrame:
    """(item, rank, doc_id, score): the best documents of each query of ``query_terms``."""
    total = index.agg(F.sum("n_docs").alias("docs"), F.sum("n_words").alias("words"), F.sum("n_postings").alias("postings")).first()
    n_docs, n_words = total.docs or 0, total.words or 0
    groups = max(1, -(-(total.postings or 0) // GROUP_POSTINGS))
    asked = queries.select("item", "query_key", F.explode("terms").alias("term")).join(term_counts(index), "term")
    weight = f"cast(floor(1000 * ln(cast(2 * {n_docs}L + 2 as double) / cast(2 * df + 1 as double))) as long)"
    asked = asked.groupBy("item", "query_key").agg(F.collect_list(F.struct("term", F.expr(weight).alias("weight"))).alias("terms"))  # an item's terms
    asked = settle(asked, "weighted-queries")
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    packed = asked.groupBy(F.expr(f"int(pmod(xxhash64(item, query_key), {blocks}))").alias("block"))
    packed = packed.agg(F.collect_list(F.struct("item", "query_key", "terms")).alias("queries"))
    spread = packed.selectExpr(f"explode(sequence(0, {groups - 1})) as part", "1 as kind", "bigint(block) as place", "queries")
    dealt = index.filter("n_postings > 0").selectExpr(f"int(pmod(xxhash64(segment), {groups})) as part", "0 as kind", "segment as place", *ARRAYS)
    rows = dealt.unionByName(spread, allowMissingColumns=True).select("part", "kind", "place", "queries", *ARRAYS)
    rows = rows.repartition(groups, "part").sortWithinPartitions("part", "kind", "place")
    item_kind = asked.schema["item"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, segments = None, []
        for batch in batches:
            items = batch.schema.field("queries").type.value_type.field("item").type
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                if row["part"] != part:
                    part, segments = row["part"], []
                if row["kind"] == 0:
                    segments.append(Segment({a: np.frombuffer(row[a], t) for a, t in ARRAYS.items()}, n_docs, n_words))
                    continue
                out: list[tuple] = []
                for q in row["queries"]:
                    terms = np.array([t["term"] for t in q["terms"]], np.int64).view(np.uint64)
                    weights = np.array([t["weight"] for t in q["terms"]], np.int64)
                    best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool))]
                    for s in segments:
                        s.search(terms, weights, best, k)
                    out += [(q["item"], q["query_key"], None if lost else int(d), int(s)) for s, d, lost in zip(*best[0], strict=True)]
                columns = list(zip(*out, strict=True)) or [()] * 4
                kinds = (items, pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["item", "query_key", "doc_id", "score"])

    found = rows.mapInArrow(run, f"item {item_kind.simpleString()}, query_key long, doc_id long, score long")
    order = Window.partitionBy("item", "query_key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item", "rank", "doc_id", "score")


def rank_documents(docs: DataFrame, queries: DataFrame, k: int = NEAREST, item: str = "item_id") -> DataFrame:
    """Per query row its best documents: item, rank, doc_id, score.

    Null and empty texts have no terms: such documents are in no count, such queries have no row.  Every row is a document,
    repeated ones too; one without an id ranks behind its equals.  Equal query rows are one query; of rows that share an id
    and not the text each is ranked.  Empty tables give an empty result; further columns are not read.
    """
    asked = settle(query_terms(queries, item), "queries")
    terms = asked.select(F.explode("terms").alias("term")).distinct()
    only = None
    if terms.count() <= TERM_FILTER:
        only = np.sort(terms.toArrow()["term"].to_numpy().astype(np.int64).view(np.uint64))
    found = search(build_index(docs, only), asked, k)
    name = unused(found, item) if item in ("rank", "doc_id", "score") else item
    return found.withColumnRenamed("item", name)
