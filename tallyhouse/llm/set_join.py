"""Operator 4: size-aware heavy-light join of documents whose sets of word n-grams have a Jaccard similarity of 0.8 or more.

Sets of n and m shingles are linked when they share c(n, m) = ceil(4 (n + m) / 9) of them.  Equal sets are one class.

* Small classes enumerate subsets of fixed size: all c-subsets for the c that some linked size needs.  Classes that meet in a
  subset of size c and need no more than c are linked; each links to the smallest class of the subset, which loses no path.
* Large classes scan inverted lists.  Shingles are ordered from light to heavy by a sketch of document counts over the whole
  corpus (a fixed number of counters), and only the first n - ceil(0.8 n) + 1 of a set are listed, since linked sets share
  one of those.  Heavy shingles, as of passages that many documents quote, come last and are hardly ever listed.
* The boundary is the size up to which subsets cost fewer rows than lists, from sums per size over all classes.

Lists are worked off in two steps.  First each class is compared with one hub of each of its lists, the class most of whose
listed shingles are shared: that joins a group of copies around its original with a comparison per copy.  Then, in lists
that still hold several components, classes of different components are paired, except those both in the list's largest
component, and only where the shingles of each from the list's one on are enough to reach c: the first shingle that linked
sets share always leaves enough.  Pairs are counted over all their shared lists, and a pair whose count and unlisted rest
cannot reach c is dropped; the others are compared exactly from their texts.  Every link between different components is
found, so components are exact.

Shingles and sets are told apart by 64-bit hashes: of N sets, two different ones fall together with a chance of N^2 / 2^65.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhouse.llm import bytetext
from tallyhouse.llm.columns import unused
from tallyhouse.llm.components import connected_components
from tallyhouse.sources.workdir import settle

WORDS_PER_SHINGLE = 5
#: Counters of the sketch that orders shingles, as a power of two.
SKETCH_BITS = 18
#: Largest size whose subsets are considered.
SMALL_LIMIT = 20
#: Rows up to which a side of ids may be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000
#: Texts compared with one hub by one group.
GROUP = 256

#: Shared shingles that link sets of n and m, and sizes that can be linked, as SQL.
NEED = "(4 * ({n} + {m}) + 8) div 9"
SIZES_FIT = "5 * least({n}, {m}) >= 4 * greatest({n}, {m})"


#: Whether a text has a word: anything but the separators of ``bytetext``.
HAS_WORDS = r"text rlike '[^\\x20\\x09-\\x0D]'"


def need(n: int, m: int) -> int:
    return (4 * (n + m) + 8) // 9


def listed(n):
    """Shingles of a set of n that go into lists."""
    return n - (4 * n + 4) // 5 + 1


def subset_sizes(n: int) -> list[int]:
    return sorted({need(n, m) for m in range(-(-4 * n // 5), 5 * n // 4 + 1) if m > 0 and need(n, m) <= n})


def _distinct(owner: np.ndarray, hashes: np.ndarray, order_by: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (owner, hash), per owner in ascending order of ``order_by`` and hash."""
    keys = (hashes, owner) if order_by is None else (hashes, order_by, owner)
    order = np.lexsort(keys)
    owner, hashes = owner[order], hashes[order]
    keep = np.ones(len(owner), bool)
    keep[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return owner[keep], hashes[keep]


def _run_sets(run: bytetext.Run, weights: np.ndarray | None = None):
    """(owner, shingle) distinct, sizes and set keys of a run's texts; with weights, shingles of a set from light to heavy."""
    owner, hashes = bytetext.shingles(bytetext.words(run), WORDS_PER_SHINGLE)
    owner, hashes = _distinct(owner, hashes, None if weights is None else weights[_slots(hashes)])
    n = np.bincount(owner, minlength=run.last - run.first)
    total = np.concatenate([[np.uint64(0)], np.cumsum(bytetext.mix(hashes + np.uint64(11)), dtype=np.uint64)])
    ends = np.cumsum(n)
    keys = bytetext.mix(total[ends] - total[ends - n] + n.astype(np.uint64))
    return owner, hashes, n, keys.view(np.int64)


def _slots(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _tokens(hashes: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Shingles as non-negative longs that sort from light to heavy."""
    return (weights[_slots(hashes)] << 54) | (hashes >> np.uint64(10)).astype(np.int64)


def document_sets(docs: DataFrame, *further: str) -> DataFrame:
    """(doc_id, n, set_key, items): size and key of every document's set; its shingles where it is small.  Null ids stay null.

    Further columns of longs are passed on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in bytetext.runs(batch.column(1)):
                owner, hashes, n, keys = _run_sets(r)
                small = n[owner] <= SMALL_LIMIT
                sizes = np.where(n <= SMALL_LIMIT, n, 0)
                items = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(hashes[small].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[r.first : r.last], pa.array(n.astype(np.int32)), pa.array(keys), items, *(c[r.first : r.last] for c in batch.columns[2:])],
                    names=["doc_id", "n", "set_key", "items", *further],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *further)
    return rows.mapInArrow(run, ", ".join(["doc_id long, n int, set_key long, items array<long>", *(f"{c} long" for c in further)]))


def shingle_weights(docs: DataFrame) -> np.ndarray:
    """Per counter a step of the logarithm of the documents' shingles that fall on it; all documents count."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            for r in bytetext.runs(batch.column(0)):
                _, hashes, _, _ = _run_sets(r)
                total += np.bincount(_slots(hashes), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["slot", "n"])

    summed = docs.select("text").mapInArrow(run, "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n"))
    counts = np.zeros(1 << SKETCH_BITS, np.int64)
    table = summed.toArrow()  # one row per counter at most
    counts[table["slot"].to_numpy()] = table["n"].to_numpy()
    return np.round(8 * np.log2(counts + 1.0)).astype(np.int64)


def _first_of_set(keys: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Whether a text is the first of a run with its set; empty sets are not."""
    first = np.zeros(len(keys), bool)
    first[np.unique(keys, return_index=True)[1]] = True
    return first & (n > 0)


def inverted_lists(docs: DataFrame, weights: np.ndarray, least_size: int) -> DataFrame:
    """(token, set_key, place): the listed shingles of each set of at least ``least_size``, copies within a run once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in bytetext.runs(batch.column(0)):
                owner, hashes, n, keys = _run_sets(r, weights)
                place = np.arange(len(owner)) - (np.cumsum(n) - n)[owner]
                wanted = _first_of_set(keys, n) & (n >= least_size)
                keep = wanted[owner] & (place < listed(n)[owner])
                columns = (_tokens(hashes[keep], weights), keys[owner[keep]], place[keep].astype(np.int32))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["token", "set_key", "place"])

    return docs.select("text").mapInArrow(run, "token long, set_key long, place int")


def _costs(classes: DataFrame, weights: np.ndarray) -> dict[int, tuple[float, float]]:
    """Per small size the rows that subsets and lists would take: a list is as long as its counter says above the usual."""
    usual = float(np.median(weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, subsets, lists = [], [], []
            for n, items in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                w = np.sort(weights[_slots(np.array(items, np.int64).view(np.uint64))])[: listed(n)]
                sizes.append(n)
                subsets.append(float(sum(comb(n, c) for c in subset_sizes(n))))
                lists.append(float(np.sum(1 + np.maximum(2 ** (w / 8) - 2 ** (usual / 8), 0))))
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int32()), pa.array(subsets), pa.array(lists)], names=["n", "subsets", "lists"])

    rows = classes.filter(F.col("n") <= SMALL_LIMIT).select("n", "items").mapInArrow(run, "n int, subsets double, lists double")
    return {r.n: (r.subsets, r.lists) for r in rows.groupBy("n").agg(F.sum("subsets").alias("subsets"), F.sum("lists").alias("lists")).collect()}


def boundary(costs: dict[int, tuple[float, float]]) -> int:
    """The size up to which sets are small, with the fewest rows in all."""
    total = [sum(s for n, (s, _) in costs.items() if n <= x) + sum(t for n, (_, t) in costs.items() if n > x) for x in range(SMALL_LIMIT + 1)]
    return int(np.argmin(total))


def small_links(classes: DataFrame, limit: int) -> DataFrame:
    """(u, v): links between classes of at most ``limit`` shingles, by shared subsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, n, items in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                values = np.sort(np.array(items, np.int64).view(np.uint64))
                for c in subset_sizes(n):
                    picks = np.array(list(combinations(range(n), c)), np.int64).reshape(-1, c)
                    subset = bytetext.mix(bytetext.mix(values + np.uint64(c))[picks].sum(axis=1, dtype=np.uint64))
                    size = len(subset)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(subset.view(np.int64)), *(pa.array(np.full(size, v, t)) for v, t in ((c, np.int32), (key, np.int64), (n, np.int32)))],
                        names=["subset", "c", "set_key", "n"],
                    )

    rows = classes.filter(F.col("n") <= limit).select("set_key", "n", "items").mapInArrow(run, "subset long, c int, set_key long, n int")
    hubs = rows.groupBy("subset", "c").agg(F.min(F.struct("n", "set_key")).alias("hub"), F.count(F.lit(1)).alias("size")).filter("size > 1")
    met = rows.join(hubs, ["subset", "c"]).filter("set_key <> hub.set_key and " + NEED.format(n="n", m="hub.n") + " <= c")
    return met.select(F.col("set_key").alias("u"), F.col("hub.set_key").alias("v")).distinct()


def _within_reach(pairs: DataFrame) -> DataFrame:
    """Of pairs (a, b, n, m, shared), with the number of lists they share, those that what is not listed can still link."""
    rest = "greatest((4 * n + 4) div 5 - 1, (4 * m + 4) div 5 - 1)"
    return pairs.filter(f"shared + {rest} >= " + NEED.format(n="n", m="m")).select("a", "b")


def compare(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(a, b, linked) for pairs of set keys, from the shingles of their texts.  A text goes once to each group of pairs of its hub."""
    keys = pairs.select(F.col("a").alias("set_key")).unionByName(pairs.select(F.col("b").alias("set_key"))).distinct()
    wanted = settle(keys.join(classes.select("set_key", "first"), "set_key"), "compared-sets")
    n = wanted.count()
    side = F.broadcast(wanted) if n <= BROADCAST_ROWS else wanted
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).alias("d")
    texts = texts.join(side.alias("w"), F.expr("d.doc_id <=> w.first.doc_id and d.text_hash = w.first.text_hash")).select("w.set_key", "d.text")
    texts = settle(texts, "compared-texts")
    if texts.count() > n:  # repeated rows
        texts = settle(texts.dropDuplicates(["set_key"]), "compared-texts")
    sizes = pairs.groupBy("b").agg(F.count(F.lit(1)).alias("size"))
    grouped = pairs.join(sizes, "b").withColumn("part", F.expr(f"pmod(xxhash64(a), (size + {GROUP - 1}) div {GROUP})")).select("a", "b", "part")
    others = grouped.join(texts, grouped.a == texts.set_key).select("b", "part", F.lit(1).alias("role"), F.col("a").alias("key"), "text")
    hubs = grouped.select("b", "part").distinct().join(texts, F.col("b") == texts.set_key)
    hubs = hubs.select("b", "part", F.lit(0).alias("role"), F.col("b").alias("key"), "text")
    rows = hubs.unionByName(others).repartition("b", "part").sortWithinPartitions("b", "part", "role", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, hub = None, None
        for batch in batches:
            b, part, role, key = (batch.column(k).to_numpy() for k in range(4))
            for r in bytetext.runs(batch.column(4)):
                owner, hashes, n, _ = _run_sets(r)
                ends = np.cumsum(n)
                out: list[tuple[int, int, bool]] = []
                for k in range(r.last - r.first):
                    row = r.first + k
                    mine = hashes[ends[k] - n[k] : ends[k]]
                    if role[row] == 0:
                        group, hub = (b[row], part[row]), mine
                    elif group == (b[row], part[row]):
                        at = np.minimum(np.searchsorted(hub, mine), len(hub) - 1)
                        same = int((hub[at] == mine).sum())
                        out.append((int(key[row]), int(b[row]), 100 * same >= 80 * (len(hub) + len(mine) - same)))
                columns = list(zip(*out, strict=True)) or [(), (), ()]
                kinds = (pa.int64(), pa.int64(), pa.bool_())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["a", "b", "linked"])

    found = rows.mapInArrow(run, "a long, b long, linked boolean")
    return found.groupBy("a", "b").agg(F.max("linked").alias("linked"))


def _hub_pairs(lists: DataFrame) -> DataFrame:
    """Each class with the hub of each of its lists: the class whose listed shingles are shared most."""
    share = lists.groupBy("set_key").agg(F.count(F.lit(1)).alias("kept"))
    weighed = lists.join(share, "set_key").withColumn("weight", F.expr("kept / (n - (4 * n + 4) div 5 + 1)"))
    hubs = weighed.groupBy("token").agg(F.max(F.struct("weight", "set_key", "n")).alias("hub"))
    pairs = lists.join(hubs, "token").filter("set_key <> hub.set_key and " + SIZES_FIT.format(n="n", m="hub.n"))
    pairs = pairs.groupBy(F.col("set_key").alias("a"), F.col("hub.set_key").alias("b"), "n", F.col("hub.n").alias("m"))
    return _within_reach(pairs.agg(F.count(F.lit(1)).alias("shared")))


def _open_pairs(lists: DataFrame, roots: DataFrame, compared: DataFrame) -> DataFrame:
    """Pairs of classes in one list and of different components that have not been compared."""
    known = lists.join(roots.select(F.col("node").alias("set_key"), "root"), "set_key", "left")
    known = known.withColumn("root", F.coalesce("root", "set_key"))
    per_root = known.groupBy("token", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = per_root.groupBy("token").agg(F.max(F.struct("size", "root")).alias("largest"), F.count(F.lit(1)).alias("roots"))
    known = settle(known.join(largest.filter("roots > 1"), "token").withColumn("common", F.expr("root = largest.root")), "open-lists")
    x = known.filter("not common").selectExpr("token", "set_key as x", "root as x_root", "n as x_n", "n - place as x_left")
    y = known.selectExpr("token", "set_key as y", "root as y_root", "n as y_n", "n - place as y_left", "common")
    enough = "least(x_left, y_left) >= " + NEED.format(n="x_n", m="y_n")
    met = x.join(y, "token").filter(
        f"x_root <> y_root and (common or x < y) and {SIZES_FIT.format(n='x_n', m='y_n')} and {enough}"
    )
    pairs = met.selectExpr("least(x, y) as a", "greatest(x, y) as b", "if(x < y, x_n, y_n) as n", "if(x < y, y_n, x_n) as m").distinct()
    done = compared.selectExpr("least(a, b) as a", "greatest(a, b) as b")
    pairs = settle(pairs.join(done, ["a", "b"], "left_anti"), "met-pairs")
    nodes = pairs.selectExpr("a as set_key").unionByName(pairs.selectExpr("b as set_key")).distinct()
    tokens = lists.join(nodes, "set_key").groupBy("set_key").agg(F.collect_list("token").alias("tokens"))  # a fifth of a set
    both = pairs.join(tokens.selectExpr("set_key as a", "tokens as a_tokens"), "a").join(tokens.selectExpr("set_key as b", "tokens as b_tokens"), "b")
    return _within_reach(both.selectExpr("a", "b", "n", "m", "size(array_intersect(a_tokens, b_tokens)) as shared"))


def linked_documents(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_shingles and component_id, the smallest doc_id reachable by links.

    Documents without words have no shingle, link with nothing and are their own component; fewer than five words are one
    shingle.  Rows that share an id are judged by their own texts; a null id is passed over when the smallest is taken.
    """
    return _linked(docs).select("doc_id", "n_shingles", "component_id")


def _linked(docs: DataFrame, *further: str) -> DataFrame:
    """Rows of ``linked_documents`` with further columns and root, a set key that names the component; null without words."""
    hashed = unused(docs, "text_hash")
    sets = settle(document_sets(docs.withColumn(hashed, F.xxhash64("text")), *further, hashed), "document-sets")
    # one row stands for a set, named by its id and its text's hash, as ids may be missing or shared
    first = F.min(F.struct("doc_id", F.col(hashed).alias("text_hash"))).alias("first")
    classes = sets.filter("n > 0").groupBy("set_key").agg(F.min("doc_id").alias("smallest"), first, F.min("n").alias("n"), F.min("items").alias("items"))
    classes = settle(classes, "set-classes")
    weights = shingle_weights(docs)
    limit = boundary(_costs(classes, weights))
    light = settle(small_links(classes, limit), "small-links")

    lists = inverted_lists(docs, weights, -(-4 * (limit + 1) // 5))
    shared = settle(lists.groupBy("token").agg(F.count(F.lit(1)).alias("size")).filter("size > 1").select("token"), "shared-tokens")
    lists = lists.join(shared, "token").distinct().join(classes.select("set_key", "n"), "set_key")
    lists = settle(lists.select("token", "set_key", "place", "n"), "inverted-lists")
    first = settle(compare(docs, classes, settle(_hub_pairs(lists), "hub-pairs")), "hub-links")
    links = light.unionByName(first.filter("linked").selectExpr("a as u", "b as v"))
    roots = settle(connected_components(links), "components")
    left = settle(_open_pairs(lists, roots, first), "open-pairs")
    second = settle(compare(docs, classes, left), "open-links").filter("linked").selectExpr("a as u", "b as v")
    if not second.isEmpty():
        joined = roots.selectExpr("node as u", "root as v").filter("u <> v").unionByName(second)
        roots = settle(connected_components(joined), "components")
    named = classes.join(roots, classes.set_key == roots.node, "left").select("set_key", "smallest", F.coalesce("root", "set_key").alias("root"))
    ids = named.groupBy("root").agg(F.min("smallest").alias("component_id"))
    named = named.join(ids, "root").select("set_key", "component_id", "root")
    out = sets.filter("n > 0").join(named, "set_key")
    out = out.select("doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "root", *further)
    alone = sets.filter("n = 0").select(
        "doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"), *further
    )
    return out.unionByName(alone)


def one_per_component(docs: DataFrame) -> DataFrame:
    """One document of each component, that of the smallest id; documents without words all stay.

    A null id comes after all others, and of texts of one id in a component the one of the smallest hash stays.  Of rows
    equal in id and text one stays.  Texts that are not linked never stand for one another, whatever their ids.
    """
    own = unused(docs, "text_hash")
    hashed = docs.withColumn(own, F.xxhash64("text"))
    has_words = F.coalesce(F.expr(HAS_WORDS), F.lit(False))
    rows = settle(_linked(hashed.filter(has_words), own).select("doc_id", "root", own), "linked-documents")
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col(own))).alias("first")
    stays = rows.groupBy("root").agg(first).select(F.col("first.doc_id").alias("doc_id"), F.col(f"first.{own}").alias(own))
    stays = settle(stays, "staying")
    kept = hashed.filter(has_words).alias("d").join(stays.alias("s"), F.expr(f"cast(d.doc_id as long) <=> s.doc_id and d.{own} = s.{own}"), "left_semi")
    copies = rows.join(stays, (rows.doc_id.eqNullSafe(stays.doc_id)) & (rows[own] == stays[own]), "left_semi").groupBy("doc_id", own).count()
    if not copies.filter("count > 1").isEmpty():
        kept = kept.dropDuplicates(["doc_id", own])
    return hashed.filter(~has_words).unionByName(kept).drop(own)
