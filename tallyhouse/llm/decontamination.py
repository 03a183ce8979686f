"""Operator 8: benchmark decontamination by winnowing, in DataFrame and SQL functions only.

Texts are cut into words; every run of ``GRAM`` words is hashed, and of each ``WINDOW - GRAM + 1`` neighbouring hashes the least is
kept.  Two equal runs of ``WINDOW`` words hold the same hashes, so they keep the same least one: a join of kept hashes misses no
shared run of that length.  Documents that share a kept hash with an item are then compared word by word: runs whose kept hash
matched are joined with the items' runs by their words, and the joined runs of a document are united into hit words.

An item of fewer words than a window is one shorter window of its own; for each such length that occurs, documents are
winnowed at that length too.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.sources.workdir import settle

WINDOW, GRAM = 10, 5
#: Largest number of item rows that a join may broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = f"""array_remove(split(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
    '[\\\\x00-\\\\x2F\\\\x3A-\\\\x60\\\\x7B-\\\\x7F]+'), '')"""


def _at_every_start(column: str, length: int, value: str) -> str:
    """An array of ``value`` for each start i of ``length`` entries of an array column; empty for fewer entries.

    The column is named twice, so the planner computes it once per row and not once per entry.
    """
    return f"""if(size({column}) >= {length},
        transform(sequence(1, size({column}) - {length} + 1), i -> {value}), cast(array() as array<bigint>))"""


def _gram_hashes(n: int) -> str:
    gram = min(GRAM, n)
    return _at_every_start("words", gram, f"xxhash64(slice(words, i, {gram}))")


def _kept(n: int) -> str:
    """The least hash of the grams in each window of n words, an n of its own apart from other lengths."""
    grams = n - min(GRAM, n) + 1
    least = f"array_min(slice(grams_{n}, i, {grams}))"
    return _at_every_start(f"grams_{n}", grams, least if n == WINDOW else f"xxhash64({n}, {least})")


def _with_kept(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds kept_n for each window length; rows have the column words."""
    for n in lengths:
        rows = rows.withColumn(f"grams_{n}", F.expr(_gram_hashes(n)))
        rows = rows.withColumn(f"kept_{n}", F.expr(_kept(n))).drop(f"grams_{n}")
    return rows


def _bounded(frame: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(frame) if rows <= BROADCAST_ROWS else frame


def _item_windows(items: DataFrame) -> DataFrame:
    """(item_id, n, words_key, kept) of every window of every item."""
    cut = items.select("item_id", F.expr(WORDS).alias("words")).filter("size(words) > 0")
    cut = cut.withColumn("n", F.least(F.size("words"), F.lit(WINDOW)))
    parts = None
    lengths = sorted(r.n for r in cut.select("n").distinct().collect())  # at most WINDOW numbers
    for n in lengths:
        key = f"array_join(slice(words, i, {n}), ' ')"
        some = _with_kept(cut.filter(F.col("n") == n), [n])
        some = some.withColumn("keys", F.expr(f"transform(sequence(1, size(kept_{n})), i -> {key})"))
        some = some.select("item_id", "n", F.explode(F.arrays_zip(F.col("keys").alias("k"), F.col(f"kept_{n}").alias("v"))).alias("w"))
        some = some.select("item_id", "n", F.col("w.k").alias("words_key"), F.col("w.v").alias("kept"))
        parts = some if parts is None else parts.unionByName(some)
    return parts if parts is not None else cut.selectExpr("item_id", "n", "'' as words_key", "0L as kept").limit(0)


def contaminated_spans(docs: DataFrame, items: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every document row with its number of words; its runs of words that are windows of items; and which items they are of.

    The frames are (doc_id, text_hash, n_words), (doc_id, text_hash, first, n) and (doc_id, text_hash, item_id), the last two distinct.
    """
    windows = settle(_item_windows(items), "item-windows")
    lengths = sorted(r.n for r in windows.select("n").distinct().collect())  # at most WINDOW numbers
    kept = windows.select("kept").distinct()
    n_windows = windows.count()

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.expr(WORDS).alias("words"))
    prints = _with_kept(texts, lengths).select(
        "doc_id", "text_hash", F.size("words").alias("n_words"),
        F.array_distinct(F.concat(*[f"kept_{n}" for n in lengths])).alias("kept") if lengths else F.expr("cast(array() as array<bigint>)").alias("kept"),
    )
    prints = settle(prints, "document-prints")
    exploded = prints.select("doc_id", "text_hash", F.explode("kept").alias("kept"))
    matched = exploded.join(_bounded(kept, n_windows), "kept").groupBy("doc_id", "text_hash").agg(F.collect_set("kept").alias("matched"))
    matched = settle(matched, "matched-prints")

    near = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").dropDuplicates(["doc_id", "text_hash"]).alias("d")
    m = matched.alias("m")
    near = near.join(m, F.expr("d.doc_id <=> m.doc_id and d.text_hash = m.text_hash")).select("d.*", "m.matched")
    near = _with_kept(near.select("doc_id", "text_hash", "matched", F.expr(WORDS).alias("words")), lengths)
    runs = None
    for n in lengths:
        at = f"""filter(transform(kept_{n}, (v, i) -> if(array_contains(matched, v),
            struct(i as first, array_join(slice(words, i + 1, {n}), ' ') as words_key), null)), x -> x is not null)"""
        some = near.select("doc_id", "text_hash", F.explode(F.expr(at)).alias("w"))
        some = some.select("doc_id", "text_hash", F.lit(n).alias("n"), F.col("w.first").alias("first"), F.col("w.words_key").alias("words_key"))
        runs = some if runs is None else runs.unionByName(some)
    if runs is None:
        runs = near.selectExpr("doc_id", "text_hash", "0 as n", "0 as first", "'' as words_key").limit(0)
    keys = windows.select("n", "words_key").distinct()
    hits = settle(runs.join(_bounded(keys, n_windows), ["n", "words_key"]), "contaminated-runs")
    of_items = hits.select("doc_id", "text_hash", "n", "words_key").distinct()
    owners = windows.select("item_id", "n", "words_key").distinct()
    of_items = of_items.join(_bounded(owners, n_windows), ["n", "words_key"]).select("doc_id", "text_hash", "item_id").distinct()
    return prints.select("doc_id", "text_hash", "n_words"), hits.select("doc_id", "text_hash", "first", "n").distinct(), of_items


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Per document row: doc_id, n_words, n_hit, n_items, items_sha256, contaminated, and text_hash.

    A null or empty text has no words and no hit.  Rows that repeat an id and a text have equal results; rows that share an id
    with different texts are judged apart.  Equal items count by their ids; an item without an id marks words and is not
    listed.  With no items nothing is contaminated; an empty table gives an empty result.
    """
    rows, spans, of_items = contaminated_spans(docs, items)
    in_order = Window.partitionBy("doc_id", "text_hash").orderBy("first", "n")
    before = F.max(F.col("first") + F.col("n")).over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.lit(0), F.col("first") + F.col("n") - F.greatest(F.col("first"), F.coalesce(before, F.lit(0))))
    hit = spans.withColumn("added", added).groupBy("doc_id", "text_hash").agg(F.sum("added").alias("n_hit"))
    listed = of_items.groupBy("doc_id", "text_hash").agg(
        F.count("item_id").alias("n_items"), F.array_join(F.array_sort(F.collect_list(F.col("item_id").cast("string"))), ",").alias("listed")
    )
    same = "r.doc_id <=> {0}.doc_id and r.text_hash = {0}.text_hash"
    out = rows.alias("r").join(hit.alias("h"), F.expr(same.format("h")), "left").join(listed.alias("l"), F.expr(same.format("l")), "left")
    return out.select(
        "r.doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
        F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("listed", F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        "r.text_hash",
    )


def clean_documents(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a hit, with all their columns."""
    _, spans, _ = contaminated_spans(docs, items)
    found = spans.select("doc_id", "text_hash").distinct().alias("s")
    same = F.expr("d.doc_id <=> s.doc_id and xxhash64(d.text) = s.text_hash")
    return docs.alias("d").join(found, same, "left_anti")
