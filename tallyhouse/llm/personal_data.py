"""Operator 5: personal data by bootstrapped contextual extraction, in DataFrame and SQL functions only.

Four base kinds are found by pattern and checked: e-mail addresses, IP addresses, card numbers and phone numbers.  They are the
seeds.  The tokens around an entity are its lexical patterns: the token before it (or the label glued to it, as in ``id=``)
and the token behind it.  Patterns and instances form a graph: a pattern is as good as the share of its places in all
documents that hold a known instance, weighted by how well that is known, and a candidate (a longer token with digits that no
base kind covers) is as well known as its patterns together make it.  Each of ``ROUNDS`` rounds reaches one hop further: what
one makes known counts for other patterns in the next, also for those without a seed.  Then the candidates known best are
added as spans of the kind ``id``.  Base spans are never changed.

Where a match starts is summed from the lengths of what lies before it: each kind's matches are set apart by a mark, the text
is split at the marks, and a window adds up lengths in code points per document and kind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.llm.columns import unused
from tallyhouse.sources.workdir import settle

ROUNDS = 3
#: Least confidence of a pattern that is kept, of a discovered instance, and places that a pattern must have.
PATTERN_CONFIDENCE, INSTANCE_CONFIDENCE, LEAST_PLACES = 0.5, 0.8, 5
#: Code points on either side that a context token is looked for in.
REACH = 60
#: Largest number of context tokens that a join may broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 500_000

KINDS = ("email", "ip", "card", "phone", "id")
# The base patterns.  Possessive repeats and looks behind find the same matches without trying a run twice.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
    "id": r"(?:(?<![A-Za-z0-9_-])|\G)(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{8,}+",
}
#: What a text must have for a match, cheaper to look for.
NEEDS = {
    "email": "contains(text, '@')",
    "ip": r"text rlike '[0-9]\\.[0-9]++\\.[0-9]'",
    "card": "text rlike '[0-9](?:[ -]?[0-9]){12}'",
    "phone": "contains(text, '+')",
    "id": "text rlike '[0-9]'",
}
CHECKS = {
    "email": "true",
    "ip": r"""forall(split(value, '\\.'), p -> length(ltrim('0', p)) <= 3 and try_cast(concat('0', ltrim('0', p)) as int) <= 255)""",
    "card": "length(translate(value, ' -', '')) between 13 and 19 and luhn_check(translate(value, ' -', ''))",
    "phone": "length(regexp_replace(value, '[^0-9]', '')) between 9 and 15",
    "id": "true",
}


def _quoted(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\") + "'"


def _matches(texts: DataFrame, kind: str) -> DataFrame:
    """Matches of one kind with the length of the gap before each and the tokens around it."""
    marked = f"split(regexp_replace(translate(text, '\\u0001', '\\u0002'), {_quoted(PATTERNS[kind])}, '\\u0001$0\\u0001'), '\\u0001', -1)"
    rows = texts.filter(NEEDS[kind]).select("doc_id", "text_hash", F.expr(marked).alias("parts")).filter("size(parts) > 1")
    each = f"""transform(sequence(1, size(parts) div 2), j -> struct(j as place, length(parts[2 * j - 2]) as gap, parts[2 * j - 1] as value,
        lower(regexp_extract(right(parts[2 * j - 2], {REACH}), '(\\\\S+\\\\s*)$', 1)) as before,
        lower(regexp_extract(left(parts[2 * j], {REACH}), '^\\\\s*(\\\\S+)', 1)) as behind))"""
    rows = rows.select("doc_id", "text_hash", F.explode(F.expr(each)).alias("m"))
    return rows.select("doc_id", "text_hash", F.lit(KINDS.index(kind)).alias("kind"), "m.*")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def found_spans(docs: DataFrame, kinds: Sequence[str] = KINDS) -> DataFrame:
    """(doc_id, text_hash, kind, start, end, value, before, behind) of every match that passes its check.

    Rows that repeat an id and a text count once.  Starts are code points, ends exclusive.
    """
    texts, parts = _texts(docs), None
    for kind in kinds:
        some = _matches(texts, kind)
        parts = some if parts is None else parts.unionByName(some)
    parts = parts.repartition("doc_id", "text_hash", "kind")  # serves the deduplication and the running sum
    row = Window.partitionBy("doc_id", "text_hash", "kind")
    once = parts.withColumn("copy", F.row_number().over(row.orderBy("place", "gap"))).withColumn("same", F.lag("place").over(row.orderBy("place", "gap")))
    once = once.filter(F.col("same").isNull() | (F.col("same") != F.col("place")))
    upto = F.sum(F.col("gap") + F.length("value")).over(row.orderBy("place").rowsBetween(Window.unboundedPreceding, 0))
    once = once.withColumn("end", upto).withColumn("start", F.col("end") - F.length("value"))
    valid = None
    for kind in kinds:
        check = (F.col("kind") == KINDS.index(kind)) & F.expr(CHECKS[kind])
        valid = check if valid is None else valid | check
    return once.filter(valid).select("doc_id", "text_hash", "kind", "start", "end", "value", "before", "behind")


def _patterns(spans: DataFrame) -> DataFrame:
    """One row per place, side and token around an instance; a label glued to the instance is a side of its own."""
    before = F.col("before")
    sides = F.array(
        F.struct(F.when(before.rlike(r"\s$"), "before").otherwise("glued").alias("side"), F.regexp_replace(before, r"\s+$", "").alias("token")),
        F.struct(F.lit("behind").alias("side"), F.col("behind").alias("token")),
    )
    return spans.select("*", F.explode(sides).alias("p")).select("*", "p.side", "p.token").drop("p").filter("token <> ''")


def _places(docs: DataFrame, tokens: DataFrame) -> DataFrame:
    """How often each wanted context token occurs in all documents: as a token, or as the label at a token's start."""
    n = tokens.count()
    wanted = F.broadcast(tokens) if n <= BROADCAST_ROWS else tokens
    words = docs.select(F.explode(F.split(F.lower("text"), r"\s+")).alias("word")).filter("word <> ''")
    label = F.regexp_extract("word", r"^([^=:]++[=:])[^=:]", 1)
    as_word = words.select(F.lit("word").alias("as"), F.col("word").alias("token"))
    as_label = words.filter("word rlike '[=:][^=:]'").select(F.lit("label").alias("as"), label.alias("token"))
    return as_word.unionByName(as_label).join(wanted, ["as", "token"]).groupBy("as", "token").agg(F.count(F.lit(1)).alias("places"))


def discovered_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """Candidates that the graph of patterns and instances makes known, as rows of ``spans``."""
    is_seed = F.col("kind") < KINDS.index("id")
    base = spans.filter(is_seed).select("doc_id", "text_hash", "start", "end").alias("b")
    free = spans.filter(~is_seed).alias("c")
    overlap = F.expr("c.doc_id <=> b.doc_id and c.text_hash = b.text_hash and c.start < b.end and b.start < c.end")
    free = free.join(base, overlap, "left_anti")
    around = _patterns(spans.filter(is_seed).unionByName(free))
    around = around.withColumn("as", F.when(F.col("side") == "glued", "label").otherwise("word"))
    edges = around.groupBy("side", "as", "token", "value").agg(F.count(F.lit(1)).alias("n"), F.max(is_seed.cast("int")).alias("seed"))
    edges = settle(edges, "pattern-instances")
    # a pattern without a seed may become good in a later round, by instances that other patterns make known
    known = edges.groupBy("side", "as", "token").agg(F.sum("n").alias("uses")).filter(F.col("uses") >= LEAST_PLACES)
    places = _places(docs, settle(known.select("as", "token").distinct(), "context-tokens"))
    # a pattern whose places mostly hold ordinary words cannot become good
    known = known.join(places, ["as", "token"]).filter(F.col("uses") >= PATTERN_CONFIDENCE * F.greatest("places", "uses"))
    graph = edges.join(known.select("side", "as", "token", F.greatest("places", "uses").alias("places")), ["side", "as", "token"])
    graph = settle(graph, "pattern-graph")
    values = graph.groupBy("value").agg(F.max("seed").cast("double").alias("seed"))
    instances = values.filter("seed = 1").select("value", F.col("seed").alias("confidence"))
    for _ in range(ROUNDS):
        patterns = graph.join(instances, "value").groupBy("side", "as", "token")
        patterns = patterns.agg((F.sum(F.col("n") * F.col("confidence")) / F.max("places")).alias("good"))
        patterns = patterns.filter(F.col("good") >= PATTERN_CONFIDENCE)
        doubt = F.sum(F.log1p(-F.least("good", F.lit(0.999999))))
        heard = graph.join(patterns, ["side", "as", "token"]).groupBy("value").agg(F.exp(doubt).alias("doubt"))
        confidence = F.when(F.col("seed") == 1, 1.0).otherwise(1 - F.col("doubt"))
        known_now = values.join(heard, "value", "left").select("value", confidence.alias("confidence"))  # seeds stay known
        instances = settle(known_now.filter("confidence > 0"), "instances")
    found = instances.filter(F.col("confidence") >= INSTANCE_CONFIDENCE).select("value")
    return free.select("c.*").join(found, "value", "left_semi").select(*spans.columns)


def personal_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, kind, start, end): base spans and discovered ones, kind as its number in ``KINDS``."""
    spans = settle(found_spans(docs), "spans")
    base = spans.filter(F.col("kind") < KINDS.index("id"))
    every = base.unionByName(discovered_spans(docs, spans))
    return settle(every.select("doc_id", "text_hash", "kind", "start", "end"), "personal-spans")


def _listed(condition: Column) -> Column:
    names = ", ".join(f"'{k}'" for k in KINDS)
    ordered = F.array_sort(F.collect_list(F.when(condition, F.struct("kind", "start", "end"))))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.expr(f"array({names})")[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per document row: doc_id, counts of the base kinds, the digest of the base spans, and all spans.

    A null or empty text has no span.  Rows that repeat an id and a text have equal results; rows that share an id with
    different texts are judged apart.  Long texts are searched whole; an empty table gives an empty result.
    """
    spans = personal_spans(docs)
    base = F.col("kind") < KINDS.index("id")
    counts = [F.count_if(F.col("kind") == k).alias(f"n_{name}") for k, name in enumerate(KINDS[:-1])]
    per_doc = spans.groupBy("doc_id", "text_hash").agg(*counts, _listed(base).alias("base"), _listed(F.lit(True)).alias("spans"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash")).alias("r")
    out = rows.join(per_doc.alias("p"), F.expr("r.doc_id <=> p.doc_id and r.text_hash = p.text_hash"), "left")
    return out.select(
        "r.doc_id",
        *[F.coalesce(f"n_{name}", F.lit(0)).cast("long").alias(f"n_{name}") for name in KINDS[:-1]],
        F.sha2(F.coalesce("base", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def redact(docs: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """The documents with every span replaced by its kind in square brackets, n_chars following where there is one.

    Spans that overlap become one, named by the kind that starts first.
    """
    spans = personal_spans(docs)
    row = Window.partitionBy("doc_id", "text_hash")
    order = row.orderBy("start", "kind", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.coalesce(F.col("start") >= reached, F.lit(True)).cast("int")
    joined = spans.withColumn("opens", opens).withColumn("block", F.sum("opens").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    blocks = joined.groupBy("doc_id", "text_hash", "block").agg(
        F.min("start").alias("start"), F.max("end").alias("end"), F.min_by("kind", F.struct("start", "kind")).alias("kind")
    )
    per_doc = blocks.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("blocks"))
    names = "array(" + ", ".join(f"'[{k}]'" for k in KINDS) + ")"
    own = unused(docs, "blocks")
    marked = docs.alias("d").join(
        per_doc.alias("p"), F.expr("d.doc_id <=> p.doc_id and xxhash64(d.text) = p.text_hash"), "left"
    ).select("d.*", F.col("p.blocks").alias(own))
    # each piece is the text from the end of the last block to the start of this one, then this one's name
    text = f"""if({own} is null, text, concat(
        array_join(transform({own}, (b, i) -> concat(
            substring(text, if(i = 0, 0, {own}[i - 1].end) + 1, b.start - if(i = 0, 0, {own}[i - 1].end)), {names}[b.kind])), ''),
        substring(text, {own}[size({own}) - 1].end + 1)))"""
    out = marked.withColumn("text", F.expr(text)).drop(own)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.select(*docs.columns)
