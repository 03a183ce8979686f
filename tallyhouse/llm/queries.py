"""Registered queries of the training-data operators.  Each applies its operator to whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import public_tokenizers

from tallyhouse.llm.workers import find_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    find_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.main_text import page_texts

    return page_texts(_table(spark, sf_dir, "pages"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.pieces import piece_digests

    return piece_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.token_files import token_file_digests

    return token_file_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.set_join import linked_documents

    return linked_documents(_table(spark, sf_dir, "documents"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.personal_data import personal_data

    return personal_data(_table(spark, sf_dir, "documents"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.quality import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.neighbours import nearest_neighbours

    return nearest_neighbours(_table(spark, sf_dir, "embeddings"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.decontamination import contamination

    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.language import language_scores

    return language_scores(_table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.toxicity import toxicity_scores

    return toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_inner_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.cover_tree import inner_product_search

    return inner_product_search(_table(spark, sf_dir, "embeddings"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.alignment import align_tokens

    return align_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tallyhouse.llm.lexical import rank_documents

    found = rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.withColumnRenamed("item", "item_id")


QUERIES = {f.__name__: f for f in (op1_main_text, op2_sentencepiece, op3_token_files, op4_jaccard_join, op5_personal_data, op6_quality, op7_neighbours, op8_decontamination, op9_language, op10_toxicity, op11_inner_products, op12_token_alignment, op13_lexical_search)}
SQL: dict[str, str] = {
    "op4_jaccard_join": r"""
with recursive word as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words
    from documents),
shingle as (
    select distinct doc_id, array_to_string(words[i : i + 4], ' ') as s
    from (select *, unnest(range(1, greatest(len(words) - 4, 1) + 1)) as i from word where len(words) > 0)),
size as (select doc_id, count(*) as n from shingle group by doc_id),
pair as (
    select a.doc_id as a, b.doc_id as b, count(*) as both_have
    from shingle a join shingle b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2),
link as (
    select a, b from pair join size x on x.doc_id = a join size y on y.doc_id = b
    where 100 * both_have >= 80 * (x.n + y.n - both_have)),
reach as (
    select doc_id, doc_id as other from documents
    union
    select r.doc_id, l.b from reach r join link l on l.a = r.other)
select r.doc_id, cast(coalesce(any_value(s.n), 0) as bigint) as n_shingles, min(other) as component_id
from reach r left join size s on s.doc_id = r.doc_id group by r.doc_id
""",
    "op8_decontamination": r"""
with doc as (
    select doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as words
    from documents),
item as (
    select item_id, words, least(len(words), 10) as n from (
        select item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') as words
        from benchmark)
    where len(words) > 0),
item_window as (
    select distinct item_id, n, array_to_string(words[i : i + n - 1], ' ') as w
    from (select *, unnest(range(1, len(words) - n + 2)) as i from item)),
doc_window as (
    select doc_id, n, i, array_to_string(words[i : i + n - 1], ' ') as w
    from (select doc_id, words, n, unnest(range(1, len(words) - n + 2)) as i
          from doc, (select distinct n from item) where len(words) >= n)),
hit as (select doc_id, n, i, item_id from doc_window join item_window using (n, w)),
hit_word as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, n, i from hit)) group by doc_id),
hit_item as (
    select doc_id, count(*) as n_items, string_agg(s, ',' order by s) as listed
    from (select distinct doc_id, cast(item_id as varchar) as s from hit) group by doc_id)
select doc_id, cast(len(words) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
    cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(listed, '')) as items_sha256,
    coalesce(n_hit, 0) > 0 as contaminated
from doc left join hit_word using (doc_id) left join hit_item using (doc_id)
""",
    "op11_inner_products": """
with v as (
    select distinct vec_id, list_transform(e, lambda x: floor(1024 * x)) as e
    from (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings)
    where vec_id is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0),
pair as (
    select q.vec_id as query_id, c.vec_id, cast(list_inner_product(q.e, c.e) as bigint) as score
    from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 100 = 0)
select query_id, cast(place as integer) as "rank", vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as place from pair) where place <= 10
""",
    "op13_lexical_search": r"""
with doc as (
    select row_number() over () as r, doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') as words
    from documents where text is not null),
item as (
    select distinct item_id, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark where text is not null),
total as (select count(*) as docs, cast(sum(len(words)) as bigint) as words from doc where len(words) > 0),
posting as (
    select r, doc_id, n, term, count(*) as tf
    from (select r, doc_id, len(words) as n, unnest(words) as term from doc) group by all),
weight as (
    select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) as w
    from posting, total group by term, docs),
scored as (
    select item_id, r, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // words)))) as bigint) as score
    from item join posting using (term) join weight using (term), total group by item_id, r, doc_id)
select item_id, cast(place as integer) as "rank", doc_id, score
from (select *, row_number() over (partition by item_id order by score desc, doc_id) as place from scored where score > 0)
where place <= 10
""",
}
