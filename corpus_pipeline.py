"""A corpus pipeline over ``documents``: five stages, each one operator of ``tallyhouse.llm``, each written and read again.

Every stage takes (spark, docs, sf_dir) and returns a frame; all but the last return the columns of its input.  Stages hold
on empty tables, null texts, repeated rows and further columns; what each does with them is said in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers
from tallyhouse.llm.columns import unused
from tallyhouse.llm.decontamination import clean_documents
from tallyhouse.llm.language import UNKNOWN, predict_languages, train_network
from tallyhouse.llm.personal_data import redact
from tallyhouse.llm.pieces import piece_digests
from tallyhouse.llm.set_join import one_per_component
from tallyhouse.llm.workers import find_package
from tallyhouse.sources.workdir import new_folder

#: Score below which a text's language counts as not told, in shares of an even spread over the languages: 0.3 with four.
LEAST_LANGUAGE_LIFT = 1.2


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose language cannot be told: null texts, texts without a letter, and scores under the threshold.

    Where nothing teaches a language, or only one is taught, scores say nothing and all texts with a letter stay.
    """
    find_package(spark)
    network = train_network(docs)
    languages = 1 if network is None else len(network.labels)
    if languages == 1:
        return docs.filter(F.col("text").rlike(r"\p{L}"))
    language, score = unused(docs, "language"), unused(docs, "language_score")
    told = predict_languages(docs, network, language=language, score=score)
    return told.filter((F.col(language) != UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE_LIFT / languages)).select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document of the smallest id of each group linked by five-word shingles at a Jaccard similarity of 0.8."""
    find_package(spark)
    return one_per_component(docs).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a ten-word run, or a whole shorter item, of ``benchmark``."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*docs.columns)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every span of personal data by its kind in brackets; n_chars follows the text."""
    return redact(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document the number of piece ids and the digests of the ids and of the text they decode to."""
    find_package(spark)
    return piece_digests(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language_id", identify_language),
    ("ngram_jaccard_join", drop_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("sentencepiece", encode_pieces),
]

#: The stages are beyond SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each to the written rows of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = new_folder(spark, f"stage-{name}")
        rows = stage(spark, docs, sf_dir)
        rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
