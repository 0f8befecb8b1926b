"""Training-data pipeline over ``documents``.

Language identification, near-duplicate removal, benchmark decontamination, masking of
personal data, packing.  Each stage takes ``(spark, docs, sf_dir)`` and works on all that
its predecessor kept; the first four return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from larkspur.llm import decontaminate, langid, ngram_join, packing, pii
from larkspur.llm.common import table, unused, without, written
from larkspur.llm.registry import TOKENIZER, held_out

#: Words of a benchmark item that rejects documents: shorter ones occur in clean text, too.
LEAST_WORDS = 5

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: What a document's language needs beyond the share of an even mixture, at no length and
#: besides at ``LONG`` characters or more: a short clean text can be ambiguous, a long one isn't.
MARGIN, LONG_MARGIN, LONG = 0.05, 0.15, 300


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known and rules them, with that language as ``lang``.

    Null text and text without a letter is rejected.  The model is fitted on a bounded
    sample of the stage's own rows that are labelled and not held out.  Without a single
    label nothing can be told, and all rows with text stay.
    """
    model = langid.train(langid.training_rows(docs.where(~held_out("doc_id"))))
    if not model.labels:
        return docs.where("text is not null")
    names = unused("lang_pred", docs.columns), unused("score", docs.columns)
    found = langid.predict(docs, model, keys=tuple(docs.columns), names=names)
    lang, score = map(F.col, names)
    return found.where((lang != langid.UNKNOWN) & (score >= least_share(len(model.labels), F.length("text")))).withColumn("lang", lang).select(*docs.columns)


def least_share(languages: int, characters: Column) -> Column:
    """Share of its words that the language of a text of so many characters needs, of so many languages."""
    return F.least(F.lit(0.95), 1 / languages + MARGIN + LONG_MARGIN * F.least(F.lit(1.0), characters / LONG))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that links connect, the one with the smallest id; those that link with nothing stay."""
    found = ngram_join.similar_components(docs)
    return without(docs, found.where("doc_id != component_id").select("doc_id"), "doc_id")


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage near an item of ``benchmark`` of at least ``LEAST_WORDS`` words."""
    leaks = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"), options=decontaminate.Options(least_words=LEAST_WORDS))
    return without(docs, leaks.select("doc_id"), "doc_id")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked in the text and ``n_chars`` brought up to date."""
    return pii.mask(docs).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, each a training sequence, with their ids."""
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate_benchmark),
    ("personal_data", mask_personal_data),
    ("packing", pack_sequences),
]

#: Trained models, edit distances and tokenizers are beyond SQL: tests/llm holds the
#: pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; every other stage is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
