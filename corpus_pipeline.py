"""From documents to packed training sequences: language, near duplicates, benchmarks, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from claimtree.llm import decontaminate, language_id, packing, pii, simhash
from claimtree.llm.common import free_name, stored, table

# A document is rejected if it has no letter, or if no language reaches this probability.
LEAST_SCORE = 0.5
# A key for the given tables only; real runs pass their own.
PII_KEY = "claimtree-example"


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; a NULL ``lang`` becomes the predicted one, a given one stays.

    The model learns from rows with a text and a language whose id is not held out. Rows go whose text is NULL,
    empty or without a letter, or whose language is less probable than ``LEAST_SCORE``; with no row to learn
    from, all go. Of equally probable languages the first by name is taken, with its score. Rows are judged one
    by one, so repeated rows stay or go together, NULL ids too. Other columns pass through, whatever their names.
    """
    model = language_id.train(docs.where(~language_id.held_out(F.col("doc_id"))))
    lang, score = free_name(docs, "__lang"), free_name(docs, "__score")
    found = language_id.identify(docs, model, lang=lang, score=score)
    kept = found.where((F.col(lang) != language_id.UNDETERMINED) & (F.col(score) >= LEAST_SCORE))
    return kept.withColumn("lang", F.coalesce("lang", lang)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group linked by close fingerprints, the document with the smallest id.

    NULL and empty texts, and texts without a word, have one fingerprint and are one group. Repeated rows become
    one; of several texts with the smallest id the one with the smallest fingerprint stays. Rows with a NULL id
    all stay, as they cannot be told apart. Other columns pass through.
    """
    return simhash.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    A NULL or empty text holds none and stays, as does every row if the benchmark is empty. Rows are judged one by
    one, so repeated rows and NULL ids change nothing; other columns pass through.
    """
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms in ``text`` and ``n_chars`` of the new text.

    Equal values become equal everywhere. A NULL text stays NULL, with a NULL ``n_chars``; an empty one stays
    empty, with 0. Repeated rows and NULL ids stay as they are, other columns pass through.
    """
    count = free_name(docs, "__values")
    hidden = pii.pseudonymise(docs, PII_KEY, count=count).drop(count)
    return hidden.withColumn("n_chars", F.length("text").cast("bigint")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their places in sequences of at most ``packing.CAPACITY`` ids.

    A NULL or empty text is the end id alone. Every row is a document of its own, repeated rows and NULL ids too;
    equally long pieces take their places in any order. Other columns are not used.
    """
    return packing.pack(docs)


STAGES = [
    ("language_id", detect_language),
    ("simhash_near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("packing", pack_sequences),
]

# Languages, fingerprints, edit distances, pseudonyms and token ids cannot be said in SQL; tests hold each
# stage against a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents, each written and read again as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
