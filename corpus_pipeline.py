"""From raw documents to packed sequences: each stage works on what the one before has kept.

Language identification drops texts that are in no language it has learned; of every class of near
duplicates one document stays; documents contaminated by benchmark passages go; secrets are replaced
by a mark; what is left is packed into sequences of token ids. A stage's result is written as
Parquet and read again by the next.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeflow.llm import arrays, decontamination, language, near_duplicates, packing, secret_scan
from gaugeflow.llm.ship import ship_package
from gaugeflow.session import write_out

#: The least share of a text's n-grams that its language must contain.
LEAST_SUPPORT = 0.3


def known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language: not ``und``, and most of the text's n-grams known.

    The filters learn from the given ``lang`` of three quarters of the documents. Null texts and
    texts without a letter go. If no row has a language nothing is learned, and all go.
    """
    ship_package(spark)
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    filters = language.train(docs.where(~F.coalesce(held_out, F.lit(False))))
    judged = language.judged(docs, filters)
    kept = judged.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("support") >= LEAST_SUPPORT))
    return arrays.unpacked(kept, docs.columns)


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near duplicates, that with the smallest ``doc_id``.

    Rows that share an id but not their words are documents of their own.
    """
    ship_package(spark)
    return near_duplicates.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth of the words lie in benchmark windows.

    Null and empty texts stay, equal rows go or stay together, and without items all stay.
    """
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.contamination(docs, items).where("contaminated")
    keyed = arrays.packed(docs, key=F.xxhash64("doc_id", F.col("text").cast("string")))
    return arrays.unpacked(keyed.join(found.select("key").distinct(), "key", "left_anti"), docs.columns)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark; ``n_chars`` follows the new text."""
    model = secret_scan.train(secret_scan.labelled_samples(docs))
    clean = secret_scan.redact(secret_scan.find_secrets(arrays.packed(docs, text=F.col("text").cast("string")), model))
    new = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = F.when(F.size("spans") > 0, F.length("text").cast("long"))
        new["n_chars"] = F.coalesce(changed, F.col("row.n_chars"))
    return arrays.unpacked(clean, docs.columns, **new)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of 4096 token ids.

    A null or empty text is a piece of one id; repeated rows are packed each for itself.
    """
    ship_package(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), plain_special=False)


STAGES = [
    ("language", known_languages),
    ("near_duplicates", without_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

#: No SQL says the same: the first two stages learn and hash.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        rows = write_out(stage(spark, rows, sf_dir), f"stage-{name}")
    return rows
