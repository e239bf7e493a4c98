"""A corpus pipeline of five stages over the documents table.

Each stage is a function of (spark, docs, sf_dir) whose result is written as Parquet and read again as the
docs of the next. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm import langid, mixing, neardup, pieces, pii
from tessera.llm.shared import read_table, settle

#: The stages include trained models, which SQL does not express; tests hold them against plain versions.
ORACLE_SQL = None

#: Least share of a text's letters that must be in spans of its main language.
LEAST_SHARE = 0.3
#: Least likelihood of a text's n-grams against those of its languages' own texts.
LEAST_CONFIDENCE = 0.1
#: Documents whose sets of five-word shingles share so many percent of their union are near duplicates.
NEAR_PERCENT = 80


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: sets lang to the predicted language; documents without letters, without a main language, or unlike all learned languages go."""
    columns = docs.columns
    model = langid.fit(docs)
    kept = docs.select(*[c for c in columns if c != "lang"])
    predicted = langid.predict_with(kept, model)
    return predicted.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SHARE) & (F.col("confidence") >= LEAST_CONFIDENCE)).withColumn("lang", F.col("lang_pred")).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of each group of linked rows, that with the least doc_id stays; rows without a doc_id all stay."""
    return neardup.without_near_duplicates(docs, NEAR_PERCENT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """PII: all spans are masked; n_chars follows the text."""
    return pii.mask_personal_data(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mixing sources to target weights: each document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding: the columns of documents without the text, and the ids of its pieces; each copy that the mix made has drops of its own."""
    copies = W.partitionBy("doc_id", F.xxhash64("text")).orderBy("source", "lang", "n_chars")
    return pieces.encode_documents(docs.withColumn("__epoch", F.row_number().over(copies)), epoch_col="__epoch").drop("text", "__epoch")


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
