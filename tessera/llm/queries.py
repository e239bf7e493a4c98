"""The registered queries of this subpackage: (spark, sf_dir) -> DataFrame, and their SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import ann, decontamination, fingerprint, langid, maintext, mixing, neardup, pieces, pii, spelling, toxicity, warc, whitening
from tessera.llm.shared import read_table


def fold(column: str, folds: int) -> Column:
    """crc32 of an id as text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(read_table(spark, sf_dir, "documents"))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"), fold("doc_id", 5) == 0)


def op3_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, sf_dir, "documents"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"), percent=85)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(spark, read_table(spark, sf_dir, "pages"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintext.extract_main_text(read_table(spark, sf_dir, "pages"))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(read_table(spark, sf_dir, "documents"), fold("doc_id", 3) == 1)


def op9_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode_documents(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op10_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_documents(read_table(spark, sf_dir, "documents"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(read_table(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten_embeddings(read_table(spark, sf_dir, "embeddings"))


def op13_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def queries() -> dict:
    return {"op1_mix": op1_mix, "op2_toxicity": op2_toxicity, "op3_personal_data": op3_personal_data, "op4_near_duplicates": op4_near_duplicates, "op5_warc": op5_warc, "op6_main_text": op6_main_text, "op7_nearest": op7_nearest, "op8_language": op8_language, "op9_pieces": op9_pieces, "op10_fingerprint": op10_fingerprint, "op11_spelling": op11_spelling, "op12_whitening": op12_whitening, "op13_decontamination": op13_decontamination}


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": mixing.ORACLE, "op4_near_duplicates": neardup.ORACLE, "op5_warc": warc.ORACLE, "op11_spelling": spelling.ORACLE, "op13_decontamination": decontamination.ORACLE}
