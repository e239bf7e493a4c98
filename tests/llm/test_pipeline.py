"""The stages of the pipeline, one by one, and the registered queries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import langid, mixing, neardup, queries
from tessera.llm.shared import settle
from tests.compare import connect, same


def test_stages(spark, sf_dir):
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    docs = start
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "personal_data", "mix", "encode"]
    before = {}
    for name, stage in corpus_pipeline.STAGES:
        before[name] = docs
        docs = settle(stage(spark, docs, sf_dir))
        if name != "encode":
            assert docs.columns == start.columns
        before[name + "/out"] = docs
    out = lambda n: before[n + "/out"]
    assert out("language").count() >= 0.98 * start.count()
    kept = {r.doc_id for r in neardup.near_duplicates(before["near_duplicates"], percent=corpus_pipeline.NEAR_PERCENT).filter("kept").collect()}
    assert {r.doc_id for r in out("near_duplicates").select("doc_id").collect()} == kept
    assert out("personal_data").count() == before["personal_data"].count()
    assert out("personal_data").filter(F.col("text").rlike(r"[a-z0-9]+@[a-z0-9]+\.example\.com")).count() == 0
    want = mixing.mix_sources(before["mix"]).agg(F.sum("epochs")).first()[0]
    assert out("mix").count() == want == docs.count()
    assert docs.filter("not lossless").count() == 0


def test_stages_take_empty_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = settle(stage(spark, docs, sf_dir))
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_against_sql(name, spark, sf_dir):
    same(queries.queries()[name](spark, sf_dir), connect(sf_dir), queries.oracle_sql()[name])


def test_numbers():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.queries()) == list(range(1, 14))


def test_near_duplicates_from_four_fifths(spark):
    words = [f"w{k}" for k in range(204)]
    # 200 shingles; four changed words that are apart take 20 of them, so 180 of 220 are shared.
    other = [f"x{k}" if k in (20, 60, 100, 140) else w for k, w in enumerate(words)]
    rows = [(k, " ".join(w), "en", "s", 0) for k, w in enumerate((words, other))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()] == [0]
    assert neardup.near_duplicates(docs, percent=85).filter("kept").count() == 2


def test_near_duplicates_stage_takes_what_four_fifths_keep(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = {r.doc_id for r in neardup.near_duplicates(docs, percent=80).filter("kept").collect()}
    assert {r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, sf_dir).select("doc_id").collect()} == kept
    assert len(kept) < neardup.near_duplicates(docs).filter("kept").count()


def test_copies_of_the_mix_are_encoded_apart(spark):
    text = "the understanding of languages is a matter of some importance " * 20
    docs = spark.createDataFrame([(1, text, "en", "s", len(text))] * 3 + [(1, text + "x", "en", "s", len(text) + 1)], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.encode(spark, docs, "").collect()
    assert len({tuple(r.ids) for r in got}) == 4 and all(r.lossless for r in got)
    assert sorted(got) == sorted(corpus_pipeline.encode(spark, docs.repartition(3), "").collect())


def test_language_stage_rejects_what_is_not_learned(spark, sf_dir):
    start = spark.read.parquet(f"{sf_dir}/documents.parquet")
    short = start.filter("n_chars > 40").withColumn("text", F.array_join(F.slice(F.split("text", " "), 1, 2), " "))
    odd = ["Αυτό είναι ένα κείμενο", "これは日本語です", "สวัสดีครับ", "one Αυτό είναι ένα κείμενο και άλλο", "xqzv kjwpq zzxj qqwk vbnx jjqz", "To jest polski tekst o niczym szczególnym"]
    planted = spark.createDataFrame([(-1 - k, t, None, "s", len(t)) for k, t in enumerate(odd)], start.schema)
    docs = settle(start.unionByName(short.withColumn("doc_id", F.col("doc_id") + 1_000_000)).unionByName(planted))
    got = {r.doc_id for r in corpus_pipeline.language(spark, docs, sf_dir).collect()}
    assert not [k for k in got if k < 0]
    assert len(got) >= 0.99 * (start.count() + short.count())
    by = {r.doc_id: r for r in langid.predict(planted, langid.fit(docs)).collect()}
    assert [by[k].score for k in (-1, -2, -3)] == [0.0] * 3 and {r.lang_pred for r in by.values()} <= {"de", "en", "es", "fr"}


def test_rows_without_or_with_repeated_ids_stay_where_they_differ(spark):
    a, b, c, d = ("the quick brown fox jumps over it", "a lazy dog sleeps all day long here", "nothing of this is said anywhere else", "one more text that is all by itself")
    rows = [(None, a), (None, b), (None, b), (1, a), (2, a), (2, b), (2, c), (2, c), (3, b), (4, d), (4, d)]
    docs = spark.createDataFrame([(k, t, "en", "s", len(t)) for k, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.repartition(3)):
        got = corpus_pipeline.near_duplicates(spark, some, "").select("doc_id", "text").collect()
        assert Counter(map(tuple, got)) == Counter([(None, a), (None, b), (None, b), (1, a), (2, b), (2, c), (4, d)])


def test_mix_matches_rows_that_share_an_id(spark):
    rows = [(1, "w " * (k + 1), "big" if k % 2 else "small") for k in range(30)] + [(None, f"v{k} " * 5, "big") for k in range(30)] + [(1, "", "big")]
    docs = settle(spark.createDataFrame([(k, t, "en", s, len(t)) for k, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long"))
    taken = {r.source: r.taken for r in mixing.mix_sources(docs).groupBy("source").agg(F.sum("taken").alias("taken")).collect()}
    mixed = mixing.mixed_documents(docs)
    assert {r.source: r.n for r in mixed.groupBy("source").agg(F.sum(mixing.word_count(F.col("text"))).alias("n")).collect()} == taken
    assert Counter(mixed.collect()) == Counter(mixing.mixed_documents(docs.repartition(3)).collect())
