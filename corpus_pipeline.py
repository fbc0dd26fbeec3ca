"""A corpus cleaning pipeline: quality, near duplicates, benchmark passages, personal data, token ids.

Each stage takes (spark, docs, sf_dir), docs having the columns of `documents`,
and returns a DataFrame; run() writes what a stage returns as Parquet to the
shared folder and rereads it for the next.  Nothing is collected on the driver
but the bounded samples that the quality classifier is fitted on.

All stages take nulls in any column, empty, blank and very long texts, repeated
rows and repeated or missing ids, and empty tables (which stay empty); columns
of docs beyond COLUMNS are left out, whatever their names.  A null text counts
as empty where it is judged and stays null where it is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastra.llm import bpe, decontaminate, forest, pii, quality
from cadastra.llm.common import give_back, importable, remainder, shared_dir, stored, table

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Bytes of texts that travel to and from a Python worker at once; by default 10,000 rows do, whatever their length.
BATCH_SETTING, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


def drop_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps what the quality classifier scores at or above its threshold; fitted on the labels outside the held-out fold.

    Rows are judged one by one: equal texts fare alike, a score that ties with the threshold is kept, and an empty
    text has the score of an empty text.  Without labels of both kinds all scores are equal.
    """
    give_back(spark)
    docs = docs.select(*COLUMNS)
    labels = table(spark, sf_dir, "labels")
    model = quality.fit(docs, labels.where(remainder("doc_id", 5) != 0))
    return quality.score(docs, model, list(COLUMNS)).where(F.col("score") >= quality.THRESHOLD).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates (five-word shingles, similarity from 0.8) one row stays.

    It is the one with the least id, then the least hash of its text, then the least of rows equal in both; a missing id
    counts as the largest.  Texts without shingles (null or blank) are in no group, and stay.
    """
    give_back(spark)
    docs = docs.select(*COLUMNS)
    path = shared_dir(spark)
    found = forest.near_duplicates(docs, path, width=5, percent=80).where("group is not null")
    each = stored(found.groupBy("group", "k", "th").agg(F.count(F.lit(1)).alias("n")), f"{path}/each")
    first = each.groupBy("group").agg(F.min(F.struct("k", "th")).alias("first"))
    stays = F.struct("k", "th") == F.col("first")
    # of what stays, only rows that others equal are looked at again
    judged = stored(each.join(first, "group").where(~stays | (F.col("n") > 1)).select("k", "th", stays.alias("stays")), f"{path}/judged")
    key, th = F.coalesce(F.col("doc_id"), F.lit(forest.NO_KEY)), F.xxhash64("text")
    single = docs.join(judged, (key == judged.k) & (th == judged.th), "left_anti").select(*COLUMNS)
    equal = judged.where("stays")
    same = docs.join(equal, (key == equal.k) & (th == equal.th), "left_semi").select(key.alias("k"), th.alias("th"), F.struct(*COLUMNS).alias("row"))
    return single.unionByName(same.groupBy("k", "th").agg(F.min("row").alias("row")).select("row.*"))


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap with a benchmark item go, with all rows equal in id and text; null and blank texts stay."""
    give_back(spark)
    docs = docs.select(*COLUMNS)
    found = decontaminate.overlaps(docs, table(spark, sf_dir, "benchmark"), shared_dir(spark)).select("k", "th").distinct()
    return docs.join(found, docs.doc_id.eqNullSafe(found.k) & (F.xxhash64("text") == found.th), "left_anti").select(*COLUMNS)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each span of personal data is replaced by its kind in brackets; n_chars follows where something was.

    All rows stay.  Of spans that overlap, the first gives the kind; what is learnt from one document masks others.
    """
    give_back(spark)
    docs = docs.select(*COLUMNS)
    found = pii.personal_data(docs, shared_dir(spark)).where(F.size("spans") > 0).select("k", "th", "spans").distinct()
    both = docs.join(found, docs.doc_id.eqNullSafe(found.k) & (F.xxhash64("text") == found.th), "left")
    clean = F.when(F.col("spans").isNull(), F.col("text")).otherwise(pii.redacted(F.col("text"), F.col("spans")))
    masked = both.select("doc_id", clean.alias("text"), "lang", "source", "n_chars", F.col("spans").isNotNull().alias("changed"))
    return masked.withColumn("n_chars", F.when(F.col("changed"), F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, with the digests of ids and of the decoded text; none for null and empty texts.  All rows stay."""
    give_back(spark)
    return bpe.encode(docs, bpe.vocabulary(), keep=("doc_id", "lang", "source"), ids=True)


STAGES = [
    ("quality", drop_low_quality),
    ("near-duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("personal data", mask_personal_data),
    ("token ids", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    path = shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    before = spark.conf.get(BATCH_SETTING)
    spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    try:
        for k, (_, stage) in enumerate(STAGES):
            docs = stored(stage(spark, docs, sf_dir), f"{path}/stage{k}")
    finally:
        spark.conf.set(BATCH_SETTING, before)
    return docs


#: Classifiers and the tokenizer can't be said in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None
