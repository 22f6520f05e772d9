"""The corpus pipeline: language, toxicity, near duplicates, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; ``run``
writes each stage's rows as Parquet to the shared folder and rereads them for the next.
All stages but the last return the columns of ``documents``; the last returns one row per
packed sequence.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillroll.llm import decontam, langmix, packing, probminhash, toxicity
from tillroll.llm.common import session_workspace, table
from tillroll.llm.queries import MAX_TOKENS, TOKENIZER, packed_digests

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: A document stays if one language makes up at least this share of it.
LEAST_SHARE = 0.5
MOST_TOXIC = 0.5
#: What a worker keeps of words and their ids: the executors have the earlier stages' memory too.
CACHE_BYTES = 64 << 20


def _rows(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The documents with a row key, stored once: a number made anew by a second scan may differ."""
    return session_workspace(spark).stage(docs.select(*COLUMNS).withColumn("uid", F.monotonically_increasing_id()), "rows")


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those in which no language has a clear share."""
    models = langmix.train(docs, ~langmix.held_out(F.col("doc_id"), 4, 2))
    got = langmix.predict(spark, docs.select(*COLUMNS), models)
    return got.filter((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SHARE)).select(*COLUMNS)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the classifier takes for toxic."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~langmix.held_out(F.col("doc_id"), 5, 0))
    return toxicity.score(spark, docs.select(*COLUMNS), model, "_toxic").filter(F.col("_toxic") < MOST_TOXIC).select(*COLUMNS)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each near-duplicate group."""
    rows = _rows(spark, docs)
    dropped = probminhash.near_duplicates(spark, rows, uid="uid").filter(~F.col("kept")).select("uid")
    return rows.join(dropped, "uid", "left_anti").select(*COLUMNS)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold benchmark passages by the contamination rule."""
    rows = _rows(spark, docs)
    found = decontam.contamination(spark, rows, table(spark, sf_dir, "benchmark"), uid="uid").filter("contaminated").select("uid")
    return rows.join(found, "uid", "left_anti").select(*COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of power-of-two length, with their ids."""
    tokenizer = public_tokenizers.path(TOKENIZER)
    return packed_digests(packing.pack(docs, tokenizer, MAX_TOKENS, cache_bytes=CACHE_BYTES))


STAGES = [
    ("language", language),
    ("toxicity", not_toxic),
    ("near_dedup", deduplicated),
    ("decontamination", decontaminated),
    ("packing", packed),
]

#: SQL can't express the trained stages; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = session_workspace(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = ws.stage(stage(spark, docs, sf_dir), name)
    return docs
