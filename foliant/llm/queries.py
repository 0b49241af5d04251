"""Queries of the training-data operators, each over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliant.llm import html, lz, packing, pieces, quality, secrets, sharding, simhash, toxicity, warc
from foliant.llm.common import table


def op1_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisits(spark, table(spark, sf_dir, "pages"))


def op2_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secrets_report(table(spark, sf_dir, "documents"))


def op3_piece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.report(table(spark, sf_dir, "documents"))


def op4_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(table(spark, sf_dir, "documents"))


def op5_lz_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lz.fingerprint_report(table(spark, sf_dir, "documents"))


def op6_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(table(spark, sf_dir, "pages"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_of(F.col("fp")).alias("fingerprint"), "component_id")


def op8_extendible_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), limit=sharding.QUERY_BYTES)


def op9_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op10_toxicity_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {f.__name__: f for f in (op1_warc_revisits, op2_secret_markov, op3_piece_dropout, op4_quality_cascade,
    op5_lz_fingerprint, op6_html_main_text, op7_simhash_near_dedup, op8_extendible_sharding, op9_online_packing,
    op10_toxicity_ordinal)}

ORACLES = {"op1_warc_revisits": warc.REVISIT_SQL, "op4_quality_cascade": quality.QUALITY_SQL,
    "op8_extendible_sharding": sharding.SHARD_SQL}
