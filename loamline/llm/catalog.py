"""Named queries of the training-data operators over whole tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import line_quality, secrets, urls
from loamline.llm.chosen_path import near_duplicates
from loamline.llm.fingerprints import fingerprints
from loamline.llm.forced_cuts import bpe_round_trip
from loamline.llm.id_files import id_round_trip
from loamline.llm.mixing import Mix, drawn
from loamline.llm.phrases import collocations
from loamline.llm.repeated_units import without_repeats
from loamline.llm.sim_hash import near_prints
from loamline.llm.token_counts import token_counts
from loamline.llm.vector_codes import vector_codes

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"

# Half of all tokens, drawn by these weights; a document at most four times.
MIX = Mix(
    weights={
        "domain": {"domain0": 3.0, "domain1": 2.0},
        "lang": {"en": 4.0, "de": 2.0, "fr": 2.0, "es": 2.0},
    },
    share=0.5,
    epochs=4,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op2_repeated_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"))


def op3_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return line_quality.quality(docs, field)


def with_domain(docs: DataFrame) -> DataFrame:
    """The test tables name no domains: sources fall into four by their number."""
    number = F.regexp_extract(F.coalesce("source", F.lit("")), "([0-9]+)$", 1)
    domain = F.concat(F.lit("domain"), F.coalesce(number.try_cast("bigint") % 4, F.lit(0)))
    return docs.withColumn("domain", domain)


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = with_domain(table(spark, sf_dir, "documents"))
    return drawn(docs, MIX).select("doc_id", "epoch", "domain", "lang", "source")


def op5_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_BPE))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.url_verdicts(pages, urls.train(urls.labelled_urls(pages)))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_scan(docs, secrets.train(secrets.labelled_strings(docs)))


def op8_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return id_round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op12_sim_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_prints(table(spark, sf_dir, "documents"))


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    named = (
        op1_token_counts,
        op2_repeated_units,
        op3_line_quality,
        op4_source_mix,
        op5_bpe_round_trip,
        op6_url_filter,
        op7_secret_scan,
        op8_id_files,
        op9_fingerprints,
        op10_near_duplicates,
        op11_vector_codes,
        op12_sim_hash,
        op13_phrases,
    )
    return {fn.__name__: fn for fn in named}


def oracle_sql() -> dict[str, str]:
    return {}
