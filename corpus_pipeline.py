"""From raw documents to token ids in five stages, each one a whole operator of ``loamline.llm``.

Every stage gets what the one before kept, written as Parquet and read again, and all but the last
return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loamline.llm import chosen_path, forced_cuts, line_quality, mixing, secrets
from loamline.llm.catalog import MIX, WORD_BPE, table, with_domain
from loamline.llm.shared import stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def keep_good_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or whose lines are mostly boilerplate."""
    field = line_quality.train(docs, table(spark, sf_dir, "labels"))
    return line_quality.kept(docs, field)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that near-duplicate links connect keep the one with the least id."""
    return chosen_path.one_of_each(docs)


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace found secrets in the text; all documents stay, ``n_chars`` follows the new text."""
    models = secrets.train(secrets.labelled_strings(docs))
    clean = secrets.redacted(docs, models)
    return clean.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else clean


def draw_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draw documents by the weights of domains, languages and sources, once per epoch drawn.

    The columns come out as they went in: a table's own ``domain`` and ``epoch`` take no part.
    """
    own = [F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns]
    known = {c: F.col(f"`{c}`") for c in ("doc_id", "text", "lang", "source")}
    mixed = mixing.drawn(with_domain(docs.select(*own, *[c.alias(n) for n, c in known.items()])), MIX)
    return mixed.select(*[F.col(f"`in_{c}`").alias(c) for c in docs.columns])


def encode_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Number of ids and digests of ids and decoded text of every document drawn."""
    return forced_cuts.bpe_round_trip(docs, public_tokenizers.path(WORD_BPE))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", keep_good_lines),
    ("n-gram Jaccard join", keep_one_of_each),
    ("secret scans", redact_secrets),
    ("mixing sources", draw_mix),
    ("BPE encoding and decoding", encode_ids),
]

# A conditional random field, the Markov models and the hash order of the mix have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(stage(spark, docs, sf_dir), spark, f"stage-{number}")
    return docs
