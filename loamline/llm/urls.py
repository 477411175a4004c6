"""URL filters: host and path rules, and boosted trees on lexical features (operator 6).

Features are column expressions and the trees are Spark's own; no Python runs on the executors.
"""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import stored

# The rules (host, path, verdict).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
# No table labels URLs. For training, a URL counts as bad when its host holds one of these words;
# the trees never see words, only the lexical features.
BAD_WORDS = ("spam", "casino", "bets", "pills")
TRAINING_ROWS = 20_000
HOST_CHARACTERS = string.ascii_lowercase + string.digits + "-."
FEATURES = (
    "url_length",
    "host_length",
    "path_length",
    "host_labels",
    "path_depth",
    "digit_ratio",
    "hyphens",
    "host_entropy",
    "parameters",
    "suffix_rate",
    "suffix_share",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, question mark, hash or the end; A-Z in lower case."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(
        F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit("")
    )


def path_of(url: Column) -> Column:
    """What follows the host, up to a question mark, hash or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """Number of the longest fitting rule, NULL without one; of equally long ones the first."""
    order = sorted(range(len(rules)), key=lambda i: (-len(rules[i][0] + rules[i][1]), i))
    fits = [
        F.when(
            ((host == rules[i][0]) | host.endswith(f".{rules[i][0]}")) & path.startswith(rules[i][1]),
            F.lit(i),
        )
        for i in order
    ]
    return F.coalesce(*fits) if fits else F.lit(None).cast("int")


def occurrences(text: Column, part: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(part), F.lit("")))


def suffix_of(host: Column) -> Column:
    """The last two labels of the host."""
    return F.substring_index(host, ".", -2)


def lexical(urls: DataFrame) -> DataFrame:
    """Add the features that follow from the URL alone. Expects columns url, host, path."""
    url, host = F.coalesce("url", F.lit("")), F.col("host")
    counts = [occurrences(host, c) for c in HOST_CHARACTERS]
    total = F.greatest(F.length(host), F.lit(1))

    def term(n: Column) -> Column:
        return F.when(n > 0, -(n / total) * F.log2(n / total)).otherwise(0.0)

    entropy = sum((term(n) for n in counts), F.lit(0.0))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    return urls.withColumns(
        {
            "url_length": F.length(url).cast("double"),
            "host_length": F.length(host).cast("double"),
            "path_length": F.length("path").cast("double"),
            "host_labels": occurrences(host, ".").cast("double") + 1,
            "path_depth": occurrences(F.col("path"), "/").cast("double"),
            "digit_ratio": F.length(F.regexp_replace(url, "[^0-9]", ""))
            / F.greatest(F.length(url), F.lit(1)),
            "hyphens": occurrences(host, "-").cast("double"),
            "host_entropy": entropy,
            "parameters": F.when(query == "", 0.0).otherwise(
                occurrences(query, "&").cast("double") + 1
            ),
            "suffix": suffix_of(host),
        }
    )


@dataclass(frozen=True)
class UrlModel:
    """Boosted trees with the suffix statistics they were trained on. Without trees all is allowed."""

    suffixes: DataFrame
    prior: float
    trees: PipelineModel | None
    block_from: float = 0.5

    def judged(self, urls: DataFrame) -> DataFrame:
        """Add ``score`` (probability of a bad URL) to rows with url, host and path."""
        if self.trees is None:
            return urls.withColumn("score", F.lit(0.0))
        scored = self.trees.transform(self.features(urls))
        return scored.withColumn("score", vector_to_array("probability")[1]).select(
            *urls.columns, "score"
        )

    def features(self, urls: DataFrame) -> DataFrame:
        known = self.suffixes.select("suffix", "bad", "rows", "share")
        return lexical(urls).join(known, "suffix", "left").withColumns(
            {
                "suffix_rate": rate(F.coalesce("bad", F.lit(0)), F.coalesce("rows", F.lit(0)), self.prior),
                "suffix_share": F.coalesce("share", F.lit(0.0)),
            }
        )


def rate(bad: Column, rows: Column, prior: float) -> Column:
    """Share of bad URLs, drawn towards the overall share by ten rows' weight."""
    return (bad + 10 * prior) / (rows + 10)


def train(
    labelled: DataFrame, rows: int = TRAINING_ROWS, trees: int = 12, depth: int = 4, seed: int = 7
) -> UrlModel:
    """Fit on at most ``rows`` different labelled URLs (columns url, label 0/1), chosen by a hash of the URL.

    Rows without a URL or with another label are left out, repeated ones count once; a URL with both
    labels counts with each. The sample is written once and read from there by everything that follows.
    Suffix statistics come from the same rows; a training row's own label is taken out of its rate.
    With no rows or only one label there are no trees, and every URL is allowed.
    """
    sample = (
        labelled.filter(F.col("label").isin(0, 1) & F.col("url").isNotNull())
        .select("url", F.col("label").cast("double").alias("label"))
        .distinct()
        .orderBy(F.xxhash64("url"), "url", "label")
        .limit(rows)
        .withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    )
    chosen = stored(sample, labelled.sparkSession, "url-sample")
    total, bad = chosen.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0.0))).first()
    prior = bad / total if total else 0.0
    suffixes = stored(
        chosen.groupBy(suffix_of(F.col("host")).alias("suffix"))
        .agg(F.sum("label").alias("bad"), F.count("*").alias("rows"))
        .withColumn("share", F.col("rows") / F.lit(max(total, 1))),
        labelled.sparkSession,
        "url-suffixes",
    )
    if not 0 < bad < total:
        return UrlModel(suffixes, prior, None)
    own = UrlModel(suffixes, prior, None).features(chosen)
    own = own.withColumn("suffix_rate", rate(F.col("bad") - F.col("label"), F.col("rows") - 1, prior))
    own = stored(own.select(*FEATURES, "label"), labelled.sparkSession, "url-features")
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    fitted = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=trees, maxDepth=depth, seed=seed
    ).fit(assembler.transform(own).select("features", "label"))
    return UrlModel(suffixes, prior, PipelineModel([assembler, fitted]))


def labelled_urls(pages: DataFrame, words: Sequence[str] = BAD_WORDS) -> DataFrame:
    bad = F.greatest(*[host_of(F.col("url")).contains(w).cast("int") for w in words])
    return pages.select("url", bad.alias("label"))


def url_verdicts(
    pages: DataFrame,
    model: UrlModel,
    rules: Sequence[tuple[str, str, str]] = RULES,
    id_column: str = "page_id",
) -> DataFrame:
    """One row per row of ``pages``: id, host, path, rule, verdict, score.

    A rule fits its host and all subdomains when the path starts with the rule's; the longest wins.
    Other URLs go by the trees. A NULL URL, or one without ``://``, has an empty host and path and
    is judged by the trees like any other; a NULL id stays NULL; repeated rows come out as often;
    other columns are ignored; an empty table gives an empty table.
    """
    parsed = pages.select(F.col(id_column), F.col("url").cast("string").alias("url")).withColumns(
        {"host": host_of(F.col("url")), "path": path_of(F.col("url"))}
    )
    names = F.array(*[F.lit(h + p) for h, p, _ in rules]) if rules else F.array(F.lit(""))
    verdicts = F.array(*[F.lit(v) for *_, v in rules]) if rules else F.array(F.lit(""))
    judged = model.judged(parsed).withColumn("__rule", rule_of(F.col("host"), F.col("path"), rules))
    by_trees = F.when(F.col("score") >= model.block_from, "block").otherwise("allow")
    return judged.select(
        id_column,
        "host",
        "path",
        F.get(names, F.col("__rule")).alias("rule"),
        F.coalesce(F.get(verdicts, F.col("__rule")), by_trees).alias("verdict"),
        "score",
    )
