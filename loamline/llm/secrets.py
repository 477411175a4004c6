"""Secret scans: fixed patterns, and Markov models of random strings and identifiers (operator 7).

Everything is a column expression; no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds in their order, pattern, the group whose length counts, and its least length.
# A run of at least 16 digits found from the left is a whole run, so short ones need no match.
KINDS = (
    (
        "assign",
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        12,
    ),
    ("access", r"AKIA[A-Z0-9]+", 0, 18),
    ("hex", r"[0-9a-f]{16,}", 0, 16),
)
# Words without which a pattern cannot match; looking for them is far cheaper than the pattern.
NEEDED = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
}
METHOD_KIND = "markov"

# The characters that the models know run from + to z.
FIRST, CODES = ord("+"), ord("z") - ord("+") + 1
RUN = "A-Za-z0-9+/_=-"
# Runs from the least length of the fixed patterns on are judged. Most short runs are plain words, so
# a run of fewer than LONG_RUN characters is judged only if it holds a digit, a capital after its first
# character, or one of + / =, which random base 64, hexadecimal or capitals lack once in ten thousand.
LEAST_RUN, LONG_RUN = 12, 20
CANDIDATE = (
    rf"(?<![{RUN}])(?:(?=[{RUN}]?[a-z_-]*[A-Z0-9+/=])[{RUN}]{{{LEAST_RUN},}}|[{RUN}]{{{LONG_RUN},}})"
)
IDENTIFIER = r"(?<![\p{L}\p{N}_-])[A-Za-z][A-Za-z0-9_-]{5,}(?![\p{L}\p{N}_-])"
TRAINING_ROWS = 4_000
WORDS_PER_TEXT = 50
BLOCK = 256


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is named there.

    Spark works out an expression anew wherever a function over arrays names it, for each element.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def running_starts(sizes: Column) -> Column:
    """Exclusive running sums of an array of numbers, in blocks so that long arrays stay cheap."""

    def total(array: Column) -> Column:
        return F.aggregate(array, F.lit(0).cast("bigint"), lambda a, x: a + x)

    def within(part: Column, base: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(part) - 1)
        return F.transform(at, lambda j: base + total(F.slice(part, 1, j)))

    def starts(own: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.ceil(F.size(own) / BLOCK).cast("int") - 1)
        parts = F.transform(blocks, lambda b: F.slice(own, b * BLOCK + 1, BLOCK))
        return bound(
            F.struct(parts.alias("parts"), F.transform(parts, total).alias("sums")),
            lambda p: F.flatten(
                F.transform(p["parts"], lambda part, b: within(part, total(F.slice(p["sums"], F.lit(1), b))))
            ),
        )

    none = F.array().cast("array<bigint>")
    return bound(sizes, lambda own: F.when(F.size(own) > 0, starts(own)).otherwise(none))


def matches(
    text: Column,
    pattern: str,
    group: int,
    least: int,
    rank: int,
    small: Column | None = None,
    needed: Iterable[str] = (),
) -> Column:
    """Spans of the matches (leftmost, not overlapping) whose group is long enough.

    Text is cut at the matches; the lengths of cuts and matches in turn give the positions. Where
    ``small``, the text in lower case, holds none of the ``needed`` words, there are no matches.
    """
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.transform(F.split(text, pattern, -1), lambda s: F.length(s).cast("bigint"))
    found = [whole.alias("whole"), between.alias("between")]
    if group:
        found.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("counted"))

    def spans(cut: Column) -> Column:
        steps = F.zip_with(
            F.slice(cut["between"], F.lit(1), F.size(cut["whole"])),
            cut["whole"],
            lambda gap, m: gap + F.length(m).cast("bigint"),
        )
        rows = F.arrays_zip(
            running_starts(steps).alias("before"),
            cut["between"].alias("gap"),
            cut["whole"].alias("text"),
            cut["counted" if group else "whole"].alias("counted"),
        )
        kept = F.filter(rows, lambda r: F.length(r["counted"]) >= least)
        return F.transform(
            kept,
            lambda r: F.struct(
                (r["before"] + r["gap"]).alias("start"),
                F.lit(rank).alias("rank"),
                (r["before"] + r["gap"] + F.length(r["text"])).alias("end"),
                r["text"].alias("text"),
            ),
        )

    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint,text:string>>")
    possible = F.rlike(text, F.lit(pattern))
    if needed:
        possible = reduce(or_, [small.contains(word) for word in needed]) & possible
    return F.when(possible, bound(F.struct(*found), spans)).otherwise(none)


def codes_of(text: Column) -> Column:
    return F.transform(F.split(text, ""), lambda c: F.ascii(c) - FIRST)


@dataclass(frozen=True)
class MarkovPair:
    """Log-likelihood ratios (random over ordinary) of each pair of neighbouring characters.

    ``ratios[a * CODES + b]`` is the ratio for the character coded b after the one coded a.
    """

    ratios: tuple[float, ...]
    least_total: float = 8.0
    least_mean: float = 0.4

    def score(self, text: Column) -> Column:
        """Sum of the ratios over the text's pairs."""
        table = F.split(F.lit(",".join(f"{r:.5f}" for r in self.ratios)), ",").cast("array<double>")

        def summed(codes: Column) -> Column:
            pairs = F.zip_with(
                F.slice(codes, 1, F.size(codes) - 1),
                F.slice(codes, 2, F.size(codes) - 1),
                lambda a, b: F.get(table, a * CODES + b),
            )
            return F.aggregate(pairs, F.lit(0.0), lambda total, r: total + r)

        one = F.transform(F.array(codes_of(text)), summed)
        return F.when(F.length(text) > 1, F.element_at(one, 1)).otherwise(F.lit(0.0))

    def random(self, text: Column) -> Column:
        floor = F.greatest(F.lit(self.least_total), (F.length(text) - 1) * self.least_mean)
        return self.score(text) >= floor


def train(samples: DataFrame, text: str = "text", label: str = "label", **limits) -> MarkovPair:
    """Fit both chains by counts over labelled strings (label 1: random, 0: ordinary identifier).

    Counting is one grouped aggregation; at most 2 * 80 * 80 counts come to the driver. Strings of
    other characters are left out there, NULLs too. Counts are smoothed by one half. Without samples
    of a class its chain is uniform.
    """
    usable = samples.filter(F.col(text).rlike(r"^[+-z]{2,}$")).select(
        F.col(label).cast("int").alias("label"), codes_of(F.col(text)).alias("codes")
    )
    pairs = usable.select(
        "label",
        F.explode(
            F.zip_with(
                F.slice("codes", 1, F.size("codes") - 1),
                F.slice("codes", 2, F.size("codes") - 1),
                lambda a, b: a * CODES + b,
            )
        ).alias("pair"),
    )
    counts = [[0.5] * (CODES * CODES) for _ in range(2)]
    for row in pairs.groupBy("label", "pair").count().collect():
        if row.label in (0, 1):
            counts[row.label][row.pair] += row["count"]
    logs = []
    for chain in counts:
        rows = [chain[a * CODES : (a + 1) * CODES] for a in range(CODES)]
        logs.append([math.log(n / sum(row)) for row in rows for n in row])
    return MarkovPair(tuple(r - o for o, r in zip(*logs)), **limits)


def labelled_strings(
    docs: DataFrame, text_column: str = "text", rows: int = TRAINING_ROWS
) -> DataFrame:
    """Labelled samples from at most ``rows`` different texts, chosen by their hashes.

    Random strings are base-64, hexadecimal and capital digests of the texts; ordinary identifiers
    are words of those documents in which no fixed pattern matches.
    """
    own = docs.select(F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    own = own.filter(F.length("text") > 0).withColumn("order", F.xxhash64("text"))
    # Only hashes are put in order; the last one chosen then filters the texts.
    least = own.select("order").distinct().orderBy("order").limit(rows)
    last = least.agg(F.max("order")).first()[0]
    chosen = own.filter(F.col("order") <= F.lit(last)).dropDuplicates(["order"])
    text, digest = F.col("text"), F.sha2(F.col("text"), 256)
    base64 = F.regexp_replace(F.base64(F.unhex(digest)), "=", "")
    random = F.array(base64, digest, F.upper(F.substring(digest, 1, 24)))
    clean = ~F.rlike(text, F.lit("|".join(f"({p})" for _, p, _, _ in KINDS[::-1])))
    words = F.slice(F.regexp_extract_all(text, F.lit(IDENTIFIER), F.lit(0)), 1, WORDS_PER_TEXT)
    return chosen.select(F.lit(1).alias("label"), F.explode(random).alias("text")).unionByName(
        chosen.filter(clean).select(F.lit(0).alias("label"), F.explode(words).alias("text"))
    )


def joined(spans: Column, names: Iterable[str]) -> Column:
    kinds = F.array(*[F.lit(n) for n in names])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["rank"]), s["start"], s["end"])),
        ",",
    )


def uncovered(runs: Column, spans: Column, rank: int) -> Column:
    """What ``spans``, in order of start, leave of ``runs``: all pieces of two characters or more."""

    def pieces(run: Column) -> Column:
        over = F.filter(spans, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))

        def piece(start: Column, end: Column) -> Column:
            text = F.substring(run["text"], (start - run["start"] + 1).cast("int"), (end - start).cast("int"))
            return F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), text.alias("text")
            )

        # Gaps lie between the furthest end so far and the next start, the last before the run's end.
        last = F.struct(run["end"].alias("start"), run["end"].alias("end"))
        edges = F.concat(F.transform(over, lambda b: F.struct(b["start"].alias("start"), b["end"].alias("end"))), F.array(last))
        none = F.struct(run["start"].alias("at"), F.filter(F.array(run), lambda r: F.lit(False)).alias("out"))

        def step(done: Column, edge: Column) -> Column:
            wide = edge["start"] - done["at"] > 1
            return F.struct(
                F.greatest(done["at"], edge["end"]).alias("at"),
                F.when(wide, F.concat(done["out"], F.array(piece(done["at"], edge["start"])))).otherwise(done["out"]).alias("out"),
            )

        return F.when(F.size(over) == 0, F.array(run)).otherwise(
            F.aggregate(edges, none, step, lambda done: done["out"])
        )

    return F.when(F.size(spans) == 0, runs).otherwise(F.flatten(F.transform(runs, pieces)))


def with_spans(docs: DataFrame, models: MarkovPair, text_column: str = "text") -> DataFrame:
    """``docs`` with the arrays ``base_spans`` and ``all_spans`` (start, rank of kind, end, text).

    Positions are code points, the end exclusive, in order of start and kind. NULL and empty texts
    have none. The models judge runs of 12 or more key characters (of fewer than 20 only if they are no
    plain words); of a run that base spans touch they judge each piece outside of them, whatever its length.
    """
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    base = F.array_sort(
        F.concat(
            *[
                matches(text, p, g, n, rank, F.col("small_text"), NEEDED.get(kind, ()))
                for rank, (kind, p, g, n) in enumerate(KINDS)
            ]
        )
    )
    runs = matches(text, CANDIDATE, 0, LEAST_RUN, len(KINDS))
    pieces = uncovered(F.col("run_spans"), F.col("base_spans"), len(KINDS))
    apart = F.filter(pieces, lambda r: models.random(r["text"]))
    return (
        docs.withColumn("small_text", F.lower(text))
        .withColumn("base_spans", base)
        .withColumn("run_spans", runs)
        .withColumn("all_spans", F.array_sort(F.concat("base_spans", apart)))
        .drop("run_spans", "small_text")
    )


def secret_scan(
    docs: DataFrame, models: MarkovPair, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, n_assign, n_access, n_hex, base_sha256, spans, n_markov.

    NULL and empty texts have no spans and the digest of the empty string; a NULL id stays NULL;
    repeated rows come out as often; other columns are ignored; an empty table gives an empty table.
    """
    names = [*(k for k, *_ in KINDS), METHOD_KIND]
    chosen = docs.select(F.col(id_column), F.col(text_column).alias("text"))
    found = with_spans(chosen, models)

    def count(rank: int) -> Column:
        return F.size(F.filter("all_spans", lambda s: s["rank"] == rank)).cast("bigint")

    return found.select(
        id_column,
        *[count(rank).alias(f"n_{name}") for rank, name in enumerate(names)],
        F.sha2(joined(F.col("base_spans"), names), 256).alias("base_sha256"),
        joined(F.col("all_spans"), names).alias("spans"),
    )


def redacted(
    docs: DataFrame, models: MarkovPair, text_column: str = "text", mark: str = "[SECRET]"
) -> DataFrame:
    """``docs`` with every span replaced by ``mark`` (touching or overlapping spans by one).

    Only the text column changes; texts without spans stay as they are, NULL included.
    """
    own = docs.select(*[F.col(f"`{c}`").alias(f"in_{c}") for c in docs.columns])
    text = F.col(f"in_{text_column}")
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.lit("").alias("out"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(text, (done["at"] + 1).cast("int"), (span["start"] - done["at"]).cast("int"))
        fresh = (span["start"] > done["at"]) | (done["at"] == 0)
        added = F.when(fresh, F.concat(done["out"], gap, F.lit(mark))).otherwise(done["out"])
        return F.struct(F.greatest(done["at"], span["end"]).alias("at"), added.alias("out"))

    def finish(done: Column) -> Column:
        return F.concat(done["out"], F.substring(text, (done["at"] + 1).cast("int"), F.length(text)))

    cleaned = F.aggregate("all_spans", start, step, finish)
    found = with_spans(own, models, f"in_{text_column}").withColumn(
        "cleaned", F.when(F.size("all_spans") > 0, cleaned).otherwise(text)
    )
    return found.select(
        *[
            (F.col("cleaned") if c == text_column else F.col(f"`in_{c}`")).alias(c)
            for c in docs.columns
        ]
    )
