"""Substring deduplication by hashed lines and sentences (operator 2)."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import arrow_map, stored

SENTENCE_END = re.compile(r"(?<=[.!?])(?=[ \t])")
CLAUSE_END = re.compile(r"(?<=[,;:])(?=[ \t])")
PARAGRAPH_END = re.compile(r"(?<=\n)(?=\n*[^\n])(?<=\n\n)")
LINE_END = re.compile(r"(?<=\n)")

# A digest is hot when it makes up more than this part of all units: fewer than as many can be.
HOT_PART = 1000

UNIT_SCHEMA = (
    "hash bigint, pos int, begin bigint, end bigint, lead bigint, high bigint, low bigint"
)


# Whole lines that are judged besides their parts are numbered from here on, all others from 0.
WHOLES = -(1 << 30)


@dataclass(frozen=True)
class Units:
    """How texts are cut. ``kind`` is line, paragraph or sentence. Sentences end with their line at the
    latest; those of more than ``long_sentence`` words are cut into clauses, so that a passage that
    starts within one is found. Sentences and clauses of fewer than ``least_words`` words and
    ``least_chars`` characters are not judged by themselves; the whole line that holds one is then
    judged too. Lines and paragraphs are judged whatever their length.
    """

    kind: str = "sentence"
    least_words: int = 5
    long_sentence: int = 24
    least_chars: int = 20

    def parts(self, whole: str) -> Iterator[str]:
        """Sentences of a line, long ones in clauses; with the other kinds the whole itself."""
        if self.kind != "sentence":
            yield whole
            return
        for sentence in SENTENCE_END.split(whole):
            if sentence.count(" ") > self.long_sentence:
                yield from CLAUSE_END.split(sentence)
            else:
                yield sentence

    def found(self, text: str) -> Iterator[tuple[int, int, int, int, int, int]]:
        """Judged units: number, begin, end, digest of the shorter units right before, digest (two halves).

        Normalised are case and white space; ends leave out the line break.
        """
        at, pos, extra, lead = 0, 0, WHOLES, xxhash.xxh64()
        for whole in (PARAGRAPH_END if self.kind == "paragraph" else LINE_END).split(text):
            start, short = at, False
            for piece in self.parts(whole):
                words = piece.lower().split()
                normal = " ".join(words)
                if len(words) >= self.least_words or len(normal) >= self.least_chars:
                    yield pos, *bounds(piece, at), lead.intdigest(), *halves(normal)
                    pos, lead = pos + 1, xxhash.xxh64()
                elif words:
                    short = True
                    lead.update(normal + " ")
                at += len(piece)
            if short:
                yield extra, *bounds(whole, start), 0, *halves(" ".join(whole.lower().split()))
                extra += 1


def bounds(piece: str, at: int) -> tuple[int, int]:
    return at + len(piece) - len(piece.lstrip()), at + len(piece.rstrip())


def halves(normal: str) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(normal)
    return digest >> 64, digest & (1 << 64) - 1


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def units_of(docs: DataFrame, units: Units, id_column: str, text_column: str) -> DataFrame:
    """One row per judged unit with its place and digest; equal rows of ``docs`` count as one."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            owners, rows = [], []
            for i, (key, text) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                for pos, begin, end, lead, high, low in units.found(text):
                    owners.append(i)
                    rows.append((key, pos, begin, end, signed(lead), signed(high), signed(low)))
            columns = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
            ids = part.column(0).take(pa.array(owners, pa.int64()))
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [ids, *arrays], names=["id", "hash", "pos", "begin", "end", "lead", "high", "low"]
            )

    kind = docs.schema[id_column].dataType.simpleString()
    return arrow_map(keyed(docs, id_column, text_column), batches, f"id {kind}, {UNIT_SCHEMA}")


def keyed(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    return docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))


def repeats(found: DataFrame) -> DataFrame:
    """Every unit that is not the first with its digest, with the place of that first one.

    Ranks go by id (NULL last), then by a hash of the text, then by position. Digests are counted
    with partial sums. The few that are hot are handed to all tasks; the join of the others then
    has no key with more than a thousandth of the rows.
    """
    spark = found.sparkSession
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "begin", "pos", "lead")
    firsts = stored(
        found.groupBy("high", "low")
        .agg(F.min(place).alias("first"), F.count("*").alias("n"))
        .filter("n > 1"),
        spark,
        "unit-firsts",
    )
    total = found.count()
    hot = firsts.filter(F.col("n") * HOT_PART > total)
    cold = firsts.filter(F.col("n") * HOT_PART <= total)
    digest = ["high", "low"]
    common = found.join(F.broadcast(hot), digest)
    others = found.join(F.broadcast(hot.select(*digest)), digest, "left_anti").join(cold, digest)
    return common.unionByName(others).filter(
        ~(
            F.col("id").eqNullSafe(F.col("first.id"))
            & (F.col("hash") == F.col("first.hash"))
            & (F.col("pos") == F.col("first.pos"))
        )
    )


def removed_spans(found: DataFrame) -> DataFrame:
    """Per text (id, hash) the spans to remove, in order: begin, end, id of the first occurrence.

    Where two neighbouring units repeat two neighbouring ones of one text, with the same shorter
    units between, the span runs over those too. Spans do not overlap: what a whole line covers is
    left out of the others.
    """
    rows = repeats(found).select(
        "id", "hash", F.struct("pos", "begin", "end", "lead", "first").alias("unit")
    )
    lists = rows.groupBy("id", "hash").agg(F.sort_array(F.collect_set("unit")).alias("units"))

    def span(unit: Column, at: Column) -> Column:
        before = F.get("units", at - 1)
        run = (
            (at > 0)
            & (unit["pos"] > 0)
            & (before["pos"] == unit["pos"] - 1)
            & before["first"]["id"].eqNullSafe(unit["first"]["id"])
            & (before["first"]["hash"] == unit["first"]["hash"])
            & (before["first"]["pos"] == unit["first"]["pos"] - 1)
            & (unit["lead"] == unit["first"]["lead"])
        )
        return F.struct(
            F.when(run, before["end"]).otherwise(unit["begin"]).alias("begin"),
            unit["end"].alias("end"),
            unit["first"]["id"].alias("first_id"),
        )

    spans = F.transform("units", span)
    # By begin; of spans with the same begin the longest first.
    by_begin = F.array_sort(
        spans,
        lambda a, b: F.when(a["begin"] != b["begin"], F.signum(a["begin"] - b["begin"]))
        .otherwise(F.signum(b["end"] - a["end"]))
        .cast("int"),
    )
    none = F.struct(F.lit(0).cast("bigint").alias("at"), F.filter(spans, lambda s: F.lit(False)).alias("out"))

    def beyond(done: Column, s: Column) -> Column:
        rest = F.struct(
            F.greatest(s["begin"], done["at"]).alias("begin"), s["end"].alias("end"), s["first_id"].alias("first_id")
        )
        return F.struct(
            F.greatest(s["end"], done["at"]).alias("at"),
            F.when(s["end"] > done["at"], F.concat(done["out"], F.array(rest))).otherwise(done["out"]).alias("out"),
        )

    apart = F.aggregate(by_begin, none, beyond, lambda done: done["out"])
    # Only whole lines overlap other units, and they come first by their numbers.
    removed = F.when(F.get("units", F.lit(0))["pos"] < 0, apart).otherwise(spans)
    return lists.select("id", "hash", removed.alias("removed"))


def without_repeats(
    docs: DataFrame,
    units: Units = Units(),
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: id, text without repeated units, n_removed, removed.

    ``removed`` holds the spans in code points of the text as it was, with the id under which the
    unit stays; n_removed counts them. Of equal units everywhere the one in the document with the
    least id stays, within it the first. White space around a removed unit stays. NULL texts stay
    NULL and empty ones empty; NULL ids rank last; equal rows are edited alike, as one document;
    other columns are ignored; an empty table gives an empty table.
    """
    spark = docs.sparkSession
    found = stored(units_of(docs, units, id_column, text_column), spark, "units")
    spans = removed_spans(found)
    own = docs.select(
        F.col(id_column).alias("own_id"),
        F.col(text_column).cast("string").alias("text"),
        F.xxhash64(F.coalesce(F.col(text_column).cast("string"), F.lit(""))).alias("own_hash"),
    )
    both = own.join(
        spans,
        F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash")),
        "left",
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("kept"))

    def step(done: Column, span: Column) -> Column:
        gap = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (span["begin"] - done["at"]).cast("int"))
        return F.struct(span["end"].alias("at"), F.concat(done["kept"], F.array(gap)).alias("kept"))

    def finish(done: Column) -> Column:
        rest = F.substring(F.col("text"), (done["at"] + 1).cast("int"), F.length("text"))
        return F.concat(F.array_join(done["kept"], ""), rest)

    edited = F.aggregate("removed", start, step, finish)
    none = F.array().cast(spans.schema["removed"].dataType)
    return both.select(
        F.col("own_id").alias(id_column),
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(edited).alias(text_column),
        F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"),
        F.coalesce("removed", none).alias("removed"),
    )
