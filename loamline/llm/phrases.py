"""Collocations by dynamic itemset counting (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.pieces import byte_batches, coded_spans, lowered, text_bytes
from loamline.llm.shared import arrow_map, discard, stored
from loamline.llm.shingles import mixed
from loamline.session import scratch_path

# Bytes that end a piece of text, and bytes between the words of a piece.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
GAPS = b" \t"

BATCH_BYTES = 4 << 20
# Bits of one bitmap of Spark's bitmap aggregates.
BITMAP = 32768

_ODD = np.uint64(0x9E3779B97F4A7C15)
# An odd number, by which the running sum of a text's bytes tells its words apart.
BASE = 0xD1342543DE82EF95
SPANS = 1 << 15
_BREAK = np.zeros(256, dtype=bool)
_BREAK[list(BREAKS)] = True
_APART = _BREAK.copy()
_APART[list(GAPS)] = True


@dataclass(frozen=True)
class Mining:
    """Settings.

    A step scans one of ``shards`` parts of the corpus, in turn. ``slots`` (a power of two) is the size of
    the table, a byte for each slot, that tells tasks which phrases have reached the threshold. It is the
    same for every corpus; phrases that share a slot are activated early, which costs counting and
    changes no result.
    """

    least: int = 30
    longest: int = 4
    shards: int = 3
    covered: int = 80
    first: int = 2000
    slots: int = 1 << 24


def word_runs(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and stops of words, and which ones are followed by a word of the same piece of text."""
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = ~_APART[raw]
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[rows] = True
    starts = np.flatnonzero(inside[1:-1] & (edge[:-1] | ~inside[:-2]))
    stops = np.flatnonzero(inside[1:-1] & (edge[1:] | ~inside[2:])) + 1
    # Breaks and row starts up to each word: as many as up to the word before, and both stand together.
    ended = np.cumsum(_BREAK[raw])
    joined = np.zeros(len(starts), dtype=bool)
    if len(starts):
        row = np.searchsorted(rows, starts, side="right")
        joined[:-1] = (ended[starts[1:]] == ended[starts[:-1]]) & (row[1:] == row[:-1])
    return starts, stops, joined


def keys_at(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, langs: list[bytes]) -> list[bytes]:
    """Language, a tab, and the words from ``starts`` to ``stops`` with one space between."""
    at = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(stops - starts)])
    body = raw[np.repeat(starts - at[:-1], stops - starts) + np.arange(at[-1])]
    # One run of gaps between two words becomes one space.
    gap = (body == 32) | (body == 9)
    keep = np.ones(len(body), dtype=bool)
    keep[1:] = ~(gap[1:] & gap[:-1])
    text = np.where(gap, np.uint8(32), body)[keep].tobytes()
    ends = np.concatenate([np.zeros(1, dtype=np.int64), np.cumsum(keep)])[at].tolist()
    return [b"%b\t%b" % (lang, text[a:b]) for lang, a, b in zip(langs, ends[:-1], ends[1:])]


def runs(raw: np.ndarray, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Texts in runs of about as many bytes: bytes in small letters, bounds of the texts, which ones.

    A long text is cut after the end of a piece, so no phrase is.
    """
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[1:] = _BREAK[raw]
    edge[rows] = True
    edges = np.flatnonzero(edge)
    for at, to in byte_batches(raw, edges, BATCH_BYTES):
        a, b = int(edges[at]), int(edges[to])
        bounds = np.unique(np.concatenate([[a], rows[(rows > a) & (rows < b)], [b]]))
        yield lowered(raw[a:b]), bounds - a, np.searchsorted(rows, bounds[:-1], side="right") - 1


def numbered(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values as numbers: where each occurs first, the number at each place, and how often."""
    which = pd.factorize(values)[0]
    times = np.bincount(which)
    first = np.empty(len(times), dtype=np.int64)
    first[which[::-1]] = np.arange(len(values) - 1, -1, -1)
    return first, which, times


@lru_cache(maxsize=4)
def powers(base: int, count: int) -> np.ndarray:
    """Powers of an odd number, modulo 2 ** 64."""
    return np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(count - 1, base, np.uint64)]), dtype=np.uint64)


def span_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, from a running sum over the bytes of some spans at a time."""
    out = np.empty(len(starts), dtype=np.uint64)
    for at in range(0, len(starts), SPANS):
        begin, end = starts[at : at + SPANS] - starts[at], stops[at : at + SPANS] - starts[at]
        part = raw[starts[at] : stops[min(at + SPANS, len(stops)) - 1]]
        size = 1 << max(len(part), 1).bit_length()
        sums = np.zeros(len(part) + 1, dtype=np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * powers(BASE, size)[: len(part)], out=sums[1:])
        own = (sums[end] - sums[begin]) * powers(pow(BASE, -1, 1 << 64), size)[begin]
        out[at : at + SPANS] = mixed(own + (end - begin).astype(np.uint64) * _ODD)
    return out


def word_hashes(words: list[bytes]) -> np.ndarray:
    stops = np.cumsum([len(w) for w in words], dtype=np.int64)
    starts = np.concatenate([np.zeros(min(1, len(words)), np.int64), stops[:-1]])
    return span_hashes(np.frombuffer(b"".join(words), dtype=np.uint8), starts, stops)


def joined_hashes(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of phrases, or of a language and its words, from those without the last word and of that word."""
    return mixed(before * _ODD + word)


def slots_of(keys: list[str], slots: int) -> np.ndarray:
    """The slot of each phrase, as :func:`counted` finds it."""
    parts = [key.rsplit("\t", 1) for key in keys]
    found = word_hashes([lang.encode() for lang, _ in parts])
    words = [phrase.encode().split(b" ") for _, phrase in parts]
    sizes = np.array([len(w) for w in words], dtype=np.int64)
    for at in range(int(sizes.max(initial=0))):
        some = np.flatnonzero(sizes > at)
        found[some] = joined_hashes(found[some], word_hashes([words[i][at] for i in some.tolist()]))
    return (found & np.uint64(slots - 1)).astype(np.int64)


def counted(
    raw: np.ndarray, rows: np.ndarray, langs: list[bytes], step: int, reached: np.ndarray, mining: Mining
) -> Iterator[tuple[list[bytes], np.ndarray, np.ndarray]]:
    """(keys, activation, counts) of the phrases that this step counts.

    ``reached`` holds, for the slot of a phrase, one more than the first step at whose end a phrase of
    that slot had reached the threshold, and 0 before. A longer phrase is activated once that holds for
    the phrases without its last and without its first word, and counted for as many steps as there are
    shards from then on. Entries never change once set, so every task agrees on the activation.
    """
    starts, stops, joined = word_runs(raw, rows)
    if not len(starts):
        return
    row = np.searchsorted(rows, starts, side="right") - 1
    codes, distinct = coded_spans(raw, starts, stops)
    kinds = {lang: n for n, lang in enumerate(dict.fromkeys(langs))}
    of_row = np.array([kinds[lang] for lang in langs], dtype=np.int64)
    if step < mining.shards:
        first, _, times = numbered(of_row[row])
        yield [langs[row[i]] + b"\t" for i in first.tolist()], np.zeros(len(first), np.int8), times

    further = bool(reached.any())
    own = span_hashes(raw, starts, stops) if further else None
    before = word_hashes(list(kinds))[of_row[row]] if further else None
    word = numbered(of_row[row] * len(distinct) + codes)[1]
    places = np.arange(len(starts))
    number, active = word, np.zeros(len(starts), dtype=np.int8)
    for length in range(1, mining.longest + 1):
        first, which, times = numbered(number)
        at, since = places[first], active[first]
        wanted = np.flatnonzero(since + mining.shards > step)
        if len(wanted):
            here = at[wanted]
            head = [langs[r] for r in row[here].tolist()]
            yield keys_at(raw, starts[here], stops[here + length - 1], head), since[wanted], times[wanted]
        if not further or length == mining.longest:
            return
        hashes = joined_hashes(before[first], own[at + length - 1])
        level = reached[(hashes & np.uint64(mining.slots - 1)).astype(np.int64)][which]
        # A phrase begins here and one begins at the next place, and both reached the threshold.
        follows = np.flatnonzero((level[:-1] > 0) & (level[1:] > 0) & (places[1:] == places[:-1] + 1))
        follows = follows[joined[places[follows] + length - 1]]
        if not len(follows):
            return
        # Phrases that share a slot with others may seem to have reached it before they were active.
        level = np.maximum(level, active)
        active = np.maximum(level[follows], level[follows + 1])
        before = hashes[which[follows]]
        number = which[follows] * np.int64(len(word)) + word[places[follows] + length]
        places = places[follows]


def shards_of(docs: DataFrame, mining: Mining, text_column: str, lang_column: str) -> DataFrame:
    """lang, text and shard of every document that has words, written by shard."""
    spark = docs.sparkSession
    text = F.col(f"`{text_column}`").cast("string")
    lang = F.coalesce(F.col(f"`{lang_column}`").cast("string"), F.lit("und"))
    rows = docs.select(lang.alias("lang"), text.alias("text"), F.monotonically_increasing_id().alias("n"))
    placed = rows.filter("text IS NOT NULL AND text != ''").select(
        "lang", "text", F.pmod(F.xxhash64("text", "n"), F.lit(mining.shards)).cast("int").alias("shard")
    )
    path = scratch_path(spark, "phrase-shards")
    placed.write.partitionBy("shard").parquet(path)
    return spark.read.schema(placed.schema).parquet(path)


def scan(shard: DataFrame, step: int, reached: np.ndarray, mining: Mining) -> DataFrame:
    """(key, since, n): counts of one shard, of a part of a task's texts each."""
    # Only what is set travels: the table is bounded, and mostly empty on small inputs.
    filled = np.flatnonzero(reached)
    known = shard.sparkSession.sparkContext.broadcast((filled.astype(np.int32), reached[filled]))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(mining.slots, dtype=np.int8)
        table[known.value[0]] = known.value[1]
        for part in parts:
            langs = [lang.encode() for lang in part.column(0).to_pylist()]
            for raw, rows, which in runs(*text_bytes(part.column(1))):
                own = [langs[r] for r in which.tolist()]
                for keys, since, times in counted(raw, rows, own, step, table, mining):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(keys, pa.binary()).cast(pa.string()),
                            pa.array(since, pa.int8()),
                            pa.array(times, pa.int64()),
                        ],
                        names=["key", "since", "n"],
                    )

    return arrow_map(shard.select("lang", "text"), batches, "key string, since tinyint, n bigint")


def words_in(key: Column) -> Column:
    """Number of words of a key; a phrase holds no tab."""
    phrase = F.substring_index(key, "\t", -1)
    return F.when(phrase == "", 0).otherwise(F.length(phrase) - F.length(F.replace(phrase, F.lit(" "))) + 1)


def newly_reached(state: DataFrame, mining: Mining) -> np.ndarray:
    """Slots of the phrases that reached the threshold in this step, as bitmaps of fixed size."""
    fresh = (
        state.filter((F.col("n") >= mining.least) & (F.col("before") < mining.least))
        .filter((words_in(F.col("key")) > 0) & (words_in(F.col("key")) < mining.longest))
        .select("key")
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            slots = slots_of(part.column(0).to_pylist(), mining.slots)
            yield pa.RecordBatch.from_arrays([pa.array(slots + 1)], names=["slot"])

    maps = (
        arrow_map(fresh, batches, "slot bigint")
        .groupBy(F.call_function("bitmap_bucket_number", F.col("slot")).alias("at"))
        .agg(
            F.call_function(
                "bitmap_construct_agg", F.call_function("bitmap_bit_position", F.col("slot"))
            ).alias("bits")
        )
    )
    found = np.zeros(mining.slots, dtype=bool)
    for row in maps.collect():
        bits = np.unpackbits(np.frombuffer(row["bits"], dtype=np.uint8), bitorder="little")
        start = (row["at"] - 1) * BITMAP
        held = found[start : start + BITMAP]
        held |= bits[: len(held)].astype(bool)
    return found


def frequencies(docs: DataFrame, mining: Mining, text_column: str, lang_column: str) -> DataFrame:
    """(key, f): all phrases of up to four words, and the empty one for all words, that occur often enough.

    Each step scans one shard and counts in it, whatever their length, all phrases that are active
    and have not been counted in it; counts are added to those of the steps before. A phrase is done after
    one full cycle; then it is kept or dropped. Scans end when the last activated phrase is done.
    """
    spark = docs.sparkSession
    shards = shards_of(docs, mining, text_column, lang_column)
    reached = np.zeros(mining.slots, dtype=np.int8)
    state, done, old = None, [], None
    step, last = 0, mining.shards - 1
    while step <= last:
        fresh = scan(shards.filter(F.col("shard") == step % mining.shards), step, reached, mining)
        rows = fresh.withColumn("before", F.lit(0).cast("bigint"))
        if state is not None:
            rows = rows.unionByName(state.select("key", "since", "n", F.col("n").alias("before")))
        ended = F.col("since") + mining.shards - 1 <= step
        counts = (
            rows.groupBy("key")
            .agg(F.min("since").alias("since"), F.sum("n").alias("n"), F.sum("before").alias("before"))
            .withColumn("done", ended)
            .filter(~F.col("done") | (F.col("n") >= mining.least))
        )
        path = scratch_path(spark, "phrase-counts")
        counts.write.partitionBy("done").parquet(path)
        table = spark.read.schema(counts.schema).parquet(path)
        if old:
            discard(spark, f"{old}/done=false")
        old = path
        found = newly_reached(table, mining)
        if (found & (reached == 0)).any():
            reached[found & (reached == 0)] = step + 1
            last = step + mining.shards
        done.append(table.filter("done").select("key", F.col("n").alias("f")))
        state = table.filter("NOT done").select("key", "since", "n")
        step += 1
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return stored(whole, spark, "phrase-frequencies")


def contained(key: Column, words: Column) -> Column:
    """Keys of the shorter phrases of two words or more that lie inside a phrase."""
    parts, head = F.split(F.substring_index(key, "\t", -1), " "), F.substring_index(key, "\t", -1)
    lang = F.substring(key, F.lit(1), F.length(key) - F.length(head))
    spans = F.flatten(
        F.transform(
            F.sequence(F.lit(2), words - 1),
            lambda size: F.transform(
                F.sequence(F.lit(1), words - size + 1),
                lambda at: F.concat(lang, F.array_join(F.slice(parts, at, size), " ")),
            ),
        )
    )
    return F.when(words > 2, spans)


def scored(known: DataFrame, mining: Mining) -> DataFrame:
    """Candidates with the counts of both parts of their lowest-scoring cut."""
    exact = "decimal(38,0)"
    phrase = F.substring_index("key", "\t", -1)
    candidates = known.withColumn("words", words_in(F.col("key"))).filter("words > 1").withColumnRenamed("f", "a")
    parts = F.split(phrase, " ")
    lang = F.substring(F.col("key"), F.lit(1), F.length("key") - F.length(phrase))
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1))).withColumns(
        {
            "left": F.concat(lang, F.array_join(F.slice(parts, F.lit(1), F.col("k")), " ")),
            "right": F.concat(lang, F.array_join(F.slice(parts, F.col("k") + 1, F.col("words")), " ")),
        }
    )
    counts = known.select(F.col("key").alias("part"), "f")
    cuts = cuts.join(counts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left")
    cuts = cuts.join(counts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    share = F.expr(f"CAST(2000000 AS {exact}) * CAST(a AS DECIMAL(19,0))")
    score = cuts.withColumn("_top", share.cast(exact)).withColumn(
        "score", F.expr(f"_top div (CAST(l AS {exact}) + CAST(r AS {exact}))")
    )
    return score.groupBy("key", "a", "words").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("cut")
    ).select("key", "a", "words", "cut.l", "cut.r", "cut.score")


def first_phrases(known: DataFrame, mining: Mining) -> DataFrame:
    """The report of each language from all frequencies."""
    spark = known.sparkSession
    candidates = scored(known, mining)
    longer = (
        known.withColumn("words", words_in(F.col("key")))
        .filter("words > 2")
        .select(F.explode(contained(F.col("key"), F.col("words"))).alias("inner"), "f")
        .groupBy("inner")
        .agg(F.max("f").alias("cover"))
    )
    whole = "decimal(38,0)"
    covered = F.col("cover").cast(whole) * 100 >= F.col("a").cast(whole) * mining.covered
    phrase = F.substring_index("key", "\t", -1)
    open_ = (
        candidates.join(longer, F.col("key") == F.col("inner"), "left")
        .filter(F.col("cover").isNull() | ~covered)
        .select(
            F.substring(F.col("key"), F.lit(1), F.length("key") - F.length(phrase) - 1).alias("lang"),
            phrase.alias("phrase"),
            "a",
            "l",
            "r",
            "score",
        )
    )
    # First within parts of a language, then among what these leave, so that no task sorts a language.
    order = [F.desc("score"), F.desc("a"), "phrase"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = open_.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(parts)))
    some = placed.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    some = some.filter(F.col("rank") <= mining.first)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    words = known.filter(F.col("key").endswith("\t")).select(
        F.expr("substring(key, 1, length(key) - 1)").alias("lang"), F.col("f").alias("n")
    )
    return (
        best.filter(F.col("rank") <= mining.first)
        .join(words, "lang")
        .select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")
    )


def collocations(
    docs: DataFrame, mining: Mining = Mining(), text_column: str = "text", lang_column: str = "lang"
) -> DataFrame:
    """Each language's best phrases: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A to Z), split into pieces at ``. , ; : ! ?`` and at line ends, and pieces into
    words at spaces and tabs. NULL languages count as ``und``, NULL texts as empty. Phrases are runs of
    words within a piece; candidates have two to four words and occur 30 times or more in the language.
    ``a`` is a candidate's frequency, ``l`` and ``r`` those of its parts at the cut with the lowest score
    floor(2000000 * a / (l + r)), the first such cut, ``n`` all words of the language. Candidates inside a
    longer candidate of at least 80 % of their frequency go. The 2,000 best by score, frequency, phrase
    (by bytes) stay. Equal rows each count; other columns are ignored; an empty table gives an empty one.

    Words are strings of any length: a key is language, tab, words. A language may contain a tab.
    """
    known = frequencies(docs, mining, text_column, lang_column)
    return first_phrases(known, mining)
