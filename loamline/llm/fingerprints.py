"""Document fingerprints by consistent weighted sampling (operator 9).

Everything is a column expression or an aggregation; no Python runs on the executors.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.shared import HOT_PART, stored

SAMPLES = 64
SEED = 29
# Draws are taken from tables of equally likely values, as logarithms would cost most of the time.
GRID = 256
# Copies of a row for which one row stands at most.
COPIES = 100_000
SPACES = r"[\x20\x09-\x0D]+"


def gamma_quantile(share: float) -> float:
    """Where the distribution function of Gamma(2, 1) has the value ``share``, by bisection."""
    low, high = 0.0, 1.0
    while 1 - math.exp(-high) * (1 + high) < share:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        if 1 - math.exp(-middle) * (1 + middle) < share:
            low = middle
        else:
            high = middle
    return high


def gamma_tables() -> tuple[list[float], list[float]]:
    """Values of r, and of ln(c): its first GRID ones divide the lowest part of the others' range.

    The least key of a text mostly comes from a small c, so that part is drawn more finely.
    """
    middles = [(i + 0.5) / GRID for i in range(GRID)]
    coarse = [gamma_quantile(m) for m in middles]
    fine = [gamma_quantile(m / GRID) for m in middles]
    return coarse, [math.log(v) for v in [*fine, *coarse]]


def constant_array(values: list[float]) -> Column:
    """An array constant, written as one text so that the plan has one literal instead of thousands."""
    return F.split(F.lit(",".join(format(v, ".6g") for v in values)), ",").cast("array<double>")


def samples(
    term: Column, weight: Column, r_values: Column, log_c_values: Column, count: int, seed: int
) -> list[Column]:
    """For each of ``count`` samples the term's key; the least key of a text is its sample.

    With r and c from Gamma(2, 1), b from (0, 1) and t = floor(ln(weight) / r + b), the key is
    ln(c) - r * (t - b + 1). A key depends on term, t and number of the sample alone, so two texts
    share a sample exactly when term and t agree, which happens with the probability of their
    generalised Jaccard similarity. All draws come from one hash of the term: eight bits for r, sixteen
    for c, the others for b, which also makes the keys of different terms differ. ``r_values`` and
    ``log_c_values`` hold the tables to draw from (:func:`gamma_tables`).
    """
    log_weight = F.log(weight.cast("double"))

    def bits(hash_: Column, at: int, size: int) -> Column:
        return F.shiftrightunsigned(hash_, at).bitwiseAND(F.lit((1 << size) - 1)).cast("int")

    keys = []
    for k in range(count):
        drawn = F.xxhash64(term, F.lit(seed * 1_000 + k))
        r = F.get(r_values, bits(drawn, 56, 8))
        coarse = bits(drawn, 48, 8)
        log_c = F.get(log_c_values, F.when(coarse == 0, bits(drawn, 40, 8)).otherwise(coarse + GRID))
        b = drawn.bitwiseAND(F.lit((1 << 40) - 1)).cast("double") / float(1 << 40)
        t = F.floor(log_weight / r + b)
        keys.append(log_c - r * (t - b + 1))
    return keys


def signatures(
    terms: DataFrame, keys: list[str], term: str, weight: str, count: int = SAMPLES, seed: int = SEED
) -> DataFrame:
    """Group weighted terms (one row per key and term) into ``signature``: an array of whole numbers.

    Each stands for a least key, by 31 bits of its hash. The minima combine on the map side, and no
    text's terms need to be in one place.
    """
    # As columns that depend on the weight the tables stand in the plan once. As constants they would
    # stand there several times for each sample, and the driver keeps and logs plans as texts.
    known = F.col(weight) > 0
    tables = [F.when(known, constant_array(t)).alias(f"__t{i}") for i, t in enumerate(gamma_tables())]
    drawn = samples(F.col(term), F.col(weight), F.col("__t0"), F.col("__t1"), count, seed)
    least = [F.min(s).alias(f"__s{k}") for k, s in enumerate(drawn)]
    return terms.select(*keys, term, weight, *tables).groupBy(*keys).agg(*least).select(
        *keys,
        F.array(
            *[
                F.xxhash64(f"__s{k}").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")
                for k in range(count)
            ]
        ).alias("signature"),
    )


def likeness(one: Column, other: Column) -> Column:
    """Share of samples that agree; two texts without terms are alike (1), with one text 0."""
    agreed = F.aggregate(
        F.zip_with(one, other, lambda a, b: (a == b).cast("int")), F.lit(0), lambda n, x: n + x
    )
    return (
        F.when(one.isNull() & other.isNull(), 1.0)
        .when(one.isNull() | other.isNull(), 0.0)
        .otherwise(agreed / F.size(one))
    )


def as_text(signature: Column) -> Column:
    """A fingerprint as text: eight hexadecimal digits for each sample; empty without terms."""
    digits = F.transform(signature, lambda s: F.lpad(F.hex(s), 8, "0"))
    return F.coalesce(F.array_join(digits, ""), F.lit(""))


def own_texts(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """text and ``place``, which orders rows: is the id known, then the id itself, then a hash of the text."""
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    own = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    place = F.struct(F.col("id").isNotNull().alias("known"), "id", F.xxhash64("text").alias("hash"))
    return own.select("text", place.alias("place"))


def range_marks(places: DataFrame, ranges: int) -> Column:
    """The least places of about as many ranges that hold about as many rows each, as a constant.

    Only places are put in order, in as many tasks as there are ranges; one place of each comes to the driver.
    """
    firsts = (
        places.select("place")
        .repartitionByRange(ranges, "place")
        .groupBy(F.spark_partition_id().alias("range"))
        .agg(F.min("place").alias("place"))
        .agg(F.to_json(F.sort_array(F.collect_list("place"))))
    )
    kind = f"array<{places.schema['place'].dataType.simpleString()}>"
    return F.from_json(F.lit(firsts.first()[0] or "[]"), kind)


def range_of(marks: Column, place: Column, ranges: int) -> Column:
    """How many marks are at or below the place, by halving."""
    steps = [1 << k for k in reversed(range(max(ranges, 1).bit_length()))]

    def step(at: Column, size: Column) -> Column:
        return F.when(F.get(marks, at + size - 1) <= place, at + size).otherwise(at)

    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), step)
    # Never NULL, so that joins on it filter nothing and all uses of the texts stay alike.
    return F.coalesce(found, F.lit(0))


def in_ranges(
    docs: DataFrame, id_column: str, text_column: str, ranges: int
) -> tuple[DataFrame, DataFrame]:
    """Rows numbered in descending order of ids inside ranges: range, at, place, text, times, following.

    Order is by the id, whatever its type, then by a hash of the text, NULL ids last. A range holds about
    as many rows as any other; rows of one id are dealt to several by their texts' hashes. Rows that
    are equal and hold more than a thousandth of all rows are brought down to a few, which say in
    ``times`` for how many they stand: all but the last copy are followed by another one, so the last
    one has a row of its own. ``following`` is the next text inside the range.

    The second table says for each range (``own``) which one comes ``before`` it, for the first the last.
    """
    own = own_texts(docs, id_column, text_column)
    places = stored(own.select("place"), docs.sparkSession, "places")
    counts = places.groupBy("place").agg(F.count("*").alias("copies")).filter("copies > 1")
    marks = range_marks(places, ranges)
    many = F.broadcast(counts.filter(F.col("copies") * HOT_PART > places.count()))
    one = F.lit(1).cast("bigint")
    alone = own.join(many, "place", "left_anti").select("place", "text", one.alias("times"))
    before_last = F.col("copies") - 1
    parts = F.sequence(F.lit(0), F.ceil(before_last / COPIES).cast("int") - 1)
    times = F.concat(
        F.transform(parts, lambda k: F.least(F.lit(COPIES), before_last - k * COPIES).cast("bigint")), F.array(one)
    )
    whole = (
        own.join(many, "place")
        .groupBy("place", "copies")
        .agg(F.min("text").alias("text"))
        .select("place", "text", F.explode(times).alias("times"))
    )
    number = range_of(marks, F.col("place"), ranges)
    rows = alone.unionByName(whole).withColumn("range", number)
    # More partitions than usual: each text becomes many terms there.
    wide = 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    window = Window.partitionBy("range").orderBy(F.col("place").desc(), "text", F.col("times").desc())
    placed = rows.repartition(wide, "range").withColumns(
        {"at": F.row_number().over(window), "following": F.lead("text").over(window)}
    )
    # Only numbers of ranges come together to be put in order.
    ring = Window.orderBy(F.col("own").desc())
    all_of_it = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("own").over(ring), F.last("own").over(all_of_it))
    order = places.select(number.alias("own")).distinct().withColumn("before", before)
    return placed, stored(order, docs.sparkSession, "ranges")


def ring_heads(placed: DataFrame, order: DataFrame, column: str) -> DataFrame:
    """For each range, ``head``: the column of the first row of the next range in descending order.

    The last range is followed by the first. What a range hands on goes to the task of the range that
    takes it.
    """
    # ``times`` decides nothing here; it keeps the columns of every use of the texts alike, so that they
    # are shuffled once.
    firsts = placed.filter((F.col("at") == 1) & (F.col("times") > 0))
    return firsts.join(order, F.col("range") == F.col("own")).select(
        F.col("before").alias("range"), F.col(column).alias("head")
    )


def fingerprints(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    count: int = SAMPLES,
    ranges: int | None = None,
) -> DataFrame:
    """One row per row of ``docs``: fingerprints of the text and of its edited text, and likenesses.

    Columns: id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.
    Terms are words between ASCII white space, weighted by how often they occur. In the edited text
    the last half of the code points (rounded down) gives way to the start of the next document's
    text, as many of its code points or all; order is by descending id (of any type that has an order),
    equal ids by a hash of the text, rows without an id last. NULL texts are empty; a text without words has an empty
    fingerprint, like only to another such. Equal rows each come out; equal texts have equal fingerprints. A single row follows itself.
    An empty table gives an empty table; other columns are ignored.
    """
    if ranges is None:
        ranges = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed, order = in_ranges(docs, id_column, text_column, ranges)
    linked = placed.join(ring_heads(placed, order, "text"), "range")
    half = F.floor(F.length("text") / 2).cast("int")
    start = F.substring(F.coalesce("following", "head"), F.lit(1), half)
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - half), start)
    rows = linked.withColumn("edited", edited)
    sides = F.array(*[F.struct(F.lit(i).alias("side"), F.col(c).alias("text")) for i, c in enumerate(("text", "edited"))])
    words = rows.select("range", "at", F.explode(sides).alias("part")).select(
        "range", "at", "part.side", F.explode(F.split("part.text", SPACES)).alias("word")
    )
    key = ["range", "at", "side"]
    weighted = (
        words.filter(F.col("word") != "")
        .groupBy(*key, F.xxhash64("word").alias("term"))
        .agg(F.count("*").alias("weight"))
    )
    signed = signatures(weighted, key, "term", "weight", count)
    pairs = signed.groupBy("range", "at").agg(
        *[
            F.first(F.when(F.col("side") == side, F.col("signature")), ignorenulls=True).alias(name)
            for side, name in enumerate(("own", "changed"))
        ]
    )
    facts = rows.select(
        "range",
        "at",
        F.col("place.id").alias("id"),
        "times",
        F.length("text").cast("bigint").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
    )
    described = stored(
        facts.join(pairs, ["range", "at"], "left").withColumnRenamed("own", "own_print"), docs.sparkSession, "fingerprints"
    )
    # The next document's fingerprint is its own row's; across ranges it is handed on as the text was.
    beside = described.withColumn(
        "inside", F.lead(F.struct("own_print")).over(Window.partitionBy("range").orderBy("at"))
    )
    heads = ring_heads(described, order, "own_print")
    following = F.when(F.col("inside").isNotNull(), F.col("inside.own_print")).otherwise(F.col("head"))
    each = beside.join(heads, "range").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "times")))
    return each.select(
        F.col("id").alias(id_column),
        "n_chars",
        "edited_sha256",
        as_text(F.col("own_print")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own_print"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own_print"), following).alias("near_next"),
    )
