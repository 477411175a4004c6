"""SimHash fingerprints, linked where balls of half the radius meet (operator 12)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.components import components
from loamline.llm.pieces import by_bytes, lowered, text_bytes, word_spans
from loamline.llm.shared import arrow_map, join_facts, stored

BITS = 64
HALF = BITS // 2
BATCH_BYTES = 4 << 20
# Shingles hashed in one go.
RUN = 1 << 16
# Variants written out at once, about.
VARIANTS = 1 << 20

@dataclass(frozen=True)
class Balls:
    """Settings. Fingerprints link at three or fewer differing bits.

    Variants are dealt to buckets by their first ``step`` bits of the order below, and a bucket that
    more than ``limit`` fingerprints reach is dealt again by the next ``step``, down to whole variants.
    """

    words: int = 3
    seed: int = 42
    step: int = 8
    limit: int = 50_000

    @property
    def order(self) -> list[list[int]]:
        """Bits by level, half of each level's from either half of the fingerprint."""
        turns = [bit for pair in zip(range(HALF), range(HALF, BITS)) for bit in pair]
        return [turns[at : at + self.step] for at in range(0, BITS, self.step)]


def pairs_of(bits: list[int]) -> list[tuple[int, int]]:
    """Pairs of bits that lie in one half: of any three bits two do."""
    return [(a, b) for a, b in combinations(bits, 2) if (a < HALF) == (b < HALF)]


def flips_of(bits: list[int]) -> np.ndarray:
    """All flips of none, one, or two of the bits, those of two within one half."""
    ones = [1 << b for b in bits]
    twos = [1 << a | 1 << b for a, b in pairs_of(bits)]
    return np.array([0, *ones, *twos], dtype=np.uint64)


def allowed(prints: np.ndarray, flips: np.ndarray) -> np.ndarray:
    """May a fingerprint emit the variant with these bits flipped?

    Half the radius of three is one and a half: every fingerprint emits itself and the variants at one
    bit, and those of odd parity the variants at two bits of one half besides. That is enough: at two
    bits or fewer the balls of one bit meet; at three bits parities differ, two of the three bits lie in
    one half, and the odd fingerprint with these two flipped is one bit from the even one.
    """
    count = np.bitwise_count(flips)
    odd = (np.bitwise_count(prints) & 1).astype(bool)
    low = np.bitwise_count(flips & np.uint64((1 << HALF) - 1))
    return (count <= 1) | ((count == 2) & odd & (low != 1))


def spaced(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words with one space after each, and where each one starts and stops there."""
    text = np.append(raw, np.uint8(32))
    text[stops] = 32
    change = np.zeros(len(text) + 1, dtype=np.int8)
    change[starts] += 1
    change[stops + 1] -= 1
    held = np.cumsum(change[:-1], dtype=np.int8).astype(bool)
    lengths = stops - starts + 1
    ends = np.cumsum(lengths)
    return text[held].tobytes(), ends - lengths, ends - 1


def fingerprint(data: bytes, starts: np.ndarray, stops: np.ndarray, words: int, seed: int) -> int:
    """SimHash of one text, whose words lie in ``data`` with one space between them."""
    n = len(starts)
    if not n:
        return 0
    size = min(words, n)
    firsts, lasts = starts[: n - size + 1], stops[size - 1 :]
    votes = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(firsts), RUN):
        part = zip(firsts[at : at + RUN].tolist(), lasts[at : at + RUN].tolist())
        hashes = np.array([digest(data[a:b], seed) for a, b in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << b for b in np.flatnonzero(2 * votes > len(firsts)).tolist())


def fingerprints(docs: DataFrame, balls: Balls, id_column: str, text_column: str) -> DataFrame:
    """id and fingerprint (as a signed number) of every row."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in by_bytes(whole, 1, BATCH_BYTES):
                raw, rows = text_bytes(part.column(1))
                raw = lowered(raw)
                starts, stops = word_spans(raw, rows)
                bounds = np.searchsorted(starts, rows).tolist()
                found = []
                for a, b in zip(bounds[:-1], bounds[1:]):
                    if a == b:
                        found.append(0)
                        continue
                    first = int(starts[a])
                    data, begin, end = spaced(raw[first : int(stops[b - 1])], starts[a:b] - first, stops[a:b] - first)
                    found.append(fingerprint(data, begin, end, balls.words, balls.seed))
                prints = np.array(found, dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(prints)], names=["id", "print"])

    kind = docs.schema[id_column].dataType.simpleString()
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    chosen = docs.select(F.col(f"`{id_column}`").alias("id"), text.alias("text"))
    return arrow_map(chosen, batches, f"id {kind}, print bigint")


def reach(prints: DataFrame, balls: Balls, level: int) -> DataFrame:
    """(print, bucket, flips): the buckets of the next level that variants of a fingerprint reach.

    ``flips`` are the flipped bits so far, ``bucket`` the variant's bits so far, the others zero.
    """
    bits = balls.order[level]
    mask = np.uint64(sum(1 << b for b in bits))
    steps = flips_of(bits)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, whole.num_rows, 4096):
                part = whole.slice(at, 4096)
                own, bucket, flips = [
                    part.column(c).to_numpy().view(np.uint64)[:, None] for c in ("print", "bucket", "flips")
                ]
                after = flips | steps[None, :]
                row, step = np.nonzero(allowed(own, after))
                bucket = bucket | (own & mask) ^ steps[None, :]
                columns = [own[row, 0], bucket[row, step], after[row, step]]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c.view(np.int64)) for c in columns], names=["print", "bucket", "flips"]
                )

    return arrow_map(prints, batches, "print bigint, bucket bigint, flips bigint")


def variants_in(own: np.ndarray, flips: np.ndarray, rest: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprints, variants) of one bucket: its bits are settled, the others are flipped here."""
    steps = flips_of(rest)
    prints, variants = [], []
    odd, low = np.bitwise_count(own) & 1, np.bitwise_count(flips & np.uint64((1 << HALF) - 1))
    # Which steps are allowed depends on parity and on how many bits of either half are flipped.
    kinds = odd * 9 + low * 3 + np.bitwise_count(flips) - low
    for kind in np.unique(kinds):
        some = kinds == kind
        mine, flipped = own[some], flips[some]
        may = steps[allowed(np.repeat(mine[:1], len(steps)), flipped[0] | steps)]
        prints.append(np.repeat(mine, len(may)))
        variants.append(((mine ^ flipped)[:, None] ^ may[None, :]).ravel())
    return np.concatenate(prints), np.concatenate(variants)


def met(own: np.ndarray, flips: np.ndarray, rest: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Links (fingerprint, partner) of the fingerprints that emit the same variant in one bucket.

    Of those that emit a variant, all link with one that is at one bit or less from it: at two bits they
    have one parity, so the distance is 1, 2 or 3, and partners at two bits each link elsewhere if at
    all, where their balls of one bit meet. A variant therefore gives one link a fingerprint, not all
    pairs. Each one is verified.
    """
    prints, variants = variants_in(own, flips, rest)
    order = np.argsort(variants)
    prints, variants = prints[order], variants[order]
    same = np.zeros(len(variants) + 1, dtype=bool)
    same[1:-1] = variants[1:] == variants[:-1]
    shared = same[:-1] | same[1:]
    prints, variants = prints[shared], variants[shared]
    order = np.lexsort((prints, np.bitwise_count(prints ^ variants), variants))
    prints, variants = prints[order], variants[order]
    fresh = np.ones(len(variants), dtype=bool)
    fresh[1:] = variants[1:] != variants[:-1]
    centre = prints[np.flatnonzero(fresh)][np.cumsum(fresh) - 1]
    linked = (prints != centre) & (np.bitwise_count(prints ^ centre) <= 3)
    return prints[linked], centre[linked]


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As few links as keep the same fingerprints connected: each with the least of its group."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    one, two = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[one], root[two])
        after = root.copy()
        np.minimum.at(after, root[one], low)
        np.minimum.at(after, root[two], low)
        after = after[after]
        if (after == root).all():
            break
        root = after
    far = root != np.arange(len(nodes))
    return nodes[far], nodes[root[far]]


def links(prints: DataFrame, balls: Balls = Balls()) -> DataFrame:
    """(a, b): links that connect what fingerprints at three or fewer differing bits connect.

    ``prints`` has one row for each different fingerprint. Instead of every variant, a fingerprint
    travels once to each bucket that one of its variants falls in; there the bucket's variants are
    written out, and equal ones meet. Crowded buckets are cut further; at the last level a bucket is
    one variant, which at most 1 + 64 + 992 different fingerprints can emit.
    """
    spark = prints.sparkSession
    zero = F.lit(0).cast("bigint")
    members = prints.select("print", zero.alias("bucket"), zero.alias("flips"))
    tables = []
    for level in range(len(balls.order)):
        members = stored(reach(members, balls, level), spark, "ball-members")
        sizes = stored(
            members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1"), spark, "ball-sizes"
        )
        last = level == len(balls.order) - 1
        crowded = sizes.filter("false" if last else F.col("n") > balls.limit).select("bucket")
        small = sizes.filter("true" if last else F.col("n") <= balls.limit).select("bucket")
        rest = [b for later in balls.order[level + 1 :] for b in later]
        tables.append(_linked(members.join(small, "bucket"), rest))
        if crowded.isEmpty():
            break
        members = members.join(crowded, "bucket")
    found = tables[0]
    for more in tables[1:]:
        found = found.unionByName(more)
    return found


def apart(
    own: np.ndarray, flips: np.ndarray, rest: list[int]
) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """A bucket cut by as many of its open bits as keep the variants written out at once few.

    Yields which fingerprints reach a part, their flips with those of the settled bits, and the open bits.
    """
    most = len(own) * (1 + len(rest) + len(rest) ** 2 // 4)
    near = rest[: max(0, (most // VARIANTS).bit_length())]
    inside, far = np.uint64(sum(1 << b for b in near)), rest[len(near) :]
    bits = (own ^ flips) & inside
    for value in np.unique(np.concatenate([bits ^ step for step in flips_of(near)])):
        settled = flips | (bits ^ value)
        may = np.flatnonzero(allowed(own, settled))
        if len(may):
            yield may, settled[may], far


def _linked(members: DataFrame, rest: list[int]) -> DataFrame:
    """Links inside the buckets, which come whole and one after the other."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def whole() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            bucket, prints, flips = None, [], []
            for part in parts:
                if not part.num_rows:
                    continue
                keys = part.column("bucket").to_numpy()
                cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
                own, flipped = [part.column(c).to_numpy().view(np.uint64) for c in ("print", "flips")]
                for a, b in zip(cuts[:-1], cuts[1:]):
                    if prints and keys[a] != bucket:
                        yield np.concatenate(prints), np.concatenate(flips)
                        prints, flips = [], []
                    bucket = keys[a]
                    prints.append(own[a:b])
                    flips.append(flipped[a:b])
            if prints:
                yield np.concatenate(prints), np.concatenate(flips)

        for own, flips in whole():
            ones, others = [], []
            for some, settled, far in apart(own, flips, rest):
                a, b = met(own[some], settled, far)
                ones.append(a)
                others.append(b)
            a, b = forest(np.concatenate(ones), np.concatenate(others))
            yield pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

    wide = 4 * int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = members.repartition(wide, "bucket").sortWithinPartitions("bucket")
    return arrow_map(placed, batches, "a bigint, b bigint")




def near_prints(
    docs: DataFrame, balls: Balls = Balls(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased (A to Z) and cut into words between ASCII white space. A fingerprint bit is
    set when more than half of the hashes (XXH64, seed 42) of the text's three-word shingles, repeats
    included, have it. A text of one or two words has one shingle; without words, NULL among them, the
    fingerprint is zero, which links like any other. Fingerprints at three or fewer differing bits link,
    and ``component_id`` is the least id of all rows that links connect, NULL where none has an id. Rows
    with equal or NULL ids are rows of their own, equal rows each come out, other columns are ignored, and
    an empty table gives an empty table.

    Equal fingerprints are one from the start, however many rows have them; ids come back by a join in
    which fingerprints of many rows are broadcast (:func:`join_facts`).
    """
    spark = docs.sparkSession
    rows = stored(fingerprints(docs, balls, id_column, text_column), spark, "sim-prints")
    prints = stored(
        rows.groupBy(F.col("print").alias("own")).agg(F.min("id").alias("least"), F.count("*").alias("n")),
        spark,
        "sim-distinct",
    )
    roots = components(links(prints.select(F.col("own").alias("print")), balls))
    grouped = stored(
        prints.join(roots.withColumnRenamed("node", "own"), "own", "left").withColumn(
            "root", F.coalesce("root", "own")
        ),
        spark,
        "sim-groups",
    )
    least = grouped.groupBy("root").agg(F.min("least").alias("component_id"))
    facts = stored(grouped.join(least, "root").select("own", "n", "component_id"), spark, "sim-facts")
    total = facts.agg(F.sum("n")).first()[0] or 0
    return join_facts(rows, facts, F.col("print") == F.col("own"), F.col("n"), total).select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
