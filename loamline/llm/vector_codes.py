"""Product quantisation of vectors; nearest entries by slices of bit masks (operator 11)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.shared import arrow_map, join_facts, stored

# Components are multiplied by this and rounded down.
SCALE = 256
# Whole components beyond this count as this, so that distances and sums stay exact in 64 bits.
BOUND = 1 << 23
# One bit for each entry of a codebook.
ENTRIES = 64
SLICE = 8192


@dataclass(frozen=True)
class Codebook:
    """Entries of one part position, with the masks that find candidates.

    ``order`` holds the sorted coordinates of every dimension, and ``masks[d, i]`` the set of the
    entries that hold the first ``i`` of them. The entries with a coordinate between two places are
    then the difference of two masks.
    """

    entries: np.ndarray
    order: np.ndarray
    masks: np.ndarray

    @staticmethod
    def of(entries: np.ndarray) -> Codebook:
        count, width = entries.shape
        places = np.argsort(entries, axis=0, kind="stable")
        order = np.take_along_axis(entries, places, axis=0).T.copy()
        bits = np.uint64(1) << places.T.astype(np.uint64)
        masks = np.zeros((width, count + 1), dtype=np.uint64)
        masks[:, 1:] = np.bitwise_or.accumulate(bits, axis=1)
        return Codebook(entries, order, masks)

    def distances(self, parts: np.ndarray, which: np.ndarray) -> np.ndarray:
        gap = parts - self.entries[which]
        return np.einsum("ij,ij->i", gap, gap)

    def nearest(self, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the nearest entry of each row, the least of equally near ones, and its distance.

        The initial radius is the distance to the best of the entries next to the row in one dimension.
        Whatever is as near or nearer differs from the row by no more than that in every dimension, so
        the AND of the dimensions' masks holds the nearest entry and all that tie with it.
        """
        rows, width = parts.shape
        if not rows or not width:
            return np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
        last = len(self.entries) - 1
        bound = np.full(rows, np.iinfo(np.int64).max)
        for d in range(width):
            at = np.searchsorted(self.order[d], parts[:, d])
            near = np.minimum(at, last)
            before = np.maximum(at - 1, 0)
            closer = parts[:, d] - self.order[d][before] < self.order[d][near] - parts[:, d]
            place = np.where(closer, before, near)
            bit = self.masks[d, place + 1] ^ self.masks[d, place]
            bound = np.minimum(bound, self.distances(parts, bit_place(bit)))
        radius = np.ceil(np.sqrt(bound.astype(np.float64))).astype(np.int64) + 1
        found = np.full(rows, np.iinfo(np.uint64).max, dtype=np.uint64)
        for d in range(width):
            low = np.searchsorted(self.order[d], parts[:, d] - radius, side="left")
            high = np.searchsorted(self.order[d], parts[:, d] + radius, side="right")
            found &= self.masks[d, high] ^ self.masks[d, low]
        best = np.zeros(rows, dtype=np.int64)
        least = np.full(rows, np.iinfo(np.int64).max)
        open_ = np.arange(rows)
        while len(open_):
            lowest = found[open_] & (~found[open_] + np.uint64(1))
            which = bit_place(lowest)
            gap = self.distances(parts[open_], which)
            better = gap < least[open_]
            least[open_[better]] = gap[better]
            best[open_[better]] = which[better]
            found[open_] ^= lowest
            open_ = open_[found[open_] != 0]
        return best, least


def bit_place(single: np.ndarray) -> np.ndarray:
    """Which bit is set in numbers that are powers of two."""
    return np.frexp(single.astype(np.float64))[1].astype(np.int64) - 1


@dataclass(frozen=True)
class Codes:
    """Settings: consecutive parts of a vector, entries of a part's codebook, rounds that move them."""

    parts: int = 16
    entries: int = ENTRIES
    rounds: int = 2

    def __post_init__(self):
        if not 1 <= self.entries <= ENTRIES:
            raise ValueError("a codebook holds 1 to 64 entries, one for each bit of a mask")

    def cuts(self, width: int) -> list[int]:
        """Where parts begin, with the end: equal parts, the first ones longer where that does not go."""
        return [0, *np.cumsum([len(p) for p in np.array_split(np.arange(width), self.parts)]).tolist()]


def usable(vector: Column) -> Column:
    """Is the vector known, and each component a finite number?"""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd


def whole_rows(vectors: pa.Array, width: int) -> np.ndarray:
    """A matrix of the whole components of vectors of one length."""
    flat = vectors.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False).reshape(len(vectors), width)
    return np.clip(np.floor(flat * SCALE), -BOUND, BOUND).astype(np.int64)


def first_entries(kept: DataFrame, codes: Codes) -> np.ndarray | None:
    """The vectors of the least ids, which the codebooks start from; None where there is no vector."""
    order = (F.col("id").isNull(), F.col("id"), F.col("vector"))
    least = kept.orderBy(*order).limit(codes.entries).collect()
    if not least:
        return None
    width = len(least[0].vector)
    if any(len(r.vector) != width for r in least):
        least = kept.filter(F.size("vector") == width).orderBy(*order).limit(codes.entries).collect()
    return whole_rows(pa.array([r.vector for r in least], pa.list_(pa.float64())), width)


def books_of(entries: np.ndarray, codes: Codes) -> list[Codebook]:
    cuts = codes.cuts(entries.shape[1])
    return [Codebook.of(entries[:, a:b]) for a, b in zip(cuts[:-1], cuts[1:])]


def slices(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with the matrix of their vectors; all vectors have one length."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            part = batch.slice(at, SLICE)
            lengths = pc.list_value_length(part.column(column))
            yield part, whole_rows(part.column(column), lengths[0].as_py())


def moved(kept: DataFrame, entries: np.ndarray, codes: Codes) -> np.ndarray:
    """One round: every entry becomes the mean, rounded down, of the parts that are nearest to it.

    A task hands on one row for each entry that it uses, with a count and a sum for each component;
    as many rows as all codebooks have entries come to the driver.
    """
    books, cuts, count = books_of(entries, codes), codes.cuts(entries.shape[1]), len(entries)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(entries.shape, dtype=np.int64)
        used = np.zeros((count, codes.parts), dtype=np.int64)
        for _, rows in slices(parts, 0):
            for p, book in enumerate(books):
                own = rows[:, cuts[p] : cuts[p + 1]]
                best, _ = book.nearest(own)
                used[:, p] += np.bincount(best, minlength=count)
                for d, column in enumerate(own.T, cuts[p]):
                    # Exact: a slice adds up to less than 2 ** 53.
                    sums[:, d] += np.bincount(best, column, count).astype(np.int64)
        at, p = np.nonzero(used)
        lists = [sums[e, cuts[q] : cuts[q + 1]].tolist() for e, q in zip(at.tolist(), p.tolist())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(p, pa.int32()),
                pa.array(at, pa.int32()),
                pa.array(used[at, p], pa.int64()),
                pa.array(lists, pa.list_(pa.int64())),
            ],
            names=["part", "entry", "n", "sums"],
        )

    longest = max(b - a for a, b in zip(cuts[:-1], cuts[1:]))
    partial = arrow_map(kept.select("vector"), batches, "part int, entry int, n bigint, sums array<bigint>")
    totals = partial.groupBy("part", "entry").agg(
        F.sum("n").alias("n"),
        F.array(*[F.sum(F.get("sums", F.lit(d))) for d in range(longest)]).alias("sums"),
    )
    after = entries.copy()
    for row in totals.collect():
        a, b = cuts[row.part], cuts[row.part + 1]
        after[row.entry, a:b] = [s // row.n for s in row.sums[: b - a]]
    return after


def digest_of(entries: np.ndarray, codes: Codes) -> str:
    """SHA-256 of all components, decimal, by part, entry and place within the part."""
    cuts = codes.cuts(entries.shape[1])
    ordered = [entries[:, a:b].ravel() for a, b in zip(cuts[:-1], cuts[1:])]
    return hashlib.sha256(",".join(map(str, np.concatenate(ordered).tolist())).encode()).hexdigest()


def coded(kept: DataFrame, entries: np.ndarray, codes: Codes) -> DataFrame:
    """id, label, code and error of every vector."""
    books, cuts = books_of(entries, codes), codes.cuts(entries.shape[1])
    digits = np.array([f"{e:02x}" for e in range(ENTRIES)])

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, rows in slices(parts, 2):
            texts, error = [], np.zeros(len(rows), dtype=np.int64)
            for p, book in enumerate(books):
                best, gap = book.nearest(rows[:, cuts[p] : cuts[p + 1]])
                texts.append(digits[best])
                error += gap
            code = ["".join(row) for row in zip(*[t.tolist() for t in texts])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(code, pa.string()), pa.array(error, pa.int64())],
                names=["id", "label", "code", "error"],
            )

    kinds = dict(kept.dtypes)
    return arrow_map(kept, batches, f"id {kinds['id']}, label {kinds['label']}, code string, error bigint")


def vector_codes(
    vectors: DataFrame,
    codes: Codes = Codes(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """One row per usable vector: id, code, error, label_error, codebooks_sha256.

    Vectors that are NULL, hold a NULL or a component that is no finite number are left out, and so are
    those of another length than the vector of the least id has. Components become floor(256 * x); those
    beyond 2 ** 23 count as 2 ** 23. A vector is cut into 16 parts, equal ones where its length allows it,
    otherwise the first ones are longer by one; parts without components have the code 00 and no error.

    The codebooks start from the vectors of the 64 least ids (NULL last, equal ids by the vector), fewer
    where there are fewer vectors, and two rounds move each entry to the mean of its parts. ``code`` holds
    two hex digits for each part, ``error`` the squared distances, ``label_error`` their sum over all rows
    with the label, NULL labels together. Equal rows each come out; an empty table gives an empty table;
    other columns are ignored.

    The codebooks are all that is broadcast, at most 64 vectors. A label's errors are added up map-side;
    labels that hold many rows are joined by broadcast (:func:`join_facts`).
    """
    spark = vectors.sparkSession
    known = vectors.select(
        F.col(f"`{id_column}`").alias("id"),
        F.col(f"`{label_column}`").alias("label"),
        F.col(f"`{vector_column}`").cast("array<double>").alias("vector"),
    ).filter(usable(F.col("vector")))
    entries = first_entries(known, codes)
    if entries is None:
        none = known.limit(0).select(
            "id",
            F.lit("").alias("code"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("error", "label_error")],
            F.lit("").alias("codebooks_sha256"),
        )
        return none.withColumnRenamed("id", id_column)
    kept = known.filter(F.size("vector") == entries.shape[1])
    for _ in range(codes.rounds):
        entries = moved(kept, entries, codes)
    rows = stored(coded(kept, entries, codes), spark, "vector-codes")
    totals = stored(
        rows.groupBy(F.col("label").alias("own_label")).agg(
            F.sum("error").alias("label_error"), F.count("*").alias("n")
        ),
        spark,
        "vector-labels",
    )
    total = totals.agg(F.sum("n")).first()[0]
    same = F.col("label").eqNullSafe(F.col("own_label"))
    return join_facts(rows, totals, same, F.col("n"), total).select(
        F.col("id").alias(id_column),
        "code",
        "error",
        "label_error",
        F.lit(digest_of(entries, codes)).alias("codebooks_sha256"),
    )
