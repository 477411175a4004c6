"""Similarity join of word-shingle sets by chosen paths (operator 10)."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.components import components
from loamline.llm.pieces import by_bytes, text_bytes
from loamline.llm.shared import arrow_map, stored
from loamline.llm.shingles import WORDS, multipliers, shingle_sets, signature

BATCH_BYTES = 1 << 20


@dataclass(frozen=True)
class PathJoin:
    """Settings of the join.

    A bucket of more than ``limit`` sets is split again, down to ``depth`` levels; one that is still
    larger then is compared in tiles of ``limit`` sets. ``recall`` holds for a pair at the threshold
    whose buckets are split all the way; pairs in small buckets and more similar ones are missed less.
    """

    threshold: float = 0.8
    words: int = WORDS
    coordinates: int = 64
    limit: int = 1000
    depth: int = 3
    recall: float = 0.999
    seed: int = 41

    @property
    def chance(self) -> float:
        """Chance of a coordinate to be chosen at a node: 1 / threshold of them on average."""
        return 1 / (self.threshold * self.coordinates)

    def missed(self, drawn: list[int]) -> float:
        """Chance that a pair at the threshold shares no path that begins at a coordinate in ``drawn``.

        Below, nodes choose among all coordinates, so how many of them agree decides how paths survive.
        """
        s, chance = self.threshold, min(self.chance, 1.0)
        alive = [1.0] * (self.coordinates + 1)
        for _ in range(self.depth - 1):
            alive = [1 - (1 - chance * a) ** agreed for agreed, a in enumerate(alive)]
        # Of the drawn coordinates so many agree, and so many paths begin at these.
        states = {(0, 0): 1.0}
        times = Counter(drawn)
        for n in times.values():
            after = Counter()
            for (agreed, begun), p in states.items():
                after[agreed, begun] += p * (1 - s)
                after[agreed + 1, begun + n] += p * s
            states = after
        rest = self.coordinates - len(times)
        others = [math.comb(rest, k) * s**k * (1 - s) ** (rest - k) for k in range(rest + 1)]
        return sum(
            p * q * (1 - alive[agreed + k]) ** begun
            for (agreed, begun), p in states.items()
            for k, q in enumerate(others)
        )

    @property
    def drawn(self) -> list[int]:
        """Coordinates that split all sets first: the share of every run, and more until the recall holds.

        All coordinates are drawn once, in an order of the seed, before one is drawn again.
        """
        order = random.Random(self.seed).sample(range(self.coordinates), self.coordinates)
        share = math.ceil(self.runs / self.threshold)
        drawn = []
        while len(drawn) < share or self.missed(drawn) > 1 - self.recall:
            drawn.append(order[len(drawn) % self.coordinates])
        return drawn

    @property
    def runs(self) -> int:
        """Enough repetitions for the recall, each with the chance that a path survives."""
        alive = 1.0
        for _ in range(self.depth):
            alive = 1 - math.exp(-alive)
        return math.ceil(math.log(1 - self.recall) / math.log(1 - alive))

    @property
    def sure(self) -> float:
        """Pairs below this share of agreeing coordinates are no candidates (five deviations)."""
        s = self.threshold
        return s - 5 * math.sqrt(s * (1 - s) / self.coordinates)


def sets_of(docs: DataFrame, join: PathJoin, id_column: str, text_column: str) -> DataFrame:
    """Per row: id, hash of the text, ``cls`` (digest of its shingle set) and the set's signature.

    Texts with the same set of shingles are one class from here on.
    """
    factors = multipliers(join.coordinates, join.seed)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for part in by_bytes(whole, 2, BATCH_BYTES):
                keys, rows = [], []
                for hashes in shingle_sets(*text_bytes(part.column(2)), join.words):
                    keys.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    rows.append(signature(hashes, factors))
                flat = np.concatenate(rows) if rows else np.zeros(0, dtype=np.int32)
                offsets = np.arange(len(rows) + 1, dtype=np.int32) * join.coordinates
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(keys, pa.binary()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    ],
                    names=["id", "hash", "cls", "sig"],
                )

    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    kind = docs.schema[id_column].dataType.simpleString()
    chosen = docs.select(F.col(id_column).alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    return arrow_map(chosen, batches, f"id {kind}, hash bigint, cls binary, sig array<int>")


def first_buckets(classes: DataFrame, join: PathJoin) -> DataFrame:
    """(bucket, cls): all sets, split anew on every coordinate drawn."""
    buckets = [F.xxhash64(F.lit(n), F.lit(at), F.col("sig")[at]) for n, at in enumerate(join.drawn)]
    return classes.select(F.explode(F.array(*buckets)).alias("bucket"), "cls")


def split(members: DataFrame, classes: DataFrame, join: PathJoin, level: int) -> DataFrame:
    """Buckets one level further down: members of a bucket are told apart by its own coordinates."""
    million = 1_000_000
    own = F.filter(
        F.sequence(F.lit(0), F.lit(join.coordinates - 1)),
        lambda at: F.pmod(F.xxhash64(F.col("bucket"), at, F.lit(join.seed + level)), F.lit(million))
        < int(million * join.chance),
    )
    return (
        members.withColumn("at", F.explode(own))
        .join(classes.select("cls", "sig"), "cls")
        .select(F.xxhash64("bucket", "at", F.get("sig", F.col("at"))).alias("bucket"), "cls")
    )


def leaves(classes: DataFrame, join: PathJoin) -> tuple[DataFrame, DataFrame]:
    """Buckets to compare: small ones (leaf, cls), and large ones at full depth (leaf, cls, n).

    Small buckets with the same members are compared once.
    """
    spark = classes.sparkSession
    members, small, large = first_buckets(classes, join), [], None
    for level in range(1, join.depth + 1):
        members = stored(members.distinct(), spark, "path-members")
        sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).filter("n > 1")
        sized = stored(members.join(sizes, "bucket"), spark, "path-sized")
        small.append(sized.filter(F.col("n") <= join.limit).select("bucket", "cls"))
        large = sized.filter(F.col("n") > join.limit)
        if large.isEmpty():
            break
        if level < join.depth:
            members = split(large.select("bucket", "cls"), classes, join, level)
    together = small[0]
    for more in small[1:]:
        together = together.unionByName(more)
    lists = together.groupBy("bucket").agg(F.sort_array(F.collect_list("cls")).alias("members"))
    once = lists.groupBy("members").agg(F.min("bucket").alias("leaf"))
    return (
        stored(once.select("leaf", F.explode("members").alias("cls")), spark, "path-leaves"),
        large.select(F.col("bucket").alias("leaf"), "cls", "n"),
    )


def tiles(small: DataFrame, large: DataFrame, join: PathJoin) -> DataFrame:
    """(tile, leaf, cls, side): what is compared in one go.

    A small bucket is one tile (side 0). A large one is dealt into blocks; tiles are its pairs of
    blocks, so a set goes to as many tiles as there are blocks, and no task holds the bucket.
    """
    one = small.select(F.col("leaf").alias("tile"), "leaf", "cls", F.lit(0).alias("side"))
    blocks = F.ceil(F.col("n") / join.limit).cast("int")
    dealt = (
        large.withColumn("blocks", blocks)
        .withColumn("own", F.pmod(F.xxhash64("cls", "leaf"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    )
    low, high = F.least("own", "other"), F.greatest("own", "other")
    many = dealt.select(
        F.xxhash64("leaf", low, high).alias("tile"),
        "leaf",
        "cls",
        F.when(F.col("own") == F.col("other"), 0)
        .when(F.col("own") < F.col("other"), 1)
        .otherwise(2)
        .alias("side"),
    )
    return one.unionByName(many)


def by_key(parts: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Groups of a sorted stream of batches; a group may run over several batches."""
    open_parts, open_key = [], None
    for part in parts:
        if part.num_rows == 0:
            continue
        keys = part.column(key).to_numpy()
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if open_parts and keys[a] != open_key:
                yield pa.Table.from_batches(open_parts)
                open_parts = []
            open_key = keys[a]
            open_parts.append(part.slice(a, b - a))
    if open_parts:
        yield pa.Table.from_batches(open_parts)


def comparable(group: pa.Table) -> np.ndarray:
    """Pairs (upper triangle) that this tile has to judge: no earlier leaf holds both sets.

    Between two blocks only pairs across them count; the inner ones have tiles of their own.
    """
    leaf, n = group.column("leaf")[0].as_py(), group.num_rows
    side = group.column("side").to_numpy()
    ours = np.triu(np.ones((n, n), dtype=bool), 1)
    if side.max(initial=0) > 0:
        ours &= side[:, None] != side[None, :]
    lists = group.column("leaves").combine_chunks()
    owner = np.repeat(np.arange(n), np.diff(lists.offsets.to_numpy()))
    values = lists.flatten().to_numpy()
    earlier = values < leaf
    if earlier.any():
        kinds, column = np.unique(values[earlier], return_inverse=True)
        shared = np.bincount(column) > 1
        column, rows = column[shared[column]], owner[earlier][shared[column]]
        if len(column):
            _, column = np.unique(column, return_inverse=True)
            held = np.zeros((n, int(column.max()) + 1), dtype=np.float32)
            held[rows, column] = 1
            ours &= (held @ held.T) == 0
    return ours


def candidates(rows: DataFrame, join: PathJoin) -> DataFrame:
    """Of each tile the sets that may have a partner in it, by their signatures."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_key(parts, "tile"):
            n = group.num_rows
            sig = group.column("sig").combine_chunks().flatten().to_numpy().reshape(n, -1)
            equal = np.zeros((n, n), dtype=np.uint8)
            for column in sig.T:
                equal += column[:, None] == column[None, :]
            near = (equal >= join.sure * join.coordinates) & comparable(group)
            kept = np.flatnonzero(near.any(axis=0) | near.any(axis=1))
            if len(kept):
                chosen = group.select(["tile", "leaf", "cls", "side", "leaves"]).take(pa.array(kept))
                yield from chosen.combine_chunks().to_batches()

    return arrow_map(
        rows, batches, "tile bigint, leaf bigint, cls binary, side int, leaves array<bigint>"
    )


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[column] > 1
    owner, column = owner[shared], column[shared]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], np.unique(column[order], return_inverse=True)[1]
    common = np.zeros((n, n), dtype=np.float32)
    width = int(column[-1]) + 1 if len(column) else 0
    for at in range(0, width, 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        held = np.zeros((n, 4096), dtype=np.float32)
        held[owner[a:b], column[a:b] - at] = 1
        common += held @ held.T
    return common.astype(np.int64)


def least_linked(pairs: np.ndarray) -> np.ndarray:
    """For each row of a matrix of links the least row that it is connected with."""
    linked = pairs | pairs.T
    np.fill_diagonal(linked, True)
    least = np.arange(len(linked))
    while True:
        after = np.where(linked, least[None, :], len(least)).min(axis=1)
        after = after[after]
        if (after == least).all():
            return least
        least = after


def confirmed(rows: DataFrame, join: PathJoin) -> DataFrame:
    """Exact similarities inside each tile: per set its links here and one edge to its group.

    ``links`` counts documents behind linked sets. Edges form stars, so there are fewer than sets.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in by_key(parts, "tile"):
            keys = group.column("cls").to_pylist()
            first = np.sort(np.unique(np.array([k.hex() for k in keys]), return_index=True)[1])
            group = group.take(pa.array(first))
            raw, bounds = text_bytes(group.column("text").combine_chunks())
            sets = list(shingle_sets(raw, bounds, join.words))
            sizes = np.array([len(s) for s in sets])
            common = overlaps(sets)
            either = sizes[:, None] + sizes[None, :] - common
            similar = (common >= join.threshold * either) & (either > 0) & comparable(group)
            weights = group.column("size").to_numpy()
            links = similar @ weights + similar.T @ weights
            roots = least_linked(similar)
            used = np.flatnonzero(links > 0)
            if len(used):
                cls = group.column("cls").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [cls.take(pa.array(used)), cls.take(pa.array(roots[used])), pa.array(links[used])],
                    names=["cls", "root", "links"],
                )

    return arrow_map(rows, batches, "cls binary, root binary, links bigint")


def in_tiles(rows: DataFrame) -> DataFrame:
    """Whole tiles next to each other; many small partitions, because tiles differ in work."""
    wide = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(wide, "tile").sortWithinPartitions("tile")


def in_groups(docs: DataFrame, join: PathJoin, id_column: str, text_column: str) -> DataFrame:
    """One row per row of ``docs``: id, hash of the text, ``root`` (digest that names the group of
    all rows that links connect), ``class_id`` and ``n_links``.
    """
    spark = docs.sparkSession
    sets = stored(sets_of(docs, join, id_column, text_column), spark, "path-sets")
    classes = stored(
        sets.groupBy("cls").agg(
            F.min("id").alias("least_id"),
            F.count("*").alias("size"),
            F.min(F.struct("id", "hash")).alias("first"),
            F.any_value("sig").alias("sig"),
        ),
        spark,
        "path-classes",
    )
    small, large = leaves(classes, join)
    rows = stored(tiles(small, large, join), spark, "path-tiles")
    held = rows.groupBy("cls").agg(F.sort_array(F.collect_set("leaf")).alias("leaves"))
    signed = held.join(classes.select("cls", "sig"), "cls")
    compared = candidates(in_tiles(rows.join(signed, "cls")), join)
    found = stored(compared, spark, "path-candidates")
    wanted = found.select("cls").distinct().join(classes, "cls").select(
        "cls", "size", F.col("first.id").alias("id"), F.col("first.hash").alias("hash")
    )
    text = F.coalesce(F.col(text_column).cast("string"), F.lit(""))
    own = docs.select(F.col(id_column).alias("own_id"), F.xxhash64(text).alias("own_hash"), text.alias("text"))
    texts = own.join(
        wanted, F.col("own_id").eqNullSafe(F.col("id")) & (F.col("own_hash") == F.col("hash"))
    ).select("cls", "size", "text")
    linked = stored(confirmed(in_tiles(found.join(texts, "cls")), join), spark, "path-links")
    counts = linked.groupBy("cls").agg(F.sum("links").alias("links"))
    roots = components(linked.select(F.col("cls").alias("a"), F.col("root").alias("b")))
    grouped = (
        classes.select("cls", "least_id", "size")
        .join(roots.withColumnRenamed("node", "cls"), "cls", "left")
        .join(counts, "cls", "left")
        .withColumn("root", F.coalesce("root", "cls"))
    )
    least = grouped.groupBy("root").agg(F.min("least_id").alias("class_id"))
    known = grouped.join(least, "root").select(
        "cls", "root", "class_id", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")
    )
    return sets.join(known, "cls").select("id", "hash", "root", "class_id", "n_links")


def near_duplicates(
    docs: DataFrame, join: PathJoin = PathJoin(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``class_id`` and ``n_links``.

    Two texts are linked when their sets of five-word shingles (words between ASCII white space) have
    a Jaccard similarity of 0.8 or more. ``n_links`` counts the other rows linked with a row, copies
    included. ``class_id`` is the least id among all rows that links connect with it.

    The sets' MinHash signatures are split on sampled coordinates, again while a bucket is large;
    small buckets are compared pair by pair, and the whole is repeated for the recall. Every pair
    found is checked on the sets themselves in exactly one bucket, its first.

    Fewer than five words make one shingle. Texts without words, NULL among them, are copies of each
    other. Rows with equal or NULL ids are rows of their own; a class of NULL ids only has the id
    NULL. Other columns are ignored; an empty table gives an empty table.
    """
    rows = in_groups(docs, join, id_column, text_column)
    return rows.select(F.col("id").alias(id_column), "class_id", "n_links")


def one_of_each(
    docs: DataFrame, join: PathJoin = PathJoin(), id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``docs`` without near duplicates: of each group that links connect one row stays.

    That is the row with the least id, NULL last; of rows with that id the one with the least hash of
    the text; of rows with that text too the least one by the other columns. Rows of different groups
    stay apart, whether or not they share an id.
    """
    rows = in_groups(docs, join, id_column, text_column)
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "n")
    firsts = stored(
        rows.groupBy("root", "id", "hash")
        .agg(F.count("*").alias("n"))
        .groupBy("root")
        .agg(F.min(place).alias("first"))
        .groupBy(F.col("first.id").alias("__id"), F.col("first.hash").alias("__hash"))
        .agg(F.sum("first.n").alias("__n")),
        docs.sparkSession,
        "path-firsts",
    )
    text = F.coalesce(F.col(f"`{text_column}`").cast("string"), F.lit(""))
    same = F.col(f"`{id_column}`").eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__hash"))
    alone = docs.join(firsts.filter("__n = 1"), same, "left_semi")
    equal = firsts.filter("__n > 1")
    if equal.isEmpty():
        return alone
    # Equal rows are reduced map-side; maps and variants have no order.
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    kinds = [(f.name, f.dataType.simpleString()) for f in docs.schema]
    order = F.struct(*[F.col(f"`{c}`") for c, kind in kinds if not re.search("map<|variant", kind)])
    chosen = (
        docs.join(equal, same, "left_semi")
        .groupBy(F.col(f"`{id_column}`").alias("__id"), text.alias("__text"))
        .agg(F.min_by(whole, order).alias("__row"))
    )
    return alone.unionByName(chosen.select("__row.*"))
