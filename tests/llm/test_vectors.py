import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import catalog, vector_codes
from tests.conftest import SF

SCHEMA = "vec_id bigint, embedding array<float>, label int, code string, n bigint, own_label int, id string, part int"


def brute(rows, parts=16, entries=64, rounds=2):
    """(id, code, error, label_error, digest) of (id, vector, label) rows, by comparing all entries."""
    def usable(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v)

    kept = [(i, [math.floor(256 * float(np.float32(x))) for x in v], lab) for i, v, lab in rows if usable(v)]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = len(kept[0][1])
    kept = [r for r in kept if len(r[1]) == width]
    sizes = [width // parts + (p < width % parts) for p in range(parts)]
    cuts = [0]
    for s in sizes:
        cuts.append(cuts[-1] + s)
    books = [[tuple(v[a:b]) for _, v, _ in kept[:entries]] for a, b in zip(cuts, cuts[1:])]

    def nearest(book, part):
        best = min(range(len(book)), key=lambda e: (sum((x - y) ** 2 for x, y in zip(part, book[e])), e))
        return best, sum((x - y) ** 2 for x, y in zip(part, book[best]))

    for _ in range(rounds):
        for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
            groups = defaultdict(list)
            for _, v, _ in kept:
                groups[nearest(books[p], v[a:b])[0]].append(v[a:b])
            for e, members in groups.items():
                books[p][e] = tuple(sum(c) // len(members) for c in zip(*members))
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    out, labels = [], defaultdict(int)
    for i, v, lab in kept:
        found = [nearest(books[p], v[a:b]) for p, (a, b) in enumerate(zip(cuts, cuts[1:]))]
        error = sum(d for _, d in found)
        labels[lab] += error
        out.append((i, "".join(f"{e:02x}" for e, _ in found), error, lab))
    return sorted([(i, c, e, labels[lab], digest) for i, c, e, lab in out], key=repr)


def answer(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_codes_equal_brute_force(spark):
    vectors = catalog.table(spark, SF, "embeddings")
    rows = [(r.vec_id, r.embedding, r.label) for r in vectors.collect()]
    assert answer(catalog.op11_vector_codes(spark, SF)) == brute(rows)


def test_odd_vectors(spark):
    rng = random.Random(5)
    good = [rng.uniform(-1, 1) for _ in range(35)]
    rows = [(i, [rng.choice([-0.5, 0.0, 0.5, 0.25, 300.0]) for _ in range(35)], i % 3 or None) for i in range(90)]
    rows += [
        (5, good, 1),
        (5, good, 1),
        (5, good[:-1], 1),
        (None, good, None),
        (200, None, 1),
        (201, [], 1),
        (202, [*good[:-1], None], 1),
        (203, [*good[:-1], float("nan")], 2),
        (204, [*good[:-1], float("-inf")], 2),
    ]
    extra = ("x", 1, None, None, 7)
    df = spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(5)
    assert answer(vector_codes.vector_codes(df)) == brute(rows)
    few = [r for r in rows if r[0] in (None, 5)][:3]
    df = spark.createDataFrame([(*r, *extra) for r in few], SCHEMA)
    assert answer(vector_codes.vector_codes(df)) == brute(few)
    for none in (df.limit(0), df.withColumn("embedding", F.lit(None).cast("array<float>"))):
        empty = vector_codes.vector_codes(none)
        assert empty.count() == 0
        assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]


@pytest.mark.parametrize("spread", [3, 40, 1 << 22])
def test_masks_give_the_nearest_entry(spread):
    rng = np.random.default_rng(spread)
    for count in (1, 7, 64):
        entries = rng.integers(-spread, spread, (count, 4))
        rows = rng.integers(-2 * spread, 2 * spread, (3000, 4))
        best, gap = vector_codes.Codebook.of(entries).nearest(rows)
        all_ = ((rows[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
        assert (gap == all_.min(axis=1)).all() and (best == all_.argmin(axis=1)).all()


def test_hot_labels_are_added_up_whole(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("vec_id"),
        F.array(*[(F.pmod(F.xxhash64("id", F.lit(d)), F.lit(512)) / 256).cast("float") for d in range(16)]).alias("embedding"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id").cast("int") + 10).alias("label"),
    )
    got = vector_codes.vector_codes(rows).join(rows.select("vec_id", "label"), "vec_id")
    sums = got.groupBy("label").agg(F.sum("error").alias("s"), F.min("label_error").alias("a"), F.max("label_error").alias("b"))
    assert sums.filter("s != a OR a != b").isEmpty() and got.count() == 3000
