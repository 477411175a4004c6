import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from loamline.llm import catalog, sim_hash
from loamline.llm.components import components
from tests.conftest import SF
from tests.llm.data import ODD, none, odd, plain


def simhash(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    runs = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """For each fingerprint the least one of those that links connect with it, by all pairs."""
    values = np.array(sorted(set(prints)), dtype=np.uint64)
    root = np.arange(len(values))
    near = [np.flatnonzero(np.bitwise_count(values ^ v) <= 3) for v in values]
    while True:
        after = np.array([root[n].min() for n in near])
        after = after[after]
        if (after == root).all():
            return {int(v): int(values[r]) for v, r in zip(values, root)}
        root = after


def brute(texts):
    prints = [simhash(t) for _, t in texts]
    group = groups(prints)
    least = {}
    for (key, _), p in zip(texts, prints):
        if key is not None:
            least[group[p]] = min(key, least.get(group[p], key))
    return plain((key, f"{p:016x}", least.get(group[p])) for (key, _), p in zip(texts, prints))


def test_components_equal_brute_force(spark):
    texts = [(r.doc_id, r.text) for r in catalog.table(spark, SF, "documents").collect()]
    assert plain(catalog.op12_sim_hash(spark, SF).collect()) == brute(texts)


def test_odd_rows(spark):
    assert plain(sim_hash.near_prints(odd(spark)).collect()) == brute(ODD)
    assert sim_hash.near_prints(none(spark)).count() == 0


def signed(values):
    return np.array(values, dtype=np.uint64).view(np.int64).tolist()


def crowd():
    """Fingerprints in balls around a few centres, some in long chains, and zero."""
    rng = random.Random(8)
    prints = {0}
    for _ in range(6):
        centre = rng.getrandbits(64)
        for _ in range(250):
            flips = rng.sample(range(64), rng.randrange(0, 7))
            prints.add(centre ^ sum(1 << b for b in flips))
    at = rng.getrandbits(64)
    for _ in range(300):
        at ^= sum(1 << b for b in rng.sample(range(64), 3))
        prints.add(at)
    return sorted(prints | {rng.getrandbits(64) for _ in range(500)})


@pytest.mark.parametrize(("step", "limit"), [(8, 50_000), (8, 3), (16, 20), (2, 40)])
def test_links_connect_what_all_pairs_connect(spark, step, limit):
    prints = crowd()
    df = spark.createDataFrame([(p,) for p in signed(prints)], "print bigint")
    found = sim_hash.links(df, sim_hash.Balls(step=step, limit=limit)).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1) for r in found)
    got = {p: p for p in prints}

    def root(x):
        while got[x] != x:
            x = got[x]
        return x

    mask = (1 << 64) - 1
    for r in found:
        a, b = sorted((root(r.a & mask), root(r.b & mask)))
        got[b] = a
    assert {p: root(p) for p in prints} == groups(prints)


def test_every_distance_up_to_three_meets():
    rng = random.Random(3)
    for _ in range(300):
        a = rng.getrandbits(64)
        b = a ^ sum(1 << x for x in rng.sample(range(64), rng.randrange(1, 6)))
        own = np.array(sorted([a, b]), dtype=np.uint64)
        ones, _ = sim_hash.met(own, np.zeros(2, dtype=np.uint64), list(range(64)))
        assert bool(len(ones)) == ((a ^ b).bit_count() <= 3)


def test_big_buckets_are_written_out_in_parts(monkeypatch):
    monkeypatch.setattr(sim_hash, "VARIANTS", 1 << 10)
    own = np.array(crowd()[:400], dtype=np.uint64)
    flips = np.zeros(len(own), dtype=np.uint64)
    whole = set(zip(*[x.tolist() for x in sim_hash.forest(*sim_hash.met(own, flips, list(range(64))))]))
    parts = [sim_hash.met(own[s], f, far) for s, f, far in sim_hash.apart(own, flips, list(range(64)))]
    assert len(parts) > 100
    joined = sim_hash.forest(*[np.concatenate(side) for side in zip(*parts)])
    assert set(zip(*[x.tolist() for x in joined])) == whole


def test_long_chains_in_random_order_settle(spark):
    n = 20_000
    edges = spark.range(n - 1).select(
        F.xxhash64(F.col("id")).alias("a"), F.xxhash64(F.col("id") + 1).alias("b")
    )
    got = components(edges)
    assert got.count() == n and got.select("root").distinct().count() == 1
    least = edges.agg(F.least(F.min("a"), F.min("b"))).first()[0]
    assert got.first().root == least


def test_stars_loops_and_null_ends(spark):
    rows = [(50, i) for i in range(40)] + [(7, 7), (None, 3), (90, None), (60, 61), (61, 60), (60, 61)]
    got = {r.node: r.root for r in components(spark.createDataFrame(rows, "a bigint, b bigint")).collect()}
    assert got == {i: 0 for i in range(40)} | {50: 0, 60: 60, 61: 60}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
