import math
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from loamline.llm import catalog, chosen_path, mixing
from loamline.llm.components import components
from tests.conftest import SF
from tests.llm.data import ODD, none, odd, plain, prose


# Near duplicates


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    if len(words) < 5:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def brute(texts, threshold=0.8):
    """(id, class, links) of every row."""
    sets, n = [shingles(t) for _, t in texts], len(texts)
    links, root = [0] * n, list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(n):
        for j in range(i):
            either = len(sets[i] | sets[j])
            if either == 0 or len(sets[i] & sets[j]) >= threshold * either:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    classes = defaultdict(list)
    for i, (key, _) in enumerate(texts):
        classes[find(i)].append(key)
    least = {r: min((k for k in keys if k is not None), default=None) for r, keys in classes.items()}
    return plain((key, least[find(i)], links[i]) for i, (key, _) in enumerate(texts))


def edited(text, *changes):
    words = text.split()
    for at in changes:
        words[at] = f"new{at}"
    return " ".join(words)


def groups():
    texts = []
    for g in range(12):
        base = prose(300 + g, 120)
        texts += [(base), edited(base, 3), edited(base, 60), edited(base, 3, 90), edited(base, *range(0, 120, 9))]
    hot = prose(900, 150)
    texts += [edited(hot, i % 140) for i in range(60)] + [hot] * 5
    shared = prose(901, 40)
    texts += [f"{shared} {prose(2000 + i, 60)}" for i in range(40)]
    return [(i * 3, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("limit", [1000, 20])
def test_join_equals_brute_force(spark, limit):
    texts = groups()
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = chosen_path.near_duplicates(docs, chosen_path.PathJoin(limit=limit)).collect()
    assert plain(got) == brute(texts)


def test_odd_rows_in_the_join(spark):
    got = chosen_path.near_duplicates(odd(spark))
    assert plain(got.collect()) == brute(ODD)
    assert chosen_path.near_duplicates(none(spark)).count() == 0
    kept = chosen_path.one_of_each(odd(spark))
    assert kept.columns == odd(spark).columns
    # One row of each group; two groups may hold rows with the same id.
    sets = [shingles(t) for _, t in ODD]
    assert sorted(map(repr, (shingles(r.text) for r in kept.collect()))) == sorted(map(repr, set(sets)))


def test_one_row_of_every_group_stays(spark):
    base, other = prose(400, 80), prose(401, 80)
    texts = [
        (None, prose(402)),
        (None, prose(403)),
        (None, prose(403)),
        (9, "one two"),
        (9, prose(404)),
        (3, base),
        (5, edited(base, 3)),
        (5, other),
        (7, None),
        (7, ""),
    ]
    docs = spark.createDataFrame([(i, t, n) for n, (i, t) in enumerate(texts)], "doc_id bigint, text string, n int")
    docs = docs.withColumn("more", F.create_map(F.lit("k"), F.col("n")))
    kept = chosen_path.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.n for r in kept.collect()) == [0, 1, 3, 4, 5, 7, 8]


def test_runs_follow_the_recall():
    assert chosen_path.PathJoin(recall=0.9).runs < chosen_path.PathJoin(recall=0.999).runs
    assert 0 < chosen_path.PathJoin().sure < 0.8


def test_first_buckets_reach_the_recall(spark):
    join = chosen_path.PathJoin()
    # Set c agrees with set -1 on coordinate c alone, so they share as many buckets as c was drawn.
    sigs = [(-1, [0] * join.coordinates)]
    sigs += [(c, [0 if at == c else c + 1 for at in range(join.coordinates)]) for c in range(join.coordinates)]
    rows = chosen_path.first_buckets(spark.createDataFrame(sigs, "cls int, sig array<int>"), join).collect()
    base = {r.bucket for r in rows if r.cls == -1}
    times = Counter(r.cls for r in rows if r.bucket in base and r.cls >= 0)
    deeper = 1.0
    for _ in range(join.depth - 1):
        deeper = 1 - math.exp(-deeper)
    s = join.threshold
    assert math.prod(1 - s + s * (1 - deeper) ** n for n in times.values()) <= 1 - join.recall
    assert sum(times.values()) == len(join.drawn) and join.missed(list(times.elements())) <= 1 - join.recall


def test_components_of_chains_and_stars(spark):
    pairs = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (300, 301)]
    got = {r.node: r.root for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect()}
    whole = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 300: 300, 301: 300}
    assert got == whole


def test_long_chains_of_edits_are_one_group(spark):
    texts, words = [], prose(77, 60).split()
    for i in range(1500):
        texts.append((i, " ".join(words)))
        words[(i * 23) % 60] = f"w{i}"
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    got = chosen_path.near_duplicates(docs)
    assert {r.class_id for r in got.collect()} == {c for _, c, _ in brute(texts)}


# Mixing


def filled(budget, children):
    """Reference water filling: children as name -> (capacity, weight)."""
    given, open_, left = {}, dict(children), budget
    while open_:
        level = left / sum(w for _, w in open_.values())
        full = {n for n, (c, w) in open_.items() if c <= level * w + 1e-9}
        if not full:
            return given | {n: level * w for n, (_, w) in open_.items()}
        for n in full:
            given[n] = open_.pop(n)[0]
            left -= given[n]
    return given


def test_budgets_equal_reference_filling(spark):
    mix = mixing.Mix(levels=("a", "b"), weights={"a": {"x": 5.0}, "b": {"q": 3.0, "zero": 0.0}}, share=0.6, epochs=2)
    tokens = {("x", "p"): 10, ("x", "q"): 40, ("y", "p"): 300, ("y", "q"): 80, ("z", "r"): 500, ("z", "zero"): 70}
    leaves = spark.createDataFrame(
        [(a, b, 1, n) for (a, b), n in tokens.items()], "a string, b string, rows bigint, tokens bigint"
    )
    got = {(r.a, r.b): r.budget for r in mixing.budgets(leaves, mix).collect()}
    top = filled(
        0.6 * sum(tokens.values()),
        {a: (2 * sum(n for (x, _), n in tokens.items() if x == a), 5.0 if a == "x" else 1.0) for a in "xyz"},
    )
    want = {}
    for a in "xyz":
        children = {b: (2 * n, 3.0 if b == "q" else 1.0) for (x, b), n in tokens.items() if x == a and b != "zero"}
        for b, amount in filled(top[a], children).items():
            want[a, b] = int(amount + 1e-6)
    assert got == want
    assert got["x", "p"] == 20 and got["x", "q"] == 80


def test_prefix_of_the_seeded_order(spark, monkeypatch):
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 7)
    docs = spark.createDataFrame(
        [(i, prose(i, 5 + i % 40), "ab"[i % 3 == 0], f"s{i % 2}") for i in range(300)],
        "doc_id bigint, text string, lang string, source string",
    )
    mix = mixing.Mix(levels=("lang", "source"), share=0.7, epochs=3, weights={"lang": {"a": 6.0}})
    got = Counter((r.doc_id, r.epoch) for r in mixing.drawn(docs, mix).collect())
    assert set(got.values()) == {1}
    measured = mixing.measured(docs, mix, "doc_id", "text").collect()
    leaves = spark.createDataFrame(measured).groupBy("lang", "source").agg(
        F.count("*").alias("rows"), F.sum("tokens").alias("tokens")
    )
    want = Counter()
    for leaf in mixing.budgets(leaves, mix).collect():
        own = sorted((r for r in measured if (r.lang, r.source) == (leaf.lang, leaf.source)), key=lambda r: r["__place"])
        full, rest = divmod(leaf.budget, leaf.tokens)
        for r in own:
            want.update((r["__id"], e) for e in range(full))
            rest -= r.tokens
            if rest >= 0:
                want[r["__id"], full] += 1
    assert got == want


def test_odd_rows_in_the_mix(spark):
    docs = catalog.with_domain(odd(spark))
    whole = mixing.drawn(docs, mixing.Mix(share=1.0, epochs=1))
    assert whole.count() == len(ODD) and set(docs.columns) == set(whole.columns)
    assert {r.epoch for r in whole.collect()} == {0}
    assert mixing.drawn(catalog.with_domain(none(spark)), mixing.Mix()).count() == 0


# Pipeline and queries


def test_stages_chain(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, sizes = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = spark.createDataFrame(out.collect(), out.schema)
            sizes.append(docs.count())
    assert sizes[0] >= sizes[1] == sizes[2] > 0
    assert docs.filter(F.col("text").rlike("[0-9a-f]{24,}")).count() == 0
    run = corpus_pipeline.run(spark, SF)
    assert run.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert run.count() == docs.count()


def test_stages_take_empty_and_odd_documents(spark):
    for docs in (none(spark), odd(spark)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            rows = out.collect()
            assert name == "BPE encoding and decoding" or out.columns == docs.columns
            assert docs.count() or not rows


def test_all_operators_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names and corpus_pipeline.ORACLE_SQL is None
