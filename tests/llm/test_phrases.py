import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from loamline.llm import catalog, phrases
from loamline.llm.phrases import Mining
from tests.llm.data import none, odd

SMALL = "/root/testdata/sf0.01"


def brute(rows, mining):
    """The report of (lang, text) rows, from counts of all phrases."""
    counts, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for size in range(1, mining.longest + 1):
                counts[lang].update(tuple(words[i : i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, found in counts.items():
        often = {p: f for p, f in found.items() if f >= mining.least}
        kept = []
        for p, a in often.items():
            if len(p) < 2:
                continue
            cuts = [(2000000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            kept.append((p, a, found[p[:k]], found[p[k:]], score))
        cover = Counter()
        for p, f in often.items():
            for size in range(2, len(p)):
                for i in range(len(p) - size + 1):
                    cover[p[i : i + size]] = max(cover[p[i : i + size]], f)
        kept = [c for c in kept if 100 * cover[c[0]] < mining.covered * c[1] or not cover[c[0]]]
        kept.sort(key=lambda c: (-c[4], -c[1], " ".join(c[0]).encode()))
        for rank, (p, a, left, right, score) in enumerate(kept[: mining.first], 1):
            out.append((lang, rank, " ".join(p), a, left, right, n[lang], score))
    return sorted(out)


def answer(df):
    return sorted(tuple(r) for r in df.collect())


def test_report_equals_counts_of_all_phrases(spark):
    docs = catalog.table(spark, SMALL, "documents")
    rows = [(r.lang, r.text) for r in docs.select("lang", "text").collect()]
    assert answer(catalog.op13_phrases(spark, SMALL)) == brute(rows, Mining())


def noisy(seed):
    rng = random.Random(seed)
    words = ["a", "B", "cé", "dd", "x y", "\x1c", "😀", "e'e", "ff", "g"]
    gaps = [" ", "  ", "\t", " \t ", ", ", ".", "\n", ";", " ", " ", " "]
    weights = [1 / (1 + i) for i in range(len(words))]
    rows = []
    for i in range(400):
        n = rng.choice([0, 1, 2, 5, 30, 200])
        text = "".join(rng.choices(words, weights)[0] + rng.choice(gaps) for _ in range(n))
        lang = rng.choice(["en", "en", "en", None, "und", "d\te", ""])
        rows.append((lang, None if i % 50 == 7 else text))
    return rows


@pytest.mark.parametrize(
    "mining",
    [
        Mining(),
        Mining(least=3, shards=4, first=7),
        Mining(least=8, shards=1),
        # So few slots that most phrases seem to have reached the threshold.
        Mining(least=5, shards=5, slots=1 << 5),
        Mining(least=40, shards=2, slots=1 << 10, covered=50),
    ],
)
def test_any_text_and_any_cycle(spark, mining):
    rows = noisy(mining.least)
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    assert answer(phrases.collocations(docs, mining)) == brute(rows, mining)


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    monkeypatch.setattr(phrases, "BATCH_BYTES", 50)
    text = " ".join(t or "" for _, t in noisy(2)).encode()
    raw = np.frombuffer(text * 2, dtype=np.uint8)
    rows = np.array([0, len(text), 2 * len(text)])
    parts = list(phrases.runs(raw, rows))
    assert len(parts) > 100
    assert b"".join(r.tobytes() for r, _, _ in parts) == (text * 2).replace(b"B", b"b")
    for bytes_, bounds, which in parts:
        assert bounds[0] == 0 and bounds[-1] == len(bytes_) and len(which) == len(bounds) - 1


def test_slots_of_keys_are_those_of_counted_phrases():
    text = "aa bb cc dd aa bb ee. bb cc\nx"
    raw = np.frombuffer(text.encode(), dtype=np.uint8)
    rows, mining = np.array([0, len(raw)]), Mining(least=1, shards=1, slots=1 << 20)
    reached = np.zeros(mining.slots, dtype=np.int8)
    found = {}
    for step in range(4):
        for keys, since, _ in phrases.counted(raw, rows, [b"d\te"], step, reached, mining):
            found.update({k.decode(): s for k, s in zip(keys, since.tolist())})
        fresh = [k for k, s in found.items() if s == step and not k.endswith("\t")]
        reached[phrases.slots_of(fresh, mining.slots)] = step + 1
    words = [p.split() for p in ("aa bb cc dd aa bb ee", "bb cc", "x")]
    want = {" ".join(w[i : i + n]) for w in words for n in range(1, 5) for i in range(len(w) - n + 1)}
    assert {k.rsplit("\t", 1)[1] for k in found} == want | {""}


def test_odd_and_empty_tables(spark):
    rows = [(r.lang, r.text) for r in odd(spark).collect()]
    mining = Mining(least=2)
    assert answer(phrases.collocations(odd(spark), mining)) == brute(rows, mining)
    empty = phrases.collocations(none(spark))
    assert empty.count() == 0
    assert empty.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    blank = odd(spark).withColumn("text", F.lit(" \t,\n"))
    assert phrases.collocations(blank).count() == 0
