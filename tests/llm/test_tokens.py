import hashlib
import random
import re
import tracemalloc
import zlib
from io import BytesIO

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from loamline.llm import forced_cuts, id_files, token_counts as counting
from loamline.llm.forced_cuts import FragmentEncoder, bpe_round_trip, encoded
from loamline.llm.pieces import byte_batches, piece_bounds
from loamline.llm.token_counts import byte_names, token_counts, tokenizer
from loamline.session import scratch_path
from tests.llm.data import ODD, none, odd, plain

BYTE = public_tokenizers.path("byte_bpe_50k.json")
WORD = public_tokenizers.path("word_bpe_49k.json")


def library_ids(path, text):
    return tokenizer(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("batch_bytes", [64, 1 << 24])
def test_counts_equal_the_library(spark, batch_bytes):
    got = token_counts(odd(spark), BYTE, batch_bytes=batch_bytes).collect()
    want = []
    for i, text in ODD:
        n = len(library_ids(BYTE, text))
        want.append((i, len((text or "").encode()), n, n > 1024))
    assert plain(got) == plain(want)
    assert token_counts(none(spark), BYTE).count() == 0


def test_random_texts_are_cut_safely(spark):
    rng = random.Random(5)
    marks = ["a", "B", "é", "1", "²", "'", "'s", "'ll", " ", "  ", "\n", "\t", "\u00a0", "\u2003", "\u3000",
             "\x1c", "\x85", "\x0b", "!", "<|endoftext|>", "<|", "İ", "ǅ", "中", "\u0301", "\ufb01", "़"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(60))) for _ in range(600)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    counts = {r.doc_id: r.n_tokens for r in token_counts(docs, BYTE).collect()}
    trips = {r.doc_id: r for r in bpe_round_trip(docs, WORD).collect()}
    for i, text in enumerate(texts):
        assert counts[i] == len(library_ids(BYTE, text)), text
        ids = library_ids(WORD, text)
        assert trips[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), text
        decoded = tokenizer(WORD).decode(ids, skip_special_tokens=False)
        assert trips[i].decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest(), text


def test_round_trip_equals_the_library(spark):
    got = bpe_round_trip(odd(spark), WORD, batch_bytes=4096).collect()
    want = []
    for i, text in ODD:
        ids = library_ids(WORD, text)
        decoded = tokenizer(WORD).decode(ids, skip_special_tokens=False)
        digest = [hashlib.sha256(s.encode()).hexdigest() for s in (" ".join(map(str, ids)), decoded)]
        want.append((i, len(ids), *digest))
    assert plain(got) == plain(want)
    assert bpe_round_trip(none(spark), WORD).count() == 0


@pytest.mark.parametrize(
    ("module", "operator", "path"),
    [(forced_cuts, bpe_round_trip, WORD), (forced_cuts, encoded, WORD), (counting, token_counts, BYTE)],
)
def test_a_large_batch_is_worked_off_in_slices(spark, monkeypatch, module, operator, path):
    taken = []
    monkeypatch.setattr(module, "arrow_map", lambda df, batches, schema: taken.append(batches))
    monkeypatch.setattr(module, "BATCH_BYTES", 1 << 16)
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    operator(docs, path, **{} if operator is encoded else {"batch_bytes": 1 << 16})
    texts = pa.array([f"ab cd e{i} " * 100 for i in range(5000)])
    part = pa.RecordBatch.from_arrays([pa.array(range(5000), pa.int64()), texts], names=["doc_id", "text"])
    assert part.nbytes > 4 << 20
    (work,) = taken
    assert next(work(iter([part.slice(0, 1)]))).num_rows == 1  # loads the models
    tracemalloc.start()
    rows = sum(found.num_rows for found in work(iter([part])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 5000 and peak < 12 << 20


def test_what_a_bpe_worker_remembers_has_a_bound():
    table = forced_cuts.PieceTable(WORD)
    table.encode.fragments.clear()
    for at in range(0, 240_000, 20_000):
        table([f"{chr(97 + i % 26)}q{i:x}" for i in range(at, at + 20_000)])
    sizes = [len(t) for t in (table.known, table.plain, table.named, table.encode.fragments)]
    assert sum(sizes) <= 180_000
    assert table.encode.ends is not None and table(["zebra crossing"])[0][0] == len(library_ids(WORD, "zebra crossing"))


def test_ids_as_a_column_keep_other_columns(spark):
    got = encoded(odd(spark), WORD)
    assert got.columns == [*odd(spark).columns, "token_ids"]
    assert plain((r.text, r.token_ids) for r in got.collect()) == plain(
        (t, library_ids(WORD, t)) for _, t in ODD
    )


def test_forced_cuts_are_in_no_token():
    encode = FragmentEncoder(WORD)
    word = byte_names("zqxjé中kvwq")
    parts = encode.cut(word)
    assert "".join(parts) == word and len(parts) > 2
    for left, right in zip(parts, parts[1:]):
        assert not any(left[-1] + right[0] in token for token in encode.ends.get_vocab()) if hasattr(
            encode.ends, "get_vocab"
        ) else left[-1] + right[0] not in encode.joined


def test_batches_are_balanced_and_whole():
    raw = np.frombuffer(b"word " * 1000 + b"y" * 5000, dtype=np.uint8)
    bounds, rows = piece_bounds(raw, np.array([0, 3000, 3000, len(raw)]))
    runs = list(byte_batches(raw, bounds, 500))
    assert [a for a, _ in runs[1:]] == [b for _, b in runs[:-1]] and runs[-1][1] == len(bounds) - 1
    sizes = [bounds[b] - bounds[a] for a, b in runs]
    assert max(sizes[:-1]) <= 500 and sizes[-1] >= 5000
    assert set(rows) == {0, 2}


def written(ids, counts, alphabet=50257):
    out = BytesIO()
    id_files.write_file(out, [(np.array(ids, dtype=np.int64), np.array(counts))], alphabet)
    return out.getvalue()


def read(data):
    counts, groups = id_files.read_file(data)
    return counts.tolist(), [i for ids in groups for i in ids.tolist()]


@pytest.mark.parametrize("n", [0, 1, 7, 8192, 8193, 20000])
def test_files_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.integers(0, 50257, n), np.full(n, 50256), rng.zipf(1.3, n) % 50257):
        counts, back = read(written(ids, [n // 3, n - n // 3]))
        assert back == ids.tolist() and counts == [n // 3, n - n // 3]


def test_repetition_compresses_and_damage_is_noticed():
    ids = np.tile(np.arange(100), 200)
    data = written(ids, [len(ids)])
    assert len(data) < 0.1 * 2 * len(ids)
    for at in (4, 18, 40, len(data) // 2, len(data) - 3):
        bad = bytearray(data)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            read(bytes(bad))


def test_pieces_put_together_have_the_library_s_ids():
    rng = random.Random(11)
    marks = ["a", "the", "B", "1", "'s", "'", " ", "  ", "\n", "\t", "\r", "!", ".", "<|endoftext|>", "<|", "é", "\x0b"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randrange(40))) for _ in range(400)]
    lengths = np.cumsum([0, *(len(t.encode()) for t in texts)])
    raw = np.frombuffer("".join(texts).encode(), dtype=np.uint8)
    encode, calls = id_files.PieceIds(BYTE), []
    apart = encode.apart
    encode.apart = lambda pieces: calls.append(len(pieces)) or apart(pieces)
    ids, counts = id_files.ids_of(raw, lengths, encode, 0)
    want = [[*library_ids(BYTE, t), 0] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]
    assert len(calls) == 1


def ids_of_texts(encode, texts):
    lengths = np.cumsum([0, *(len(t.encode()) for t in texts)])
    ids, counts = id_files.ids_of(np.frombuffer("".join(texts).encode(), dtype=np.uint8), lengths, encode, 0)
    want = [[*library_ids(BYTE, t), 0] for t in texts]
    assert ids.tolist() == [i for w in want for i in w] and counts.tolist() == [len(w) for w in want]


def test_words_are_encoded_once_for_all_batches(monkeypatch):
    encode, asked = id_files.PieceIds(BYTE), []
    encoded_words = encode.encoded
    encode.encoded = lambda words: asked.extend(words) or encoded_words(words)
    texts = [" Été ouéaie, it's 12½ «x» naïve.\n", " it's naïve! \u00ad¹²\u017f\u0130 x", " " + "ab" * 300]
    ids_of_texts(encode, texts)
    first = len(asked)
    assert first > 5 and len(set(asked)) == first
    ids_of_texts(encode, texts[::-1])
    assert len(asked) == first
    monkeypatch.setattr(id_files, "REMEMBERED_WORDS", 4)
    for k in range(3):
        ids_of_texts(encode, [f" word{k} it's {t}" for t in texts])
    ids_of_texts(encode, [" it's"])
    assert len(encode.slots) <= 4 + 2


def test_plain_words_are_those_of_the_vocabulary():
    from loamline.llm.token_counts import BYTE_LEVEL_WORDS, PLAIN

    rng = random.Random(5)
    plain_chars = [chr(c) for c in range(0x180) if PLAIN.fullmatch(chr(c))]
    pool = plain_chars + list(" \n\t'sstrevmld ") * 12
    for text in ["".join(plain_chars), *("".join(rng.choices(pool, k=14)) for _ in range(5000))]:
        assert id_files.PLAIN_WORDS.findall(text) == BYTE_LEVEL_WORDS.findall(text)


def test_words_are_cut_by_arrays_as_by_the_pattern():
    rng = random.Random(6)
    plain_chars = [chr(c) for c in range(0x180) if re.fullmatch(rf"[ \t\n\r{id_files._PLAIN_MARKS}]", chr(c))]
    pool = plain_chars + list(" \n\t''sstrevmld " + "'") * 12
    texts = ["".join(rng.choices(pool, k=14)).rstrip() for _ in range(5000)]
    for text in ["", "'", "'s", "a'", "a're", "it's 'll \n't x''d", "".join(plain_chars).strip(), *texts]:
        assert id_files.plain_words(text.encode()).to_pylist() == id_files.PLAIN_WORDS.findall(text)


def test_words_that_share_a_hash_are_told_apart(monkeypatch):
    texts = [" " + " ".join(f"word{k} é{k}'s" for k in range(at, at + 60)) for at in range(0, 200, 20)]
    for n in (1, 5):
        monkeypatch.setattr(id_files, "word_hashes", lambda raw, stops: (np.diff(stops) % n).astype(np.uint64))
        encode = id_files.PieceIds(BYTE)
        for part in (texts[:4], texts[2:], texts):
            ids_of_texts(encode, part)
        assert 0 < len(encode.slots) <= n


def test_remembered_words_take_no_python_objects():
    encode = id_files.PieceIds(BYTE)
    words = [" " + "".join(random.Random(k).choices("abcdefgh", k=9)) for k in range(20_000)]
    ids_of_texts(encode, ["".join(words)])
    held = [v for v in vars(encode).values() if isinstance(v, np.ndarray)]
    assert len(encode.slots) > 19_000 and sum(v.nbytes for v in held) < 80 * len(words) + encode.n_bytes.nbytes


@pytest.mark.parametrize("alphabet", [1, 2, 65_535, 65_536, 70_000])
def test_files_of_any_alphabet_round_trip(alphabet):
    ids = np.random.default_rng(alphabet).zipf(1.2, 9000) % alphabet
    ids[:50] = alphabet - 1
    assert read(written(ids, [len(ids)], alphabet))[1] == ids.tolist()


def test_no_more_tasks_than_files_read_them(spark, monkeypatch):
    tasks, keep = {}, id_files.stored
    monkeypatch.setattr(
        id_files, "stored", lambda df, s, name: tasks.update({name: df.rdd.getNumPartitions()}) or keep(df, s, name)
    )
    files = id_files.write_ids(odd(spark), BYTE, f"file://{scratch_path(spark, 'ids')}", docs_per_file=100)
    id_files.read_ids(files)
    assert tasks["ids-read"] == 1


def test_the_rest_of_a_file_is_coded_side_by_side(monkeypatch):
    steps, learn = [], id_files.Mixer.learn
    monkeypatch.setattr(id_files.Mixer, "learn", lambda self, ids: steps.append(len(ids)) or learn(self, ids))
    ids = np.random.default_rng(9).integers(0, 50257, 2047)
    data = written(ids, [len(ids)])
    assert len(steps) < 100
    assert read(data)[1] == ids.tolist() and len(steps) < 200


def test_blocks_of_a_group_learn_from_each_other():
    cycle = np.random.default_rng(3).permutation(50257)[:4000]
    ids = np.tile(cycle, 20)
    data = written(ids, [len(ids)])
    assert read(data)[1] == ids.tolist()
    # The cycle is longer than a block: a block by itself would pay for each of its ids.
    assert len(data) < len(ids)


def test_id_files_over_many_files(spark):
    docs = odd(spark)
    folder = f"file://{scratch_path(spark, 'ids')}"
    files = id_files.write_ids(docs, BYTE, folder, docs_per_file=4)
    assert files.manifest.select("file").distinct().count() > 2
    got = sorted(id_files.read_ids(files).collect(), key=lambda r: r.start)
    place = 0
    for row in got:
        assert row.start == place
        place += row.n_tokens
    want = []
    for i, text in ODD:
        ids = np.array([*library_ids(BYTE, text), 0], dtype="<u4")
        want.append((i, len(ids), zlib.crc32(ids.tobytes())))
    assert plain((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == plain(want)
    known = [r.doc_id for r in got if r.doc_id is not None]
    assert known == sorted(known) and [r.doc_id for r in got][:2] == [None, None]
    assert id_files.id_round_trip(none(spark), BYTE).count() == 0
