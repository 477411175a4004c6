"""Byte-pair encoding over fragments at forced boundaries, and decoding (operator 5)."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from loamline.llm.pieces import by_bytes, byte_batches, distinct_pieces, piece_bounds, text_bytes
from loamline.llm.shared import arrow_map
from loamline.llm.token_counts import PLAIN, byte_names, tokenizer

# Texts are worked off in slices of about so many bytes: cutting takes several times their size.
BATCH_BYTES = 1 << 20
# What a worker remembers stays as long as it lives, so each of its tables has a bound: some 350 bytes an entry.
REMEMBERED_WORDS, REMEMBERED_PIECES, REMEMBERED_FRAGMENTS = 100_000, 40_000, 40_000

# Fixed value: the word vocabulary's split pattern.
WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


class FragmentEncoder:
    """Ids of a piece of text, by way of fragments that are encoded apart.

    Two neighbouring bytes that stand next to each other in no token of the vocabulary can never end
    up in one token: every merge makes a token. The place between them is a certain cut. A word is
    cut at all such places; the last fragment carries the word's end, the others have none, so they
    go to a second model without the suffix. Concatenated, their ids are those of the whole word.
    """

    def __init__(self, path: str):
        from tokenizers import models

        self.whole = tokenizer(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ends = self.whole.model
        self.inner = models.BPE(vocab=vocab, merges=merges)
        self.specials = [t["content"] for t in spec["added_tokens"]]
        bare = (t.removesuffix(suffix) if suffix else t for t in vocab)
        self.joined = {t[i : i + 2] for t in bare for i in range(len(t) - 1)}
        self.names = {i: t for t, i in vocab.items()}
        self.names.update({t["id"]: t["content"] for t in spec["added_tokens"]})
        self.fragments: dict[tuple[str, bool], list[int]] = {}

    def cut(self, word: str) -> list[str]:
        """Fragments of a word whose characters stand for bytes."""
        joined, parts, start = self.joined, [], 0
        for i in range(1, len(word)):
            if word[i - 1 : i + 1] not in joined:
                parts.append(word[start:i])
                start = i
        parts.append(word[start:])
        return parts

    def fragment(self, text: str, end: bool) -> list[int]:
        ids = self.fragments.get((text, end))
        if ids is None:
            model = self.ends if end else self.inner
            ids = [t.id for t in model.tokenize(text)]
            if len(self.fragments) < REMEMBERED_FRAGMENTS and len(text) <= 32:
                self.fragments[text, end] = ids
        return ids

    def words(self, piece: str) -> list[str]:
        if PLAIN.fullmatch(piece):  # there the library's steps come to this
            return [byte_names(word) for word in WORDS.findall(piece.lower())]
        text = self.whole.normalizer.normalize_str(piece)
        return [word for word, _ in self.whole.pre_tokenizer.pre_tokenize_str(text)]

    def word(self, word: str) -> list[int]:
        """Ids of a word whose characters stand for bytes."""
        *inner, last = self.cut(word)
        ids: list[int] = []
        for part in inner:
            ids += self.fragment(part, False)
        return ids + self.fragment(last, True)

    def special(self, piece: str) -> list[int] | None:
        """Ids of a piece that holds a special string, as the library finds it."""
        if any(s in piece for s in self.specials):
            return self.whole.encode(piece, add_special_tokens=False).ids
        return None

    def __call__(self, piece: str) -> list[int]:
        ids = self.special(piece)
        return [i for word in self.words(piece) for i in self.word(word)] if ids is None else ids

    def decoded(self, ids: list[int]) -> str:
        """The library's decoding without a decoder step: names of the tokens, one space between."""
        return " ".join(self.names[i] for i in ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> FragmentEncoder:
    return FragmentEncoder(path)


# Number of ids, the ids as text, and the decoded text.
Entry = tuple[int, bytes, bytes]


class PieceTable:
    """For each distinct piece its entry, put together from those of its words.

    Words differ less than pieces, which hold capitals and marks as well, so both are remembered.
    """

    def __init__(self, path: str):
        self.encode = encoder(path)
        self.known: dict[str, Entry] = {}
        self.plain: dict[str, Entry] = {}
        self.named: dict[str, Entry] = {}

    def entry(self, ids: list[int]) -> Entry:
        return len(ids), " ".join(map(str, ids)).encode(), self.encode.decoded(ids).encode()

    def word(self, word: str, memory: dict[str, Entry], name: Callable[[str], str]) -> Entry:
        entry = self.entry(self.encode.word(name(word)))
        if len(word) <= 32 and len(memory) < REMEMBERED_WORDS:
            memory[word] = entry
        return entry

    def piece(self, key: str) -> Entry:
        ids = self.encode.special(key)
        if ids is not None:
            return self.entry(ids)
        if PLAIN.fullmatch(key):  # there the library's steps come to this
            memory, name, words = self.plain, byte_names, WORDS.findall(key.lower())
        else:
            memory, name, words = self.named, str, self.encode.words(key)
        parts = [memory.get(w) or self.word(w, memory, name) for w in words]
        if len(parts) == 1:
            return parts[0]
        return sum([p[0] for p in parts]), b" ".join([p[1] for p in parts]), b" ".join([p[2] for p in parts])

    def __call__(self, pieces: list[str]) -> list[Entry]:
        known = self.known
        out = []
        for piece in pieces:
            key = piece.strip(" \n")
            entry = known.get(key)
            if entry is None:
                entry = self.piece(key)
                if len(key) <= 64 and len(known) < REMEMBERED_PIECES:
                    known[key] = entry
            out.append(entry)
        return out


@lru_cache(maxsize=1)
def piece_table(path: str) -> PieceTable:
    """One table for all tasks of a worker."""
    return PieceTable(path)


def digests(
    raw: np.ndarray, rows: np.ndarray, table: PieceTable, most: int
) -> tuple[np.ndarray, list[str], list[str]]:
    """Per row: number of ids, digest of the ids, digest of the decoded text."""
    bounds, row_of = piece_bounds(raw, rows)
    n = len(rows) - 1
    totals = np.zeros(n, dtype=np.int64)
    ids, texts = ([hashlib.sha256() for _ in range(n)] for _ in range(2))
    for at, to in byte_batches(raw, bounds, most):
        which, pieces = distinct_pieces(raw, bounds, at, to)
        entries = table(pieces)
        # A piece of nothing but spaces has no ids and leaves no separator.
        filled = np.fromiter((e[0] > 0 for e in entries), bool, len(entries))[which]
        which, owner = which[filled], row_of[at:to][filled]
        cuts = np.flatnonzero(np.diff(owner)) + 1
        starts = np.concatenate([[0], cuts]) if len(owner) else []
        stops = np.concatenate([cuts, [len(owner)]]) if len(owner) else []
        order = which.tolist()
        for start, stop in zip(starts, stops):
            row = owner[start]
            own = [entries[i] for i in order[start:stop]]
            if totals[row]:
                ids[row].update(b" ")
                texts[row].update(b" ")
            ids[row].update(b" ".join([e[1] for e in own]))
            texts[row].update(b" ".join([e[2] for e in own]))
            totals[row] += sum([e[0] for e in own])
    return totals, [h.hexdigest() for h in ids], [h.hexdigest() for h in texts]


def bpe_round_trip(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256.

    Ids and decoded text are those of the tokenizers library without added special tokens. NULL and
    empty texts have no ids and the digest of the empty string; a NULL id stays NULL; repeated rows
    come out as often; other columns are ignored; an empty table gives an empty table.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_table(path)
        for part in (cut for whole in parts for cut in by_bytes(whole, 1, batch_bytes)):
            raw, rows = text_bytes(part.column(1))
            tokens, ids, texts = digests(raw, rows, table, batch_bytes)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(tokens), pa.array(ids, pa.string()), pa.array(texts, pa.string())],
                names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    chosen = docs.select(id_column, F.col(text_column).cast("string"))
    kind = docs.schema[id_column].dataType.simpleString()
    return arrow_map(
        chosen,
        batches, f"`{id_column}` {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    )


def encoded(
    docs: DataFrame, path: str, text_column: str = "text", to: str = "token_ids"
) -> DataFrame:
    """``docs`` with the ids of each text as a column ``to`` (array of int; empty for NULL)."""
    schema = docs.drop(to).schema.add(to, ArrayType(IntegerType()))

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, at = piece_table(path), schema.names.index(text_column)
        for part in (cut for whole in parts for cut in by_bytes(whole, at, BATCH_BYTES)):
            raw, rows = text_bytes(part.column(at))
            ids = _row_ids(raw, rows, table)
            yield pa.RecordBatch.from_arrays(
                [*part.columns, ids], names=[*part.schema.names, to]
            )

    return arrow_map(docs.drop(to), batches, schema)


def _row_ids(raw: np.ndarray, rows: np.ndarray, table: PieceTable) -> pa.Array:
    bounds, row_of = piece_bounds(raw, rows)
    totals, flat = np.zeros(len(rows) - 1, dtype=np.int64), []
    for at, to in byte_batches(raw, bounds, BATCH_BYTES):
        which, pieces = distinct_pieces(raw, bounds, at, to)
        entries = table(pieces)
        own = [np.array(e[1].split(), dtype=np.int32) for e in entries]
        sizes = np.fromiter((e[0] for e in entries), np.int64, len(entries))[which]
        flat += [own[i] for i in which.tolist()]
        totals += np.bincount(row_of[at:to], weights=sizes, minlength=len(totals)).astype(np.int64)
    values = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32)
    offsets = np.concatenate([[0], np.cumsum(totals)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))
