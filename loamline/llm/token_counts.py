"""Token counts of whole texts (operator 1)."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.pieces import by_bytes, byte_batches, distinct_pieces, piece_bounds, text_bytes
from loamline.llm.shared import arrow_map

BATCH_BYTES = 8 << 20
REMEMBERED = 400_000
LONGEST_REMEMBERED = 64

# The byte-level vocabulary's split pattern and its names for bytes.
BYTE_LEVEL_WORDS = regex.compile(
    r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
)
_NAMED = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_UNNAMED = [b for b in range(256) if b not in _NAMED]
BYTE_NAMES = {b: chr(b) for b in _NAMED} | {b: chr(256 + i) for i, b in enumerate(_UNNAMED)}

# Texts of these characters alone are split the same by every version of Unicode.
PLAIN = re.compile("[ \t\n\r!-~\u00a1-\u012f\u0131-\u017f]*")


def byte_names(text: str) -> str:
    """The text as the models see it: one character for each byte."""
    return text.encode().decode("latin-1").translate(BYTE_NAMES)


@lru_cache(maxsize=4)
def tokenizer(path: str):
    """The library's tokenizer, one per worker, without threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    loaded = Tokenizer.from_file(path)
    loaded.no_truncation()
    loaded.no_padding()
    return loaded


class PieceLengths:
    """Numbers of tokens by piece.

    A plain piece is split into words here and each word goes through the library's model; any other
    piece, and any with a special token in it, goes through the whole library. Words met before are
    looked up; how many are remembered has a bound, and beyond it words are encoded again.
    """

    def __init__(self, path: str):
        whole = tokenizer(path)
        self.encode, self.tokenize = whole.encode_batch_fast, whole.model.tokenize
        self.specials = tuple(t.content for t in whole.get_added_tokens_decoder().values())
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        n = self.known.get(word)
        if n is None:
            n = len(self.tokenize(byte_names(word)))
            if len(self.known) < REMEMBERED and len(word) <= LONGEST_REMEMBERED:
                self.known[word] = n
        return n

    def __call__(self, pieces: list[str]) -> np.ndarray:
        counts, rest, word = np.zeros(len(pieces), dtype=np.int64), [], self.word
        for i, piece in enumerate(pieces):
            if PLAIN.fullmatch(piece) and not any(s in piece for s in self.specials):
                counts[i] = sum(map(word, BYTE_LEVEL_WORDS.findall(piece)))
            else:
                rest.append(i)
        for at in range(0, len(rest), 20_000):
            part = rest[at : at + 20_000]
            found = self.encode([pieces[i] for i in part], add_special_tokens=False)
            counts[part] = [len(e) for e in found]
        return counts


def counted(raw: np.ndarray, rows: np.ndarray, lengths: PieceLengths, most: int) -> np.ndarray:
    """Tokens of each row of a batch; a row longer than ``most`` bytes is counted in parts."""
    bounds, row_of = piece_bounds(raw, rows)
    totals = np.zeros(len(rows) - 1, dtype=np.int64)
    for at, to in byte_batches(raw, bounds, most):
        which, pieces = distinct_pieces(raw, bounds, at, to)
        first, last = row_of[at], row_of[to - 1] + 1
        totals[first:last] += np.bincount(
            row_of[at:to] - first, weights=lengths(pieces)[which], minlength=last - first
        ).astype(np.int64)
    return totals


def token_counts(
    docs: DataFrame,
    path: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    over: int = 1024,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes (UTF-8), n_tokens, over_limit.

    Each Arrow batch is cut at safe places (:func:`safe_cuts`) and worked off in runs of equal bytes,
    so a long text is spread over several runs and only lengths come back. A piece that repeats
    within a run is encoded once. NULL and empty texts have no tokens; a NULL id stays NULL; repeated
    rows are counted each; other columns are ignored; an empty table gives an empty table.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = PieceLengths(path)
        for part in (cut for whole in parts for cut in by_bytes(whole, 1, batch_bytes)):
            raw, rows = text_bytes(part.column(1))
            tokens = counted(raw, rows, lengths, batch_bytes)
            columns = [part.column(0), pa.array(np.diff(rows)), pa.array(tokens)]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(tokens > over)],
                names=[id_column, "n_bytes", "n_tokens", "over_limit"],
            )

    chosen = docs.select(id_column, F.col(text_column).cast("string"))
    kind = docs.schema[id_column].dataType.simpleString()
    return arrow_map(
        chosen,
        batches, f"`{id_column}` {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean"
    )
