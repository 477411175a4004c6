"""Cut Arrow text columns into pieces at byte level, without a Python object per piece."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The six ASCII white-space bytes.
ASCII_SPACES = (0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x20)

_SPACE = np.zeros(256, dtype=bool)
_SPACE[list(ASCII_SPACES)] = True
# A byte that may end some other space or control character: no cut after it. Refusing too many
# places costs nothing but a longer piece.
_UNSURE = np.zeros(256, dtype=bool)
_UNSURE[0x1C:0x20] = True
_UNSURE[[0x85, 0xA0, 0xA8, 0xA9, 0xAF, 0x9F]] = True
_UNSURE[0x80:0x8B] = True


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column in one array, and where each row starts (one entry more).

    NULL counts as empty.
    """
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    rows = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[rows[0] : rows[-1]], rows - rows[0]


def piece_bounds(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces start (one entry more), and the row of each piece. No piece spans two rows.

    Within a row, pieces start before a white-space byte that follows a character which is surely
    none. No pre-tokenizer of the public vocabularies lets a word run over such a place, and none
    looks back over it, so the parts can be encoded apart. Special tokens contain no white space.
    """
    starts = np.zeros(len(raw) + 1, dtype=bool)
    space = _SPACE[raw]
    starts[1:-1] = space[1:]
    starts[1:-1] &= ~space[:-1]
    starts[1:-1] &= ~_UNSURE[raw[:-1]]
    starts[rows] = True
    bounds = np.flatnonzero(starts)
    filled = np.flatnonzero(np.diff(rows))
    firsts = np.searchsorted(bounds, rows[filled])
    pieces = np.diff(np.append(firsts, len(bounds) - 1))
    return bounds, np.repeat(filled, pieces)


def byte_batches(raw: np.ndarray, bounds: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Runs of pieces (from, to) of about ``most`` bytes each; a longer piece is a run of its own."""
    at, last = 0, len(bounds) - 1
    while at < last:
        to = int(np.searchsorted(bounds, bounds[at] + most, side="right")) - 1
        to = min(max(to, at + 1), last)
        yield at, to
        at = to


def coded_pieces(
    raw: np.ndarray, bounds: np.ndarray, at: int, to: int
) -> tuple[np.ndarray, pa.LargeStringArray]:
    """Of the pieces ``at`` to ``to``: which distinct text each one is, and those texts."""
    start, stop = bounds[at], bounds[to]
    offsets = (bounds[at : to + 1] - start).astype(np.int64)
    array = pa.LargeStringArray.from_buffers(
        to - at, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(raw[start:stop]))
    )
    coded = array.dictionary_encode()
    return coded.indices.to_numpy(), coded.dictionary


def distinct_pieces(
    raw: np.ndarray, bounds: np.ndarray, at: int, to: int
) -> tuple[np.ndarray, list[str]]:
    """Like :func:`coded_pieces`, the texts as Python strings."""
    which, texts = coded_pieces(raw, bounds, at, to)
    return which, texts.to_pylist()


def by_bytes(part: pa.RecordBatch, column: int, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each."""
    sizes = pc.fill_null(pc.binary_length(part.column(column)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(sizes, dtype=np.int64) // most
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), part.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield part.slice(a, b - a)


def word_spans(raw: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and stops of the maximal runs without ASCII white space, none across two rows."""
    filled = np.zeros(len(raw) + 2, dtype=bool)
    filled[1:-1] = ~_SPACE[raw]
    # Texts touch in the buffer, so a word also ends where its text does.
    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[rows] = True
    starts = np.flatnonzero(filled[1:-1] & (edge[:-1] | ~filled[:-2]))
    stops = np.flatnonzero(filled[1:-1] & (edge[1:] | ~filled[2:])) + 1
    return starts, stops


def coded_spans(
    raw: np.ndarray, starts: np.ndarray, stops: np.ndarray
) -> tuple[np.ndarray, pa.LargeBinaryArray]:
    """Which distinct bytes each span holds, and those bytes."""
    edges = np.empty(2 * len(starts) + 1, dtype=np.int64)
    edges[0:-1:2], edges[1::2], edges[-1] = starts, stops, stops[-1] if len(stops) else 0
    array = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(),
        2 * len(starts),
        [None, pa.py_buffer(edges), pa.py_buffer(np.ascontiguousarray(raw))],
    )
    coded = array.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def span_codes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A number for each distinct span of bytes."""
    return coded_spans(raw, starts, stops)[0]


def lowered(raw: np.ndarray) -> np.ndarray:
    """Bytes with A to Z as small letters."""
    capital = (raw >= 65) & (raw <= 90)
    return np.where(capital, raw + np.uint8(32), raw)
