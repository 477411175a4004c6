"""Quality rules: fixed counts, and line labels by a linear-chain conditional random field (operator 3)."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loamline.llm.pieces import by_bytes, span_codes, text_bytes, word_spans
from loamline.llm.shared import arrow_map

# Fixed values of the base rules.
SYMBOLS = b"#*$%&|<>"
LEAST_WORDS = 10
MOST_REPEATED_PERCENT = 20
WINDOW = 5

CONTENT, BOILERPLATE = 0, 1
LEAST_CONTENT_SHARE = 0.5
TRAINING_ROWS = 4_000
# Of a training text so many lines are gathered at most; judged texts have no such bound.
TRAINING_LINES = 400
BATCH_BYTES = 1 << 20

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[ord("A") : ord("Z") + 1] = True
_LOWER = np.zeros(256, dtype=bool)
_LOWER[ord("a") : ord("z") + 1] = True
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[ord("0") : ord("9") + 1] = True
_END = np.zeros(256, dtype=bool)
_END[list(b".!?")] = True
_ODD = np.zeros(256, dtype=bool)
_ODD[list(b"!|{}[]\\^~_=+@/")] = True

# Line features are cut into classes at these bounds; each class is one binary feature of the field.
FEATURES = {
    "words": (1, 2, 4, 8, 16, 32),
    "word_length": (2, 3, 4, 5, 6, 8, 12),
    "symbols_per_word": (0.01, 0.1, 0.3, 0.6, 1.0),
    "odd_per_word": (0.01, 0.1, 0.3, 0.6, 1.0),
    "upper_share": (0.02, 0.1, 0.3, 0.6),
    "digit_share": (0.01, 0.05, 0.2, 0.5),
    "end_marks_per_word": (0.02, 0.05, 0.1, 0.3, 0.8),
    "repeats": (0.5,),
    "repeated_words": (0.05, 0.1, 0.2, 0.5),
    "stutters": (0.01, 0.05, 0.2, 0.4),
}
CLASSES = [len(bounds) + 1 for bounds in FEATURES.values()]
OFFSETS = np.concatenate([[0], np.cumsum(CLASSES)[:-1]])


def _sums(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the flags between neighbouring bounds."""
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return total[bounds[1:]] - total[bounds[:-1]]


@dataclass
class Measured:
    """Counts per text of a batch, and the lines with a word: text of each line, feature classes."""

    words: np.ndarray
    word_chars: np.ndarray
    symbols: np.ndarray
    dup_lines: np.ndarray
    repeat_words: np.ndarray
    line_row: np.ndarray
    line_words: np.ndarray
    classes: np.ndarray

    @property
    def base_failed(self) -> np.ndarray:
        return (self.words < LEAST_WORDS) | (
            100 * self.repeat_words > MOST_REPEATED_PERCENT * self.words
        )


def _renumber(values: np.ndarray) -> np.ndarray:
    return pd.factorize(values)[0].astype(np.int64)


def _repeated(word_row: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Which words lie in a five-word window that occurs at least twice in the same text.

    A window can only repeat where each of its four pairs of words repeats, which few do; those
    windows are then numbered exactly, pair by pair.
    """
    inside = np.zeros(len(codes), dtype=bool)
    n = len(codes) - WINDOW + 1
    if n < 1:
        return inside
    many = int(codes.max()) + 1
    pairs = _renumber(codes[:-1] * many + codes[1:])
    own = _renumber(word_row[:-1] * (int(pairs.max()) + 1) + pairs)
    again = (np.bincount(own)[own] > 1) & (word_row[:-1] == word_row[1:])
    at = np.flatnonzero(again[:n] & again[1 : n + 1] & again[2 : n + 2] & again[3 : n + 3])
    if len(at) == 0:
        return inside
    wide = int(own.max()) + 1
    fours = _renumber(own[at] * wide + own[at + 2])
    fives = _renumber(fours * many + codes[at + WINDOW - 1])
    twice = at[np.bincount(fives)[fives] > 1]
    for k in range(WINDOW):
        inside[twice + k] = True
    return inside


def measured(raw: np.ndarray, rows: np.ndarray) -> Measured:
    n = len(rows) - 1
    starts, stops = word_spans(raw, rows)
    word_row = np.searchsorted(rows, starts, side="right") - 1
    codes = span_codes(raw, starts, stops)
    repeated = _repeated(word_row, codes)
    lead = (raw & 0xC0) != 0x80
    chars = np.concatenate([[0], np.cumsum(lead, dtype=np.int64)])
    word_chars = chars[stops] - chars[starts]

    edge = np.zeros(len(raw) + 1, dtype=bool)
    edge[rows] = True
    edge[1:] |= raw == 0x0A
    line_starts = np.flatnonzero(edge[:-1])
    line_row = np.searchsorted(rows, line_starts, side="right") - 1
    bounds = np.append(line_starts, len(raw))
    word_line = np.searchsorted(line_starts, starts, side="right") - 1
    line_words = np.bincount(word_line, minlength=len(line_starts))
    used = np.flatnonzero(line_words > 0)
    line_stops = bounds[1:] - (raw[bounds[1:] - 1] == 0x0A)
    line_codes = span_codes(raw, line_starts[used], line_stops[used])
    keys = line_row[used] * (int(line_codes.max()) + 1 if len(used) else 1) + line_codes
    first = np.zeros(len(used), dtype=bool)
    first[np.unique(keys, return_index=True)[1]] = True
    repeats = ~first

    def per_line(values: np.ndarray) -> np.ndarray:
        return _sums(values, bounds)[used].astype(float)

    n_words = line_words[used].astype(float)
    letters = np.maximum(per_line(_UPPER[raw]) + per_line(_LOWER[raw]), 1)
    length = np.bincount(word_line, weights=word_chars, minlength=len(line_starts))[used]
    again = np.bincount(word_line, weights=repeated, minlength=len(line_starts))[used]
    same = np.zeros(len(codes), dtype=bool)
    same[1:] = (codes[1:] == codes[:-1]) & (word_line[1:] == word_line[:-1])
    stutters = np.bincount(word_line, weights=same, minlength=len(line_starts))[used]
    values = (
        n_words,
        length / n_words,
        per_line(_SYMBOL[raw]) / n_words,
        per_line(_ODD[raw]) / n_words,
        per_line(_UPPER[raw]) / letters,
        per_line(_DIGIT[raw]) / np.maximum(length, 1),
        per_line(_END[raw]) / n_words,
        repeats.astype(float),
        again / n_words,
        stutters / n_words,
    )
    classes = np.stack(
        [
            offset + np.searchsorted(np.asarray(cuts, dtype=float), v, side="right")
            for offset, cuts, v in zip(OFFSETS, FEATURES.values(), values)
        ],
        axis=1,
    )

    def per_row(row: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        return np.bincount(row, weights=weights, minlength=n).astype(np.int64)

    return Measured(
        words=per_row(word_row),
        word_chars=per_row(word_row, word_chars),
        symbols=_sums(_SYMBOL[raw], rows),
        dup_lines=per_row(line_row[used], repeats),
        repeat_words=per_row(word_row, repeated),
        line_row=line_row[used],
        line_words=line_words[used],
        classes=classes,
    )


@dataclass(frozen=True)
class LineField:
    """A linear-chain conditional random field over the lines of a text, with two labels.

    ``states[label, feature]`` and ``moves[from, to]`` are its weights.
    """

    states: np.ndarray
    moves: np.ndarray

    def scores(self, classes: np.ndarray) -> np.ndarray:
        return self.states[:, classes].sum(axis=2).T

    def label(self, line_row: np.ndarray, classes: np.ndarray) -> np.ndarray:
        """Viterbi decoding of all texts of a batch at once, one line of each text per step."""
        scores, labels = self.scores(classes), np.zeros(len(line_row), dtype=np.int64)
        for at in _in_steps(line_row):
            best, back = None, []
            for lines in at:
                if best is None:
                    best = scores[lines]
                    continue
                paths = best[: len(lines), :, None] + self.moves[None]
                back.append(paths.argmax(axis=1))
                best = np.concatenate([paths.max(axis=1) + scores[lines], best[len(lines) :]])
            chosen = best.argmax(axis=1)
            for step in range(len(at) - 1, -1, -1):
                lines = at[step]
                labels[lines] = chosen[: len(lines)]
                if step:
                    previous = back[step - 1][np.arange(len(lines)), chosen[: len(lines)]]
                    chosen = np.concatenate([previous, chosen[len(lines) :]])
        return labels


def _in_steps(line_row: np.ndarray) -> Iterator[list[np.ndarray]]:
    """The first lines of all texts, the second lines and so on; texts with most lines come first.

    The texts with a k-th line then are a prefix of those with a (k-1)-th.
    """
    if len(line_row) == 0:
        return
    _, first, sizes = np.unique(line_row, return_index=True, return_counts=True)
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    yield [first[: np.searchsorted(-sizes, -k, side="left")] + k for k in range(sizes[0])]


def fit(
    texts: list[tuple[np.ndarray, np.ndarray]], rounds: int = 150, rate: float = 0.1, ridge: float = 1e-3
) -> LineField:
    """Maximise the conditional likelihood over (feature classes, labels) of labelled texts.

    Gradients come from the forward-backward pass over all texts side by side; the steps are Adam's.
    Nothing is drawn at random, so equal samples give equal weights.
    """
    n_features = int(sum(CLASSES))
    params = np.zeros(2 * n_features + 4)
    if not texts:
        return LineField(params[: 2 * n_features].reshape(2, -1), params[2 * n_features :].reshape(2, 2))
    row = np.repeat(np.arange(len(texts)), [len(y) for _, y in texts])
    classes, gold = np.concatenate([c for c, _ in texts]), np.concatenate([y for _, y in texts])
    (steps,) = _in_steps(row)
    within = [i for i in range(1, len(row)) if row[i] == row[i - 1]]
    seen_moves = np.zeros((2, 2))
    np.add.at(seen_moves, (gold[np.array(within, dtype=int) - 1], gold[within]), 1)
    mean, spread = np.zeros_like(params), np.zeros_like(params)
    for t in range(1, rounds + 1):
        states = params[: 2 * n_features].reshape(2, -1)
        moves = params[2 * n_features :].reshape(2, 2)
        scores = states[:, classes].sum(axis=2).T
        ahead, behind = np.zeros_like(scores), np.zeros_like(scores)
        for k, lines in enumerate(steps):
            ahead[lines] = scores[lines]
            if k:
                ahead[lines] += np.logaddexp.reduce(ahead[lines - 1][:, :, None] + moves, axis=1)
        for k in range(len(steps) - 1, 0, -1):
            lines = steps[k]
            behind[lines - 1] = np.logaddexp.reduce(
                moves + (scores[lines] + behind[lines])[:, None, :], axis=2
            )
        total = np.logaddexp.reduce(ahead + behind, axis=1)
        share = np.exp(ahead + behind - total[:, None])
        wrong = -share
        wrong[np.arange(len(gold)), gold] += 1
        slope = np.zeros((2, n_features))
        for label in (CONTENT, BOILERPLATE):
            for column in classes.T:
                slope[label] += np.bincount(column, weights=wrong[:, label], minlength=n_features)
        expected = np.zeros((2, 2))
        for lines in steps[1:]:
            joint = (
                ahead[lines - 1][:, :, None]
                + moves
                + (scores[lines] + behind[lines])[:, None, :]
                - total[lines][:, None, None]
            )
            expected += np.exp(joint).sum(axis=0)
        gradient = np.concatenate([slope.ravel(), (seen_moves - expected).ravel()]) / len(gold)
        gradient -= ridge * params
        mean = 0.9 * mean + 0.1 * gradient
        spread = 0.999 * spread + 0.001 * gradient**2
        params = params + rate * (mean / (1 - 0.9**t)) / (np.sqrt(spread / (1 - 0.999**t)) + 1e-8)
    return LineField(params[: 2 * n_features].reshape(2, -1), params[2 * n_features :].reshape(2, 2))


LABEL_SCHEMA = "quality int, classes binary"


def training_lines(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> DataFrame:
    """Feature classes of the first lines of at most ``rows`` labelled documents, chosen by a hash of the id.

    No table labels lines: a line of a document of good quality counts as content, one of a
    document of bad quality as boilerplate. See :func:`spliced` for texts that hold both.
    """
    known = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    chosen = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(
        F.broadcast(known), "doc_id"
    )

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (cut for whole in parts for cut in by_bytes(whole, 1, BATCH_BYTES)):
            raw, bounds = text_bytes(part.column(1))
            found = measured(raw, bounds)
            cuts = np.searchsorted(found.line_row, np.arange(part.num_rows + 1))
            lines = [
                found.classes[a : min(b, a + TRAINING_LINES)].astype(np.uint8).tobytes()
                for a, b in zip(cuts[:-1], cuts[1:])
            ]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(lines, pa.binary())], names=["quality", "classes"]
            )

    return arrow_map(chosen.select("quality", "text"), batches, LABEL_SCHEMA)


Labelled = tuple[np.ndarray, np.ndarray]


def spliced(texts: list[Labelled]) -> list[Labelled]:
    """Texts with lines of both labels, from texts with lines of one.

    The k-th good and the k-th bad text (the shorter list from its start again) give two texts: the good
    one with a run of one to eight of the bad one's lines inside, and the bad one with a run of the good
    one's. Places and lengths follow from k. In these texts the label changes, so the field learns how
    often it does, and that a line's own features decide.
    """
    good = [t for t in texts if t[1][0] == CONTENT]
    bad = [t for t in texts if t[1][0] == BOILERPLATE]
    if not good or not bad:
        return []
    out = []
    for k in range(max(len(good), len(bad))):
        one, other = good[k % len(good)], bad[k % len(bad)]
        for (outer, label), (inner, insert) in ((one, other), (other, one)):
            size = 1 + 7919 * k % min(8, len(inner))
            start = 104729 * k % (len(inner) - size + 1)
            at = 15485863 * k % (len(outer) + 1)
            run = slice(start, start + size)
            out.append(
                (
                    np.concatenate([outer[:at], inner[run], outer[at:]]),
                    np.concatenate([label[:at], insert[run], label[at:]]),
                )
            )
    return out


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> LineField:
    """Fit the field on a bounded sample of labelled documents and on texts spliced from them; only
    feature numbers are gathered, of a bounded number of lines.

    Without labelled documents all weights are zero, and then every line counts as content.
    """
    texts: list[Labelled] = []
    for row in training_lines(docs, labels, rows).orderBy("classes", "quality").collect():
        classes = np.frombuffer(row.classes, dtype=np.uint8).reshape(-1, len(CLASSES)).astype(int)
        if len(classes):
            texts.append((classes, np.full(len(classes), 1 - row.quality)))
    return fit(texts + spliced(texts))


def quality(
    docs: DataFrame,
    field: LineField,
    id_column: str = "doc_id",
    text_column: str = "text",
    least_share: float = LEAST_CONTENT_SHARE,
) -> DataFrame:
    """One row per row of ``docs`` with base counts, content share and verdict.

    Columns: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept,
    n_lines, content_share. Kept are texts that pass the base rules and of whose words at least
    ``least_share`` stand on lines that the field labels content. NULL and empty texts have no words
    and fail; a NULL id stays NULL; repeated rows come out as often; other columns are ignored; an
    empty table gives an empty table.
    """

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            yield from (_judged(cut, field, id_column, least_share) for cut in by_bytes(part, 1, BATCH_BYTES))

    kind = docs.schema[id_column].dataType.simpleString()
    return arrow_map(
        docs.select(id_column, F.col(text_column).cast("string")),
        batches,
        f"`{id_column}` {kind}, n_words bigint, word_chars bigint, n_symbols bigint, "
        "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
        "n_lines bigint, content_share double",
    )


def kept(
    docs: DataFrame,
    field: LineField,
    text_column: str = "text",
    least_share: float = LEAST_CONTENT_SHARE,
) -> DataFrame:
    """The rows of ``docs`` whose verdict is to keep them (see :func:`quality`), all columns as they are."""

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            at = part.schema.get_field_index(text_column)
            for cut in by_bytes(part, at, BATCH_BYTES):
                verdict = _judged(pa.RecordBatch.from_arrays([cut.column(at)] * 2, names=["a", "b"]), field, "a", least_share)
                yield cut.filter(verdict.column("kept"))

    return arrow_map(docs, batches, docs.schema)


def _judged(
    part: pa.RecordBatch, field: LineField, id_column: str, least_share: float
) -> pa.RecordBatch:
    raw, rows = text_bytes(part.column(1))
    found, n = measured(raw, rows), part.num_rows
    content = field.label(found.line_row, found.classes) == CONTENT
    good = np.bincount(found.line_row[content], weights=found.line_words[content], minlength=n)
    share = good / np.maximum(found.words, 1)
    failed = found.base_failed
    columns = {
        id_column: part.column(0),
        "n_words": pa.array(found.words),
        "word_chars": pa.array(found.word_chars),
        "n_symbols": pa.array(found.symbols),
        "n_dup_lines": pa.array(found.dup_lines),
        "n_repeat_words": pa.array(found.repeat_words),
        "base_failed": pa.array(failed),
        "kept": pa.array(~failed & (share >= least_share)),
        "n_lines": pa.array(np.bincount(found.line_row, minlength=n)),
        "content_share": pa.array(share),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))
