"""Token ids in compressed binary files: an adaptive context-mixing range coder (operator 8)."""

from __future__ import annotations

import itertools
import re
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from typing import BinaryIO

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loamline.llm.pieces import by_bytes, byte_batches, coded_pieces, piece_bounds, text_bytes
from loamline.llm.shared import arrow_map, stored
from loamline.llm.token_counts import BATCH_BYTES, BYTE_NAMES, tokenizer
from loamline.session import scratch_path

BLOCK_IDS = 2048
# Blocks that are coded side by side as a group, one array element each.
ABREAST = 4096
DOCS_PER_FILE = 4_000
BYTES_PER_FILE = 16 << 20

# Ids at a file's end that fill no block go into blocks of so many, side by side.
SHORT_BLOCK = 32

# Plain pieces that can be cut into words together: no word runs over such a place.
_PLAIN_MARKS = "!-~\u00a1-\u012f\u0131-\u017f"
JOINED = rf"\A[ \t\n\r][ \t\n\r{_PLAIN_MARKS}]*[{_PLAIN_MARKS}]\z"
# BYTE_LEVEL_WORDS for plain texts, where its classes hold these characters alone.
_LETTERS = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
_NUMBERS = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
PLAIN_WORDS = re.compile(
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^\s{_LETTERS}{_NUMBERS}]+|\s+(?!\S)|\s+"
)
# The classes of plain characters: white space, letters, numbers, others.
_CLASSES = [r"\s", f"[{_LETTERS}]", f"[{_NUMBERS}]", "."]
CLASS_OF = np.array([next(k for k, c in enumerate(_CLASSES) if re.match(c, chr(i), re.S)) for i in range(0x180)])
# What a contraction may be, in code points after the apostrophe.
SHORT_ENDS = [[ord(c) for c in end] for end in ("s", "t", "m", "d", "re", "ve", "ll")]
LONGEST_PLAIN = 256
# How many words go to the library at a time, and how many a worker remembers (some 60 bytes each).
TOGETHER, REMEMBERED_WORDS = 2000, 1_000_000
# The names of bytes as code points.
BYTE_CODES, LINE_END = np.array([ord(BYTE_NAMES[b]) for b in range(256)], dtype="<u4"), 10
# A byte's factor in a word's hash, by its place.
FACTORS = np.random.default_rng(8).integers(1 << 64, size=512, dtype=np.uint64, endpoint=False) | np.uint64(1)

MAGIC = b"LLID0004"
HEAD, FRAME, TAIL = struct.Struct("<II"), struct.Struct("<III"), struct.Struct("<QQI")
TOTAL_BITS = 24
TOTAL = 1 << TOTAL_BITS
# Order 0 keeps at least this part of the range, so that every id can be coded at any time.
RESERVED = 1 << 22
ORDER_0_BITS = 18
HASH_BITS = 16
ID_BITS = 28
ID_MASK = (1 << ID_BITS) - 1
MOST_TRIES = 1 << 20
# Shares of the range are set anew after each of the first steps, then after so many; then one step in four is counted.
SHARE_STEPS, TRIED_STEPS = 16, 4
PAIR_FACTOR, PAIR_SHIFT = np.uint32(2654435761), np.uint32(32 - HASH_BITS)
_WORD = np.uint64(32)
_LOW = np.uint64((1 << 32) - 1)
_BOTTOM = np.uint64(1 << 32)


class Mixer:
    """The model that coder and decoder keep alike, for a group of blocks side by side.

    Order 0 is a table of counts (of one step in four), summed up anew at set places. Orders 1 and 2 remember the id that
    followed one or two ids (order 2 by hashed context) and how often in a row it was right, its
    standing. The three predictions are mixed: the two guesses get shares of the range by how often
    guesses of that pair of standings have been right in this group until lately, the rest goes by order 0.
    All numbers are whole, and the only fractions are quotients below 2**42, rounded down, which are
    exact in double precision, so every machine codes alike. All blocks of a group teach one model,
    step by step; where several teach the same slot, the last one's guess stays. A new object knows
    nothing: groups are independent.
    """

    def __init__(self, blocks: int, alphabet: int, length: int):
        if not 0 < alphabet < ID_MASK:
            raise ValueError("no ids, or too many")
        self.alphabet = alphabet
        self.bits = max(ORDER_0_BITS, alphabet.bit_length() + 2)
        self.counts = np.zeros(alphabet, dtype=np.int64)
        self.waiting: list[np.ndarray] = []
        self.places = {1 << k for k in range(2, 40)} | set(range(256, length + 1, 256))
        self.refresh()
        # A slot holds its standing (0 for none) and the id plus one: first a slot for each id, then for pairs.
        self.table = np.zeros(alphabet + (1 << HASH_BITS), dtype=np.int32)
        self.slot = np.zeros((2, blocks), dtype=np.int64)
        self.tries = np.ones((3, 16), dtype=np.int64)  # order 2 was right, order 1 was, none was
        self.outcomes: list[np.ndarray] = []
        self.share()
        self.older = np.zeros(blocks, dtype=np.uint32)
        self.seen = 0

    def refresh(self) -> None:
        whole, total = 1 << self.bits, int(self.counts.sum())
        spread = self.counts * (whole - self.alphabet) // max(total, 1)
        self.below = np.zeros(self.alphabet + 1, dtype=np.int32)
        np.cumsum(spread + (1 if total else whole // self.alphabet), out=self.below[1:])
        self.below[-1] = whole
        self.above = self.below[1:]
        narrow = np.uint16 if self.alphabet < 1 << 16 else np.int32
        self.owner = np.repeat(np.arange(1, self.alphabet + 1, dtype=narrow), np.diff(self.below))

    def share(self) -> None:
        right, less, wrong = self.tries
        self.for_two, self.for_one = (TOTAL - RESERVED) * self.tries[:2] // (right + less + wrong)
        self.for_both = self.for_two + self.for_one

    def predict(self) -> None:
        """Set slots, guesses (plus one, 0 where there is none) and shares for the next id."""
        own = self.slot[0].astype(np.uint32) * PAIR_FACTOR
        np.add(own + self.older >> PAIR_SHIFT, self.alphabet, out=self.slot[1], casting="unsafe")
        self.older = own * PAIR_FACTOR
        values = self.table.take(self.slot)
        self.guess = values & ID_MASK
        self.standing = (values >> ID_BITS).astype(np.uint8)
        by_one, by_two = self.standing
        self.kind = by_two * 4 + by_one
        kind = self.kind.astype(np.int64)
        self.second, self.both = self.for_two.take(kind), self.for_both.take(kind)
        self.rest = TOTAL - self.both

    def part(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the parts of ids begin within the range, and their sizes."""
        self.fresh = ids.astype(np.int32) + 1
        self.hits = self.guess == self.fresh
        less, right = self.hits
        start = self.below.take(ids) * self.rest >> self.bits
        size = (self.above.take(ids) * self.rest >> self.bits) - start
        start = np.where(less, self.second, start + self.both)
        size = np.where(less, self.both - self.second, size)
        return np.where(right, 0, start), np.where(right, self.second, size)

    def find(self, at: np.ndarray) -> np.ndarray:
        """The ids whose parts hold the given places."""
        left = np.maximum(at - self.both, 0)
        place = (((left + 1 << self.bits) - 1) / self.rest).astype(np.int64)
        guessed = np.where(at < self.both, self.guess[0], self.owner.take(place, mode="clip"))
        ids = np.where(at < self.second, self.guess[1], guessed).astype(np.int64) - 1
        return np.maximum(ids, 0)  # only damaged data has a place where there is no guess

    def learn(self, ids: np.ndarray) -> None:
        """Take in the ids last given to :meth:`part`."""
        early, hits = self.seen < SHARE_STEPS, self.hits.view(np.uint8)
        less, right = hits
        if early or self.seen % TRIED_STEPS == 0:
            self.outcomes.append(self.kind + (right << 4) + (less << 5))
            self.waiting.append(ids)
        standing = np.minimum(self.standing * hits, 2) + 1
        self.table[self.slot] = (standing.astype(np.int32) << ID_BITS) + self.fresh
        self.slot[0] = ids
        self.seen += 1
        if early or self.seen % SHARE_STEPS == 0:
            outcome = np.bincount(np.concatenate(self.outcomes), minlength=64).reshape(2, 2, 16)
            self.outcomes = []
            self.tries += np.stack([outcome[0, 1] + outcome[1, 1], outcome[1, 0], outcome[0, 0]])
            if self.tries.max() > MOST_TRIES:
                self.tries = self.tries + 1 >> 1
            self.share()
        if self.seen in self.places:
            self.counts += np.bincount(np.concatenate(self.waiting), minlength=self.alphabet)
            self.waiting = []
            self.refresh()


def encode_blocks(ids: np.ndarray, alphabet: int) -> list[bytes]:
    """Range-code the rows of ``ids`` (blocks of equal length), which learn from each other."""
    blocks, length = ids.shape
    mixer = Mixer(blocks, alphabet, length)
    low = np.zeros(blocks, dtype=np.uint64)
    span = np.full(blocks, np.iinfo(np.uint64).max, dtype=np.uint64)
    out = np.zeros((length + 4) * blocks, dtype=np.uint32)
    free = np.arange(blocks)
    for column in np.ascontiguousarray(ids.T, dtype=np.int32):
        column = column.astype(np.int64)
        mixer.predict()
        start, size = mixer.part(column)
        part = span >> np.uint64(TOTAL_BITS)
        low += part * start.view(np.uint64)
        span = part * size.view(np.uint64)
        rows = np.flatnonzero(span < _BOTTOM)
        if len(rows):
            place = free[rows]
            out[place] = low[rows] >> _WORD
            free[rows] = place + blocks
            _shift(low, span, rows)
        mixer.learn(column)
    for word in (low >> _WORD, low & _LOW):
        out[free] = word
        free += blocks
    return [row[:n].astype("<u4").tobytes() for row, n in zip(out.reshape(-1, blocks).T, free // blocks)]


def _shift(low: np.ndarray, span: np.ndarray, rows: np.ndarray) -> None:
    """Go on with the next word in blocks whose span is below a word.

    Mostly the upper word is settled; where it is not, the span is cut to the word's end first.
    """
    own, left = low[rows], span[rows]
    settled = (own >> _WORD) == ((own + (left - np.uint64(1))) >> _WORD)
    left = np.where(settled, left, (np.uint64(0) - own) & _LOW)
    low[rows], span[rows] = own << _WORD, left << _WORD


def decode_blocks(coded: list[bytes], length: int, alphabet: int) -> np.ndarray:
    blocks = len(coded)
    mixer = Mixer(blocks, alphabet, length)
    words = np.zeros((blocks, max(map(len, coded)) // 4), dtype=np.uint32)
    for row, data in zip(words, coded):
        row[: len(data) // 4] = np.frombuffer(data, dtype="<u4")
    words = np.ascontiguousarray(words.T)
    low = np.zeros(blocks, dtype=np.uint64)
    span = np.full(blocks, np.iinfo(np.uint64).max, dtype=np.uint64)
    code = (words[0].astype(np.uint64) << _WORD) | words[1]
    words, next_word = words.ravel(), np.arange(2 * blocks, 3 * blocks)
    ids = np.zeros((length, blocks), dtype="<u4")
    for t in range(length):
        mixer.predict()
        part = span >> np.uint64(TOTAL_BITS)
        at = np.minimum((code - low) // part, np.uint64(TOTAL - 1)).view(np.int64)
        found = mixer.find(at)
        start, size = mixer.part(found)
        low += part * start.view(np.uint64)
        span = part * size.view(np.uint64)
        rows = np.flatnonzero(span < _BOTTOM)
        if len(rows):
            place = next_word[rows]
            # Only damaged data asks for more words than there are; its checksum tells.
            code[rows] = (code[rows] << _WORD) | words.take(place, mode="clip")
            next_word[rows] = place + blocks
            _shift(low, span, rows)
        mixer.learn(found)
        ids[t] = found
    return np.ascontiguousarray(ids.T)


def write_file(
    out: BinaryIO, batches: Iterable[tuple[np.ndarray, np.ndarray]], alphabet: int, block: int = BLOCK_IDS
) -> None:
    """Write batches of (ids, ids per document) as one file; no more than one group is held.

    All numbers are little-endian. Head: magic, alphabet, block length. A group is up to ``ABREAST``
    blocks of equal length, and is read as a whole. Blocks: ids, bytes, CRC of
    the ids as unsigned 32-bit numbers and then the data, data. A frame of no ids and bytes ends them. Tail: ids of
    each document, then documents, ids, CRC of the tail's first part.
    """
    out.write(MAGIC + HEAD.pack(alphabet, block))
    waiting, sizes, total = np.zeros(0, dtype="<u4"), [], 0

    def frames(rows: np.ndarray) -> None:
        for row, data in zip(rows, encode_blocks(rows, alphabet)):
            out.write(FRAME.pack(len(row), len(data), zlib.crc32(data, zlib.crc32(row))) + data)

    for ids, counts in batches:
        waiting = np.concatenate([waiting, ids.astype("<u4")])
        sizes.append(counts.astype("<u4"))
        total += len(ids)
        while len(waiting) >= ABREAST * block:
            frames(waiting[: ABREAST * block].reshape(-1, block))
            waiting = waiting[ABREAST * block :]
    full = len(waiting) // block * block
    if full:
        frames(waiting[:full].reshape(-1, block))
    # Side by side they take few steps; a step costs about the same for one block as for many.
    waiting, short = waiting[full:], min(SHORT_BLOCK, block)
    full = len(waiting) // short * short
    if full:
        frames(waiting[:full].reshape(-1, short))
    if len(waiting) > full:
        frames(waiting[None, full:])
    out.write(FRAME.pack(0, 0, 0))
    tail = b"".join(s.tobytes() for s in sizes)
    out.write(tail + TAIL.pack(len(tail) // 4, total, zlib.crc32(tail)))


def read_file(data: bytes) -> tuple[np.ndarray, Iterator[np.ndarray]]:
    """Ids per document of a file, and its ids group by group; damage raises ValueError."""
    if data[:8] != MAGIC or len(data) < 8 + HEAD.size + FRAME.size + TAIL.size:
        raise ValueError("not a file of token ids")
    alphabet, block = HEAD.unpack_from(data, 8)
    docs, total, crc = TAIL.unpack_from(data, len(data) - TAIL.size)
    tail = data[len(data) - TAIL.size - 4 * docs : len(data) - TAIL.size]
    if zlib.crc32(tail) != crc or len(tail) != 4 * docs:
        raise ValueError("damaged table of documents")
    counts = np.frombuffer(tail, dtype="<u4").astype(np.int64)
    if counts.sum() != total:
        raise ValueError("ids are missing")
    return counts, _groups(data, alphabet, block, total)


def _groups(data: bytes, alphabet: int, block: int, total: int) -> Iterator[np.ndarray]:
    at, group, seen = 8 + HEAD.size, [], 0
    while True:
        if at + FRAME.size > len(data):
            raise ValueError("damaged block")
        n, size, crc = FRAME.unpack_from(data, at)
        at += FRAME.size
        if group and (n != group[0][0] or len(group) == ABREAST):
            rows = decode_blocks([f[1] for f in group], group[0][0], alphabet)
            for row, frame in zip(rows, group):
                if zlib.crc32(frame[1], zlib.crc32(row)) != frame[2]:
                    raise ValueError("damaged block")
            seen += rows.size
            yield rows.ravel()
            group = []
        if n == 0:
            break
        if n > block or size % 4 or size < 8 or at + size > len(data):
            raise ValueError("damaged block")
        group.append((n, data[at : at + size], crc))
        at += size
    if seen != total:
        raise ValueError("ids are missing")


def document_sums(counts: np.ndarray, groups: Iterable[np.ndarray]) -> list[int]:
    """CRC of each document's ids as unsigned 32-bit numbers; a document may span groups."""
    sums, doc, due = [0] * len(counts), 0, int(counts[0]) if len(counts) else 0
    for ids in groups:
        raw, at = ids.astype("<u4", copy=False).view(np.uint8), 0
        while at < len(raw):
            take = min(4 * due, len(raw) - at)
            sums[doc] = zlib.crc32(raw[at : at + take], sums[doc])
            at, due = at + take, due - take // 4
            while due == 0 and doc + 1 < len(counts):
                doc += 1
                due = int(counts[doc])
            if due == 0:
                break
    return sums


def plain_words(text: bytes) -> pa.LargeStringArray:
    """``PLAIN_WORDS.findall`` of a plain text that ends without white space, by arrays."""
    codes = np.frombuffer(text.decode().encode("utf-32-le"), dtype="<u4")
    kinds = CLASS_OF.take(codes)
    starts = np.ones(len(codes) + 1, dtype=bool)
    starts[1:-1] = kinds[1:] != kinds[:-1]
    # The last of several white spaces stands apart; a blank belongs to what follows.
    last = np.flatnonzero((kinds[:-1] == 0) & (kinds[1:] != 0))
    starts[last] = True
    starts[last[codes[last] == ord(" ")] + 1] = False
    marks = np.flatnonzero(codes == ord("'"))
    marks = marks[starts[marks]]
    padded = np.append(codes, np.zeros(2, dtype=codes.dtype))
    for end in SHORT_ENDS:
        found = marks[np.all([padded[marks + 1 + k] == c for k, c in enumerate(end)], axis=0)]
        starts[found + 1] = False
        starts[found + 1 + len(end)] = True
    stops = np.concatenate([[0], np.cumsum(1 + (codes > 0x7F))])[starts]
    return pa.LargeStringArray.from_buffers(len(stops) - 1, pa.py_buffer(stops), pa.py_buffer(text))


class PieceIds:
    """Ids by piece with the byte-level vocabulary; the library makes them.

    Plain pieces that begin with white space and end without are cut into words, and each new word goes
    to the library's model, many at a time; how many ids each has follows from the bytes that the ids
    stand for. Any other piece, and any with a special token in it, goes through the whole library. Words
    met before are looked up; how many are remembered from one call to the next has a bound.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = tokenizer(path)
        # The names of bytes hold no line end, so one can stand between words.
        self.model = Tokenizer(self.whole.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        self.specials = [t.content for t in self.whole.get_added_tokens_decoder().values()]
        vocab = self.whole.get_vocab(with_added_tokens=True)
        self.n_bytes = np.zeros(max(vocab.values()) + 1, dtype=np.int64)
        for name, i in vocab.items():
            self.n_bytes[i] = len(name)
        # Word k has the ids from bounds[k] up to bounds[k + 1], and its bytes lie between two stops alike.
        self.ids, self.bounds = np.zeros(0, dtype=np.int32), np.zeros(1, dtype=np.int64)
        self.raw, self.stops = np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
        # Hashes of remembered words in order, and the word of each.
        self.slots, self.owner = np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)

    def encoded(self, words: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of plain words one after the other, and how many each has."""
        raw, stops = text_bytes(words)
        names = np.insert(BYTE_CODES[raw], stops[1:-1], LINE_END).tobytes().decode("utf-32-le")
        (found,) = self.model.encode_batch_fast([names], add_special_tokens=False)
        ids = np.array(found.ids, dtype=np.int32)
        return ids, np.diff(np.searchsorted(np.cumsum(self.n_bytes[ids]), stops[1:]) + 1, prepend=0)

    def known(self, raw: np.ndarray, stops: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 where it is new. Words of one hash are compared byte by byte."""
        at = np.searchsorted(self.slots, hashes)
        near = np.flatnonzero(np.append(self.slots, hashes[:1])[at] == hashes)
        near = near[at[near] < len(self.slots)]
        own, sizes = self.owner[at[near]], np.diff(stops)[near]
        alike = np.diff(self.stops)[own] == sizes
        near, own, sizes = near[alike], own[alike], sizes[alike]
        theirs, ends = runs(self.raw, self.stops[own], sizes)
        others = np.flatnonzero(theirs != runs(raw, stops[near], sizes)[0])
        own[np.searchsorted(ends, others, side="right")] = -1
        numbers = np.full(len(hashes), -1, dtype=np.int64)
        numbers[near] = own
        return numbers

    def remember(self, words: pa.LargeStringArray, hashes: np.ndarray) -> None:
        """Give new words their numbers; of those that share a hash only one is found again."""
        n, order = len(self.bounds) - 1, np.argsort(hashes, kind="stable")
        parts = [self.encoded(words.slice(at, TOGETHER)) for at in range(0, len(words), TOGETHER)]
        raw, stops = text_bytes(words)
        self.ids = np.concatenate([self.ids, *[ids for ids, _ in parts]])
        self.bounds = np.append(self.bounds, self.bounds[-1] + np.cumsum(np.concatenate([k for _, k in parts])))
        self.raw = np.concatenate([self.raw, raw])
        self.stops = np.append(self.stops, self.stops[-1] + stops[1:])
        hashes = hashes[order]
        at = np.searchsorted(self.slots, hashes)
        alone = np.append(self.slots, ~hashes[-1:])[at] != hashes
        alone[1:] &= hashes[1:] != hashes[:-1]
        self.slots = np.insert(self.slots, at[alone], hashes[alone])
        self.owner = np.insert(self.owner, at[alone], order[alone] + n)

    def forget(self, most: int) -> None:
        """Keep the words that came first."""
        kept = self.owner < most
        self.slots, self.owner = self.slots[kept], self.owner[kept]
        self.bounds, self.stops = self.bounds[: most + 1], self.stops[: most + 1]
        self.ids, self.raw = self.ids[: self.bounds[-1]], self.raw[: self.stops[-1]]

    def look_up(self, words: pa.LargeStringArray) -> np.ndarray:
        """The numbers under which the words' ids are found."""
        if len(self.bounds) > REMEMBERED_WORDS + 1:
            self.forget(REMEMBERED_WORDS)
        coded = words.dictionary_encode()
        texts, which = coded.dictionary, coded.indices.to_numpy()
        hashes = word_hashes(*text_bytes(texts))
        # Searched for in order of hashes, so that what is found lies side by side.
        order = np.argsort(hashes)
        own = np.empty(len(order), dtype=np.int64)
        own[order] = self.known(*text_bytes(texts.take(pa.array(order))), hashes[order])
        new = np.flatnonzero(own < 0)
        if len(new):
            own[new] = np.arange(len(new)) + len(self.bounds) - 1
            self.remember(texts.take(pa.array(new)), hashes[new])
        return own[which]

    def together(self, text: bytes, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are cut into words as one text, and how many each piece of so many bytes has."""
        words = plain_words(text)
        slot = self.look_up(words)
        ids, ends = runs(self.ids, self.bounds[slot], self.bounds[slot + 1] - self.bounds[slot])
        last = np.searchsorted(text_bytes(words)[1], np.cumsum(sizes))
        return ids, np.diff(np.concatenate([[0], ends])[last], prepend=0)

    def apart(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for any pieces, each by itself."""
        lists = [self.whole.encode(p, add_special_tokens=False).ids for p in pieces]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        return np.fromiter(itertools.chain.from_iterable(lists), np.int32, int(sizes.sum())), sizes

    def table(self, pieces: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all pieces, and for each piece where its ids start and how many there are."""
        chars = pc.utf8_length(pieces).to_numpy()
        short = chars <= LONGEST_PLAIN
        for token in self.specials:
            short &= ~pc.match_substring(pieces, token).to_numpy(zero_copy_only=False)
        together = short & pc.match_substring_regex(pieces, JOINED).to_numpy(zero_copy_only=False)
        joined, others = np.flatnonzero(together), np.flatnonzero(~together)
        text, stops = text_bytes(pieces.take(pa.array(joined)))
        values, sizes = self.together(text.tobytes(), np.diff(stops))
        if len(others):
            more, n = self.apart(pieces.take(pa.array(others)).to_pylist())
            values, sizes = np.concatenate([values, more]), np.concatenate([sizes, n])
        order = np.argsort(np.concatenate([joined, others]))
        return values, (np.cumsum(sizes) - sizes)[order], sizes[order]


@lru_cache(maxsize=1)
def piece_ids(path: str) -> PieceIds:
    """One for all tasks of a worker."""
    return PieceIds(path)


def runs(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of values one after the other, and where each ends."""
    ends = np.cumsum(sizes)
    places = np.repeat(starts - (ends - sizes), sizes)
    places += np.arange(len(places))
    return values.take(places), ends


def word_hashes(raw: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit number for each word of one byte or more."""
    place = np.arange(len(raw)) - np.repeat(stops[:-1], np.diff(stops))
    return np.add.reduceat(FACTORS[place % len(FACTORS)] * (raw.astype(np.uint64) + np.uint64(1)), stops[:-1])


def ids_of(raw: np.ndarray, rows: np.ndarray, encode: PieceIds, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """All ids of a batch of texts one after the other, each text closed by ``end_id``, and counts."""
    bounds, row_of = piece_bounds(raw, rows)
    n = len(rows) - 1
    counts, flat = np.zeros(n, dtype=np.int64), []
    for at, to in byte_batches(raw, bounds, BATCH_BYTES):
        which, pieces = coded_pieces(raw, bounds, at, to)
        values, starts, sizes = encode.table(pieces)
        own = sizes[which]
        flat.append(runs(values, starts[which], own)[0])
        counts += np.bincount(row_of[at:to], weights=own, minlength=n).astype(np.int64)
    ids = np.concatenate(flat) if flat else np.zeros(0, dtype=np.int32)
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


@dataclass(frozen=True)
class IdFiles:
    """A set of written files: where they lie, a row per document (file, at, id, hash), how many files at most."""

    folder: str
    manifest: DataFrame
    most: int


def write_ids(
    docs: DataFrame,
    path: str,
    folder: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    end_id: int = 0,
    docs_per_file: int = DOCS_PER_FILE,
) -> IdFiles:
    """Write the ids of all texts in ascending order of ids into files below ``folder``.

    Documents are dealt into ranges of ids, a range is one task and one file. A task writes under a
    name of its own and reports it; only reported files count, so a task that runs again leaves at
    most a file that nobody reads. NULL ids come first, equal ids in order of a hash of their text.
    """
    own = docs.select(
        F.col(id_column).alias("id"),
        F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"),
    ).withColumn("hash", F.xxhash64("text"))
    alphabet = tokenizer(path).get_vocab_size(with_added_tokens=True)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, keys = piece_ids(path), []

        def found() -> Iterator[tuple[np.ndarray, np.ndarray]]:
            for whole in parts:
                for part in by_bytes(whole, 1, BATCH_BYTES):
                    keys.append((part.column(0), part.column(2)))
                    yield ids_of(*text_bytes(part.column(1)), encode, end_id)

        work = found()
        head = next(work, None)
        if head is None:
            return
        system, root = pafs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        name = f"{uuid.uuid4().hex}.ids"
        with system.open_output_stream(f"{root}/{name}") as out:
            write_file(out, itertools.chain([head], work), alphabet)
        at = 0
        for owners, hashes in keys:
            places = pa.array(np.arange(at, at + len(owners), dtype=np.int64))
            at += len(owners)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(owners), pa.string()), places, owners, hashes], names=["file", "at", "id", "hash"]
            )

    rows, size = own.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    files = max(1, -(-rows // docs_per_file), -(-size // BYTES_PER_FILE))
    kind = docs.schema[id_column].dataType.simpleString()
    sorted_docs = own.repartitionByRange(files, "id", "hash").sortWithinPartitions("id", "hash")
    written = arrow_map(sorted_docs.select("id", "text", "hash"), batches, f"file string, at bigint, id {kind}, hash bigint")
    return IdFiles(folder, stored(written, docs.sparkSession, "id-manifest"), files)


def read_ids(files: IdFiles, id_column: str = "doc_id") -> DataFrame:
    """Read files back: per document id, n_tokens, ids_crc32 and start (ids of all before it)."""
    folder = files.folder

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = pafs.FileSystem.from_uri(folder)
        for part in parts:
            for name in part.column(0).to_pylist():
                with system.open_input_stream(f"{root}/{name}") as source:
                    counts, groups = read_file(source.read())
                sums = document_sums(counts, groups)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * len(counts), pa.string()),
                        pa.array(np.arange(len(counts), dtype=np.int64)),
                        pa.array(np.cumsum(counts) - counts),
                        pa.array(counts),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["file", "at", "within", "n_tokens", "ids_crc32"],
                )

    spark = files.manifest.sparkSession
    # Ranges do not overlap, so the files' least ids and hashes put them in order.
    heads = files.manifest.groupBy("file").agg(
        F.min(F.struct(F.col("id").isNotNull().alias("has_id"), "id", "hash")).alias("first")
    )
    wide = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = stored(
        arrow_map(
            heads.select("file").repartition(min(wide, files.most)),
            batches,
            "file string, at bigint, within bigint, n_tokens bigint, ids_crc32 bigint",
        ),
        spark,
        "ids-read",
    )
    # One row per file: their sums in order give where each file starts.
    order = Window.orderBy("first", "file").rowsBetween(Window.unboundedPreceding, -1)
    ends = read.groupBy("file").agg(F.sum("n_tokens").alias("ids"))
    placed = (
        heads.join(ends, "file")
        .select("file", F.coalesce(F.sum("ids").over(order), F.lit(0)).alias("before"))
    )
    return (
        files.manifest.join(read, ["file", "at"])
        .join(placed, "file")
        .select(
            F.col("id").alias(id_column),
            (F.col("before") + F.col("within")).alias("start"),
            "n_tokens",
            "ids_crc32",
        )
    )


def id_round_trip(
    docs: DataFrame, path: str, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """Write all texts' ids, read the files back and describe each document from what was read.

    Columns: id, start, n_tokens (with the closing id 0), ids_crc32. NULL and empty texts have the
    closing id alone; NULL ids come first, equal ids in order of a hash of the text; repeated rows
    each have a place; other columns are ignored; an empty table gives an empty table.
    """
    folder = scratch_path(docs.sparkSession, "token-ids")
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return read_ids(write_ids(docs, path, folder, id_column, text_column), id_column)
