"""Words of Arrow string batches and hashes of their runs, by whole-buffer steps over the UTF-8 bytes.

A table classifies each byte, differences of neighbouring classes give the words' boundaries, and the table-driven CRC-32 of all
words advances by one byte a step, for all starts at once. Words stand in order of length, so that those that still have a byte left are
always the first ones; the few that are longer than ``LOCKSTEP`` bytes go on alone, with the same state.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text taken at a time (one text at least), and steps that all words take together.
CHUNK_BYTES, LOCKSTEP = 4 << 20, 64


def crc_table(polynomial: int = 0xEDB88320) -> np.ndarray:
    """The state's change by each byte, of the reflected polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(polynomial), table >> 1)
    return table


_CRC = crc_table()
_ALL = np.uint32(0xFFFFFFFF)
_BYTES = np.arange(256)
#: A-Z in lower case, and whether a byte of the folded text belongs to a word: 0-9, a-z and all beyond ASCII.
FOLD = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)
IN_WORD = (_BYTES >= 128) | ((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122))


@dataclass
class Words:
    """Words of some rows: folded bytes, and each word's start, length and row."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    rows: np.ndarray
    n_rows: int

    def counts(self) -> np.ndarray:
        """Words of each row."""
        return np.bincount(self.rows, minlength=self.n_rows)


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """Words of the texts ``data[offsets[i]:offsets[i + 1]]``; a text's end always ends a word."""
    data = FOLD[data[offsets[0] : offsets[-1]]]
    offsets = offsets - offsets[0]
    inside = IN_WORD[data]
    # 1 where a word begins, -1 behind its last byte.
    step = np.diff(inside.astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = step == 1, step == -1
    seams = offsets[1:-1]
    seams = seams[(seams > 0) & (seams < len(data))]
    seams = seams[inside[seams - 1] & inside[seams]]  # words that meet where one text ends and the next begins
    starts[seams] = ends[seams] = True
    at = np.flatnonzero(starts)
    return Words(data, at, np.flatnonzero(ends) - at, np.searchsorted(offsets, at, side="right") - 1, len(offsets) - 1)


def chunks(column: pa.Array) -> Iterator[tuple[int, int, Words]]:
    """(first row, end row, words) of a string column, in pieces of bounded bytes; null texts have no words."""
    column = column.cast(pa.large_string()).fill_null("") if column.null_count else column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    data = np.frombuffer(held, dtype=np.uint8) if held else np.empty(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        end = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, side="right")) - 1)
        yield first, end, split_words(data, offsets[first : end + 1])
        first = end


def _advanced(state: np.ndarray, data: np.ndarray, at: np.ndarray, lengths: np.ndarray, alive: np.ndarray) -> np.ndarray:
    """States after each word's bytes; words in descending order of length."""
    for j, n in enumerate(alive):
        s = state[:n]
        state[:n] = _CRC[(s ^ data[at[:n] + j]) & np.uint32(0xFF)] ^ (s >> np.uint32(8))
    for i in np.flatnonzero(lengths > LOCKSTEP):
        rest = data[at[i] + LOCKSTEP : at[i] + lengths[i]].tobytes()
        state[i] = zlib.crc32(rest, int(state[i] ^ _ALL)) ^ 0xFFFFFFFF
    return state


def run_hashes(words: Words, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1 to ``longest`` words joined by one space: (rows, CRC-32 as unsigned integers), in the order of their last words."""
    n = len(words.starts)
    if not n:
        return
    order = np.argsort(-words.lengths, kind="stable")
    at, lengths = words.starts[order], words.lengths[order]
    # Words with more than j bytes, for each step j.
    alive = n - np.cumsum(np.bincount(np.minimum(lengths, LOCKSTEP), minlength=LOCKSTEP + 1))[:LOCKSTEP]
    alive = alive[alive > 0]
    state = np.full(n, _ALL)
    for size in range(1, longest + 1):
        if size > 1:  # the run before, a space, and this word
            before = np.concatenate([state[:1], state[:-1]])
            state = _CRC[(before ^ np.uint32(32)) & np.uint32(0xFF)] ^ (before >> np.uint32(8))
        whole = np.zeros(n, dtype=bool)
        whole[size - 1 :] = words.rows[size - 1 :] == words.rows[: max(n - size + 1, 0)]
        moved = np.empty(n, dtype=np.uint32)
        moved[order] = _advanced(state[order], words.data, at, lengths, alive)
        state = moved
        yield words.rows[whole], state[whole] ^ _ALL
