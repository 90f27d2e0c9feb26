"""Words, word hashes and shingles of many texts at once, on the bytes of an Arrow column.

The word classes in use exclude ASCII characters only, so a word is a run of UTF-8 bytes and a
batch of texts is cut with a handful of array operations, without a Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are taken together up to this many bytes; a longer text is taken alone, and whole.
CHUNK_BYTES = 1 << 19

_ASCII = np.arange(256)
#: Bytes of words that leave out ASCII other than digits and small letters (after lowering A-Z).
LETTER_BYTES = (_ASCII >= 128) | ((_ASCII >= 48) & (_ASCII <= 57)) | ((_ASCII >= 97) & (_ASCII <= 122))
#: The same for texts whose capitals are not lowered yet.
LETTER_BYTES_ANY_CASE = LETTER_BYTES | ((_ASCII >= 65) & (_ASCII <= 90))
#: Bytes of words between white space.
VISIBLE_BYTES = ~((_ASCII == 32) | ((_ASCII >= 9) & (_ASCII <= 13)))
#: A-Z to a-z, everything else to itself.
LOWER = np.where((_ASCII >= 65) & (_ASCII <= 90), _ASCII + 32, _ASCII).astype(np.uint8)

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, so that close inputs have unrelated outputs."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))[LOWER]
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def power_tables(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[k] = np.cumprod(steps)
    return _powers


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, byte offsets of the rows); nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if n == 0:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    lo = 0
    while lo < n:
        hi = int(np.searchsorted(offsets, offsets[lo] + limit, side="right")) - 1
        hi = min(max(hi, lo + 1), n)
        yield lo, hi, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


class Words:
    """The words of a chunk: byte spans, hashes (A-Z as a-z), and the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, member: np.ndarray):
        inside = member[data]
        begins, ends = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        ends[:-1] &= ~inside[1:]
        cuts = offsets[1:-1]
        cuts = cuts[(cuts > 0) & (cuts < len(data))]
        begins[cuts] = inside[cuts]
        ends[cuts - 1] = inside[cuts - 1]
        self.data = data
        self.starts = np.flatnonzero(begins)
        self.ends = np.flatnonzero(ends) + 1
        #: Word numbers at which the texts begin, and the number of all words.
        self.firsts = np.searchsorted(self.starts, offsets)
        self.counts = np.diff(self.firsts)
        self._hashes: np.ndarray | None = None

    @property
    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.counts)), self.counts)

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            n = len(self.data)
            if len(self.starts) == 0:
                self._hashes = np.zeros(0, np.uint64)
            else:
                powers, inverses = power_tables(n)
                sums = np.zeros(n + 1, np.uint64)
                np.cumsum(_VALUES[self.data] * powers[:n], out=sums[1:])
                raw = (sums[self.ends] - sums[self.starts]) * inverses[self.starts]
                self._hashes = mix(raw + (self.ends - self.starts).astype(np.uint64) * _STEP)
        return self._hashes

    def shingles(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(word number, hash) of every run of ``k`` words within one text."""
        h = self.hashes
        m = len(h) - k + 1
        if m <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        text = self.text_of
        at = np.flatnonzero(text[:m] == text[k - 1 :])
        return at, sequence_hash([h[j : j + m] for j in range(k)])[at]

    def phrase(self, start: int, count: int) -> bytes:
        """``count`` words from word ``start``, lowered and joined by a space."""
        data = self.data
        return b" ".join(
            LOWER[data[a:b]].tobytes()
            for a, b in zip(self.starts[start : start + count], self.ends[start : start + count])
        )


def sequence_hash(columns: list[np.ndarray]) -> np.ndarray:
    """Hash of a sequence of word hashes, given as one array per place."""
    total = np.full(len(columns[0]), len(columns), np.uint64) * _STEP
    for column in columns:
        total = total * _BASE + column
    return mix(total)


def ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and the range of each; empty ones are allowed."""
    sizes = np.maximum(ends - starts, 0)
    owner = np.repeat(np.arange(len(starts)), sizes)
    offset = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return starts[owner] + offset, owner


def spare(df, names) -> list[str]:
    """Columns of ``df`` whose names the operator does not write itself (any case)."""
    taken = {name.lower() for name in names}
    return [name for name in df.columns if name.lower() not in taken]
