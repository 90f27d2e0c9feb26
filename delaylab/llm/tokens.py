"""Token ids of a public byte-level BPE vocabulary, many texts at a time.

All ids come from the ``tokenizers`` library. It spends its time on cutting texts into words and on
words it has met before; here texts are cut with array operations on their code points, and the
library's model encodes each distinct word of a worker (told by a 64-bit hash) once, in the
byte-level spelling that its own cutter hands it.
"""

from __future__ import annotations

import itertools
import os
from array import array

import numpy as np
import regex

from delaylab.llm.textbytes import mix, power_tables

#: Code points above this are left to the library: their classes may differ between Unicode versions.
_PLAIN = 0x2000
_OTHER, _LETTER, _NUMBER, _SPACE, _STOP = range(5)
#: Endings that the vocabulary splits off after an apostrophe.
_ENDINGS = ("s", "t", "re", "ve", "m", "ll", "d")
#: Words a worker remembers before it starts afresh. With their places in a table that is mostly
#: empty, and the copies made for a chunk of texts, they take some 80 bytes each.
_REMEMBERED = 500_000
_SPECIAL = "<|endoftext|>"


def _spelling() -> dict[int, str]:
    """A printable character for every byte: itself where it has one, else the next above 255."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}


def _classes() -> np.ndarray:
    table = np.full(_PLAIN, _OTHER, np.uint8)
    for kind, pattern in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_SPACE, r"\s")):
        match = regex.compile(pattern).match
        table[[c for c in range(_PLAIN) if match(chr(c))]] = kind
    return table


def _join(texts: list[str]) -> tuple[str, np.ndarray, np.ndarray]:
    """The texts with a stop after each, its code points, and where the stops are."""
    joined = "\0".join(texts) + "\0"
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1) - 1
    return joined, np.frombuffer(joined.encode("utf-32-le"), np.uint32), ends


class ByteBpe:
    """Encodes texts with the vocabulary in ``json_path``."""

    def __init__(self, json_path: str):
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(json_path)
        self._model, self._letters = self._library.model, _spelling()
        self._class_of = _classes()
        self._value_of = mix(np.arange(1, _PLAIN + 1, dtype=np.uint64))
        self._forget()

    def _word_ids(self, word: str) -> list[int]:
        spelled = word.encode().decode("latin-1").translate(self._letters)
        return [token.id for token in self._model.tokenize(spelled)]

    def _cuts(self, text: str, points: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Places where a word or the stop between two texts begins, and the end of all."""
        kind = self._class_of[points]
        kind[ends] = _STOP
        n = len(kind)
        cut = np.ones(n + 1, bool)
        np.not_equal(kind[1:], kind[:-1], out=cut[1:n])
        runs = np.flatnonzero(cut[:n])
        run_kind = kind[runs]
        # The last space of a run belongs to the word after it; another last white space and the
        # run before it are words of their own.
        spaces = np.flatnonzero((run_kind[:-1] == _SPACE) & (run_kind[1:] != _STOP))
        last = runs[spaces + 1] - 1
        cut[last] = True
        cut[last[points[last] == 32] + 1] = False
        # A lone apostrophe takes a known ending off the letters behind it.
        quotes = np.flatnonzero((run_kind[:-1] == _OTHER) & (run_kind[1:] == _LETTER))
        quotes = runs[quotes[np.diff(runs)[quotes] == 1]]
        for q in quotes[(points[quotes] == 39) & cut[quotes]].tolist():
            for ending in _ENDINGS:
                # A quote is a word's start unless the space before it, or an ending, took it.
                if text.startswith(ending, q + 1):
                    cut[q + 1] = False
                    cut[q + 1 + len(ending)] = True
                    break
        return np.flatnonzero(cut)

    def _numbers(self, text: str, points: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Number of each word among the words the worker remembers, learning the new ones."""
        powers, inverses = power_tables(len(points))
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(self._value_of[points] * powers[: len(points)], out=sums[1:])
        keys = mix((sums[end] - sums[begin]) * inverses[begin] + (end - begin).astype(np.uint64))
        keys |= np.uint64(1)
        number = self._look_up(keys)
        new = np.flatnonzero(number < 0)
        if len(new):
            distinct, first = np.unique(keys[new], return_index=True)
            met = new[first]
            for a, b in zip(begin[met].tolist(), end[met].tolist()):
                encoded = self._word_ids(text[a:b])
                self._lengths.append(len(encoded))
                self._ids.extend(encoded)
            self._insert(distinct, np.arange(self._count, self._count + len(distinct)))
            self._count += len(distinct)
            number[new] = self._look_up(keys[new])
        return number

    def _look_up(self, keys: np.ndarray) -> np.ndarray:
        number = np.full(len(keys), -1, np.int64)
        left, step = np.arange(len(keys)), 0
        while len(left):
            place = ((keys[left] >> np.uint64(20)) + np.uint64(step)) & self._mask
            there = self._keys[place]
            same = there == keys[left]
            number[left[same]] = self._number[place[same]]
            left = left[~same & (there != 0)]
            step += 1
        return number

    def _insert(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        while (self._count + len(keys)) * 3 > len(self._keys):
            full = np.flatnonzero(self._keys)
            old_keys, old_numbers = self._keys[full], self._number[full]
            self._resize(2 * len(self._keys))
            self._place(old_keys, old_numbers)
        self._place(keys, numbers)

    def _place(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        left, step = np.arange(len(keys)), 0
        while len(left):
            place = ((keys[left] >> np.uint64(20)) + np.uint64(step)) & self._mask
            free = self._keys[place] == 0
            self._keys[place[free]] = keys[left[free]]
            won = free & (self._keys[place] == keys[left])
            self._number[place[won]] = numbers[left[won]]
            left = left[~won]
            step += 1

    def _resize(self, size: int) -> None:
        self._keys, self._number = np.zeros(size, np.uint64), np.zeros(size, np.int32)
        self._mask = np.uint64(size - 1)

    def _forget(self) -> None:
        self._resize(1 << 16)
        self._count = 0
        self._lengths, self._ids = array("I"), array("I")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other as uint32, where each text's ids begin)."""
        if self._count > _REMEMBERED:
            self._forget()
        joined, points, ends = _join(texts)
        odd = {int(i) for i in np.unique(np.searchsorted(ends, np.flatnonzero(points >= _PLAIN)))}
        if _SPECIAL in joined:
            odd |= {i for i, text in enumerate(texts) if _SPECIAL in text}
        if odd:
            joined, points, ends = _join(["" if i in odd else t for i, t in enumerate(texts)])
        cuts = self._cuts(joined, points, ends)
        begin, end = cuts[:-1], cuts[1:]
        word = np.ones(len(points), bool)
        word[ends] = False
        word = word[begin]
        begin, end = begin[word], end[word]
        number = self._numbers(joined, points, begin, end)
        # The ids of each word are a run in the array of all remembered ids.
        all_lengths = np.array(self._lengths, np.int64)
        all_starts = np.cumsum(all_lengths) - all_lengths
        lengths = all_lengths[number]
        upto = np.concatenate([[0], np.cumsum(lengths)])
        shift = np.repeat(all_starts[number] - upto[:-1], lengths)
        ids = np.array(self._ids, np.uint32)[shift + np.arange(len(shift))]
        starts = upto[np.concatenate([[0], np.searchsorted(begin, ends)])]
        if odd:
            pieces = [ids[a:b] for a, b in itertools.pairwise(starts.tolist())]
            whole = self._library.encode_batch([texts[i] for i in sorted(odd)], add_special_tokens=False)
            for i, encoded in zip(sorted(odd), whole):
                pieces[i] = np.array(encoded.ids, np.uint32)
            ids = np.concatenate(pieces)
            starts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])])
        return ids, starts


_loaded: dict[str, ByteBpe] = {}


def load(json_path: str) -> ByteBpe:
    """One encoder per worker process."""
    if json_path not in _loaded:
        # Spark runs a worker on every core: threads of the library would only compete.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        _loaded[json_path] = ByteBpe(json_path)
    return _loaded[json_path]
