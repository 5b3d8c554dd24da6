"""Token ids of whole texts from the `tokenizers` library, many texts at a time.

A text is cut at places where the tokenizer's own pre-tokenization always begins a new piece.
Each different unit between two cuts is encoded once by the library and looked up from then
on, which gives the same ids as encoding the whole text and costs a fraction of it.
"""

from __future__ import annotations

import os
import re
from itertools import chain, repeat

import numpy as np

# Units remembered by one Python worker, about 200 bytes each. Units that come later are
# encoded each time; the frequent ones are among the first.
MAX_UNITS = 1_200_000

# In byte-level BPE a piece starts at a space that no white space follows. A line feed with no
# white space around it is a piece of its own.
_BYTE_LEVEL_CUT = re.compile(r" (?=\S)")
_ODD_SPACE = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\0]")
_RUNS = ("  ", " \n", "\n ", "\n\n")

# Letters and the ASCII marks after them are pieces of their own in all these tokenizers.
_WORD_AND_MARKS = re.compile(r"( ?[^\W\d_]+)([!-/:-@\[-^`{-~]+)")

# Stands between units that are encoded in one go. After a space it is a piece of its own.
_MARK = "\x01"
_AT_ONCE = 1_000


def public_path(file: str) -> str:
    """Where a public vocabulary file lies."""
    try:
        import public_tokenizers
    except ImportError:
        return f"/opt/tokenizers/{file}"
    return public_tokenizers.path(file)


def byte_level_units(text: str) -> list[str]:
    """Cut a text for byte-level BPE without a normalizer; joined they give the text again."""
    if not text:
        return []
    if text[-1] == " " or any(r in text for r in _RUNS) or _ODD_SPACE.search(text):
        cuts = [m.start() for m in _BYTE_LEVEL_CUT.finditer(text)]
        return [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)]) if a < b]
    units = text.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
    return units if units[0] and units[-1] else [u for u in units if u]


def word_units(text: str) -> list[str]:
    """Cut a text for a tokenizer that drops white space: at spaces and line feeds."""
    return [u for u in text.replace("\n", " ").split(" ") if u]


CUTS = {"byte_level": byte_level_units, "words": word_units}


def _grown(array: np.ndarray, size: int) -> np.ndarray:
    """The array, or a copy with room for size elements and half as many again."""
    if size <= len(array):
        return array
    out = np.zeros(size + size // 2, array.dtype)
    out[: len(array)] = array
    return out


class UnitEncoder:
    """Ids of texts, by way of a bounded memory of units.

    With `special`, the strings of the vocabulary's special tokens get their ids wherever they
    stand, as the library does it; else they are ordinary text.
    """

    def __init__(self, path: str, cut: str, max_units: int = MAX_UNITS, special: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.special = self._special_strings() if special else []
        self.at_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.cut = CUTS[cut]
        self.max_units = max_units
        self.mark = self.tokenizer.encode(f" {_MARK}", add_special_tokens=False).ids
        self.number: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)  # of each unit's ids in flat, and the end of the last
        self.flat = np.zeros(0, np.uint32)

    def _special_strings(self) -> list[str]:
        """The strings that the library takes out of a text first, the longest ones first."""
        added = self.tokenizer.get_added_tokens_decoder().values()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added):
            raise ValueError("special tokens that depend on what is around them")
        return sorted((t.content for t in added if t.content), key=len, reverse=True)

    def _units(self, text: str) -> list[str]:
        """Units of a text; a special token's string is one, and the text ends and begins there."""
        if not any(s in text for s in self.special):
            return self.cut(text)
        parts = self.at_special.split(text)  # text and special strings by turns
        return list(chain.from_iterable([p] if k % 2 else self.cut(p) for k, p in enumerate(parts)))

    def _encoded(self, units: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(the units in another order, number of ids of each, all their ids)."""
        plain, odd = [], []
        for u in units:
            (plain if (u[0].isalnum() or u[0] in " \n") and _MARK not in u else odd).append(u)
        chunks = [plain[at : at + _AT_ONCE] for at in range(0, len(plain), _AT_ONCE)]
        texts = [f" {_MARK}".join([*chunk, ""]) for chunk in chunks]
        lengths, ids = [], []
        for chunk, e in zip(chunks, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found = np.array(e.ids, np.uint32)
            last = np.flatnonzero(found == self.mark[-1])
            if len(last) != len(chunk):
                raise ValueError("a unit's ids run into the next one's")
            own = np.ones(len(found), bool)
            for k in range(len(self.mark)):
                own[last - k] = False
            lengths.append(np.diff(last, prepend=-1) - len(self.mark))
            ids.append(found[own])
        for e in self.tokenizer.encode_batch_fast(odd, add_special_tokens=False):
            lengths.append([len(e.ids)])
            ids.append(np.array(e.ids, np.uint32))
        return plain + odd, np.concatenate(lengths), np.concatenate(ids)

    def _append(self, units: list[str], lengths: np.ndarray, ids: np.ndarray) -> None:
        known, used = len(self.number), int(self.starts[len(self.number)])
        self.number.update(zip(units, range(known, known + len(units))))
        self.starts = _grown(self.starts, known + len(units) + 1)
        self.starts[known + 1 : known + len(units) + 1] = used + np.cumsum(lengths)
        self.flat = _grown(self.flat, used + len(ids))
        self.flat[used : used + len(ids)] = ids

    def _learn(self, units: list[str]) -> None:
        """Give units, none of them known, a number; a word with marks gets the ids of both."""
        fresh, joined, parts = [], [], []
        for u in units:
            if u[-1].isalnum():
                fresh.append(u)
            elif found := _WORD_AND_MARKS.fullmatch(u):
                joined.append(u)
                parts += found.groups()
            else:
                fresh.append(u)
        known = self.number
        fresh = list(dict.fromkeys(chain(fresh, [p for p in parts if p not in known])))
        if fresh:
            self._append(*self._encoded(fresh))
        if joined:
            both = np.fromiter(map(known.__getitem__, parts), np.int64, len(parts))
            lengths, ids = self._gathered(both)
            self._append(joined, lengths.reshape(-1, 2).sum(axis=1), ids)

    def _gathered(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each unit, all ids) of units given by number."""
        begins, lengths = self.starts[which], self.starts[which + 1] - self.starts[which]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        # Place in flat of every id: its unit's beginning plus its place in the unit.
        return lengths, self.flat[np.arange(total) + np.repeat(begins - (ends - lengths), lengths)]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, place where each text's ids end)."""
        per_text = [self._units(t) for t in texts]
        units = list(chain.from_iterable(per_text))
        which = np.fromiter(map(self.number.get, units, repeat(-1)), np.int64, len(units))
        missing = np.flatnonzero(which < 0)
        before = len(self.number)
        if len(missing):
            unknown = [units[i] for i in missing]
            self._learn(list(dict.fromkeys(unknown)))
            which[missing] = np.fromiter(map(self.number.get, unknown), np.int64, len(unknown))
        lengths, ids = self._gathered(which)
        if len(self.number) > self.max_units:  # full: keep what was known before
            while len(self.number) > before:
                self.number.popitem()
        units_before = np.cumsum(np.fromiter(map(len, per_text), np.int64, len(per_text)))
        return ids, np.concatenate([[0], np.cumsum(lengths)])[units_before]


_ENCODERS: dict[tuple[str, str], UnitEncoder] = {}


def encoder(path: str, cut: str, max_units: int = MAX_UNITS) -> UnitEncoder:
    """The Python worker's encoder for a vocabulary file; it lives as long as the worker.

    It gives the library's own ids, those of special tokens included.
    """
    if (path, cut) not in _ENCODERS:
        _ENCODERS[path, cut] = UnitEncoder(path, cut, max_units, special=True)
    return _ENCODERS[path, cut]


# Characters encoded at a time, so that a batch of very long texts stays in memory bounds.
CHARS_AT_ONCE = 1_000_000


def encoded_runs(batch_texts: list[str], encode: UnitEncoder):
    """Yield (first text, ids, ends) for runs of texts of about CHARS_AT_ONCE characters."""
    first = 0
    while first < len(batch_texts):
        chars, last = 0, first
        while last < len(batch_texts) and (last == first or chars + len(batch_texts[last]) <= CHARS_AT_ONCE):
            chars += len(batch_texts[last])
            last += 1
        yield (first, *encode.encode(batch_texts[first:last]))
        first = last
