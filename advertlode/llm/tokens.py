"""Token ids of whole texts, each distinct word encoded once.

A byte-level BPE cuts texts before it merges, and always between a character that is no white space and a single space
followed by another such character. So the ids of a text are the ids of its words, each with the space before it, one
after another, and a word need be given to the library only once per worker. Texts with other white space beside a
space are cut only where that holds.
"""

from __future__ import annotations

import ctypes
import gc
import re
from array import array
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .words import worker_memory

#: Words a worker remembers before it starts anew.
REMEMBERED = 700_000

# White space as the tokenizer's pattern has it, and the separators that only Python counts, which cut less often.
_WHITE = r"\t\n\x0b\x0c\r\x1c-\x1f \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_BESIDE_SPACE = f" [{_WHITE}]|[{_WHITE}] "
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
_PUNCTUATION = ".,;:!?*%$#&|\"()[]-"


def _byte_symbols() -> dict[int, str]:
    """Byte-level BPE's character for each byte: printable ones stand for themselves, the others follow at 256."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(own)]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(other)}


_SPACE = "\u0120"  # byte-level BPE's character for a space


def _listed(words: pa.Array) -> list[str]:
    """Words without spaces as a list, through one text, which is quicker than one by one."""
    if not len(words):
        return []
    whole = pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words.cast(pa.string()))
    return pc.binary_join(whole, " ")[0].as_py().split(" ")


class Encoder:
    """Encodes with the library's tokenizer file at `path`, without special tokens. If `plain`, the name of a special token
    within a text is text like any other, and no text has its id."""

    def __init__(self, path: str, plain: bool = False):
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = plain
        self._model = self._tokenizer.model
        self._symbols = _byte_symbols()
        self._tails: dict[str, list[int]] = {}
        self._forget()

    def _forget(self) -> None:
        self._spaced: dict[str, int] = {}  # words after a space
        self._leading: dict[str, int] = {}  # pieces that begin a text
        self._flat, self._ends = array("I"), array("q", [0])

    def release(self) -> None:
        """Forget all words and give their memory back to the system, which the allocators would keep for later."""
        self._tails.clear()
        self._forget()
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):  # other systems' allocators need no asking
            trim(0)

    def _pretoken(self, text: str) -> list[int]:
        text = text.replace(" ", _SPACE) if text.isascii() else text.encode().decode("latin-1").translate(self._symbols)
        return [t.id for t in self._model.tokenize(text)]

    def _quick(self, word: str) -> list[int] | None:
        """Ids of a word after a space, if it is of Latin letters, marks after it allowed: one or two pieces of the
        tokenizer's pattern."""
        if word.isascii() and word.isalpha():
            return [t.id for t in self._model.tokenize(_SPACE + word)]
        head = word.rstrip(_PUNCTUATION)
        if not word or (head and not (head.isalpha() and max(head) < "ɐ")):
            return None
        if not head or len(head) == len(word):
            return self._pretoken(" " + word)
        place = self._spaced.get(head)
        ids = self._pretoken(" " + head) if place is None else list(self._flat[self._ends[place]:self._ends[place + 1]])
        tail = word[len(head):]
        if tail not in self._tails:
            if len(self._tails) > REMEMBERED:
                self._tails.clear()
            self._tails[tail] = self._pretoken(tail)
        return ids + self._tails[tail]

    def _add(self, known: dict[str, int], piece: str, ids: list[int]) -> int:
        known[piece] = place = len(self._ends) - 1
        self._flat.extend(ids)
        self._ends.append(len(self._flat))
        return place

    def _places(self, words: list[str]) -> np.ndarray:
        """Where the ids of words that follow a space are; new ones are encoded."""
        known = self._spaced
        place = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
        slow = []
        for i in np.flatnonzero(place < 0).tolist():
            word = words[i]
            if word in known:  # more than once in the list
                place[i] = known[word]
            elif (ids := self._quick(word)) is None:
                slow.append(i)
            else:
                place[i] = self._add(known, word, ids)
        new = list(dict.fromkeys(words[i] for i in slow))
        for word, found in zip(new, self._tokenizer.encode_batch_fast([" " + w for w in new], add_special_tokens=False)):
            self._add(known, word, found.ids)
        for i in slow:
            place[i] = known[words[i]]
        return place

    def _leading_places(self, pieces: list[str]) -> np.ndarray:
        new = [p for p in dict.fromkeys(pieces) if p not in self._leading]
        for piece, found in zip(new, self._tokenizer.encode_batch_fast(new, add_special_tokens=False)):
            self._add(self._leading, piece, found.ids)
        return np.fromiter(map(self._leading.__getitem__, pieces), np.int64, len(pieces))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids (uint32) of all texts, one after another, and how many each has; null counts as empty."""
        collects = gc.isenabled()
        gc.disable()  # very many short lists and no cycles: looking for some takes an eighth of the time
        try:
            return self._encode(texts)
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        if len(self._ends) > REMEMBERED:
            self._forget()
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        texts = texts.fill_null("").cast(pa.large_string())
        parts = pc.split_pattern(texts, " ")
        words, at = parts.flatten(), np.asarray(parts.offsets) - parts.offsets[0].as_py()
        coded = words.dictionary_encode()
        place = self._places(_listed(coded.dictionary))[np.asarray(coded.indices)]
        place[at[:-1]] = self._leading_places(words.take(pa.array(at[:-1])).to_pylist())
        odd = np.flatnonzero(pc.match_substring_regex(texts, _BESIDE_SPACE).to_numpy(zero_copy_only=False))
        if len(odd):
            kept, counts, last = [], np.diff(at), 0
            for i in odd.tolist():
                cut = _SAFE_CUT.split(texts[i].as_py())
                own = np.concatenate([self._leading_places(cut[:1]), self._places(cut[1:])])
                kept += [place[last:at[i]], own]
                counts[i], last = len(own), at[i + 1]
            place = np.concatenate([*kept, place[last:]])
            at = np.concatenate(([0], np.cumsum(counts)))
        ends = np.frombuffer(self._ends, np.int64)
        start, length = ends[place], ends[place + 1] - ends[place]
        until = np.concatenate(([0], np.cumsum(length)))
        ids = np.frombuffer(self._flat, np.uint32)[np.repeat(start - until[:-1], length) + np.arange(until[-1])] \
            if until[-1] else np.empty(0, np.uint32)
        return ids, np.diff(until[at])


def encoder(path: str, plain: bool = False) -> Encoder:
    """This worker's encoder for a tokenizer file."""
    held = worker_memory().setdefault("encoders", {})
    if (path, plain) not in held:
        held[path, plain] = Encoder(path, plain)
    return held[path, plain]
