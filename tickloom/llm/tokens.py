"""Token ids of whole texts, for the operators that write or pack them."""

from __future__ import annotations

import os
import re

import numpy as np

from tickloom.llm.common import bounds, ragged
from tickloom.llm.words import BLANK, LOWER, HashIndex, span_hashes

#: Blanks beside the ASCII ones (a superset of what the vocabularies' patterns take as such), in UTF-8.
_WIDE = re.compile(b"|".join(chr(x).encode() for x in [0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
_ODD = BLANK.copy()
_ODD[0x1C:0x20] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_PUNCTUATION = np.zeros(256, bool)
_PUNCTUATION[list(b".,;:!?")] = True


def space_units(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Cut texts into units whose ids, one after the other, are the ids of the text, for byte-level vocabularies.

    Their pre-tokenizer always starts a piece at a single space between other characters, and at
    punctuation behind a letter, so a text may be cut there. Returns the buffer of all texts, starts and
    ends of the units, whether a unit has the space in front of it, and the units before each text.
    """
    joined = b"\n".join(texts) + b"\n"
    buffer = np.frombuffer(joined, np.uint8)
    odd = _ODD[buffer]
    if _WIDE.search(joined):
        odd |= buffer >= 0x80
    cut = np.zeros(len(buffer), bool)
    cut[1:-1] = (buffer[1:-1] == 0x20) & ~odd[:-2] & ~odd[2:]
    glued = np.zeros(len(buffer), bool)
    glued[1:] = _LETTER[buffer[:-1]] & _PUNCTUATION[buffer[1:]]
    firsts = bounds(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    begin = glued
    begin[1:] |= cut[:-1]
    begin[firsts[:-1]] = True
    starts = np.flatnonzero(begin)
    spaced = np.concatenate([[False], cut])[starts]
    ends = np.append(starts[1:], len(buffer))
    ends = ends - np.append(spaced[1:], False)  # the space belongs to the next unit
    at = np.searchsorted(starts, firsts)
    ends[at[1:] - 1] = firsts[1:] - 1  # the line end between two texts belongs to none
    return buffer, starts, ends, spaced, at


def word_units(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """The same for vocabularies that drop white space and case: words between ASCII white space.

    A unit that may hold a special token, which the tokenizer finds by its very bytes, keeps its case.
    """
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    buffer = LOWER[raw]
    dark = np.concatenate([[False], ~BLANK[buffer]])
    glued = np.zeros(len(buffer), bool)
    glued[1:] = _LETTER[buffer[:-1]] & _PUNCTUATION[buffer[1:]]
    starts = np.flatnonzero((dark[1:] & ~dark[:-1]) | glued)
    ends = np.flatnonzero((dark[:-1] & ~dark[1:]) | glued)
    opening = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
    if len(opening):
        special = np.unique(np.searchsorted(starts, opening, "right") - 1)
        there = ragged(starts[special], ends[special] - starts[special])
        buffer[there] = raw[there]
    firsts = bounds(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    return buffer, starts, ends, np.zeros(len(starts), bool), np.searchsorted(starts, firsts)


class Encoder:
    """Ids of texts by way of their units: a unit is encoded once and then looked up by its hash.

    Beyond ``most`` units all are forgotten, which costs time only.
    """

    def __init__(self, path: str, units, most: int = 800_000):
        from tokenizers import Tokenizer

        self.tokenizer, self.units, self.most = Tokenizer.from_file(path), units, most
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.forget()

    def forget(self) -> None:
        self.index = HashIndex()
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0
        self.ends, self.count = np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int32)

    def learn(self, hashes: np.ndarray, texts: list[str]) -> None:
        first = self.index.size
        self.index.add(hashes)
        while self.index.size > len(self.ends):
            self.ends, self.count = (np.concatenate([x, np.zeros_like(x)]) for x in (self.ends, self.count))
        for a in range(0, len(texts), 10_000):
            found = [x.ids for x in self.tokenizer.encode_batch_fast(texts[a : a + 10_000], add_special_tokens=False)]
            counts = np.fromiter(map(len, found), np.int64, len(found))
            need = self.used + int(counts.sum())
            while need > len(self.ids):
                self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
            self.ids[self.used : need] = np.fromiter((i for x in found for i in x), "<u4", need - self.used)
            here = slice(first + a, first + a + len(found))
            self.count[here], self.ends[here] = counts, self.used + np.cumsum(counts)
            self.used = need

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and how many each text has."""
        if self.index.size > self.most:
            self.forget()
        buffer, starts, ends, spaced, at = self.units(texts)
        hashes = span_hashes(buffer, starts, ends) ^ spaced
        places = self.index.find(hashes)
        unknown = np.flatnonzero(places < 0)
        if len(unknown):
            new, where = np.unique(hashes[unknown], return_index=True)
            where = unknown[where]
            raw = buffer.tobytes()
            spans = zip(starts[where].tolist(), ends[where].tolist(), spaced[where].tolist())
            self.learn(new, [(b" " + raw[a:b] if s else raw[a:b]).decode() for a, b, s in spans])
            places[unknown] = self.index.find(hashes[unknown])
        counts = self.count[places]
        total = bounds(counts)
        return self.ids[ragged(self.ends[places] - counts, counts)], total[at[1:]] - total[at[:-1]]


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, units) -> Encoder:
    """One encoder for each vocabulary in a worker process, kept from task to task."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if (path, units.__name__) not in _ENCODERS:
        _ENCODERS[path, units.__name__] = Encoder(path, units)
    return _ENCODERS[path, units.__name__]


def public_vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)
