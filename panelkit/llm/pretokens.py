"""The pieces into which byte-level BPE vocabularies cut a text before merging.

The usual pattern (contractions, then runs of letters, digits, other characters with one space
in front, then white space) is evaluated on whole batches: every character gets a class, runs
of a class are pieces, and a few corrections move the space before a run into it and split
contractions off. Equal pieces are found by hash, so a piece is encoded once per batch.
"""

from __future__ import annotations

import functools

import numpy as np
import regex

from panelkit.llm import flat

LETTER, NUMBER, BLANK, OTHER = 0, 1, 2, 3


@functools.cache
def classes() -> np.ndarray:
    """The class of each code point."""
    out = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for pattern, kind in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", BLANK)):
        found = "".join(regex.findall(pattern + "+", every))
        out[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    return out


@functools.cache
def _ascii() -> np.ndarray:
    return np.concatenate([classes()[:128], np.full(128, OTHER, np.uint8)])


def _kinds(data: np.ndarray) -> np.ndarray:
    """The class of each byte's character."""
    kind = _ascii()[data]
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        padded = np.concatenate([data, np.zeros(3, np.uint8)])
        b = padded[lead].astype(np.uint32)
        one, two, three = (padded[lead + i].astype(np.uint32) & 0x3F for i in (1, 2, 3))
        code = np.where(
            b < 0xE0,
            ((b & 0x1F) << 6) | one,
            np.where(
                b < 0xF0,
                ((b & 0x0F) << 12) | (one << 6) | two,
                ((b & 0x07) << 18) | (one << 12) | (two << 6) | three,
            ),
        )
        found = classes()[code]
        kind[lead] = kind[lead + 1] = found
        for width, first in ((2, 0xE0), (3, 0xF0)):
            long = b >= first
            kind[lead[long] + width] = found[long]
    return kind


def pieces(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Start, end and text number of each piece, and whether it ends in white space.

    The pieces of a text cover it.
    """
    n = len(data)
    if n == 0:
        return (*[np.zeros(0, np.int64)] * 3, np.zeros(0, bool))
    kind = _kinds(data)
    heads = offsets[:-1][offsets[:-1] < n]
    cut = np.ones(n, bool)  # a piece begins here
    np.not_equal(kind[1:], kind[:-1], out=cut[1:])
    cut[heads] = True

    # White space before something else in the same text: its last character stands apart,
    # and if that is a plain space it belongs to what follows.
    blank = kind == BLANK
    ends_here = blank[:-1] & ~blank[1:]
    ends_here[heads[heads > 0] - 1] = False
    last = np.flatnonzero(ends_here)
    plain = data[last] == 0x20
    cut[last[plain]] = True
    cut[last[plain] + 1] = False
    rest = last[~plain]
    for _ in range(3):  # to the first byte of the character
        rest = np.where((data[rest] & 0xC0) == 0x80, rest - 1, rest)
    cut[rest] = True

    # Contractions: an apostrophe that begins a piece, followed by one of the endings.
    quote = np.flatnonzero((data == 0x27) & cut)
    if len(quote):
        padded = np.concatenate([data, np.zeros(2, np.uint8)])
        one, two = padded[quote + 1], padded[quote + 2]
        room = offsets[np.searchsorted(offsets, quote, "right")] - quote
        single = np.isin(one, np.frombuffer(b"stmd", np.uint8)) & (room >= 2)
        double = np.zeros(len(quote), bool)
        for a, b in (b"re", b"ve", b"ll"):
            double |= (one == a) & (two == b)
        double &= (room >= 3) & ~single
        for found, width in ((quote[single], 2), (quote[double], 3)):
            cut[found + 1] = False
            after = found + width
            cut[after[after < n]] = True
    starts = np.flatnonzero(cut)
    ends = np.append(starts[1:], n)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1, blank[ends - 1]


class Encoder:
    """Token ids of texts, from a function that encodes distinct pieces.

    The function takes two lists of pieces in UTF-8, those that do not end in white space and
    those that do, and returns all their ids in turn and the number of ids of each piece.
    Remembers the ids of up to ``remember`` pieces by hash, and forgets all beyond that.
    """

    def __init__(self, encode_pieces, remember: int = 400_000):
        self.encode_pieces, self.remember = encode_pieces, remember
        self._forget()

    def _forget(self):
        self.hashes = np.zeros(0, np.uint64)
        self.begin, self.count = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after the other, and the number of ids of each text."""
        starts, ends, docs, blank = pieces(data, offsets)
        hashes = flat.hash_spans(data, starts, ends)
        distinct, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hashes, distinct)
        near = np.minimum(place, max(0, len(self.hashes) - 1))
        known = self.hashes[near] == distinct if len(self.hashes) else np.zeros(len(distinct), bool)
        new = np.flatnonzero(~known)
        if len(new):
            if len(self.hashes) + len(new) > self.remember and len(self.hashes):
                self._forget()
                new = np.arange(len(distinct))
            spaced = blank[first[new]]
            new = np.concatenate([new[~spaced], new[spaced]])
            raw = data.tobytes()
            spots = zip(starts[first[new]].tolist(), ends[first[new]].tolist())
            found = [raw[a:b] for a, b in spots]
            solid = len(found) - int(spaced.sum())
            flat_ids, count = self.encode_pieces(found[:solid], found[solid:])
            begin = len(self.ids) + np.cumsum(count) - count
            merged = np.concatenate([self.hashes, distinct[new]])
            order = np.argsort(merged, kind="stable")
            self.hashes = merged[order]
            self.begin = np.concatenate([self.begin, begin])[order]
            self.count = np.concatenate([self.count, count])[order]
            self.ids = np.concatenate([self.ids, flat_ids])
        at = np.searchsorted(self.hashes, distinct)
        begin, count = self.begin[at][back], self.count[at][back]
        total = np.bincount(docs, weights=count, minlength=len(offsets) - 1).astype(np.int64)
        ends_at = np.cumsum(count)
        size = int(ends_at[-1]) if len(ends_at) else 0
        where = np.arange(size) - np.repeat(ends_at - count - begin, count)
        return self.ids[where], total
