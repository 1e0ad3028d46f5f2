"""Burrows-Wheeler transform and common prefixes of a collection, built column by column.

Round j inserts, for every string at once, the suffix of length j. Two columns stand for the sorted suffixes so far:
entries (the symbol before a suffix, and how long a prefix it has in common with the one above) and keys (that symbol
and the suffix' position, sorted). The keys are the order of all suffixes one symbol longer, so the place of a key
says where its longer suffix belongs: those that the last round made new are inserted in this one. A round reads
both columns from front to back and writes them anew, piece by piece. Beyond ``MEMORY_SYMBOLS`` they are files.
Which suffix an entry stands for is read off the finished transform.
"""

from __future__ import annotations

import os
import tempfile
from contextlib import AbstractContextManager

import numpy as np

#: Symbols whose columns are kept in memory (10 bytes each while a round runs); larger collections use files.
MEMORY_SYMBOLS = 48 << 20
#: Entries that are written at once.
PIECE = 1 << 16
END = 0  # stands before a whole string

_SYMBOL = np.uint16(0xFF)


class Columns(AbstractContextManager):
    """Makes columns, in memory or as files of a folder of their own."""

    def __init__(self, on_disk: bool):
        self.folder = tempfile.TemporaryDirectory(prefix="columns-") if on_disk else None
        self.made = 0

    def __exit__(self, *_) -> None:
        if self.folder:
            self.folder.cleanup()

    def new(self, count: int, kind) -> np.ndarray:
        if not self.folder or not count:
            return np.empty(count, kind)
        self.made += 1
        return np.memmap(os.path.join(self.folder.name, str(self.made)), kind, "w+", shape=(count,))

    def done(self, column: np.ndarray) -> None:
        """The column isn't needed any more."""
        if isinstance(column, np.memmap):
            os.remove(column.filename)


class Transform:
    """The columns of ``text``, whose strings end at ``ends``; strings are shorter than 255 bytes.

    At most 255 byte values may occur (UTF-8 has 243). The first entries are the empty suffixes, string by string.
    """

    def __init__(self, text: bytes, ends: np.ndarray, columns: Columns, wide: bool | None = None):
        self.columns, self.ends, self.strings = columns, ends, len(ends)
        wide = len(text) + len(ends) >= 1 << 24 if wide is None else wide
        self.kind, self.shift = (np.uint64, np.uint64(40)) if wide else (np.uint32, np.uint32(24))
        self.low = self.kind((1 << int(self.shift)) - 1)
        raw = np.frombuffer(text, np.uint8)
        present = np.flatnonzero(np.bincount(raw, minlength=256))
        code = np.zeros(256, np.uint16)
        code[present] = np.arange(1, len(present) + 1)
        # The symbol before each place; END where a string begins.
        self.before = np.r_[np.uint16(END), code[raw]]
        starts = np.r_[0, ends[:-1]]
        last = np.where(ends > starts, self.before[ends], np.uint16(END))
        self.before[starts[ends > starts]] = END
        self.entries = last
        self.keys, new_at, order = self._keys(np.zeros(0, self.kind), last, np.arange(len(ends)), np.zeros(0, self.kind))
        place = np.asarray(ends, np.int64)[order]
        while len(new_at):
            new_at, place = self._round(new_at, place)

    def split(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return keys >> self.shift, (keys & self.low).astype(np.int64)

    def _round(self, new_at: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Insert the longer suffixes of the keys ``new_at``, whose suffixes begin at ``place``; returns the same for these."""
        sign, here = self.split(self.keys[new_at])
        n = len(self.keys)
        ended = int(np.searchsorted(self.keys, self.kind(1) << self.shift))
        at = self.strings - ended + new_at
        # Common prefix with the one above: the same symbol before, and the least of what lies between.
        sign_above, above = self.split(self.keys[np.maximum(new_at - 1, 0)])
        same = (sign_above == sign) & (new_at > 0)
        common = np.zeros(len(at), np.uint16)
        common[same] = self._least(above[same], here[same]) + np.uint16(1)
        # The one below, where it isn't new itself.
        sign_below, below = self.split(self.keys[np.minimum(new_at + 1, n - 1)])
        old = (sign_below == sign) & (new_at + 1 < n)
        follows = np.zeros(len(new_at), bool)  # the one above is new
        follows[1:] = new_at[1:] == new_at[:-1] + 1
        old[:-1] &= ~follows[1:]
        # It keeps what it had in common with the old one above both, if this one has more in common with that.
        between = np.flatnonzero(old & same & ~follows)
        had = self.entries[at[between] - between] >> np.uint16(8)
        old[between[common[between] > had]] = False
        value = self._least(here[old], below[old]) + np.uint16(1)
        place = place - 1
        symbols = self.before[place]
        now = self.columns.new(n, self.kind)
        moved = self._inserted(self.entries, at, symbols | common << np.uint16(8), now)
        edited = at[old] + 1
        moved[edited] = moved[edited] & _SYMBOL | value << np.uint16(8)
        self.columns.done(self.entries)
        self.entries = moved
        keys, new_at, order = self._keys(self.keys, symbols, at, now)
        self.columns.done(self.keys)
        self.columns.done(now)
        self.keys = keys
        return new_at, place[order]

    def _least(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The least common prefix of entries left + 1 .. right, for each pair; pairs ascend within a symbol."""
        if not len(left):
            return np.zeros(0, np.uint16)
        # Pairs go backwards, so that nothing is reduced from the end of one to the start of the next.
        edges = np.empty(2 * len(left), np.int64)
        edges[0::2], edges[1::2] = left[::-1] + 1, right[::-1] + 1
        last = edges == len(self.entries)
        if last.any():  # the end of a range may be the end of all; a pair there goes alone
            ends = np.flatnonzero(last[1::2])
            out = np.empty(len(left), np.uint16)
            for i in ends.tolist():
                out[i] = self.entries[edges[2 * i] :].min()
            rest = np.setdiff1d(np.arange(len(left)), ends)
            if len(rest):
                out[rest] = np.minimum.reduceat(self.entries, edges.reshape(-1, 2)[rest].ravel())[0::2]
        else:
            out = np.minimum.reduceat(self.entries, edges)[0::2]
        return out[::-1] >> np.uint16(8)

    def _inserted(self, old: np.ndarray, at: np.ndarray, new: np.ndarray, now: np.ndarray | None = None) -> np.ndarray:
        """``old`` with ``new`` at the positions ``at`` of the result; ``now`` gets where each of ``old`` stands in it."""
        total = len(old) + len(at)
        out = self.columns.new(total, old.dtype)
        for start in range(0, total, PIECE):
            stop = min(total, start + PIECE)
            i, j = np.searchsorted(at, (start, stop))
            kept = np.ones(stop - start, bool)
            kept[at[i:j] - start] = False
            piece = out[start:stop]
            piece[kept] = old[start - i : stop - j]
            piece[at[i:j] - start] = new[i:j]
            if now is not None:
                now[start - i : stop - j] = np.flatnonzero(kept) + start
        return out

    def _keys(self, old: np.ndarray, symbols: np.ndarray, at: np.ndarray, now: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Keys with the positions of now and those of the new entries; which of them are of entries that go on, and of which."""
        new = symbols.astype(self.kind) << self.shift | at.astype(self.kind)
        order = np.argsort(new)
        new = new[order]
        moved = self.columns.new(len(old), self.kind)
        for start in range(0, len(old), PIECE):
            piece = old[start : start + PIECE]
            moved[start : start + PIECE] = now[piece & self.low] | (piece & ~self.low)
        new_at = np.searchsorted(moved, new) + np.arange(len(new))
        keys = self._inserted(moved, new_at, new)
        self.columns.done(moved)
        going = symbols[order] != END
        return keys, new_at[going], order[going]

    def common(self) -> np.ndarray:
        return self.entries >> np.uint16(8)

    def places(self) -> np.ndarray:
        """Where in the text the suffix of each entry begins: from the empty suffixes on, all strings are walked at once."""
        longer, out = self.columns.new(len(self.keys), np.int64), self.columns.new(len(self.keys), np.int64)
        for start in range(0, len(self.keys), PIECE):
            piece = (self.keys[start : start + PIECE] & self.low).astype(np.int64)
            longer[piece] = np.arange(start, start + len(piece))
        place, entry = np.array(self.ends, np.int64), np.arange(self.strings)
        out[entry] = place
        while len(entry):
            entry = np.asarray(longer[entry])
            going = entry >= self.strings
            entry, place = entry[going], place[going] - 1
            out[entry] = place
        self.columns.done(longer)
        return out


def least_owner(strings: list[bytes], owner: np.ndarray, width: int) -> np.ndarray:
    """For each ``width`` bytes that begin in a string, the least owner of a string that holds the same bytes.

    ``owner`` has a number for each string. The answers come string by string, place by place.
    """
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes)
    text = b"".join(strings)
    # Owners by rank: 4 bytes per symbol are enough to tell strings apart.
    known, rank = np.unique(owner, return_inverse=True)
    whose = np.repeat(rank.astype(np.int32), sizes)
    answer = np.zeros(len(text) + 1, np.int32)
    with Columns(len(text) > MEMORY_SYMBOLS) as columns:
        transform = Transform(text, ends, columns)
        place, common = transform.places(), transform.common()
        start, n = len(strings), len(common)
        while start < n:  # whole classes, some at a time
            stop = min(n, start + PIECE)
            while stop < n and common[stop] >= width:
                stop += 1
            here = np.asarray(place[start:stop])
            heads = np.flatnonzero(np.r_[True, common[start + 1 : stop] < width])
            least = np.minimum.reduceat(whose[here], heads)
            answer[here] = np.repeat(least, np.diff(np.r_[heads, len(here)]))
            start = stop
    windows = np.maximum(sizes - width + 1, 0)
    at = np.repeat(ends - sizes - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
    return known[answer[at]]
