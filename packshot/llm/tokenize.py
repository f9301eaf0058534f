"""Token ids of whole texts by the ``tokenizers`` library, with each distinct piece encoded once.

A byte-level BPE of this kind first cuts a text into pieces and then encodes every piece by itself.
Some of its cuts can be told from ASCII bytes alone: before a single space between two other
characters, around a single line break between two others, and between an ASCII letter or digit and
ASCII punctuation (but no apostrophe). Cutting there and encoding what lies between gives the ids of
the whole text. A worker keeps the ids of pieces it has met in a table of fixed size; texts with other
white space or control characters are encoded whole, and so are texts with the string of an added token
(``<|endoftext|>``), which the library gives its own id.
"""

from __future__ import annotations

import re
import sys

import numpy as np

from packshot.llm.arrow_text import ragged, span_hashes

SLOTS = 1 << 21
POOL_IDS = 24 << 20
_SPACE, _BREAK, _WHITE, _ALNUM, _PUNCT = range(5)
_KINDS = np.zeros((5, 256), bool)
_KINDS[_SPACE, 0x20] = _KINDS[_BREAK, 0x0A] = True
_KINDS[_WHITE, [0x20, *range(0x09, 0x0E)]] = True
_KINDS[_ALNUM, [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_KINDS[_PUNCT, [c for c in range(0x21, 0x7F) if not chr(c).isalnum() and c != 0x27]] = True
# control characters, and the first bytes of white space beyond ASCII and of invisible characters
_ODD = np.zeros(256, bool)
_ODD[[*range(0x09), *range(0x0E, 0x20), 0x7F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF]] = True
_ODD_SEQUENCE = re.compile(
    rb"[\x00-\x08\x0e-\x1f\x7f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8-\xaf]|\xe2\x81[\x9f-\xaf]|\xe3\x80\x80|\xef\xbb\xbf"
)


class PieceEncoder:
    """Ids of texts; one per worker and tokenizer file, kept between tasks (:func:`encoder`)."""

    def __init__(self, path: str) -> None:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = sorted((t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile(b"|".join(map(re.escape, added)) or rb"(?!)")
        size = self.tokenizer.get_vocab_size()
        spaced = [self.tokenizer.id_to_token(i) or "" for i in range(size)]
        # byte-level spellings of the space and the line break
        self.starts_piece = np.array([t.startswith("Ġ") for t in spaced], bool)
        self.break_id = self.tokenizer.token_to_id("Ċ")
        self.forget()

    def forget(self) -> None:
        self.keys = np.zeros(SLOTS, np.uint64)
        self.where = np.zeros(SLOTS, np.int32)
        self.sizes = np.zeros(SLOTS, np.int32)
        self.pool = np.zeros(1 << 20, np.int32)
        self.used = 0

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts, and the number of ids of each (``raw``, ``offsets``: ``arrow_text.buffer``)."""
        n_texts = len(offsets) - 1
        if not len(raw):
            return np.zeros(0, np.int32), np.zeros(n_texts, np.int64)
        if self.used > POOL_IDS:
            self.forget()
        starts = _cuts(raw, offsets)
        ends = np.append(starts[1:], len(raw))
        first = np.searchsorted(starts, offsets)
        odd = self._unusual(raw, offsets)
        if len(odd):  # an unusual text is one piece
            keep = np.ones(len(starts), bool)
            for i in odd:
                keep[first[i] + 1 : first[i + 1]] = False
            starts = starts[keep]
            ends = np.append(starts[1:], len(raw))
            first = np.searchsorted(starts, offsets)
        where, sizes = self._pieces(raw, starts, ends)
        ids = self.pool[ragged(where, sizes)]
        sums = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(sizes, out=sums[1:])
        return ids, np.diff(sums[first])

    def _unusual(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        at = [i for i in np.flatnonzero(_ODD[raw]).tolist() if _ODD_SEQUENCE.match(raw[i : i + 3].tobytes())]
        at = np.array(at + self._added_at(raw, offsets), np.int64)
        return np.unique(np.searchsorted(offsets, at, side="right") - 1)

    def _added_at(self, raw: np.ndarray, offsets: np.ndarray) -> list[int]:
        """The starts of texts with the string of an added token."""
        data = raw.tobytes()
        if not self.added.search(data):
            return []
        return [a for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True) if self.added.search(data, a, b)]

    def _pieces(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        hashes = span_hashes(raw, starts, ends) | np.uint64(1)
        slots = [(hashes >> np.uint64(s)).astype(np.int64) & (SLOTS - 1) for s in (1, 33)]
        where, sizes = np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
        missing = np.ones(len(starts), bool)
        for slot in slots:
            hit = missing & (self.keys[slot] == hashes)
            where[hit], sizes[hit] = self.where[slot[hit]], self.sizes[slot[hit]]
            missing &= ~hit
        if missing.any():
            at = np.flatnonzero(missing)
            new, one, back = np.unique(hashes[at], return_index=True, return_inverse=True)
            one = at[one]
            got_where, got_sizes = self._encode_new(raw, starts[one], ends[one])
            where[at], sizes[at] = got_where[back], got_sizes[back]
            one_slots = [slot[one] for slot in slots]
            second = self.keys[one_slots[0]] != 0  # the second place if the first is taken
            slot = np.where(second & (self.keys[one_slots[1]] == 0), one_slots[1], one_slots[0])
            self.keys[slot], self.where[slot], self.sizes[slot] = new, got_where, got_sizes
            # of new pieces that share a slot the last stays; key, place and size have to be the same one's
            lost = self.keys[slot] != new
            self.where[slot[~lost]], self.sizes[slot[~lost]] = got_where[~lost], got_sizes[~lost]
        return where, sizes

    def _encode_new(self, raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data = raw.tobytes()
        texts = [data[a:b].decode("utf-8") for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        found: list = [None] * len(texts)
        spaced, plain, rest = [], [], []
        for i, t in enumerate(texts):
            if self.added.search(data, starts[i], ends[i]):
                rest.append(i)
            elif t[0] == " " and len(t) > 1 and not _white(t[1:]):
                spaced.append(i)
            elif not _white(t):
                plain.append(i)
            else:
                rest.append(i)
        self._joined(texts, spaced, "", self.starts_piece, found, rest)
        breaks = np.zeros(len(self.starts_piece), bool)
        breaks[self.break_id] = True
        self._joined(texts, plain, "\n", breaks, found, rest)
        for i in range(0, len(rest), 512):
            for j, ids in zip(rest[i : i + 512], self.whole([texts[j] for j in rest[i : i + 512]]), strict=True):
                found[j] = np.array(ids, np.int32)
        sizes = np.array([len(x) for x in found], np.int64)
        where = self.used + np.cumsum(sizes) - sizes
        need = self.used + int(sizes.sum())
        if need > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(need, 2 * len(self.pool)) - len(self.pool), np.int32)])
        self.pool[self.used : need] = np.concatenate(found) if found else []
        self.used = need
        return where, sizes

    def _joined(self, texts, which, lead: str, marks: np.ndarray, found: list, rest: list) -> None:
        """Encode pieces in rows of 256, told apart by the ids that can only begin a piece."""
        for i in range(0, len(which), 256):
            row = which[i : i + 256]
            ids = np.array(self.whole(["".join(lead + texts[j] for j in row)])[0], np.int32)
            at = np.flatnonzero(marks[ids])
            if len(at) != len(row) or at[0] != 0:
                rest.extend(row)
                continue
            for j, part in zip(row, np.split(ids, at[1:]), strict=True):
                found[j] = part[len(lead) :]


def _white(text: str) -> bool:
    return len(text.split(None, 1)) != 1 or text[0].isspace() or text[-1].isspace()


def _cuts(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where pieces start: the starts of non-empty texts and the cuts named at the top."""
    n = len(raw)
    white, alnum, punct = _KINDS[_WHITE][raw], _KINDS[_ALNUM][raw], _KINDS[_PUNCT][raw]
    cut = np.zeros(n + 1, bool)
    if n > 2:
        between = ~white[:-2] & ~white[2:]
        alone = between & _KINDS[_BREAK][raw[1:-1]]
        cut[1 : n - 1] = alone | between & _KINDS[_SPACE][raw[1:-1]]
        cut[2:n] |= alone
    cut[1:n] |= alnum[:-1] & punct[1:] | punct[:-1] & alnum[1:]
    # white space at the border of two texts has no neighbour on one side
    edge = offsets[1:-1]
    for at in (edge, edge + 1):
        at = at[(at > 0) & (at < n)]
        cut[at] = False
    last = offsets[1:] - 1
    last = last[(last > 0) & (last < n)]
    blank = white[last]
    cut[last[blank]] = False
    cut[offsets[:-1]] = True
    cut[0] = True
    return np.flatnonzero(cut[:n])


def encoder(path: str) -> PieceEncoder:
    kept = sys.__dict__.setdefault("_piece_encoders", {})
    if path not in kept:
        kept[path] = PieceEncoder(path)
    return kept[path]
