"""Ids of whole texts by the tokenizers library, at the speed of a table lookup for the words seen before.

A text is cut where every tokenizer here has a boundary anyway: before a single space between two visible characters, between a
Latin letter and one of ``. , ! ? ; : * # $ % &``, and between a single line's end after a visible character and a Latin letter. Neither a pre-token nor a normalisation nor a special token crosses such a place, so the ids of
the pieces, joined, are the ids of the text. Pieces are looked up by a 64-bit hash in a bounded table; the tokenizers library encodes those not in it,
words of Latin letters after a space many at a time: the places between them are such boundaries too.
"""

from __future__ import annotations

import os

import numpy as np

from pednet.llm.common import mix, powers

#: Pieces that a worker keeps, and ids that these may fill; the table starts anew beyond either.
SLOTS = 1 << 20
ARENA = 6 << 20

_R = np.random.default_rng(11).integers(1, 1 << 63, 256, dtype=np.uint64)
_P = 0xD6E8FEB86659FD93
_PINV = pow(_P, -1, 1 << 64)
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in ".,!?;:*#$%&"]] = True
_VISIBLE = np.zeros(256, bool)
_VISIBLE[0x21:0x7F] = True
#: Words after a space begin and end where texts are cut; how many of these the library gets as one text.
GROUP = 48
_encoders: dict[str, Encoder] = {}


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(path: str) -> Encoder:
    """The worker's encoder for a tokenizer file; it stays for later tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.t = Tokenizer.from_file(path)
        self.clear()

    def clear(self) -> None:
        self.key = np.zeros(SLOTS, np.uint64)
        self.at = np.zeros(SLOTS, np.int32)
        self.n = np.zeros(SLOTS, np.int32)
        self.ids = np.zeros(ARENA, np.uint16)
        self.used = 0

    def cuts(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where pieces start, and which bytes belong to Latin letters."""
        cut, latin = np.zeros(len(data), bool), np.zeros(len(data), bool)
        latin[1:] = (data[:-1] == 0xC3) & (data[1:] & 0xC0 == 0x80) & (data[1:] != 0x97) & (data[1:] != 0xB7)  # last byte of a letter from U+00C0 to U+00FF
        letter = _LETTER[data] | latin
        letter[:-1] |= latin[1:]
        if len(data) > 2:
            first = (data == 0xC3)  # first byte of a character from U+00C0 to U+00FF
            ends, begins = _VISIBLE[data] | latin, _VISIBLE[data] | first
            cut[1:-1] = (data[1:-1] == 0x20) & ends[:-2] & begins[2:]
            cut[1:] |= (_LETTER[data[:-1]] | latin[:-1]) & _MARK[data[1:]]
            cut[2:] |= (data[1:-1] == 0x0A) & ends[:-2] & letter[2:]
        starts = off[:-1][off[1:] > off[:-1]]
        cut[starts] = True
        return np.flatnonzero(cut), letter

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents, one after another, and each document's number of ids."""
        if len(data) == 0:
            return np.zeros(0, np.uint16), np.zeros(len(off) - 1, np.int64)
        start, letter = self.cuts(data, off)
        end = np.append(start[1:], len(data))
        with np.errstate(over="ignore"):
            h = np.add.reduceat(_R[data] * powers(_P, len(data)), start) * powers(_PINV, len(data))[start]
            h = mix(h + (end - start).astype(np.uint64)) | np.uint64(1)
        slot = (h >> np.uint64(13)).astype(np.int64) & (SLOTS - 1)
        missing = np.flatnonzero(self.key[slot] != h)
        extra, direct = [], {}
        if len(missing):
            _, one = np.unique(h[missing], return_index=True)
            one = missing[one]
            which, flat, size = self.some(data, start[one], end[one], letter)
            one = one[which]
            if self.used + size.sum() > ARENA:
                self.clear()
                return self.encode(data, off) if size.sum() <= ARENA else self._plain(data, off)
            at = self.used + np.concatenate([[0], np.cumsum(size)[:-1]])
            self.ids[self.used : self.used + len(flat)] = flat
            self.used += len(flat)
            order = np.argsort(h[one], kind="stable")
            extra = (h[one][order], at[order], size[order])
        where, n = self.at[slot].astype(np.int64), self.n[slot].astype(np.int64)
        if len(missing):
            k = np.searchsorted(extra[0], h[missing])
            where[missing], n[missing] = extra[1][k], extra[2][k]
            s = slot[one]
            self.key[s], self.at[s], self.n[s] = h[one], extra[1][np.searchsorted(extra[0], h[one])], size
        total = np.concatenate([[0], np.cumsum(n)])
        ids = self.ids[np.repeat(where - total[:-1], n) + np.arange(total[-1])]
        first = np.searchsorted(start, off)
        return ids, np.diff(total[first])

    def each(self, pieces: list[str]) -> list[list[int]]:
        """The ids of each piece."""
        parts = [p.encode() for p in pieces]
        off = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
        data = np.frombuffer(b"".join(parts), np.uint8)
        which, flat, size = self.some(data, off[:-1], off[1:], self.cuts(data, off)[1])
        got = dict(zip(which.tolist(), np.split(flat, np.cumsum(size)[:-1]), strict=True))
        return [got[i].tolist() for i in range(len(pieces))]

    def some(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pieces in another order, all their ids, and each one's number of ids. A group of words after a space whose parts by the library are as many as its
        words has one for each, as none is without ids; words of other groups are encoded one by one."""
        inside, raw = np.concatenate([[0], np.cumsum(letter)]), data.tobytes()
        word = (end - start > 1) & (data[np.minimum(start, len(data) - 1)] == 0x20) & (inside[end] - inside[np.minimum(start + 1, end)] == end - start - 1)
        cut = lambda at: [raw[a:b] for a, b in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        words, rest, flat, size = np.flatnonzero(word), [np.flatnonzero(~word)], [], []
        groups, texts, which = [words[k : k + GROUP] for k in range(0, len(words), GROUP)], cut(words), []
        joined = [b"".join(texts[k : k + GROUP]).decode("utf-8", "replace") for k in range(0, len(words), GROUP)]
        for g, e in zip(groups, self.t.encode_batch(joined, add_special_tokens=False), strict=True):
            part = np.array(e.word_ids, np.int64)
            at = np.concatenate([[0], np.flatnonzero(part[1:] != part[:-1]) + 1, [len(part)]])
            if len(at) != len(g) + 1 or not len(part):
                rest.append(g)
                continue
            which.append(g)
            flat.append(np.array(e.ids, np.uint16))
            size.append(np.diff(at))
        others = np.concatenate(rest)
        got = [e.ids for e in self.t.encode_batch_fast([x.decode("utf-8", "replace") for x in cut(others)], add_special_tokens=False)]
        flat.append(np.fromiter((i for x in got for i in x), np.uint16))
        size.append(np.fromiter(map(len, got), np.int64, len(got)))
        return np.concatenate([*which, others]), np.concatenate(flat), np.concatenate(size)

    def _plain(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        raw = data.tobytes()
        got = [e.ids for e in self.t.encode_batch_fast([raw[a:b].decode("utf-8", "replace") for a, b in zip(off[:-1], off[1:], strict=True)], add_special_tokens=False)]
        return np.fromiter((i for x in got for i in x), np.uint16), np.fromiter(map(len, got), np.int64, len(got))


def with_end(ids: np.ndarray, n: np.ndarray, end: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The end id after each document's ids; the documents' new lengths."""
    at = np.cumsum(n)
    return np.insert(ids, at, end).astype(np.uint16), n + 1
