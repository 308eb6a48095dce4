"""Token ids of many texts at once for a word-level BPE vocabulary file.

The vocabulary splits a lower-cased text into words, single digits and runs of other marks, and
encodes each piece by itself. So a piece has the same ids wherever it stands: pieces are found and
looked up with array operations, and only pieces not met before go through the tokenizer. Texts with
anything beyond ASCII and the Latin-1 letters, or with the string of a special token, are encoded
whole by the tokenizer instead, so all ids are the tokenizer's own.
"""

from __future__ import annotations

import numpy as np

SPACE, LETTER, DIGIT, MARK, OTHER = range(5)
LONGEST = 64  # bytes of a piece that is remembered
POOL_IDS = 4_000_000
CHUNK_BYTES = 1 << 18


def _classes() -> np.ndarray:
    kind = np.full(256, OTHER, dtype=np.uint8)
    kind[33:127] = MARK
    for b in b" \t\n\x0b\x0c\r":
        kind[b] = SPACE
    kind[ord("0"):ord("9") + 1] = DIGIT
    for low, high in (("a", "z"), ("A", "Z")):
        kind[ord(low):ord(high) + 1] = LETTER
    kind[0x80:0xC0] = LETTER  # second byte; only valid after 0xC3, which `plain` checks
    kind[0xC3] = LETTER
    return kind


KIND = _classes()
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A"):ord("Z") + 1] += 32
_ODD = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def plain(text: bytes) -> bool:
    """Whether the array path is exact for this text: ASCII without control codes, letters of Latin-1
    (0xC3 with a second byte other than the multiplication and division signs), no special token."""
    if b"<|" in text:
        return False
    a = np.frombuffer(text, dtype=np.uint8)
    if text.isascii():
        return not (KIND[a] == OTHER).any()
    high = a >= 0x80
    lead = a == 0xC3
    second = np.zeros(len(a), dtype=bool)
    second[1:] = lead[:-1]
    return not ((KIND[a] == OTHER).any() or (high & ~lead & ~second).any() or (second & ((a == 0x97) | (a == 0xB7))).any())


class WordBPE:
    """Encoder with a memory of pieces. The memory is bounded: it starts anew beyond ``POOL_IDS`` ids."""

    def __init__(self, path: str, slots: int = 1 << 20):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        if max(vocabulary.values()) >= 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        self.ends_word = np.zeros(1 << 16, dtype=bool)
        self.ends_word[[i for piece, i in vocabulary.items() if piece.endswith("</w>")]] = True
        self.slots = slots
        powers = np.empty(CHUNK_BYTES + 2, dtype=np.uint64)
        powers[0] = 1
        inverse = powers.copy()
        powers[1:], inverse[1:] = _BASE, _INVERSE
        self.powers, self.inverse = np.multiply.accumulate(powers), np.multiply.accumulate(inverse)
        self._forget()

    def _forget(self) -> None:
        self.known = np.zeros(self.slots, dtype=np.uint64)
        self.at = np.zeros(self.slots, dtype=np.int32)
        self.count = np.zeros(self.slots, dtype=np.int16)
        self.pool, self.used = np.empty(1 << 16, dtype=np.uint16), 0

    def _whole(self, text: bytes) -> np.ndarray:
        return np.array(self.tokenizer.encode(text.decode("utf-8"), add_special_tokens=False).ids, dtype=np.uint16)

    def _pieces(self, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the pieces of lower-cased bytes."""
        kind = KIND[a]
        before = np.empty_like(kind)
        before[0], before[1:] = SPACE, kind[:-1]
        edge = kind != before
        start = (edge | (kind == DIGIT)) & (kind != SPACE)
        quotes = np.nonzero((a == 39) & edge)[0]  # contractions: only a mark that starts a run
        for q in quotes[quotes + 1 < len(a)]:
            one, two = a[q + 1:q + 2].tobytes(), a[q + 1:q + 3].tobytes()
            width = 2 if one in (b"s", b"t") else 3 if two in (b"re", b"ve", b"ll") else 2 if one in (b"m", b"d") else 0
            if width:
                start[q + 1] = False
                if q + width < len(a) and kind[q + width] == LETTER:
                    start[q + width] = True
        starts = np.nonzero(start)[0]
        stop = np.nonzero(edge & (kind == SPACE))[0]
        bounds = np.sort(np.concatenate([starts, stop, [len(a)]]))
        return starts, bounds[np.searchsorted(bounds, starts, side="right")]

    def _find(self, names: np.ndarray) -> np.ndarray:
        """Slot of each name, or -1."""
        slot = (names >> np.uint64(40)).astype(np.int64) % self.slots
        out = np.where(self.known[slot] == names, slot, -1)
        for step in range(1, 4):
            left = np.nonzero(out < 0)[0]
            if not len(left):
                break
            at = (slot[left] + step) % self.slots
            out[left] = np.where(self.known[at] == names[left], at, -1)
        return out

    def _learn(self, names: np.ndarray, pieces: list[bytes]) -> None:
        ids = np.array(self.tokenizer.encode(b" ".join(pieces).decode("utf-8"), add_special_tokens=False).ids, dtype=np.uint16)
        ends = np.nonzero(self.ends_word[ids])[0] + 1
        if len(ends) != len(pieces):
            raise ValueError("the vocabulary does not encode pieces one by one")
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[:self.used], np.empty(max(len(ids), len(self.pool)), dtype=np.uint16)])
        self.pool[self.used:self.used + len(ids)] = ids
        begins = np.concatenate([[0], ends[:-1]])
        left = np.arange(len(names))
        home = (names >> np.uint64(40)).astype(np.int64) % self.slots
        for step in (0, 1, 2, 3, 0):  # the last round takes the first slot whatever it holds
            slot = (home[left] + step) % self.slots
            _, first = np.unique(slot, return_index=True)
            free = np.zeros(len(left), dtype=bool)
            free[first] = True
            if len(left) and not (step == 0 and len(left) < len(names)):
                free &= self.known[slot] == 0
            mine, place = left[free], slot[free]
            self.known[place], self.at[place], self.count[place] = names[mine], self.used + begins[mine], ends[mine] - begins[mine]
            left = left[~free]
            if not len(left):
                break
        self.used += len(ids)

    def _chunk(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of plain texts whose joined bytes fit a chunk."""
        line = b"\n".join(texts)
        a = LOWER[np.frombuffer(line, dtype=np.uint8)]
        if b"\xc3" in line:  # capital letters of Latin-1: one bit of the second byte
            second = np.zeros(len(a), dtype=bool)
            second[1:] = a[:-1] == 0xC3
            a[second & (a >= 0x80) & (a <= 0x9E)] += 0x20
        starts, ends = self._pieces(a)
        limits = np.cumsum([len(t) + 1 for t in texts])
        piece_limits = np.searchsorted(starts, limits)
        total = np.zeros(len(a) + 1, dtype=np.uint64)
        np.cumsum(_ODD[a] * self.powers[1:len(a) + 1], out=total[1:])
        names = (total[ends] - total[starts]) * self.inverse[starts]
        names ^= names >> np.uint64(29)
        names *= np.uint64(0xBF58476D1CE4E5B9)
        names ^= (ends - starts).astype(np.uint64)
        names |= np.uint64(1)
        if self.used > POOL_IDS:
            self._forget()
        slot = self._find(names)
        long = (ends - starts) > LONGEST
        slot[long] = -1
        missing = np.nonzero(slot < 0)[0]
        own: dict[int, np.ndarray] = {}
        if len(missing):
            short = missing[~long[missing]]
            if len(short):
                new, first = np.unique(names[short], return_index=True)
                self._learn(new, [a[starts[i]:ends[i]].tobytes() for i in short[first]])
                slot = self._find(names)  # of all pieces: learning may have taken the slot of one that was found
                slot[long] = -1
            for i in np.nonzero(slot < 0)[0]:  # long pieces, and the few that lost their slot at once
                own[int(i)] = self._whole(a[starts[i]:ends[i]].tobytes())
        counts = np.where(slot >= 0, self.count[slot], 0).astype(np.int64)
        for i, ids in own.items():
            counts[i] = len(ids)
        offset = np.zeros(len(counts) + 1, dtype=np.int64)
        np.cumsum(counts, out=offset[1:])
        source = np.repeat(self.at[slot].astype(np.int64) - offset[:-1], counts) + np.arange(offset[-1])
        if own:
            source = np.clip(source, 0, len(self.pool) - 1)
        out = self.pool[source]
        for i, ids in own.items():
            out[offset[i]:offset[i + 1]] = ids
        return np.split(out, offset[piece_limits[:-1]])

    def encode(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids (uint16) of each UTF-8 text, as the tokenizer gives them without special tokens."""
        out: list = [None] * len(texts)
        chunk, size = [], 0

        def flush():
            if chunk:
                for i, ids in zip(chunk, self._chunk([texts[i] for i in chunk])):
                    out[i] = ids

        for i, text in enumerate(texts):
            if not text:
                out[i] = np.empty(0, dtype=np.uint16)
                continue
            if len(text) >= CHUNK_BYTES or not plain(text):
                out[i] = self._whole(text)
                continue
            if size + len(text) + 1 > CHUNK_BYTES:
                flush()
                chunk, size = [], 0
            chunk.append(i)
            size += len(text) + 1
        flush()
        return out
