"""Token ids of whole texts by the tokenizers library, with every distinct word encoded once."""

from __future__ import annotations

import os

import numpy as np

#: Of the words that a worker keeps; beyond it the store starts anew.
KEPT_WORDS = 1_500_000
#: Words that go to the library as one text.
TOGETHER = 100
#: Bytes of text that one step encodes; it needs some sixty times as much.
STEP = 1 << 20
#: Longer words, in bytes, are looked up one by one.
SHORT = 32

_M1, _M2, _ODD = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
#: The lowest 0 to 8 bytes.
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x ^= x >> np.uint64(30)
    x *= _M1
    x ^= x >> np.uint64(27)
    x *= _M2
    x ^= x >> np.uint64(31)
    return x


def _shown(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Whether a character, by its first two bytes, has no part in white space: visible ASCII, U+00A1 to U+023F."""
    return ((first > 0x20) & (first < 0x7F)) | ((first > 0xC2) & (first < 0xC9)) | ((first == 0xC2) & (second > 0xA0))


class Store:
    """Words' ids: a hash table of at most ``kept`` words over one array of ids.

    A word is known by a 64-bit hash of all its bytes and by its first eight bytes as they are.
    """

    def __init__(self, kept: int):
        self.bits = max(kept * 2 - 1, 1).bit_length()
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.hash, self.lead = np.zeros(kept, np.uint64), np.zeros(kept, np.uint64)
        self.start, self.count = np.zeros(kept, np.int32), np.zeros(kept, np.int32)
        self.ids, self.used, self.words = np.zeros(1 << 16, np.uint32), 0, 0
        self.named: dict[bytes, int] = {}  # long words, and first words of texts

    def add(self, ids: list[np.ndarray]) -> np.ndarray:
        """Numbers of new words that have these ids."""
        sizes = np.array([len(x) for x in ids], np.int64)
        total = int(sizes.sum())
        while self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        numbers = np.arange(self.words, self.words + len(ids))
        self.start[numbers] = self.used + np.cumsum(sizes) - sizes
        self.count[numbers] = sizes
        if total:
            self.ids[self.used : self.used + total] = np.concatenate(ids)
        self.used += total
        self.words += len(ids)
        return numbers

    def _places(self, h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, h: np.ndarray, lead: np.ndarray) -> np.ndarray:
        """Numbers of words, -1 for those that are not known."""
        at, out = self._places(h), np.full(len(h), -1, np.int32)
        todo = np.arange(len(h))
        while len(todo):
            found = self.slots[at]
            there = found >= 0
            hit = there & (self.hash[found] == h) & (self.lead[found] == lead)
            out[todo[hit]] = found[hit]
            on = there & ~hit
            todo, h, lead, at = todo[on], h[on], lead[on], (at[on] + 1) & (len(self.slots) - 1)
        return out

    def enter(self, h: np.ndarray, lead: np.ndarray, numbers: np.ndarray) -> None:
        """Make new words known; none may come twice."""
        self.hash[numbers], self.lead[numbers] = h, lead
        at = self._places(h)
        while len(numbers):
            free = self.slots[at] < 0
            self.slots[at[free]] = numbers[free]
            on = self.slots[at] != numbers  # the slot was taken, before or just now
            numbers, at = numbers[on], (at[on] + 1) & (len(self.slots) - 1)


class WordEncoder:
    """Ids as little-endian unsigned 32-bit bytes, equal to encoding the whole text at once. Texts are UTF-8.

    The split that precedes the merges starts a new piece at a single space between two visible
    characters, so a text can be cut there, and words can be put together there. All words of a step are
    looked up at once; new ones are encoded, many as one text, and told apart by the tokens that begin
    with a space. A text in which a word is empty or has another character at its ends goes to the
    library whole.
    """

    def __init__(self, path: str, kept: int = KEPT_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.kept = kept
        self.store = Store(1)
        size = self.library.get_vocab_size()
        self.opens = np.array([(self.library.id_to_token(i) or "").startswith("Ġ") for i in range(size)])

    def _apart(self, texts: list[str]) -> list[np.ndarray]:
        found = self.library.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, np.uint32) for x in found]

    def _together(self, words: list[str]) -> list[np.ndarray]:
        """Ids of plain words, each with a space before it."""
        out = []
        for a in range(0, len(words), TOGETHER):
            some = words[a : a + TOGETHER]
            (ids,) = self._apart([" " + " ".join(some)])
            cuts = np.flatnonzero(self.opens[ids])
            if len(cuts) != len(some) or cuts[0]:
                out += self._apart([" " + w for w in some])
            else:
                out += np.split(ids, cuts[1:])
        return out

    def _named(self, words: list[bytes], lead: str) -> np.ndarray:
        """Numbers of words that are looked up one by one; ``lead`` stands before each."""
        key = lead.encode()
        new = sorted({w for w in words if key + w not in self.store.named})
        ids = self._apart([lead + w.decode() for w in new])
        self.store.named.update(zip([key + w for w in new], self.store.add(ids).tolist()))
        return np.array([self.store.named[key + w] for w in words], np.int64)

    def encode(self, texts: list[bytes]) -> list[bytes]:
        joined = b"".join(texts)
        data = np.frombuffer(joined + bytes(SHORT + 8), np.uint8)
        edge = np.cumsum([0, *(len(t) for t in texts)])
        space = np.flatnonzero(data[: len(joined)] == 0x20)
        start, end = (np.sort(np.concatenate(x), kind="stable") for x in ((edge[:-1], space + 1), (space, edge[1:])))
        words = np.diff(np.searchsorted(space, edge)) + 1
        first = np.cumsum(words) - words
        size = end - start
        head = np.zeros(len(start), bool)
        head[first] = True
        # A text whose cuts are not all plain goes to the library whole. Of first words only the end counts.
        last, before = data[end - 1], data[np.maximum(end - 2, 0)]
        plain = np.where(last < 0x80, _shown(last, last), _shown(before, last)) & (size > 0)
        plain &= head | _shown(data[start], data[start + 1])
        plain |= head & (size == 0)
        whole = ~np.logical_and.reduceat(plain, first) if len(first) else np.zeros(0, bool)
        use = ~np.repeat(whole, words)

        # Eight bytes at a time; the array has a view that begins at every byte.
        window = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
        at = np.flatnonzero(use & ~head & (size <= SHORT))
        s, n = start[at], size[at]
        lead = window[s] & _MASK[np.minimum(n, 8)]
        h = _mixed(lead + n.astype(np.uint64) * _ODD)
        for k in range(8, SHORT, 8):
            more = np.flatnonzero(n > k)
            h[more] = _mixed(h[more] ^ (window[s[more] + k] & _MASK[np.minimum(n[more] - k, 8)]) * _ODD)
        rest = np.flatnonzero(use & ~head & (size > SHORT))
        number = np.zeros(len(start), np.int64)
        found = self.store.find(h, lead)
        new = np.flatnonzero(found < 0)
        if self.store.words + len(new) + len(rest) + len(texts) > len(self.store.hash):
            # Start anew, with room for the kept words, or for more if this step itself may have more.
            self.store = Store(max(self.kept, len(at) + len(rest) + len(texts)))
            found[:], new = -1, np.arange(len(at))
        if len(new):
            _, one, of = np.unique(h[new], return_index=True, return_inverse=True)
            one = new[one]
            ids = self._together([joined[a : a + b].decode() for a, b in zip(s[one].tolist(), n[one].tolist())])
            numbers = self.store.add(ids)
            self.store.enter(h[one], lead[one], numbers)
            found[new] = numbers[of]
        number[at] = found
        if len(rest):
            number[rest] = self._named([joined[a:b] for a, b in zip(start[rest].tolist(), end[rest].tolist())], " ")
        heads = first[~whole]
        if len(heads):
            number[heads] = self._named([joined[a:b] for a, b in zip(start[heads].tolist(), end[heads].tolist())], "")

        count = np.where(use, self.store.count[number], 0)
        stop = np.cumsum(count, dtype=np.int64)
        total = int(stop[-1]) if len(stop) else 0
        place = np.repeat(self.store.start[number] - (stop - count), count) + np.arange(total)
        ids = memoryview(self.store.ids[place].astype("<u4").tobytes())
        ends = stop[first + words - 1].tolist() if len(first) else []
        out, a = [], 0
        for text, b, odd in zip(texts, ends, whole.tolist()):
            out.append(self._apart([text.decode()])[0].astype("<u4").tobytes() if odd else bytes(ids[4 * a : 4 * b]))
            a = b
        return out


_encoders: dict[tuple[str, int], WordEncoder] = {}


def encoder(path: str, kept: int = KEPT_WORDS) -> WordEncoder:
    """One encoder for each vocabulary and worker process; the words it knows last from task to task."""
    if (path, kept) not in _encoders:
        _encoders[path, kept] = WordEncoder(path, kept)
    return _encoders[path, kept]
