"""Byte-level BPE over whole Arrow batches, with numpy only.

A slice of documents is one flat byte array. Character classes give the limits of the words as the
tokenizer's pattern would; equal words are counted once by exact 8-byte keys (longer words by a hash
whose hits are compared byte by byte); words that were not met before are merged together: all their
symbols lie in one flat array, and each round looks up every adjacent pair by binary search in the
sorted pair keys, takes the lowest rank of each word, and merges that pair wherever it stands in it.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pandas as pd

OTHER, LETTER, NUMBER, SPACE = range(4)
# The characters of Unicode's White_Space property.
WHITE = (*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
QUOTE, BLANK = ord("'"), ord(" ")
#: Bytes of documents that are worked on at once (a longer document is a slice of its own).
SLICE_BYTES = 2_000_000
#: Symbols from which a single word is merged by a priority queue: time in rounds times length would be quadratic.
LONG_WORD = 400
#: Words that are remembered by a worker before it starts afresh.
KNOWN_WORDS = 600_000


def default_vocabulary(name: str = "byte_bpe_50k.json") -> str:
    try:
        import public_tokenizers

        return public_tokenizers.path(name)
    except ImportError:
        return f"/opt/tokenizers/{name}"


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    out = np.zeros(0x110000, np.uint8)
    category = unicodedata.category
    first = np.array([ord({"L": "L", "N": "N"}.get(category(chr(i))[0], "-")) for i in range(0x110000)], np.uint8)
    out[first == ord("L")] = LETTER
    out[first == ord("N")] = NUMBER
    out[list(WHITE)] = SPACE
    return out


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary -> the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _load64(flat: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Eight bytes from each place; flat has eight spare bytes at its end."""
    wide = np.ndarray((len(flat) - 7,), "<u8", buffer=flat, strides=(1,))
    return wide[at]


_MASK = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_LONG = np.uint64(0xFF) << np.uint64(56)


class Encoder:
    """Token ids of many texts by a byte-level BPE vocabulary file; strings of special tokens are ordinary text."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], _byte_letters()
        self.byte_id = np.zeros(256, np.int32)
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right, made = (np.array([vocab[x] for x in xs], np.int64) for xs in (*zip(*pairs), [a + b for a, b in pairs]))
        keys = left << 32 | right
        order = np.argsort(keys)
        self.keys, self.rank, self.made = keys[order], order.astype(np.int32), made[order].astype(np.int32)
        self.forget()

    def forget(self) -> None:
        self.known: dict[int | bytes, int] = {}
        self.tokens = np.empty(1 << 16, np.int32)
        self.used = 0
        self.begin = np.empty(1 << 14, np.int64)
        self.count = np.empty(1 << 14, np.int64)

    # words

    def words(self, flat: np.ndarray, size: int, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(byte offset of each word, index of each document's first word). starts: byte offset of each non-empty document."""
        table = char_classes()
        text = flat[:size]
        if (text < 0x80).all():
            at, code, first = None, text, starts
            kind = table[:256][text]
        else:
            at = np.flatnonzero((text & 0xC0) != 0x80)
            lead = text[at]
            code = lead.astype(np.int32)
            for low, keep, more in ((0xC0, 0x1F, 1), (0xE0, 0x0F, 2), (0xF0, 0x07, 3)):
                w = np.flatnonzero((lead >= low) & (lead < (0xE0, 0xF0, 0x100)[more - 1]))
                c = code[w] & keep
                for j in range(1, more + 1):
                    c = c << 6 | (flat[at[w] + j] & 0x3F)
                code[w] = np.minimum(c, 0x10FFFF)
            kind = table[code]
            first = np.searchsorted(at, starts)
        n = len(kind)
        new = np.empty(n + 1, bool)
        new[0] = new[n] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:n])
        new[first] = True
        runs = np.flatnonzero(new)
        begin, end = runs[:-1], runs[1:]
        new = new[:n]
        ends_doc = np.zeros(n + 1, bool)
        ends_doc[first] = ends_doc[n] = True
        w = (kind[begin] == SPACE) & ~ends_doc[end]
        last, after = end[w] - 1, end[w]
        new[last] = True
        new[after[code[last] == BLANK]] = False  # one blank goes with what follows
        q = np.flatnonzero((kind[begin] == OTHER) & (end - begin == 1))
        q = begin[q]
        q = q[(code[q] == QUOTE) & new[q]]
        q = q[(q + 1 < n) & ~ends_doc[np.minimum(q + 1, n)]]
        if len(q):
            a = code[q + 1]
            b = np.where((q + 2 < n) & ~ends_doc[np.minimum(q + 2, n)], code[np.minimum(q + 2, n - 1)], 0)
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = (a == ord("r")) & (b == ord("e")) | (a == ord("v")) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            for hit, length in ((one, 2), (two, 3)):
                p = q[hit]
                new[p + 1] = False
                p = p + length
                new[p[p < n]] = True
        begin = np.flatnonzero(new)
        return begin if at is None else at[begin], np.searchsorted(begin, first)

    def unique(self, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(code of each word, index of a word of each code, key of each code); equal words share a code and no others do."""
        head = _load64(flat, begin)
        short = length <= 7
        key = np.where(short, head & _MASK[np.minimum(length, 7)] | length.astype(np.uint64) << np.uint64(56), 0)
        long = np.flatnonzero(~short)
        if len(long):
            acc = length[long].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            for j, act, chunk in self._chunks(flat, begin[long], length[long]):
                a = (acc[act] ^ chunk) * np.uint64(0xD6E8FEB86659FD93)
                acc[act] = a ^ a >> np.uint64(32)
            key[long] = acc | _LONG
        code, keys = pd.factorize(key)
        rep = np.empty(len(keys), np.int64)
        rep[code[::-1]] = np.arange(len(code) - 1, -1, -1)
        if len(long):
            other = rep[code[long]]
            same = length[long] == length[other]
            for (_, act, chunk), (_, _, theirs) in zip(self._chunks(flat, begin[long], length[long]), self._chunks(flat, begin[other], length[long])):
                same[act] &= chunk == theirs
            odd = long[~same]
            if len(odd):  # two different words of one hash: tell them apart by their bytes
                seen: dict[bytes, int] = {}
                more = []
                for w in odd:
                    text = flat[begin[w] : begin[w] + length[w]].tobytes()
                    if text not in seen:
                        seen[text] = len(keys) + len(more)
                        more.append(w)
                    code[w] = seen[text]
                rep = np.concatenate([rep, more]).astype(np.int64)
                keys = np.concatenate([keys, key[more]])
        return code, rep, keys

    @staticmethod
    def _chunks(flat: np.ndarray, begin: np.ndarray, length: np.ndarray):
        """The words' bytes, eight at a time, with the words that reach so far."""
        j, act = 0, np.arange(len(begin))
        while len(act):
            left = np.minimum(length[act] - 8 * j, 8)
            yield j, act, _load64(flat, np.minimum(begin[act] + 8 * j, len(flat) - 8)) & _MASK[left]
            j += 1
            act = act[length[act] > 8 * j]

    # merges

    def merge(self, symbols: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each word) from their bytes' ids."""
        n = len(size)
        word = np.repeat(np.arange(n), size)
        done_word, done_ids = [], []
        none = np.int32(2**31 - 1)
        for w in np.flatnonzero(size > LONG_WORD):
            ids = self._merge_long(symbols[word == w])
            done_word.append(np.full(len(ids), w))
            done_ids.append(ids)
        if done_word:
            keep = size[word] <= LONG_WORD
            symbols, word = symbols[keep], word[keep]
        while len(symbols):
            key = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            rank = np.where((self.keys[at] == key) & (word[:-1] == word[1:]), self.rank[at], none)
            rank = np.append(rank, none)
            edges = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            least = np.minimum.reduceat(rank, edges)
            of = np.cumsum(np.r_[False, word[1:] != word[:-1]])
            over = least[of] == none
            if over.any():
                done_word.append(word[over])
                done_ids.append(symbols[over])
                keep = ~over
                symbols, word, rank, of, at = symbols[keep], word[keep], rank[keep], of[keep], np.append(at, 0)[keep]
                if not len(symbols):
                    break
            else:
                at = np.append(at, 0)
            hit = np.flatnonzero(rank == least[of])
            if len(hit) > 1:  # of pairs that overlap (a a a), every second one from the left
                run = np.r_[True, np.diff(hit) != 1]
                since = np.arange(len(hit)) - np.maximum.accumulate(np.where(run, np.arange(len(hit)), 0))
                hit = hit[since % 2 == 0]
            symbols[hit] = self.made[at[hit]]
            keep = np.ones(len(symbols), bool)
            keep[hit + 1] = False
            symbols, word = symbols[keep], word[keep]
        word, ids = np.concatenate(done_word), np.concatenate(done_ids)
        order = np.argsort(word, kind="stable")
        return ids[order], np.bincount(word, minlength=n)

    def _merge_long(self, symbols: np.ndarray) -> np.ndarray:
        ids = symbols.tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]

        def pair(i: int) -> tuple[int, int, int] | None:
            j = after[i]
            if j < 0:
                return None
            key = ids[i] << 32 | ids[j]
            at = int(np.searchsorted(self.keys, key))
            return (int(self.rank[at]), i, key) if at < len(self.keys) and self.keys[at] == key else None

        key = symbols[:-1].astype(np.int64) << 32 | symbols[1:]
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        heap = [(int(self.rank[a]), i, int(key[i])) for i, a in enumerate(at) if self.keys[a] == key[i]]
        heapq.heapify(heap)
        while heap:
            _, i, key = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j < 0 or ids[i] << 32 | ids[j] != key:
                continue
            ids[i] = int(self.made[np.searchsorted(self.keys, key)])
            ids[j] = -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for k in (before[i], i):
                if k >= 0 and (p := pair(k)):
                    heapq.heappush(heap, p)
        return np.array([x for x in ids if x >= 0], np.int32)

    def _learn(self, names: list, flat: np.ndarray, begin: np.ndarray, length: np.ndarray) -> None:
        total = int(length.sum())
        shift = begin - (np.cumsum(length) - length)
        symbols = self.byte_id[flat[np.arange(total) + np.repeat(shift, length)]]
        ids, count = self.merge(symbols, length)
        while len(self.tokens) < self.used + len(ids):
            self.tokens = np.concatenate([self.tokens, np.empty_like(self.tokens)])
        have = len(self.known)
        while len(self.begin) < have + len(names):
            self.begin, self.count = (np.concatenate([x, np.empty_like(x)]) for x in (self.begin, self.count))
        self.tokens[self.used : self.used + len(ids)] = ids
        self.count[have : have + len(names)] = count
        self.begin[have : have + len(names)] = self.used + np.cumsum(count) - count
        self.used += len(ids)
        self.known.update(zip(names, range(have, have + len(names))))

    # texts

    def encode(self, data: np.ndarray, offsets: np.ndarray, want_ids: bool = True) -> tuple[np.ndarray | None, np.ndarray]:
        """(ids of all texts, offsets of each text's ids). data: UTF-8 bytes; offsets: len(texts) + 1 byte offsets from 0."""
        size = int(offsets[-1])
        if not size:
            return np.empty(0, np.int32), np.zeros(len(offsets), np.int64)
        if len(self.known) > KNOWN_WORDS:
            self.forget()
        flat = np.zeros(size + 16, np.uint8)
        flat[:size] = data[:size]
        full = offsets[1:] > offsets[:-1]
        begin, first = self.words(flat, size, offsets[:-1][full])
        length = np.diff(np.append(begin, size))
        code, rep, keys = self.unique(flat, begin, length)
        names = keys.tolist()
        for i in np.flatnonzero(length[rep] > 7):
            r = rep[i]
            names[i] = flat[begin[r] : begin[r] + length[r]].tobytes()
        get = self.known.get
        index = np.array([get(x, -1) for x in names], np.int64)
        fresh = np.flatnonzero(index < 0)
        if len(fresh):
            have = len(self.known)
            self._learn([names[i] for i in fresh], flat, begin[rep[fresh]], length[rep[fresh]])
            index[fresh] = np.arange(have, have + len(fresh))
        word = index[code]
        count = self.count[word]
        upto = np.concatenate([[0], np.cumsum(count)])
        ends = np.zeros(len(offsets), np.int64)
        ends[1:][full] = upto[np.append(first[1:], len(begin))]
        ends = np.maximum.accumulate(ends)
        if not want_ids:
            return None, ends
        place = np.arange(upto[-1]) + np.repeat(self.begin[word] - upto[:-1], count)
        return self.tokens[place], ends


@lru_cache(maxsize=2)
def encoder(vocabulary: str) -> Encoder:
    """One encoder for each worker process."""
    return Encoder(vocabulary)
