"""Byte-pair encoding of texts with a public vocabulary (problem 7).

Method, two tiers: a minimal perfect hash resolves pre-tokens that are vocabulary entries; any other pre-token is merged
bottom up with a heap over a linked list of its bytes. Words already seen by a worker are kept in a bounded memo, so
each tier runs once per distinct word of a stretch of documents.
"""

from __future__ import annotations

import base64
import heapq
import importlib.util
import os
import re
from itertools import chain

import regex
import xxhash

DEFAULT_VOCAB = "byte_bpe_50k.tiktoken"
MEMO_WORDS = 300_000
# White space as Unicode defines it, spelled out because the two regex engines differ on U+001C to U+001F.
_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_ANY = regex.compile(rf"'(?:[sdmt]|ll|ve|re)| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")
_ASCII = re.compile(r"'(?:[sdmt]|ll|ve|re)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")

# Odd multipliers (golden ratio and a random odd number) that mix a displacement into a 64-bit hash.
_ODD_1, _ODD_2, _M64 = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, (1 << 64) - 1


def pre_tokens(text: str) -> list[str]:
    """Words with their leading blank, numbers, marks and runs of white space; together they are the whole text."""
    return (_ASCII if text.isascii() else _ANY).findall(text)


class PerfectHash:
    """Minimal perfect hash over byte strings by hashing and displacement; ``get`` is exact as the key is compared."""

    def __init__(self, items: dict[bytes, int]):
        n = self.n = max(len(items), 1)
        r = self.r = max(n // 4, 1)
        buckets: dict[int, list[tuple[int, bytes]]] = {}
        for k in items:
            h = xxhash.xxh3_64_intdigest(k)
            buckets.setdefault(h % r, []).append((h, k))
        self.disp, self.keys, self.values = [0] * r, [None] * n, [0] * n
        free = 0
        for b, members in sorted(buckets.items(), key=lambda x: -len(x[1])):
            if len(members) == 1:
                while self.keys[free] is not None:
                    free += 1
                slots, d = [free], -free - 1
            else:
                d = 0
                while True:
                    slots = [self._slot(h, d) for h, _ in members]
                    if len(set(slots)) == len(slots) and all(self.keys[s] is None for s in slots):
                        break
                    d += 1
            self.disp[b] = d
            for s, (_, k) in zip(slots, members):
                self.keys[s], self.values[s] = k, items[k]

    def _slot(self, h: int, d: int) -> int:
        return ((((h ^ d * _ODD_1) & _M64) * _ODD_2 & _M64) >> 24) % self.n

    def get(self, key: bytes) -> int | None:
        h = xxhash.xxh3_64_intdigest(key)
        d = self.disp[h % self.r]
        s = -d - 1 if d < 0 else self._slot(h, d)
        return self.values[s] if self.keys[s] == key else None


class _Memo(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= MEMO_WORDS:
            self.clear()
        ids = self[word] = self.encode(word.encode("utf-8"))
        return ids


class Vocabulary:
    """Ranks of a byte-level vocabulary with the two-tier lookup."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.whole = PerfectHash(ranks)
        self.memo = _Memo(self._word)

    def __getstate__(self):
        return {"ranks": self.ranks, "whole": self.whole}

    def __setstate__(self, state):
        self.__dict__ |= state
        self.memo = _Memo(self._word)

    @classmethod
    def load(cls, path: str | None = None) -> Vocabulary:
        with open(path or default_path(), "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in (x.split() for x in f if x.strip())})

    def _word(self, word: bytes) -> tuple[int, ...]:
        i = self.whole.get(word)
        return (i,) if i is not None else self._merge(word)

    def _merge(self, word: bytes) -> tuple[int, ...]:
        """Lowest rank first, leftmost first. An entry of the heap is void once either part of its pair has changed."""
        n, rank = len(word), self.ranks.get
        after, before, alive = list(range(1, n + 2)), list(range(-1, n)), bytearray(b"\x01") * n
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := rank(word[i : i + 2])) is not None]
        heapq.heapify(heap)
        pop, push = heapq.heappop, heapq.heappush
        while heap:
            _, i, end = pop(heap)
            j = after[i]
            if not alive[i] or j >= n or after[j] != end:
                continue
            alive[j], after[i] = 0, end
            if end < n:
                before[end] = i
                far = after[end]
                if (r := rank(word[i:far])) is not None:
                    push(heap, (r, i, far))
            if (p := before[i]) >= 0 and (r := rank(word[p:end])) is not None:
                push(heap, (r, p, end))
        out, i = [], 0
        while i < n:
            out.append(self.ranks[word[i : after[i]]])
            i = after[i]
        return tuple(out)

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memo.__getitem__, pre_tokens(text))))

    def count(self, text: str) -> int:
        return sum(map(len, map(self.memo.__getitem__, pre_tokens(text))))


def default_path() -> str:
    """The vocabulary file: $PUBLIC_TOKENIZERS, the installed package of vocabularies, or /opt/tokenizers."""
    folders = [os.environ.get("PUBLIC_TOKENIZERS", "")]
    if (spec := importlib.util.find_spec("public_tokenizers")) and spec.origin:
        folders.append(os.path.dirname(spec.origin))
    for d in [*folders, "/opt/tokenizers"]:
        if d and os.path.exists(p := os.path.join(d, DEFAULT_VOCAB)):
            return p
    raise FileNotFoundError(f"no {DEFAULT_VOCAB}; pass its path")
