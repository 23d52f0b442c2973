"""A SentencePiece vocabulary as numpy tables (read once per worker from a model file)."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

from .textvec import mix

_BASE = np.uint64(0x9E3779B97F4A7C15)
SPACE = "▁"


def default_model() -> str:
    """The public 32,000-piece model that comes with the Python environment."""
    import public_tokenizers
    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """Ids, scores and strings of a vocabulary; the space mark stands as a plain space in strings."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = sp.vocab_size()
        self.scores = np.array([sp.get_score(i) for i in range(self.size)])
        self.byte_ids = np.full(256, -1, dtype=np.int32)
        self.strings: list[str | None] = [None] * self.size
        self.raw: list[bytes] = [b""] * self.size
        for i in range(self.size):
            if sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                continue
            text = sp.id_to_piece(i)
            if sp.is_byte(i):
                value = int(text[3:5], 16)
                self.byte_ids[value] = i
                self.raw[i] = bytes([value])
            else:
                self.strings[i] = text.replace(SPACE, " ")
                self.raw[i] = self.strings[i].encode()
        self.id_of = {s: i for i, s in enumerate(self.strings) if s is not None}
        self.longest = max(map(len, self.id_of))
        # code point -> piece id; an ASCII character without a piece is its byte piece; -1: several byte pieces
        self.char_id = np.full(0x110000, -1, dtype=np.int32)
        for c in range(128):
            self.char_id[c] = self.byte_ids[c]
        for s, i in self.id_of.items():
            if len(s) == 1:
                self.char_id[ord(s)] = i

    def byte_pieces(self, char: str) -> list[int]:
        return [int(self.byte_ids[b]) for b in char.encode("utf-8", "surrogatepass")]

    @lru_cache(maxsize=1)  # noqa: B019 - one instance per worker
    def merges(self) -> "PairTable":
        """(left id, right id) -> (merged id, rank); rank 0 is the best score."""
        order = np.argsort(-self.scores, kind="stable")
        rank = np.empty(self.size, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate(([0], np.diff(-self.scores[order]) > 0)))
        keys, merged = [], []
        for s, i in self.id_of.items():
            for cut in range(1, len(s)):
                a, b = self.id_of.get(s[:cut]), self.id_of.get(s[cut:])
                if a is not None and b is not None:
                    keys.append(a << 32 | b)
                    merged.append(i)
        return PairTable(np.array(keys, dtype=np.uint64), np.array(merged, dtype=np.int64), rank)

    @lru_cache(maxsize=1)  # noqa: B019
    def substrings(self) -> "HashTable":
        """Hash of a piece's code points -> id (see ``running_hash``)."""
        ids = np.array(list(self.id_of.values()), dtype=np.int64)
        h = np.zeros(len(ids), dtype=np.uint64)
        for k, s in enumerate(self.id_of):
            v = 0
            for c in s:
                v = (v * int(_BASE) + ord(c) + 1) & 0xFFFFFFFFFFFFFFFF
            h[k] = v
        return HashTable(h, ids)


@lru_cache(maxsize=4)
def load_pieces(path: str) -> Pieces:
    return Pieces(path)


def running_hash(points: np.ndarray) -> np.ndarray:
    """[n, L] code points -> [n, L + 1] Horner sums; a substring's hash is sums[:, b] - sums[:, a] * base**(b - a)."""
    n, size = points.shape
    sums = np.zeros((n, size + 1), dtype=np.uint64)
    for t in range(size):
        sums[:, t + 1] = sums[:, t] * _BASE + (points[:, t].astype(np.uint64) + np.uint64(1))
    return sums


def base_power(k: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), k, 1 << 64))


class HashTable:
    """64-bit keys -> ids with a few direct-address probes; absent keys give -1."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, bits: int = 17):
        self.shift = np.uint64(64 - bits)
        self.keys, self.values = np.concatenate((keys, [np.uint64(0)])), np.concatenate((values, [-1]))
        self.levels: list[np.ndarray] = []
        left = np.arange(len(keys))
        while len(left):
            slot = np.full(1 << bits, len(keys), dtype=np.int32)
            at = self._slot(keys[left], len(self.levels))
            slot[at] = left
            self.levels.append(slot)
            left = left[slot[at] != left]

    def _slot(self, keys: np.ndarray, level: int) -> np.ndarray:
        return mix(keys + np.uint64(level * 0x632BE59BD9B4E019 & 0xFFFFFFFFFFFFFFFF)) >> self.shift

    def find(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(keys.shape, -1, dtype=np.int64)
        for level, slot in enumerate(self.levels):
            at = slot[self._slot(keys, level)]
            np.copyto(out, self.values[at], where=(self.keys[at] == keys) & (at < len(self.keys) - 1))
        return out


class PairTable:
    NONE = np.int64(1 << 40)

    def __init__(self, keys: np.ndarray, merged: np.ndarray, rank: np.ndarray):
        self.table = HashTable(keys, merged, 18)
        self.rank = np.concatenate((rank, [self.NONE]))
        self.of_pair = dict(zip(keys.tolist(), merged.tolist()))

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Merged id of each pair of ids, or -1."""
        return self.table.find(left.astype(np.uint64) << np.uint64(32) | right.astype(np.uint64) & np.uint64(0xFFFFFFFF))
