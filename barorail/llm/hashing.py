"""64-bit hashes of words and of runs of words, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

U = np.uint64
STEP = U(0x9E3779B97F4A7C15)
_M1, _M2 = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers one to one."""
    x = (x ^ (x >> U(30))) * _M1
    x = (x ^ (x >> U(27))) * _M2
    return x ^ (x >> U(31))


def words_of(text: str | None) -> list[bytes]:
    """What stands between ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def word_codes(text: str | None) -> np.ndarray:
    words = words_of(text)
    return np.fromiter(map(xxhash.xxh64_intdigest, words), U, len(words))


class Recent:
    """A bounded memory that forgets what was not asked for lately: two generations of entries."""

    def __init__(self, size: int):
        self.size = size
        self.new: dict = {}
        self.old: dict = {}

    def get(self, key):
        found = self.new.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def renewed(self) -> dict:
        """The newer generation, begun anew if it is full: the caller may fill it as it likes."""
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        return self.new

    def put(self, key, value) -> None:
        if len(self.new) >= self.size:
            self.old, self.new = self.new, {}
        self.new[key] = value
