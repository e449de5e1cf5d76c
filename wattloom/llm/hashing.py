"""64-bit hashes of words in numpy, equal in every process."""

import numpy as np
import xxhash

MEMO_WORDS = 200_000


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < MEMO_WORDS:
            self[word] = h
        return h


_hashes = _Hashes()


def ascii_words(text: str | None) -> list[bytes]:
    """Words of a text between spaces, tabs and line ends, with A-Z in lower case. Bytes know these six blanks and these letters only."""
    return text.encode().lower().split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    return x
