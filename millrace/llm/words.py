"""Words of whole texts: digits, letters in lower case, and everything beyond ASCII."""

from __future__ import annotations

import numpy as np

# All else becomes a space; A to Z become a to z.
TABLE = bytes(
    b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 0x20 for b in range(256)
)
#: Words whose hashes a task remembers; all are forgotten at once when there are more.
REMEMBERED = 150_000


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "replace").translate(TABLE).split()


class Hashes(dict):
    """64-bit hashes of words, the same in every process."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        found = self[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, text: str | None) -> np.ndarray:
        if len(self) > REMEMBERED:
            self.clear()
        return np.array([self[w] for w in words(text)], np.uint64)
