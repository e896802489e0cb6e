"""Small helpers on one text, used inside Arrow batches. Words are separated by ASCII white space, as bytes.split does."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Entries of a worker's word-to-hash cache before it is emptied.
CACHED_WORDS = 500_000
#: Letters in lower case; what is no ASCII letter or digit and no byte of a longer character becomes a space.
ALNUM_LOWER = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SPACES = " \t\n\r\x0b\x0c"


#: Rows of an Arrow batch that are worked on at once; as Python objects, and what they become, they may be many times larger.
SLICE = 500


def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE):
            yield batch.slice(at, SLICE)


def utf8(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


class WordHash(dict):
    """Word to the number in the first ``digits`` hexadecimal digits of its MD5; remembers what it has seen."""

    def __init__(self, digits: int):
        super().__init__()
        self.digits = digits

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = int(hashlib.md5(word).hexdigest()[: self.digits], 16)
        return value

    def of(self, words: list[bytes], kind=np.int64) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), kind, len(words))
