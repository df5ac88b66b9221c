"""Vectorised passes over the UTF-8 bytes of many texts at once.

Texts are laid end to end with a line feed after each, so words never join. Word and
shingle hashes are 64 bits: a polynomial over the bytes, taken from prefix sums, then mixed.
What needs eight bytes for each byte of text is done in blocks, so that one very long text
takes about ten times its size.
"""

import numpy as np
import pyarrow as pa

U = np.uint64
BLOCK = 1 << 18
_BASE = U(0x9E3779B97F4A7C15)
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_powers = np.ones(1, U)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse modulo 2**64."""
    global _powers
    if len(_powers) < 2 * n:
        inverse = pow(int(_BASE), -1, 1 << 64)
        out = np.empty((2, 1 << max(18, n.bit_length())), U)
        for row, factor in zip(out, (int(_BASE), inverse)):
            row[0], filled = 1, 1
            while filled < len(row):  # doubling: the next block is the last one times factor**filled
                more = min(filled, len(row) - filled)
                row[filled : filled + more] = row[:more] * U(pow(factor, filled, 1 << 64))
                filled += more
        _powers = out.ravel()
    half = len(_powers) // 2
    return _powers[:n], _powers[half : half + n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


class Texts:
    """Bytes, word bounds and, for each text, the range of its bytes and words."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        self.data = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
        if lower:
            upper = (self.data >= 65) & (self.data <= 90)
            self.data = self.data + (upper.astype(np.uint8) << 5)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.first = np.concatenate([[0], ends]).astype(np.int64)  # byte of each text, and the end
        space = np.ones(len(self.data) + 2, np.int8)
        space[1:-1] = SPACE[self.data]
        edge = np.diff(space)
        self.start, self.stop = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self.word = np.searchsorted(self.start, self.first)  # first word of each text, and the end

    def totals(self, at: np.ndarray) -> np.ndarray:
        """Sums by text of a small value for each byte of the data."""
        return np.add.reduceat(at, self.first[:-1], dtype=np.int64)

    def word_hashes(self) -> np.ndarray:
        out = np.empty(len(self.start), U)
        a = 0
        while a < len(out):  # words that begin within a block, at least one
            low = self.start[a]
            z = max(a + 1, int(np.searchsorted(self.start, low + BLOCK)))
            start, stop = self.start[a:z] - low, self.stop[a:z] - low
            power, inverse = powers(int(stop[-1]) + 1)
            run = np.zeros(int(stop[-1]) + 1, U)
            np.cumsum((self.data[low : low + stop[-1]].astype(U) + U(1)) * power[:-1], out=run[1:])
            out[a:z] = mixed((run[stop] - run[start]) * inverse[start] + (stop - start).astype(U))
            a = z
        return out


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every k words in a row, by the position of the first."""
    n = max(0, len(words) - k + 1)
    out = np.zeros(n, U)
    for i in range(k):
        out = out * U(0xD6E8FEB86659FD93) + words[i : i + n]
    return mixed(out)


def as_bytes(column: pa.Array) -> pa.Array:
    """A text column as bytes, nulls as empty; copied only if there are nulls."""
    column = column.cast(pa.binary())
    return column.fill_null(b"") if column.null_count else column


def batches(sizes, most: int):
    """Slices of consecutive items with about ``most`` bytes; a larger item stands alone."""
    first = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > most:
            yield slice(first, i)
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield slice(first, len(sizes))
