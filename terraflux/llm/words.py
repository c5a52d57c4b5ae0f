"""Words of many texts at once, as numpy arrays over one byte buffer."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
_STEP = 4096


def _powers(base: int) -> tuple[np.ndarray, int]:
    """base to the power of 0 .. 4095, and of 4096."""
    out = np.full(_STEP, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out), pow(base, _STEP, 1 << 64)


_LOW, _HIGH = _powers(_P)
_LOW_BACK, _HIGH_BACK = _powers(pow(_P, -1, 1 << 64))


def _high(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def chunks(texts: Iterable[str | None], size: int = 2_000_000) -> Iterator[tuple[int, list[bytes]]]:
    """(index of the first, encoded texts) of runs of texts of about size bytes; null is empty."""
    first, held, n = 0, [], 0
    for i, text in enumerate(texts):
        held.append(b"" if text is None else text.encode())
        n += len(held[-1])
        if n >= size:
            yield first, held
            first, held, n = i + 1, [], 0
    if held:
        yield first, held


@dataclass
class Words:
    """buf holds every word followed by one space; word w is buf[start[w]:end[w]], those of text r are first[r]:first[r + 1]."""

    buf: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @staticmethod
    def of(texts: list[bytes]) -> Words:
        raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
        space = SPACE[raw]
        keep = ~space
        keep[1:] |= ~space[:-1]  # the first space after a word
        ends_at = np.cumsum([len(t) + 1 for t in texts])
        kept = np.add.reduceat(keep.astype(np.int32), np.concatenate([[0], ends_at[:-1]])) if texts else np.empty(0, np.int64)
        buf = raw[keep]
        buf[space[keep]] = 32
        end = np.flatnonzero(buf == 32)
        start = np.concatenate([[0], end[:-1] + 1]) if len(end) else end
        return Words(buf, start, end, np.searchsorted(start, np.concatenate([[0], np.cumsum(kept, dtype=np.int64)])))

    @staticmethod
    def of_lines(raw: bytes) -> Words:
        """Of texts that are words with one space between them, a line feed after each text."""
        line = np.frombuffer(raw, np.uint8)
        end = np.flatnonzero((line == 32) | (line == 10))
        last = np.flatnonzero(line[end] == 10)
        buf = line.copy()
        buf[line == 10] = 32
        return Words(buf, np.concatenate([[0], end[:-1] + 1]) if len(end) else end, end, np.concatenate([[0], last + 1]))

    def prefix(self) -> np.ndarray:
        """Prefix sums of a polynomial over the bytes."""
        n = len(self.buf)
        out = np.zeros(n + 1, np.uint64)
        out[1:] = self.buf
        out[1:] *= np.multiply.outer(_high(_HIGH, n // _STEP + 1), _LOW).reshape(-1)[:n]
        np.cumsum(out[1:], out=out[1:])
        return out

    def hashes(self, prefix: np.ndarray, span: int = 1) -> np.ndarray:
        """A 64-bit hash of the bytes from each word to the end of the span-th, counting it; equal bytes, equal hash."""
        start, end = self.start[: len(self.start) - span + 1], self.end[span - 1 :]
        back = _high(_HIGH_BACK, len(self.buf) // _STEP + 1)[start // _STEP] * _LOW_BACK[start % _STEP]
        return mix((prefix[end] - prefix[start]) * back + (end - start).astype(np.uint64))

    def slices(self, start: np.ndarray, end: np.ndarray) -> list[bytes]:
        whole = self.buf.tobytes()
        return [whole[s:e] for s, e in zip(start.tolist(), end.tolist())]
