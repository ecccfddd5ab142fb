"""Many slices of one byte string: which are the same, and values for each."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd

# The bits that the first n of 8 bytes fill.
_FILLED = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def _first_of(codes: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    """For each code below n, the first of the places `at` that has it."""
    out = np.zeros(n, np.int64)
    out[codes[::-1]] = at[::-1]
    return out


def distinct(blob: bytes, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """A number for each slice, equal for equal slices, and the distinct slices by number.

    Slices of up to 16 bytes are one or two 64-bit integers, read from the bytes
    as they stand, so equal integers are equal slices. Longer ones, and all if
    there is a zero byte, which could pass for the end of a slice, are compared
    as byte strings.
    """
    lengths = stops - starts
    codes = np.zeros(len(starts), np.int64)
    firsts: list[np.ndarray] = []
    n = 0
    plain = b"\0" not in blob
    data = np.frombuffer(blob + bytes(16), np.uint8)
    eights = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    read = lambda at, size: eights[at].view("<u8")[:, 0] & _FILLED[size]
    if plain:
        short = np.flatnonzero(lengths <= 8)
        own, values = pd.factorize(read(starts[short], lengths[short]))
        codes[short] = own
        firsts.append(_first_of(own, short, len(values)))
        n += len(values)
        middle = np.flatnonzero((lengths > 8) & (lengths <= 16))
        left, _ = pd.factorize(read(starts[middle], 8))
        right, _ = pd.factorize(read(starts[middle] + 8, lengths[middle] - 8))
        own, values = pd.factorize(left << 32 | right)
        codes[middle] = own + n
        firsts.append(_first_of(own, middle, len(values)))
        n += len(values)
    rest = np.flatnonzero(lengths > 16) if plain else np.arange(len(starts))
    seen: dict[bytes, int] = {}
    places = zip(starts[rest].tolist(), stops[rest].tolist(), strict=True)
    own = np.array([seen.setdefault(blob[a:b], len(seen)) for a, b in places], np.int64)
    codes[rest] = own + n
    firsts.append(_first_of(own, rest, len(seen)))
    first = np.concatenate(firsts)
    bounds = zip(starts[first].tolist(), stops[first].tolist(), strict=True)
    return codes, [blob[a:b].decode() for a, b in bounds]


def joined(codes: np.ndarray, values: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The 32-bit integers of every slice's value one after another, and how many each has."""
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    pool = np.frombuffer(b"".join(values), "<u4")
    first = np.cumsum(sizes) - sizes
    counts = sizes[codes]
    stops = np.cumsum(counts)
    total = int(stops[-1]) if len(stops) else 0
    return pool[np.repeat(first[codes] - stops + counts, counts) + np.arange(total)], counts


def per_text(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of `values` with these sizes."""
    upto = np.concatenate([[0], np.cumsum(values)])
    stops = np.cumsum(sizes)
    return upto[stops] - upto[stops - sizes]
