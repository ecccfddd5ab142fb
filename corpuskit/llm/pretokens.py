"""Pre-token boundaries for byte-level BPE, found with arrays instead of a regular expression.

The pattern 's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+
covers every character, so its matches are the stretches between boundaries, and
a small automaton over character symbols tells where they are. Its transition
functions compose associatively: many blocks of a text are folded side by side,
the blocks' functions are combined by a doubling scan, and with the state at
each block's start all blocks are replayed side by side.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Regex, normalizers

# Symbols. A1 and A2 are apostrophes before a contraction of one or two letters;
# INNER is white space before white space or the end, JOINED a blank and LONE
# other white space before anything else; END follows each text.
LETTER, NUMBER, OTHER, A1, A2, INNER, JOINED, LONE, END = range(9)
_APOSTROPHE, _BLANK, _WHITE = 9, 10, 11

# States: what the current pre-token is. ONE and TWO wait for so many letters of
# a contraction; after CLOSED anything begins a pre-token.
CLOSED, IN_LETTERS, IN_NUMBERS, IN_OTHER, IN_WHITE, AFTER_BLANK, ONE, TWO = range(8)

_FRESH = {
    LETTER: IN_LETTERS,
    NUMBER: IN_NUMBERS,
    OTHER: IN_OTHER,
    A1: ONE,
    A2: TWO,
    INNER: IN_WHITE,
    JOINED: AFTER_BLANK,
    LONE: CLOSED,
    END: CLOSED,
}
_CONTINUED = {
    (IN_LETTERS, LETTER): IN_LETTERS,
    (IN_NUMBERS, NUMBER): IN_NUMBERS,
    **{(s, c): IN_OTHER for s in (IN_OTHER, AFTER_BLANK) for c in (OTHER, A1, A2)},
    (AFTER_BLANK, LETTER): IN_LETTERS,
    (AFTER_BLANK, NUMBER): IN_NUMBERS,
    (IN_WHITE, INNER): IN_WHITE,
    (ONE, LETTER): CLOSED,
    (TWO, LETTER): ONE,
}
_N_STATES, _N_SYMBOLS = 8, 9


@cache
def _classes() -> np.ndarray:
    """The class of each code point, by the Unicode tables of the tokenizers library."""
    points = np.r_[0:0xD800, 0xE000:0x110000].astype("<u4")
    everything = points.tobytes().decode("utf-32-le")
    table = np.full(0x110000, OTHER, np.uint8)
    for others, number in ((r"\P{L}+", LETTER), (r"\P{N}+", NUMBER), (r"\S+", _WHITE)):
        found = normalizers.Replace(Regex(others), "").normalize_str(everything)
        table[np.frombuffer(found.encode("utf-32-le"), "<u4")] = number
    table[ord(" ")], table[ord("'")] = _BLANK, _APOSTROPHE
    return table


@cache
def _automaton() -> tuple[np.ndarray, np.ndarray]:
    """Next state and whether a pre-token begins, by state * 16 + symbol."""
    state = np.zeros(_N_STATES * 16, np.uint8)
    begins = np.zeros(_N_STATES * 16, bool)
    for s in range(_N_STATES):
        for c in range(_N_SYMBOLS):
            go = _CONTINUED.get((s, c))
            state[s * 16 + c] = _FRESH[c] if go is None else go
            begins[s * 16 + c] = go is None
    return state, begins


@cache
def _functions() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All transition functions of strings of symbols: values, products, and products with one symbol.

    `values[f, s]` is the state after s; `product[f, g]` is f then g. Function 0
    is the identity.
    """
    state, _ = _automaton()
    single = [tuple(int(state[s * 16 + c]) for s in range(_N_STATES)) for c in range(_N_SYMBOLS)]
    number = {tuple(range(_N_STATES)): 0}
    queue = list(number)
    for f in queue:
        for g in single:
            h = tuple(g[x] for x in f)
            if h not in number:
                number[h] = len(number)
                queue.append(h)
    values = np.array(queue, np.uint8)
    product = np.array([[number[tuple(g[x] for x in f)] for g in queue] for f in queue], np.int64)
    step = np.zeros((len(queue), 16), np.int64)
    step[:, :_N_SYMBOLS] = product[:, [number[g] for g in single]]
    return values, product, step


def _symbols(points: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The symbol of each code point; `ends` are the positions of the texts' end marks."""
    symbols = _classes()[points]
    symbols[ends] = END
    white = (symbols == _BLANK) | (symbols == _WHITE)
    at = np.flatnonzero(white)
    # the last position is an end mark, so at + 1 is always there
    before_more = white[at + 1] | (symbols[at + 1] == END)
    symbols[at] = np.where(before_more, INNER, np.where(symbols[at] == _BLANK, JOINED, LONE))

    at = np.flatnonzero(symbols == _APOSTROPHE)
    if len(at):
        after = points[np.minimum(at[:, None] + [1, 2], len(points) - 1)]
        # an end mark stands for a character of a text only by chance
        after[symbols[np.minimum(at + 1, len(points) - 1)] == END, 0] = 0
        after[symbols[np.minimum(at + 2, len(points) - 1)] == END, 1] = 0
        one = np.isin(after[:, 0], [ord(c) for c in "stmd"])
        two = np.zeros(len(at), bool)
        for a, b in ("re", "ve", "ll"):
            two |= (after[:, 0] == ord(a)) & (after[:, 1] == ord(b))
        symbols[at] = np.select([one, two], [A1, A2], OTHER)
    return symbols


def _begins(symbols: np.ndarray, width: int = 256) -> np.ndarray:
    """Whether a pre-token begins at each symbol."""
    n = len(symbols)
    lanes = -(-n // width)
    padded = np.full(lanes * width, END, np.uint8)
    padded[:n] = symbols
    columns = np.ascontiguousarray(padded.reshape(lanes, width).T)
    values, product, step = _functions()
    flat_step = step.ravel()
    block = np.zeros(lanes, np.int64)
    for column in columns:
        block = flat_step[block * 16 + column]
    shift = 1
    while shift < lanes:  # block[i] becomes the function of blocks 0 .. i
        block[shift:] = product[block[:-shift], block[shift:]]
        shift *= 2
    state = np.empty(lanes, np.int64)
    state[0] = CLOSED
    state[1:] = values[block[:-1], CLOSED]
    next_state, begins = _automaton()
    next_state = next_state.astype(np.int64)
    out = np.empty((width, lanes), bool)
    for j, column in enumerate(columns):
        at = state * 16 + column
        out[j] = begins[at]
        state = next_state[at]
    return out.T.reshape(-1)[:n]


def boundaries(texts: Sequence[str]) -> tuple[bytes, np.ndarray, np.ndarray, np.ndarray]:
    """All texts as one byte string, the first and last byte of every pre-token, and how many each text has."""
    joined = "\n".join([*texts, ""])
    blob = joined.encode("utf-8", "surrogatepass")
    lengths = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lengths + 1) - 1
    if not len(ends):
        return blob, ends, ends, ends
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), "<u4")
    symbols = _symbols(points, ends)
    starts = np.flatnonzero(_begins(symbols))
    is_end = symbols[starts] == END
    counts = np.diff(np.flatnonzero(is_end), prepend=-1) - 1
    stops = np.append(starts[1:], len(points))
    starts, stops = starts[~is_end], stops[~is_end]
    if len(blob) > len(points):  # from characters to bytes
        first = np.flatnonzero((np.frombuffer(blob, np.uint8) & 0xC0) != 0x80)
        first = np.append(first, len(blob))
        starts, stops = first[starts], first[stops]
    return blob, starts, stops, counts


def chunks(column: pa.Array, size: int = 1 << 19) -> Iterator[tuple[int, int, list[str]]]:
    """Slices (first, last, texts) of a string column with about `size` bytes each, nulls as empty strings.

    A longer text is alone. Only one slice's texts are Python strings at a time.
    """
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    upto = np.cumsum(lengths)
    first = 0
    while first < len(lengths):
        room = upto[first] - lengths[first] + size
        last = max(first + 1, int(np.searchsorted(upto, room, "right")))
        texts = column.slice(first, last - first).to_pylist()
        yield first, last, ["" if t is None else t for t in texts]
        first = last
