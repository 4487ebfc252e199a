"""Text as arrays: code points, runs of one kind, and hashes of spans.

Texts of a block are laid end to end; ``bounds`` has where each begins (and
the end of the last), so one numpy pass serves many texts. Every result is
exact for whole texts of any length.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Sequence
from functools import cache

import numpy as np

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
#: White space as Unicode's property of that name has it.
WHITE_SPACE = [(0x09, 0x0D), (0x20, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000)]
#: Letters and numbers that Unicode 16 added, for older Pythons.
LETTERS_16 = [(0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0)]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
_ODD = 0x9E3779B97F4A7C15


@cache
def kinds() -> np.ndarray:
    """The kind of each code point."""
    out = np.zeros(0x110000, np.uint8)
    for c in range(0x110000):
        kind = unicodedata.category(chr(c))[0]
        if kind == "L":
            out[c] = LETTER
        elif kind == "N":
            out[c] = NUMBER
    for kind, ranges in ((LETTER, LETTERS_16), (NUMBER, NUMBERS_16)):
        for low, high in ranges:
            out[low : high + 1] = kind
    for low, high in WHITE_SPACE:
        out[low : high + 1] = SPACE
    return out


@cache
def lowered() -> np.ndarray:
    """The lower case of each code point, where that is one code point."""
    out = np.arange(0x110000, dtype=np.uint32)
    for c in range(0x20000):
        low = chr(c).lower()
        if len(low) == 1:
            out[c] = ord(low)
    return out


def points(texts: Sequence[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts end to end, and the bounds; null counts as empty."""
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) if t else 0 for t in texts], out=bounds[1:])
    joined = "".join(t for t in texts if t)
    return np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32), bounds


def run_starts(kind: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where a run of one kind within one text begins."""
    new = np.empty(len(kind), bool)
    if len(kind):
        new[0] = True
        np.not_equal(kind[1:], kind[:-1], out=new[1:])
        inner = bounds[(bounds > 0) & (bounds < len(kind))]
        new[inner] = True
    return new


def words(cps: np.ndarray, bounds: np.ndarray, numbers: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each run of letters (``numbers``: or digits)."""
    kind = kinds()[cps]
    inside = (kind == LETTER) | (kind == NUMBER) if numbers else kind == LETTER
    new = run_starts(inside, bounds)
    starts = np.flatnonzero(new)
    ends = np.append(starts[1:], len(cps))
    own = inside[starts] if len(starts) else np.zeros(0, bool)
    return starts[own], ends[own]


@cache
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for base in (_ODD, pow(_ODD, -1, 1 << 64)):
        p = np.full(size, base, np.uint64)
        p[0] = 1
        out.append(np.multiply.accumulate(p))
    return out[0], out[1]


def _size(n: int) -> int:
    return 1 << max(16, int(n).bit_length())


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def span_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's values, the same wherever the span lies."""
    up, down = _powers(_size(len(values) + 1))
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * up[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def per_text(starts: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Bounds of each text's spans among all spans."""
    return np.searchsorted(starts, bounds)


def sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sums of ``values`` (along axis 0) between consecutive cuts; 0 where there are none."""
    out = np.zeros((len(cuts) - 1, *values.shape[1:]), values.dtype)
    full = cuts[1:] > cuts[:-1]
    if full.any():
        out[full] = np.add.reduceat(values, cuts[:-1][full], axis=0)
    return out


def gpt_tokens(cps: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Begins of the pieces into which byte-level BPE splits texts before merging.

    The rule: a contraction ('s 't 're 've 'm 'll 'd); letters, digits or other
    signs with at most one space before them; white space, of which the last
    sign goes with what follows when it is a space.
    """
    n = len(cps)
    if not n:
        return np.zeros(0, np.int64)
    kind = kinds()[cps]
    run = run_starts(kind, bounds)
    begins = np.flatnonzero(run)
    ends = np.append(begins[1:], n)
    last = np.zeros(n + 1, bool)  # where a text ends
    last[bounds] = True
    start = np.append(run, True)
    followed = (kind[begins] == SPACE) & ~last[ends]
    tail = ends[followed]
    start[tail - 1] = True
    start[tail[cps[tail - 1] == 0x20]] = False
    # contractions: an apostrophe that begins a piece, alone before letters
    q = np.flatnonzero((cps[:-1] == 0x27) & start[: n - 1] & run[1:] & (kind[1:] == LETTER) & ~last[1:n])
    if len(q):
        one = cps[q + 1]
        more = np.where(q + 2 < n, cps[np.minimum(q + 2, n - 1)], 0)
        more[(q + 2 >= n) | last[np.minimum(q + 2, n)]] = 0
        short = np.isin(one, np.frombuffer("stmd".encode("utf-32-le"), np.uint32))
        pairs = [(0x72, 0x65), (0x76, 0x65), (0x6C, 0x6C)]
        long = np.zeros(len(q), bool)
        for x, y in pairs:
            long |= (one == x) & (more == y)
        start[q[short | long] + 1] = False
        start[q[short] + 2] = True
        start[q[long] + 3] = True
    return np.flatnonzero(start[:n])
