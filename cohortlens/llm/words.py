"""Whole texts as NumPy arrays inside a task: bytes, words and hashes, without a Python object per word.

A text is UTF-8 bytes; a missing text is an empty one. A word is a run of bytes other than the six ASCII
white-space bytes (0x09-0x0D and 0x20), so a word never cuts a character.
"""

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20     # texts are taken in slices of about this size, whole texts always
U = np.uint64
BASE = U(0x9E3779B97F4A7C15 | 1)
BASE_INVERSE = U(pow(int(BASE), -1, 1 << 64))
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LANE_BYTES = 128          # longer spans are hashed one by one
LANE_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32        # A-Z only


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (the finaliser of splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x = x * U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def random_words(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit numbers, the same on every machine."""
    return mix(mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed)) + U(seed))


class Powers:
    """Powers of the base and of its inverse modulo 2**64, grown as longer slices come."""
    up = down = np.ones(1, U)

    @classmethod
    def upto(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, SLICE_BYTES + 1)
            for name, base in (("up", BASE), ("down", BASE_INVERSE)):
                steps = np.full(size, base, U)
                steps[0] = 1
                setattr(cls, name, np.multiply.accumulate(steps))
        return cls.up[:n], cls.down[:n]


def slices(batch: pa.RecordBatch | pa.Table, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts hold about ``limit`` bytes."""
    for part in batch.to_batches() if isinstance(batch, pa.Table) else [batch]:
        sizes = pc.fill_null(pc.binary_length(part.column(text)), 0).to_numpy(zero_copy_only=False)
        pieces = (np.cumsum(sizes, dtype=np.int64) - sizes) // limit
        cuts = [0, *(np.flatnonzero(np.diff(pieces)) + 1), part.num_rows] if part.num_rows else []
        for a, b in zip(cuts, cuts[1:]):
            yield part.slice(a, b - a)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and where each text starts (one more entry at the end)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None:
        return np.empty(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[starts[0]:starts[-1]], starts - starts[0]


def word_spans(buf: np.ndarray, starts: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each run of bytes other than ``space``, and the index of the first one of each text (one more at the end)."""
    inside = ~space[buf]
    edge = np.zeros(len(buf) + 1, bool)
    edge[starts] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | edge[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | edge[1:-1]
    first, last = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return first, last, np.searchsorted(first, starts)


def span_hashes(buf: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of the bytes of each span: eight bytes at a time, mixed in between; longer spans by BLAKE2.

    Spans of up to eight bytes and one length never collide. Two seeds give independent halves of a 128-bit hash.
    """
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    lanes = np.ndarray(len(buf) + 1, "<u8", padded, strides=(1,))      # the eight bytes from each place
    size = last - first
    out = mix(size.astype(U) * U(0x9E3779B97F4A7C15) + mix(np.array([seed], U)))
    at = np.flatnonzero(size > 0)
    for done in range(0, LANE_BYTES, 8):
        left = size[at] - done
        lane = lanes[first[at] + done] & LANE_MASKS[np.minimum(left, 8)]
        out[at] = mix(out[at] ^ lane) * U(0xD6E8FEB86659FD93)
        at = at[left > 8]
        if not len(at):
            return mix(out)
    salt = seed.to_bytes(8, "little")
    for i in at.tolist():
        digest = blake2b(buf[first[i]:last[i]].tobytes(), digest_size=8, salt=salt).digest()
        out[i] = int.from_bytes(digest, "little")
    return mix(out)


def running_hashes(buf: np.ndarray, first: np.ndarray, last: np.ndarray, seed: int = 1) -> np.ndarray:
    """A 64-bit hash of overlapping spans from running sums: a polynomial, shifted to the span's start.

    Modulo 2**64 such a polynomial is blind to some repetitive spans of a thousand bytes and more; use ``span_hashes`` for words.
    """
    up, down = Powers.upto(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, U)
    np.cumsum(random_words(256, seed)[buf] * up[:len(buf)], out=sums[1:])
    return mix((sums[last] - sums[first]) * down[first] + (last - first).astype(U))


def words(column: pa.Array, lower: bool = False, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word of a column, and the index of the first word of each text."""
    buf, starts = text_bytes(column)
    if lower:
        buf = LOWER[buf]
    first, last, bounds = word_spans(buf, starts)
    return span_hashes(buf, first, last, seed), bounds


def rolling(codes: np.ndarray, width: int, seed: int = 1) -> np.ndarray:
    """The hash of every run of ``width`` consecutive codes, by doubling; fewer codes give none."""
    if len(codes) < width:
        return np.empty(0, U)
    whole, have, span, level = None, 0, 1, codes.astype(U)
    factors = random_words(2 * width.bit_length() + 2, seed) | U(1)
    step = 0
    while True:
        if width & span:
            whole = level if whole is None else (
                whole[:len(codes) - have - span + 1] * factors[2 * step + 1] + level[have:len(codes) - span + 1])
            have += span
        if have == width:
            return mix(whole[:len(codes) - width + 1])
        level = level[:-span] * factors[2 * step] + level[span:]
        level ^= level >> U(29)
        span, step = span * 2, step + 1


def window_starts(bounds: np.ndarray, width: int) -> np.ndarray:
    """The positions at which a window of ``width`` items lies within one text."""
    n = int(bounds[-1])
    ok = np.zeros(n + 1, np.int32)
    sizes = np.diff(bounds)
    fits = sizes >= width
    np.add.at(ok, bounds[:-1][fits], 1)
    np.add.at(ok, bounds[1:][fits] - width + 1, -1)
    return np.flatnonzero(np.cumsum(ok[:n]) > 0)
