"""Words of many texts at once, as numpy arrays over an Arrow column's bytes."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa

_WHITE = np.zeros(256, bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True
#: Odd factors that mix eight bytes of a word into its hash, for each of two hashes.
_FACTORS = ((0x9FB21C651E98DF25, 0xD6E8FEB86659FD93), (0xC2B2AE3D27D4EB4F, 0x9E3779B97F4A7C15))
#: Words of more bytes are hashed one by one.
_LONG = 1 << 12
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], "u8")


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, end to end, and where each row begins."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, "i8" if wide else "i4")[column.offset : column.offset + len(column) + 1].astype("i8")
    held = np.frombuffer(data, "u1")[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.empty(0, "u1")
    return held, at - at[0]


def words(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each word begins and ends, and its row."""
    solid = ~_WHITE[data]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    full = rows[1:] > rows[:-1]
    for marks, at in ((first, rows[:-1][full]), (last, rows[1:][full] - 1)):
        marks[at] = solid[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(rows, starts, "right") - 1


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each word's bytes; seeds 0 and 1 are independent.

    Words are taken eight bytes at a time, and what has been hashed is turned and multiplied before the next eight come
    in, so that there is no algebra by which unequal words agree, as there is with a polynomial."""
    first, second = map(np.uint64, _FACTORS[seed])
    size = ends - starts
    out = mixed(size.astype("u8") * second + first)
    padded = np.concatenate((data, np.zeros(8, "u1")))
    eights = np.lib.stride_tricks.as_strided(padded[:8].view("<u8"), (len(data) + 1,), (1,))
    todo, at = np.flatnonzero((size > 0) & (size <= _LONG)), 0
    while len(todo):
        left = size[todo] - at
        x = eights[starts[todo] + at] & _MASKS[np.minimum(left, 8)]
        x *= first
        x ^= x >> np.uint64(32)
        h = out[todo] ^ (x * second)
        out[todo] = mixed((h << np.uint64(23) | h >> np.uint64(41)) * first)
        todo, at = todo[left > 8], at + 8
    for i in np.flatnonzero(size > _LONG):
        whole = hashlib.blake2b(data[starts[i] : ends[i]].tobytes(), digest_size=8, salt=bytes([seed])).digest()
        out[i] = np.frombuffer(whole, "<u8")[0]
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def joined(a: np.ndarray, b: np.ndarray, seed: int) -> np.ndarray:
    """A hash of two neighbouring parts from theirs."""
    a = a * np.uint64(0x9E3779B97F4A7C15 + 2 * seed)
    b = (b ^ (b >> np.uint64(32))) * np.uint64(0xC2B2AE3D27D4EB4F + 2 * seed)
    return mixed(a + b)


def runs_of_words(h: np.ndarray, n: int, seed: int = 0) -> np.ndarray:
    """Hashes of all runs of n consecutive words, put together from runs of powers of two."""
    if len(h) < n:
        return np.empty(0, "u8")
    out, size, width, part = None, 0, 1, h
    while True:
        if n & width:
            m = len(h) - (size + width) + 1
            out = part[:m] if out is None else joined(part[:m], out[width : width + m], seed)
            size += width
        if size == n:
            return out
        part = joined(part[: len(part) - width], part[width:], seed)
        width *= 2


def sliding(x: np.ndarray, n: int, op) -> np.ndarray:
    """op (np.minimum or np.maximum) over each n neighbours."""
    if len(x) < n:
        return x[:0]
    width = 1
    while width * 2 <= n:
        x = op(x[: len(x) - width], x[width:])
        width *= 2
    rest = n - width
    return op(x[: len(x) - rest], x[rest:]) if rest else x
