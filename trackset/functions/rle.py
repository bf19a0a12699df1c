"""Run-length masks: COCO's compressed counts, run lengths, and intervals over the column-major pixel index."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTERVALS = T.ArrayType(T.StructType([T.StructField("s", T.LongType()), T.StructField("e", T.LongType())]))


def pack(runs: list[int]) -> str:
    """Run lengths as text: from the fourth on each is the difference to the one two before; a number is written in
    groups of five bits, low ones first, 32 marks that more follow, and 48 is added to make it printable."""
    out = []
    for i, run in enumerate(runs):
        left = int(run) - (int(runs[i - 2]) if i > 2 else 0)
        while True:
            five, left = left & 31, left >> 5
            done = left == (-1 if five & 16 else 0)
            out.append(chr(48 + five + (0 if done else 32)))
            if done:
                break
    return "".join(out)


def unpack(text: str) -> list[int]:
    runs: list[int] = []
    value = bits = 0
    for c in text.encode("ascii"):
        c -= 48
        value |= (c & 31) << bits
        bits += 5
        if not c & 32:
            if c & 16:
                value -= 1 << bits
            runs.append(value + (runs[-2] if len(runs) > 2 else 0))
            value = bits = 0
    if bits:
        raise ValueError("counts end within a number")
    return runs


def checked(text: str, height: int, width: int) -> list[int]:
    """Run lengths that fill the frame, or an error."""
    runs = unpack(text)
    if any(r < 0 for r in runs) or sum(runs) != height * width:
        raise ValueError(f"runs cover {sum(runs)} of {height * width} pixels")
    return runs


def runs_of(intervals: list[tuple[int, int]], size: int) -> list[int]:
    """Run lengths, background first, of sorted disjoint intervals; touching ones are merged."""
    runs, at = [], 0
    for s, e in intervals:
        if runs and s == at:
            runs[-1] += e - s
        else:
            runs += [s - at, e - s]
        at = e
    return [*runs, size - at] if at < size or not runs else runs


def intervals_of(runs: list[int]) -> list[tuple[int, int]]:
    edges = np.cumsum([0, *runs]).tolist()
    return [(edges[i], edges[i + 1]) for i in range(1, len(runs), 2) if runs[i]]


#: Below so many pixels shifting small integers is faster than numpy's calls.
_SMALL = 1 << 14


def bits_of_edges(edges: np.ndarray) -> int:
    """A mask as one integer with a bit for each pixel, from the starts and ends of its sorted intervals in turn."""
    if not len(edges):
        return 0
    if edges[-1] < _SMALL:
        bits, turns = 0, iter(edges.tolist())
        for s, e in zip(turns, turns):
            bits |= ((1 << (e - s)) - 1) << s
        return bits
    lengths = edges.copy()
    lengths[1:] -= edges[:-1]
    shown = np.zeros(len(edges), "u1")
    shown[1::2] = 1
    return int.from_bytes(np.packbits(np.repeat(shown, lengths), bitorder="little").tobytes(), "little")


def edges_of_bits(bits: int) -> np.ndarray:
    """The starts and ends of a mask's intervals in turn: where a pixel differs from the one before."""
    changes = bits ^ (bits << 1)
    packed = np.frombuffer(changes.to_bytes((changes.bit_length() + 7) // 8, "little"), "u1")
    some = np.flatnonzero(packed)
    which, bit = np.nonzero(np.unpackbits(packed[some, None], axis=1, bitorder="little"))
    return some[which] * 8 + bit


def bits_of(intervals) -> int:
    return bits_of_edges(np.array(list(intervals), "i8").ravel())


def intervals_of_bits(bits: int) -> list[tuple[int, int]]:
    edges = edges_of_bits(bits).tolist()
    return list(zip(edges[::2], edges[1::2]))


@F.pandas_udf(T.StringType())
def counts_text(intervals: pd.Series, size: pd.Series) -> pd.Series:
    """Compressed counts of a mask given by intervals; null stays null."""
    return pd.Series(
        [None if m is None else pack(runs_of([(int(x["s"]), int(x["e"])) for x in m], int(n))) for m, n in zip(intervals, size)]
    )


@F.pandas_udf(INTERVALS)
def counts_intervals(counts: pd.Series) -> pd.Series:
    """The intervals of compressed counts; null stays null."""
    return pd.Series([None if c is None else [{"s": s, "e": e} for s, e in intervals_of(unpack(c))] for c in counts])


@F.pandas_udf(T.ArrayType(T.LongType()))
def runs(intervals: pd.Series, size: pd.Series) -> pd.Series:
    """Run lengths, background first, of a mask given by intervals; null stays null."""
    return pd.Series(
        [None if m is None else runs_of([(int(x["s"]), int(x["e"])) for x in m], int(n)) for m, n in zip(intervals, size)]
    )


@F.pandas_udf(T.BooleanType())
def decodable(counts: pd.Series, size: pd.Series) -> pd.Series:
    """Whether compressed counts can be read and fill the frame."""

    def ok(text, n) -> bool:
        try:
            runs = unpack(text)
        except (ValueError, TypeError, AttributeError, UnicodeEncodeError):
            return False
        return min(runs, default=0) >= 0 and sum(runs) == n

    return pd.Series([ok(c, n) for c, n in zip(counts, size)])


def area(intervals: Column) -> Column:
    """Pixels of a mask; 0 for null."""
    total = F.aggregate(intervals, F.lit(0).cast("long"), lambda n, x: n + x["e"] - x["s"])
    return F.coalesce(total, F.lit(0)).cast("long")


def overlap(a: Column, b: Column) -> Column:
    """Pixels that two masks share; 0 if either is null.

    Both areas less that of the union, which one fold over all intervals by start finds.
    """
    zero = F.lit(0).cast("long")
    begin = F.struct(zero.alias("n"), zero.alias("end"))
    more = lambda u, x: F.struct(
        (u["n"] + F.greatest(zero, x["e"] - F.greatest(x["s"], u["end"]))).alias("n"),
        F.greatest(u["end"], x["e"]).alias("end"),
    )
    union = F.aggregate(F.sort_array(F.concat(a, b)), begin, more)["n"]
    return F.coalesce(area(a) + area(b) - union, zero).cast("long")
