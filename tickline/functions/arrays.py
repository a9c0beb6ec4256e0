"""Rules for wire values on whole arrays: times, fixed-point numbers and flag words. `wire` has them as Column expressions."""

from __future__ import annotations

import numpy as np

from tickline.functions.fixed import NULL_TIME, QUALITY
from tickline.functions.wire import null_of


def flags(*bits: tuple[np.ndarray, int]) -> np.ndarray:
    """One word for each record, with the bit of every condition that holds."""
    out = np.zeros(len(bits[0][0]), np.int64)
    for condition, bit in bits:
        out[condition] |= bit
    return out


def time_ns(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nanoseconds from midnight of a time hhmmssmmm, whether it is one)."""
    raw = raw.astype(np.int64)
    h, m, s, ms = raw // 10_000_000, raw // 100_000 % 100, raw // 1000 % 100, raw % 1000
    return (((h * 60 + m) * 60 + s) * 1000 + ms) * 1_000_000, (raw != NULL_TIME) & (h < 24) & (m < 60) & (s < 60)


def time_flags(raw: np.ndarray, good: np.ndarray) -> np.ndarray:
    return flags((raw == NULL_TIME, QUALITY["null_source"] | QUALITY["time"]), (~good, QUALITY["time"]))


def decimal(raw: np.ndarray, scale: int, bits: int, normal: np.ndarray) -> tuple[tuple, np.ndarray]:
    """((raw, p6, scale, raw_valid, p6_valid), whether p6 leaves 64 bits): p6 is there where the value is, `normal` holds and it fits."""
    factor = 10 ** (6 - scale)
    top = ((1 << 63) - 1) // factor
    valid = raw != null_of(bits)
    fits = (raw <= top) & (raw >= -top - (1 if (top + 1) * factor == 1 << 63 else 0))
    shown = valid & normal & fits
    return (raw, np.where(shown, raw, 0) * factor, scale, valid, shown), valid & normal & ~fits
