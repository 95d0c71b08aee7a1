"""Hashed character and word n-grams of a text as numpy arrays."""

from __future__ import annotations

import numpy as np
import pandas as pd

#: White space; every other character belongs to a word.
BLANKS = " \t\n\x0b\x0c\r"
# fixed odd multipliers of the rolling hashes
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def words(text: str) -> list[str]:
    # without these, ``split`` takes the same white space
    if text.isascii() and not any(c in text for c in "\x1c\x1d\x1e\x1f"):
        return text.split()
    # that of bytes always does
    found = b"\n".join(text.encode("utf-8", "surrogatepass").split())
    return found.decode("utf-8", "surrogatepass").split("\n") if found else []


def word_hashes(tokens: list[str]) -> np.ndarray:
    if not tokens:
        return np.empty(0, np.uint64)
    return pd.util.hash_array(np.array(tokens, dtype=object), categorize=False)


def _slots(h: np.ndarray, order: int, bits: int) -> np.ndarray:
    h = h + np.uint64(order)
    h *= _MIX
    h ^= h >> np.uint64(29)
    h *= _STEP
    h >>= np.uint64(64 - bits)
    return h.astype(np.int32)


def rolled(units: np.ndarray, order: int, start: np.ndarray | None = None, of: int = 1) -> np.ndarray:
    """Hash of every window of ``order`` units, from those of ``of`` units, if given."""
    h = units if start is None else start
    for k in range(of, order):
        h = h[:-1] * _STEP
        h += units[k:]
    return h


def hash_slots(units: np.ndarray, orders: tuple[int, ...], bits: int, first: int = 64) -> np.ndarray:
    """Slots of all n-grams of hashed units, order after order."""
    out, h, of = [], units, 1
    for k in orders:
        h, of = (rolled(units, k, h, of) if k >= of else rolled(units, k)), k
        out.append(_slots(h, first + k, bits))
    return np.concatenate(out)


def char_slots(text: str, orders: tuple[int, ...], bits: int) -> np.ndarray:
    """Slot of every character n-gram, repeats included; runs of white space count as one blank."""
    units = np.frombuffer(f" {text} ".encode("utf-32-le", "surrogatepass"), np.uint32)
    blank = (units == 0x20) | (units - np.uint32(9) < 5)
    kept = np.flatnonzero(~(blank[1:] & blank[:-1])) + 1
    # a text without words keeps both its blanks
    units = np.where(blank, np.uint32(0x20), units)[np.append(0, kept) if len(kept) else [0, 0]].astype(np.uint64)
    units += np.uint64(1)
    return hash_slots(units, orders, bits, 0)
