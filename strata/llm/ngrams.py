"""Hashed character n-grams of whole texts, with numpy."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np

NOT_LETTERS = re.compile(r"[\W\d_]+")
LETTER = re.compile(r"[^\W\d_]")
#: Characters hashed at a time; a longer text is taken in overlapping blocks, so memory is bounded.
BLOCK = 1 << 18
#: Odd multipliers of the hash (fixed values, any odd 64-bit numbers do).
STEP, SPREAD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def has_letter(text: str | None) -> bool:
    return text is not None and LETTER.search(text) is not None


def buckets(text: str, sizes: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """The bucket of every n-gram of the lower-cased text, runs of other characters as one space."""
    flat = f" {NOT_LETTERS.sub(' ', text.lower()).strip()} "
    most = max(sizes)
    for start in range(0, max(1, len(flat) - most + 1), BLOCK):
        last = start + BLOCK + most > len(flat)
        block = flat[start : start + BLOCK + (most - 1)]
        codes = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        rolling = codes
        for n in range(1, most + 1):
            if n > 1:
                if len(codes) < n:
                    break
                rolling = rolling[:-1] * STEP + codes[n - 1 :]
            if n in sizes:
                own = rolling if last else rolling[:BLOCK]
                mixed = (own + np.uint64(n)) * SPREAD
                mixed = (mixed ^ (mixed >> np.uint64(32))) * STEP
                yield (mixed >> np.uint64(64 - bits)).astype(np.int64)
        if last:
            break


def counts(text: str, sizes: tuple[int, ...], bits: int) -> np.ndarray:
    """How often each bucket occurs."""
    total = np.zeros(1 << bits, np.int64)
    for block in buckets(text, sizes, bits):
        total += np.bincount(block, minlength=1 << bits)
    return total


def present(text: str, sizes: tuple[int, ...], bits: int, flags: np.ndarray) -> np.ndarray:
    """The buckets that occur, ascending. `flags` is scratch space of 2**bits zeros and left so."""
    parts = list(buckets(text, sizes, bits))
    for block in parts:
        flags[block] = 1
    found = np.flatnonzero(flags)
    flags[found] = 0
    return found
