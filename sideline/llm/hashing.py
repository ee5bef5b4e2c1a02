"""Vectorised hashing of byte buffers, shared by the fingerprinting operators.

All functions run on numpy arrays inside tasks.  Hashes are 64-bit sums of
random byte values times powers of an odd number (modulo 2**64), so the hash
of any substring follows from one running sum; ``mix`` then scrambles it.
They depend on bytes only and are the same on every machine.

Sums of powers collide for strings made for it (as Thue-Morse sequences), so
whole words are hashed by ``block_hashes``, where each block of bytes is
scrambled together with all before it.
"""

from __future__ import annotations

import hashlib

import numpy as np

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = np.random.Generator(np.random.PCG64(20240607)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    have = _powers[kind]
    if len(have) < n:
        step = np.uint64(_BASE if kind == "up" else _INVERSE)
        size = 1 << max(16, (n - 1).bit_length())
        have = np.full(size, step, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 22:
            _powers[kind] = have
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


#: Bytes up to which words are hashed in blocks of eight, all words at once; longer ones are digested one by one.
_SHORT = 64


def block_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte strings of a buffer: eight bytes at a time, each block mixed with the hash so far."""
    length = ends - starts
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))
    out = mix(length.astype(np.uint64) + np.uint64(_BASE))
    on = np.flatnonzero((length > 0) & (length <= _SHORT))
    at, left = starts[on], length[on]
    while len(on):
        block = eight[at].astype(np.uint64)
        spare = (np.maximum(0, 8 - left) * 8).astype(np.uint64)
        block = (block << spare) >> spare
        out[on] = mix(out[on] * np.uint64(_BASE) ^ mix(block + np.uint64(_BASE)))
        more = left > 8
        on, at, left = on[more], at[more] + 8, left[more] - 8
    for k in np.flatnonzero(length > _SHORT):
        out[k] = np.frombuffer(hashlib.blake2b(data[starts[k]: ends[k]].tobytes(), digest_size=8).digest(), "<u8")[0]
    return out


class Substrings:
    """Hashes of substrings of one buffer: ``of(starts, ends)``."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self._sum = np.zeros(n + 1, np.uint64)
        np.multiply(_BYTE[data], _power("up", n), out=self._sum[1:])
        np.add.accumulate(self._sum, out=self._sum)
        self._down = _power("down", n + 1)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self._sum[ends] - self._sum[starts]) * self._down[starts] + (ends - starts).astype(np.uint64))

    def windows(self, size: int) -> np.ndarray:
        """The hash of every window of ``size`` bytes."""
        n = len(self._sum) - size
        if n <= 0:
            return np.empty(0, np.uint64)
        return mix((self._sum[size:] - self._sum[:n]) * self._down[:n] + np.uint64(size))
