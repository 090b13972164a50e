"""Counting quotient filters, lossless: the sorted form in which shards send and merge counts of packed keys.

A key of ``bits`` bits is permuted invertibly, so that its leading bits, the quotient, are spread evenly whatever the
keys are; the rest, the remainder, is kept whole, so the key can be had back.  A filter holds one range of permuted keys
(those with the same ``range_bits`` leading bits): run lengths of its quotients in unary, remainders in as few bytes
as they need, and one byte a counter (eight more where it does not suffice), compressed.
"""

from __future__ import annotations

import struct

import numpy as np
import zstandard

_U = np.uint64
_HEAD = struct.Struct("<QQQBBB")      # entries, counters beyond a byte, bytes of counters, quotient, range and key bits
_MUL = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)


def _mixed(x: np.ndarray, bits: int, factors) -> np.ndarray:
    mask, half = _U((1 << bits) - 1), _U((bits + 1) // 2)
    with np.errstate(over="ignore"):
        x = x ^ (x >> half)               # its own inverse, as half the bits or more are shifted out
        for f in factors:
            x = (x * _U(f)) & mask
            x = x ^ (x >> half)
    return x


def permute(key: np.ndarray, bits: int = 64) -> np.ndarray:
    """A bijection of the whole numbers below 2 ** bits whose leading bits depend on every bit of the key."""
    return _mixed(key, bits, [m & ((1 << bits) - 1) for m in _MUL])


def restore(x: np.ndarray, bits: int = 64) -> np.ndarray:
    """The key of a permuted value."""
    return _mixed(x, bits, [pow(m, -1, 1 << bits) for m in reversed(_MUL)])


def range_of(x: np.ndarray, range_bits: int, bits: int = 64) -> np.ndarray:
    return (x >> _U(bits - range_bits)).astype(np.int64) if range_bits else np.zeros(len(x), np.int64)


def encode(x: np.ndarray, counts: np.ndarray, range_bits: int = 0, bits: int = 64) -> bytes:
    """A filter of sorted distinct permuted keys of one range, and their counts."""
    n = len(x)
    q = min(max(n.bit_length() - 1, 0), bits - range_bits)
    rest = bits - range_bits - q
    quotient = (x >> _U(rest)).astype(np.int64) & ((1 << q) - 1) if q else np.zeros(n, np.int64)
    runs = np.bincount(quotient, minlength=1 << q)
    unary = np.ones(n + (1 << q), dtype=np.uint8)
    unary[np.cumsum(runs + 1) - 1] = 0
    width = -(-rest // 8)
    remainder = x & _U((1 << rest) - 1)
    body = remainder.astype("<u8").view(np.uint8).reshape(n, 8)[:, :width]
    big = counts >= 255
    counters = zstandard.compress(np.where(big, 255, counts).astype(np.uint8).tobytes() + counts[big].astype("<i8").tobytes(), 1)
    return b"".join([_HEAD.pack(n, int(big.sum()), len(counters), q, range_bits, bits), np.packbits(unary).tobytes(),
                     body.tobytes(), counters])


def decode(data: bytes, range_id: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(sorted permuted keys, counts) of a filter."""
    n, n_big, size_counters, q, range_bits, bits = _HEAD.unpack_from(data)
    if not n:
        return np.zeros(0, _U), np.zeros(0, np.int64)
    at = _HEAD.size
    size = -(-(n + (1 << q)) // 8)
    unary = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n + (1 << q))
    at += size
    quotient = (np.flatnonzero(unary) - np.arange(n)).astype(_U)     # zeros before each entry
    rest = bits - range_bits - q
    width = -(-rest // 8)
    body = np.zeros((n, 8), dtype=np.uint8)
    if width:
        body[:, :width] = np.frombuffer(data, np.uint8, n * width, at).reshape(n, width)
    at += n * width
    x = body.reshape(-1).view("<u8").astype(_U)
    if q:
        x |= quotient << _U(rest)
    if range_bits:
        x |= _U(range_id) << _U(bits - range_bits)
    counters = zstandard.decompress(data[at:at + size_counters])
    counts = np.frombuffer(counters, np.uint8, n).astype(np.int64)
    if n_big:
        counts[counts == 255] = np.frombuffer(counters, "<i8", n_big, n)
    return x, counts


def merge(filters: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted filters merged: (distinct permuted keys, summed counts, each input entry's place among them)."""
    x = np.concatenate([f[0] for f in filters]) if filters else np.zeros(0, _U)
    if not len(x):
        return x, np.zeros(0, np.int64), np.zeros(0, np.int64)
    counts = np.concatenate([f[1] for f in filters])
    order = np.argsort(x, kind="stable")
    x = x[order]
    new = np.ones(len(x), dtype=bool)
    new[1:] = x[1:] != x[:-1]
    place = np.empty(len(x), dtype=np.int64)
    place[order] = np.cumsum(new) - 1
    return x[new], np.add.reduceat(counts[order], np.flatnonzero(new)), place
