"""Words and bytes of Arrow text columns as arrays of 64-bit symbols.

Words are hashed eight bytes at a time under a key. Stretches of symbols have polynomials modulo
2^64 for hashes, taken from prefix sums, so that of any stretch costs one subtraction and one
product. Such polynomials of long regular stretches can agree without a reason, whatever the
values; so they are taken of short stretches only, over symbols that depend on the key.
"""

from __future__ import annotations

import hashlib
import secrets
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
BASE = 0x9E3779B97F4A7C15
CHUNK = 1 << 20
#: Words of more bytes are hashed one by one.
LONG_WORD = 256
U = np.uint64

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
#: Everything but ASCII letters, digits and bytes of non-ASCII characters.
NOT_ALNUM = np.zeros(256, bool)
NOT_ALNUM[[*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_powers: dict[str, np.ndarray] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> U(32))  # an array of its own, changed in place from here on
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    h *= U(0xD6E8FEB86659FD93)
    h ^= h >> U(32)
    return h


BYTE_VALUES = mix(np.arange(1, 257, dtype=U) * U(0xA24BAED4963EE407))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^i and BASE^-i modulo 2^64 for i < n."""
    if len(_powers.get("p", ())) < n:
        size = max(n, CHUNK + 4096)
        for name, base in (("p", BASE), ("q", pow(BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=U)
            steps[0] = 1
            _powers[name] = np.cumprod(steps, dtype=U)
    return _powers["p"], _powers["q"]


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values[i] * BASE^i, one longer than values."""
    p, _ = powers(len(values) + 1)
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def stretches(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of values[start:end], from prefix(values)."""
    _, q = powers(len(sums))
    return mix((sums[end] - sums[start]) * q[start] + (end - start).astype(U) * U(0x94D049BB133111EB))


def grams(sums: np.ndarray, size: int) -> np.ndarray:
    """stretches() of `size` values from every place on."""
    n = len(sums) - size
    h = sums[size:] - sums[:n]
    h *= powers(len(sums))[1][:n]
    h += U(size * 0x94D049BB133111EB % (1 << 64))
    return mix(h)


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[tuple]:
    """(rows, bytes, offsets) of stretches of the batch with about `most` bytes of text each,
    or of one row alone. Null texts count as empty."""
    text = pc.fill_null(batch.column(column).cast(pa.large_string()), "")
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    n = len(text)
    if not n:
        return
    offsets = np.frombuffer(text.buffers()[1], dtype=np.int64)[text.offset : text.offset + n + 1]
    data = text.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        to = min(to, n)
        own = offsets[at : to + 1]
        yield batch.slice(at, to - at), raw[own[0] : own[-1]], own - own[0]
        at = to


def words(raw: np.ndarray, offsets: np.ndarray, apart: np.ndarray) -> tuple:
    """(start, end, first): byte spans of the words of all texts, and where each text's words
    begin in them (one longer than the texts). apart: by byte, whether it separates words."""
    n = len(raw)
    inside = ~apart[raw]
    begins, ends = inside.copy(), inside.copy()
    edge = offsets[1:-1]
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edge = edge[(edge > 0) & (edge < n)]
    begins[edge] = inside[edge]
    ends[edge - 1] = inside[edge - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return start, end, np.searchsorted(start, offsets)


def new_key() -> int:
    """A key for one run: no text can be made for two words to share a hash under it."""
    return secrets.randbits(63)


def hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, key: int = 0) -> np.ndarray:
    """The hash of every span of bytes."""
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(raw) + 1,), "<u8", padded, strides=(1,))  # from every byte on
    length = end - start
    out = mix(length.astype(U) * U(0x94D049BB133111EB) + U(key))
    for k in np.flatnonzero(length > LONG_WORD):
        own = hashlib.blake2b(raw[start[k] : end[k]].tobytes(), digest_size=8, key=key.to_bytes(8, "little"))
        out[k] = int.from_bytes(own.digest(), "little")
    alive, at = np.flatnonzero((length > 0) & (length <= LONG_WORD)), 0
    while len(alive):
        left = length[alive] - at
        chunk = eight[start[alive] + at]
        # bytes behind the end count as none
        chunk &= U(0xFFFFFFFFFFFFFFFF) >> (U(8) * (U(8) - np.minimum(left, 8).astype(U)))
        out[alive] = mix(out[alive] ^ chunk) + U(at)
        alive = alive[left > 8]
        at += 8
    return out
