"""64-bit hashes of words, and vectorised ones of word windows and byte windows of many texts at once.

Texts arrive as one byte buffer with offsets, as Arrow holds them. A word's
hash is a digest of its bytes. A window's hash is a difference of prefix sums
of ``value[i] * base**i``, brought back to position 0 by the inverse power, and
then mixed. Prefix sums run over blocks, so temporary arrays stay small for
texts of any length. A window's hash finds candidates; where windows decide,
their operators compare bytes or 128-bit digests.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash

U = np.uint64
#: Items worked on at once, so that temporary arrays stay in a processor's cache.
BLOCK = 1 << 16
#: Odd numbers that are 3 modulo 8, so that 1 - base keeps all but one bit.
_BASES = (0x9E3779B97F4A7C13 | 3, 0xC2B2AE3D27D4EB4B, 0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64 bits (two multiplications, three shifts)."""
    h = h ^ (h >> U(30))
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(27)
    h *= U(0x94D049BB133111EB)
    h ^= h >> U(31)
    return h


_TABLES = [mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15) + U(s)) for s in (11, 0x5851F42D4C957F2D)]
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and its inverse modulo 2**64 for i below n (at least)."""
    have = _powers.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, BLOCK + 4096)
        up = np.full(size, base, U)
        down = np.full(size, pow(base, -1, 1 << 64), U)
        up[0] = down[0] = 1
        have = (np.multiply.accumulate(up), np.multiply.accumulate(down))
        if size <= 4 * BLOCK:
            _powers[base] = have
    return have


def flat(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and len + 1 offsets into them; a null text is an empty one."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no chunk at all
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, at - at[0]


def words_of(data: bytes, offsets: np.ndarray, lower: bool = False) -> list[list[bytes]]:
    """The words of each text (A-Z as a-z if ``lower``); words never cross texts."""
    data = data.lower() if lower else data  # of bytes, only A-Z changes
    at = offsets.tolist()
    return [data[a:b].split() for a, b in zip(at, at[1:])]


def word_hashes(words: list[bytes]) -> np.ndarray:
    """A 64-bit digest of each word's bytes.

    A polynomial of the bytes would not do: modulo a power of two, a
    Thue-Morse word of 1,024 letters and its complement agree for every base.
    """
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), U, len(words))


def windows(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of every k consecutive items of ``hashes`` (len - k + 1 of them, or none)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out, base = np.empty(n, U), _BASES[seed]
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        m = b - a + k - 1
        up, down = powers(base, m + 1)
        sums = np.zeros(m + 1, U)
        np.cumsum(hashes[a : a + m] * up[:m], out=sums[1:])
        out[a:b] = (sums[k : k + b - a] - sums[: b - a]) * down[: b - a]
    return mix(out)


def byte_windows(buf: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of every k consecutive bytes."""
    n = len(buf) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    out, base, table = np.empty(n, U), _BASES[seed], _TABLES[seed]
    for a in range(0, n, BLOCK):
        b = min(n, a + BLOCK)
        m = b - a + k - 1
        up, down = powers(base, m + 1)
        part = table[buf[a : a + m]]
        part *= up[:m]
        sums = np.zeros(m + 1, U)
        np.cumsum(part, out=sums[1:])
        out[a:b] = (sums[k : k + b - a] - sums[: b - a]) * down[: b - a]
    return mix(out)
