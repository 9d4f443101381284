"""Array kernels over UTF-8 bytes, shared by the Arrow-batched operators.

Every kernel works on a *block*: whole documents joined by one newline, at most
``BLOCK_BYTES`` long (a longer document is a block of its own). Hashes are
polynomials modulo 2**64 from prefix sums, finished by a mixing step.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BLOCK_BYTES = 1 << 18
U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[str, np.ndarray] = {}

WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mixing of 64-bit values (the finaliser of SplitMix64)."""
    x = x + U((seed * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


def powers(n: int, inverse: bool = False) -> np.ndarray:
    name = "inverse" if inverse else "base"
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, BLOCK_BYTES + 4096)
        step = np.full(size, _INVERSE if inverse else _BASE, dtype=U)
        step[0] = 1
        out = np.cumprod(step, dtype=U)
        if size > 16 * BLOCK_BYTES:  # a huge document's table isn't kept
            return out[:n]
        have = _powers[name] = out
    return have[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] the unnormalised hash of codes[i:j]; codes are 64-bit."""
    out = np.zeros(len(codes) + 1, dtype=U)
    np.cumsum(codes * powers(len(codes)), dtype=U, out=out[1:])
    return out


def range_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    inverse = powers(len(sums), inverse=True)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(U), seed)


_BYTE_CODES = mix(np.arange(256, dtype=U), 7)


def byte_codes(buffer: np.ndarray) -> np.ndarray:
    return _BYTE_CODES[buffer]


def blocks(texts: list[bytes | None], limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first index, buffer, starts, ends) of runs of documents; null counts as empty."""
    at = 0
    while at < len(texts):
        size, upto = 0, at
        while upto < len(texts) and (upto == at or size + len(texts[upto] or b"") < limit) and upto - at < 4096:
            size += len(texts[upto] or b"") + 1
            upto += 1
        part = [t or b"" for t in texts[at:upto]]
        lengths = np.fromiter(map(len, part), dtype=np.int64, count=len(part))
        ends = np.cumsum(lengths + 1) - 1
        yield at, np.frombuffer(b"\n".join(part) + b"\n", dtype=np.uint8), ends - lengths, ends
        at = upto


def words(buffer: np.ndarray, doc_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the first word of each document (with the total last)."""
    white = WHITE[buffer]
    before = np.empty_like(white)
    before[0] = True
    before[1:] = white[:-1]
    starts = np.flatnonzero(~white & before)
    ends = np.flatnonzero(white & ~before)
    first = np.append(np.searchsorted(starts, doc_starts), len(starts))
    return starts, ends, first


def word_hashes(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    return range_hash(prefix_sums(byte_codes(buffer)), starts, ends, seed)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """out[i] = min(values[i : i + width]), by doubling."""
    out, done = values, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[: len(out) - step], out[step:])
        done += step
    return out


def winnow(order: np.ndarray, width: int, valid: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window of ``width`` entries the place of its least, the rightmost of ties.

    Only the upper 32 bits of ``order`` count. ``valid`` marks the windows that count.
    Returns (place, first window, number of windows) of each place that is chosen;
    the windows of a place are consecutive.
    """
    n = len(order) - width + 1
    if n <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    low = U(0xFFFFFFFF)
    keyed = (order & ~low) | (low - np.arange(len(order), dtype=U))
    place = (low - (sliding_min(keyed, width) & low)).astype(np.int64)
    window = np.arange(n, dtype=np.int64) if valid is None else np.flatnonzero(valid[:n])
    if not len(window):
        none = np.zeros(0, dtype=np.int64)
        return none, none, none
    place = place[window]
    first = np.concatenate([[0], np.flatnonzero((np.diff(place) != 0) | (np.diff(window) != 1)) + 1])
    return place[first], window[first], np.diff(np.append(first, len(window)))
