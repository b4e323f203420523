"""Word and shingle hashes of many texts at once (numpy), and grouped batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

from occrisk.llm.common import mix64

# An odd multiplier.
_BASE = 0x9E3779B97F4A7C15
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64))
CHUNK_BYTES = 1 << 21


def powers(n: int, base: int = _BASE) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out)


# A second, independent hash: another base and another value for each byte.
_BASES = (_BASE, 0xD6E8FEB86659FD93)
_BYTES = (_BYTE, mix64(_BYTE + np.uint64(0x1234567)))


class _Powers:
    """Powers of a base and of its inverse, grown on demand."""

    known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    @classmethod
    def of(cls, n: int, kind: int = 0) -> tuple[np.ndarray, np.ndarray]:
        if kind not in cls.known or n > cls.known[kind][0].size:
            size = max(1 << 16, 1 << (n - 1).bit_length())
            cls.known[kind] = powers(size, _BASES[kind]), powers(size, pow(_BASES[kind], -1, 1 << 64))
        return cls.known[kind]


def prefix_hash(data: np.ndarray, kind: int = 0) -> np.ndarray:
    """H with H[j] - H[i] = hash of data[i:j] times base^i."""
    up, _ = _Powers.of(data.size + 1, kind)
    out = np.zeros(data.size + 1, np.uint64)
    np.cumsum(_BYTES[kind][data] * up[: data.size], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray, kind: int = 0) -> np.ndarray:
    """Hashes of spans that depend on their bytes only."""
    _, down = _Powers.of(prefix.size, kind)
    return mix64((prefix[ends] - prefix[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of a byte array; `gap` tells the bytes between words."""
    inside = np.zeros(data.size + 2, np.int8)
    inside[1:-1] = ~gap[data]
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def chunks(texts: list[bytes], size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of texts of about `size` bytes; one text alone may be larger."""
    begin, held = 0, 0
    for n, text in enumerate(texts):
        if held and held + len(text) > size:
            yield begin, n
            begin, held = n, 0
        held += len(text) + 1
    if begin < len(texts):
        yield begin, len(texts)


def words_of(texts: list[bytes], gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and the number of words of each text."""
    data = np.frombuffer(b" ".join(texts), np.uint8)
    starts, ends = word_spans(data, gap)
    lengths = np.array([len(t) for t in texts], np.int64)
    firsts = np.concatenate([[0], np.cumsum(lengths[:-1] + 1)]) if len(texts) else np.empty(0, np.int64)
    counts = np.diff(np.searchsorted(starts, np.concatenate([firsts, [data.size + 1]])))
    return span_hash(prefix_hash(data), starts, ends), counts


def shingles_of(words: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes per text, all in a row, and how many each has.

    A text of fewer than `width` words, but at least one, has one shingle: all its words.
    """
    begins = np.concatenate([[0], np.cumsum(counts)])
    multipliers = powers(width)
    rolled = np.zeros(max(0, words.size - width + 1), np.uint64)
    for k in range(width):
        rolled += words[k : k + rolled.size] * multipliers[k]
    rolled = mix64(rolled)
    parts = []
    for n, count in enumerate(counts.tolist()):
        at = begins[n]
        if count >= width:
            parts.append(np.unique(rolled[at : at + count - width + 1]))
        elif count:
            own = words[at : at + count]
            parts.append(mix64(np.array([(own * multipliers[:count]).sum(dtype=np.uint64) + np.uint64(count)], np.uint64)))
        else:
            parts.append(np.empty(0, np.uint64))
    sizes = np.array([p.size for p in parts], np.int64)
    return np.concatenate(parts) if parts else np.empty(0, np.uint64), sizes


def grouped(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Whole groups from batches of rows that come sorted by `keys`."""
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        changes = np.zeros(len(batch), bool)
        for key in keys:
            values = batch[key].to_numpy()
            changes[1:] |= values[1:] != values[:-1]
        cuts = np.flatnonzero(changes)
        if held:
            last = held[-1].iloc[-1]
            same = all(last[k] == batch[k].iloc[0] for k in keys)
            if not same:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
        edges = [0, *cuts.tolist(), len(batch)]
        for a, b in zip(edges[:-2], edges[1:-1]):
            held.append(batch.iloc[a:b])
            yield pd.concat(held) if len(held) > 1 else held[0]
            held = []
        held.append(batch.iloc[edges[-2] : edges[-1]])
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]
