"""Vectorised word and shingle hashes of many texts at once (numpy over the UTF-8 bytes)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15 | 1)
_LOWER = np.arange(256, dtype=np.uint64) + np.uint64(1)
_LOWER[ord("A") : ord("Z") + 1] = _LOWER[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes that are worked on at once; longer texts are cut at white space.
PIECE = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (two multiply and shift rounds)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _MULTIPLIER, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _hashes(data: bytes, prefix: int = 0) -> tuple[np.ndarray, ...]:
    """Hash and first byte of each word of white-space separated bytes, and hash of its first `prefix` bytes; A-Z are lower-cased."""
    raw = np.frombuffer(data, dtype=np.uint8)
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    starts, ends = edge[0::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, dtype=np.uint64), starts, np.zeros(0, dtype=np.uint64)
    lengths = ends - starts
    first = np.concatenate(([0], np.cumsum(lengths)[:-1]))
    place = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
    terms = _LOWER[raw[inside]] * _powers(int(lengths.max()))[place]
    heads = mix(np.add.reduceat(terms * (place < prefix), first)) if prefix else None
    return mix(np.add.reduceat(terms, first) + lengths.astype(np.uint64)), starts, heads


def _pieces(data: bytes) -> Iterator[bytes]:
    at = 0
    while len(data) - at > PIECE:
        cut = max(data.rfind(c, at, at + PIECE) for c in (b" ", b"\n", b"\t", b"\r"))
        if cut <= at:
            found = [x for c in (b" ", b"\n", b"\t", b"\r") if (x := data.find(c, at + PIECE)) >= 0]
            cut = min(found, default=len(data))
        yield data[at:cut]
        at = cut
    yield data[at:]


def words(texts: list[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first text's number, offsets of each text's words, word hashes) for runs of texts of about PIECE bytes together."""
    for at, offsets, hashes, _ in words_and_heads(texts, 0):
        yield at, offsets, hashes


def words_and_heads(texts: list[str], prefix: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray | None]]:
    """As words(), with the hashes of the words' first `prefix` bytes."""
    at = 0
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    while at < len(coded):
        end, size = at + 1, len(coded[at])
        while end < len(coded) and size + len(coded[end]) < PIECE:
            size += len(coded[end]) + 1
            end += 1
        if size > PIECE:
            parts = [_hashes(x, prefix) for x in _pieces(coded[at])]
            hashes = np.concatenate([x[0] for x in parts])
            yield at, np.array([0, len(hashes)]), hashes, np.concatenate([x[2] for x in parts]) if prefix else None
        else:
            hashes, starts, heads = _hashes(b"\n".join(coded[at:end]), prefix)
            edges = np.cumsum([0, *(len(x) + 1 for x in coded[at:end])])
            yield at, np.searchsorted(starts, edges), hashes, heads
        at = end


def shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of `width` words, one for each starting word that has one."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(width):
        out = out * _MULTIPLIER + hashes[k : k + n]
    return mix(out)


def text_shingles(hashes: np.ndarray, width: int) -> np.ndarray:
    """The shingles of one text: of all its words, if they are fewer than width; none without words."""
    return shingles(hashes, min(width, len(hashes))) if len(hashes) else hashes


def bits(h: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each hash."""
    return np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def pack(ones: np.ndarray) -> np.ndarray:
    """64-bit integers from rows of 64 booleans."""
    return np.packbits(ones, axis=1, bitorder="little").view(np.uint64).ravel()
