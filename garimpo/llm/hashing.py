"""Word and n-gram hashes of whole Arrow text columns, without a Python loop per word.

Words are runs of bytes other than ASCII white space, ``[^\\x20\\x09-\\x0D]+``.
A word hash is a polynomial over its bytes, an n-gram hash one over its word
hashes, each ended by a 64-bit mixer. All arithmetic is modulo 2**64.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import cloudpickle

# Tasks get this module's code along with their function, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

PIECE = 1 << 18  # bytes hashed at once; bounds the temporary arrays
TEXT_SLICE = 1 << 20  # bytes of text of the rows handled at once
U64 = np.uint64
MASK = (1 << 64) - 1
BYTE_BASE = 0x9E3779B97F4A7C15 | 1
WORD_BASE = 0xC2B2AE3D27D4EB4F | 1
_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=U64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _tables() -> dict[str, np.ndarray]:
    if not _TABLES:
        byte = np.arange(256)
        lower = np.where((byte >= 65) & (byte <= 90), byte + 32, byte)
        code = mix(np.arange(1, 257, dtype=U64) * U64(0xD6E8FEB86659FD93))
        _TABLES["cased"] = code
        _TABLES["lower"] = code[lower]
        _TABLES["solid"] = ~((byte == 32) | ((byte >= 9) & (byte <= 13)))
        _TABLES["power"] = powers(BYTE_BASE, PIECE)
        _TABLES["inverse"] = powers(pow(BYTE_BASE, -1, 1 << 64), PIECE)
    return _TABLES


class Words:
    """The words of a text column: byte spans, hashes, and where each row's words begin."""

    def __init__(self, column: pa.Array, lower: bool):
        column = column.fill_null("")
        large = pa.types.is_large_string(column.type)
        bounds = np.frombuffer(column.buffers()[1], dtype=np.int64 if large else np.int32)
        bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
        raw = column.buffers()[2]
        data = np.frombuffer(raw, dtype=np.uint8) if raw is not None else np.empty(0, np.uint8)
        self.data = data[bounds[0] : bounds[-1]]
        self.bounds = bounds - bounds[0]
        solid = _tables()["solid"][self.data]
        starts = solid.copy()
        starts[1:] &= ~solid[:-1]
        inner = self.bounds[self.bounds < len(solid)]
        starts[inner] = solid[inner]
        ends = solid.copy()
        ends[:-1] &= ~solid[1:]
        last = self.bounds[self.bounds > 0] - 1
        ends[last] = solid[last]
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends) + 1
        self.first = np.searchsorted(self.starts, self.bounds)
        self.hashes = self._hash(_tables()["lower" if lower else "cased"])

    def _hash(self, code: np.ndarray) -> np.ndarray:
        power, inverse = _tables()["power"], _tables()["inverse"]
        out = np.empty(len(self.starts), dtype=U64)
        at = 0
        while at < len(out):
            origin = self.starts[at]
            to = int(np.searchsorted(self.ends, origin + PIECE, side="right"))
            if to == at:  # one word longer than a piece
                word = code[self.data[origin : self.ends[at]]].tobytes()
                out[at] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
                at += 1
                continue
            span = self.data[origin : self.ends[to - 1]]
            total = np.zeros(len(span) + 1, dtype=U64)
            np.cumsum(code[span] * power[: len(span)], out=total[1:])
            begin, end = self.starts[at:to] - origin, self.ends[at:to] - origin
            out[at:to] = (total[end] - total[begin]) * inverse[begin]
            at = to
        return mix(out)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def grams(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, by doubling; rows are not told apart."""
    if size < 1 or len(words) < size:
        return np.empty(0, dtype=U64)
    total, done = None, 0
    part, width = words, 1
    left = size
    while True:
        if left & 1:
            if total is None:
                total, done = part, width
            else:
                n = len(words) - done - width + 1
                total = total[:n] + part[done : done + n] * U64(pow(WORD_BASE, done, 1 << 64))
                done += width
        left >>= 1
        if not left:
            break
        n = len(part) - width
        part = part[:n] + part[width : width + n] * U64(pow(WORD_BASE, width, 1 << 64))
        width *= 2
    return mix(total[: len(words) - size + 1] + U64(size))


def shingle_sets(words: Words, size: int) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes; fewer words than ``size`` are one shingle."""
    every = grams(words.hashes, size)
    for begin, end in zip(words.first[:-1], words.first[1:], strict=True):
        if end - begin >= size:
            yield np.unique(every[begin : end - size + 1])
        elif end > begin:
            yield grams(words.hashes[begin:end], int(end - begin))
        else:
            yield np.empty(0, dtype=U64)


def tidy() -> None:
    """Give back what earlier tasks of this worker process left behind.

    Functions shipped by value come with globals of their own, which refer to each
    other: their tables stay until cycles are collected, and freed memory stays
    with the allocators until it is asked for.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = TEXT_SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``most`` bytes of text, or one row."""
    tidy()
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(column)
        sizes = np.asarray(pa.compute.binary_length(batch.column(at)).fill_null(0)).astype(np.int64)
        total, begin = np.cumsum(sizes), 0
        while begin < batch.num_rows:
            before = total[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(total, before + most, side="right")))
            yield batch.slice(begin, end - begin)
            begin = end


def signed(x: np.ndarray) -> np.ndarray:
    """The same bits as Spark's long."""
    return x.view(np.int64)
