"""Vectorised views of the words in Arrow batches of text.

A word is a run of bytes outside space and the five ASCII control spaces, that is
``[^\\x20\\x09-\\x0D]+``. Work goes in slices of bounded size; one text is never split.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2_000_000
SPACES = (9, 10, 11, 12, 13, 32)

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[list(SPACES)] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(name: str, base: np.uint64, n: int) -> np.ndarray:
    have = _POWERS.get(name)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base)
        steps[0] = 1
        have = _POWERS[name] = np.cumprod(steps)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the splitmix64 finisher)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that the texts of each part take about ``limit`` bytes; a longer text stands alone."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths) // limit
    cuts = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts end to end, and the offsets of each (NULL reads as empty)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "" if pa.types.is_string(texts.type) or pa.types.is_large_string(texts.type) else b"")
    kind = np.int64 if pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of some texts.

    ``data`` holds the word bytes without spaces and ``at`` each word's offset there;
    ``text`` is the text of each word and ``first`` each text's first word (one more at the end).
    """

    def __init__(self, texts: pa.Array):
        raw, offsets = buffers(texts)
        space = _IS_SPACE[raw]
        edge = np.ones(len(raw) + 1, bool)
        edge[1:] = space
        # A text's first byte begins a word whatever stands before it, and its last one ends it.
        heads, tails = offsets[:-1][offsets[:-1] < offsets[1:]], offsets[1:]
        edge[heads] = True
        starts = np.flatnonzero(edge[:-1] & ~space)
        edge[:-1] = space
        edge[-1] = True
        edge[tails] = True
        ends = np.flatnonzero(edge[1:] & ~space) + 1
        self.raw, self.offsets = raw, offsets
        self.data = raw[~space]
        self.at = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        self.first = np.searchsorted(starts, offsets)
        self.text = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))

    def __len__(self) -> int:
        return len(self.at) - 1

    def ids(self) -> tuple[np.ndarray, pa.Array]:
        """An exact number for each word's spelling, and the spellings."""
        if not len(self):
            return np.zeros(0, np.int64), pa.array([], pa.binary())
        spelled = pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(self.at), pa.py_buffer(self.data)])
        coded = spelled.dictionary_encode()
        return coded.indices.to_numpy().astype(np.int64), coded.dictionary

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word's bytes, the same in every batch."""
        n = len(self.data)
        terms = (self.data.astype(np.uint64) + np.uint64(1)) * _powers("up", _BASE, n)
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms)])
        a, b = self.at[:-1], self.at[1:]
        return mix((total[b] - total[a]) * _powers("down", _BASE_INVERSE, n)[a] + (b - a).astype(np.uint64))

    def joined(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space after each, and each word's offset in that."""
        n = len(self)
        at = self.at + np.arange(n + 1)
        out = np.full(at[-1], 32, np.uint8)
        keep = np.ones(at[-1], bool)
        keep[at[1:] - 1] = False
        out[keep] = self.data
        return out, at

    def lengths(self) -> np.ndarray:
        """Code points of each word."""
        points = np.concatenate([[0], np.cumsum((self.data & 0xC0) != 0x80)])
        return points[self.at[1:]] - points[self.at[:-1]]

    def per_text(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value of each word over each text."""
        total = np.concatenate([[0], np.cumsum(values)])
        return total[self.first[1:]] - total[self.first[:-1]]


def gather(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Copy many, maybe overlapping, ranges of ``data`` end to end; the offsets of each."""
    lengths = ends - starts
    at = np.concatenate([[0], np.cumsum(lengths)])
    kind = np.int32 if max(len(data), at[-1]) < 2**31 else np.int64
    index = np.repeat((starts - at[:-1]).astype(kind), lengths)
    index += np.arange(at[-1], dtype=kind)
    return data[index], at


def chain(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of ``k`` values."""
    n = max(len(hashes) - k + 1, 0)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[j : j + n]
    return mix(out)
