"""Static range asymmetric numeral system over token ids, many lanes at a time, in numpy.

A segment is one array of ids in bytes: a header, one frequency table that all blocks
share, and blocks that can be decoded apart from each other. Within a block the ids are
dealt round-robin to ``LANES`` states, so that a step codes ``LANES`` ids at once. The
directory in the header holds for each block its size, its place and its checksum; a
block begins with checkpoints, each the state of all lanes before some step and the
place of the next word to read there, so that a block too can be decoded from several
places. A decoder refuses a block whose bytes or ids do not have their checksum.

    segment   magic, version, counts, table (zlib of id gaps and frequencies), directory,
              blocks
    block     checkpoints, words of 32 bits; all numbers are little-endian
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

MAGIC = b"TRNS"
VERSION = 1
#: Frequencies of a table add up to this power of two.
SCALE_BITS = 20
LOW = np.uint64(1 << 31)
WORD = np.uint64(32)
LANES = 2048
BLOCK_TOKENS = 1 << 19
#: Steps between checkpoints of a block.
CHECKPOINT_STEPS = 128
_HEADER = struct.Struct("<4sBBHIQII")
_ENTRY = struct.Struct("<IQIII")


class CorruptSegment(ValueError):
    """The bytes are not a segment, or are not those that were written."""


def quantised(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to the scale, none of them below one.

    Rounded down first; what is over or missing then falls on the most frequent ids.
    """
    scale = 1 << SCALE_BITS
    if len(counts) > scale:
        raise ValueError("more different ids than the scale has room for")
    freq = np.maximum(1, counts * scale // counts.sum()).astype(np.int64)
    off = scale - int(freq.sum())
    order = np.argsort(-freq, kind="stable")
    if off >= 0:
        freq[order[0]] += off
    else:
        spare = np.cumsum(freq[order] - 1)
        whole = int(np.searchsorted(spare, -off))
        taken = -off - (int(spare[whole - 1]) if whole else 0)
        freq[order[:whole]] = 1
        freq[order[whole]] -= taken
    return freq


def _encode_block(ranks: np.ndarray, freq: np.ndarray, start: np.ndarray) -> bytes:
    scale, shift = np.uint64(SCALE_BITS), np.uint64(63 - SCALE_BITS)
    state = np.full(LANES, LOW, np.uint64)
    steps = -(-len(ranks) // LANES)
    words: list[np.ndarray] = []
    marks: list[tuple[int, int, np.ndarray]] = []
    written = 0
    for step in range(steps - 1, -1, -1):
        now = ranks[step * LANES : (step + 1) * LANES]
        f, x = freq[now], state[: len(now)]
        full = x >= (f << shift)
        if full.any():
            out = x[full]
            words.append(out.astype(np.uint32))
            written += len(out)
            x = np.where(full, x >> WORD, x)
        quotient = x // f
        state[: len(now)] = (quotient << scale) + (x - quotient * f) + start[now]
        if step % CHECKPOINT_STEPS == 0:
            marks.append((step, written, state.copy()))
    head = [struct.pack("<I", len(marks))]
    for step, before, saved in reversed(marks):
        head += [struct.pack("<II", step, written - before), saved.astype("<u8").tobytes()]
    stream = np.concatenate(words[::-1]) if words else np.zeros(0, np.uint32)
    return b"".join([*head, stream.astype("<u4").tobytes()])


def encode_segment(ids: np.ndarray, block_tokens: int = BLOCK_TOKENS) -> bytes:
    """The ids as one segment; no ids give a segment without blocks."""
    ids = np.ascontiguousarray(ids, np.uint32)
    # Counting by value is much cheaper than sorting, but only for small ids.
    if len(ids) and int(ids.max()) < (1 << 22):
        tally = np.bincount(ids)
        known = np.flatnonzero(tally)
        counts, ranked = tally[known], np.zeros(len(tally), np.intp)
        ranked[known] = np.arange(len(known))
        ranks = ranked[ids]
    else:
        known, ranks, counts = np.unique(ids, return_inverse=True, return_counts=True)
    freq = quantised(counts.astype(np.int64)) if len(known) else np.zeros(0, np.int64)
    start = np.cumsum(freq) - freq
    table = zlib.compress(
        np.diff(known, prepend=0).astype("<u4").tobytes() + freq.astype("<u4").tobytes(), 6
    )
    blocks, directory, at = [], [], 0
    wide, first = freq.astype(np.uint64), start.astype(np.uint64)
    for low in range(0, len(ids), block_tokens):
        part = ids[low : low + block_tokens]
        block = _encode_block(ranks[low : low + block_tokens], wide, first)
        directory.append(
            _ENTRY.pack(len(part), at, len(block), zlib.crc32(block), zlib.crc32(part.astype("<u4").tobytes()))
        )
        blocks.append(block)
        at += len(block)
    head = _HEADER.pack(
        MAGIC, VERSION, SCALE_BITS, LANES, len(known), len(ids), len(table), len(blocks)
    )
    index = b"".join(directory)
    return b"".join([head, table, index, struct.pack("<I", zlib.crc32(head + table + index)), *blocks])


class Segment:
    """A segment opened for decoding; its blocks may be decoded in any order."""

    def __init__(self, data: bytes) -> None:
        try:
            magic, version, bits, lanes, known, self.n_ids, size, blocks = _HEADER.unpack_from(data)
        except struct.error as short:
            raise CorruptSegment("too short") from short
        if (magic, version, bits, lanes) != (MAGIC, VERSION, SCALE_BITS, LANES):
            raise CorruptSegment("not a segment of this format")
        index = _HEADER.size + size
        self.base = index + blocks * _ENTRY.size + 4
        if self.base > len(data) or struct.unpack_from("<I", data, self.base - 4)[0] != zlib.crc32(
            data[: self.base - 4]
        ):
            raise CorruptSegment("header")
        table = np.frombuffer(zlib.decompress(data[_HEADER.size : index]), "<u4")
        self.ids = np.cumsum(table[:known], dtype=np.int64).astype(np.uint32)
        freq = table[known:].astype(np.int64)
        self.rank_at = np.repeat(np.arange(known, dtype=np.int32), freq)
        self.freq = freq.astype(np.uint64)
        self.start = (np.cumsum(freq) - freq).astype(np.uint64)
        self.directory = [_ENTRY.unpack_from(data, index + i * _ENTRY.size) for i in range(blocks)]
        self.data = data

    def block(self, number: int) -> np.ndarray:
        """Ids of one block, checked."""
        n, at, size, of_bytes, of_ids = self.directory[number]
        data = self.data[self.base + at : self.base + at + size]
        if len(data) != size or zlib.crc32(data) != of_bytes:
            raise CorruptSegment(f"bytes of block {number}")
        marks = struct.unpack_from("<I", data)[0]
        width = 8 + 8 * LANES
        words = np.frombuffer(data, "<u4", offset=4 + marks * width)
        steps = -(-n // LANES)
        ranks = np.zeros(n, np.int32)
        begins = [struct.unpack_from("<II", data, 4 + i * width) for i in range(marks)]
        for i, (step, word) in enumerate(begins):
            state = np.frombuffer(data, "<u8", LANES, 4 + i * width + 8).astype(np.uint64)
            until = begins[i + 1][0] if i + 1 < marks else steps
            self._steps(ranks, step, until, state, words, word)
        ids = self.ids[ranks]
        if zlib.crc32(ids.astype("<u4").tobytes()) != of_ids:
            raise CorruptSegment(f"ids of block {number}")
        return ids

    def _steps(
        self,
        ranks: np.ndarray,
        step: int,
        until: int,
        state: np.ndarray,
        words: np.ndarray,
        word: int,
    ) -> None:
        scale, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
        for now in range(step, until):
            out = ranks[now * LANES : (now + 1) * LANES]
            x = state[: len(out)]
            slot = x & mask
            rank = self.rank_at[slot]
            out[:] = rank
            x = self.freq[rank] * (x >> scale) + slot - self.start[rank]
            need = np.flatnonzero(x < LOW)
            if len(need):
                x[need] = (x[need] << WORD) | words[word : word + len(need)]
                word += len(need)
            state[: len(out)] = x

    def all(self) -> np.ndarray:
        parts = [self.block(i) for i in range(len(self.directory))]
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)
