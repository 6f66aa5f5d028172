"""A block of token ids as a static range asymmetric numeral system (rANS), in numpy.

All blocks share one frequency table. Ids of a block are dealt to ``lanes`` in turn; every
lane has a state of 64 bits and all write 32-bit words to one stream. Coding goes
backwards over the steps, so that decoding reads forwards. Every ``STEPS`` steps a
checkpoint keeps the lanes' states and the place in the stream: segments between
checkpoints decode independently of each other. CRC-32 sums cover stream and ids.

Layout, little-endian::

    magic "RNS1" | lanes u32 | documents u32 | segments u32 | ids u64 | words u32
    | crc of all that follows u32 | crc of ids (as u32 each) u32
    document ids i64 each | null marks u8 each | ids of each document u32
    word position u32 of each segment | states u64, lanes of each segment | words u32
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

#: Frequencies add up to 2 ** SCALE.
SCALE = 20
#: Steps between checkpoints, and lanes of a large block.
STEPS, LANES = 256, 1024
_HEAD = struct.Struct("<4sIIIQIII")
_LOW = np.uint64(1 << 31)
_U = np.uint64


def quantized(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to ``2 ** SCALE``, at least 1 for every id of the
    vocabulary, so that the table also codes ids that were not counted."""
    size, whole = len(counts), 1 << SCALE
    if size > whole // 2:
        raise ValueError(f"a vocabulary of {size} ids needs a SCALE over {SCALE}")
    spare, total = whole - size, max(int(counts.sum()), 1)
    out = 1 + (counts.astype(np.float64) * (spare / total)).astype(np.int64)
    out[int(np.argmax(counts))] += whole - int(out.sum())
    return out


class Table:
    """Frequencies, where each id's range starts, and the id of every slot."""

    def __init__(self, frequency: np.ndarray) -> None:
        self.frequency = frequency.astype(np.uint64)
        self.start = (np.cumsum(frequency) - frequency).astype(np.uint64)
        self.slot = np.repeat(np.arange(len(frequency), dtype=np.uint32), frequency)


def _lanes(n: int) -> int:
    lanes = 1
    while lanes < LANES and lanes * 64 < n:
        lanes *= 2
    return lanes


def encode(ids: np.ndarray, table: Table, docs: list[int | None], sizes: list[int]) -> bytes:
    """The block of ``ids``, which are those of documents ``docs`` with ``sizes`` ids."""
    lanes = _lanes(len(ids))
    steps = -(-len(ids) // lanes)
    states = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
    kept: list[np.ndarray] = []
    frequency, start = table.frequency[ids], table.start[ids]
    for step in range(steps - 1, -1, -1):
        f = frequency[step * lanes : (step + 1) * lanes]
        c = start[step * lanes : (step + 1) * lanes]
        x = states[: len(f)]
        full = x >= (f << _U(63 - SCALE))
        words[step] = (x[full] & _U(0xFFFFFFFF)).astype(np.uint32)
        x = np.where(full, x >> _U(32), x)
        q = x // f
        states[: len(f)] = (q << _U(SCALE)) + (x - q * f) + c
        if step % STEPS == 0:
            kept.append(states.copy())
    kept.reverse()
    before = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.uint32)
    stream = np.concatenate(words) if words else np.empty(0, np.uint32)
    body = b"".join([
        np.array([0 if d is None else d for d in docs], "<i8").tobytes(),
        np.array([d is None for d in docs], "u1").tobytes(),
        np.array(sizes, "<u4").tobytes(),
        before[:steps:STEPS].astype("<u4").tobytes(),
        b"".join(k.astype("<u8").tobytes() for k in kept),
        stream.astype("<u4").tobytes(),
    ])
    return _HEAD.pack(
        b"RNS1", lanes, len(docs), len(kept), len(ids), len(stream), zlib.crc32(body),
        zlib.crc32(ids.astype("<u4").tobytes()),
    ) + body


def _segment(
    words: np.ndarray, at: int, states: np.ndarray, first: int, last: int, table: Table
) -> np.ndarray:
    """Ids at places ``first`` to ``last`` of a block, from a checkpoint at ``first``."""
    lanes, out, x = len(states), np.empty(last - first, np.uint32), states.copy()
    for place in range(0, last - first, lanes):
        n = min(lanes, last - first - place)
        low = x[:n] & _U((1 << SCALE) - 1)
        ids = table.slot[low.astype(np.int64)]
        out[place : place + n] = ids
        y = table.frequency[ids] * (x[:n] >> _U(SCALE)) + low - table.start[ids]
        short = y < _LOW
        n_short = int(np.count_nonzero(short))
        y[short] = (y[short] << _U(32)) | words[at : at + n_short]
        at += n_short
        x[:n] = y
    return out


def decode(
    block: bytes, table: Table, segments: range | None = None
) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """Documents, their sizes, and the ids of the block or of some of its segments. Raises
    if a sum does not hold."""
    magic, lanes, n_docs, n_segments, n_ids, n_words, crc, crc_ids = _HEAD.unpack_from(block)
    body = memoryview(block)[_HEAD.size :]
    if magic != b"RNS1" or zlib.crc32(body) != crc:
        raise ValueError("not a block of token ids, or a damaged one")
    at = 0

    def take(kind: str, n: int) -> np.ndarray:
        nonlocal at
        out = np.frombuffer(body, kind, n, at)
        at += out.nbytes
        return out

    numbers, null, sizes = take("<i8", n_docs), take("u1", n_docs), take("<u4", n_docs)
    places, states = take("<u4", n_segments), take("<u8", n_segments * lanes)
    words = take("<u4", n_words).astype(np.uint64)
    per = STEPS * lanes
    chosen = range(n_segments) if segments is None else segments
    found = [
        _segment(words, int(places[k]), states[k * lanes : (k + 1) * lanes].astype(np.uint64),
                 k * per, min((k + 1) * per, n_ids), table)
        for k in chosen
    ]
    ids = np.concatenate(found) if found else np.empty(0, np.uint32)
    if segments is None and zlib.crc32(ids.astype("<u4").tobytes()) != crc_ids:
        raise ValueError("a block of token ids decodes to other ids")
    return [None if z else int(d) for d, z in zip(numbers, null)], sizes.astype(np.int64), ids
