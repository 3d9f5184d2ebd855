"""Static range asymmetric numeral systems over interleaved lanes, in whole-array steps.

Token i of a block belongs to lane i mod ``lanes``; all lanes share one stream of 32-bit words
and one frequency table. Every ``interval`` steps the lanes' states and the place in the stream
are kept as a checkpoint, from which decoding can start. A block carries the checksum of its
content and of its table.

Layout, little-endian: the header's fields in the order of ``HEADER``, then per checkpoint the
stream's place (u32) and the lanes' states (u64 each), then the words (u32 each).
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

# The mark and version of a block.
MAGIC, VERSION = b"TMRA", 1
PRECISION = 20
LOWEST = np.uint64(1 << 31)
WORD = np.uint64(32)
# mark, version, lanes, interval, tokens, words, checkpoints, table's checksum, content's checksum
HEADER = "<4sHHIQIIII"
HEADER_SIZE = struct.calcsize(HEADER)


class Table:
    """Frequencies that add up to 2^PRECISION; every token that was counted has at least one."""

    def __init__(self, frequencies: np.ndarray):
        self.frequencies = np.asarray(frequencies, np.uint64)
        self.starts = np.concatenate([[0], np.cumsum(self.frequencies)])[:-1].astype(np.uint64)
        self.tokens = np.repeat(np.arange(len(self.frequencies), dtype=np.uint32), self.frequencies.astype(np.int64))
        self.checksum = zlib.crc32(self.frequencies.astype("<u4").tobytes())


def frequencies(counts: np.ndarray) -> np.ndarray:
    """Counts by token scaled to the table's sum."""
    counts = np.asarray(counts, np.int64)
    seen = int((counts > 0).sum())
    if not seen:
        return np.zeros(len(counts), np.int64)
    if seen > 1 << PRECISION:
        raise ValueError("more tokens than the table has room for")
    spare = (1 << PRECISION) - seen
    scaled = np.array([1 + c * spare // total if c else 0 for total in [int(counts.sum())] for c in counts.tolist()])
    scaled[int(counts.argmax())] += (1 << PRECISION) - int(scaled.sum())
    return scaled


def encode(tokens: np.ndarray, table: Table, lanes: int = 512, interval: int = 256) -> bytes:
    n = len(tokens)
    f_all, c_all = table.frequencies[tokens], table.starts[tokens]
    if n and not f_all.all():
        raise ValueError("a token that the table does not have")
    states = np.full(lanes, LOWEST)
    steps = -(-n // lanes)
    words: list[np.ndarray] = [np.empty(0, np.uint32)] * steps
    marks: dict[int, np.ndarray] = {}
    shift, limit = np.uint64(PRECISION), np.uint64(31 - PRECISION + 32)
    for t in range(steps - 1, -1, -1):
        f, c = f_all[t * lanes : (t + 1) * lanes], c_all[t * lanes : (t + 1) * lanes]
        x = states[: len(f)]
        full = x >= (f << limit)
        if full.any():
            words[t] = x[full].astype(np.uint32)
            x = np.where(full, x >> WORD, x)
        whole, rest = np.divmod(x, f)
        states[: len(f)] = (whole << shift) + rest + c
        if t % interval == 0:
            marks[t] = states.copy()
    places = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
    kept = b"".join(
        struct.pack("<I", int(places[t])) + marks[t].astype("<u8").tobytes() for t in range(0, steps, interval)
    )
    body = kept + (np.concatenate(words).astype("<u4").tobytes() if steps else b"")
    count = -(-steps // interval)
    head = struct.pack(
        HEADER, MAGIC, VERSION, lanes, interval, n, int(places[-1]), count, table.checksum, zlib.crc32(body)
    )
    return head + body


def decode(block: bytes, table: Table, first: int = 0, last: int | None = None) -> np.ndarray:
    """The tokens from checkpoint ``first`` up to checkpoint ``last`` (the end)."""
    mark, version, lanes, interval, n, n_words, count, of_table, of_body = struct.unpack_from(HEADER, block)
    body = memoryview(block)[HEADER_SIZE:]
    if mark != MAGIC or version != VERSION:
        raise ValueError("not a token block of this version")
    if of_table != table.checksum or of_body != zlib.crc32(body):
        raise ValueError("a checksum of the token block does not hold")
    if not n:
        return np.empty(0, np.uint32)
    size = 4 + 8 * lanes
    words = np.frombuffer(body, "<u4", n_words, size * count)
    (place,) = struct.unpack_from("<I", body, size * first)
    states = np.frombuffer(body, "<u8", lanes, size * first + 4).astype(np.uint64)
    low, high = first * interval * lanes, n if last is None else min(n, last * interval * lanes)
    out = np.empty(high - low, np.uint32)
    shift, mask = np.uint64(PRECISION), np.uint64((1 << PRECISION) - 1)
    for start in range(low, high, lanes):
        end = min(n, start + lanes)
        x = states[: end - start]
        slot = x & mask
        token = table.tokens[slot]
        out[start - low : end - low] = token
        x = table.frequencies[token] * (x >> shift) + slot - table.starts[token]
        short = np.flatnonzero(x < LOWEST)
        x[short] = (x[short] << WORD) | words[place : place + len(short)]
        place += len(short)
        states[: end - start] = x
    return out
