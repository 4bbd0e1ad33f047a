"""Two Bloom filters over 64-bit hashes: met once, and met twice or more.

Each task fills both filters from the rows that it reads.  Tasks send on only the blocks in which they set a bit,
compressed, so what is shuffled follows the number of hashes.  Filters merge block by block: a bit that two tasks set
in their first filters counts as met twice.  The second filter thus never misses a hash that was met twice, and what
it holds besides is a small share, as long as there are some 16 bits a hash.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PROBES = 4
#: Rows whose hashes are held at once.
ROWS = 1_000
BLOCK = 1 << 16
#: The largest filter: 32 MB.  With more than some 16 million different hashes more of them pass by chance, so more
#: rows go on to the exact step; none is lost.
MOST_BITS = 1 << 28


def filter_bits(n_hashes: int, per_hash: int = 16) -> int:
    """A power of two, at least one block and at most MOST_BITS."""
    return min(MOST_BITS, max(BLOCK * 8, 1 << max(0, n_hashes * per_hash - 1).bit_length()))


def positions(h: np.ndarray, bits: int) -> list[np.ndarray]:
    step = (h >> np.uint64(32)) | np.uint64(1)
    return [((h + np.uint64(i) * step) & np.uint64(bits - 1)).astype(np.int64) for i in range(PROBES)]


def contains(bitmap: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    found = np.ones(len(h), bool)
    for p in positions(h, bits):
        found &= (bitmap[p >> 3] >> (p & 7).astype(np.uint8)) & 1 > 0
    return found


def parts(batches):
    """Batches in slices of few rows, so that what a task holds at once stays small."""
    for batch in batches:
        for i in range(0, batch.num_rows, ROWS):
            yield batch.slice(i, ROWS)


def _insert(bitmap: np.ndarray, h: np.ndarray, bits: int) -> None:
    for p in positions(h, bits):
        np.bitwise_or.at(bitmap, p >> 3, np.left_shift(np.uint8(1), (p & 7).astype(np.uint8)))


def _blocks(once: np.ndarray, twice: np.ndarray):
    rows = [(k, zlib.compress(a, 1), zlib.compress(b, 1)) for k, (a, b) in enumerate(zip(once.reshape(-1, BLOCK), twice.reshape(-1, BLOCK), strict=True)) if a.any() or b.any()]
    for i in range(0, len(rows), 64):
        part = list(zip(*rows[i : i + 64], strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.binary()), pa.array(part[2], pa.binary())], ["block", "once", "twice"])


def members(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of a column of 64-bit hashes."""

    def fill(batches):
        held = np.zeros(bits >> 3, np.uint8)
        for batch in batches:
            _insert(held, batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)
        for k, part in enumerate(held.reshape(-1, BLOCK)):
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())], ["block", "held"])

    def merge(batches):
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            for k, part in zip(*(batch.column(i).to_pylist() for i in range(2)), strict=True):
                part = np.frombuffer(zlib.decompress(part), np.uint8)
                have[k] = have[k] | part if k in have else part
        yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.int32()), pa.array([x.tobytes() for x in have.values()], pa.binary())], ["block", "held"])

    filled = hashes.mapInArrow(fill, "block int, held binary").repartition("block").mapInArrow(merge, "block int, held binary")
    out = np.zeros(bits >> 3, np.uint8)
    for row in filled.collect():  # MOST_BITS bounds what arrives
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(row.held, np.uint8)
    return out


#: Cells of a sketch, at most: 16 MB while it is filled, 4 MB once told.
MOST_CELLS = 1 << 22


def sketch_cells(n_hashes: int) -> int:
    return min(MOST_CELLS, max(BLOCK, 1 << max(0, n_hashes // 4).bit_length()))


#: Hashes of a shard of exact counts, about, and those that a task sorts at once.
SHARD_HASHES, SORTED = 1 << 20, 1 << 20


class Recurring:
    """Which of very many hashes recur, and how often, from exact counts.

    Hashes are cut to their first ``width`` bits, 8 more than tell their number, so one in some 256 is taken for
    another.  Tasks send them sorted, as differences (some 2 bytes a hash), to shards by their first bits; a shard
    counts its own.  A filter then holds those that recur, and no others, and a sketch the largest count of a cell.
    Each shard fills its own slice of both.
    """

    def __init__(self, n_hashes: int, per_hash: int):
        self.bits, self.cells = filter_bits(n_hashes, per_hash), sketch_cells(n_hashes)
        self.log_shards = max(0, n_hashes - 1).bit_length() - SHARD_HASHES.bit_length() + 1
        self.log_shards = min(max(0, self.log_shards), self.cells.bit_length() - 1)
        self.width = min(64, max(n_hashes.bit_length() + 8, self.log_shards + 16))

    def cut(self, h: np.ndarray) -> np.ndarray:
        return h >> np.uint64(64 - self.width)

    def shard(self, t: np.ndarray) -> np.ndarray:
        return (t >> np.uint64(self.width - self.log_shards)).astype(np.int64)

    def _places(self, t: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Two bits of the filter and the cell of each cut hash."""
        with np.errstate(over="ignore"):
            m = t * np.uint64(0x9E3779B97F4A7C15)
            m = (m ^ (m >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        m, shard = m ^ (m >> np.uint64(29)), self.shard(t)
        bits, cells = self.bits >> self.log_shards, self.cells >> self.log_shards
        at = [shard * bits + (x & np.uint64(bits - 1)).astype(np.int64) for x in (m, m >> np.uint64(32))]
        return at, shard * cells + (m >> np.uint64(16) & np.uint64(cells - 1)).astype(np.int64)

    def find(self, bitmap: np.ndarray, sketch: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Whether each hash recurs, and its cell's count, as four times a logarithm."""
        (a, b), cell = self._places(self.cut(h))
        return ((bitmap[a >> 3] >> (a & 7).astype(np.uint8)) & (bitmap[b >> 3] >> (b & 7).astype(np.uint8)) & 1) > 0, sketch[cell]

    def count(self, rows: DataFrame, hashes) -> tuple[np.ndarray, np.ndarray]:
        """(bitmap, sketch); ``hashes`` gives, for an Arrow value, the hashes of which each occurrence counts."""

        def send(batches):
            held, size = [], 0

            def sent():
                t, n = np.unique(self.cut(np.concatenate(held)), return_counts=True)
                shards, first = np.unique(self.shard(t), return_index=True)
                ends = [*first[1:].tolist(), len(t)]
                blobs = [_squeezed(t[i:j]) for i, j in zip(first.tolist(), ends, strict=True)]
                counts = [zlib.compress(np.minimum(n[i:j], 255).astype(np.uint8).tobytes(), 1) for i, j in zip(first.tolist(), ends, strict=True)]
                return pa.RecordBatch.from_arrays([pa.array(shards, pa.int32()), pa.array(blobs, pa.binary()), pa.array(counts, pa.binary())], ["shard", "cut", "n"])

            for batch in batches:
                for value in batch.column(0):
                    held.append(hashes(value))
                    size += len(held[-1])
                    if size >= SORTED:
                        yield sent()
                        held, size = [], 0
            if size:
                yield sent()

        def counted(table: pa.Table) -> pa.Table:
            shard = table.column("shard")[0].as_py()
            t = np.concatenate([_unsqueezed(x.as_py()) for x in table.column("cut")])
            n = np.concatenate([np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in table.column("n")])
            order = np.argsort(t, kind="stable")
            t, n = t[order], n[order].astype(np.int64)
            first = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            t, n = t[first], np.add.reduceat(n, first)
            t, n = t[n > 1], n[n > 1]
            places, cell = self._places(t)
            bits, cells = self.bits >> self.log_shards, self.cells >> self.log_shards
            marks, most = np.zeros(bits, np.uint8), np.zeros(cells, np.uint8)
            for at in places:
                marks[at - shard * bits] = 1
            np.maximum.at(most, cell - shard * cells, np.minimum(4 * np.log2(n), 255).astype(np.uint8))
            return pa.table({"shard": pa.array([shard], pa.int32()), "bits": pa.array([np.packbits(marks, bitorder="little").tobytes()], pa.binary()), "most": pa.array([most.tobytes()], pa.binary())})

        sent = rows.mapInArrow(send, "shard int, cut binary, n binary")
        bitmap, sketch = np.zeros(self.bits >> 3, np.uint8), np.zeros(self.cells, np.uint8)
        for row in sent.groupBy("shard").applyInArrow(counted, "shard int, bits binary, most binary").collect():  # MOST_BITS and MOST_CELLS bound it
            for out, part in ((bitmap, row.bits), (sketch, row.most)):
                out[row.shard * len(part) : (row.shard + 1) * len(part)] = np.frombuffer(part, np.uint8)
        return bitmap, sketch


def _squeezed(t: np.ndarray) -> bytes:
    """Ascending numbers as differences, byte by byte of all: the low bytes are noise, the high ones nearly all zero."""
    return zlib.compress(np.ascontiguousarray(np.diff(t, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T).tobytes(), 1)


def _unsqueezed(blob: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(zlib.decompress(blob), np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def repeats(rows: DataFrame, hashes, bits: int, at_once: int | None = None) -> np.ndarray:
    """The bitmap of hashes met twice or more.

    ``hashes`` gives, for an Arrow batch, a uint64 array in which each occurrence that counts is one entry; they are
    taken ``at_once`` at a time where it is given, in less memory.
    """

    def fill(batches):
        once, twice = np.zeros(bits >> 3, np.uint8), np.zeros(bits >> 3, np.uint8)
        for batch in parts(batches):
            met = hashes(batch)
            for i in range(0, len(met), at_once or max(1, len(met))):
                h, n = np.unique(met[i : i + at_once] if at_once else met, return_counts=True)
                again = (n > 1) | contains(once, h, bits)
                _insert(twice, h[again], bits)
                _insert(once, h[~again | (n > 1)], bits)
        yield from _blocks(once, twice)

    def merge(batches):
        have: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for k, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                a, b = np.frombuffer(zlib.decompress(a), np.uint8), np.frombuffer(zlib.decompress(b), np.uint8)
                if k in have:
                    have[k] = [have[k][0] | a, have[k][1] | b | (have[k][0] & a)]
                else:
                    have[k] = [a, b]
        rows = [(k, b.tobytes()) for k, (_, b) in have.items()]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.binary())], ["block", "twice"])

    filled = rows.mapInArrow(fill, "block int, once binary, twice binary").repartition("block").mapInArrow(merge, "block int, twice binary")
    out = np.zeros(bits >> 3, np.uint8)
    for row in filled.collect():  # MOST_BITS bounds what arrives; an iterator would merge one partition at a time
        out[row.block * BLOCK : (row.block + 1) * BLOCK] = np.frombuffer(row.twice, np.uint8)
    return out
