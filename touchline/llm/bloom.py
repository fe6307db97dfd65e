"""Bloom filters that Spark builds by segments, and joins they spare."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stash

#: A hash's lowest bits choose one of 2 to the power of SEGMENT_BITS segments; HASHES probes each.
SEGMENT_BITS, HASHES = 10, 3
#: Bits a hash, and the largest filter that is broadcast, as powers of two: 2^30 bits are 128 MB, for 67 million hashes.
PER_HASH, LARGEST = 4, 30
#: Rows (a long each) up to which Spark broadcasts a set of ids, about 40 MB of the driver with overhead.
BROADCAST_IDS = 250_000


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """HASHES bit positions of each hash in a segment of 2 to the power of ``bits`` bits."""
    a, b = h >> np.uint64(SEGMENT_BITS), (h * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(31)) | np.uint64(1)
    return ((a[:, None] + np.arange(HASHES, dtype=np.uint64) * b[:, None]) & np.uint64((1 << bits) - 1)).astype(np.int64)


def put(bits: np.ndarray, where: np.ndarray) -> None:
    np.bitwise_or.at(bits, where >> 3, (1 << (where & 7)).astype(np.uint8))


def has(bits: np.ndarray, where: np.ndarray) -> np.ndarray:
    return (bits[where >> 3] >> (where & 7).astype(np.uint8) & 1).astype(bool)


def segment_of(h: np.ndarray) -> np.ndarray:
    return (h & np.uint64((1 << SEGMENT_BITS) - 1)).astype(np.int64)


class Growing:
    """A Bloom filter for a number of hashes that isn't known before: when an
    array is full, one of twice the size is added."""

    def __init__(self, least: int = 10):
        self.arrays: list[tuple[np.ndarray, int]] = []
        self.room, self.bits = 0, least - 1

    def has(self, h: np.ndarray) -> np.ndarray:
        out = np.zeros(len(h), bool)
        for array, bits in self.arrays:
            out |= has(array, places(h, bits)).all(1)
        return out

    def add(self, h: np.ndarray) -> None:
        if self.room < len(h):
            self.bits = max(self.bits + 1, len(h).bit_length() + PER_HASH)
            self.arrays.append((np.zeros(1 << self.bits - 3, np.uint8), self.bits))
            self.room = 1 << self.bits - PER_HASH
        put(self.arrays[-1][0], places(h, self.arrays[-1][1]).ravel())
        self.room -= len(h)


def by_segment(h: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """The hashes of each segment, in the order they come."""
    if not len(h):
        return
    segment = segment_of(h)
    order = np.argsort(segment, kind="stable")
    found, start = np.unique(segment[order], return_index=True)
    for k, part in zip(found.tolist(), np.split(h[order], start[1:]), strict=True):
        yield k, part


def within(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes a filter over all segments (a row of bytes each) may hold."""
    where = places(h, filter_.shape[1].bit_length() + 2)
    return (filter_[segment_of(h)[:, None], where >> 3] >> (where & 7).astype(np.uint8) & 1).astype(bool).all(1)


def filter_of(segments: DataFrame, n: int, largest: int = LARGEST) -> np.ndarray:
    """The filter of all hashes in ``segments`` (segment, hashes: packed 64-bit
    numbers), a plain array to broadcast, sized by their number ``n`` up to 2 to
    the power of ``largest`` bits, which bounds what the driver gets.  More hashes fill it up: it then
    says yes more often, never no to a hash it was given."""
    bits = min(largest, max(SEGMENT_BITS + 6, n.bit_length() + PER_HASH))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                array = np.zeros(1 << bits - SEGMENT_BITS - 3, np.uint8)
                put(array, places(np.frombuffer(packed.as_py(), np.uint64), bits - SEGMENT_BITS).ravel())
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([array.tobytes()], pa.binary())], names=["segment", "bits"])

    out = np.zeros((1 << SEGMENT_BITS, 1 << bits - SEGMENT_BITS - 3), np.uint8)
    for row in segments.select("segment", "hashes").mapInArrow(build, "segment int, bits binary").collect():
        out[row["segment"]] |= np.frombuffer(row["bits"], np.uint8)
    return out


def mix(ids: np.ndarray) -> np.ndarray:
    """64-bit hashes of integers (a bijection, so different ids differ)."""
    h = ids.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(29))


def split_by_ids(docs: DataFrame, ids: DataFrame, n: int, id_col: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Rows of ``docs`` that may have one of the ``n`` ids in ``ids`` (id), and
    those that certainly have none, by a broadcast filter over the ids."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for segment, h in by_segment(mix(batch.column(0).to_numpy(zero_copy_only=False))):
                yield pa.RecordBatch.from_arrays([pa.array([segment], pa.int32()), pa.array([h.tobytes()], pa.binary())], names=["segment", "hashes"])

    bounded_batches(docs.sparkSession)
    made = docs.sparkSession.sparkContext.broadcast(filter_of(ids.mapInArrow(pack, "segment int, hashes binary"), n))
    at = docs.columns.index(id_col)

    def part(wanted: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = batch.column(at)
                maybe = within(made.value, mix(own.fill_null(0).to_numpy(zero_copy_only=False))) & own.is_valid().to_numpy(zero_copy_only=False)
                yield batch.filter(pa.array(maybe == wanted))

        return docs.mapInArrow(run, docs.schema)

    return part(True), part(False)


def without(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id", most: int = BROADCAST_IDS) -> DataFrame:
    """Rows of ``docs`` whose integer id is not in ``ids`` (id: distinct longs);
    rows with a null id stay.

    Texts are not shuffled: while the ids are few they are broadcast, and beyond
    that only rows that pass a filter over the ids join them.
    """
    ids = stash(ids.where("id is not null"))
    n = ids.count()
    if n <= most:
        return docs.join(F.broadcast(ids), docs[id_col] == ids["id"], "left_anti")
    maybe, clear = split_by_ids(docs, ids, n, id_col)
    return clear.union(maybe.join(ids, maybe[id_col] == ids["id"], "left_anti"))
