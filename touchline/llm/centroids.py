"""Operator 11: centroid clustering in exact integers by bit-plane popcounts."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, release, stash

#: Components of a vector: one bit plane of all of them fills a 64-bit number.
WIDTH = 64
#: Bits of the largest component: 64 squares of differences of such ones stay below 2^63.
MOST_BITS = 27
OUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def bits_of(x: np.ndarray) -> int:
    """Planes that integers need in two's complement."""
    return max(int(x.max(initial=0)), -1 - int(x.min(initial=0))).bit_length() + 1


def planes_of(x: np.ndarray, bits: int) -> np.ndarray:
    """rows x bits: bit j of all 64 components of a row in one number."""
    on = (x[:, None, :] >> np.arange(bits)[None, :, None] & 1).astype(np.uint8)
    return np.packbits(on, axis=2, bitorder="little").view(np.uint64)[:, :, 0]


def unpacked(planes: np.ndarray) -> np.ndarray:
    """The components (rows x 64) of planes."""
    on = np.unpackbits(planes[:, :, None].view(np.uint8), axis=2, bitorder="little")
    return np.tensordot(weights(planes.shape[1]), on, axes=(0, 1)) if len(planes) else np.zeros((0, WIDTH), np.int64)


def weights(bits: int) -> np.ndarray:
    """What a set bit of each plane counts: the top one is the sign."""
    w = np.left_shift(1, np.arange(bits, dtype=np.int64))
    w[-1] = -w[-1]
    return w


def dots(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """rows x centroids: exact inner products of vectors and centroids, both as
    planes, by counting the bits that a plane of either have in common."""
    out = np.zeros((len(x), len(c)), np.int64)
    for k, wk in enumerate(weights(c.shape[1])):
        part = np.zeros((len(x), len(c)), np.int64)
        for j, wj in enumerate(weights(x.shape[1])):
            part += wj * np.bitwise_count(x[:, j, None] & c[None, :, k]).astype(np.int64)
        out += wk * part
    return out


def squares(x: np.ndarray) -> np.ndarray:
    """The squared length of each row, by popcounts of its own planes."""
    w, out = weights(x.shape[1]), np.zeros(len(x), np.int64)
    for j in range(len(w)):
        for k in range(len(w)):
            out += w[j] * w[k] * np.bitwise_count(x[:, j] & x[:, k]).astype(np.int64)
    return out


class Centroids:
    """Integer vectors in order, packed once for all rows of a task."""

    def __init__(self, vectors: list[list[int]]):
        self.vectors = np.array(vectors, np.int64).reshape(-1, WIDTH)
        self.planes = planes_of(self.vectors, bits_of(self.vectors))
        self.squares = squares(self.planes)

    def nearest(self, x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and squared distance of each row's centroid; the smaller number wins ties."""
        d = own[:, None] + self.squares[None, :] - 2 * dots(x, self.planes)
        best = d.argmin(1)
        return best, d[np.arange(len(x)), best]


def blocks(batch: pa.RecordBatch, rows: int = 2048) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Row numbers, planes and squared lengths of a batch (planes, square, ...), by number of planes."""
    column = batch.column(0)
    length = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    square = batch.column(1).to_numpy(zero_copy_only=False)
    for n in np.unique(length):
        at = np.nonzero(length == n)[0]
        for part in np.split(at, range(rows, len(at), rows)):
            packed = b"".join(column.take(pa.array(part)).to_pylist())
            yield part, np.frombuffer(packed, np.uint64).reshape(len(part), n // 8), square[part]


def packed(vectors: DataFrame, scale: int, id_col: str, vector_col: str) -> DataFrame:
    """planes (a 64-bit number a plane), square and vec_id of the vectors that take part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(scale * batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, WIDTH))
            if np.abs(x).max(initial=0) >= 1 << MOST_BITS:
                raise ValueError(f"a component of {MOST_BITS} bits or more: distances would not fit into 64 bits")
            planes = planes_of(x.astype(np.int64), bits_of(x.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array([p.tobytes() for p in planes], pa.binary()), pa.array(squares(planes), pa.int64()), batch.column(0)], names=["planes", "square", "vec_id"])

    bounded_batches(vectors.sparkSession)
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"))
    sound = (F.size("v") == WIDTH) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return own.where(F.col("v").isNotNull() & sound).mapInArrow(run, "planes binary, square long, vec_id long")


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, scale: int = 256, seed: str = "2:", id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of
    every vector of exactly 64 finite components, taken as floor(scale * x).

    Centroids start as the ``k`` vectors with the smallest SHA-256 of ``seed``
    and id (fewer vectors: all of them); a round assigns every vector to the
    nearest centroid and moves every centroid that has vectors to the floor of
    their mean; after the rounds vectors are assigned once more.

    All arithmetic is in integers, so results don't depend on how rows are dealt
    out.  Each vector is packed once, plane by plane, and written; rounds read
    the planes.  A task adds up its vectors by cluster and only those sums, k x
    64 numbers a task, are shuffled; k x 64 numbers reach the driver and go out
    again, whatever the number of vectors, or how many lie in one cluster.

    Null vectors, those of another length and those with a null or non-finite
    component are left out.  Ties take the smaller number.  Repeated rows count
    each.  A null vec_id is hashed as an empty one; of equal hashes the one with
    the smaller planes comes first.  No vectors give an empty result; other
    columns are ignored.  A component of 2^27 or more after scaling is an error,
    as distances would not fit into a long.
    """
    spark = vectors.sparkSession
    own = stash(packed(vectors, scale, id_col, vector_col))
    first = own.select("planes", F.sha2(F.concat(F.lit(seed), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256).alias("hash")).orderBy("hash", "planes").limit(k).collect()
    now = [unpacked(np.frombuffer(r["planes"], np.uint64)[None, :])[0].tolist() for r in first]

    def sums(found):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = Centroids(found.value)
            n = len(held.vectors)
            total, count = np.zeros((n, WIDTH), np.int64), np.zeros(n, np.int64)
            for batch in batches:
                for _, x, square in blocks(batch):
                    best, _ = held.nearest(x, square)
                    order = np.argsort(best, kind="stable")
                    which, start = np.unique(best[order], return_index=True)
                    total[which] += np.add.reduceat(unpacked(x)[order], start, axis=0)
                    count += np.bincount(best, minlength=n)
            at = np.nonzero(count)[0]
            names = ["cluster", "at", "total", "n"]
            columns = [np.repeat(at, WIDTH), np.tile(np.arange(WIDTH), len(at)), total[at].ravel(), np.repeat(count[at], WIDTH)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

        return run

    for _ in range(rounds if now else 0):
        sent = spark.sparkContext.broadcast(now)
        made = own.select("planes", "square").mapInArrow(sums(sent), "cluster long, at long, total long, n long").groupBy("cluster", "at").agg(F.sum("total").alias("total"), F.sum("n").alias("n"))
        for r in made.collect():  # 64 rows a centroid
            now[r["cluster"]][r["at"]] = r["total"] // r["n"]
        sent.unpersist()
    if not now:
        return spark.createDataFrame([], OUT)
    sent = spark.sparkContext.broadcast(now)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Centroids(sent.value)
        for batch in batches:
            cluster, distance = np.zeros(batch.num_rows, np.int32), np.zeros(batch.num_rows, np.int64)
            for at, x, square in blocks(batch):
                cluster[at], distance[at] = held.nearest(x, square)
            yield pa.RecordBatch.from_arrays([batch.column(2), pa.array(cluster, pa.int32()), pa.array(distance, pa.int64())], names=["vec_id", "cluster", "distance"])

    found = stash(own.select("planes", "square", "vec_id").mapInArrow(assign, "vec_id long, cluster int, distance long"))
    release(own)
    inertia = {r["cluster"]: r["s"] for r in found.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now]
    about = spark.createDataFrame([(c, s, sum(inertia.values()), digest[c]) for c, s in inertia.items()], "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
