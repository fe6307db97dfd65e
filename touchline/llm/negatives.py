"""Operator 13: hard negatives by segment summary filtering."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches, stash

#: Components of a segment at each level, from coarse to fine; each divides the one before.
LEVELS = (64, 16, 4)
#: Anchors of one pass over the vectors: what is sent to all tasks, and what they keep, is in proportion to it.
ANCHORS = 8192
#: Pairs of an anchor and a vector that are looked at together.
PAIRS = 1 << 17
#: Largest component for which a sum of products is exact in doubles, and the largest at all.
EXACT, MOST = 1 << 22, 1 << 26
#: The score of a place that no row has yet.
NONE = -(1 << 62)
FOUND = "anchor long, slot int, vec_id long, score long"


def padded(column: pa.Array) -> np.ndarray:
    """Lists of numbers as rows of one length, a multiple of the coarsest segment, zeros behind."""
    length = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]) if len(column) else np.zeros(0, int)
    width = LEVELS[0] * max(1, -(-int(length.max(initial=0)) // LEVELS[0]))
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < length[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def summary(x: np.ndarray) -> np.ndarray:
    """Mean and deviation of each segment, level by level, each times the root
    of the segment's length: the products of two vectors' values are then what
    means and deviations contribute to their inner product."""
    out = []
    for n in LEVELS:
        s = x.reshape(len(x), -1, n)
        total = s.sum(2)
        spread = np.maximum((s * s).sum(2) - total * total / n, 0)
        out += [total / np.sqrt(n), np.sqrt(spread)]
    return np.concatenate(out, axis=1)


def at_level(s: np.ndarray, width: int, level: int) -> tuple[np.ndarray, np.ndarray]:
    """Means and deviations of a level of summaries of vectors ``width`` wide."""
    counts = [width // n for n in LEVELS]
    start = 2 * sum(counts[:level])
    return s[:, start : start + counts[level]], s[:, start + counts[level] : start + 2 * counts[level]]


def widened(x: np.ndarray, s: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Vectors and summaries with zeros behind."""
    if x.shape[1] == width:
        return x, s
    more = lambda a, n: np.pad(a, ((0, 0), (0, n - a.shape[1])))
    levels = [more(part, width // n) for i, n in enumerate(LEVELS) for part in at_level(s, x.shape[1], i)]
    return more(x, width), np.concatenate(levels, axis=1)


def near(x: np.ndarray, y: np.ndarray, sx: np.ndarray, sy: np.ndarray, asked: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (row of ``x``, row of ``y``, score) among ``asked`` (a mask) whose
    inner product is from ``least`` to ``most`` of the row of ``x``.

    The product over a segment is that of the means plus or minus at most the
    product of the deviations.  The coarsest level bounds all pairs at once;
    only pairs that may still count are looked at with finer segments, and only
    what is left is scored.
    """
    width = x.shape[1]
    # a few units of rounding of sums of that size, far less than one
    slack = 1e-12 * (np.sqrt((x * x).sum(1))[:, None] * np.sqrt((y * y).sum(1))[None, :] if len(x) and len(y) else np.zeros((len(x), len(y)))) + 1e-6
    (mx, dx), (my, dy) = at_level(sx, width, 0), at_level(sy, width, 0)
    middle, reach = mx @ my.T, dx @ dy.T + slack
    a, b = np.nonzero(asked & (middle + reach >= least[:, None]) & (middle - reach <= most[:, None]))
    for level in range(1, len(LEVELS)):
        (mx, dx), (my, dy) = at_level(sx, width, level), at_level(sy, width, level)
        middle, reach = np.einsum("ij,ij->i", mx[a], my[b]), np.einsum("ij,ij->i", dx[a], dy[b]) + slack[a, b]
        may = (middle + reach >= least[a]) & (middle - reach <= most[a])
        a, b = a[may], b[may]
    if max(np.abs(x).max(initial=0), np.abs(y).max(initial=0)) < EXACT:
        score = np.einsum("ij,ij->i", x[a], y[b]).astype(np.int64)
    else:
        score = np.einsum("ij,ij->i", x[a].astype(np.int64), y[b].astype(np.int64))
    good = (score >= least[a]) & (score <= most[a])
    return a[good], b[good], score[good]


class Best:
    """For each of ``n`` slots the ``k`` best (score, vec_id): higher scores, then smaller ids."""

    def __init__(self, n: int, k: int):
        self.k, self.score, self.ids = k, np.full((n, k), NONE), np.full((n, k), np.iinfo(np.int64).max)

    def least(self) -> np.ndarray:
        """The score that a further row needs at least."""
        return self.score[:, -1]

    def add(self, slot: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        order = np.lexsort((ids, -score, slot))
        slot, score, ids = slot[order], score[order], ids[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        keep = rank < self.k
        slot, rank, score, ids = slot[keep], rank[keep], score[keep], ids[keep]
        which, row = np.unique(slot, return_inverse=True)
        s, i = np.full((len(which), self.k), NONE), np.full((len(which), self.k), np.iinfo(np.int64).max)
        s[row, rank], i[row, rank] = score, ids
        s, i = np.concatenate([self.score[which], s], axis=1), np.concatenate([self.ids[which], i], axis=1)
        order = np.lexsort((i, -s), axis=1)[:, : self.k]
        self.score[which], self.ids[which] = np.take_along_axis(s, order, 1), np.take_along_axis(i, order, 1)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, rank = np.nonzero(self.score > NONE)
        return slot, self.ids[slot, rank], self.score[slot, rank]


def sent_of(rows: list, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, list[list[int]]]:
    """What a pass sends of its anchors (row, label, x, s, perhaps scores), as plain arrays: row, label, x, s, scores."""
    x, s = np.zeros((len(rows), width)), np.zeros((len(rows), 2 * sum(width // n for n in LEVELS)))
    for i, r in enumerate(rows):
        wide = widened(np.frombuffer(r["x"], np.float64)[None, :], np.frombuffer(r["s"], np.float64)[None, :], width)
        x[i], s[i] = wide[0][0], wide[1][0]
    return np.array([r["row"] for r in rows], np.int64), np.array([r["label"] for r in rows], np.int64), x, s, [list(r["scores"]) for r in rows if "scores" in r]


def blocks(batch: pa.RecordBatch, anchors: int, width: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Parts of a batch (row, vec_id, label, x, s), as many rows as make PAIRS pairs with the anchors, in one width."""
    row, ids, label = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(3))
    step = max(1, PAIRS // max(1, anchors))
    for start in range(0, batch.num_rows, step):
        part = slice(start, start + step)
        x = [np.frombuffer(v.as_py(), np.float64)[None, :] for v in batch.column(3)[part]]
        s = [np.frombuffer(v.as_py(), np.float64)[None, :] for v in batch.column(4)[part]]
        both = [widened(a, b, width) for a, b in zip(x, s, strict=True)]
        yield row[part], ids[part], label[part], *(np.concatenate([b[i] for b in both]) for i in (0, 1))


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = 5, negatives: int = 5, least_percent: int = 80, most_percent: int = 100, scale: int = 256, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", anchors_a_pass: int = ANCHORS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A vector's components are floor(scale * x), a score is the inner product.
    Of each row for which ``anchor`` (a condition on columns of ``vectors``)
    holds, the ``positives`` best other rows of its label are its positives;
    for each of them come the ``negatives`` best rows of other labels whose
    score is between ``least_percent`` and ``most_percent`` of the positive's.
    Higher scores are better, ties take the smaller id.

    The anchors are the queries; all rows are searched.  Vectors are written
    once with mean and deviation of their segments, for segments of 64, 16 and 4
    components.  A pass takes ``anchors_a_pass`` anchors to every task, which
    bounds what is broadcast; a task goes through its vectors block by block
    and keeps the best rows of each anchor, whose scores prune what follows; at
    its end they are shuffled by anchor, a few rows for each anchor and task.
    The first step looks at rows of an anchor's label, the second at others.

    Rows with a null id, label or vector, or with a null or non-finite component
    take no part.  Repeated rows count each, and other rows of an anchor's id
    may be its positives.  Vectors of different lengths are compared as if
    zeros followed.  An anchor without positives or negatives gives no rows;
    no anchors, or an empty table, an empty result.  Other columns are ignored.
    A component of 2^26 or more after scaling is an error: scores would not fit
    into a long.
    """
    spark = vectors.sparkSession

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.floor(scale * padded(batch.column(3)))
            if np.abs(x).max(initial=0) >= MOST:
                raise ValueError(f"a component of {MOST} or more: scores would not fit into 64 bits")
            columns = [pa.array([r.tobytes() for r in a], pa.binary()) for a in (x, summary(x))]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), *columns, batch.column(4)], names=["row", "vec_id", "label", "x", "s", "is_anchor"])

    bounded_batches(spark)
    v = vectors[vector_col].cast("array<double>")
    own = vectors.select(vectors[id_col].cast("long").alias("vec_id"), vectors[label_col].cast("long").alias("label"), v.alias("v"), F.coalesce(anchor, F.lit(False)).alias("is_anchor"))
    sound = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    own = own.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & sound)
    # numbered where they are written
    own = own.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "v", "is_anchor").mapInArrow(pack, "row long, vec_id long, label long, x binary, s binary, is_anchor boolean")
    own = stash(own)
    chosen = own.where("is_anchor")
    count, width = own.agg(F.count_if("is_anchor"), F.max(F.length("x"))).first()
    passes, width = -(-count // anchors_a_pass), (width or 0) // 8
    searched = own.select("row", "vec_id", "label", "x", "s")

    def search(sent, k: int, other: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            at, labels, ax, as_, scores = sent.value
            n = len(at)
            # a slot an anchor, or one for each different score of its positives; missing ones ask for nothing
            wanted = np.array([p + [None] * (positives - len(p)) for p in scores], object).reshape(n, positives) if other else np.zeros((n, 1), object)
            none = wanted == None  # noqa: E711
            score = np.where(none, 0, wanted).astype(np.int64)
            floor = np.where(none, np.iinfo(np.int64).max, -(-least_percent * score // 100)) if other else np.full((n, 1), NONE)
            top = np.where(none, -(1 << 62), most_percent * score // 100) if other else np.full((n, 1), 1 << 62)
            best = [Best(n, k) for _ in range(score.shape[1])]
            for batch in batches:
                for row, ids, label, x, s in blocks(batch, n, ax.shape[1]):
                    asked = (labels[:, None] != label[None, :]) if other else (labels[:, None] == label[None, :]) & (at[:, None] != row[None, :])
                    need = np.maximum(floor, np.stack([b.least() for b in best], axis=1))
                    a, b, found = near(ax, x, as_, s, asked, need.min(1), top.max(1))
                    for slot, kept in enumerate(best):
                        fits = (found >= need[a, slot]) & (found <= top[a, slot])
                        if fits.any():
                            kept.add(a[fits], found[fits], ids[b[fits]])
            for slot, kept in enumerate(best):
                a, ids, found = kept.rows()
                yield pa.RecordBatch.from_arrays([pa.array(at[a], pa.int64()), pa.array(np.full(len(a), slot), pa.int32()), pa.array(ids, pa.int64()), pa.array(found, pa.int64())], names=["anchor", "slot", "vec_id", "score"])

        return run

    def ranked(found: DataFrame, k: int) -> DataFrame:
        w = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)

    out = None
    for number in range(passes):
        part = chosen.where(F.pmod(F.xxhash64("row"), F.lit(passes)) == number).select("row", "vec_id", "label", "x", "s")
        sent = spark.sparkContext.broadcast(sent_of(part.collect(), width))
        first = stash(ranked(searched.mapInArrow(search(sent, positives, False), FOUND), positives).select(F.col("anchor").alias("row"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")))
        # slots of the second step: an anchor's different positive scores, smallest first
        scores = first.groupBy("row").agg(F.array_sort(F.collect_set("positive_score")).alias("scores"))
        sent = spark.sparkContext.broadcast(sent_of(part.join(scores, "row").collect(), width))
        second = ranked(searched.mapInArrow(search(sent, negatives, True), FOUND), negatives).withColumnsRenamed({"anchor": "row", "vec_id": "negative_id", "score": "negative_score"})
        slots = first.join(part.select("row", F.col("vec_id").alias("anchor_id")), "row").join(scores, "row").withColumn("slot", (F.array_position("scores", F.col("positive_score")) - 1).cast("int"))
        rows = stash(slots.join(second, ["row", "slot"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
        out = rows if out is None else out.union(rows)
    return out if out is not None else spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
