"""Operator 9: line dedup with two Bloom filters and an exact confirmation."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bloom import LARGEST, Growing, by_segment, filter_of, split_by_ids, within
from .common import bounded_batches, stash, text_of

STRIP = " \t\n\x0b\x0c\r"
MIN_CHARS = 10
#: Hashes of one task that are made distinct together before they are sent on.
FLUSH = 1 << 21
#: Confirmed lines (24 bytes each) that are broadcast, those in most documents; the others are joined.
BROADCAST_LINES = 400_000


def long_keys(text: str, least: int = MIN_CHARS) -> list[str | None]:
    """The key of each line, None where it is too short to count."""
    lines = text.encode().lower().decode().split("\n")  # bytes.lower() changes A-Z alone
    return [k if len(k) >= least else None for k in (x.strip(STRIP) for x in lines)]


def hashes(keys: list[str]) -> np.ndarray:
    """128-bit hashes of keys, as rows of two numbers.  Lines are told apart by
    them: among 10^12 different lines two share one with probability 10^-15."""
    return np.array(np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)) or b"", ">u8"), np.uint64).reshape(-1, 2)


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of one task's lines by segment, each once, and which of them were in several documents."""

    def sent(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        found, n = np.unique(np.concatenate(parts), return_counts=True)
        again = dict(by_segment(found[n > 1]))
        rows = [(k, h.tobytes(), again.get(k, h[:0]).tobytes()) for k, h in by_segment(found)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int32(), pa.binary(), pa.binary()), strict=True)], names=["segment", "once", "twice"])

    parts, held = [], 0
    for batch in batches:
        keys = [k for x in batch.column(0) for k in {*long_keys(x.as_py())} if k is not None]
        if keys:
            parts.append(hashes(keys)[:, 0])
            held += len(keys)
        if held >= FLUSH:
            yield from sent(parts)
            parts, held = [], 0
    if parts:
        yield from sent(parts)


def _twice(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes that tasks have seen twice or that a filter of those seen once
    holds already when another task brings them."""
    once: dict[int, Growing] = {}
    twice: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for k, new, again in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            seen, h = once.setdefault(k, Growing()), np.frombuffer(new, np.uint64)
            hit = seen.has(h)
            seen.add(h[~hit])
            twice.setdefault(k, []).extend((h[hit], np.frombuffer(again, np.uint64)))
    for k, parts in twice.items():
        h = np.unique(np.concatenate(parts))
        if len(h):
            yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([h.tobytes()], pa.binary()), pa.array([len(h)], pa.int64())], names=["segment", "hashes", "n"])


def repeated_lines(narrow: DataFrame, largest: int = LARGEST) -> tuple[DataFrame, DataFrame]:
    """Of ``narrow`` (doc_id, text): suspected lines (k1, k2, doc_id), and the
    lines that several documents hold (k1, k2, keeper: the smallest of them, n).

    The filter of lines seen once lies in partitions, a segment of the hashes
    each, and grows with what it gets: 8 bytes a distinct line of a task are
    shuffled for it.  The filter of lines seen twice is sized by its content,
    up to 2^30 bits, and broadcast.  Lines it suspects are shuffled as 24 bytes
    and confirmed by an aggregate, which starts map-side, so a hot line costs a
    row a task.  Beyond 67 million repeated lines it suspects ever more lines
    that aren't: at worst all are confirmed, none is missed.
    """
    spark = narrow.sparkSession
    local = narrow.select("text").mapInArrow(_local, "segment int, once binary, twice binary")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    twice = stash(local.repartition(n, "segment").mapInArrow(_twice, "segment int, hashes binary, n long"))
    shared = spark.sparkContext.broadcast(filter_of(twice, twice.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], largest))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                own = [k for k in {*long_keys(text.as_py())} if k is not None]
                ids += [doc_id] * len(own)
                keys += own
            h = hashes(keys)
            hit = within(shared.value, h[:, 0])
            h = h[hit].view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array(np.array(ids, np.int64)[hit])], names=["k1", "k2", "doc_id"])

    found = stash(narrow.where("doc_id is not null").mapInArrow(suspects, "k1 long, k2 long, doc_id long"))
    keepers = found.groupBy("k1", "k2").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"), F.count("*").alias("n"))
    return found, stash(keepers.where("last > keeper").drop("last"))


def arranged(table: pa.Table) -> tuple[np.ndarray, ...]:
    """The lines to broadcast (k1, k2, keeper), by k1, as plain arrays; at last
    how many share their first number at most: 1 in practice."""
    k1 = table["k1"].to_numpy()
    order = np.argsort(k1, kind="stable")
    return *(table[c].to_numpy()[order] for c in ("k1", "k2", "keeper")), np.unique(k1, return_counts=True)[1].max(initial=0)


def others(lines: tuple[np.ndarray, ...], h: np.ndarray, doc_id: int) -> np.ndarray:
    """Which of the hashes are ``lines`` that a smaller document keeps."""
    k1, k2, keeper, runs = lines
    h = h.view(np.int64)
    out, at = np.zeros(len(h), bool), np.searchsorted(k1, h[:, 0])
    for step in range(runs):
        i = np.minimum(at + step, len(k1) - 1)
        out |= (k1[i] == h[:, 0]) & (k2[i] == h[:, 1]) & (keeper[i] < doc_id)
    return out


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None, broadcast_lines: int = BROADCAST_LINES, largest: int = LARGEST) -> DataFrame:
    """doc_id, n_lines, n_dropped, text of every row of ``docs``, the text
    without lines that a smaller document holds too; other lines as they were.
    The columns named in ``keep`` come along after these four, as they were,
    whatever their names are.

    No text is shuffled that loses no line, nor one that loses only lines that
    very many documents hold: the lines in most documents (``broadcast_lines``
    at most, chosen by a power of two of their count) are broadcast.  The
    others are joined to the documents that lose them, found by a filter.

    Null or empty texts have one empty line.  Rows that share a doc_id count as
    one document (each loses the same lines); rows without one are left alone.
    Texts of any length are read whole, their lines hashed one by one.  An empty
    table gives an empty result; columns not kept are ignored.
    """
    bounded_batches(docs.sparkSession)
    along = {f"along_{i}": c for i, c in enumerate(keep or [])}
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"), *(docs[c].alias(a) for a, c in along.items()))
    found, keepers = repeated_lines(narrow.select("doc_id", "text"), largest)
    level = F.floor(F.log2("n")).cast("int")
    sizes = sorted(((r["level"], r["n"]) for r in keepers.groupBy(level.alias("level")).agg(F.count("*").alias("n")).collect()), reverse=True)
    hot, least, cold = 0, 64, 0
    for k, n in sizes:
        if cold or hot + n > broadcast_lines:
            cold += n
        else:
            hot, least = hot + n, k
    shared = docs.sparkSession.sparkContext.broadcast(arranged(keepers.where(level >= least).select("k1", "k2", "keeper").toArrow()))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], []]
            for doc_id, text, gone in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2).to_pylist(), strict=True):
                text = text.as_py()
                lines = text.split("\n")
                own = [(i, k) for i, k in enumerate(long_keys(text)) if k is not None] if doc_id is not None else []
                if own:
                    h = hashes([k for _, k in own])
                    drop = others(shared.value, h, doc_id)
                    if gone:
                        cold_keys = {(g["k1"], g["k2"]) for g in gone}
                        drop |= np.fromiter((tuple(x) in cold_keys for x in h.view(np.int64).tolist()), bool, len(h))
                    if drop.any():
                        lost = {own[i][0] for i in np.flatnonzero(drop).tolist()}
                        lines = [x for i, x in enumerate(lines) if i not in lost]
                n_lines = text.count("\n") + 1
                for column, value in zip(out, (n_lines, n_lines - len(lines), "\n".join(lines)), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string()), *batch.columns[3:]], names=["doc_id", "n_lines", "n_dropped", "text", *batch.schema.names[3:]])

    kinds = "".join(f", {a} {docs.schema[c].dataType.simpleString()}" for a, c in along.items())
    kind = "array<struct<k1:long,k2:long>>"
    none = narrow
    some = None
    if cold:
        drops = found.join(keepers.where(level < least), ["k1", "k2"]).where("doc_id > keeper").select("doc_id", "k1", "k2")
        drops = stash(drops.groupBy("doc_id").agg(F.collect_set(F.struct("k1", "k2")).alias("drops")))
        ids = drops.select(F.col("doc_id").alias("id"))
        maybe, none = split_by_ids(narrow, ids, ids.count())
        some = maybe.join(drops, "doc_id", "left")
    rows = none.withColumn("drops", F.lit(None).cast(kind))
    order = ["doc_id", "text", "drops", *along]
    rows = rows.select(*order) if some is None else rows.select(*order).union(some.select(*order))
    out = rows.mapInArrow(cut, "doc_id long, n_lines long, n_dropped long, text string" + kinds)
    return out.toDF("doc_id", "n_lines", "n_dropped", "text", *along.values())
