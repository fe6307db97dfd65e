"""Operator 10: quality by similarity-weighted votes of nearest neighbours."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, text_of

#: Hashed features: byte trigrams, and windows of four character shapes.
GRAMS, SHAPES = 1536, 512
DIMS, NEIGHBOURS, SHARPNESS = 48, 25, 8.0
#: At most so many labelled rows of each label are fitted on, those of the smallest hash.
SAMPLE_PER_LABEL = 1500
_shape = np.full(256, 1, np.uint32)
_shape[ord("A") : ord("Z") + 1] = 2
_shape[ord("0") : ord("9") + 1] = 3
for _i, _c in enumerate(b" \t\n\r.,;:!?#*$%&|<>()[]{}\"'@/\\-_=+"):
    _shape[_c] = 4 + _i
_shape[ord("a") : ord("z") + 1] = 0


def counts(text: str) -> np.ndarray:
    """How often each hashed feature occurs in the whole text."""
    raw = np.frombuffer(text.encode(), np.uint8)
    a = raw.astype(np.uint32)
    gram = (a[:-2] * np.uint32(0x9E3779B1) + a[1:-1] * np.uint32(0x85EBCA6B) + a[2:] * np.uint32(0xC2B2AE35)) >> np.uint32(8) if len(a) > 2 else a[:0]
    s = _shape[raw]
    shape = ((((s[:-3] * np.uint32(37) + s[1:-2]) * np.uint32(37) + s[2:-1]) * np.uint32(37) + s[3:]) * np.uint32(0x9E3779B1)) >> np.uint32(8) if len(s) > 3 else s[:0]
    return np.concatenate([np.bincount(gram % GRAMS, minlength=GRAMS), np.bincount(shape % SHAPES, minlength=SHAPES)])


def embed(x: np.ndarray, idf: np.ndarray, axes: np.ndarray | None = None) -> np.ndarray:
    """Unit rows: log counts by inverse document frequency, the two kinds of
    features on equal terms, on the latent axes if they are given."""
    w = np.log1p(x) * idf
    for part in (slice(0, GRAMS), slice(GRAMS, None)):
        w[:, part] /= np.maximum(np.linalg.norm(w[:, part], axis=1, keepdims=True), 1e-9)
    w = w.astype(np.float32)
    if axes is not None:
        w = w @ axes
    return w / np.maximum(np.linalg.norm(w, axis=1, keepdims=True), 1e-9)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, df = 0, np.zeros(GRAMS + SHAPES, np.int64)
    for batch in batches:
        for x in batch.column(0):
            df += counts(x.as_py()) > 0
            n += 1
    if n:
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, len(df)), pa.int32()), pa.array([n, *df.tolist()], pa.int64())], names=["feature", "n"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str) -> dict:
    """Inverse document frequencies over all rows of ``docs``; latent axes and
    labelled vectors from a bounded sample of the rows that may be learned from.
    """
    bounded_batches(docs.sparkSession)
    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    seen = {r["feature"]: r["n"] for r in own.select("text").mapInArrow(_frequencies, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect()}
    df = np.array([seen.get(k, 0) for k in range(GRAMS + SHAPES)], np.float64)
    idf = np.log((seen.get(-1, 0) + 1) / (df + 1)) + 0.05
    may = labels.select(labels[id_col].cast("long").alias("doc_id"), labels[label_col].cast("int").alias("label")).where("doc_id is not null and label in (0, 1) and crc32(cast(doc_id as string)) % 5 != 0")
    may = may.groupBy("doc_id").agg(F.max("label").alias("label"))
    sizes = {r["label"]: r["n"] for r in may.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in sizes:
        part = may.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
        chosen = part if chosen is None else chosen.union(part)
    if chosen is None:
        return {"idf": idf, "axes": np.zeros((GRAMS + SHAPES, 1), np.float32), "vectors": np.zeros((0, 1), np.float32), "good": np.zeros(0), "weight": np.zeros(0), "prior": 0.5}

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [counts(x.as_py()) for x in batch.column(2)]
            where = [np.flatnonzero(c) for c in found]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([w.astype("<u2").tobytes() for w in where], pa.binary()), pa.array([c[w].astype("<u4").tobytes() for c, w in zip(found, where, strict=True)], pa.binary())],
                names=["doc_id", "label", "at", "n"],
            )

    taken = own.join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text").mapInArrow(sparse, "doc_id long, label int, at binary, n binary")
    taken = taken.groupBy("doc_id", "label").agg(F.max(F.struct("n", "at")).alias("of")).select("doc_id", "label", "of.n", "of.at")
    rows = {r["doc_id"]: r for r in taken.collect()}  # SAMPLE_PER_LABEL of each label at most
    x, y = np.zeros((len(rows), GRAMS + SHAPES)), np.zeros(len(rows))
    for k, doc_id in enumerate(sorted(rows)):
        x[k, np.frombuffer(rows[doc_id]["at"], "<u2")] = np.frombuffer(rows[doc_id]["n"], "<u4")
        y[k] = rows[doc_id]["label"]
    w = embed(x, idf)
    _, axes = np.linalg.eigh(w.T @ w)
    axes = np.ascontiguousarray(axes[:, -DIMS:]).astype(np.float32)
    total = max(sum(sizes.values()), 1)
    share = {label: n / total / max((y == label).sum(), 1) for label, n in sizes.items()}
    return {"idf": idf, "axes": axes, "vectors": embed(x, idf, axes), "good": y, "weight": np.array([share[int(v)] for v in y]), "prior": sizes.get(1, 0) / total}


def vote(model: dict, vectors: np.ndarray) -> np.ndarray:
    """Share of the similarity-weighted votes for label 1 among the nearest."""
    if not len(model["good"]):
        return np.full(len(vectors), model["prior"])
    near = vectors @ model["vectors"].T
    k = min(NEIGHBOURS, near.shape[1])
    top = np.argpartition(-near, k - 1, axis=1)[:, :k]
    w = np.exp(SHARPNESS * np.take_along_axis(near, top, 1).astype(np.float64)) * model["weight"][top]
    score = (w * model["good"][top]).sum(1) / w.sum(1)
    return np.where(np.abs(vectors).sum(1) > 0, score, model["prior"]).clip(0, 1)


def scores_of(model: dict, texts: pa.Array, block: int = 128) -> np.ndarray:
    """Scores of a batch of texts, by blocks of exact cosines."""
    out = [np.zeros(0)]
    for start in range(0, len(texts), block):
        x = np.stack([counts(t.as_py() or "") for t in texts[start : start + block]])
        out.append(vote(model, embed(x, model["idf"], model["axes"])))
    return np.concatenate(out)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs``.

    Two narrow passes over the documents: feature frequencies, then exact
    cosines of blocks of documents with all broadcast labelled vectors
    (2 x SAMPLE_PER_LABEL x DIMS numbers at most).  Only the text is an input of
    a score.  Null and very short texts have no features and get the share of
    label 1 as score; without labels that share is 0.5.  Of several rows of one
    labelled doc_id one, the greatest by its feature counts, is learned from; of clashing labels of one
    doc_id the larger holds.  Texts of any length are read whole.  Repeated rows
    give repeated results; an empty table gives an empty one; other columns are
    ignored.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores_of(model.value, batch.column(1)), pa.float64())], names=["doc_id", "score"])

    own = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    scored = own.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """The rows of ``docs`` that ``classify`` predicts 1, with all their columns
    as they were.  Each row is judged on its own text, in the pass that scores
    it, so nothing is joined; rows without an id are judged like any other."""
    model, at = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col)), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores_of(model.value, batch.column(at)) >= threshold))

    return docs.mapInArrow(run, docs.schema)
