"""Operator 3: URL filter by the ratio of two character language models."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, lower_ascii, shuffled, stash

#: Longest context plus one; 2 to the power of BITS URLs are scored together.
ORDER, BITS, STRENGTH = 5, 11, 4.0
#: Steps of the score in which the threshold is chosen, and how far they reach on either side.
STEP, REACH = 0.01, 500


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(rules: list[tuple[str, str]]) -> Column:
    """struct(rule, verdict) of the longest rule that fits columns host and path.

    For hand-kept lists: the expression has one branch a rule (1,000 at most).
    """
    if len(rules) > 1000:
        raise ValueError("more than 1,000 rules: keep them in a table and join on host suffixes")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        host, slash, path = rule.partition("/")
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(slash + path)
        out = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def grams(url: str) -> np.ndarray:
    """64-bit hash of the n-gram that ends at each byte, for n = 1 to ORDER (rows)."""
    raw = np.frombuffer(b"\x02" * (ORDER - 1) + url.encode() + b"\x03", np.uint8).astype(np.uint64)
    n = len(raw) - ORDER + 1
    h, out = np.zeros(n, np.uint64), np.empty((ORDER, n), np.uint64)
    for k in range(ORDER):
        h = (h + raw[ORDER - 1 - k : ORDER - 1 - k + n] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        # the order in the lowest three bits
        out[k] = h << np.uint64(3) | np.uint64(k)
    return out.view(np.int64)


def log_likelihood(n_of: np.ndarray, total: float) -> float:
    """Of all bytes under the smoothed variable-order model that has seen the
    n-grams at each byte ``n_of`` times, and ``total`` bytes: the estimate of
    each order backs off to the next lower one by a Dirichlet prior of STRENGTH,
    so an unseen context leaves it as it is."""
    p = np.full(n_of.shape[1], 1 / 256)
    for k, n in enumerate(n_of):
        # the context is the k-gram that ends one byte earlier
        context = np.full(len(n), total) if k == 0 else np.concatenate([[total], n_of[k - 1][:-1]])
        p = (n + STRENGTH * p) / (context + STRENGTH)
    return float(np.log(p).sum())


def ratio(model: np.ndarray, url: str, known: np.ndarray | None = None, total: tuple[float, float] = (0.0, 0.0)) -> float:
    """Log-likelihood difference of the accepted and the rejected model a byte.

    ``model`` has the counts of the n-grams ``known`` (sorted) by class, and
    zeros in a last column."""
    g = grams(url)
    at = np.full(g.shape, -1)
    if known is not None and len(known):
        found = np.minimum(np.searchsorted(known, g), len(known) - 1)
        at = np.where(known[found] == g, found, -1)
    return (log_likelihood(model[1][at], total[1]) - log_likelihood(model[0][at], total[0])) / g.shape[1]


def train(labelled: DataFrame) -> DataFrame:
    """gram, bad, good: how often each n-gram is in the rows of ``labelled``
    (url, good) of either class.  As many rows as there are distinct n-grams;
    counted map-side first, never gathered."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for good in (False, True):
                own = [grams(url.as_py()).ravel() for url, g in zip(batch.column(0), batch.column(1).to_pylist(), strict=True) if g == good]
                if own:
                    found, n = np.unique(np.concatenate(own), return_counts=True)
                    none = np.zeros(len(n), np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(none if good else n, pa.int64()), pa.array(n if good else none, pa.int64())], names=["gram", "bad", "good"])

    return labelled.select("url", "good").mapInArrow(run, "gram long, bad long, good long").groupBy("gram").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))


def score(df: DataFrame, model: DataFrame, total: tuple[float, float]) -> DataFrame:
    """``df`` (with url and chunk) with score: 0 for an empty url.

    The distinct n-grams of each chunk meet the model in a join, and what it has
    of them goes back to the chunk's URLs.  Neither is broadcast: Spark counts a
    row a URL for both."""

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chunks = batch.column(0).to_numpy()
            for chunk in np.unique(chunks):
                own = [grams(batch.column(1)[int(i)].as_py()).ravel() for i in np.flatnonzero(chunks == chunk)]
                found = np.unique(np.concatenate(own))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), chunk)), pa.array(found)], names=["chunk", "gram"])

    def judge(rows: pa.Table, seen: pa.Table) -> pa.Table:
        gram, bad, good = (seen[c].to_numpy() for c in ("gram", "bad", "good"))
        known, first = np.unique(gram, return_index=True)  # a chunk over two batches may ask twice
        counts = np.concatenate([np.stack([bad[first], good[first]]), np.zeros((2, 1))], axis=1)
        found = [ratio(counts, u.as_py(), known, total) if u.as_py() else 0.0 for u in rows["url"]]
        return rows.append_column("score", pa.array(found, pa.float64()))

    asked = df.select("chunk", "url").where("url <> ''").mapInArrow(needed, "chunk long, gram long").join(shuffled(model), "gram")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema) + ", score double"
    return df.groupby("chunk").cogroup(asked.groupby("chunk")).applyInArrow(judge, kinds)


def calibrate(held_out: DataFrame) -> float:
    """The threshold of best balanced accuracy on ``held_out`` (good, score),
    from counts by score step: a bounded number of rows reaches the driver."""
    step = F.greatest(F.lit(-REACH), F.least(F.lit(REACH), F.floor(F.col("score") / STEP)))
    rows = held_out.groupBy(step.alias("step"), "good").count().collect()
    n = {True: max(1, sum(r["count"] for r in rows if r["good"])), False: max(1, sum(r["count"] for r in rows if not r["good"]))}
    best, at = -1.0, 0
    for t in range(-REACH, REACH + 1):
        got = sum(r["count"] / n[r["good"]] for r in rows if (r["step"] >= t) == r["good"])
        if (round(got, 9), -abs(t)) > (round(best, 9), -abs(at)):
            best, at = got, t
    return at * STEP


def filter_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, fold, score, threshold of every row of ``pages``.

    URLs that a rule accepts or rejects train the two models, but for a fifth of
    them (crc32 of the id mod 5 = 0): one half of it chooses the threshold, the
    other, which nothing is chosen by, is there to report agreement on.  fold
    says which it was (train, threshold, report; null without a rule).  The
    models judge the URLs without a rule.  The models are exact counts of n-grams, one row each
    however many there are; chunks of URLs join them.  URLs of any length are
    scored whole; columns of ``pages`` that aren't named are ignored.  Null URLs and those without ``://`` have an empty host and path
    and no rule; a null or empty URL scores 0.  Without URLs of both kinds every
    score is 0 and the verdict allow.  Repeated rows give repeated results.
    """
    bounded_batches(pages.sparkSession)
    url = F.col(url_col)
    own = pages.select(pages[id_col].cast("long").alias("page_id"), F.coalesce(url, F.lit("")).alias("url"), host_of(url).alias("host"), path_of(url).alias("path"))
    chunk = F.shiftright(F.monotonically_increasing_id(), BITS).alias("chunk")
    found = stash(own.withColumn("found", longest_rule(rules)).select("page_id", "url", "host", "path", "found.rule", "found.verdict", chunk))
    part = F.coalesce(F.crc32(F.col("page_id").cast("string")) % 10, F.lit(1))
    fold = F.when(F.col("verdict").isNull(), None).when(part == 0, "threshold").when(part == 5, "report").otherwise("train")
    own = found.where(fold == "train").withColumn("good", F.col("verdict") == "allow")
    total = {r["good"]: float(r["n"]) for r in own.groupBy("good").agg(F.sum(F.octet_length("url") + 1).alias("n")).collect()}
    if len(total) == 2:
        scored = stash(score(found, train(own), (total[False], total[True])))
    else:
        scored = found.withColumn("score", F.lit(0.0))
    threshold = calibrate(scored.where(fold == "threshold").select((F.col("verdict") == "allow").alias("good"), "score"))
    own_verdict = F.when(F.col("score") >= threshold, "allow").otherwise("block")
    return scored.select("page_id", "host", "path", "rule", F.coalesce("verdict", own_verdict).alias("verdict"), fold.alias("fold"), "score", F.lit(threshold).alias("threshold"))


def agreement(judged: DataFrame, fold: str = "report") -> DataFrame:
    """own, ruled, n: how the models alone would have judged the URLs of a fold,
    beside what their rule says.  ``judged`` is what ``filter_urls`` returns."""
    return judged.where(F.col("fold") == fold).groupBy(F.when(F.col("score") >= F.col("threshold"), "allow").otherwise("block").alias("own"), F.col("verdict").alias("ruled")).agg(F.count("*").alias("n"))
