"""Operator 8: quality rules under weak supervision."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches, stash, text_of

SYMBOLS, SPACES = "#*$%&|<>", " \t\n\x0b\x0c\r"
FEATURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters", "n_shouts", "n_stops")
#: Rules: numerator, denominator, good interval (inclusive), bad outside of the wider interval; between them a rule abstains.
RULES = (
    ("n_words", None, (80, float("inf")), (50, float("inf"))),
    ("word_chars", "n_words", (3.0, 9.0), (2.2, 14.0)),
    ("n_symbols", "n_words", (0.0, 0.02), (0.0, 0.2)),
    ("n_letters", "word_chars", (0.93, 1.0), (0.88, 1.0)),
    ("n_dup_lines", "n_lines", (0.0, 0.1), (0.0, 0.3)),
    ("n_repeat_words", "n_words", (0.0, 0.1), (0.0, 0.35)),
    ("n_upper", "n_letters", (0.0, 0.12), (0.0, 0.4)),
    ("n_shouts", "n_words", (0.0, 0.1), (0.0, 0.4)),
    ("n_stops", "n_words", (0.02, 0.4), (0.002, 0.7)),
)


def repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur twice or more, each word once."""
    if len(words) < 4:
        return 0
    index: dict[bytes, int] = defaultdict(count().__next__)
    ids = np.fromiter(map(index.__getitem__, words), np.int64, len(words))
    m = len(index)
    if m < 2_000_000:
        key = (ids[:-2] * m + ids[1:-1]) * m + ids[2:]
    else:
        _, pair = np.unique(ids[:-2] * m + ids[1:-1], return_inverse=True)
        key = pair * m + ids[2:]
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    if not same.any():
        return 0
    again = np.zeros(len(key), bool)
    again[order[1:][same]] = again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(key)] |= again
    return int(covered.sum())


def features(text: str) -> tuple[int, ...]:
    """The values named in FEATURES, over the whole text."""
    words = text.encode().split()  # bytes.split() splits at ASCII white space alone
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    upper = sum(map(str.isupper, text)) if not text.islower() else 0
    spaces = sum(map(text.count, SPACES))
    return (
        len(words), len(text) - spaces, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeat_words(words),
        len(lines), upper, sum(map(str.isalpha, text)), text.count("!"), text.count(". ") + text.count(".\n") + text.count(", "),
    )


def votes(f: dict[str, int]) -> list[int]:
    """For each rule 1 (good), -1 (bad) or 0 (abstains)."""
    out = []
    for top, below, good, wide in RULES:
        x = f[top] / max(f[below], 1) if below else f[top]
        out.append(1 if good[0] <= x <= good[1] else 0 if wide[0] <= x <= wide[1] else -1)
    return out


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200, floor: float = 0.5) -> np.ndarray:
    """Posterior probability of good quality of each vote pattern.

    Expectation-maximisation for a two-class model: every rule has an accuracy
    for good and one for bad documents, votes are independent given the class
    and an abstention says nothing.  All accuracies are estimated.  ``floor``
    only says which class is which: a rule's votes on good documents are right
    more often than not; on bad ones they may mostly be wrong, as each rule
    knows one kind of flaw and takes the others for good.
    """
    right = np.stack([np.full(patterns.shape[1], 0.4), np.full(patterns.shape[1], 0.95)])  # bad documents voted -1, good ones voted 1
    prior, total = 0.8, max(counts.sum(), 1)
    posterior = np.full(len(patterns), prior)
    for _ in range(rounds):
        log_good = np.where(patterns > 0, np.log(right[1]), np.where(patterns < 0, np.log1p(-right[1]), 0)).sum(1)
        log_bad = np.where(patterns < 0, np.log(right[0]), np.where(patterns > 0, np.log1p(-right[0]), 0)).sum(1)
        new = 1 / (1 + np.exp(np.clip(np.log1p(-prior) - np.log(prior) + log_bad - log_good, -50, 50)))
        good, bad = (counts * new)[:, None], (counts * (1 - new))[:, None]
        right[1] = ((good * (patterns > 0)).sum(0) + 4) / ((good * (patterns != 0)).sum(0) + 5)
        right[0] = ((bad * (patterns < 0)).sum(0) + 4) / ((bad * (patterns != 0)).sum(0) + 5)
        right = right.clip([[0.01], [floor]], [[0.99], [0.999]])
        prior = float(np.clip(good.sum() / total, 0.05, 0.95))
        if np.abs(new - posterior).max(initial=0) < 1e-9:
            break
        posterior = new
    return posterior


def judge(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts, base_failed, p_good and kept of every row of ``docs``.

    One narrow pass counts and votes; its small result is written once.  What
    reaches the driver is the number of rows of each vote pattern: at most 3 to
    the power of the number of rules rows (19,683), whatever the input's size.
    The posterior of each pattern joins back as a table of that many rows.

    Null texts count as texts without words: they fail the base rules.  Texts
    of any length are counted whole.  Repeated rows give repeated results and
    vote as often as they occur; an empty table gives an empty one; other columns
    are ignored, whatever they are named.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(x.as_py()) for x in batch.column(1)]
            columns = list(zip(*rows, strict=True)) or [()] * len(FEATURES)
            pattern = ["".join("-0+"[v + 1] for v in votes(dict(zip(FEATURES, r, strict=True)))) for r in rows]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, pa.int64()) for c in columns), pa.array(pattern, pa.string())], names=["doc_id", *FEATURES, "pattern"])

    bounded_batches(docs.sparkSession)
    narrow = docs.select(docs[id_col].cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    seen = stash(narrow.mapInArrow(run, "doc_id long, " + ", ".join(f"{f} long" for f in FEATURES) + ", pattern string"))
    tally = seen.groupBy("pattern").count().collect()
    signs = np.array([["-0+".index(c) - 1 for c in r["pattern"]] for r in tally], dtype=np.int8).reshape(len(tally), len(RULES))
    posterior = fit(signs, np.array([r["count"] for r in tally], dtype=np.float64))
    table = docs.sparkSession.createDataFrame([(r["pattern"], float(p)) for r, p in zip(tally, posterior, strict=True)], "pattern string, p_good double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = seen.join(F.broadcast(table), "pattern").withColumn("base_failed", failed)
    return out.select("doc_id", *FEATURES[:5], "base_failed", (~F.col("base_failed") & (F.col("p_good") >= threshold)).alias("kept"), "p_good")
