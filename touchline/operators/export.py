"""Match documents: what was captured of a match, as one nested record."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def match_documents(captures: dict[str, DataFrame]) -> DataFrame:
    """match_id, one struct a component, and errors with a status and a message
    a component, of every match that any capture names.

    ``captures`` maps components to validated documents (entity_id, parsed,
    is_valid, reason).  A valid document is ``success``, one that is not
    ``failed`` with its reason, none ``not_attempted``.  Of several captures of a
    component a valid one comes before others, the greatest if there are more.
    All components meet in one aggregate, so there is one shuffle.
    """
    parts = [
        df.select(F.col("entity_id").alias("match_id"), F.when(F.col("is_valid"), F.col("parsed")).alias(name), F.struct(F.col("is_valid").alias("valid"), "reason").alias(f"_{name}"))
        for name, df in captures.items()
    ]
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    found = rows.groupBy("match_id").agg(*(F.max(c).alias(c) for name in captures for c in (name, f"_{name}")))

    def outcome(name: str):
        seen = F.col(f"_{name}")
        status = F.when(seen.isNull(), "not_attempted").when(seen["valid"], "success").otherwise("failed")
        return F.struct(status.alias("status"), F.when(~seen["valid"], seen["reason"]).alias("message")).alias(name)

    return found.select("match_id", *captures, F.struct(*map(outcome, captures)).alias("errors"))


def write_json(documents: DataFrame, path: str) -> DataFrame:
    """One JSON document a line in gzipped files under ``path``, and the documents
    as read back with the types that they were written with.  Plain, names that
    every document repeats would take many times the room of what was captured."""
    documents.write.option("compression", "gzip").json(path)
    return documents.sparkSession.read.schema(documents.schema).json(path)
