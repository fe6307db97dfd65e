"""Odds documents cleaned as documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.contracts import CONTRACTS
from ..functions.sanitise import sanitise_choices
from ..functions.scalars import once
from ..functions.validate import shadow, validate_payload


def parse_markets(df: DataFrame) -> DataFrame:
    """``df`` with its markets as text leaves."""
    return once(df, doc=F.from_json("payload", shadow(CONTRACTS["odds"].fields)))


def cleaned(doc: Column) -> dict[str, Column]:
    """A parsed odds document with its choices cleaned; documents without
    markets stay as they are.  raw_markets are the cleaned markets as JSON."""
    clean = F.transform(doc["markets"], lambda m: m.withField("choices", sanitise_choices(m["marketName"], m["marketGroup"], m["choices"])))
    texts = F.transform(F.col("_shadow.markets"), lambda m: F.to_json(m))
    return {"_shadow": F.when(doc["markets"].isNull(), doc).otherwise(doc.withField("markets", clean)), "raw_markets": texts}


def clean_odds(df: DataFrame) -> DataFrame:
    """Odds cleaned and checked in one parse: the cleaned structure itself meets
    the contract, not its JSON form.  payload stays as sent."""
    return validate_payload(df.withColumn("raw_payload", F.col("payload")), CONTRACTS["odds"], shaped=cleaned)
