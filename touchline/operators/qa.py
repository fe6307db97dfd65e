"""Comparison of two captures of the same document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.contracts import Contract
from ..functions.scalars import once
from ..functions.validate import validate_payload


def pair(landing: DataFrame) -> DataFrame:
    """entity_id, a, b: both captures in one row, by one shuffle."""
    slot = lambda x: F.max(F.when(F.col("fetch_slot") == x, F.col("payload")))
    return landing.groupBy("entity_id").agg(slot("A").alias("a"), slot("B").alias("b"))


def comparable(value: Column, kind: DataType) -> Column:
    """The value in a form that ``<=>`` takes: maps as sorted entries."""
    if isinstance(kind, MapType):
        return F.array_sort(F.map_entries(value))
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: comparable(x, kind.elementType))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*(comparable(value[f.name], f.dataType).alias(f.name) for f in kind.fields)))
    return value


def text_of(value: Column, kind: DataType) -> Column:
    return F.to_json(value) if isinstance(kind, (StructType, ArrayType, MapType)) else value.cast("string")


def _leaves(a: Column, b: Column, kind: StructType, path: str, within: Column | None) -> list[Column]:
    """Differences of two structs: nested structs are walked, arrays and maps
    compared whole; a struct that only one side has differs as a whole."""
    out = []
    for f in kind.fields:
        x, y, at = a[f.name], b[f.name], f"{path}.{f.name}".lstrip(".")
        row = F.struct(F.lit(at).alias("path"), text_of(x, f.dataType).alias("a"), text_of(y, f.dataType).alias("b"))
        if isinstance(f.dataType, StructType):
            one = x.isNull() != y.isNull()
            out.append(F.when(one if within is None else within & one, row))
            both = x.isNotNull() & y.isNotNull()
            out += _leaves(x, y, f.dataType, at, both if within is None else within & both)
        else:
            differs = ~comparable(x, f.dataType).eqNullSafe(comparable(y, f.dataType))
            out.append(F.when(differs if within is None else within & differs, row))
    return out


def delta(a: str, b: str, kind: StructType) -> Column:
    """array<struct<path,a,b>> in schema order; an absent key is a null."""
    return F.array_compact(F.array(*_leaves(F.col(a), F.col(b), kind, "", None)))


def compare(paired: DataFrame, contract: Contract) -> DataFrame:
    """``paired`` with a_state, b_state, verdict and delta.

    Each capture is validated first and is valid, invalid or absent (no
    document, or an error envelope); what is compared are the typed documents.
    A capture that isn't valid counts as none: with one the verdict is a
    mismatch of the whole, with none the document is unavailable.
    """
    parsed = paired
    for side in ("a", "b"):
        parsed = validate_payload(parsed, contract, side).withColumnsRenamed({"parsed": f"p{side}"})
        state = F.when(F.col("is_valid"), "valid").when(F.col("reason") == "invalid_contract", "invalid").otherwise("absent")
        parsed = parsed.withColumn(f"{side}_state", state).drop("errors", "reason", "is_valid")
    a_ok, b_ok = (F.col(f"{side}_state") == "valid" for side in ("a", "b"))
    whole = F.array(F.struct(F.lit("root_payload").alias("path"), F.when(a_ok, F.col("a")).alias("a"), F.when(b_ok, F.col("b")).alias("b")))
    none = F.array().cast("array<struct<path:string,a:string,b:string>>")
    parsed = once(parsed, delta=F.when(a_ok & b_ok, delta("pa", "pb", parsed.schema["pa"].dataType)).when(a_ok | b_ok, whole).otherwise(none))
    verdict = F.when(~a_ok & ~b_ok, "unavailable").when(F.size("delta") > 0, "mismatch").otherwise("match")
    return parsed.withColumn("verdict", verdict).drop("pa", "pb")


def delta_message(found: Column) -> Column:
    """The delta as a message, cut to 500 characters."""
    message = F.concat(F.lit("QA Mismatch | Delta: "), F.to_json(found))
    return F.when(F.length(message) > 500, F.concat(F.substring(message, 1, 497), F.lit("..."))).otherwise(message)


def route(verdict: Column, failed: Column) -> Column:
    """struct<status, retry, keep>: what becomes of the task."""
    one = lambda status, retry, keep: F.struct(F.lit(status).alias("status"), F.lit(retry).alias("retry"), F.lit(keep).alias("keep"))
    return F.when(failed, one("API_ERROR", 1, False)).when(verdict == "match", one("SUCCESS", 0, True)).when(verdict == "unavailable", one("UNAVAILABLE", 0, False)).otherwise(one("QA_MISMATCH", 1, False))


def raw_equal(a: Column, b: Column) -> Column:
    """Delta of payloads that aren't objects: null where they are equal."""
    return F.when(~a.eqNullSafe(b), F.to_json(F.struct(F.struct(a.alias("a"), b.alias("b")).alias("raw_value")), {"ignoreNullFields": "false"}))
