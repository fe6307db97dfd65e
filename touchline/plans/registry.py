"""What belongs to a component, and the routes built from it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contracts import CONTRACTS, Contract
from ..functions.validate import validate_payload
from ..operators import flatten
from ..operators.odds import clean_odds
from ..operators.tables import last_by_key


@dataclass(frozen=True)
class ComponentSpec:
    contract: Contract
    flatten: Callable[[DataFrame], DataFrame]
    table: str
    key: tuple[str, ...]
    mode: str
    check: Callable[[DataFrame], DataFrame] | None = None


REGISTRY = {
    "tournament": ComponentSpec(CONTRACTS["tournament"], flatten.tournaments, "tournaments", ("tournament_id",), "upsert"),
    "seasons": ComponentSpec(CONTRACTS["seasons"], flatten.seasons, "seasons", ("season_id",), "upsert"),
    "events": ComponentSpec(CONTRACTS["events"], flatten.events, "events", ("match_id",), "upsert"),
    "base": ComponentSpec(CONTRACTS["base"], flatten.match, "matches", ("match_id",), "upsert"),
    "stats": ComponentSpec(CONTRACTS["stats"], flatten.statistics, "match_statistics", ("match_id", "period", "group_name", "stat_key"), "replace"),
    "lineup": ComponentSpec(CONTRACTS["lineups"], flatten.lineups, "match_player_lineups", ("match_id", "player_id"), "upsert"),
    "incidents": ComponentSpec(CONTRACTS["incidents"], flatten.incidents, "match_incidents", ("match_id", "seq"), "replace"),
    "graph": ComponentSpec(CONTRACTS["graph"], flatten.graph, "match_graph", ("match_id",), "upsert"),
    "odds": ComponentSpec(CONTRACTS["odds"], flatten.odds, "match_odds", ("match_id", "market_id", "choice_group", "choice_name"), "replace", clean_odds),
}


#: Components whose documents are about one match each.
OF_MATCH = ("base", "stats", "lineup", "incidents", "graph", "odds")


def checked_by(component: str, documents: DataFrame) -> tuple[ComponentSpec, DataFrame]:
    if component not in REGISTRY:
        raise ValueError(f"unknown component: {component}")
    spec = REGISTRY[component]
    return spec, spec.check(documents) if spec.check else validate_payload(documents, spec.contract)


def batch_steps(component: str) -> tuple[Callable[[DataFrame], DataFrame], Callable[[DataFrame], tuple[DataFrame, DataFrame, DataFrame]]]:
    """What a continuous ingest does with a batch of landed documents: a step
    that checks them, and one that gives of the checked ones the matches that
    they speak for, their rows, and what is rejected, with reasons.

    Of several documents of a match the newest valid one counts, as if the
    others had come in batches before: one that is newer and not valid is
    rejected and replaces nothing.  Documents of the same time go by slot, then
    by text; one without a time is the oldest, and one that names no match is
    rejected.
    """
    if component not in OF_MATCH:
        raise ValueError(f"documents of {component!r} are not about one match each")

    def check(batch: DataFrame) -> DataFrame:
        return checked_by(component, batch)[1]

    def handle(checked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        good = F.col("is_valid") & F.col("entity_id").isNotNull()
        newest = last_by_key(checked.where(good), ["entity_id"], [F.col("fetched_at"), F.col("fetch_slot"), F.col("payload")])
        reason = F.coalesce("reason", F.lit("no_entity"))
        rejects = checked.where(~good).select("entity_id", "run_id", "fetched_at", reason.alias("reason"))
        return newest.select(F.col("entity_id").alias("match_id")), REGISTRY[component].flatten(newest), rejects

    return check, handle


def route(component: str, documents: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of the component's table, rejected documents); an unknown component is an error."""
    spec, checked = checked_by(component, documents)
    return spec.flatten(checked.where("is_valid")), checked.where("not is_valid")
