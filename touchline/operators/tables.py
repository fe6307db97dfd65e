"""Writing and checking the stored tables, on plain Parquet.

Parquet has no MERGE or DELETE, so both write modes compute the new state as a
DataFrame; ``store`` keeps the state of a continuous ingest.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.contracts import INCIDENT_REQUIRED
from ..sources.scratch import scratch


@dataclass(frozen=True)
class TableSpec:
    name: str
    ddl: str
    key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    mode: str = "upsert"  # or "replace": rows of the incoming matches go first
    #: (column, table whose key it must be in)
    parents: tuple[tuple[str, str], ...] = ()
    #: (column, values it may have)
    domains: tuple[tuple[str, tuple[str, ...]], ...] = ()


# What the columns of a few kinds may hold.
STATUSES = ("PENDING", "SUCCESS", "QA_MISMATCH", "API_ERROR", "UNAVAILABLE", "SKIPPED_MISSING")
COMPONENTS = ("base", "stats", "lineup", "incidents", "graph", "odds")
OF_MATCH, OF_SEASON, OF_TOURNAMENT = ("match_id", "events"), ("season_id", "seasons"), ("tournament_id", "tournaments")
TABLES = {
    t.name: t
    for t in (
        TableSpec("tournaments", "tournament_id bigint, name string, sport string, country string, raw string", ("tournament_id",), ("name",)),
        TableSpec("seasons", "season_id bigint, tournament_id bigint, year string, name string, raw string", ("season_id",), ("year",), parents=(OF_TOURNAMENT,)),
        TableSpec("events", "match_id bigint, season_id bigint, tournament_id bigint, slug string, home_slug string, away_slug string, round bigint, status_type string, start_timestamp bigint, has_global_highlights boolean, has_xg boolean, has_player_statistics boolean, has_player_heat_map boolean, raw string", ("match_id",), ("home_slug", "away_slug"), parents=(OF_TOURNAMENT, OF_SEASON)),
        TableSpec("match_component_audit", "audit_id bigint, match_id bigint, component_name string, status string, retry_count int, last_attempted_at timestamp, error_message string", ("match_id", "component_name"), ("status",), parents=(OF_MATCH,), domains=(("component_name", COMPONENTS), ("status", STATUSES))),
        TableSpec("matches", "match_id bigint, tournament_id bigint, season_id bigint, slug string, start_time timestamp, home_slug string, away_slug string, status_type string, injury_time1 bigint, injury_time2 bigint, home_score_ht bigint, home_score bigint, away_score_ht bigint, away_score bigint, round bigint, winner_code bigint, home_manager string, away_manager string, home_venue string, away_venue string, home_venue_city string, away_venue_city string, raw string", ("match_id",), ("home_slug", "away_slug"), parents=(OF_MATCH, OF_TOURNAMENT, OF_SEASON)),
        TableSpec("match_statistics", "match_id bigint, period string, group_name string, stat_key string, name string, home string, away string, home_value double, away_value double, home_total bigint, away_total bigint, compare_code bigint, statistics_type string, value_type string, render_type bigint", ("match_id", "period", "group_name", "stat_key"), ("name",), "replace", (OF_MATCH,)),
        TableSpec("match_player_lineups", "match_id bigint, player_id bigint, team_id bigint, side string, player_name string, player_slug string, position string, shirt_number bigint, substitute boolean, captain boolean, minutes_played bigint, rating double, goals bigint, expected_goals double, expected_assists double, statistics string", ("match_id", "player_id"), ("team_id", "side", "player_name"), parents=(OF_MATCH,), domains=(("side", ("home", "away")),)),
        TableSpec("match_incidents", "id bigint, match_id bigint, incident_type string, time bigint, added_time bigint, is_home boolean, data string", ("id",), ("match_id", "incident_type"), "replace", (OF_MATCH,), (("incident_type", tuple(INCIDENT_REQUIRED)),)),
        TableSpec("match_graph", "match_id bigint, period_time bigint, overtime_length bigint, period_count bigint, points string", ("match_id",), parents=(OF_MATCH,)),
        TableSpec("match_odds", "match_id bigint, market_id bigint, choice_group string, choice_name string, market_name string, is_live boolean, suspended boolean, initial_num int, initial_den int, num int, den int, winning boolean, change bigint, raw string", ("match_id", "market_id", "choice_group", "choice_name"), ("market_name",), "replace", (OF_MATCH,)),
    )
}


def last_by_key(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The last row in ``order`` of each key."""
    w = Window.partitionBy(*key).orderBy(*(c.desc() for c in order))
    return rows.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def keyed_upsert(target: DataFrame, incoming: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """State after insert-or-replace by key; within ``incoming`` the last in
    ``order`` wins.  Both meet in one window by key, so each is worked out and
    shuffled once; rows of ``target`` whose key has a null are replaced by none."""
    both = target.withColumn("_new", F.lit(False)).unionByName(incoming.withColumn("_new", F.lit(True)), allowMissingColumns=True)
    w = Window.partitionBy(*key)
    ranked = both.withColumns({"_rn": F.row_number().over(w.orderBy(F.col("_new").desc(), *(c.desc() for c in order))), "_hit": F.max("_new").over(w)})
    unkeyed = F.array_contains(F.array(*(F.col(k).isNull() for k in key)), True)
    return ranked.where(F.when(F.col("_new"), F.col("_rn") == 1).otherwise(~F.col("_hit") | unkeyed)).select(*target.columns)


def wipe_replace(target: DataFrame, payload_keys: DataFrame, rows: DataFrame, key: str = "match_id") -> DataFrame:
    """State after all rows of the incoming documents' matches gave way to the
    new ones; a document without rows wipes too."""
    kept = target.join(payload_keys.select(key).distinct(), key, "left_anti").select(*target.columns)
    return kept.unionByName(rows.select(*target.columns))


def surrogate_ids(df: DataFrame, order: list[str], stored: DataFrame | None = None, start: int = 0, name: str = "id") -> DataFrame:
    """``df`` with consecutive ids in a given order, continued from the largest
    one in ``stored`` (from ``start`` where there is none).

    Rows are dealt to ranges, sorted and written once, each with its range and
    its place in it.  The size of every range is counted on what was written, so
    counts and places can't disagree, whatever bounds were sampled and however
    often a lost task is rerun; a range's first id is the sum of the sizes
    before, one row a range.
    """
    spark = df.sparkSession
    n, path = max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), scratch(spark)
    # a row's number is its range (33 bits up) and its place
    df.repartitionByRange(n, *order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    written = spark.read.schema(StructType(df.schema.fields).add("_at", "long")).parquet(path)
    part = F.shiftright("_at", 33).alias("_part")
    sizes = written.groupBy(part).agg(F.count("*").alias("_n"))
    first = sizes.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_first"))
    last = F.lit(start).cast("long")
    if stored is not None:
        last = F.lit(stored.agg(F.coalesce(F.max(name), last)).first()[0])
    out = written.withColumn("_part", part).join(F.broadcast(first), "_part")
    return out.withColumn(name, last + F.col("_first") + F.col("_at").bitwiseAND((1 << 33) - 1) + 1).select(*(c for c in df.columns if c != name), name)


def violations(df: DataFrame, spec: TableSpec, parents: dict[str, DataFrame]) -> DataFrame:
    """table_name, rule, match_id, key_text, n of every broken rule of a table.

    Rules are unique, not_null:<column> (key columns included), domain:<column>
    and foreign_key:<column>; ``parents`` holds the parent tables that are to be
    looked at.  Each parent is one join with its distinct keys, which marks the
    rows that have it; then all rules are counted in one aggregate by the key.
    Where the key doesn't name the match, each match that holds a repeated key
    breaks the rule, with its own rows as n.
    """
    marked, broken = df, {}
    for column in dict.fromkeys((*spec.key, *spec.not_null)):
        broken[f"not_null:{column}"] = F.col(column).isNull()
    for column, allowed in spec.domains:
        broken[f"domain:{column}"] = ~F.col(column).isin(*allowed)
    for i, (column, parent) in enumerate(spec.parents):
        if parent in parents:
            own = parents[parent].select(F.col(TABLES[parent].key[0]).alias(column)).distinct().withColumn(f"_parent{i}", F.lit(True))
            marked = marked.join(own, column, "left")
            broken[f"foreign_key:{column}"] = F.col(column).isNotNull() & F.col(f"_parent{i}").isNull()
    text = F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in spec.key))
    match = F.col("match_id") if "match_id" in df.columns else F.lit(None).cast("long")
    spans = "match_id" in df.columns and "match_id" not in spec.key
    counts = marked.groupBy(*spec.key, *(["match_id"] if spans else [])).agg(F.count("*").alias("_rows"), F.min(match).alias("_match"), *(F.count_if(c).alias(f"_broken{i}") for i, c in enumerate(broken.values())))
    repeated = F.col("_rows") > 1
    if spans:
        names = [f"_key{i}" for i in range(len(spec.key))]
        held = counts.groupBy(*(F.col(k).alias(n) for k, n in zip(spec.key, names, strict=True))).agg(F.sum("_rows").alias("_all")).where("_all > 1")
        same = F.lit(True)
        for k, n in zip(spec.key, names, strict=True):
            same = same & F.col(k).eqNullSafe(F.col(n))
        counts, repeated = counts.join(held, same, "left"), F.col("_all").isNotNull()
    found = [F.when(repeated, F.struct(F.lit("unique").alias("rule"), F.col("_rows").alias("n")))]
    found += [F.when(F.col(f"_broken{i}") > 0, F.struct(F.lit(rule).alias("rule"), F.col(f"_broken{i}").alias("n"))) for i, rule in enumerate(broken)]
    return counts.select(F.col("_match").alias("match_id"), text.alias("key_text"), F.explode(F.array_compact(F.array(*found))).alias("r")).select(F.lit(spec.name).alias("table_name"), "r.rule", "match_id", "key_text", "r.n")


def admitted(rows: DataFrame, found: DataFrame, component: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the matches that break no rule, and an outcome (match_id,
    component_name, outcome, message) for each match that does: the whole task
    failed, and its message names the rules.  Rows without a match belong to no
    task and are never admitted; ``found`` names them."""
    bad = found.where("match_id is not null").groupBy("match_id").agg(F.array_sort(F.collect_set("rule")).alias("rules"), F.count("*").alias("n"))
    message = F.concat(F.lit("constraint: "), F.array_join("rules", ", "), F.lit(" ("), F.col("n").cast("string"), F.lit(")"))
    outcomes = bad.select("match_id", F.lit(component).alias("component_name"), F.lit("API_ERROR").alias("outcome"), message.alias("message"))
    return rows.where("match_id is not null").join(bad.select("match_id"), "match_id", "left_anti").select(*rows.columns), outcomes


def create_schema(spark: SparkSession, database: str, drop: bool = False) -> None:
    """All tables as Parquet tables of a database; ``drop`` removes it first, with all its tables."""
    if drop:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for t in TABLES.values():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {database}.{t.name} ({t.ddl}) USING parquet")
