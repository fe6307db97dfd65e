"""Consensus over many runs of the same documents."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType

from ..functions.contracts import CONTRACTS, Contract
from ..functions.scalars import once
from ..functions.validate import enveloped, holding, typed, validate_payload
from .qa import delta

# Weights of components in the quality score.
WEIGHTS = {"base": 1.0, "stats": 0.8, "lineup": 0.8, "incidents": 0.6, "graph": 0.3}
# Fields of each component that tell of the capture, not of the match.
EXCLUDED = {
    "base": ("scraped_at", "currentPeriodStartTimestamp"), "stats": ("generated_at", "processing_time"), "lineup": ("lastUpdated", "cached_at"),
    "incidents": ("processedAt",), "graph": ("calculatedAt",),
}


def pruned(value: Column, kind: DataType, excluded: tuple[str, ...], path: str = "") -> Column:
    """A value without the fields that are excluded, by name at any depth or by
    dotted path; members and map entries sorted by name."""
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: pruned(x, kind.elementType, excluded, path))
    if isinstance(kind, MapType):
        return F.array_sort(F.map_entries(F.map_filter(value, lambda k, _: ~k.isin(*excluded) if excluded else F.lit(True))))
    if isinstance(kind, StructType):
        kept = sorted((f for f in kind.fields if f.name not in excluded and f"{path}.{f.name}".lstrip(".") not in excluded), key=lambda f: f.name)
        return F.when(value.isNotNull(), F.struct(*(pruned(value[f.name], f.dataType, excluded, f"{path}.{f.name}".lstrip(".")).alias(f.name) for f in kept)))
    return value


def with_fingerprints(runs: DataFrame, contracts: dict[str, Contract], excluded: dict[str, tuple[str, ...]] = EXCLUDED) -> DataFrame:
    """``runs`` (match_id, component, run_id, run_at, payload) with data, the
    typed document without what is excluded for its component, and fp, the
    SHA-256 of that.  What can't be read or breaks its contract is no data."""
    out = None
    for component, contract in contracts.items():
        checked = validate_payload(runs.where(F.col("component") == component), contract)
        data = F.to_json(pruned(F.col("parsed"), checked.schema["parsed"].dataType, excluded.get(component, ())))
        one = checked.withColumn("data", F.when(F.col("is_valid"), data)).drop("parsed", "errors", "reason", "is_valid")
        out = one if out is None else out.unionByName(one)
    return out.withColumn("fp", F.sha2("data", 256))


def run_stats(runs: DataFrame, by: tuple[str, ...] = ("run_id", "component")) -> DataFrame:
    return runs.groupBy(*by).agg(F.min("run_at").alias("run_at"), F.count("*").alias("documents"), F.count("payload").alias("present"), F.countDistinct("match_id").alias("matches"))


RUN_KEY = ("tournament_id", "season_id", "run_id")
RUN = "component string, match_id bigint, run_at timestamp, payload string, tournament_id bigint, season_id bigint, run_id string"


def save_run(docs: DataFrame, root: str) -> None:
    """Stores runs: ``docs`` (tournament_id, season_id, run_id, run_at, component,
    match_id, payload) by tournament, season and run, and a catalogue of them by
    run: a few rows a season, so seasons have no files of their own there.
    A run that is saved again replaces itself, season by season, and no other one."""
    own = docs.select("component", "match_id", "run_at", "payload", *RUN_KEY).hint("rebalance", *RUN_KEY)  # splits what is large
    own.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*RUN_KEY).parquet(f"{root}/runs")
    saved = [r["run_id"] for r in docs.select("run_id").distinct().collect()]  # those of one call: few
    run_stats(load_runs(docs.sparkSession, root, run_ids=saved), (*RUN_KEY, "component")).hint("rebalance", "run_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(f"{root}/catalogue")


def list_runs(spark: SparkSession, root: str) -> DataFrame:
    """tournament_id, season_id, run_id, component, run_at, documents, present,
    matches of every stored run: the catalogue alone is read."""
    kinds = "tournament_id bigint, season_id bigint, component string, run_at timestamp, documents bigint, present bigint, matches bigint, run_id string"
    return spark.read.schema(kinds).parquet(f"{root}/catalogue").select(*RUN_KEY, "component", "run_at", "documents", "present", "matches")


def load_runs(spark: SparkSession, root: str, tournament_id: int | None = None, season_id: int | None = None, run_ids: list[str] | None = None) -> DataFrame:
    """Documents of stored runs; only the folders asked for are read."""
    out = spark.read.schema(RUN).parquet(f"{root}/runs")
    for name, value in (("tournament_id", tournament_id), ("season_id", season_id)):
        out = out if value is None else out.where(F.col(name) == value)
    return out if run_ids is None else out.where(F.col("run_id").isin(*run_ids))


@dataclass(frozen=True)
class Rule:
    """What a valid document of a component must have beyond its contract.  Where ``holds``
    has an attribute ``shape``, it looks only at these members: there or not, arrays' sizes."""

    required: bool
    holds: Callable[[Column], Column]
    active: bool = True


def at_least(n: int, *paths: str) -> Callable[[Column], Column]:
    """Each array has ``n`` elements or more."""

    def holds(doc: Column) -> Column:
        out = F.lit(True)
        for path in paths:
            value = doc
            for name in path.split("."):
                value = value[name]
            out = out & (F.coalesce(F.size(value), F.lit(0)) >= n)
        return out

    holds.shape = paths
    return holds


def present(*names: str) -> Callable[[Column], Column]:
    """Fields of the event that must not be null."""

    def holds(doc: Column) -> Column:
        out = F.lit(True)
        for name in names:
            out = out & doc["event"][name].isNotNull()
        return out

    holds.shape = tuple(f"event.{name}" for name in names)
    return holds


# The rules of the five components.
RULES = {
    "base": Rule(True, present("homeTeam", "awayTeam", "status", "startTimestamp")),
    "stats": Rule(True, at_least(1, "statistics")),
    "lineup": Rule(True, at_least(11, "home.players", "away.players")),
    "incidents": Rule(False, at_least(0, "incidents")),
    "graph": Rule(False, at_least(5, "graphPoints")),
}
CONTRACT_OF = {"lineup": "lineups"}


def configured(rules: dict[str, Rule] = RULES, active: list[str] | None = None, **changed: Rule) -> dict[str, Rule]:
    """``rules`` with some replaced, and only those of ``active`` components in force."""
    return {k: replace(r, active=r.active and (active is None or k in active)) for k, r in (rules | changed).items()}


def assess(docs: dict[str, DataFrame], rules: dict[str, Rule] = RULES) -> DataFrame:
    """match_id, component, state, required of each document (entity_id,
    payload) of the active components: missing, error, valid or invalid."""
    out = None
    for component, frame in docs.items():
        rule = rules[component]
        if not rule.active:
            continue
        good = holding(CONTRACTS[CONTRACT_OF.get(component, component)], rule.holds, shape=getattr(rule.holds, "shape", None))
        state = F.when(F.col("payload").isNull(), "missing").when(enveloped(F.col("payload")), "error").when(good, "valid").otherwise("invalid")
        one = once(frame, state=state).select(F.col("entity_id").alias("match_id"), F.lit(component).alias("component"), "state", F.lit(rule.required).alias("required"))
        out = one if out is None else out.union(one)
    if out is None:
        raise ValueError("no active component")
    return out


def match_verdicts(states: DataFrame, rules: dict[str, Rule] = RULES) -> DataFrame:
    """match_id, components, valid, lacking, complete: complete is a match all of
    whose required active components are valid; one without a document lacks."""
    needed = sorted(k for k, r in rules.items() if r.required and r.active)
    names = F.array(*map(F.lit, needed)) if needed else F.array().cast("array<string>")
    have = F.collect_set(F.when((F.col("state") == "valid") & F.col("required"), F.col("component")))
    per = states.groupBy("match_id").agg(F.count("*").alias("components"), F.count_if(F.col("state") == "valid").alias("valid"), F.array_except(names, have).alias("lacking"))
    return per.withColumn("complete", F.size("lacking") == 0)


def compare_runs(fps: DataFrame, one: str, other: str) -> DataFrame:
    """match_id, component, equal: both missing is equal, one missing is not."""
    pick = lambda run: F.max(F.when(F.col("run_id") == run, F.col("fp")))
    both = fps.where(F.col("run_id").isin(one, other)).groupBy("match_id", "component").agg(pick(one).alias("x"), pick(other).alias("y"))
    return both.select("match_id", "component", F.col("x").eqNullSafe(F.col("y")).alias("equal"))


def groups(fps: DataFrame) -> DataFrame:
    """Runs with the same data: match_id, component, fp, size, runs in order of time."""
    runs = F.transform(F.array_sort(F.collect_list(F.struct("run_at", "run_id"))), lambda r: r["run_id"])
    return fps.groupBy("match_id", "component", "fp").agg(F.count("*").alias("size"), runs.alias("runs"))


def consensus(grouped: DataFrame, threshold: float = 1.0, min_runs: int = 2) -> DataFrame:
    """Per match and component the largest group, whether it reaches the
    threshold, and which runs agree or don't."""
    w = Window.partitionBy("match_id", "component")
    ranked = grouped.withColumn("rank", F.row_number().over(w.orderBy(F.desc("size"), F.col("fp").isNull(), "fp"))).withColumn("total", F.sum("size").over(w)).withColumn("every", F.flatten(F.collect_list("runs").over(w)))
    best = ranked.where("rank = 1")
    reached = (F.col("size") >= threshold * F.col("total")) & (F.col("total") >= min_runs) & F.col("fp").isNotNull()
    return best.select("match_id", "component", "fp", "size", "total", reached.alias("has_consensus"), F.col("runs").alias("agreeing"), F.array_sort(F.array_except("every", "runs")).alias("disagreeing"))


def season(found: DataFrame) -> DataFrame:
    """Per match: components, with consensus, all of them, ready for golden."""
    return found.groupBy("match_id").agg(F.count("*").alias("components"), F.count_if("has_consensus").alias("agreed"), F.bool_and("has_consensus").alias("full_consensus"), (F.bool_and("has_consensus") & F.bool_or(F.col("component") == "stats")).alias("ready_for_golden"))


def retry_candidates(found: DataFrame, attempts: DataFrame, max_attempts: int = 2) -> DataFrame:
    """match_id, components lacking consensus whose attempts aren't used up."""
    lacking = found.where("not has_consensus").join(attempts, ["match_id", "component"], "left").where(F.coalesce("attempts", F.lit(0)) < max_attempts)
    return lacking.groupBy("match_id").agg(F.array_sort(F.collect_list("component")).alias("components"))


def summary(found: DataFrame) -> DataFrame:
    """Per component: totals, rate, and its rank by problems."""
    per = found.groupBy("component").agg(F.count("*").alias("matches"), F.count_if("has_consensus").alias("agreed"))
    per = per.withColumn("rate", F.round(F.col("agreed") / F.col("matches"), 4))
    return per.withColumn("problem_rank", F.rank().over(Window.orderBy("rate", "component")))  # one row a component


def season_state(captured: DataFrame, found: DataFrame, calendar: DataFrame) -> DataFrame:
    """How far each season is: its runs and when the last one was, matches that
    runs hold, components with consensus, and matches ready for the golden set.
    ``captured`` (match_id, run_id, run_at) needs no fingerprints."""
    of = calendar.select("match_id", "tournament_id", "season_id")
    runs = captured.join(of, "match_id").groupBy("tournament_id", "season_id").agg(F.countDistinct("run_id").alias("runs"), F.max("run_at").alias("last_run_at"))
    matches = season(found).join(of, "match_id").groupBy("tournament_id", "season_id").agg(F.count("*").alias("matches"), F.sum("components").alias("components"), F.sum("agreed").alias("agreed"), F.count_if("ready_for_golden").alias("golden"))
    return runs.join(matches, ["tournament_id", "season_id"])


def golden(found: DataFrame, fps: DataFrame) -> DataFrame:
    """Consensus data of each match and component from the agreeing run of the earliest time."""
    agreed = found.where("has_consensus").select("match_id", "component", "fp")
    first = F.min_by(F.struct("run_id", "run_at", "payload"), F.struct("run_at", "run_id"))
    picked = fps.join(agreed, ["match_id", "component", "fp"]).groupBy("match_id", "component").agg(first.alias("first"))
    return picked.select("match_id", "component", F.col("first.run_id").alias("source_run"), "first.run_at", "first.payload")


def golden_matches(picked: DataFrame, components: int) -> DataFrame:
    """One row a match: source runs as text and completeness."""
    runs = F.array_sort(F.collect_list(F.struct("component", "source_run")))
    return picked.groupBy("match_id").agg(F.array_join(F.transform(runs, lambda r: F.concat_ws("=", r["component"], r["source_run"])), ",").alias("sources"), F.round(F.count("*") / components, 4).alias("completeness"))


def quality_score(states: DataFrame, weights: dict[str, float] = WEIGHTS) -> DataFrame:
    """Weighted share of valid components."""
    w = F.coalesce(F.element_at(F.create_map(*(x for k, v in weights.items() for x in (F.lit(k), F.lit(v)))), F.col("component")), F.lit(0.0))
    return states.groupBy("match_id").agg(F.round(F.sum(F.when(F.col("state") == "valid", w).otherwise(0.0)) / F.sum(w), 4).alias("quality_score"))


def workflow(runs: DataFrame, contracts: dict[str, Contract], attempts: DataFrame) -> DataFrame:
    """Runs to consensus to retries: one row a match, with whether a person must look."""
    found = consensus(groups(with_fingerprints(runs, contracts)))
    retry = retry_candidates(found, attempts)
    out = season(found).drop("components").join(retry, "match_id", "left")
    return out.select("match_id", "full_consensus", F.coalesce(F.array_join("components", ","), F.lit("")).alias("retry"), F.col("components").isNotNull().alias("needs_manual_review"))


def review_report(fps: DataFrame, component: str, contract: Contract) -> DataFrame:
    """Paths in which other runs differ from the largest group of equal ones; of
    several largest the one with the earliest run leads."""
    own = fps.where((F.col("component") == component) & F.col("fp").isNotNull())
    groups = own.groupBy("match_id", "fp").agg(F.count("*").alias("size"), F.min(F.struct("run_at", "run_id")).alias("first"), F.any_value("data").alias("data"))
    lead = groups.groupBy("match_id").agg(F.min_by(F.struct("data", "fp"), F.struct(-F.col("size"), "first")).alias("lead")).select("match_id", F.col("lead.data").alias("lead"), F.col("lead.fp").alias("lead_fp"))
    kind = typed(contract.fields)
    both = own.join(lead, "match_id").where("fp <> lead_fp").withColumn("a", F.from_json("lead", kind)).withColumn("b", F.from_json("data", kind))
    return both.select("match_id", F.lit(component).alias("component"), "run_id", F.explode(delta("a", "b", both.schema["a"].dataType)).alias("d")).select("match_id", "component", "run_id", "d.path", "d.a", "d.b")
