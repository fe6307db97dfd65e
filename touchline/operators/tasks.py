"""Task planning and the task state machine, set-based."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import keyed_upsert, last_by_key

RETRYING = ("API_ERROR", "QA_MISMATCH")
OPEN = ("PENDING", *RETRYING)
#: Prerequisite of a component, over the columns of the calendar.
PREREQUISITES: dict[str, Callable[[], Column]] = {"graph": lambda: F.col("has_player_heat_map")}


def finished(calendar: DataFrame, season: int | None = None, limit: int | None = None) -> DataFrame:
    out = calendar.where(F.lower("status_type") == "finished")
    out = out.where(F.col("season_id") == season) if season is not None else out
    out = out.select("match_id", "season_id", "has_xg", "has_player_heat_map")
    return out.orderBy("match_id").limit(limit) if limit else out


def missing(done: DataFrame, audit: DataFrame, component: str) -> DataFrame:
    have = audit.where(F.col("component_name") == component).select("match_id")
    return done.join(have, "match_id", "left_anti")


def prerequisite(component: Column) -> Column:
    out = F.lit(True)
    for name, rule in PREREQUISITES.items():
        out = F.when(component == name, F.coalesce(rule(), F.lit(False))).otherwise(out)
    return out


def status_of(ok: Column, strict: bool = True) -> Column:
    return F.when(ok | F.lit(not strict), "PENDING").otherwise("SKIPPED_MISSING")


def queue_component(calendar: DataFrame, audit: DataFrame, component: str, limit: int | None = None, strict: bool = True) -> DataFrame:
    """New audit rows of a component: the limit counts after the anti-join."""
    todo = missing(finished(calendar), audit, component)
    todo = todo.orderBy("match_id").limit(limit) if limit else todo
    return todo.select("match_id", F.lit(component).alias("component_name"), status_of(prerequisite(F.lit(component)), strict).alias("status"), F.lit(0).alias("retry_count"))


def queue_components(calendar: DataFrame, audit: DataFrame, components: list[str], strict: bool = True) -> DataFrame:
    """New audit rows of all components: each match is exploded to the fixed
    component list, then one anti-join."""
    every = finished(calendar).select("*", F.explode(F.array(*map(F.lit, components))).alias("component_name"))
    todo = every.join(audit.select("match_id", "component_name"), ["match_id", "component_name"], "left_anti")
    return todo.select("match_id", "component_name", status_of(prerequisite(F.col("component_name")), strict).alias("status"), F.lit(0).alias("retry_count"))


def queued_by_component(new: DataFrame, components: list[str]) -> DataFrame:
    """component_name, queued (skipped ones don't count), 0 where there is none."""
    names = new.sparkSession.createDataFrame([(c,) for c in components], "component_name string")
    counts = new.groupBy("component_name").agg(F.count_if(F.col("status") == "PENDING").alias("queued"))
    return F.broadcast(names).join(counts, "component_name", "left").select("component_name", F.coalesce("queued", F.lit(0)).alias("queued"))


def pending_batch(audit: DataFrame, n: int, max_retries: int = 3) -> DataFrame:
    """The next tasks, the lowest audit ids first: a top-k, not a full sort."""
    return audit.where(F.col("status").isin(*OPEN) & (F.col("retry_count") < max_retries)).orderBy("audit_id").limit(n)


def apply_outcomes(audit: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Audit after one outcome a task: a retry counts, success clears the
    message, no new message keeps the old one."""
    o = outcomes.select("match_id", "component_name", F.col("outcome"), F.col("message"))
    out = audit.join(o, ["match_id", "component_name"], "left")
    return out.select(
        *(c for c in audit.columns if c not in ("status", "retry_count", "error_message")), F.coalesce("outcome", "status").alias("status"),
        (F.col("retry_count") + F.col("outcome").isin(*RETRYING).cast("int").eqNullSafe(F.lit(1)).cast("int")).alias("retry_count"),
        F.when(F.col("outcome") == "SUCCESS", None).otherwise(F.coalesce("message", "error_message")).alias("error_message"),
    )


def fold_attempts(attempts: DataFrame, max_retries: int = 3) -> DataFrame:
    """State of each task after its attempts in order: attempts after success,
    after unavailability or after ``max_retries`` retrying failures don't count."""
    key = ["match_id", "component_name"]
    earlier = Window.partitionBy(*key).orderBy("attempted_at", "attempt_id").rowsBetween(Window.unboundedPreceding, -1)
    retrying = F.col("outcome").isin(*RETRYING)
    live = attempts.withColumn("failures", F.coalesce(F.sum(retrying.cast("int")).over(earlier), F.lit(0))).withColumn("ended", F.coalesce(F.max((~retrying).cast("int")).over(earlier), F.lit(0)))
    live = live.where((F.col("failures") < max_retries) & (F.col("ended") == 0))
    order = F.struct("attempted_at", "attempt_id")
    last = F.max_by("outcome", order)
    message = F.max_by("message", F.when(F.col("message").isNotNull(), order))
    return live.groupBy(*key).agg(last.alias("status"), F.count_if(retrying).cast("int").alias("retry_count"), F.when(last != "SUCCESS", message).alias("error_message"), F.min("attempted_at").alias("first_attempted_at"), F.max("attempted_at").alias("last_attempted_at"), F.count("*").alias("attempts"))


def retry_sweep(audit: DataFrame, scope: DataFrame | None = None, allowed: tuple[str, ...] = RETRYING, max_retries: int = 3) -> DataFrame:
    """``audit`` with ``reset``: rows that go back to PENDING (counts and
    messages stay), within the matches of ``scope`` if it is given."""
    hit = F.col("status").isin(*allowed) & (F.col("retry_count") < max_retries)
    out = audit
    if scope is not None:
        out = out.join(scope.select("match_id").distinct().withColumn("in_scope", F.lit(True)), "match_id", "left")
        hit = hit & F.coalesce("in_scope", F.lit(False))
    return out.withColumn("reset", hit).withColumn("status", F.when(hit, "PENDING").otherwise(F.col("status"))).select(*audit.columns, "reset")


def calendar_delta(incoming: DataFrame, stored: DataFrame) -> DataFrame:
    """Matches that are finished now and weren't in the store."""
    return finished(incoming).select("match_id", "season_id").join(finished(stored).select("match_id"), "match_id", "left_anti")


def recent_seasons(seasons: DataFrame, n: int) -> DataFrame:
    """The n latest seasons of each tournament; years sort as text."""
    w = Window.partitionBy("tournament_id").orderBy(F.desc("year"), F.desc("season_id"))
    return seasons.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def season_backfill(incoming: DataFrame, stored: DataFrame, audit: DataFrame, components: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Brings the calendar up to date and queues what is finished, for all seasons at once.

    Gives the calendar after the sync (``incoming`` rows win, of several of a
    match a finished one, then the last by all columns; other ``stored`` ones
    stay), the new audit rows, and by tournament and season, with totals
    (null: all), fetched, inserted and updated matches, those that are newly
    finished, and queued and skipped tasks.
    """
    incoming = last_by_key(incoming.select(*stored.columns), ["match_id"], [F.lower("status_type").eqNullSafe("finished"), F.struct(*stored.columns)])
    calendar = keyed_upsert(stored, incoming, ["match_id"], [F.col("status_type")])
    new = queue_components(calendar, audit, components)
    tasks = new.groupBy("match_id").agg(F.count_if(F.col("status") == "PENDING").alias("queued"), F.count_if(F.col("status") != "PENDING").alias("skipped"))
    before = stored.select("match_id", F.struct(*(c for c in stored.columns if c != "match_id")).alias("before"))
    each = incoming.select("match_id", F.struct(*(c for c in stored.columns if c != "match_id")).alias("now")).join(before, "match_id", "left")
    done = lambda x: F.coalesce(F.lower(F.col(x)["status_type"]) == "finished", F.lit(False))
    flags = each.select("match_id", F.col("before").isNull().alias("inserted"), (F.col("before").isNotNull() & (F.col("before") != F.col("now"))).alias("updated"), (done("now") & ~done("before")).alias("newly"))
    every = calendar.select("match_id", "tournament_id", "season_id").join(flags, "match_id", "left").join(tasks, "match_id", "left")
    sums = [F.count("inserted").alias("fetched"), F.count_if("inserted").alias("inserted"), F.count_if("updated").alias("updated"), F.count_if("newly").alias("newly_finished")]
    sums += [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("queued", "skipped")]
    return calendar, new, every.rollup("tournament_id", "season_id").agg(*sums)


def batch_progress(audit: DataFrame, max_retries: int = 3) -> DataFrame:
    """One row: tasks, completed, succeeded, and whether work is left."""
    left = F.count_if(F.col("status").isin(*OPEN) & (F.col("retry_count") < max_retries))
    return audit.agg(F.count("*").alias("tasks"), F.count_if(~F.col("status").isin(*OPEN)).alias("completed"), F.count_if(F.col("status") == "SUCCESS").alias("succeeded"), left.alias("pending_total"), (left > 0).alias("work_left"))
