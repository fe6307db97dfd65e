"""Match and season summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Components in the order of reports; odds don't count as errors.
ORDER = ("base", "stats", "lineup", "incidents", "graph")


def component_flags(status: DataFrame) -> DataFrame:
    """match_id, has_<component>: a component is there when it succeeded."""
    return status.groupBy("match_id").agg(*(F.coalesce(F.bool_or((F.col("component_name") == c) & (F.col("status") == "SUCCESS")), F.lit(False)).alias(f"has_{c}") for c in (*ORDER, "odds")))


def component_errors(status: DataFrame) -> DataFrame:
    """match_id, successful, failed (in report order), has_errors, and from when to when attempts were made."""
    rank = F.array_position(F.array(*map(F.lit, ORDER)), F.col("component_name"))
    named = lambda ok: F.transform(F.array_sort(F.collect_list(F.when(ok & (rank > 0), F.struct(rank.alias("r"), F.col("component_name").alias("c"))))), lambda x: x["c"])
    good = F.col("status") == "SUCCESS"
    out = status.groupBy("match_id").agg(named(good).alias("successful"), named(~good).alias("failed"), F.min("first_attempted_at").alias("began"), F.max("last_attempted_at").alias("ended"))
    return out.withColumn("has_errors", F.size("failed") > 0)


def success_rate(successful: Column, failed: Column) -> Column:
    return F.concat_ws("/", F.size(successful).cast("string"), (F.size(successful) + F.size(failed)).cast("string"))


def error_text(failed: Column) -> Column:
    return F.when(F.size(failed) > 0, F.concat(F.lit("Failed components: "), F.array_join(failed, ", "))).otherwise("No errors")


def match_info(flat: DataFrame) -> DataFrame:
    """Names, 'h-a' with 0 for a missing score, status and venue."""
    score = F.concat_ws("-", F.coalesce("home_score", F.lit(0)).cast("string"), F.coalesce("away_score", F.lit(0)).cast("string"))
    return flat.select("match_id", "home_team", "away_team", score.alias("score"), F.col("status_text").alias("status"), "venue")


def in_season(errors: DataFrame, calendar: DataFrame) -> DataFrame:
    """Matches with their tournament and season; null for those that no calendar has."""
    return errors.join(calendar.select("match_id", "tournament_id", "season_id"), "match_id", "left")


def season_totals(errors: DataFrame, calendar: DataFrame) -> DataFrame:
    """tournament_id, season_id, matches, with and without errors, failed
    components, and seconds from the first attempt to the last one."""
    length = F.unix_seconds(F.max("ended").cast("timestamp")) - F.unix_seconds(F.min("began").cast("timestamp"))
    return in_season(errors, calendar).groupBy("tournament_id", "season_id").agg(F.count("*").alias("total"), F.count_if(~F.col("has_errors")).alias("successful"), F.count_if("has_errors").alias("failed"), F.sum(F.size("failed")).alias("failed_components"), length.alias("duration_seconds"))


def season_failures(errors: DataFrame, calendar: DataFrame) -> DataFrame:
    """The failed matches of each season, a row each: a season may have any number."""
    return in_season(errors.where("has_errors"), calendar).select("tournament_id", "season_id", "match_id", error_text(F.col("failed")).alias("summary"))


def rate_text(good: Column, total: Column) -> Column:
    """'85.2%' with ties to even, '0%' where there is nothing."""
    return F.when(total == 0, "0%").otherwise(F.concat(F.format_string("%.1f", F.bround(100 * good / total, 1)), F.lit("%")))


def tournament_info(flat: DataFrame) -> DataFrame:
    return flat.select("tournament_id", F.format_string("%s (%s) - %s [%d]", "name", "country", "sport", "tournament_id").alias("info"))


def odds_lines(odds: DataFrame) -> DataFrame:
    """Full-time 1, X, 2 and Under 0.5, 1.5, 2.5 of each match, 'N/A' if missing."""
    price = F.concat_ws("/", F.col("num").cast("string"), F.col("den").cast("string"))
    pick = lambda ok: F.coalesce(F.min(F.when(ok, price)), F.lit("N/A"))
    full = F.col("market_name") == "Full time"
    goals = (F.col("market_name") == "Match goals") & (F.col("choice_name") == "Under")
    return odds.groupBy("match_id").agg(*(pick(full & (F.col("choice_name") == n)).alias(f"full_time_{n.lower()}") for n in ("1", "X", "2")), *(pick(goals & (F.col("choice_group") == g)).alias(f"under_{g.replace('.', '_')}") for g in ("0.5", "1.5", "2.5")))


def status_counts(calendar: DataFrame) -> DataFrame:
    return calendar.groupBy("season_id").agg(F.count_if(F.col("status_code") == 100).alias("ended"), F.count_if(F.col("status_code") != 100).alias("other"))


def stat_values(stats: DataFrame) -> DataFrame:
    return stats.groupBy("stat_key", "period").agg(F.round(F.avg("home_value"), 4).alias("home_avg"), F.round(F.sum("home_value"), 2).alias("home_sum"), F.round(F.avg("away_value"), 4).alias("away_avg"), F.round(F.sum("away_value"), 2).alias("away_sum"), F.count("*").alias("n"))


def run_stat_diff(one: DataFrame, other: DataFrame) -> DataFrame:
    """Items of two runs side by side, those that differ or only one has."""
    key = ["match_id", "period", "group_name", "stat_key"]
    side = lambda df, n: df.select(*key, F.col("home_value").alias(f"home_{n}"), F.col("away_value").alias(f"away_{n}"))
    both = side(one, 1).join(side(other, 2), key, "full_outer")
    return both.where(~(F.col("home_1").eqNullSafe(F.col("home_2")) & F.col("away_1").eqNullSafe(F.col("away_2"))))
