"""Flat rows from parsed documents: one function a component.

Each takes validated rows (entity_id, payload, parsed, ...) and returns the
table's rows.  Everything is a projection or an explode: no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import epoch_utc, safe_get
from ..functions.validate import normalise_status


def raw_elements(path: str) -> Column:
    """The elements of an array of the payload as JSON texts."""
    return F.from_json(F.get_json_object("payload", path), "array<string>")


def zipped(df: DataFrame, parsed: str, path: str, names: tuple[str, str]) -> DataFrame:
    """One row an element, with its position, parsed form and raw text.  The
    arrays aren't zipped: texts that nobody asks for are never made."""
    every = df.withColumn("_raw", raw_elements(path)).select("*", F.posexplode(parsed).alias("pos", names[0]))
    return every.withColumn(names[1], F.get("_raw", "pos")).drop("_raw")


def tournaments(df: DataFrame) -> DataFrame:
    t = F.col("parsed.tournament")
    return df.select(t["id"].alias("tournament_id"), t["name"].alias("name"), t["category"]["sport"]["slug"].alias("sport"), t["category"]["name"].alias("country"), F.col("payload").alias("raw"))


def seasons(df: DataFrame) -> DataFrame:
    one = zipped(df.select("entity_id", "payload", "parsed"), "parsed.seasons", "$.seasons", ("season", "raw"))
    return one.select(F.col("season.id").alias("season_id"), F.col("entity_id").alias("tournament_id"), "season.year", "season.name", "raw")


def events(df: DataFrame) -> DataFrame:
    """Calendar rows; an event without a season is marked in ``error``."""
    one = zipped(df.select("entity_id", "payload", "parsed"), "parsed.events", "$.events", ("event", "raw")).withColumn("event", normalise_status(F.col("event")))
    e = F.col("event")
    flag = lambda n: F.coalesce(e[n], F.lit(False))
    return one.select(
        e["id"].alias("match_id"), e["season"]["id"].alias("season_id"), e["tournament"]["id"].alias("tournament_id"), e["slug"].alias("slug"), e["homeTeam"]["slug"].alias("home_slug"), e["awayTeam"]["slug"].alias("away_slug"),
        e["roundInfo"]["round"].alias("round"), e["status"]["type"].alias("status_type"), e["status"]["code"].alias("status_code"), e["startTimestamp"].alias("start_timestamp"), e["winnerCode"].alias("winner_code"),
        flag("hasGlobalHighlights").alias("has_global_highlights"), flag("hasXg").alias("has_xg"), flag("hasEventPlayerStatistics").alias("has_player_statistics"), flag("hasEventPlayerHeatMap").alias("has_player_heat_map"),
        "raw", F.when(e["season"].isNull(), "season missing").alias("error"),
    )


def match(df: DataFrame) -> DataFrame:
    e = F.col("event")
    one = df.select("entity_id", "payload", normalise_status(F.col("parsed.event")).alias("event"))
    return one.select(
        e["id"].alias("match_id"), e["season"]["id"].alias("season_id"), e["tournament"]["id"].alias("tournament_id"), e["slug"].alias("slug"), epoch_utc(e["startTimestamp"]).alias("start_time"), e["status"]["type"].alias("status_type"),
        e["status"]["description"].alias("status_text"), e["winnerCode"].alias("winner_code"), e["roundInfo"]["round"].alias("round"), e["homeTeam"]["name"].alias("home_team"), e["awayTeam"]["name"].alias("away_team"),
        safe_get(e["homeScore"], "current").alias("home_score"), safe_get(e["awayScore"], "current").alias("away_score"), safe_get(e["homeScore"], "period1").alias("home_score_ht"), safe_get(e["awayScore"], "period1").alias("away_score_ht"),
        e["homeTeam"]["slug"].alias("home_slug"), e["awayTeam"]["slug"].alias("away_slug"), safe_get(e["homeTeam"]["manager"], "name").alias("home_manager"), safe_get(e["awayTeam"]["manager"], "name").alias("away_manager"), e["venue"]["name"].alias("venue"), e["venue"]["city"]["name"].alias("venue_city"),
        *(e[f"{side}Team"]["venue"]["name"].alias(f"{side}_venue") for side in ("home", "away")), *(e[f"{side}Team"]["venue"]["city"]["name"].alias(f"{side}_venue_city") for side in ("home", "away")),
        safe_get(e["referee"], "name").alias("referee"), e["attendance"].alias("attendance"), *(safe_get(e["time"], f"injuryTime{k}", F.lit(0).cast("long")).alias(f"injury_time{k}") for k in (1, 2)), F.col("payload").alias("raw"),
    )


def statistics(df: DataFrame) -> DataFrame:
    periods = df.select(F.col("entity_id").alias("match_id"), F.explode("parsed.statistics").alias("p"))
    groups = periods.select("match_id", F.col("p.period").alias("period"), F.explode("p.groups").alias("g"))
    items = groups.select("match_id", "period", F.col("g.groupName").alias("group_name"), F.explode("g.statisticsItems").alias("i"))
    return items.select(
        "match_id", "period", "group_name", F.col("i.key").alias("stat_key"), F.col("i.name").alias("name"), F.col("i.home").alias("home"), F.col("i.away").alias("away"), F.col("i.compareCode").alias("compare_code"),
        F.col("i.statisticsType").alias("statistics_type"), F.col("i.valueType").alias("value_type"), F.col("i.homeValue").alias("home_value"), F.col("i.awayValue").alias("away_value"), F.col("i.renderType").alias("render_type"),
        F.col("i.homeTotal").alias("home_total"), F.col("i.awayTotal").alias("away_total"),
    )


#: Line-up statistics that have a column of their own.
PROMOTED = {"goals": "goals", "goalAssist": "assists", "minutesPlayed": "minutes_played", "rating": "rating", "expectedGoals": "expected_goals", "expectedAssists": "expected_assists"}
#: Those that are 0 for a player without a statistics object; the others are null there.
ZERO = ("goals", "minutesPlayed")


def lineups(df: DataFrame) -> DataFrame:
    """Home then away players; of a player without a statistics object
    goals and minutes are 0 and the other promoted statistics null."""
    side = lambda name: F.transform(F.coalesce(F.col(f"parsed.{name}.players"), F.array().cast(df.schema["parsed"].dataType[name].dataType["players"].dataType)), lambda p: F.struct(F.lit(name).alias("side"), p.alias("p")))
    one = df.select(F.col("entity_id").alias("match_id"), F.posexplode(F.concat(side("home"), side("away"))).alias("seq", "x")).select("match_id", "seq", "x.side", "x.p")
    stats = F.col("p.statistics")
    kept = {k: safe_get(stats, k, F.lit(0).cast("long") if k in ZERO else None).alias(v) for k, v in PROMOTED.items()}
    return one.select(
        "match_id", F.col("p.player.id").alias("player_id"), "side", "seq", F.col("p.teamId").alias("team_id"), F.col("p.player.name").alias("player_name"), F.col("p.player.slug").alias("player_slug"), F.coalesce(F.nullif(F.col("p.position"), F.lit("")), F.col("p.player.position")).alias("position"),
        F.col("p.shirtNumber").alias("shirt_number"), F.col("p.substitute").alias("substitute"), F.col("p.captain").alias("captain"), *kept.values(), F.to_json(stats).alias("statistics"),
    )


#: Incident types without the field at all: there its default stands, elsewhere an absent value stays null.
NO_ADDED_TIME = ("card", "goal", "varDecision", "inGamePenalty")
NO_SIDE = ("period", "injuryTime")


def incidents(df: DataFrame) -> DataFrame:
    one = zipped(df.select("entity_id", "payload", "parsed"), "parsed.incidents", "$.incidents", ("i", "data"))
    kind = F.col("i.incidentType")
    added = F.when(kind.isin(*NO_ADDED_TIME), F.lit(0).cast("long")).otherwise(F.col("i.addedTime"))
    home = F.when(kind.isin(*NO_SIDE), F.lit(False)).otherwise(F.col("i.isHome"))
    return one.select(F.col("entity_id").alias("match_id"), F.col("pos").alias("seq"), kind.alias("incident_type"), F.col("i.time").alias("time"), added.alias("added_time"), home.alias("is_home"), "data")


def graph(df: DataFrame) -> DataFrame:
    points = F.col("parsed.graphPoints")
    return df.select(F.col("entity_id").alias("match_id"), F.col("parsed.periodTime").alias("period_time"), F.col("parsed.overtimeLength").alias("overtime_length"), F.col("parsed.periodCount").alias("period_count"), F.when(F.size(points) > 0, F.to_json(points)).alias("points"))


def graph_points(stored: DataFrame) -> DataFrame:
    """The long form of the stored series."""
    return stored.select("match_id", F.inline(F.from_json("points", "array<struct<minute:double,value:bigint>>")))


def odds(df: DataFrame) -> DataFrame:
    raw = F.col("raw_markets") if "raw_markets" in df.columns else raw_elements("$.markets")
    # not zipped, as above
    every = df.select("entity_id", "parsed", raw.alias("_raw")).select("entity_id", "_raw", F.posexplode("parsed.markets").alias("pos", "m"))
    one = every.select(F.col("entity_id").alias("match_id"), "m", F.get("_raw", "pos").alias("raw"), F.explode("m.choices").alias("c"))
    return one.select(
        "match_id", F.col("m.marketId").alias("market_id"), F.col("m.marketName").alias("market_name"), F.col("m.isLive").alias("is_live"), F.col("m.suspended").alias("suspended"), F.coalesce(F.nullif(F.col("m.choiceGroup"), F.lit("")), F.lit("default")).alias("choice_group"), F.col("c.name").alias("choice_name"),
        F.col("c.initialFractionalValue.num").alias("initial_num"), F.col("c.initialFractionalValue.den").alias("initial_den"), F.col("c.fractionalValue.num").alias("num"), F.col("c.fractionalValue.den").alias("den"),
        F.col("c.winning").alias("winning"), F.col("c.change").alias("change"), "raw",
    )


def flat_record(df: DataFrame, column: str, keys: dict[str, str]) -> DataFrame:
    """Primitive members of a struct column, and foreign keys by dotted path;
    with its JSON form, which leaves out nulls."""
    kind = df.schema[column].dataType
    own = [F.col(f"{column}.{f.name}").alias(f.name) for f in kind.fields if f.dataType.simpleString().split("<")[0] not in ("struct", "array", "map")]
    own += [F.col(f"{column}.{path}").alias(name) for name, path in keys.items()]
    out = df.select(*own)
    return out.withColumn("record", F.to_json(F.struct(*out.columns)))
