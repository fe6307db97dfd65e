"""Payload documents made from the given tables, as Spark expressions.

Input for queries and tests: each table of base rows becomes the JSON documents
that a capture would have landed, so operators are exercised end to end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.contracts import Contract
from ..functions.scalars import let

#: A document of a list holds the ids of a range of 2 to the power of this, whatever the input's size.
PAGE_BITS = 14
#: A total order of an order's line items.
LINE_ORDER = ("l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice", "l_shipdate")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def s(**fields) -> Column:
    return F.struct(*((v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()))


def sport() -> Column:
    return s(name="Football", slug="football", id=1)


def tournament(prefix: str = "") -> Column:
    """Of columns n_nationkey, n_name, r_regionkey, r_name."""
    category = s(name=F.col("r_name"), id=F.col("r_regionkey"), slug=F.lower("r_name"), sport=sport())
    return s(id=F.col("n_nationkey"), name=F.col("n_name"), slug=F.lower("n_name"), category=category)


def nations(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "nation").join(F.broadcast(table(spark, sf, "region")), F.col("n_regionkey") == F.col("r_regionkey"))


def enc_tournament(spark: SparkSession, sf: str) -> DataFrame:
    return nations(spark, sf).select(F.col("n_nationkey").cast("long").alias("entity_id"), F.to_json(s(tournament=tournament())).alias("payload"))


def season_id(nation: Column, year: Column) -> Column:
    return nation.cast("long") * 10000 + year


def placed(spark: SparkSession, sf: str) -> DataFrame:
    """Orders with their customer, nation and region."""
    customers = table(spark, sf, "customer").join(F.broadcast(nations(spark, sf)), F.col("c_nationkey") == F.col("n_nationkey"))
    return table(spark, sf, "orders").join(customers, F.col("o_custkey") == F.col("c_custkey")).withColumn("year", F.year("o_orderdate"))


def matches(spark: SparkSession, sf: str) -> DataFrame:
    """``placed``, dealt out by the order after the join: where Spark broadcasts
    one side the other's partitions, which may be one, would hold all documents."""
    return by(placed(spark, sf), "o_orderkey")


def season() -> Column:
    two = lambda y: F.lpad((y % 100).cast("string"), 2, "0")
    return s(name=F.concat(F.lit("Season "), F.col("year").cast("string")), id=season_id(F.col("n_nationkey"), F.col("year")), year=F.concat(two(F.col("year")), F.lit("/"), two(F.col("year") + 1)))


def enc_seasons(spark: SparkSession, sf: str) -> DataFrame:
    one = placed(spark, sf).select("n_nationkey", "year").distinct()
    return one.groupBy("n_nationkey").agg(F.sort_array(F.collect_list(season())).alias("seasons")).select(F.col("n_nationkey").cast("long").alias("entity_id"), F.to_json(s(seasons=F.col("seasons"))).alias("payload"))


def team(name: Column, country: Column, extra: dict | None = None) -> Column:
    colours = s(primary="#111111", secondary="#222222", text="#333333")
    return s(name=name, slug=F.lower(name), nameCode=F.upper(F.substring(name, -3, 3)), gender="M", sport=sport(), country=s(name=country), teamColors=colours, **(extra or {}))


def event(base: bool) -> Column:
    """One match of ``matches``; the base document has venue, referee and staff."""
    played, cents = F.col("o_orderstatus") == "F", F.floor(F.col("o_totalprice")).cast("long")
    home, away = (cents % 5).cast("int"), (F.floor(cents / 10) % 4).cast("int")
    status = F.when(played, s(code=100, description="Ended", type="finished")).when(F.col("o_orderstatus") == "O", s(code=0, description="Not started", type="notstarted")).otherwise(s(code=60, description="Postponed", type="postponed"))
    score = lambda x: s(current=F.when(played, x), display=F.when(played, x), period1=F.when(played, (x / 2).cast("int")))
    flag = lambda k: F.when(F.col("o_orderkey") % k != 1, F.col("o_orderkey") % k == 0)  # noqa: E731  absent for one residue
    fields = dict(
        slug=F.concat(F.lower("c_name"), F.lit("-"), F.lower("n_name")), id=F.col("o_orderkey"), startTimestamp=F.when(F.col("o_orderkey") % 10 == 3, 0).otherwise(F.unix_timestamp("o_orderdate")),
        status=status, time=s(injuryTime1=F.when(played & (F.col("o_orderkey") % 3 == 0), F.lit(2))), tournament=tournament(), season=season(), roundInfo=s(round=F.month("o_orderdate")),
        winnerCode=F.when(played, F.when(home > away, 1).when(home < away, 2).otherwise(3)), homeScore=score(home), awayScore=score(away),
        hasGlobalHighlights=flag(5), hasXg=flag(2), hasEventPlayerStatistics=flag(7), hasEventPlayerHeatMap=flag(3),
    )
    slug = lambda x: F.lower(F.replace(x, F.lit(" "), F.lit("-")))
    venue = lambda name, city, number, **more: s(name=name, slug=slug(name), id=number, city=s(name=city), **more)
    manager = lambda who: s(name=F.concat(F.lit("M. "), who), slug=slug(F.concat(F.lit("m-"), who)), shortName=F.concat(F.lit("M. "), F.substring(who, 1, 3)), id=F.col("o_custkey"))
    staff = lambda who: dict(fullName=F.concat(who, F.lit(" FC")), manager=F.when(F.col("o_orderkey") % 4 != 0, manager(who)), venue=venue(F.concat(who, F.lit(" Park")), F.col("n_name"), F.col("o_custkey")), **{"class": F.col("n_nationkey") % 3})
    fields["homeTeam"] = team(F.col("c_name"), F.col("n_name"), staff(F.col("c_name")) if base else None)
    fields["awayTeam"] = team(F.col("n_name"), F.col("n_name"), staff(F.col("n_name")) if base else None)
    if base:
        ref = s(name=F.concat(F.lit("Ref "), F.col("o_orderpriority")), slug=slug(F.concat(F.lit("ref-"), F.col("o_orderpriority"))), id=F.col("o_custkey") % 17, yellowCards=cents % 90, redCards=cents % 7, yellowRedCards=cents % 5, games=cents % 30, sport=sport())
        ground = venue(F.concat(F.col("n_name"), F.lit(" Arena")), F.col("r_name"), F.col("n_nationkey"), capacity=F.lit(50000), venueCoordinates=s(latitude=F.col("n_nationkey") / 2, longitude=F.col("r_regionkey") / 4), stadium=s(name=F.col("n_name"), capacity=50000))
        fields |= dict(attendance=(cents % 50000).cast("int"), venue=ground, referee=F.when(F.col("o_orderkey") % 6 != 0, ref), defaultPeriodCount=2, defaultPeriodLength=45, defaultOvertimeLength=15, currentPeriodStartTimestamp=F.unix_timestamp("o_orderdate"), fanRatingEvent=True, seasonStatisticsType="overall", showTotoPromo=False)
    return s(**fields)


def enc_events(spark: SparkSession, sf: str) -> DataFrame:
    """Calendars of a season, in pages of at most 2 to the power of PAGE_BITS
    matches (by match id): entity_id is the season."""
    one = matches(spark, sf).select(season_id(F.col("n_nationkey"), F.col("year")).alias("entity_id"), F.shiftright("o_orderkey", PAGE_BITS).alias("page"), "o_orderkey", event(False).alias("event"))
    return one.groupBy("entity_id", "page").agg(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", F.to_json("event").alias("event")))), lambda x: x["event"]).alias("events")).select("entity_id", F.concat(F.lit('{"events":['), F.array_join("events", ","), F.lit("]}")).alias("payload"))


def enc_base(spark: SparkSession, sf: str) -> DataFrame:
    return matches(spark, sf).select(F.col("o_orderkey").alias("entity_id"), F.to_json(s(event=event(True))).alias("payload"))


def by(df: DataFrame, key: str) -> DataFrame:
    """Dealt out by ``key`` once; all grouping and joining by it reuses that."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def lines(spark: SparkSession, sf: str) -> DataFrame:
    return by(table(spark, sf, "lineitem"), "l_orderkey")


def per_order(spark: SparkSession, sf: str, grouped: DataFrame) -> DataFrame:
    """All orders with what ``grouped`` (l_orderkey, ...) has of them."""
    return table(spark, sf, "orders").select("o_orderkey").join(grouped, F.col("o_orderkey") == F.col("l_orderkey"), "left")


def enc_odds(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("l_suppkey") % 4
    pick = lambda *v: F.element_at(F.array(*map(F.lit, v)), kind.cast("int") + 1)
    whole = F.col("l_quantity").cast("int").cast("string")
    odds = lambda n: F.when(F.col("l_partkey") % 97 == 0, "N/A").otherwise(F.concat(n, F.lit("/"), F.col("l_linenumber").cast("string")))
    name = F.when(kind == 3, F.when(F.col("l_linestatus") == "O", "Over").otherwise("Under")).when(kind == 2, F.concat(F.lit("(0.5) "), F.col("l_linestatus"))).otherwise(F.col("l_linestatus"))
    choice = s(initialFractionalValue=odds(whole), fractionalValue=odds((F.col("l_quantity") + 1).cast("int").cast("string")), name=name, winning=F.when(F.col("l_returnflag") == "A", "true").when(F.col("l_returnflag") == "R", "yes"), change=(F.col("l_linenumber") % 3 - 1))
    group = F.when(kind == 3, F.element_at(F.array(F.lit("0.5"), F.lit("1.5"), F.lit("2.5"), F.lit(None)), (F.col("l_orderkey") % 4).cast("int") + 1))
    markets = lines(spark, sf).groupBy("l_orderkey", pick(1, 6, 17, 9).alias("marketId"), pick("Full time", "First team to score", "Asian handicap", "Match goals").alias("marketName"), pick("1X2", "First team to score", "Asian handicap", "Match goals").alias("marketGroup"), group.alias("choiceGroup")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct(*LINE_ORDER, choice.alias("choice")))), lambda x: x["choice"]).alias("choices")
    )
    market = F.struct("marketId", "marketName", "marketGroup", F.lit(False).alias("isLive"), F.lit(False).alias("suspended"), "choiceGroup", "choices")
    grouped = markets.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(market), lambda a, b: (a["marketId"] - b["marketId"]).cast("int")).alias("markets"))
    text = F.to_json(s(markets=F.coalesce("markets", F.array().cast(grouped.schema["markets"].dataType)), eventId=F.col("o_orderkey")))
    return per_order(spark, sf, grouped).select(F.col("o_orderkey").alias("entity_id"), F.replace(text, F.lit('"winning":"true"'), F.lit('"winning":true')).alias("payload"))


def enc_stats(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    """Statistics of an order's line items; without ``rows`` of the first of each key alone.
    One grouping gathers an order's items, and what follows works within it."""
    one_of_key, rows = rows is None, lines(spark, sf) if rows is None else rows
    item = s(key=F.concat(F.lit("k"), F.col("l_linenumber").cast("string")), name=F.concat(F.lit("Stat "), F.col("l_linenumber").cast("string")), home=F.col("l_quantity").cast("int").cast("string"), away=F.round("l_extendedprice").cast("long").cast("string"), compareCode=F.col("l_linenumber") % 3, statisticsType="positive", valueType="event", homeValue=F.col("l_quantity"), awayValue=F.col("l_extendedprice"), renderType=1)
    key = ("l_linestatus", "l_returnflag", "l_linenumber")
    grouped = rows.groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*key, *LINE_ORDER[:2], "l_extendedprice", "l_shipdate", item.alias("item")))).alias("all"))
    new = lambda x, before: ~F.struct(*(x[k] for k in key)).eqNullSafe(F.struct(*(before[k] for k in key)))
    kept = F.filter("all", lambda x, i: (i == 0) | new(x, F.get("all", i - 1))) if one_of_key else F.col("all")
    split = lambda rows, k, use: F.transform(F.array_distinct(F.transform(rows, lambda x: x[k])), lambda v: use(v, F.filter(rows, lambda x: x[k].eqNullSafe(v))))
    groups = lambda mine: split(mine, "l_returnflag", lambda v, x: s(groupName=v, statisticsItems=F.transform(x, lambda one: one["item"])))
    periods = let(kept, lambda all_: split(all_, "l_linestatus", lambda v, x: s(period=v, groups=let(x, groups))))
    grouped = grouped.select("l_orderkey", periods.alias("statistics"))
    return per_order(spark, sf, grouped).select(F.col("o_orderkey").alias("entity_id"), F.to_json(s(statistics=F.coalesce("statistics", F.array().cast(grouped.schema["statistics"].dataType)))).alias("payload"))


def enc_lineups(spark: SparkSession, sf: str) -> DataFrame:
    stats = F.when(F.col("l_returnflag") != "N", s(goals=F.when(F.col("l_linestatus") != "F", (F.col("l_quantity") % 3).cast("int")), minutesPlayed=F.col("l_quantity").cast("int"), rating=F.col("l_tax") * 100))
    position = F.when(F.col("l_discount") < 0.03, "").when(F.col("l_discount") >= 0.06, "M")
    player = s(player=s(name=F.concat(F.lit("P"), F.col("l_partkey").cast("string")), id=F.col("l_partkey"), position="G"), teamId=F.col("l_suppkey"), shirtNumber=F.col("l_linenumber"), position=position, substitute=F.col("l_linestatus") == "O", statistics=stats)
    side = lambda at: F.transform(F.filter("all", lambda x: at(x["l_linenumber"])), lambda x: x["p"])
    grouped = lines(spark, sf).groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(*LINE_ORDER, player.alias("p")))).alias("all"))
    grouped = grouped.select("l_orderkey", side(lambda n: n <= 3).alias("home"), side(lambda n: n > 3).alias("away"))
    empty = F.array().cast(grouped.schema["home"].dataType)
    return per_order(spark, sf, grouped).select(F.col("o_orderkey").alias("entity_id"), F.to_json(s(confirmed=True, home=s(players=F.coalesce("home", empty), formation="4-4-2"), away=s(players=F.coalesce("away", empty)))).alias("payload"))


def minute_of(ts: Column) -> Column:
    return F.minute(ts) + 60 * (F.hour(ts) % 2)


def enc_incidents(spark: SparkSession, sf: str) -> DataFrame:
    kind, t = F.col("event_type"), minute_of(F.col("ts"))
    only = lambda types, v: F.when(kind.isin(*types), v)
    goal, card, sub, period, injury = "click", "error", "purchase", "signup", "view"
    one = s(
        incidentType=F.when(kind == goal, "goal").when(kind == card, "card").when(kind == sub, "substitution").when(kind == period, "period").otherwise("injuryTime"),
        id=only([goal, sub], F.col("event_id")), time=t, addedTime=F.when(kind == period, 999).when(kind == injury, 0).when((kind == sub) & (F.col("event_id") % 2 == 0), 3),
        text=only([period], F.lit("HT")), homeScore=only([period, goal], F.lit(1)), awayScore=only([period, goal], F.lit(0)), isLive=only([period], F.lit(False)), timeSeconds=only([period], t * 60), reversedPeriodTime=only([goal, sub, period, injury], F.lit(1)),
        reversedPeriodTimeSeconds=only([period], F.lit(60)), periodTimeSeconds=only([period], F.lit(2700)), length=only([injury], F.lit(4)), injury=only([sub], F.lit(False)),
        isHome=F.when(kind.isin(goal, sub), F.col("event_id") % 2 == 0).when((kind == card) & (F.col("event_id") % 3 != 0), True), incidentClass=only([goal, sub, card], F.lit("regular")), playerName=only([card], F.concat(F.lit("P"), F.col("event_id").cast("string"))),
    )
    grouped = table(spark, sf, "events").groupBy("user_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("ts", "event_id", F.to_json(one).alias("j")))), lambda x: x["j"]).alias("all"))
    kits = '"home":{"goalkeeperColor":{"primary":"a"},"playerColor":{"primary":"b"}},"away":{"goalkeeperColor":{"primary":"c"},"playerColor":{"primary":"d"}}'
    return grouped.select(F.col("user_id").alias("entity_id"), F.concat(F.lit('{"incidents":['), F.array_join("all", ","), F.lit(f"],{kits}}}")).alias("payload"))


def enc_graph(spark: SparkSession, sf: str) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    points = table(spark, sf, "events").withColumn("minute", F.row_number().over(w)).select("user_id", "minute", F.round("value").cast("long").alias("v"))
    grouped = points.groupBy("user_id").agg(F.sort_array(F.collect_list(s(minute=F.col("minute").cast("double"), value=F.coalesce("v", F.lit(0).cast("long"))))).alias("points"))
    keep = F.when(F.col("user_id") % 10 != 0, F.col("points")).otherwise(F.array().cast(grouped.schema["points"].dataType))
    return grouped.select(F.col("user_id").alias("entity_id"), F.to_json(s(graphPoints=keep, periodTime=45, overtimeLength=15, periodCount=2)).alias("payload"))


def enc_ab(spark: SparkSession, sf: str) -> DataFrame:
    """Two captures of each base-like document: B changes where id % 7 = 0, is
    missing where id % 11 = 0 and broken where id % 17 = 0, both are missing
    where id % 13 = 0 and broken where id % 34 = 0."""
    orders = table(spark, sf, "orders").withColumn("entity_id", F.col("o_orderkey"))
    changed = F.col("entity_id") % 7 == 0

    def doc(b: bool) -> Column:
        x = F.when(F.col("entity_id") % (17 if b else 34) == 0, F.lit("broken")).otherwise(F.col("o_custkey").cast("string"))
        return F.to_json(s(a=s(x=x, y=F.when(changed & F.lit(b), "changed").otherwise(F.col("o_orderpriority"))), n=F.when((F.col("entity_id") % 14 == 0) & F.lit(b), F.lit(None)).otherwise(F.col("o_orderstatus")), tags=F.array(F.col("o_orderstatus"), F.when(changed & F.lit(b) & (F.col("entity_id") % 3 == 0), "t2").otherwise("t1"))))

    a = orders.select("entity_id", F.lit("A").alias("fetch_slot"), F.when(F.col("entity_id") % 13 != 0, doc(False)).alias("payload"))
    b = orders.select("entity_id", F.lit("B").alias("fetch_slot"), F.when((F.col("entity_id") % 13 != 0) & (F.col("entity_id") % 11 != 0), doc(True)).alias("payload"))
    return a.union(b)


#: What enc_ab's documents must hold.
AB_CONTRACT = Contract("ab", {"a!": {"x!": "int", "y": "str"}, "n": "str", "tags!": ["str"]})


COMPONENTS = ("base", "stats", "lineup", "incidents", "graph", "odds")


def enc_attempts(spark: SparkSession, sf: str) -> DataFrame:
    """An attempt log: match_id, component_name, attempted_at, outcome, message."""
    kind = F.col("event_type")
    outcome = F.when(kind == "click", "SUCCESS").when(kind == "error", "API_ERROR").when(kind == "signup", "UNAVAILABLE").otherwise("QA_MISMATCH")
    message = F.when(outcome.isin("API_ERROR", "QA_MISMATCH") & (F.col("event_id") % 5 != 0), F.concat(F.lit("m"), F.col("event_id").cast("string")))
    component = F.element_at(F.array(*map(F.lit, COMPONENTS)), (F.col("event_id") % 6).cast("int") + 1)
    return table(spark, sf, "events").select(F.col("user_id").alias("match_id"), component.alias("component_name"), F.col("ts").alias("attempted_at"), outcome.alias("outcome"), message.alias("message"), F.col("event_id").alias("attempt_id"))


def enc_landing(spark: SparkSession, sf: str, made: DataFrame, component: str) -> DataFrame:
    """Landing rows of a component, some replaced by empty or error documents."""
    k = F.col("entity_id") % 17
    payload = F.when(k == 1, None).when(k == 2, "{}").when(k == 3, "[]").when(k == 4, '{"error":{"code":404}}').when(k == 5, '{"error":{"code":500}}').otherwise(F.col("payload"))
    return made.select(F.lit(component).alias("component"), "entity_id", F.lit("run1").alias("run_id"), F.lit("A").alias("fetch_slot"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("fetched_at"), payload.alias("payload"))


#: Runs in order of time, which isn't that of their names.
RUN_IDS = ("run2", "run10", "run11")


def enc_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Three runs of two components of each match: the second differs where
    match % 5 = 0, the third where match % 7 = 0 and lacks graphs where match %
    11 = 0; no run has readable stats where match % 23 = 0.  Times of making,
    at the top and deep inside, differ in every run.  Matches are dealt out
    before their documents are made: the table may be read by few tasks."""
    orders = by(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "o_orderkey").select(F.col("o_orderkey").alias("match_id"), F.col("o_custkey").alias("v"), F.col("o_orderstatus").alias("st"))
    runs = orders.withColumn("run", F.explode(F.array(*(F.lit(i) for i in (1, 2, 3)))))
    differs = ((F.col("run") == 2) & (F.col("match_id") % 5 == 0)) | ((F.col("run") == 3) & (F.col("match_id") % 7 == 0))
    doc = F.to_json(s(total=F.when(differs, F.col("v") + F.col("run")).otherwise(F.col("v")), kind=F.col("st"), generated_at=F.col("run"), meta=s(generated_at=F.col("run"), by="x"), items=F.array(s(v=F.col("v"), processing_time=F.col("run")))))
    garbage = F.concat(F.lit("garbage "), F.col("run").cast("string"))
    stats = runs.select("match_id", F.lit("stats").alias("component"), "run", F.when(F.col("match_id") % 23 == 0, garbage).otherwise(doc).alias("payload"))
    missing = (F.col("run") == 3) & (F.col("match_id") % 11 == 0)
    graph = runs.where("match_id % 2 = 0").select("match_id", F.lit("graph").alias("component"), "run", F.when(~missing, F.to_json(s(points=F.when(differs & (F.col("match_id") % 4 == 0), 9).otherwise(3), total=F.col("v"), calculatedAt=F.col("run")))).alias("payload"))
    name = F.element_at(F.array(*map(F.lit, RUN_IDS)), F.col("run"))
    return stats.union(graph).select("match_id", "component", name.alias("run_id"), F.timestamp_seconds(F.col("run") * 86400).alias("run_at"), "payload")


#: What enc_runs' documents must hold.
RUN_CONTRACTS = {
    "stats": Contract("stats", {"total!": "int", "kind!": "str", "generated_at": "int", "meta": {"generated_at": "int", "by": "str"}, "items": [{"v": "int", "processing_time": "int"}]}),
    "graph": Contract("graph", {"points!": "int", "total!": "int", "calculatedAt": "int"}),
}
