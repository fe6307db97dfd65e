"""Small cases with exact values, and properties."""

import json

import pytest
from pyspark.sql import functions as F

from touchline.functions import sanitise
from touchline.functions.contracts import CONTRACTS, Contract
from touchline.functions.scalars import fraction
from touchline.functions.validate import validate_payload
from touchline.operators import flatten, qa, tables, tasks
from touchline.operators.odds import clean_odds
from touchline.plans.registry import route
from touchline.sources.landing import id_list


def docs(spark, *payloads):
    return spark.createDataFrame([(i, p if p is None or isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], "entity_id long, payload string")


@pytest.mark.parametrize(("text", "want"), [("4/6", (4, 6)), ("11/10", (11, 10)), ("1/1", (1, 1)), ("0/1", (0, 1)), ("4-6", None), ("N/A", None), ("10", None), (None, None), ("1/two", None)])
def test_fractions(spark, text, want):
    (r,) = spark.createDataFrame([(text,)], "t string").select(F.expr(fraction("t")).alias("f")).collect()
    assert (tuple(r.f) if r.f else None) == want


def market(i, name, group, *choices):
    return {"marketId": i, "marketName": name, "marketGroup": group, "isLive": False, "suspended": False, "choices": [{"initialFractionalValue": "1/2", "fractionalValue": "1/2", "name": n, "change": 0} | ({} if w is None else {"winning": w}) for n, w in choices]}


DIRTY = {
    "eventId": 1,
    "markets": [
        market(1, "Full time", "1X2", ("1", False), ("X", False), ("2", True)),
        market(2, "Double chance", "Double chance", ("1X", False), ("X2", "yes"), ("12", True)),
        market(3, "1st half", "1X2", ("1", True), ("X", False), ("1", False)),
        market(4, "Draw no bet", "Draw no bet", ("1", None), ("2", True)),
        market(17, "Asian handicap", "Asian handicap", ("(-0.75) A", None), ("(0.75) B", None)),
        market(6, "First team to score", "First team to score", ("R", True), ("No goal", False), ("R", False)),
        market(9, "Other", "Other", ("a", None), ("a", None), ("a_dup_1", None), ("a", None)),
    ],
}


def test_dirty_odds(spark):
    (r,) = clean_odds(docs(spark, DIRTY)).collect()
    assert r.is_valid
    got = {m.marketId: ([c.name for c in m.choices], [c.winning for c in m.choices]) for m in r.parsed.markets}
    assert got == {
        1: (["1", "X", "2"], [False, False, True]), 2: (["1X", "X2", "12"], [False, True, False]), 3: (["1", "X", "2"], [None] * 3), 4: (["1", "2"], [False, True]),
        17: (["(-0.75) Home", "(0.75) Away"], [False, False]), 6: (["Home", "No goal", "Away"], [None] * 3), 9: (["a", "a_dup_1", "a_dup_1_dup_1", "a_dup_2"], [None] * 4),
    }
    assert r.raw_payload == json.dumps(DIRTY)


def test_empty_and_error_documents(spark):
    rows = validate_payload(docs(spark, None, "", "{}", " { } ", "[]", '{"error":{"code":404}}', '{"error":{"code":500}}', '{"x":1}', "{broken"), CONTRACTS["graph"]).orderBy("entity_id").collect()
    assert [r.reason for r in rows] == ["empty"] * 5 + ["http_404", "http_500", "invalid_contract", "invalid_contract"]
    lineups = validate_payload(docs(spark, '{"error":{"code":404}}'), CONTRACTS["lineups"], parity=True).collect()
    assert lineups[0].is_valid  # all of its fields are optional
    assert validate_payload(docs(spark), CONTRACTS["graph"]).count() == 0


def test_coercion_and_errors(spark):
    good = {"graphPoints": [{"minute": "5", "value": 3.0}, {"minute": 45.5, "value": "-2"}], "periodTime": "45", "overtimeLength": 15.0, "periodCount": 2, "more": 1}
    bad = {"graphPoints": [{"minute": 1, "value": 5.5}, {"value": 1}], "periodTime": "x", "overtimeLength": None, "periodCount": 2}
    one, two = validate_payload(docs(spark, good, bad), CONTRACTS["graph"]).orderBy("entity_id").collect()
    assert one.is_valid and [tuple(p) for p in one.parsed.graphPoints] == [(5.0, 3), (45.5, -2)] and one.parsed.periodTime == 45
    assert sorted((e.path, e.code) for e in two.errors) == [("graphPoints[].minute", "missing"), ("graphPoints[].value", "int"), ("overtimeLength", "missing"), ("periodTime", "int")]


SIDES = {k: {"goalkeeperColor": {}, "playerColor": {}} for k in ("home", "away")}


def test_incident_union(spark):
    ok = {"incidents": [{"incidentType": "card", "isHome": None}, {"incidentType": "goal", "id": 1, "time": 3, "isHome": True, "incidentClass": "x", "reversedPeriodTime": 1}, {"incidentType": "injuryTime", "length": 1, "time": 2, "addedTime": 0, "reversedPeriodTime": 1}, {"incidentType": "substitution", "id": 2, "time": 3, "injury": False, "isHome": False, "incidentClass": "y", "reversedPeriodTime": 1}], **SIDES}
    unknown = {"incidents": [{"incidentType": "party"}], **SIDES}
    lacking = {"incidents": [{"incidentType": "goal", "id": 1}], **SIDES}
    checked = validate_payload(docs(spark, ok, unknown, lacking), CONTRACTS["incidents"])
    rows = checked.orderBy("entity_id").collect()
    assert [r.is_valid for r in rows] == [True, False, False] and rows[1].errors[0].code == "unknown_type" and len(rows[2].errors) == 4
    flat = flatten.incidents(checked.where("is_valid")).orderBy("seq").collect()
    assert [(r.added_time, r.is_home) for r in flat] == [(0, None), (0, True), (0, False), (None, False)]


def test_comparison(spark):
    contract = Contract("t", {"a!": {"x!": "int", "m": "map"}, "l": ["str"], "n": "str", "k": "int"})
    doc = lambda **k: json.dumps({"a": {"x": 1, "m": {"p": 1.0, "q": 2.0}}, "l": ["1", "2"], "n": "s"} | k)
    bad, envelope = doc(k="x"), '{"error":{"code":404}}'
    pairs = [
        (0, doc(), doc(a={"m": {"q": 2.0, "p": 1.0}, "x": "1"})), (1, doc(), doc(n=None, l=["2", "1"])), (2, doc(a=None), doc()), (3, None, doc()), (4, None, None), (5, doc(), doc(a={"x": 2, "m": {"p": 1.5}})),
        (6, doc(k=None), bad), (7, bad, doc(k="y")), (8, bad, None), (9, "garbage", "other garbage"), (10, envelope, doc()), (11, doc(k=None), doc()),
    ]
    frame = lambda rows: spark.createDataFrame(rows, "entity_id long, a string, b string")
    rows = {r.entity_id: r for r in qa.compare(frame(pairs), contract).collect()}
    paths = {k: [d.path for d in r.delta] for k, r in rows.items()}
    assert [rows[k].verdict for k in range(12)] == ["match", "mismatch", "mismatch", "mismatch", "unavailable", "mismatch", "mismatch", "unavailable", "unavailable", "unavailable", "mismatch", "match"]
    assert paths == {0: [], 1: ["l", "n"], 2: ["root_payload"], 3: ["root_payload"], 4: [], 5: ["a.x", "a.m"], 6: ["root_payload"], 7: [], 8: [], 9: [], 10: ["root_payload"], 11: []}
    assert [(rows[k].a_state, rows[k].b_state) for k in (6, 7, 8, 10)] == [("valid", "invalid"), ("invalid", "invalid"), ("invalid", "absent"), ("absent", "valid")]
    swapped = qa.compare(frame([(k, b, a) for k, a, b in pairs]), contract).collect()
    assert {r.entity_id: [d.path for d in r.delta] for r in swapped} == paths
    long = spark.createDataFrame([("z" * 600,)], "t string").select(qa.delta_message(F.array(F.struct("t"))).alias("m")).collect()[0].m
    assert len(long) == 500 and long.endswith("...")


def test_state_machine(spark):
    log = [("a", "QA_MISMATCH", "m1"), ("a", "QA_MISMATCH", "m2"), ("a", "SUCCESS", None), ("b", "API_ERROR", "e1"), ("b", "API_ERROR", None), ("b", "API_ERROR", "e3"), ("b", "SUCCESS", None), ("c", "UNAVAILABLE", None), ("c", "SUCCESS", None)]
    frame = spark.createDataFrame([(1, c, i, o, m, i) for i, (c, o, m) in enumerate(log)], "match_id long, component_name string, attempted_at int, outcome string, message string, attempt_id int")
    got = {r.component_name: (r.status, r.retry_count, r.error_message, r.attempts) for r in tasks.fold_attempts(frame).collect()}
    assert got == {"a": ("SUCCESS", 2, None, 3), "b": ("API_ERROR", 3, "e3", 3), "c": ("UNAVAILABLE", 0, None, 1)}


def test_table_states(spark):
    old = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 1, "c")], "match_id long, k long, v string")
    new = spark.createDataFrame([(1, 1, "x", 0), (1, 1, "y", 1), (3, 1, "z", 0)], "match_id long, k long, v string, seq int")
    once = tables.keyed_upsert(old, new, ["match_id", "k"], [F.col("seq")])
    assert sorted(map(tuple, once.collect())) == [(1, 1, "y"), (1, 2, "b"), (2, 1, "c"), (3, 1, "z")]
    assert sorted(map(tuple, tables.keyed_upsert(once, new, ["match_id", "k"], [F.col("seq")]).collect())) == sorted(map(tuple, once.collect()))
    keys = spark.createDataFrame([(1,), (2,)], "match_id long")
    wiped = tables.wipe_replace(old, keys, new.where("match_id = 1").drop("seq"))
    assert sorted(map(tuple, wiped.collect())) == [(1, 1, "x"), (1, 1, "y")]


def test_routes_and_lists(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown component"):
        route("weather", docs(spark, "{}"))
    rows, bad = route("odds", docs(spark, DIRTY, "{}"))
    assert rows.count() == 20 and [r.reason for r in bad.collect()] == ["empty"]
    (tmp_path / "m.json").write_text('{"match_ids":\n [5, 6]}')
    assert [r.match_id for r in id_list(spark, str(tmp_path / "m.json"), [1]).collect()] == [5, 6]
    assert [r.match_id for r in id_list(spark, str(tmp_path / "none.json"), [1]).collect()] == [1]


def test_plans_stay_in_the_jvm(spark, sf):
    from touchline.plans import queries as core

    plan = core.odds_rows(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "ArrowEval" not in plan and plan.count("from_json") <= 4


def test_calendar_documents_are_bounded(spark, tmp_path):
    """A season of more matches than a page holds is more than one document, and no match is lost."""
    from pyspark.sql import functions as F

    from touchline.sources import encode as enc

    d, n = str(tmp_path), 3 << enc.PAGE_BITS
    spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string").write.parquet(f"{d}/region.parquet")
    spark.createDataFrame([(1, "N", 0)], "n_nationkey int, n_name string, n_regionkey int").write.parquet(f"{d}/nation.parquet")
    spark.createDataFrame([(1, "C", 1)], "c_custkey long, c_name string, c_nationkey int").write.parquet(f"{d}/customer.parquet")
    spark.range(n).select(F.col("id").alias("o_orderkey"), F.lit(1).cast("long").alias("o_custkey"), F.lit("F").alias("o_orderstatus"), F.lit(10.0).alias("o_totalprice"), F.lit("1995-01-01").cast("timestamp").alias("o_orderdate"), F.lit("1-URGENT").alias("o_orderpriority")).write.parquet(f"{d}/orders.parquet")
    held = [r.n for r in enc.enc_events(spark, d).select(F.size(F.split("payload", '"startTimestamp"')).alias("n")).collect()]
    assert max(held) - 1 <= 1 << enc.PAGE_BITS and sum(held) - len(held) == n


def test_renamings_exclude_each_other(spark):
    made = spark.createDataFrame([("First team to score", "1X2", [("a", "true"), ("b", "false"), ("c", "false")])], "m string, g string, c array<struct<name:string,winning:string>>")
    (got,) = made.select(sanitise.sanitise_choices(F.col("m"), F.col("g"), F.col("c")).alias("c")).collect()
    assert [x.name for x in got.c] == ["1", "X", "2"]


def test_lineup_defaults_and_types(spark):
    player = '{"player":{"id":%d,"name":"n","slug":"s-l"},"teamId":1%s}'
    side = lambda extra="": '{"players":[' + player % (1, "") + "," + player % (2, ',"captain":true,"statistics":{"totalKeeperSweeper":2,"rating":7.5}') + "]" + extra + "}"
    frame = spark.createDataFrame([(1, '{"home":%s}' % side()), (2, '{"home":%s}' % side(',"missingPlayers":null')), (3, '{"home":%s}' % side(',"missingPlayers":[{"reason":"x"}]'))], "entity_id long, payload string")
    got = {r.entity_id: r for r in validate_payload(frame, CONTRACTS["lineups"]).collect()}
    assert got[1].is_valid and got[1].parsed.home.missingPlayers == [] and got[1].parsed.home.supportStaff == [] and got[1].parsed.home.players[1].statistics.totalKeeperSweeper == 2
    assert [(e.path, e.code) for e in got[2].errors] == [("home.missingPlayers", "null")]
    assert sorted((e.path, e.code) for e in got[3].errors) == [("home.missingPlayers[].player", "missing"), ("home.missingPlayers[].reason", "int")]
    a, b = flatten.lineups(validate_payload(frame.where("entity_id = 1"), CONTRACTS["lineups"])).orderBy("seq").collect()
    assert (a.goals, a.minutes_played, a.assists, a.rating, a.expected_assists, a.captain, a.substitute, a.player_slug) == (0, 0, None, None, None, None, None, "s-l")
    assert (b.goals, b.minutes_played, b.rating, b.captain) == (None, None, 7.5, True)


def test_network_actions_are_checked(spark):
    goal = '{"incidentType":"goal","id":1,"time":5,"isHome":true,"incidentClass":"regular","reversedPeriodTime":40,"footballPassingNetworkAction":[%s]}'
    page = '{"incidents":[' + goal + '],"home":{"goalkeeperColor":{},"playerColor":{}},"away":{"goalkeeperColor":{},"playerColor":{}}}'
    action = '{"player":{"name":"p","id":1},"eventType":"pass","time":3,"playerCoordinates":{"x":1,"y":%s},"isHome":true}'
    frame = spark.createDataFrame([(1, page % (action % "2.5")), (2, page % (action % '"far"'))], "entity_id long, payload string")
    got = {r.entity_id: r for r in validate_payload(frame, CONTRACTS["incidents"]).collect()}
    assert got[1].is_valid and got[1].parsed.incidents[0].footballPassingNetworkAction[0].playerCoordinates.y == 2.5
    assert [(e.path, e.code, e.value) for e in got[2].errors] == [("incidents[].footballPassingNetworkAction[].playerCoordinates.y", "float", "far")]


def test_staff_and_grounds_of_a_match(spark):
    """Venues, managers and referees must be whole where they are there; class is an alias."""
    sport, venue = {"name": "f", "slug": "f", "id": 1}, {"name": "v", "slug": "v", "id": 3, "city": {"name": "c"}}
    team = {"name": "t", "slug": "t", "nameCode": "T", "gender": "M", "sport": sport, "country": None, "teamColors": {"primary": "1", "secondary": "2", "text": "3"}}
    category = {"name": "c", "id": 1, "slug": "c", "sport": sport}
    event = {"slug": "s", "id": 5, "status": {"code": 1, "description": "d", "type": "t"}, "tournament": {"id": 1, "name": "n", "slug": "s", "category": category}, "homeTeam": team | {"class": "2"}, "awayTeam": team}
    referee = {"name": "r", "slug": "r", "id": 2, "yellowCards": 1, "redCards": 0, "yellowRedCards": 0, "games": 3, "sport": sport}
    more = [
        {"venue": venue | {"venueCoordinates": {"latitude": "1.5", "longitude": 2}, "stadium": {"name": "st"}}, "referee": referee, "fanRatingEvent": "true"}, {}, {"venue": {k: v for k, v in venue.items() if k != "slug"}},
        {"venue": venue | {"city": {}}}, {"venue": venue | {"venueCoordinates": {"latitude": 1}}}, {"referee": {k: v for k, v in referee.items() if k != "games"}}, {"homeTeam": team | {"manager": {"name": "m", "slug": "m", "id": 1}}}, {"awayTeam": team | {"class": "x"}},
    ]
    got = [r for r in validate_payload(docs(spark, *({"event": event | m} for m in more)), CONTRACTS["base"]).orderBy("entity_id").collect()]
    assert [[(e.path, e.code) for e in r.errors] for r in got] == [
        [], [], [("event.venue.slug", "missing")], [("event.venue.city.name", "missing")], [("event.venue.venueCoordinates.longitude", "missing")], [("event.referee.games", "missing")], [("event.homeTeam.manager.shortName", "missing")], [("event.awayTeam.class", "int")],
    ]
    assert got[0].parsed.event.homeTeam.class_ == 2 and got[0].parsed.event.venue.venueCoordinates.latitude == 1.5 and got[0].parsed.event.fanRatingEvent is True


ODD_LEAVES = ("7", "-7", "+7", '"7"', '" 7"', "7.0", "7.5", "1e2", "true", '"x"', '""', "null", "[7]", '{"x":7}', "99999999999999999999", '"\\t7"', '"007"', '"NaN"')


def test_strict_and_lax_ways_agree(spark):
    """Whatever the leaves are, documents that go the strict way come out as those that go the lax way, and sound
    ones are read and checked without patterns: two generators, where there were four."""
    from dataclasses import replace

    from touchline.functions import validate

    fields = {"i": "int", "n!": "int", "f": "float", "b": "bool", "s": "str", "d": ("int", 3), "o": {"i!": "int", "class=class_": "int"}, "a": [{"i!": "int", "f": "float"}]}
    contract = validate.Contract("odd", fields)
    documents = [f'{{"n":1,"{k}":{v}}}' for k in "infbsdoa" for v in ODD_LEAVES] + [f'{{"n":1,"o":{{"i":{v}}}}}' for v in ODD_LEAVES] + [f'{{"n":1,"a":[{{"i":1}},{{"i":{v},"f":{v}}},null]}}' for v in ODD_LEAVES]
    documents += ["", "{}", "[]", " { }", "{", '{"error":{"code":404}}', '{"n":1,"error":{"code":"x"}}', '{"n":1}', ' {"n":1,"o":{"i":2,"class":5},"a":[{"i":1,"f":1}]}', '{"n":1,"o":{"i":2,"class":5},"a":[{"i":1,"f":1}]}', '{"n":1,"o":{}}', '{"i":1}']
    rows = spark.createDataFrame([(d,) for d in [*documents, None]], "payload string")
    fast = validate.compiled(contract)
    both = []
    for strict in (fast.strict, None):
        validate._COMPILED[repr(contract)] = replace(fast, strict=strict)
        both.append(sorted(map(repr, validate.validate_payload(rows, contract).collect())))
    validate._COMPILED.pop(repr(contract))
    assert both[0] == both[1]
    plan = validate.validate_payload(rows, contract)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate ") == 2


def test_run_documents_are_made_by_all_tasks(spark, sf):
    """The table of matches may be one file, read by one task; all that follows goes by match and deals out no more."""
    from touchline.operators import consensus as cns
    from touchline.sources import encode as enc

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = enc.enc_runs(spark, sf)
    assert made.where("component = 'stats'").select(F.spark_partition_id().alias("p")).distinct().count() == n > 1
    found = cns.consensus(cns.groups(cns.with_fingerprints(made, enc.RUN_CONTRACTS)))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 2


def test_wipe_replace_and_odds_read_documents_once_and_make_no_unused_text(spark, sf):
    from touchline.plans.queries import QUERIES

    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan(QUERIES["snk_wipe_replace"](spark, sf))  # what was checked is read where it was written
    assert "raw" not in plan(QUERIES["flt_odds"](spark, sf)).replace("raw_name", "")  # texts of markets


def test_errors_are_gathered_where_there_are_any_and_only_there(spark):
    from touchline.functions import validate
    from touchline.functions.contracts import CONTRACTS

    choice = '{"initialFractionalValue":"1/2","fractionalValue":%s,"name":"a","change":%s}'
    market = '{"marketId":1,"marketName":"m","marketGroup":"g","isLive":false,"suspended":%s,"choices":%s}'
    one = lambda *c: "[" + ",".join(c) + "]"
    texts = [market % ("false", one(choice % ('"1/3"', "1"))), market % ("false", one(choice % ('"N/A"', "1"))), market % ("false", one(choice % ('"1/3"', "1"), choice % ('"1/3"', "null"))), market % ('"?"', "[]"), market % ("false", one("null")), market % ("false", "null"), "null"]
    rows = spark.createDataFrame([(i, '{"eventId":7,"markets":[%s]}' % t) for i, t in enumerate(texts)] + [(90, '{"eventId":7}'), (91, '{"eventId":"x","markets":[]}')], "k int, payload string")
    kind = CONTRACTS["odds"].fields
    made = rows.withColumn("s", F.from_json("payload", validate.shadow(kind))).withColumn("m", F.expr(validate.typed_value("s", kind)))
    broken = F.expr(" OR ".join(f"({c})" for c in validate.faulty("s", "m", kind, False, None)))
    every = F.expr(validate._gather(*validate.faults("s", "m", kind, "", False, True, None)))
    got = {r.k: (r.b, len(r.e)) for r in made.select("k", broken.alias("b"), every.alias("e")).collect()}
    assert all(b == (n > 0) for b, n in got.values()) and got[0] == (False, 0) and got[91] == (True, 1) and sum(b for b, _ in got.values()) >= 6
    assert {r.k: len(r.errors) for r in validate.validate_payload(rows, CONTRACTS["odds"]).collect()} == {k: n for k, (_, n) in got.items()}


def test_only_asked_members_are_made(spark):
    """Documents are checked whole, but members that nobody asks for may be null; a fault in one of those still counts."""
    player = lambda i, **more: {"player": {"name": f"p{i}", "id": i}, "teamId": 7, **more}
    good = {"home": {"players": [player(1, shirtNumber=9), player(2)]}, "away": {"players": []}}
    wrong = {"home": {"players": [player(1, shirtNumber="nine")]}, "away": {"players": []}}
    lacks = {"home": {"players": [{"teamId": 7}]}, "away": {"players": []}}
    lax = {"home": {"players": [player(1) | {"teamId": "7"}]}, "away": {"players": []}}
    rows = validate_payload(docs(spark, good, wrong, lacks, lax, None), CONTRACTS["lineups"], only=("home.players.player.id", "home.players.teamId")).orderBy("entity_id").collect()
    assert [r.reason for r in rows] == [None, "invalid_contract", "invalid_contract", None, "empty"]
    assert [[(p.player.id, p.teamId) for p in rows[i].parsed.home.players] for i in (0, 3)] == [[(1, 7), (2, 7)], [(1, 7)]]
    assert rows[0].parsed.home.players[0].shirtNumber is None and rows[0].parsed.away is None
    whole = validate_payload(docs(spark, good), CONTRACTS["lineups"]).first()
    assert whole.parsed.home.players[0].shirtNumber == 9 and whole.parsed.away.players == []


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_raw_elements_are_made_only_where_asked(spark):
    """Incidents without their raw texts don't read the payload a second time."""
    kit = {"goalkeeperColor": {}, "playerColor": {}}
    cards = [{"incidentType": "card", "playerName": "a"}, {"incidentType": "card", "playerName": "b"}]
    rows = flatten.incidents(validate_payload(docs(spark, {"incidents": cards, "home": kit, "away": kit}), CONTRACTS["incidents"]).where("is_valid"))
    assert [(r.seq, json.loads(r.data)) for r in rows.orderBy("seq").collect()] == list(enumerate(cards))
    assert "$.incidents" in plan_of(rows) and "$.incidents" not in plan_of(rows.select("match_id", "incident_type"))


def test_seasons_are_not_dealt_by_match(spark, sf):
    """Making the lists of seasons shuffles nations' years, not all matches."""
    from touchline.sources import encode

    assert "RepartitionByExpression" not in plan_of(encode.enc_seasons(spark, sf)) and "RepartitionByExpression" in plan_of(encode.enc_base(spark, sf))


def test_assess_judges_without_making_documents(spark):
    """States are those of the validated documents; of a parsed one only the state leaves the assessment."""
    from touchline.functions.validate import envelope_code
    from touchline.operators import consensus as cns

    kit, point, player = {"goalkeeperColor": {}, "playerColor": {}}, {"minute": 1, "value": 2}, {"player": {"name": "p", "id": 1}, "teamId": 7}
    ends = {"periodTime": 45, "overtimeLength": 15, "periodCount": 2}
    cards = lambda **more: {"incidents": [{"incidentType": "card"} | more], "home": kit, "away": kit}
    side = lambda *players, **more: {"home": {"players": list(players)} | more, "away": {"players": [player]}}
    odd = (None, "{}", " { }", "[]", "{", '{"error":{"code":404}}', '{"error":1}', '{"error":{"code":5},"error":null}', '{"\\u0065rror":{"code":"7"}}')
    given = {
        "graph": docs(spark, ends | {"graphPoints": [point] * 5}, ends | {"graphPoints": [point] * 4}, ends, ends | {"periodTime": "45", "graphPoints": [point] * 5}, ends | {"graphPoints": [{"minute": "x"}] * 5}, ends | {"graphPoints": [point] * 5, "error": {"code": 500}}, *odd),
        "incidents": docs(spark, cards(), cards(incidentType="new"), cards(incidentType="goal"), cards(text=[1], player="none"), cards(time="late"), {"incidents": []}, *odd),
        "lineup": docs(spark, side(player), side(), side(player, missingPlayers=None), side(player, formation=3, playerColor="red"), side(player | {"shirtNumber": "nine"}), side({"teamId": 7}), *odd),
    }
    rules = cns.configured(lineup=cns.Rule(True, cns.at_least(1, "home.players", "away.players")), incidents=cns.Rule(False, lambda d: ~F.exists(d["incidents"], lambda x: x["player"].isNotNull())))
    states = cns.assess(given, rules)
    got = {(r.component, r.match_id): r.state for r in states.collect()}
    want = {}
    for name, frame in given.items():
        checked = validate_payload(frame, CONTRACTS[cns.CONTRACT_OF.get(name, name)])
        state = F.when(F.col("payload").isNull(), "missing").when(envelope_code(F.col("payload")).isNotNull(), "error").when(F.col("is_valid") & rules[name].holds(F.col("parsed")), "valid").otherwise("invalid")
        want |= {(name, r.entity_id): r.state for r in checked.select("entity_id", state.alias("state")).collect()}
    assert got == want and set(got.values()) == {"missing", "error", "valid", "invalid"} and got["graph", 0] == got["lineup", 0] == got["incidents", 0] == "valid"
    assert "_new_state#" in plan_of(states) and "_new_parsed#" not in plan_of(states)


def test_statistics_are_gathered_by_one_grouping(spark, sf):
    """Of each key the first item, by one aggregate of an order's items and no window."""
    from touchline.sources import encode

    plan = plan_of(encode.enc_stats(spark, sf))
    assert plan.count("Aggregate") == 1 and "Window" not in plan
    item = lambda number, price, status="O", flag="N": (1, 1, 1, number, 5.0, price, 0.0, 0.0, flag, status, None)
    rows = spark.createDataFrame([item(2, 3.0), item(2, 1.0), item(1, 2.0), item(2, 4.0, flag="A"), item(1, 9.0, "F")], encode.table(spark, sf, "lineitem").schema)
    made = lambda one: [(p["period"], [(g["groupName"], [(x["key"], x["awayValue"]) for x in g["statisticsItems"]]) for g in p["groups"]]) for p in json.loads(one)["statistics"]]
    (all_,) = encode.enc_stats(spark, sf, rows).where("entity_id = 1").collect()
    assert made(all_.payload) == [("F", [("N", [("k1", 9.0)])]), ("O", [("A", [("k2", 4.0)]), ("N", [("k1", 2.0), ("k2", 1.0), ("k2", 3.0)])])]
