"""Registered queries, each beside the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sanitise
from ..functions.contracts import CONTRACTS
from ..functions.scalars import epoch_utc, fraction, safe_get
from ..functions.validate import coerce, envelope_code, is_empty, validate_payload
from ..operators import consensus as cns
from ..operators import export, flatten, qa, store, summary, tables, tasks
from ..operators.odds import clean_odds, parse_markets
from ..sources import encode as enc
from ..sources import landing
from ..sources.encode import table
from ..sources.scratch import scratch
from ..streaming import stream
from .registry import REGISTRY, batch_steps, route

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# ---------------------------------------------------------------- shared SQL
M = """m AS (SELECT o_orderkey AS match_id, *, CAST(floor(o_totalprice) AS BIGINT) AS cents, CAST(n_nationkey AS BIGINT) * 10000 + year(o_orderdate) AS season_id, year(o_orderdate) AS yr,
  CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'notstarted' ELSE 'postponed' END AS status_type, CASE o_orderstatus WHEN 'F' THEN 100 WHEN 'O' THEN 0 ELSE 60 END AS status_code,
  CAST(CAST(floor(o_totalprice) AS BIGINT) % 5 AS BIGINT) AS home, CAST((CAST(floor(o_totalprice) AS BIGINT) // 10) % 4 AS BIGINT) AS away
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
O = """o0 AS (SELECT l_orderkey AS match_id, [1, 6, 17, 9][l_suppkey % 4 + 1] AS market_id, ['Full time', 'First team to score', 'Asian handicap', 'Match goals'][l_suppkey % 4 + 1] AS market_name, ['1X2', 'First team to score', 'Asian handicap', 'Match goals'][l_suppkey % 4 + 1] AS market_group,
  CASE WHEN l_suppkey % 4 = 3 THEN ['0.5', '1.5', '2.5', NULL][l_orderkey % 4 + 1] END AS choice_group, l_returnflag, l_partkey, l_linenumber, CAST(l_quantity AS INT) AS q,
  CASE l_suppkey % 4 WHEN 3 THEN CASE l_linestatus WHEN 'O' THEN 'Over' ELSE 'Under' END WHEN 2 THEN '(0.5) ' || l_linestatus ELSE l_linestatus END AS raw_name,
  CAST(row_number() OVER (PARTITION BY l_orderkey, l_suppkey % 4 ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) AS INT) AS pos, count(*) OVER (PARTITION BY l_orderkey, l_suppkey % 4) AS n,
  bool_or(l_partkey % 97 = 0) OVER (PARTITION BY l_orderkey) AS bad FROM lineitem),
o1 AS (SELECT *, row_number() OVER (PARTITION BY match_id, market_id, raw_name ORDER BY pos) AS raw_rn,
  CASE WHEN market_id = 1 AND n = 3 THEN ['1', 'X', '2'][pos] ELSE raw_name END AS n1, CASE WHEN market_id = 6 AND n = 3 THEN ['Home', 'No goal', 'Away'][pos] ELSE raw_name END AS n6,
  CASE WHEN market_id = 17 AND n = 2 THEN '(0.5) ' || ['Home', 'Away'][pos] ELSE raw_name END AS n17 FROM o0),
o2 AS (SELECT *, max(raw_rn) OVER (PARTITION BY match_id, market_id) > 1 AS corrupted, CASE market_id WHEN 1 THEN n1 WHEN 6 THEN n6 ELSE n17 END AS named FROM o1),
o AS (SELECT *, named || CASE WHEN rn > 1 THEN '_dup_' || CAST(rn - 1 AS VARCHAR) ELSE '' END AS name, w AND sum(CAST(w AS INT)) OVER (PARTITION BY match_id, market_id ORDER BY pos) = 1 AS first_win
  FROM (SELECT *, row_number() OVER (PARTITION BY match_id, market_id, named ORDER BY pos) AS rn, l_returnflag IN ('A', 'R') AS w FROM o2))"""
C = "c(component_name, idx) AS (VALUES ('base', 0), ('stats', 1), ('lineup', 2), ('incidents', 3), ('graph', 4), ('odds', 5))"
AUDIT = C + """, audit AS (SELECT o_orderkey * 10 + idx AS audit_id, o_orderkey AS match_id, component_name, ['PENDING', 'SUCCESS', 'QA_MISMATCH', 'API_ERROR', 'UNAVAILABLE'][(o_orderkey + idx) % 5 + 1] AS status, CAST(o_orderkey % 4 AS INT) AS retry_count,
  CASE WHEN (o_orderkey + idx) % 5 IN (2, 3) THEN 'e' || CAST(o_orderkey AS VARCHAR) END AS error_message FROM orders, c WHERE (o_orderkey + idx) % 3 = 0)"""
S = """s AS (SELECT l_orderkey AS match_id, l_linestatus AS period, l_returnflag AS group_name, 'k' || CAST(l_linenumber AS VARCHAR) AS stat_key, l_linenumber, l_quantity AS home_value, l_extendedprice AS away_value
  FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linestatus, l_returnflag, l_linenumber ORDER BY l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) AS rn FROM lineitem) WHERE rn = 1)"""
L = """p AS (SELECT l_orderkey AS match_id, l_partkey AS player_id, CASE WHEN l_linenumber <= 3 THEN 'home' ELSE 'away' END AS side, l_suppkey AS team_id, l_linenumber AS shirt_number, l_linestatus = 'O' AS substitute,
  CASE WHEN l_discount >= 0.06 THEN 'M' ELSE 'G' END AS position, CASE WHEN l_returnflag = 'N' THEN 0 WHEN l_linestatus = 'F' THEN NULL ELSE CAST(l_quantity AS BIGINT) % 3 END AS goals, CASE WHEN l_returnflag = 'N' THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS minutes_played,
  CAST(NULL AS BIGINT) AS assists, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN l_linenumber <= 3 THEN 0 ELSE 1 END, l_partkey, l_suppkey, l_linenumber, l_extendedprice, l_shipdate) - 1 AS seq FROM lineitem)"""
AB = """ab AS (SELECT *, na OR entity_id % 34 = 0 AS no_a, nb OR entity_id % 17 = 0 AS no_b FROM (SELECT o_orderkey AS entity_id, o_orderkey % 13 = 0 AS na, o_orderkey % 13 = 0 OR o_orderkey % 11 = 0 AS nb, o_orderkey % 7 = 0 AS ch, o_orderkey % 14 = 0 AS ch_n, o_orderkey % 7 = 0 AND o_orderkey % 3 = 0 AS ch_t, o_orderpriority AS y, o_orderstatus AS n FROM orders)),
v AS (SELECT *, CASE WHEN no_a AND no_b THEN 'unavailable' WHEN no_a OR no_b THEN 'mismatch' WHEN ch THEN 'mismatch' ELSE 'match' END AS verdict FROM ab)"""
AT = C + """, att AS (SELECT user_id AS match_id, component_name, ts, event_id, CASE event_type WHEN 'click' THEN 'SUCCESS' WHEN 'error' THEN 'API_ERROR' WHEN 'signup' THEN 'UNAVAILABLE' ELSE 'QA_MISMATCH' END AS outcome,
  CASE WHEN event_type IN ('error', 'purchase', 'view') AND event_id % 5 <> 0 THEN 'm' || CAST(event_id AS VARCHAR) END AS message FROM events JOIN c ON event_id % 6 = idx),
f0 AS (SELECT *, outcome IN ('API_ERROR', 'QA_MISMATCH') AS r, coalesce(sum(CASE WHEN outcome IN ('API_ERROR', 'QA_MISMATCH') THEN 1 ELSE 0 END) OVER w, 0) AS before, coalesce(max(CASE WHEN outcome IN ('API_ERROR', 'QA_MISMATCH') THEN 0 ELSE 1 END) OVER w, 0) AS ended
  FROM att WINDOW w AS (PARTITION BY match_id, component_name ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT match_id, component_name, arg_max(outcome, event_id) AS status, CAST(count(*) FILTER (WHERE r) AS INT) AS retry_count, count(*) AS attempts, min(ts) AS first_ts, max(ts) AS last_ts, max(event_id) AS last_id FROM f0 WHERE before < 3 AND ended = 0 GROUP BY ALL),
fold AS (SELECT f.*, CASE WHEN status <> 'SUCCESS' THEN (SELECT arg_max(message, event_id) FROM f0 x WHERE x.match_id = f.match_id AND x.component_name = f.component_name AND before < 3 AND ended = 0 AND message IS NOT NULL) END AS error_message FROM f)"""
RUN = "['run2', 'run10', 'run11'][run]"
R = f"""r AS (SELECT match_id, component, run, CASE WHEN component = 'graph' AND run = 3 AND match_id % 11 = 0 OR component = 'stats' AND match_id % 23 = 0 THEN NULL WHEN differs AND (component = 'stats' OR match_id % 4 = 0) THEN CASE component WHEN 'stats' THEN 'd' || CAST(run AS VARCHAR) ELSE 'd' END ELSE 'same' END AS data
  FROM (SELECT o_orderkey AS match_id, component, run, (run = 2 AND o_orderkey % 5 = 0) OR (run = 3 AND o_orderkey % 7 = 0) AS differs FROM orders, (VALUES ('stats'), ('graph')) k(component), range(1, 4) z(run) WHERE component = 'stats' OR o_orderkey % 2 = 0)),
g AS (SELECT match_id, component, data, count(*) AS size, min(run) AS first_run, string_agg({RUN}, ',' ORDER BY run) AS runs FROM r GROUP BY ALL),
best AS (SELECT match_id, component, sum(size) AS total, max(size) AS size, max(CASE WHEN data IS NOT NULL THEN size END) AS size_nn FROM g GROUP BY ALL),
cn AS (SELECT *, size_nn = total AND total >= 2 AS has_consensus FROM best)"""
BAD5 = "CASE WHEN id % 17 = 1 OR id % 17 = 2 OR id % 17 = 3 THEN 'empty' WHEN id % 17 = 4 THEN 'http_404' WHEN id % 17 = 5 THEN 'http_500'"


def q(sql: str | None = None, ctes: tuple[str, ...] = ()):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = (f"WITH {', '.join(ctes)} " if ctes else "") + sql
        return f

    return add


# ---------------------------------------------------------------- inputs
def calendar(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.when(F.col("o_orderstatus") == "F", "finished").when(F.col("o_orderstatus") == "O", "notstarted").otherwise("postponed")
    return enc.matches(spark, sf).select(F.col("o_orderkey").alias("match_id"), enc.season_id(F.col("n_nationkey"), F.col("year")).alias("season_id"), F.col("n_nationkey").cast("long").alias("tournament_id"), kind.alias("status_type"), F.when(kind == "finished", 100).otherwise(0).alias("status_code"), (F.col("o_orderkey") % 2 == 0).alias("has_xg"), (F.col("o_orderkey") % 3 == 0).alias("has_player_heat_map"))


def audit(spark: SparkSession, sf: str) -> DataFrame:
    k = (F.col("o_orderkey") + F.col("idx")) % 5
    rows = table(spark, sf, "orders").select("o_orderkey", F.posexplode(F.array(*map(F.lit, enc.COMPONENTS))).alias("idx", "component_name")).where((F.col("o_orderkey") + F.col("idx")) % 3 == 0)
    status = F.element_at(F.array(*map(F.lit, ("PENDING", "SUCCESS", "QA_MISMATCH", "API_ERROR", "UNAVAILABLE"))), k.cast("int") + 1)
    return rows.select((F.col("o_orderkey") * 10 + F.col("idx")).alias("audit_id"), F.col("o_orderkey").alias("match_id"), "component_name", status.alias("status"), (F.col("o_orderkey") % 4).cast("int").alias("retry_count"), F.when(k.isin(2, 3), F.concat(F.lit("e"), F.col("o_orderkey").cast("string"))).alias("error_message"))


def valid(made: DataFrame, contract: str, *only: str) -> DataFrame:
    """Valid documents; with ``only``, parsed holds these members for sure and others perhaps."""
    return validate_payload(made, CONTRACTS[contract], only=only or None).where("is_valid")


def stored(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """Rows written once, for queries that use them more than once."""
    path = scratch(spark)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def odds_rows(spark: SparkSession, sf: str) -> DataFrame:
    return flatten.odds(clean_odds(enc.enc_odds(spark, sf)).where("is_valid"))


def markets(spark: SparkSession, sf: str) -> DataFrame:
    one = parse_markets(enc.enc_odds(spark, sf)).select(F.col("entity_id").alias("match_id"), F.explode("doc.markets").alias("m"))
    return one.select("match_id", F.col("m.marketId").cast("int").alias("market_id"), F.col("m.marketName").alias("market_name"), F.col("m.marketGroup").alias("market_group"), F.col("m.choices").alias("choices"))


def choice_names(df: DataFrame, choices) -> DataFrame:
    return df.select("match_id", "market_id", F.posexplode(choices).alias("pos", "c")).select("match_id", "market_id", (F.col("pos") + 1).alias("pos"), F.col("c.name").alias("name"))


def folded(spark: SparkSession, sf: str) -> DataFrame:
    return tasks.fold_attempts(enc.enc_attempts(spark, sf))


def run_fps(spark: SparkSession, sf: str) -> DataFrame:
    return cns.with_fingerprints(enc.enc_runs(spark, sf), enc.RUN_CONTRACTS)


def run_consensus(spark: SparkSession, sf: str) -> DataFrame:
    return cns.consensus(cns.groups(run_fps(spark, sf)))


# ---------------------------------------------------------------- sources
@q(f"SELECT id AS entity_id, NOT (id % 17 IN (1, 3)) AS has_payload FROM (SELECT CAST(n_nationkey AS BIGINT) AS id FROM nation)")
def src_payload_scan(spark, sf):
    path = scratch(spark)
    enc.enc_landing(spark, sf, enc.enc_tournament(spark, sf), "tournament").write.partitionBy("component").parquet(path)
    return landing.read_landing(spark, path, "tournament").select("entity_id", F.col("payload").isNotNull().alias("has_payload"))


@q("SELECT component_name AS component, match_id AS entity_id, '/event/' || CAST(match_id AS VARCHAR) || ['', '/statistics', '/lineups', '/incidents', '/graph', '/odds/1/all'][idx + 1] AS url, match_id % 2 = 0 AS landed FROM (SELECT a.*, idx FROM audit a JOIN c USING (component_name)) WHERE status = 'PENDING'", (AUDIT,))
def src_request_manifest(spark, sf):
    todo = audit(spark, sf).where("status = 'PENDING'").select(F.col("component_name").alias("component"), F.col("match_id").alias("entity_id"))
    have = table(spark, sf, "orders").where("o_orderkey % 2 = 0").select(F.explode(F.array(*map(F.lit, enc.COMPONENTS))).alias("component"), F.col("o_orderkey").alias("entity_id"), F.lit("{}").alias("payload"))
    return landing.request_manifest(todo, have)


@q("SELECT match_id, season_id, match_id % 2 = 0 AS has_xg, match_id % 3 = 0 AS has_player_heat_map FROM m WHERE status_type = 'finished' AND yr = 1995", (M,))
def src_table_scan(spark, sf):
    path = scratch(spark)
    calendar(spark, sf).withColumn("year", F.col("season_id") % 10000).write.partitionBy("year").parquet(path)
    return spark.read.parquet(path).where("year = 1995 and status_type = 'finished'").select("match_id", "season_id", "has_xg", "has_player_heat_map")


@q("SELECT o_orderkey AS match_id FROM orders UNION ALL SELECT -1")
def src_id_list(spark, sf):
    path = scratch(spark)
    ids = table(spark, sf, "orders").select(F.col("o_orderkey").alias("i"))
    ids.withColumn("page", F.shiftright("i", enc.PAGE_BITS)).groupBy("page").agg(F.collect_list("i").alias("match_ids")).select("match_ids").write.option("maxRecordsPerFile", 1).json(path)  # one document a file
    return landing.id_list(spark, path, []).union(landing.id_list(spark, path + "-absent", [-1]))


# ---------------------------------------------------------------- contracts
SPOILED = "id % 19 = 4"


def _checked(name, made, contract, ids, bad=SPOILED, landing_name=None, spoil=None):
    """Registers val_<name>: reason of each landed document.  With ``spoil``,
    some documents have one text replaced by another that breaks the contract."""

    def run(spark, sf):
        docs = made(spark, sf)
        if spoil:
            docs = docs.withColumn("payload", F.when(F.col("entity_id") % 19 == 4, F.replace("payload", F.lit(spoil[0]), F.lit(spoil[1]))).otherwise(F.col("payload")))
        rows = enc.enc_landing(spark, sf, docs, landing_name or name)
        rows = clean_odds(rows) if contract == "odds" else validate_payload(rows, CONTRACTS[contract])
        rows = rows.select("entity_id", "is_valid", F.coalesce("reason", F.lit("ok")).alias("reason"))
        return rows.distinct() if made is enc.enc_events else rows  # a season's calendar has pages

    run.__name__ = f"val_{name}"
    ctes = (M,) if " m" in ids else ()
    q(f"SELECT id AS entity_id, reason = 'ok' AS is_valid, reason FROM (SELECT id, {BAD5} WHEN {bad} THEN 'invalid_contract' ELSE 'ok' END AS reason FROM ({ids}))", ctes)(run)


ORDER_IDS, USER_IDS = "SELECT o_orderkey AS id FROM orders", "SELECT DISTINCT user_id AS id FROM events"
_checked("tournament", enc.enc_tournament, "tournament", "SELECT CAST(n_nationkey AS BIGINT) AS id FROM nation", spoil=('"slug"', '"slag"'))
_checked("seasons", enc.enc_seasons, "seasons", "SELECT DISTINCT CAST(c_nationkey AS BIGINT) AS id FROM orders JOIN customer ON o_custkey = c_custkey", spoil=('"year"', '"jear"'))
_checked("events", enc.enc_events, "events", "SELECT DISTINCT season_id AS id FROM m", spoil=('"nameCode"', '"nameKode"'))
_checked("base", enc.enc_base, "base", ORDER_IDS, "id % 19 = 4 AND id % 6 <> 0", spoil=('"yellowRedCards"', '"yellowRetCards"'))  # without a referee nothing is broken
_checked("stats", enc.enc_stats, "stats", ORDER_IDS, spoil=('"statistics"', '"statistix"'))
_checked("lineups", enc.enc_lineups, "lineups", ORDER_IDS, spoil=('"players"', '"playerz"'))
_checked("incidents", enc.enc_incidents, "incidents", USER_IDS, spoil=('"incidents"', '"incidentz"'))
_checked("graph", enc.enc_graph, "graph", USER_IDS, spoil=('"periodTime":', '"periodTime":"x","was":'))
_checked("odds", enc.enc_odds, "odds", ORDER_IDS, "id IN (SELECT l_orderkey FROM lineitem WHERE l_partkey % 97 = 0)")


@q("SELECT l_orderkey, l_linenumber, l_partkey, CASE k WHEN 0 THEN CAST(l_quantity AS INT) WHEN 1 THEN NULL WHEN 2 THEN NULL WHEN 3 THEN NULL ELSE 0 END AS num, CASE k WHEN 0 THEN l_linenumber WHEN 4 THEN 1 END AS den FROM (SELECT *, l_partkey % 5 AS k FROM lineitem)")
def val_fraction(spark, sf):
    n = F.col("l_quantity").cast("int").cast("string")
    k = F.col("l_partkey") % 5
    text = F.when(k == 0, F.concat(n, F.lit(" / "), F.col("l_linenumber").cast("string"))).when(k == 1, F.concat(n, F.lit("-6"))).when(k == 2, n).when(k == 3, F.concat(n, F.lit("/two"))).otherwise("0/1")
    return table(spark, sf, "lineitem").withColumn("t", text).withColumn("f", F.expr(fraction("t"))).select("l_orderkey", "l_linenumber", "l_partkey", "f.num", "f.den")


@q("SELECT o_orderkey, CASE k WHEN 3 THEN NULL WHEN 4 THEN 1 ELSE o_custkey END AS as_int, CASE k WHEN 3 THEN o_custkey + 0.5 WHEN 4 THEN 1.0 ELSE CAST(o_custkey AS DOUBLE) END AS as_float, CASE WHEN k = 4 THEN true WHEN k <= 2 AND o_custkey = 1 THEN true WHEN k <= 2 AND o_custkey = 0 THEN false END AS as_bool FROM (SELECT *, o_orderkey % 5 AS k FROM orders)")
def val_coerce(spark, sf):
    k, c = F.col("o_orderkey") % 5, F.col("o_custkey").cast("string")
    text = F.when(k == 0, c).when(k == 1, F.concat(c, F.lit(".0"))).when(k == 2, F.concat(F.lit('"'), c, F.lit('"'))).when(k == 3, F.concat(c, F.lit(".5"))).otherwise("true")
    leaf = F.from_json(F.concat(F.lit('{"x":'), text, F.lit("}")), "x string")["x"]
    return table(spark, sf, "orders").withColumn("leaf", leaf).select("o_orderkey", *(F.expr(coerce("leaf", kind)).alias(f"as_{kind}") for kind in ("int", "float", "bool")))


@q("SELECT match_id AS entity_id, match_id % 5 <> 2 AND match_id % 5 <> 3 AS is_valid, CASE match_id % 5 WHEN 2 THEN 'event.hasXg:null' WHEN 3 THEN 'event.slug:missing' ELSE '' END AS faults, CASE WHEN match_id % 5 IN (2, 3) THEN NULL WHEN match_id % 5 = 1 THEN false ELSE match_id % 2 = 0 END AS has_xg, CASE WHEN match_id % 5 IN (2, 3) THEN NULL WHEN status_type = 'finished' AND match_id % 3 = 0 THEN 2 ELSE 0 END AS injury1 FROM m", (M,))
def val_required_default(spark, sf):
    k = F.col("entity_id") % 5
    has = r'"hasXg":(true|false),'
    text = F.when(k == 1, F.regexp_replace("payload", has, "")).when(k == 2, F.replace(F.regexp_replace("payload", has, ""), F.lit('{"event":{'), F.lit('{"event":{"hasXg":null,'))).when(k == 3, F.regexp_replace("payload", r'^\{"event":\{"slug":"[^"]*",', '{"event":{')).otherwise(F.col("payload"))
    out = validate_payload(enc.enc_base(spark, sf).withColumn("payload", text), CONTRACTS["base"])
    faults = F.array_join(F.transform("errors", lambda e: F.concat_ws(":", e["path"], e["code"])), ",")
    return out.select("entity_id", "is_valid", faults.alias("faults"), F.when(F.col("is_valid"), F.col("parsed.event.hasXg")).alias("has_xg"), F.when(F.col("is_valid"), F.col("parsed.event.time.injuryTime1")).alias("injury1"))


@q("SELECT match_id, status_type = 'finished' AS has_time, status_type = 'finished' AS has_score, CASE WHEN status_type = 'finished' THEN CASE WHEN home > away THEN 1 WHEN home < away THEN 2 ELSE 3 END END AS winner_code FROM m", (M,))
def val_status_normalise(spark, sf):
    from ..functions.validate import normalise_status

    e = F.col("e")
    return valid(enc.enc_base(spark, sf), "base").select(F.col("entity_id").alias("match_id"), normalise_status(F.col("parsed.event")).alias("e")).select("match_id", e["time"].isNotNull().alias("has_time"), e["homeScore"].isNotNull().alias("has_score"), e["winnerCode"].alias("winner_code"))


@q("SELECT o_orderkey AS entity_id, CASE o_orderkey % 17 WHEN 4 THEN 404 WHEN 5 THEN 500 END AS code FROM orders")
def val_error_envelope(spark, sf):
    return enc.enc_landing(spark, sf, enc.enc_lineups(spark, sf), "lineup").select("entity_id", envelope_code(F.col("payload")).alias("code"))


@q("SELECT user_id AS entity_id, user_id % 17 IN (1, 2, 3) AS empty FROM (SELECT DISTINCT user_id FROM events)")
def val_empty_payload(spark, sf):
    return enc.enc_landing(spark, sf, enc.enc_graph(spark, sf), "graph").select("entity_id", is_empty(F.col("payload")).alias("empty"))


@q("SELECT o_orderkey AS entity_id, true AS is_valid, false AS in_parsed, true AS in_raw FROM orders")
def val_unknown_fields(spark, sf):
    made = enc.enc_stats(spark, sf).withColumn("payload", F.regexp_replace("payload", r"^\{", '{"surprise":1,'))
    return validate_payload(made, CONTRACTS["stats"]).select("entity_id", "is_valid", F.to_json("parsed").contains("surprise").alias("in_parsed"), F.col("payload").contains("surprise").alias("in_raw"))


@q(f"SELECT id AS entity_id, reason, CASE WHEN reason = 'invalid_contract' THEN n ELSE 0 END AS n_errors FROM (SELECT id, n, {BAD5} WHEN n > 0 THEN 'invalid_contract' END AS reason FROM (SELECT o_orderkey AS id, 2 * count(*) FILTER (WHERE l_partkey % 97 = 0) AS n FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1)) WHERE reason IS NOT NULL")
def val_reject_sink(spark, sf):
    from ..functions.validate import quarantine

    _, bad = quarantine(clean_odds(enc.enc_landing(spark, sf, enc.enc_odds(spark, sf), "odds")))
    return bad.select("entity_id", "reason", F.when(F.col("reason") == "invalid_contract", F.size("errors")).otherwise(0).alias("n_errors"))


# ---------------------------------------------------------------- odds cleaning
@q("SELECT DISTINCT match_id, market_id, corrupted FROM o", (O,))
def san_duplicate_flag(spark, sf):
    return markets(spark, sf).select("match_id", "market_id", sanitise.duplicate_flag(F.col("choices")).alias("corrupted"))


@q("SELECT match_id, market_id, pos, n1 AS name FROM o", (O,))
def san_names_1x2(spark, sf):
    return choice_names(markets(spark, sf), sanitise.names_1x2(F.col("market_group"), F.col("choices")))


@q("SELECT match_id, market_id, pos, n6 AS name FROM o", (O,))
def san_names_first_team(spark, sf):
    return choice_names(markets(spark, sf), sanitise.names_first_team(F.col("market_name"), F.col("choices")))


@q("SELECT match_id, market_id, pos, n17 AS name FROM o", (O,))
def san_names_asian(spark, sf):
    return choice_names(markets(spark, sf), sanitise.names_asian(F.col("market_name"), F.col("choices")))


@q("SELECT match_id, market_id, pos, raw_name || CASE WHEN raw_rn > 1 THEN '_dup_' || CAST(raw_rn - 1 AS VARCHAR) ELSE '' END AS name FROM o", (O,))
def san_dedupe_names(spark, sf):
    return choice_names(markets(spark, sf), sanitise.dedupe_names(F.col("choices")))


def _flags(df, flags):
    return df.select("match_id", "market_id", F.posexplode(flags).alias("pos", "winning")).withColumn("pos", F.col("pos") + 1)


@q("SELECT match_id, market_id, pos, w AS winning FROM o", (O,))
def san_winning_bool(spark, sf):
    return _flags(markets(spark, sf), F.transform("choices", lambda c: sanitise.winning_bool(c["winning"])))


@q("SELECT match_id, market_id, pos, CASE WHEN NOT corrupted THEN first_win END AS winning FROM o", (O,))
def san_winning_corrupt(spark, sf):
    return _flags(markets(spark, sf), sanitise.winning_flags(F.col("choices"), sanitise.duplicate_flag(F.col("choices"))))


@q("SELECT match_id, market_id, pos, first_win AS winning FROM o", (O,))
def san_single_winner(spark, sf):
    return _flags(markets(spark, sf), sanitise.single_winner(F.transform("choices", lambda c: sanitise.winning_bool(c["winning"]))))


# ---------------------------------------------------------------- flat rows
@q("SELECT CAST(n_nationkey AS BIGINT) AS tournament_id, n_name AS name, 'football' AS sport, r_name AS country, true AS has_raw FROM nation JOIN region ON n_regionkey = r_regionkey")
def flt_tournament(spark, sf):
    return flatten.tournaments(valid(enc.enc_tournament(spark, sf), "tournament")).withColumn("has_raw", F.col("raw").isNotNull()).drop("raw")


@q("SELECT DISTINCT season_id, CAST(n_nationkey AS BIGINT) AS tournament_id, lpad(CAST(yr % 100 AS VARCHAR), 2, '0') || '/' || lpad(CAST((yr + 1) % 100 AS VARCHAR), 2, '0') AS year, 'Season ' || CAST(yr AS VARCHAR) AS name, season_id AS raw_id FROM m", (M,))
def flt_seasons(spark, sf):
    return flatten.seasons(valid(enc.enc_seasons(spark, sf), "seasons")).withColumn("raw_id", F.get_json_object("raw", "$.id").cast("long")).drop("raw")


@q("SELECT match_id, season_id, CAST(n_nationkey AS BIGINT) AS tournament_id, lower(c_name) || '-' || lower(n_name) AS slug, lower(c_name) AS home_slug, lower(n_name) AS away_slug, CAST(month(o_orderdate) AS BIGINT) AS round, status_type, CAST(status_code AS BIGINT) AS status_code, CASE WHEN match_id % 10 = 3 THEN 0 ELSE CAST(epoch(o_orderdate) AS BIGINT) END AS start_timestamp, CASE WHEN status_code = 100 THEN CASE WHEN home > away THEN 1 WHEN home < away THEN 2 ELSE 3 END END AS winner_code, match_id % 5 = 0 AS has_global_highlights, match_id % 2 = 0 AS has_xg, match_id % 7 = 0 AS has_player_statistics, match_id % 3 = 0 AS has_player_heat_map, CAST(NULL AS VARCHAR) AS error FROM m", (M,))
def flt_events(spark, sf):
    return flatten.events(valid(enc.enc_events(spark, sf), "events")).drop("raw")


@q("SELECT match_id, season_id, status_type, c_name AS home_team, n_name AS away_team, CASE WHEN status_code = 100 THEN home END AS home_score, CASE WHEN status_code = 100 THEN away END AS away_score, CASE WHEN status_code = 100 THEN home // 2 END AS home_score_ht, CASE WHEN match_id % 4 <> 0 THEN 'M. ' || c_name END AS home_manager, n_name || ' Arena' AS venue, r_name AS venue_city, CASE WHEN match_id % 6 <> 0 THEN 'Ref ' || o_orderpriority END AS referee, cents % 50000 AS attendance, CASE WHEN status_code = 100 AND match_id % 3 = 0 THEN 2 ELSE 0 END AS injury_time1, lower(c_name) AS home_slug, lower(n_name) AS away_slug, c_name || ' Park' AS home_venue, n_name || ' Park' AS away_venue, n_name AS home_venue_city, n_name AS away_venue_city, CASE WHEN match_id % 10 <> 3 THEN CAST(epoch(o_orderdate) AS BIGINT) END AS start FROM m", (M,))
def flt_match(spark, sf):
    return flatten.match(valid(enc.enc_base(spark, sf), "base")).select("match_id", "season_id", "status_type", "home_team", "away_team", "home_score", "away_score", "home_score_ht", "home_manager", "venue", "venue_city", "referee", "attendance", "injury_time1", "home_slug", "away_slug", "home_venue", "away_venue", "home_venue_city", "away_venue_city", F.unix_timestamp("start_time").alias("start"))


@q("SELECT match_id, player_id, side, CAST(seq AS INT) AS seq, team_id, shirt_number, substitute, position, goals, minutes_played, assists FROM p", (L,))
def flt_lineups(spark, sf):
    return flatten.lineups(valid(enc.enc_lineups(spark, sf), "lineups")).select("match_id", "player_id", "side", "seq", "team_id", "shirt_number", "substitute", "position", "goals", "minutes_played", "assists")


@q("SELECT user_id AS match_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS seq, CASE event_type WHEN 'click' THEN 'goal' WHEN 'error' THEN 'card' WHEN 'purchase' THEN 'substitution' WHEN 'signup' THEN 'period' ELSE 'injuryTime' END AS incident_type, minute(ts) + 60 * (hour(ts) % 2) AS time, CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 0 WHEN 'view' THEN 0 WHEN 'signup' THEN 999 ELSE CASE WHEN event_id % 2 = 0 THEN 3 END END AS added_time, CASE WHEN event_type IN ('click', 'purchase') THEN event_id % 2 = 0 WHEN event_type = 'error' THEN CASE WHEN event_id % 3 <> 0 THEN true END ELSE false END AS is_home FROM events")
def flt_incidents(spark, sf):
    return flatten.incidents(valid(enc.enc_incidents(spark, sf), "incidents")).drop("data")


@q("SELECT match_id, period, group_name, stat_key, 'Stat ' || CAST(l_linenumber AS VARCHAR) AS name, CAST(CAST(home_value AS INT) AS VARCHAR) AS home, CAST(l_linenumber % 3 AS BIGINT) AS compare_code, home_value, away_value FROM s", (S,))
def flt_statistics(spark, sf):
    return flatten.statistics(valid(enc.enc_stats(spark, sf), "stats")).select("match_id", "period", "group_name", "stat_key", "name", "home", "compare_code", "home_value", "away_value")


@q("SELECT user_id AS match_id, 45 AS period_time, 15 AS overtime_length, 2 AS period_count, CASE WHEN user_id % 10 <> 0 THEN count(*) END AS n_points FROM events GROUP BY user_id")
def flt_graph(spark, sf):
    return flatten.graph(valid(enc.enc_graph(spark, sf), "graph")).withColumn("n_points", F.when(F.col("points").isNotNull(), F.size(F.from_json("points", "array<string>")))).drop("points")


@q("SELECT user_id AS match_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS DOUBLE) AS minute, coalesce(CAST(round(value) AS BIGINT), 0) AS value FROM events WHERE user_id % 10 <> 0")
def flt_graph_points(spark, sf):
    return flatten.graph_points(flatten.graph(valid(enc.enc_graph(spark, sf), "graph")))


ODDS_SQL = "SELECT match_id, CAST(market_id AS BIGINT) AS market_id, market_name, coalesce(choice_group, 'default') AS choice_group, name AS choice_name, q AS initial_num, l_linenumber AS initial_den, q + 1 AS num, l_linenumber AS den, CASE WHEN NOT corrupted THEN first_win END AS winning, CAST(l_linenumber % 3 - 1 AS BIGINT) AS change, false AS is_live, false AS suspended FROM o WHERE NOT bad"


@q(ODDS_SQL, (O,))
def flt_odds(spark, sf):
    return odds_rows(spark, sf).drop("raw")


@q("SELECT match_id, CASE WHEN match_id % 4 <> 0 THEN 'M. ' || c_name ELSE 'none' END AS manager, CASE WHEN match_id % 4 <> 0 AND status_code = 100 THEN CASE WHEN home > away THEN 1 WHEN home < away THEN 2 ELSE 3 END END AS winner FROM m", (M,))
def exp_safe_get(spark, sf):
    e = F.col("parsed.event")
    manager = e["homeTeam"]["manager"]
    return valid(enc.enc_base(spark, sf), "base").select(F.col("entity_id").alias("match_id"), safe_get(manager, "name", F.lit("none")).alias("manager"), F.when(manager.isNotNull(), e["winnerCode"]).alias("winner"))


@q("SELECT o_orderkey AS match_id, CASE WHEN o_orderkey % 10 <> 3 THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS at FROM orders")
def exp_epoch_utc(spark, sf):
    seconds = F.when(F.col("o_orderkey") % 10 == 3, 0).otherwise(F.unix_timestamp("o_orderdate"))
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("match_id"), F.date_format(epoch_utc(seconds), "yyyy-MM-dd HH:mm:ss").alias("at"))


@q("SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, lower(n_name) AS slug, CAST(r_regionkey AS BIGINT) AS category_id, CAST(1 AS BIGINT) AS sport_id, '{\"id\":' || CAST(n_nationkey AS VARCHAR) || ',\"name\":\"' || n_name || '\",\"slug\":\"' || lower(n_name) || '\",\"category_id\":' || CAST(r_regionkey AS VARCHAR) || ',\"sport_id\":1}' AS record FROM nation JOIN region ON n_regionkey = r_regionkey")
def exp_flat_record(spark, sf):
    rows = valid(enc.enc_tournament(spark, sf), "tournament").select(F.col("parsed.tournament").alias("t"))
    return flatten.flat_record(rows, "t", {"category_id": "category.id", "sport_id": "category.sport.id"})


# ---------------------------------------------------------------- two captures
def compared(spark, sf):
    return qa.compare(qa.pair(enc.enc_ab(spark, sf)), enc.AB_CONTRACT)


@q("SELECT entity_id, NOT na AS has_a, NOT nb AS has_b FROM v", (AB,))
def qa_pair(spark, sf):
    return qa.pair(enc.enc_ab(spark, sf)).select("entity_id", F.col("a").isNotNull().alias("has_a"), F.col("b").isNotNull().alias("has_b"))


@q("SELECT entity_id, CASE WHEN na THEN 'absent' WHEN no_a THEN 'invalid' ELSE 'valid' END AS a_state, CASE WHEN nb THEN 'absent' WHEN no_b THEN 'invalid' ELSE 'valid' END AS b_state, verdict FROM v", (AB,))
def qa_verdict(spark, sf):
    return compared(spark, sf).select("entity_id", "a_state", "b_state", "verdict")


@q("""SELECT entity_id, 'a.y' AS path, y AS a, 'changed' AS b FROM v WHERE ch AND NOT no_b UNION ALL SELECT entity_id, 'n', n, NULL FROM v WHERE ch_n AND NOT no_b
UNION ALL SELECT entity_id, 'tags', '["' || n || '","t1"]', '["' || n || '","t2"]' FROM v WHERE ch_t AND NOT no_b""", (AB,))
def qa_delta(spark, sf):
    return compared(spark, sf).where("a_state = 'valid' and b_state = 'valid'").select("entity_id", F.explode("delta").alias("d")).select("entity_id", "d.path", "d.a", "d.b")


@q("""SELECT entity_id, CASE WHEN ch THEN 'QA Mismatch | Delta: [{"path":"a.y","a":"' || y || '","b":"changed"}' || CASE WHEN ch_n THEN ',{"path":"n","a":"' || n || '"}' ELSE '' END
|| CASE WHEN ch_t THEN ',{"path":"tags","a":"[\\"' || n || '\\",\\"t1\\"]","b":"[\\"' || n || '\\",\\"t2\\"]"}' ELSE '' END || ']' END AS message, true AS short FROM v WHERE NOT no_b""", (AB,))
def qa_delta_message(spark, sf):
    rows = compared(spark, sf).where("b_state = 'valid'")
    return rows.select("entity_id", F.when(F.size("delta") > 0, qa.delta_message(F.col("delta"))).alias("message"), (F.length(qa.delta_message(F.col("delta"))) <= 500).alias("short"))


@q("SELECT entity_id, CASE WHEN entity_id % 19 = 0 THEN 'API_ERROR' WHEN verdict = 'match' THEN 'SUCCESS' WHEN verdict = 'unavailable' THEN 'UNAVAILABLE' ELSE 'QA_MISMATCH' END AS status, CASE WHEN entity_id % 19 = 0 OR verdict = 'mismatch' THEN 1 ELSE 0 END AS retry, entity_id % 19 <> 0 AND verdict = 'match' AS keep FROM v", (AB,))
def qa_route(spark, sf):
    return compared(spark, sf).select("entity_id", qa.route(F.col("verdict"), F.col("entity_id") % 19 == 0).alias("r")).select("entity_id", "r.status", "r.retry", "r.keep")


@q("SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN '{\"raw_value\":{\"a\":\"' || o_orderstatus || '\",\"b\":\"x\"}}' WHEN o_orderkey % 3 = 1 THEN '{\"raw_value\":{\"a\":\"' || o_orderstatus || '\",\"b\":null}}' END AS delta FROM orders")
def qa_raw_equal(spark, sf):
    k = F.col("o_orderkey") % 3
    other = F.when(k == 0, "x").when(k == 2, F.col("o_orderstatus"))
    return table(spark, sf, "orders").select("o_orderkey", qa.raw_equal(F.col("o_orderstatus"), other).alias("delta"))


# ---------------------------------------------------------------- tasks
@q("SELECT match_id, season_id, match_id % 2 = 0 AS has_xg, match_id % 3 = 0 AS has_player_heat_map FROM m WHERE status_type = 'finished'", (M,))
def tsk_finished(spark, sf):
    return tasks.finished(calendar(spark, sf))


@q("SELECT match_id, season_id FROM m WHERE status_type = 'finished' AND match_id NOT IN (SELECT match_id FROM audit WHERE component_name = 'stats')", (M, AUDIT))
def tsk_missing(spark, sf):
    return tasks.missing(tasks.finished(calendar(spark, sf)), audit(spark, sf), "stats").select("match_id", "season_id")


@q("SELECT match_id, component_name, component_name <> 'graph' OR match_id % 3 = 0 AS ok FROM m, c WHERE status_type = 'finished'", (M, C))
def tsk_prereq_check(spark, sf):
    every = tasks.finished(calendar(spark, sf)).select("*", F.explode(F.array(*map(F.lit, enc.COMPONENTS))).alias("component_name"))
    return every.select("match_id", "component_name", tasks.prerequisite(F.col("component_name")).alias("ok"))


@q("SELECT match_id, CASE WHEN match_id % 3 = 0 THEN 'PENDING' ELSE 'SKIPPED_MISSING' END AS strict, 'PENDING' AS lax FROM m", (M,))
def tsk_status(spark, sf):
    ok = F.col("has_player_heat_map")
    return calendar(spark, sf).select("match_id", tasks.status_of(ok).alias("strict"), tasks.status_of(ok, strict=False).alias("lax"))


@q("SELECT match_id, 'graph' AS component_name, CASE WHEN match_id % 3 = 0 THEN 'PENDING' ELSE 'SKIPPED_MISSING' END AS status, 0 AS retry_count FROM m WHERE status_type = 'finished' AND match_id NOT IN (SELECT match_id FROM audit WHERE component_name = 'graph') ORDER BY match_id LIMIT 500", (M, AUDIT))
def tsk_queue_component(spark, sf):
    return tasks.queue_component(calendar(spark, sf), audit(spark, sf), "graph", limit=500)


@q("SELECT component_name, count(match_id) AS queued FROM c LEFT JOIN (SELECT match_id, component_name FROM m, c WHERE status_type = 'finished' AND (component_name <> 'graph' OR match_id % 3 = 0) AND (match_id, component_name) NOT IN (SELECT (match_id, component_name) FROM audit)) USING (component_name) GROUP BY 1", (M, AUDIT))
def tsk_queue_components(spark, sf):
    return tasks.queued_by_component(tasks.queue_components(calendar(spark, sf), audit(spark, sf), list(enc.COMPONENTS)), list(enc.COMPONENTS))


@q("SELECT * FROM audit WHERE status IN ('PENDING', 'QA_MISMATCH', 'API_ERROR') AND retry_count < 3 ORDER BY audit_id LIMIT 400", (AUDIT,))
def tsk_pending_batch(spark, sf):
    return tasks.pending_batch(audit(spark, sf), 400)


OUTCOME = "['SUCCESS', 'API_ERROR', 'QA_MISMATCH', 'UNAVAILABLE'][audit_id % 4 + 1]"


@q(f"SELECT audit_id, match_id, component_name, CASE WHEN match_id % 2 = 0 THEN {OUTCOME} ELSE status END AS status, retry_count + CASE WHEN match_id % 2 = 0 AND {OUTCOME} IN ('API_ERROR', 'QA_MISMATCH') THEN 1 ELSE 0 END AS retry_count, CASE WHEN match_id % 2 = 0 AND {OUTCOME} = 'SUCCESS' THEN NULL WHEN match_id % 2 = 0 AND match_id % 3 <> 0 THEN 'n' ELSE error_message END AS error_message FROM audit", (AUDIT,))
def tsk_apply_outcomes(spark, sf):
    now = audit(spark, sf)
    outcome = F.element_at(F.array(*map(F.lit, ("SUCCESS", "API_ERROR", "QA_MISMATCH", "UNAVAILABLE"))), (F.col("audit_id") % 4).cast("int") + 1)
    return tasks.apply_outcomes(now, now.where("match_id % 2 = 0").select("match_id", "component_name", outcome.alias("outcome"), F.when(F.col("match_id") % 3 != 0, "n").alias("message")))


@q("SELECT match_id, component_name, status, retry_count, error_message, attempts, CAST(floor(epoch(last_ts)) AS BIGINT) AS last_at FROM fold", (AT,))
def tsk_fold_attempts(spark, sf):
    return folded(spark, sf).withColumn("last_at", F.unix_timestamp("last_attempted_at")).drop("first_attempted_at", "last_attempted_at")


@q("SELECT audit_id, CASE WHEN hit THEN 'PENDING' ELSE status END AS status, retry_count, hit AS reset FROM (SELECT a.*, status IN ('QA_MISMATCH', 'API_ERROR') AND retry_count < 3 AND n_nationkey = 7 AS hit FROM audit a JOIN m USING (match_id))".replace("a.*, status", "audit_id, a.status, a.retry_count, a.status"), (M, AUDIT))
def tsk_retry_sweep(spark, sf):
    return tasks.retry_sweep(audit(spark, sf), calendar(spark, sf).where("tournament_id = 7")).select("audit_id", "status", "retry_count", "reset")


@q("SELECT match_id, season_id FROM m WHERE status_type = 'finished' AND match_id % 4 = 0", (M,))
def tsk_calendar_delta(spark, sf):
    now = calendar(spark, sf)
    return tasks.calendar_delta(now, now.withColumn("status_type", F.when(F.col("match_id") % 4 == 0, "notstarted").otherwise(F.col("status_type"))))


@q("SELECT season_id, tournament_id, year, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY tournament_id ORDER BY year DESC, season_id DESC) AS rank FROM (SELECT DISTINCT season_id, CAST(n_nationkey AS BIGINT) AS tournament_id, lpad(CAST(yr % 100 AS VARCHAR), 2, '0') || '/' || lpad(CAST((yr + 1) % 100 AS VARCHAR), 2, '0') AS year FROM m)) WHERE rank <= 3", (M,))
def tsk_recent_seasons(spark, sf):
    return tasks.recent_seasons(flatten.seasons(valid(enc.enc_seasons(spark, sf), "seasons")), 3).select("season_id", "tournament_id", "year", "rank")


@q("""SELECT tournament_id, season_id, count(*) AS fetched, count(*) FILTER (WHERE ins) AS inserted, count(*) FILTER (WHERE NOT ins AND ch) AS updated, count(*) FILTER (WHERE fin AND (ins OR ch)) AS newly_finished, CAST(sum(q) AS BIGINT) AS queued, CAST(sum(s) AS BIGINT) AS skipped
FROM (SELECT CAST(n_nationkey AS BIGINT) AS tournament_id, season_id, match_id % 5 = 0 AS ins, match_id % 4 = 0 AND status_type <> 'notstarted' AS ch, status_type = 'finished' AS fin, coalesce(q, 0) AS q, coalesce(s, 0) AS s FROM m LEFT JOIN
(SELECT m.match_id, count(*) FILTER (WHERE c.component_name <> 'graph' OR m.match_id % 3 = 0) AS q, count(*) FILTER (WHERE c.component_name = 'graph' AND m.match_id % 3 <> 0) AS s FROM m CROSS JOIN c LEFT JOIN audit a ON a.match_id = m.match_id AND a.component_name = c.component_name WHERE m.status_type = 'finished' AND a.match_id IS NULL GROUP BY 1) USING (match_id))
GROUP BY ROLLUP (tournament_id, season_id)""", (M, AUDIT))
def tsk_season_backfill(spark, sf):
    now = calendar(spark, sf)
    stored = now.where("match_id % 5 <> 0").withColumn("status_type", F.when(F.col("match_id") % 4 == 0, "notstarted").otherwise(F.col("status_type")))
    return tasks.season_backfill(now.drop("status_code"), stored.drop("status_code"), audit(spark, sf), list(enc.COMPONENTS))[2]


@q("SELECT count(*) AS tasks, count(*) FILTER (WHERE status IN ('SUCCESS', 'UNAVAILABLE')) AS completed, count(*) FILTER (WHERE status = 'SUCCESS') AS succeeded, count(*) FILTER (WHERE status NOT IN ('SUCCESS', 'UNAVAILABLE') AND retry_count < 3) AS pending_total, count(*) FILTER (WHERE status NOT IN ('SUCCESS', 'UNAVAILABLE') AND retry_count < 3) > 0 AS work_left FROM audit", (AUDIT,))
def tsk_batch_progress(spark, sf):
    return tasks.batch_progress(audit(spark, sf))


# ---------------------------------------------------------------- tables
@q("SELECT match_id, player_id, side, team_id, minutes_played FROM (SELECT *, row_number() OVER (PARTITION BY match_id, player_id ORDER BY seq DESC) AS rn FROM p) WHERE rn = 1 UNION ALL SELECT o_orderkey, -1, 'home', 0, 1 FROM orders", (L,))
def snk_keyed_upsert(spark, sf):
    new = flatten.lineups(valid(enc.enc_lineups(spark, sf), "lineups")).select("match_id", "player_id", "side", "team_id", "minutes_played", "seq")
    new = stored(spark, new)
    stale = new.drop("seq").withColumn("minutes_played", F.lit(-5).cast("long")).dropDuplicates(["match_id", "player_id"])
    gone = table(spark, sf, "orders").select(F.col("o_orderkey").alias("match_id"), F.lit(-1).cast("long").alias("player_id"), F.lit("home").alias("side"), F.lit(0).cast("long").alias("team_id"), F.lit(1).cast("long").alias("minutes_played"))
    return tables.keyed_upsert(stale.unionByName(gone), new, ["match_id", "player_id"], [F.col("seq")])


@q(f"SELECT match_id, market_id, choice_name, num FROM ({ODDS_SQL}) WHERE match_id % 2 = 0 UNION ALL SELECT o_orderkey, -1, 'old', 0 FROM orders WHERE o_orderkey % 2 = 1 OR o_orderkey IN (SELECT match_id FROM o WHERE bad)", (O,))
def snk_wipe_replace(spark, sf):
    checked = stored(spark, clean_odds(enc.enc_odds(spark, sf).where("entity_id % 2 = 0")).where("is_valid").select("entity_id", "parsed")).withColumn("payload", F.lit(None).cast("string"))  # this table has no raw
    old = table(spark, sf, "orders").select(F.col("o_orderkey").alias("match_id"), F.lit(-1).cast("long").alias("market_id"), F.lit("old").alias("choice_name"), F.lit(0).alias("num"))
    return tables.wipe_replace(old, checked.select(F.col("entity_id").alias("match_id")), flatten.odds(checked))


@q("""SELECT 'tournament' AS component, count(*) AS n FROM nation UNION ALL SELECT 'seasons', count(DISTINCT season_id) FROM m UNION ALL SELECT 'events', count(*) FROM m UNION ALL SELECT 'base', count(*) FROM m UNION ALL SELECT 'stats', count(*) FROM s UNION ALL SELECT 'lineup', count(*) FROM lineitem
UNION ALL SELECT 'incidents', count(*) FROM events UNION ALL SELECT 'graph', count(DISTINCT user_id) FROM events UNION ALL SELECT 'odds', count(*) FROM o WHERE NOT bad""", (M, S, O))
def snk_route(spark, sf):
    made = {"tournament": enc.enc_tournament, "seasons": enc.enc_seasons, "events": enc.enc_events, "base": enc.enc_base, "stats": enc.enc_stats, "lineup": enc.enc_lineups, "incidents": enc.enc_incidents, "graph": enc.enc_graph, "odds": enc.enc_odds}
    out = None
    for name, f in made.items():
        one = route(name, f(spark, sf))[0].agg(F.count("*").alias("n")).select(F.lit(name).alias("component"), "n")
        out = one if out is None else out.union(one)
    return out


#: Parents that are stored: tournaments but every sixth, their seasons, and matches that aren't postponed.
STORED = "tn AS (SELECT n_nationkey AS id FROM nation WHERE n_nationkey % 6 <> 0), sn AS (SELECT DISTINCT season_id AS id FROM m WHERE n_nationkey % 6 <> 0), ev AS (SELECT o_orderkey AS id FROM orders WHERE o_orderstatus <> 'P')"


def _keys(table, rule, rows, key, n="count(*)", having=""):
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS keys, CAST(sum(n) AS BIGINT) AS n_rows FROM (SELECT {n} AS n FROM {rows} GROUP BY {key} {having}) HAVING count(*) > 0"


RAW_ODDS = "(SELECT * FROM o WHERE NOT bad)"
CONSTRAINTS = " UNION ALL ".join(
    [
        _keys("seasons", "foreign_key:tournament_id", "m WHERE n_nationkey % 6 = 0", "season_id", "1"),
        *(_keys(t, f"foreign_key:{c}", "m WHERE n_nationkey % 6 = 0", "match_id") for t in ("events", "matches") for c in ("tournament_id", "season_id")),
        _keys("matches", "foreign_key:match_id", "orders WHERE o_orderstatus = 'P'", "o_orderkey"),
        _keys("match_component_audit", "foreign_key:match_id", "audit WHERE match_id NOT IN (SELECT id FROM ev)", "audit_id"),
        _keys("match_component_audit", "not_null:status", "audit WHERE match_id % 7 = 0", "audit_id"),
        _keys("match_component_audit", "domain:status", "audit WHERE match_id % 7 = 1", "audit_id"),
        _keys("match_statistics", "unique", "lineitem", "l_orderkey, l_linestatus, l_returnflag, l_linenumber", having="HAVING count(*) > 1"),
        _keys("match_statistics", "foreign_key:match_id", "lineitem WHERE l_orderkey NOT IN (SELECT id FROM ev)", "l_orderkey, l_linestatus, l_returnflag, l_linenumber"),
        _keys("match_player_lineups", "unique", "lineitem", "l_orderkey, l_partkey", having="HAVING count(*) > 1"),
        _keys("match_player_lineups", "foreign_key:match_id", "lineitem WHERE l_orderkey NOT IN (SELECT id FROM ev)", "l_orderkey, l_partkey"),
        _keys("match_incidents", "foreign_key:match_id", "events WHERE user_id NOT IN (SELECT id FROM ev)", "event_id"),
        _keys("match_graph", "foreign_key:match_id", "events WHERE user_id NOT IN (SELECT id FROM ev)", "user_id", "1"),
        _keys("match_odds", "unique", RAW_ODDS, "match_id, market_id, choice_group, raw_name", having="HAVING count(*) > 1"),
        _keys("match_odds", "foreign_key:match_id", "(SELECT * FROM o WHERE NOT bad AND match_id NOT IN (SELECT id FROM ev))", "match_id, market_id, choice_group, raw_name"),
    ]
)


def raw_odds_rows(spark, sf):
    """Odds as they come: names aren't made different."""
    return flatten.odds(valid(enc.enc_odds(spark, sf), "odds"))


def small_tables(spark, sf):
    """Tournaments and their seasons: written once, as their rows and those of others' parents
    come from them; the files tell Spark how few they are, so that no table is sorted by them."""
    return {"tournaments": stored(spark, flatten.tournaments(valid(enc.enc_tournament(spark, sf), "tournament"))), "seasons": stored(spark, flatten.seasons(valid(enc.enc_seasons(spark, sf), "seasons")))}


def stored_parents(spark, sf, small=None):
    small = small or {"tournaments": flatten.tournaments(valid(enc.enc_tournament(spark, sf), "tournament")), "seasons": flatten.seasons(valid(enc.enc_seasons(spark, sf), "seasons"))}
    tournaments, seasons = (small[name].where("tournament_id % 6 <> 0") for name in ("tournaments", "seasons"))
    return {"tournaments": tournaments, "seasons": seasons, "events": table(spark, sf, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("match_id"))}


@q(CONSTRAINTS, (M, O, AUDIT, STORED))
def snk_constraints(spark, sf):
    """Broken rules of all ten tables, counted by rule.  Documents are checked whole; of the
    parsed ones only the columns that a rule looks at are kept."""
    small = small_tables(spark, sf)
    parents = stored_parents(spark, sf, small)
    tasks_ = audit(spark, sf).withColumn("status", F.when(F.col("match_id") % 7 == 0, None).when(F.col("match_id") % 7 == 1, "LOST").otherwise(F.col("status")))
    event = ("id", "status", "time", "homeScore", "awayScore", "season.id", "tournament.id", "homeTeam.slug", "awayTeam.slug")
    incidents = flatten.incidents(valid(enc.enc_incidents(spark, sf), "incidents", "incidents.incidentType")).select("match_id", "seq", "incident_type")
    stats = valid(enc.enc_stats(spark, sf, table(spark, sf, "lineitem")), "stats", "statistics.period", "statistics.groups.groupName", "statistics.groups.statisticsItems.key", "statistics.groups.statisticsItems.name")
    lineups = valid(enc.enc_lineups(spark, sf), "lineups", *(f"{side}.players.{name}" for side in ("home", "away") for name in ("player.id", "player.name", "teamId")))
    rows = small | {
        "events": flatten.events(valid(enc.enc_events(spark, sf), "events", *(f"events.{name}" for name in event))), "matches": flatten.match(valid(enc.enc_base(spark, sf), "base", *(f"event.{name}" for name in event))),
        "match_component_audit": tasks_, "match_statistics": flatten.statistics(stats), "match_player_lineups": flatten.lineups(lineups), "match_incidents": tables.surrogate_ids(incidents, ["match_id", "seq"]),
        "match_graph": flatten.graph(valid(enc.enc_graph(spark, sf), "graph", "periodTime")), "match_odds": raw_odds_rows(spark, sf),
    }
    out = None
    for name, spec in tables.TABLES.items():
        one = tables.violations(rows[name], spec, parents).groupBy("table_name", "rule").agg(F.count("*").alias("keys"), F.sum("n").alias("n_rows"))
        out = one if out is None else out.union(one)
    return out


@q("""SELECT audit_id, match_id, CASE WHEN b THEN 'API_ERROR' ELSE 'SUCCESS' END AS status, retry_count + CASE WHEN b THEN 1 ELSE 0 END AS retry_count, CASE WHEN b THEN 'constraint: ' || CASE WHEN f > 0 THEN 'foreign_key:match_id' || CASE WHEN u > 0 THEN ', unique' ELSE '' END ELSE 'unique' END || ' (' || CAST(u + f AS VARCHAR) || ')' END AS error_message, rows_kept
FROM (SELECT o_orderkey * 10 + 5 AS audit_id, o_orderkey AS match_id, 0 AS retry_count, coalesce(u, 0) AS u, coalesce(f, 0) AS f, coalesce(u, 0) + coalesce(f, 0) > 0 AS b, CASE WHEN coalesce(u, 0) + coalesce(f, 0) = 0 THEN coalesce(n, 0) ELSE 0 END AS rows_kept
FROM orders LEFT JOIN (SELECT match_id, count(*) FILTER (WHERE n > 1) AS u, count(*) FILTER (WHERE match_id NOT IN (SELECT id FROM ev)) AS f, CAST(sum(n) AS BIGINT) AS n FROM (SELECT match_id, count(*) AS n FROM o WHERE NOT bad GROUP BY match_id, market_id, choice_group, raw_name) GROUP BY 1) ON match_id = o_orderkey)""", (M, O, STORED))
def snk_constraint_outcomes(spark, sf):
    """The audit after a load of odds: a match that breaks a rule is an error, and none of its rows are stored."""
    rows = raw_odds_rows(spark, sf)
    kept, failed = tables.admitted(rows, tables.violations(rows, tables.TABLES["match_odds"], stored_parents(spark, sf)), "odds")
    tasks_ = table(spark, sf, "orders").select((F.col("o_orderkey") * 10 + 5).alias("audit_id"), F.col("o_orderkey").alias("match_id"), F.lit("odds").alias("component_name"), F.lit("PENDING").alias("status"), F.lit(0).alias("retry_count"), F.lit(None).cast("string").alias("error_message"))
    done = tasks_.join(failed, ["match_id", "component_name"], "left_anti").select("match_id", "component_name", F.lit("SUCCESS").alias("outcome"), F.lit(None).cast("string").alias("message"))
    after = tasks.apply_outcomes(tasks_, failed.unionByName(done))
    stored = kept.groupBy("match_id").agg(F.count("*").alias("rows_kept"))
    return after.join(stored, "match_id", "left").select("audit_id", "match_id", "status", "retry_count", "error_message", F.coalesce("rows_kept", F.lit(0)).alias("rows_kept"))


IDS = "x AS (SELECT user_id AS match_id, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS INT) AS seq, ts, event_id, event_type FROM events)"


@q("""SELECT match_id, seq, CASE event_type WHEN 'click' THEN 'goal' WHEN 'error' THEN 'card' WHEN 'purchase' THEN 'substitution' WHEN 'signup' THEN 'period' ELSE 'injuryTime' END AS incident_type,
100 + CASE WHEN match_id % 2 = 0 THEN 0 ELSE (SELECT count(*) FROM x WHERE match_id % 2 = 0) END + row_number() OVER (PARTITION BY match_id % 2 ORDER BY match_id, ts, event_id) AS id FROM x""", (IDS,))
def snk_surrogate_id(spark, sf):
    """Incidents of even matches first, those of the others continue from the largest stored id."""
    rows = flatten.incidents(valid(enc.enc_incidents(spark, sf), "incidents")).select("match_id", "seq", "incident_type", "data")
    path = scratch(spark)
    tables.surrogate_ids(rows.where("match_id % 2 = 0"), ["match_id", "seq"], start=100).write.parquet(path)
    stored = spark.read.parquet(path)
    more = tables.surrogate_ids(rows.where("match_id % 2 <> 0"), ["match_id", "seq"], stored, start=100)
    return stored.unionByName(more).select("match_id", "seq", "incident_type", "id")


@q("SELECT 'match_odds' AS table_name, count(*) AS n FROM o WHERE NOT bad", (O,))
def snk_create_schema(spark, sf):
    name = "touchline_" + scratch(spark)[-8:]
    tables.create_schema(spark, name, drop=True)
    columns = [c.split(" ")[0] for c in tables.TABLES["match_odds"].ddl.split(", ")]
    odds_rows(spark, sf).select(*columns).write.insertInto(f"{name}.match_odds")
    return spark.table(f"{name}.match_odds").agg(F.count("*").alias("n")).select(F.lit("match_odds").alias("table_name"), "n")


@q("SELECT match_id, CAST(market_id AS BIGINT) AS market_id, pos, name AS raw_name FROM o WHERE NOT bad", (O,))
def snk_raw_retention(spark, sf):
    one = odds_rows(spark, sf).select("match_id", "market_id", "raw").distinct()
    names = F.from_json(F.get_json_object("raw", "$.choices"), "array<struct<name:string>>")
    return one.select("match_id", "market_id", F.posexplode(names).alias("pos", "c")).select("match_id", "market_id", (F.col("pos") + 1).alias("pos"), F.col("c.name").alias("raw_name"))


@q(
    """SELECT match_id, c_name AS home, CASE WHEN coalesce(bad, false) THEN NULL ELSE coalesce(n_markets, 0) END AS n_markets, 'success' AS base_status, CASE WHEN coalesce(bad, false) THEN 'failed' ELSE 'success' END AS odds_status, CASE WHEN bad THEN 'invalid_contract' END AS odds_message
FROM m LEFT JOIN (SELECT match_id, bool_or(bad) AS bad, CAST(count(DISTINCT market_id) AS INT) AS n_markets FROM o0 GROUP BY 1) USING (match_id)""",
    (M, O),
)
def snk_json_export(spark, sf):
    captures = {"base": validate_payload(enc.enc_base(spark, sf), CONTRACTS["base"]), "odds": clean_odds(enc.enc_odds(spark, sf))}
    documents = export.write_json(export.match_documents(captures), scratch(spark))
    return documents.select(
        "match_id", F.col("base.event.homeTeam.name").alias("home"), F.array_size("odds.markets").alias("n_markets"),
        F.col("errors.base.status").alias("base_status"), F.col("errors.odds.status").alias("odds_status"), F.col("errors.odds.message").alias("odds_message"),
    )


# ---------------------------------------------------------------- summaries
@q("SELECT match_id, " + ", ".join(f"coalesce(bool_or(component_name = '{c}' AND status = 'SUCCESS'), false) AS has_{c}" for c in enc.COMPONENTS) + " FROM fold GROUP BY 1", (AT,))
def sum_component_flags(spark, sf):
    return summary.component_flags(folded(spark, sf))


ERRORS = "e AS (SELECT match_id, coalesce(string_agg(component_name, ', ' ORDER BY idx) FILTER (WHERE status = 'SUCCESS' AND idx < 5), '') AS good, coalesce(string_agg(component_name, ', ' ORDER BY idx) FILTER (WHERE status <> 'SUCCESS' AND idx < 5), '') AS bad, count(*) FILTER (WHERE status = 'SUCCESS' AND idx < 5) AS n_good, count(*) FILTER (WHERE status <> 'SUCCESS' AND idx < 5) AS n_bad FROM fold JOIN c USING (component_name) GROUP BY 1)"


@q("SELECT match_id, good AS successful, bad AS failed, n_bad > 0 AS has_errors FROM e", (AT, ERRORS))
def sum_component_errors(spark, sf):
    return summary.component_errors(folded(spark, sf)).select("match_id", F.array_join("successful", ", ").alias("successful"), F.array_join("failed", ", ").alias("failed"), "has_errors")


@q("SELECT match_id, CAST(n_good AS VARCHAR) || '/' || CAST(n_good + n_bad AS VARCHAR) AS rate FROM e", (AT, ERRORS))
def sum_match_success_rate(spark, sf):
    return summary.component_errors(folded(spark, sf)).select("match_id", summary.success_rate(F.col("successful"), F.col("failed")).alias("rate"))


@q("SELECT match_id, c_name AS home_team, n_name AS away_team, CASE WHEN status_code = 100 THEN CAST(home AS VARCHAR) || '-' || CAST(away AS VARCHAR) ELSE '0-0' END AS score, ['Ended', 'Not started', 'Postponed'][CASE status_code WHEN 100 THEN 1 WHEN 0 THEN 2 ELSE 3 END] AS status, n_name || ' Arena' AS venue FROM m", (M,))
def sum_match_info(spark, sf):
    return summary.match_info(flatten.match(valid(enc.enc_base(spark, sf), "base")))


@q("SELECT match_id, CASE WHEN n_bad = 0 THEN 'No errors' ELSE 'Failed components: ' || bad END AS summary FROM e", (AT, ERRORS))
def sum_error_summary(spark, sf):
    return summary.component_errors(folded(spark, sf)).select("match_id", summary.error_text(F.col("failed")).alias("summary"))


IN_SEASON = "se AS (SELECT e.*, CAST(n_nationkey AS BIGINT) AS tournament_id, season_id, (SELECT min(first_ts) FROM fold WHERE fold.match_id = e.match_id) AS began, (SELECT max(last_ts) FROM fold WHERE fold.match_id = e.match_id) AS ended FROM e LEFT JOIN m USING (match_id))"


def season_errors(spark, sf):
    return summary.component_errors(folded(spark, sf)), calendar(spark, sf)


@q("SELECT tournament_id, season_id, count(*) AS total, count(*) FILTER (WHERE n_bad = 0) AS successful, count(*) FILTER (WHERE n_bad > 0) AS failed, CAST(sum(n_bad) AS BIGINT) AS failed_components, CAST(floor(epoch(max(ended))) - floor(epoch(min(began))) AS BIGINT) AS duration_seconds FROM se GROUP BY 1, 2", (AT, ERRORS, M, IN_SEASON))
def sum_season(spark, sf):
    return summary.season_totals(*season_errors(spark, sf))


@q("SELECT tournament_id, season_id, match_id, 'Failed components: ' || bad AS summary FROM se WHERE n_bad > 0", (AT, ERRORS, M, IN_SEASON))
def sum_season_failures(spark, sf):
    return summary.season_failures(*season_errors(spark, sf))


@q("SELECT tournament_id, season_id, printf('%.1f', round_even(100.0 * count(*) FILTER (WHERE n_bad = 0) / count(*), 1)) || '%' AS rate FROM se GROUP BY 1, 2", (AT, ERRORS, M, IN_SEASON))
def sum_season_rate(spark, sf):
    totals = summary.season_totals(*season_errors(spark, sf))
    return totals.select("tournament_id", "season_id", summary.rate_text(F.col("successful"), F.col("total")).alias("rate"))


@q("SELECT CAST(n_nationkey AS BIGINT) AS tournament_id, n_name || ' (' || r_name || ') - football [' || CAST(n_nationkey AS VARCHAR) || ']' AS info FROM nation JOIN region ON n_regionkey = r_regionkey")
def sum_tournament_info(spark, sf):
    return summary.tournament_info(flatten.tournaments(valid(enc.enc_tournament(spark, sf), "tournament")))


LINES = ", ".join(f"coalesce(min(CASE WHEN market_id = 1 AND name = '{n}' THEN price END), 'N/A') AS full_time_{n.lower()}" for n in ("1", "X", "2")) + ", " + ", ".join(f"coalesce(min(CASE WHEN market_id = 9 AND name = 'Under' AND choice_group = '{g}' THEN price END), 'N/A') AS under_{g.replace('.', '_')}" for g in ("0.5", "1.5", "2.5"))


@q(f"SELECT match_id, {LINES} FROM (SELECT *, CAST(q + 1 AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR) AS price FROM o WHERE NOT bad) GROUP BY 1", (O,))
def sum_odds_lines(spark, sf):
    return summary.odds_lines(odds_rows(spark, sf))


@q("SELECT season_id, count(*) FILTER (WHERE status_code = 100) AS ended, count(*) FILTER (WHERE status_code <> 100) AS other FROM m GROUP BY 1", (M,))
def sum_status_counts(spark, sf):
    return summary.status_counts(flatten.events(valid(enc.enc_events(spark, sf), "events")))


@q("SELECT stat_key, period, round(avg(home_value), 4) AS home_avg, round(sum(home_value), 2) AS home_sum, round(avg(away_value), 4) AS away_avg, round(sum(away_value), 2) AS away_sum, count(*) AS n FROM s GROUP BY ALL", (S,))
def sum_stat_values(spark, sf):
    return summary.stat_values(flatten.statistics(valid(enc.enc_stats(spark, sf), "stats")))


@q("SELECT match_id, period, group_name, stat_key, home_value AS home_1, away_value AS away_1, CASE WHEN l_linenumber <> 7 THEN home_value + 1 END AS home_2, CASE WHEN l_linenumber <> 7 THEN away_value END AS away_2 FROM s WHERE l_linenumber = 7 OR match_id % 5 = 0", (S,))
def sum_run_stat_diff(spark, sf):
    one = stored(spark, flatten.statistics(valid(enc.enc_stats(spark, sf), "stats")).select("match_id", "period", "group_name", "stat_key", "home_value", "away_value"))
    other = one.where("stat_key <> 'k7'").withColumn("home_value", F.when(F.col("match_id") % 5 == 0, F.col("home_value") + 1).otherwise(F.col("home_value")))
    return summary.run_stat_diff(one, other)


# ---------------------------------------------------------------- many runs
@q(f"""SELECT CAST(n_nationkey AS BIGINT) AS tournament_id, season_id, {RUN} AS run_id, component, run AS day, count(*) AS documents, count(*) FILTER (WHERE component = 'stats' OR run < 3 OR match_id % 11 <> 0) AS present, count(DISTINCT match_id) AS matches
FROM r JOIN m USING (match_id) GROUP BY ALL""", (R, M))
def cns_runs(spark, sf):
    """The catalogue of all runs, each saved for itself."""
    root = scratch(spark)
    made = enc.enc_runs(spark, sf).join(calendar(spark, sf).select("match_id", "tournament_id", "season_id"), "match_id")
    for run in enc.RUN_IDS:
        cns.save_run(made.where(F.col("run_id") == run), root)
    return cns.list_runs(spark, root).withColumn("run_at", F.datediff("run_at", F.lit("1970-01-01")).cast("long")).withColumnRenamed("run_at", "day")


@q(f"""SELECT o_orderkey AS match_id, 'stats' AS component, {RUN} AS run_id, CASE WHEN o_orderkey % 23 <> 0 THEN sha256('{{"items":[{{"v":' || CAST(o_custkey AS VARCHAR) || '}}],"kind":"' || o_orderstatus || '","meta":{{"by":"x"}},"total":' || CAST(o_custkey + CASE WHEN (run = 2 AND o_orderkey % 5 = 0) OR (run = 3 AND o_orderkey % 7 = 0) THEN run ELSE 0 END AS VARCHAR) || '}}') END AS fp FROM orders, range(1, 4) z(run)
UNION ALL SELECT o_orderkey, 'graph', {RUN}, CASE WHEN run < 3 OR o_orderkey % 11 <> 0 THEN sha256('{{"points":' || CASE WHEN o_orderkey % 4 = 0 AND ((run = 2 AND o_orderkey % 5 = 0) OR (run = 3 AND o_orderkey % 7 = 0)) THEN '9' ELSE '3' END || ',"total":' || CAST(o_custkey AS VARCHAR) || '}}') END FROM orders, range(1, 4) z(run) WHERE o_orderkey % 2 = 0""")
def cns_fingerprint(spark, sf):
    return run_fps(spark, sf).select("match_id", "component", "run_id", "fp")


ASSESS = """landed AS (SELECT o_orderkey AS id, 'base' AS component, true AS ok FROM orders UNION ALL SELECT o_orderkey, 'stats', count(l_orderkey) > 0 FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
UNION ALL SELECT o_orderkey, 'lineup', count(*) FILTER (WHERE l_linenumber <= 3) >= 2 AND count(*) FILTER (WHERE l_linenumber > 3) >= 2 FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1
UNION ALL SELECT DISTINCT user_id, 'incidents', true FROM events UNION ALL SELECT user_id, 'graph', user_id % 10 <> 0 AND count(*) >= 5 FROM events GROUP BY 1),
a AS (SELECT id AS match_id, component, CASE WHEN id % 17 IN (1, 3) THEN 'missing' WHEN id % 17 IN (4, 5) THEN 'error' WHEN id % 17 = 2 OR NOT ok THEN 'invalid' ELSE 'valid' END AS state, component IN ('base', 'stats', 'lineup') AS required FROM landed)"""
#: Line-ups here are short: two players a side are enough.
RULES = cns.configured(lineup=cns.Rule(True, cns.at_least(2, "home.players", "away.players")))


def states(spark, sf):
    made = {"base": enc.enc_base, "stats": enc.enc_stats, "lineup": enc.enc_lineups, "incidents": enc.enc_incidents, "graph": enc.enc_graph}
    return cns.assess({name: landing.payload_scan(enc.enc_landing(spark, sf, f(spark, sf), name), name) for name, f in made.items()}, RULES)


@q("SELECT * FROM a", (ASSESS,))
def cns_assess(spark, sf):
    return states(spark, sf)


@q("""SELECT match_id, count(*) AS components, count(*) FILTER (WHERE state = 'valid') AS valid, array_to_string([c FOR c IN ['base', 'lineup', 'stats'] IF NOT list_contains(coalesce(list(component) FILTER (WHERE state = 'valid'), []), c)], ',') AS lacking,
count(*) FILTER (WHERE state = 'valid' AND required) = 3 AS complete FROM a GROUP BY 1""", (ASSESS,))
def cns_match_verdict(spark, sf):
    """Whether each match is complete, and what it lacks."""
    return cns.match_verdicts(states(spark, sf), RULES).withColumn("lacking", F.array_join("lacking", ","))


@q("SELECT match_id, component, max(CASE WHEN run = 1 THEN data END) IS NOT DISTINCT FROM max(CASE WHEN run = 3 THEN data END) AS equal FROM r GROUP BY ALL", (R,))
def cns_compare(spark, sf):
    return cns.compare_runs(run_fps(spark, sf), "run2", "run11")


@q("SELECT match_id, component, size, runs FROM g", (R,))
def cns_groups(spark, sf):
    return cns.groups(run_fps(spark, sf)).select("match_id", "component", "size", F.array_join("runs", ",").alias("runs"))


@q("SELECT match_id, component, CAST(total AS BIGINT) AS total, size, coalesce(has_consensus, false) AS has_consensus, CAST(total - size AS INT) AS n_disagreeing FROM cn", (R,))
def cns_consensus(spark, sf):
    return run_consensus(spark, sf).select("match_id", "component", "total", "size", "has_consensus", F.size("disagreeing").alias("n_disagreeing"))


@q("SELECT match_id, count(*) AS components, count(*) FILTER (WHERE has_consensus) AS agreed, bool_and(coalesce(has_consensus, false)) AS full_consensus, bool_and(coalesce(has_consensus, false)) AS ready_for_golden FROM cn GROUP BY 1", (R,))
def cns_season(spark, sf):
    return cns.season(run_consensus(spark, sf))


def spent(spark, sf):
    return table(spark, sf, "orders").where("o_orderkey % 3 = 0").select(F.col("o_orderkey").alias("match_id"), F.lit("stats").alias("component"), F.lit(2).alias("attempts"))


RETRY = "rt AS (SELECT match_id, string_agg(component, ',' ORDER BY component) AS components FROM cn WHERE NOT coalesce(has_consensus, false) AND NOT (component = 'stats' AND match_id % 3 = 0) GROUP BY 1)"


@q("SELECT * FROM rt", (R, RETRY))
def cns_retry_candidates(spark, sf):
    return cns.retry_candidates(run_consensus(spark, sf), spent(spark, sf)).withColumn("components", F.array_join("components", ","))


@q("SELECT *, CAST(rank() OVER (ORDER BY rate, component) AS INT) AS problem_rank FROM (SELECT component, count(*) AS matches, count(*) FILTER (WHERE has_consensus) AS agreed, round(count(*) FILTER (WHERE has_consensus) / count(*), 4) AS rate FROM cn GROUP BY 1)", (R,))
def cns_summary(spark, sf):
    return cns.summary(run_consensus(spark, sf))


@q("""SELECT CAST(n_nationkey AS BIGINT) AS tournament_id, season_id, 3 AS runs, 3 AS last_day, count(*) AS matches, CAST(sum(k) AS BIGINT) AS components, CAST(sum(ok) AS BIGINT) AS agreed, count(*) FILTER (WHERE k = ok) AS golden
FROM (SELECT match_id, count(*) AS k, count(*) FILTER (WHERE has_consensus) AS ok FROM cn GROUP BY 1) JOIN m USING (match_id) GROUP BY 1, 2""", (R, M))
def cns_season_state(spark, sf):
    """Runs, consensus and golden matches of each season."""
    state = cns.season_state(enc.enc_runs(spark, sf), run_consensus(spark, sf), calendar(spark, sf))
    return state.withColumn("last_day", F.datediff("last_run_at", F.lit("1970-01-01"))).drop("last_run_at")


@q("SELECT match_id, string_agg(component || '=run2', ',' ORDER BY component) AS sources, round(count(*) / 2, 4) AS completeness FROM cn WHERE has_consensus GROUP BY 1", (R,))
def cns_golden(spark, sf):
    return cns.golden_matches(cns.golden(run_consensus(spark, sf), run_fps(spark, sf)), 2)


@q("SELECT match_id, round(sum(CASE WHEN state = 'valid' THEN w ELSE 0 END) / sum(w), 4) AS quality_score FROM (SELECT *, CASE component WHEN 'base' THEN 1.0::DOUBLE WHEN 'stats' THEN 0.8::DOUBLE WHEN 'lineup' THEN 0.8::DOUBLE WHEN 'incidents' THEN 0.6::DOUBLE ELSE 0.3::DOUBLE END AS w FROM a) GROUP BY 1", (ASSESS,))
def cns_quality_score(spark, sf):
    return cns.quality_score(states(spark, sf))


@q("SELECT match_id, bool_and(coalesce(has_consensus, false)) AS full_consensus, coalesce(max(components), '') AS retry, max(components) IS NOT NULL AS needs_manual_review FROM cn LEFT JOIN rt USING (match_id) GROUP BY 1", (R, RETRY))
def cns_workflow(spark, sf):
    return cns.workflow(enc.enc_runs(spark, sf), enc.RUN_CONTRACTS, spent(spark, sf))


@q(f"""SELECT x.match_id, 'graph' AS component, {RUN} AS run_id, 'points' AS path, CASE lead WHEN 'd' THEN '9' ELSE '3' END AS a, CASE data WHEN 'd' THEN '9' ELSE '3' END AS b
FROM r x JOIN (SELECT match_id, arg_min(data, (-n, first)) AS lead FROM (SELECT match_id, data, count(*) AS n, min(run) AS first FROM r WHERE component = 'graph' AND data IS NOT NULL GROUP BY 1, 2) GROUP BY 1) y ON x.match_id = y.match_id
WHERE component = 'graph' AND data <> lead""", (R,))
def cns_review_report(spark, sf):
    return cns.review_report(run_fps(spark, sf), "graph", enc.RUN_CONTRACTS["graph"])


# ---------------------------------------------------------------- streams
@q("SELECT match_id, count(*) AS n FROM o WHERE NOT bad AND match_id % 17 NOT IN (1, 2, 3, 4, 5) GROUP BY 1", (O,))
def str_ingest(spark, sf):
    root = scratch(spark)
    land = enc.enc_landing(spark, sf, enc.enc_odds(spark, sf), "odds")
    land.write.parquet(f"{root}/landing")

    check, handle = batch_steps("odds")
    for attempt in (1, 2):  # the second delivery of everything changes nothing
        stream.ingest(spark, f"{root}/landing", landing.LANDING, f"{root}/table", f"{root}/bad{attempt}", f"{root}/checkpoint{attempt}", handle, check, files_a_batch=4, compact_after=3)
    schema = odds_rows(spark, sf).schema
    return store.read(spark, f"{root}/table", schema).groupBy("match_id").agg(F.count("*").alias("n"))


@q("SELECT event_id AS entity_id, event_id % 11 <> 0 AS paired, event_id % 11 = 0 OR event_id % 7 = 0 AS mismatch FROM events")
def str_ab_pair(spark, sf):
    root = scratch(spark)
    rows = table(spark, sf, "events").select(F.col("event_id").alias("entity_id"), F.col("ts").alias("fetched_at"), F.lit("x").alias("payload"))
    end = spark.createDataFrame([(-1, "x")], "entity_id long, payload string").select("entity_id", F.lit("2100-01-01").cast("timestamp").alias("fetched_at"), "payload")
    later = rows.where("entity_id % 11 <> 0").withColumn("fetched_at", F.col("fetched_at") + F.expr("INTERVAL 3 SECONDS")).withColumn("payload", F.when(F.col("entity_id") % 7 == 0, "y").otherwise("x"))
    for name, frame in (("a", rows), ("b", later)):
        frame.write.parquet(f"{root}/{name}")
        end.write.mode("append").parquet(f"{root}/{name}")  # moves the watermark past all others
    read = lambda name: spark.readStream.schema("entity_id long, fetched_at timestamp, payload string").parquet(f"{root}/{name}")
    pairs = stream.ab_pairs(read("a"), read("b")).select(F.col("a_id").alias("entity_id"), F.col("b").isNotNull().alias("paired"), (~F.col("a").eqNullSafe(F.col("b"))).alias("mismatch"))
    pairs.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/checkpoint").outputMode("append").trigger(availableNow=True).start().awaitTermination()
    # filtered here: in the stream the filter would reach the scan and keep the end row from the watermark
    return spark.read.parquet(f"{root}/out").where("entity_id >= 0")


@q("SELECT match_id, component_name, status, retry_count, error_message, CAST(attempts AS INT) AS attempts FROM fold", (AT,))
def str_task_state(spark, sf):
    root = scratch(spark)
    log = enc.enc_attempts(spark, sf)
    for half in (1, 0):  # each task's attempts come in two batches, out of order, each of as many files as there are tasks
        log.where(F.col("attempt_id") % 2 == half).write.mode("append").parquet(f"{root}/attempts")
        states = stream.task_states(spark.readStream.schema(log.schema).parquet(f"{root}/attempts"), late="3650 days", keep_seconds=3650 * 86400)
        states.writeStream.foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/checkpoint").outputMode("update").trigger(availableNow=True).start().awaitTermination()
    out = spark.read.parquet(f"{root}/out")
    last = out.groupBy("match_id", "component_name").agg(F.max_by(F.struct("status", "retry_count", "error_message", "attempts"), "batch").alias("s"))
    return last.select("match_id", "component_name", "s.*")


assert set(REGISTRY) >= set(enc.COMPONENTS)
