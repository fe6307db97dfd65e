"""Ids, the appended store and the streamed state machine, through crashes and repeats."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from touchline.operators import store, tables, tasks
from touchline.streaming import stream


def test_ids_of_many_rows_with_a_payload(spark, tmp_path):
    """More rows than range bounds are sampled from, and a column that the order doesn't need."""
    n = 3_000_000
    rows = spark.range(n, numPartitions=7).select(F.xxhash64("id").alias("x"), F.concat(F.lit("payload"), F.col("id").cast("string")).alias("payload"))
    path = str(tmp_path / "ids")
    tables.surrogate_ids(rows, ["x"], name="n").write.parquet(path)
    made = spark.read.parquet(path)
    assert made.agg(F.countDistinct("n"), F.min("n"), F.max("n"), F.countDistinct("payload")).first()[:] == (n, 1, n, n)
    before = F.lag("x").over(Window.partitionBy(F.shiftright("n", 12)).orderBy("n"))
    assert made.withColumn("before", before).where("before > x").isEmpty()


def test_ids_continue(spark):
    frame = lambda ids: spark.createDataFrame([(i, None if i % 5 == 0 else "v") for i in ids], "k long, v string")
    first = tables.surrogate_ids(frame(range(50)), ["k"], start=10)
    assert [r.id for r in first.orderBy("k").collect()] == list(range(11, 61))
    more = tables.surrogate_ids(frame(range(100, 130)), ["k"], first)
    assert [r.id for r in more.orderBy("k").collect()] == list(range(61, 91))
    assert [r.id for r in tables.surrogate_ids(frame([7, 7, 7]), ["k"], frame([]).withColumn("id", F.lit(1).cast("long"))).orderBy("id").collect()] == [1, 2, 3]
    assert tables.surrogate_ids(frame([]), ["k"]).count() == 0


SCHEMA = "match_id long, v string"


def batch(spark, *rows, keys=()):
    return spark.createDataFrame([(k,) for k in keys], "match_id long"), spark.createDataFrame(list(rows), SCHEMA)


def read(spark, path):
    return sorted(map(tuple, store.read(spark, path, spark.createDataFrame([], SCHEMA).schema).collect()))


def test_batches_replace_their_matches_alone(spark, tmp_path):
    path, far = f"{tmp_path}/t", 1 << store.PART_BITS
    schema = spark.createDataFrame([], SCHEMA).schema
    assert read(spark, path) == []
    store.append(path, *batch(spark, (1, "a"), (1, "b"), (2, "c"), (far, "d")), "s-0")
    store.append(path, *batch(spark, (1, "x"), keys=[2]), "s-1")  # match 2 has a payload without rows
    assert read(spark, path) == [(1, "x"), (far, "d")]
    store.append(path, *batch(spark, (1, "never")), "s-1")  # delivered again
    assert read(spark, path) == [(1, "x"), (far, "d")]
    written = {p.parent.name: spark.read.parquet(str(p)).count() for p in Path(path).glob("batches/*/rows")}
    assert sorted(written.values()) == [1, 4]  # a batch writes its own rows
    store.compact(spark, path, schema)
    assert read(spark, path) == [(1, "x"), (far, "d")] and store.live_batches(spark, path) == []
    store.append(path, *batch(spark, keys=[1]), "s-2")  # now the partition is empty
    assert read(spark, path) == [(far, "d")]
    store.compact(spark, path, schema)
    assert read(spark, path) == [(far, "d")]
    bases = sorted(Path(path).glob("base/*"))
    assert [sorted(r.part for r in spark.read.parquet(f"{b}/parts").collect()) for b in bases] == [[0, 1], [0]]  # partition 1 isn't rewritten
    assert (bases[0] / "rows/part=0").exists() and not (bases[1] / "rows/part=0").exists()  # superseded, kept for running readers
    store.compact(spark, path, schema)  # nothing to do
    store.append(path, *batch(spark, (1, "again"), (far + 1, "e")), "other-0")
    assert read(spark, path) == [(1, "again"), (far, "d"), (far + 1, "e")]
    store.compact(spark, path, schema)
    assert read(spark, path) == [(1, "again"), (far, "d"), (far + 1, "e")] and not (bases[0] / "rows/part=0").exists()


@pytest.mark.parametrize("step", ["rows", "keys", "parts", "base"])
def test_a_crash_loses_no_state(spark, tmp_path, monkeypatch, step):
    """A write that breaks off at any step leaves the state before; done again, and again, it gives the state after."""
    path, schema = f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema
    store.append(path, *batch(spark, *((i, "a") for i in range(200))), "s-0")
    store.compact(spark, path, schema)
    keys, rows = batch(spark, (5, "b"), (900, "b"), keys=[6])
    broken = rows.withColumn("v", F.when(F.col("match_id") == 900, F.raise_error(F.lit("lost")).cast("string")).otherwise(F.col("v")))
    before = sorted((i, "a") for i in range(200))
    after = sorted([(i, "a") for i in range(200) if i not in (5, 6)] + [(5, "b"), (900, "b")])
    done = store._done
    if step == "rows":
        with pytest.raises(Exception, match="lost"):
            store.append(path, keys, broken, "s-1")
    elif step == "keys":
        with pytest.raises(Exception, match="lost"):
            store.append(path, keys.withColumn("match_id", F.raise_error(F.lit("lost")).cast("long")), rows, "s-1")
    if step in ("rows", "keys"):
        assert read(spark, path) == before
    for _ in range(2):
        store.append(path, keys, rows, "s-1")
        assert read(spark, path) == after
    if step in ("parts", "base"):
        write = store.read if step == "base" else None

        def fails(spark, path, schema, parts=None):
            out = write(spark, path, schema, parts)
            return out if parts is None else out.withColumn("v", F.raise_error(F.lit("lost")).cast("string"))

        with monkeypatch.context() as m:
            if step == "base":
                m.setattr(store, "read", fails)
            else:
                m.setattr(store, "read", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(Exception, match="lost"):
                store.compact(spark, path, schema)
        assert done is store._done and read(spark, path) == after
    for _ in range(2):
        store.compact(spark, path, schema)
        assert read(spark, path) == after and store.live_batches(spark, path) == []


def test_ingest_appends_and_compacts(spark, tmp_path):
    kinds = "match_id long, v string"
    handle = lambda b: (b.where("match_id >= 0").select("match_id"), b.where("match_id >= 0 and v is not null"), b.where("match_id < 0"))
    root = str(tmp_path)
    for k in range(5):
        spark.createDataFrame([(i, f"{k}") for i in range(k, k + 3)] + [(0, None), (-1, "bad")], kinds).coalesce(1).write.mode("append").parquet(f"{root}/land")
        stream.ingest(spark, f"{root}/land", kinds, f"{root}/t", f"{root}/bad", f"{root}/cp", handle, compact_after=2)
    assert read(spark, f"{root}/t") == [(1, "1"), (2, "2"), (3, "3"), (4, "4"), (5, "4"), (6, "4")]
    assert spark.read.parquet(f"{root}/bad").count() == 5 and len(store.live_batches(spark, f"{root}/t")) == 1


def test_late_attempts_count_in_order_and_ended_tasks_leave(spark, tmp_path):
    root, zero = str(tmp_path), datetime(2024, 1, 1)
    at = lambda hours: zero + timedelta(hours=hours)
    kinds = "match_id long, component_name string, attempted_at timestamp, outcome string, message string, attempt_id long"
    batches = [
        [(1, "a", at(5), "SUCCESS", None, 3), (2, "a", at(4), "API_ERROR", "late", 9), (3, "a", at(3), "UNAVAILABLE", None, 4), (4, "a", at(1), "QA_MISMATCH", "m", 5)],
        [(1, "a", at(2), "API_ERROR", "first", 1), (1, "a", at(3), "QA_MISMATCH", None, 2), (2, "a", at(1), "API_ERROR", None, 6), (2, "a", at(2), "API_ERROR", "x", 7), (2, "a", at(3), "API_ERROR", "y", 8), (3, "a", at(6), "SUCCESS", None, 10)],
        [(9, "z", at(100), "QA_MISMATCH", "end", 11)], [(9, "z", at(200), "QA_MISMATCH", "end", 12)], [(9, "z", at(300), "QA_MISMATCH", "end", 13)],
    ]
    sizes = []
    for k, rows in enumerate(batches):
        spark.createDataFrame(rows, kinds).coalesce(1).write.mode("append").parquet(f"{root}/log")
        states = stream.task_states(spark.readStream.schema(kinds).parquet(f"{root}/log"), late="10 hours", keep_seconds=36000)
        q = states.writeStream.foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/cp").outputMode("update").trigger(availableNow=True).start()
        q.awaitTermination()
        sizes.append(spark.read.format("statestore").option("stateVarName", "task").load(f"{root}/cp").count())
    out = spark.read.parquet(f"{root}/out").groupBy("match_id").agg(F.max_by(F.struct("status", "retry_count", "error_message", "attempts"), "batch").alias("s"))
    got = {r.match_id: tuple(r.s) for r in out.collect()}
    everything = [r for b in batches for r in b]
    want = {r.match_id: (r.status, r.retry_count, r.error_message, r.attempts) for r in tasks.fold_attempts(spark.createDataFrame(everything, kinds)).collect()}
    assert got == want and want[1] == ("SUCCESS", 2, None, 3) and want[2] == ("API_ERROR", 3, "y", 3) and want[3][0] == "UNAVAILABLE"
    assert sizes[-1] == 2  # the open tasks 4 and 9; those that ended have left


def test_a_match_has_one_timer_and_one_state_whatever_its_attempts(spark, tmp_path):
    root = str(tmp_path)
    rows = [(m, c, datetime(2024, 1, 1, h), "API_ERROR" if h < 2 else "SUCCESS", f"{h}", 100 * m + h) for m in (1, 2) for c in ("a", "b", "c") for h in (3, 2, 1, 0)]
    for half in (1, 0):  # the earlier attempts of a task come with the later batch
        spark.createDataFrame([r for r in rows if r[5] % 2 == half], "match_id long, component_name string, attempted_at timestamp, outcome string, message string, attempt_id long").write.mode("append").parquet(f"{root}/log")
        states = stream.task_states(spark.readStream.schema("match_id long, component_name string, attempted_at timestamp, outcome string, message string, attempt_id long").parquet(f"{root}/log"), late="10 hours")
        states.writeStream.foreachBatch(lambda df, i: df.withColumn("batch", F.lit(i)).write.mode("append").parquet(f"{root}/out")).option("checkpointLocation", f"{root}/cp").outputMode("update").trigger(availableNow=True).start().awaitTermination()
        timers = spark.read.format("statestore").option("readRegisteredTimers", True).load(f"{root}/cp")
        assert timers.count() <= 4 and timers.select("key").distinct().count() <= 2  # one a match, and one that an earlier attempt left behind
    assert spark.read.format("statestore").option("stateVarName", "task").load(f"{root}/cp").count() == 2
    last = spark.read.parquet(f"{root}/out").groupBy("match_id", "component_name").agg(F.max_by(F.struct("status", "retry_count", "attempts"), "batch").alias("s"))
    assert {tuple(r.s) for r in last.collect()} == {("SUCCESS", 2, 3)} and last.count() == 6


def test_match_documents_of_partial_and_repeated_captures(spark, tmp_path):
    from touchline.operators import export

    kind = "entity_id long, parsed struct<n:int,xs:array<string>>, is_valid boolean, reason string"
    base = spark.createDataFrame([(1, (5, ["a", None]), True, None), (1, (9, None), False, "http_404"), (2, None, False, "empty"), (1, (5, ["a", None]), True, None)], kind)
    odds = spark.createDataFrame([(3, (7, []), True, None), (2, (1, ["z"]), True, None)], kind)
    back = export.write_json(export.match_documents({"base": base, "odds": odds}), str(tmp_path / "documents"))
    got = {r.match_id: r for r in back.collect()}
    assert len(got) == back.count() == 3
    assert got[1].base == (5, ["a", None]) and got[1].odds is None and got[2].base is None and got[3].odds == (7, [])
    assert got[1].errors == (("success", None), ("not_attempted", None)) and got[2].errors == (("failed", "empty"), ("success", None)) and got[3].errors.base.status == "not_attempted"
    assert export.match_documents({"base": base.limit(0)}).count() == 0


def test_exported_documents_are_gzipped_lines(spark, tmp_path):
    import gzip
    import json

    from touchline.operators import export

    rows = spark.createDataFrame([(i, ("name that every document repeats " * 20, None)) for i in range(500)], "match_id long, base struct<name:string,gone:int>").coalesce(1)
    back = export.write_json(rows, str(tmp_path / "documents"))
    files = [x for x in (tmp_path / "documents").iterdir() if x.name.startswith("part-")]
    lines = [json.loads(line) for x in files for line in gzip.open(x, "rt")]
    assert sorted(x["match_id"] for x in lines) == list(range(500)) and sum(x.stat().st_size for x in files) < 20_000
    assert back.schema == rows.schema and sorted(back.collect()) == sorted(rows.collect())


def test_rows_without_a_match_are_an_error_and_payloads_without_one_speak_for_none(spark, tmp_path):
    path, schema = f"{tmp_path}/t", spark.createDataFrame([], SCHEMA).schema
    with pytest.raises(Exception, match="without match_id"):
        store.append(path, *batch(spark, (None, "lost")), "s-0")
    store.append(path, *batch(spark, (3, "a"), keys=[None, 4]), "s-0")
    assert read(spark, path) == [(3, "a")]
    store.compact(spark, path, schema)
    assert read(spark, path) == [(3, "a")] and store.live_batches(spark, path) == []


def test_keys_that_several_matches_hold(spark):
    """No match of a repeated key gets in, and rows without a match neither."""
    rows = spark.createDataFrame([(1, 10, "goal"), (1, 11, "goal"), (1, 12, "card"), (2, 13, "goal"), (3, 14, "goal"), (3, 14, "goal"), (4, None, "goal"), (None, 15, "goal"), (5, 16, "dance")], "id long, match_id long, incident_type string")
    found = tables.violations(rows, tables.TABLES["match_incidents"], {})
    got = sorted(tuple(r) for r in found.select("rule", "match_id", "key_text", "n").fillna(-1, ["match_id"]).collect())
    assert got == [
        ("domain:incident_type", 16, "5", 1), ("not_null:id", 15, "null", 1), ("not_null:match_id", -1, "4", 1),
        ("unique", 10, "1", 1), ("unique", 11, "1", 1), ("unique", 12, "1", 1), ("unique", 14, "3", 2),
    ]
    kept, failed = tables.admitted(rows, found, "incidents")
    assert [tuple(r) for r in kept.collect()] == [(2, 13, "goal")]
    assert sorted(r.match_id for r in failed.collect()) == [10, 11, 12, 14, 15, 16]


def test_backfill_of_a_calendar_that_names_a_match_twice(spark):
    kinds = "match_id long, tournament_id long, season_id long, status_type string, has_xg boolean, has_player_heat_map boolean"
    stored = spark.createDataFrame([(1, 1, 1, "notstarted", None, True), (2, 1, 1, "finished", None, True)], kinds)
    incoming = spark.createDataFrame([(1, 1, 1, "finished", None, True), (1, 1, 1, "notstarted", None, True), (1, 1, 1, "notstarted", None, True), (3, 1, 2, "finished", True, None)], kinds)
    audit = spark.createDataFrame([(2, "base")], "match_id long, component_name string")
    calendar, new, sums = tasks.season_backfill(incoming, stored, audit, ["base", "graph"])
    assert sorted(r.match_id for r in calendar.collect()) == [1, 2, 3]
    assert sorted(tuple(r)[:3] for r in new.collect()) == [(1, "base", "PENDING"), (1, "graph", "PENDING"), (2, "graph", "PENDING"), (3, "base", "PENDING"), (3, "graph", "SKIPPED_MISSING")]
    total = sums.where("tournament_id is null").first().asDict()
    assert [total[c] for c in ("fetched", "inserted", "updated", "newly_finished", "queued", "skipped")] == [2, 1, 1, 2, 4, 1]


def test_runs_are_catalogued_and_loaded_by_season(spark, tmp_path):
    from touchline.operators import consensus

    root, at = str(tmp_path), lambda day: datetime(2024, 1, day)
    kinds = "tournament_id long, season_id long, run_id string, run_at timestamp, component string, match_id long, payload string"
    save = lambda *rows: consensus.save_run(spark.createDataFrame(list(rows), kinds), root)
    save((1, 1, "run10", at(9), "base", 5, "a"), (1, 1, "run10", at(8), "base", 6, None), (1, 2, "run10", at(9), "stats", 7, "c"))
    save((1, 1, "run2", at(2), "base", 5, "a"))
    listed = lambda: sorted(tuple(r) for r in consensus.list_runs(spark, root).collect())
    others = [(1, 1, "run2", "base", at(2), 1, 1, 1), (1, 2, "run10", "stats", at(9), 1, 1, 1)]
    assert listed() == sorted([(1, 1, "run10", "base", at(8), 2, 1, 2), *others])
    save((1, 1, "run10", at(10), "base", 5, "b"))  # replaces its season alone
    assert listed() == sorted([(1, 1, "run10", "base", at(10), 1, 1, 1), *others])
    found = consensus.load_runs(spark, root, tournament_id=1, season_id=1, run_ids=["run10"])
    assert [(r.match_id, r.payload) for r in found.collect()] == [(5, "b")]
    filters = found._jdf.queryExecution().executedPlan().toString().partition("PartitionFilters: [")[2].partition("]")[0]
    assert all(name in filters for name in ("tournament_id", "season_id", "run_id"))
    assert consensus.load_runs(spark, root, season_id=3).isEmpty()


def test_golden_rows_come_from_the_earliest_run(spark):
    from touchline.operators import consensus

    fps = spark.createDataFrame([(1, "base", "run10", datetime(2024, 1, 3), "p10", "x"), (1, "base", "run2", datetime(2024, 1, 2), "p2", "x"), (2, "base", "run10", datetime(2024, 1, 3), "q", None), (2, "base", "run2", datetime(2024, 1, 2), "r", None)], "match_id long, component string, run_id string, run_at timestamp, payload string, fp string")
    found = consensus.consensus(consensus.groups(fps))
    assert {r.match_id: (r.has_consensus, r.agreeing) for r in found.collect()} == {1: (True, ["run2", "run10"]), 2: (False, ["run2", "run10"])}
    assert [(r.match_id, r.source_run, r.payload) for r in consensus.golden(found, fps).collect()] == [(1, "run2", "p2")]


def test_the_newest_valid_document_of_a_batch_counts(spark):
    from touchline.plans.registry import batch_steps
    from touchline.sources.landing import LANDING

    graph = lambda *minutes: '{"graphPoints":[%s],"periodTime":45,"overtimeLength":15,"periodCount":2}' % ",".join('{"minute":%d,"value":1}' % m for m in minutes)
    at = lambda day: datetime(2024, 1, day)
    rows = [
        ("graph", 1, "r", "A", at(2), graph(1)), ("graph", 1, "r", "A", at(3), graph(1, 2)), ("graph", 1, "r", "A", at(4), "{}"),  # newer, but empty
        ("graph", 2, "r", "A", at(1), graph(3)), ("graph", 2, "r", "B", at(1), graph(4)), ("graph", 2, "r", "A", None, graph(5)), ("graph", 2, "r", "B", at(1), graph(4)),
        ("graph", 3, "r", "A", at(1), '{"error":{"code":404}}'), ("graph", None, "r", "A", at(1), graph(6)),
    ]
    check, handle = batch_steps("graph")
    keys, made, bad = handle(check(spark.createDataFrame(rows, LANDING)))
    assert sorted(r.match_id for r in keys.collect()) == [1, 2]
    points = {r.match_id: r.points for r in made.collect()}
    assert made.count() == 2 and points[1].count("minute") == 2 and '"minute":4' in points[2]
    assert sorted((r.entity_id or 0, r.reason) for r in bad.collect()) == [(0, "no_entity"), (1, "empty"), (3, "http_404")]
    with pytest.raises(ValueError, match="seasons"):
        batch_steps("seasons")
    check, handle = batch_steps("odds")
    keys, made, bad = handle(check(spark.createDataFrame([], LANDING)))
    assert keys.isEmpty() and made.isEmpty() and bad.isEmpty()


def test_upsert_meets_in_one_shuffle(spark):
    """Keys with nulls and repeated rows of the target stay; target and incoming are each read and dealt out once."""
    target = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "c"), (None, 1, "d")], "k long, n int, v string")
    incoming = spark.createDataFrame([(2, 1, "x", 1), (2, 1, "y", 2), (3, 1, "z", 1), (None, 1, "w", 1)], "k long, n int, v string, seq int")
    out = tables.keyed_upsert(target, incoming, ["k", "n"], [F.col("seq")])
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted((r.k or 0, r.v) for r in out.collect()) == [(0, "d"), (0, "w"), (1, "a"), (1, "b"), (2, "y"), (3, "z")]


def test_compactions_write_a_fixed_multiple_of_the_rows(spark, tmp_path, monkeypatch):
    """Every batch touches the one partition: rewriting it after each would write the square of the rows."""
    rewritten, compact = [], store.compact

    def counted(spark, path, schema):
        compact(spark, path, schema)
        rewritten.append(store.read(spark, path, schema).count())

    monkeypatch.setattr(store, "compact", counted)
    n, root = 12, str(tmp_path)
    for k in range(n):
        spark.range(k, 1000 * n, n, 1).select(F.col("id").alias("match_id"), F.sha2(F.col("id").cast("string"), 256).alias("v")).write.mode("append").parquet(f"{root}/land")
    handle = lambda b: (b.select("match_id"), b, b.where("false"))
    stream.ingest(spark, f"{root}/land", SCHEMA, f"{root}/t", f"{root}/bad", f"{root}/cp", handle, files_a_batch=1, compact_after=1)
    assert sum(rewritten) <= 4 * 1000 * n and len(rewritten) < n
    assert store.read(spark, f"{root}/t", spark.createDataFrame([], SCHEMA).schema).agg(F.count("*"), F.countDistinct("match_id")).first()[:] == (1000 * n, 1000 * n)


def test_the_check_of_documents_is_planned_once_for_all_batches(spark, tmp_path):
    from touchline.plans.registry import batch_steps
    from touchline.sources.landing import LANDING

    root, planned, batches = str(tmp_path), [], []
    for k in range(3):
        rows = [("graph", 10 * k + i, "r", "A", datetime(2024, 1, 1), '{"graphPoints":[],"periodTime":45,"overtimeLength":15,"periodCount":2}' if i else "{}") for i in range(2)]
        spark.createDataFrame(rows, LANDING).coalesce(1).write.mode("append").parquet(f"{root}/land")
    check, handle = batch_steps("graph")
    stream.ingest(spark, f"{root}/land", LANDING, f"{root}/t", f"{root}/bad", f"{root}/cp", lambda b: batches.append(1) or handle(b), lambda b: planned.append(1) or check(b), files_a_batch=1)
    assert len(batches) == 3 and len(planned) == 1
    schema = handle(check(spark.createDataFrame([], LANDING)))[1].schema
    assert sorted(r.match_id for r in store.read(spark, f"{root}/t", schema).collect()) == [1, 11, 21]
    assert sorted((r.entity_id, r.reason) for r in spark.read.parquet(f"{root}/bad").collect()) == [(0, "empty"), (10, "empty"), (20, "empty")]
