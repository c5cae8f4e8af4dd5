"""Ledger, status and reconciliation queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from histoframe.functions import numeric as X
from histoframe.operators import status as Q
from histoframe.sources import readers
from histoframe.sources.sinks import geometry_hash
from histoframe.workloads import inputs as I
from histoframe.workloads import workload

LATEST = """latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY slide_id, stage, task_key ORDER BY ts DESC, event_id DESC) AS rn FROM task_events) WHERE rn = 1)"""
COHORT = "cohort AS (SELECT DISTINCT slide_id FROM task_events)"
ROLLUP = f"""{LATEST}, {COHORT}, rollup_ AS (
    SELECT c.slide_id, st.stage, CASE WHEN bool_or(l.status = 'error') THEN 'error' WHEN bool_or(l.status = 'running') THEN 'running'
            WHEN bool_and(l.status = 'completed') THEN 'completed' ELSE 'pending' END AS status, COUNT(l.stage) AS n_tasks,
            arg_min(l.error, l.task_key) FILTER (l.status = 'error') AS error
    FROM cohort c CROSS JOIN (VALUES ('ingest'), ('tissue'), ('cells'), ('patch'), ('extract')) st(stage)
    LEFT JOIN latest l ON l.slide_id = c.slide_id AND l.stage = st.stage GROUP BY 1, 2)"""
LISTING = "listing AS (SELECT DISTINCT slide_id, output AS path FROM task_events JOIN events e USING (event_id) WHERE e.value > 12)"
GROUPS = "grps AS (SELECT DISTINCT slide_id, stage, task_key FROM task_events JOIN events e USING (event_id) WHERE e.value > 40)"
LABEL = "CASE WHEN stage IN ('ingest', 'cells') THEN stage ELSE stage || '[' || task_key || ']' END"
DRIFT = f"""{LISTING}, {GROUPS}, drift AS (
    SELECT slide_id, {LABEL} || ': completed but ''' || output || ''' missing' AS message FROM latest
    WHERE status = 'completed' AND (slide_id, output) NOT IN (SELECT slide_id, path FROM listing)
    UNION ALL SELECT slide_id, {LABEL} || ': present but not completed' FROM (
        SELECT slide_id, stage, task_key FROM grps EXCEPT SELECT slide_id, stage, task_key FROM latest WHERE status = 'completed'))"""
STATUS = f"""status_ AS (
    SELECT r.slide_id, {', '.join(f"MAX(CASE WHEN stage = '{s}' THEN status END) AS {s}" for s in Q.STAGES)},
           COALESCE(ANY_VALUE(n), 0) AS n_drift
    FROM rollup_ r LEFT JOIN (SELECT slide_id, COUNT(*) AS n FROM drift GROUP BY 1) d ON d.slide_id = r.slide_id GROUP BY 1)"""


def _latest(spark, sf):
    return Q.latest_tasks(I.task_events(spark, sf))


def _cohort(spark, sf):
    return I.task_events(spark, sf).select("slide_id").distinct()


def _rollup(spark, sf):
    return Q.stage_rollup(_latest(spark, sf), _cohort(spark, sf))


def _with_value(spark, sf, bound):
    e = I.table(spark, sf, "events").filter(F.col("value") > bound)
    return e.select(*I.task_columns())


def _listing(spark, sf):
    return _with_value(spark, sf, 12).select("slide_id", F.col("output").alias("path")).distinct()


def _groups(spark, sf):
    return _with_value(spark, sf, 40).select(*Q.TASK).distinct()


def _drift(spark, sf):
    return Q.drift_messages(_latest(spark, sf), _listing(spark, sf), _groups(spark, sf))


@workload("latest_task", f"WITH {LATEST} SELECT slide_id, stage, task_key, status, ts, event_id, COALESCE(error, '') AS error, output FROM latest")
def latest_task(spark, sf):
    return _latest(spark, sf).fillna("", ["error"])


@workload("stage_rollup", f"WITH {ROLLUP} SELECT slide_id, stage, status, n_tasks, COALESCE(error, '') AS error FROM rollup_")
def stage_rollup(spark, sf):
    return _rollup(spark, sf).fillna("", ["error"])


@workload(
    "reconcile_missing",
    f"""WITH {LATEST}, {LISTING} SELECT slide_id, stage, task_key, output AS path FROM latest
        WHERE status = 'completed' AND (slide_id, output) NOT IN (SELECT slide_id, path FROM listing)""",
)
def reconcile_missing(spark, sf):
    """Outputs kept as a map, exploded first."""
    tasks = _latest(spark, sf).withColumn("outputs", F.create_map(F.lit("main"), F.col("output"))).drop("output")
    return Q.missing_outputs(Q.exploded_outputs(tasks), _listing(spark, sf))


@workload("reconcile_orphans", f"WITH {LATEST}, {GROUPS} SELECT * FROM grps EXCEPT SELECT slide_id, stage, task_key FROM latest WHERE status = 'completed'")
def reconcile_orphans(spark, sf):
    return Q.orphan_groups(_groups(spark, sf), _latest(spark, sf))


@workload(
    "issue_list",
    f"""WITH {ROLLUP}, {DRIFT} SELECT slide_id, 'error' AS kind, stage || ': ' || COALESCE(error, '?') AS message FROM rollup_ WHERE status = 'error'
        UNION ALL SELECT slide_id, 'drift', message FROM drift""",
)
def issue_list(spark, sf):
    return Q.issue_list(_rollup(spark, sf), _drift(spark, sf))


@workload("cohort_status", f"WITH {ROLLUP}, {DRIFT}, {STATUS} SELECT * FROM status_")
def cohort_status(spark, sf):
    return Q.cohort_status(_rollup(spark, sf), _drift(spark, sf))


@workload("stage_done_counts", f"WITH {ROLLUP} SELECT stage, COUNT(*) FILTER (status = 'completed') AS n_done, COUNT(*) AS n_slides FROM rollup_ GROUP BY 1")
def stage_done_counts(spark, sf):
    return Q.stage_done_counts(_rollup(spark, sf))


@workload(
    "cohort_tally",
    f"""WITH {ROLLUP}, {DRIFT}, {STATUS} SELECT COUNT(*) AS n_slides, CAST(SUM(n_drift) AS BIGINT) AS n_drift,
            CAST(SUM({' + '.join(f"CASE WHEN {s} = 'error' THEN 1 ELSE 0 END" for s in Q.STAGES)}) AS BIGINT) AS n_errors FROM status_""",
)
def cohort_tally(spark, sf):
    return Q.cohort_tally(Q.cohort_status(_rollup(spark, sf), _drift(spark, sf)))


@workload(
    "stage_completed",
    f"""WITH {LATEST}, {LISTING} SELECT DISTINCT slide_id, stage, task_key FROM task_events
        EXCEPT SELECT slide_id, stage, task_key FROM latest
        WHERE status = 'completed' AND (stage = 'extract' OR (slide_id, output) IN (SELECT slide_id, path FROM listing))""",
)
def stage_completed(spark, sf):
    wanted = I.task_events(spark, sf).select(*Q.TASK).distinct()
    return Q.work_list(wanted, _latest(spark, sf), _listing(spark, sf))


RUNS = """run_events AS (
    SELECT o_orderkey AS run_id, o_orderpriority AS tool, o_orderdate AS started_at, 0 AS seq, 'running' AS status, NULL::TIMESTAMP AS finished_at,
           '' AS error, '{"custkey":' || o_custkey || ',"priority":"' || o_orderpriority || '"}' AS args FROM orders
    UNION ALL SELECT o_orderkey, NULL, NULL, 1, CASE o_orderstatus WHEN 'F' THEN 'success' ELSE 'error' END,
           o_orderdate + o_custkey * INTERVAL 1 SECOND, CASE o_orderstatus WHEN 'O' THEN 'stopped' ELSE '' END, NULL
    FROM orders WHERE o_orderstatus IN ('F', 'O')),
    runs AS (SELECT run_id, arg_min(tool, seq) AS tool, arg_min(started_at, seq) AS started_at, arg_min(args, seq) AS args,
           arg_max(status, seq) AS status, MAX(finished_at) AS finished_at, arg_max(error, seq) AS error FROM run_events GROUP BY 1)"""


def _run_events(spark, sf):
    o = I.table(spark, sf, "orders")
    start = o.select(
        F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("tool"), F.col("o_orderdate").alias("started_at"),
        F.lit(0).alias("seq"), F.lit("running").alias("status"), F.lit(None).cast("timestamp_ntz").alias("finished_at"), F.lit("").alias("error"),
        Q.json_args(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority")).alias("args"),
    )
    end = o.filter("o_orderstatus IN ('F', 'O')").select(
        F.col("o_orderkey").alias("run_id"), F.lit(None).cast("string").alias("tool"), F.lit(None).cast("timestamp_ntz").alias("started_at"),
        F.lit(1).alias("seq"), F.when(F.col("o_orderstatus") == "F", "success").otherwise("error").alias("status"),
        (F.col("o_orderdate") + F.make_dt_interval(secs=F.col("o_custkey"))).alias("finished_at"),
        F.when(F.col("o_orderstatus") == "O", "stopped").otherwise("").alias("error"), F.lit(None).cast("string").alias("args"),
    )
    return start.withColumn("started_at", F.col("started_at").cast("timestamp_ntz")).unionByName(
        end.withColumn("finished_at", F.col("finished_at").cast("timestamp_ntz"))
    )


@workload("run_ledger", f"WITH {RUNS} SELECT run_id, tool, started_at, args, status, COALESCE(finished_at, started_at) AS finished_at, error FROM runs")
def run_ledger(spark, sf):
    runs = Q.fold_runs(_run_events(spark, sf))
    return runs.withColumn("finished_at", F.coalesce("finished_at", "started_at"))


@workload("runs_newest_first", f"WITH {RUNS} SELECT run_id, tool, started_at, status FROM runs ORDER BY started_at DESC, run_id DESC")
def runs_newest_first(spark, sf):
    return Q.newest_first(Q.fold_runs(_run_events(spark, sf))).select("run_id", "tool", "started_at", "status")


@workload("json_safe", """SELECT o_orderkey AS run_id, '{"custkey":' || o_custkey || ',"priority":"' || o_orderpriority || '"}' AS args FROM orders""")
def json_safe(spark, sf):
    o = I.table(spark, sf, "orders")
    args = Q.json_args(F.col("o_custkey").alias("custkey"), F.col("o_orderpriority").alias("priority"))
    return o.select(F.col("o_orderkey").alias("run_id"), args.alias("args"))


@workload(
    "duration",
    """SELECT event_id, ROUND(s, 3) AS duration_s, CASE WHEN s < 1 THEN format('{:.3f}s', s) WHEN s < 60 THEN format('{:.1f}s', s)
            ELSE CAST(FLOOR(s / 60) AS INT) || 'm ' || CAST(FLOOR(s - FLOOR(s / 60) * 60) AS INT) || 's' END AS duration
       FROM (SELECT event_id, CAST(FLOOR(value * 1000) AS BIGINT) / 1000 AS s FROM events)""",
)
def duration(spark, sf):
    e = I.table(spark, sf, "events")
    millis = F.floor(F.col("value") * 1000).cast("bigint")
    tasks = e.select("event_id", F.col("ts").cast("timestamp").alias("started_at"), millis.alias("m"))
    tasks = tasks.withColumn("completed_at", F.timestamp_micros(F.unix_micros("started_at") + F.col("m") * 1000))
    return Q.with_duration(tasks).select("event_id", F.round("duration_s", 3).alias("duration_s"), "duration")


@workload(
    "stale_running",
    f"""WITH {LATEST} SELECT slide_id, stage, task_key, ts FROM latest
        WHERE status = 'running' AND epoch((SELECT MAX(ts) FROM events)) // 1 - epoch(ts) // 1 > 86400""",
)
def stale_running(spark, sf):
    now = I.table(spark, sf, "events").select(F.max("ts")).scalar()
    return Q.stale_running(_latest(spark, sf), now)


RING_SQL = """rings AS (
    SELECT l_orderkey, l_returnflag, list([CAST(round_even(px * 0.5::DOUBLE, 0) AS BIGINT), CAST(round_even(py * 0.5::DOUBLE, 0) AS BIGINT)] ORDER BY n, px, py) AS ring
    FROM (SELECT l_orderkey, l_returnflag, l_linenumber AS n, l_partkey AS px, l_suppkey AS py FROM lineitem) GROUP BY 1, 2),
    hashes AS (SELECT l_orderkey, sha256('[' || array_to_string(list_transform(list_sort(list(ring)), lambda r: '[' || array_to_string(
            list_transform(r, lambda p: '[' || p[1] || ',' || p[2] || ']'), ',') || ']'), ',') || ']') AS h FROM rings GROUP BY 1)"""


def _hashes(spark, sf):
    li = I.table(spark, sf, "lineitem").withColumnRenamed("l_partkey", "px")
    half = X.d(0.5)
    point = F.array(F.col("px") * half, F.col("l_suppkey") * half)
    rings = li.groupBy("l_orderkey", "l_returnflag").agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "px", "l_suppkey", point.alias("p")))).alias("pts")
    )
    rings = rings.select("l_orderkey", F.transform("pts", lambda s: s["p"]).alias("ring"))
    return rings.groupBy("l_orderkey").agg(geometry_hash(F.collect_list("ring")).alias("h"))


@workload("geometry_hash", f"WITH {RING_SQL} SELECT * FROM hashes")
def geometry_hash_query(spark, sf):
    return _hashes(spark, sf)


@workload(
    "tissue_edited",
    """WITH a AS (SELECT o_orderkey AS k, md5(o_orderpriority) AS current_hash, o_orderdate AS source_at FROM orders),
        b AS (SELECT o_orderkey AS k, CASE WHEN o_custkey % 5 = 0 THEN md5('x') ELSE md5(o_orderpriority) END AS recorded_hash,
                     o_orderdate + (o_custkey % 3 - 1) * INTERVAL 1 DAY AS derived_at FROM orders WHERE o_orderstatus <> 'P')
       SELECT a.k AS slide_id, COALESCE(recorded_hash <> current_hash, FALSE) AS edited, derived_at IS NULL OR derived_at < source_at AS stale
       FROM a LEFT JOIN b ON a.k = b.k""",
)
def tissue_edited(spark, sf):
    o = I.table(spark, sf, "orders")
    current = o.select(F.col("o_orderkey").alias("slide_id"), F.md5("o_orderpriority").alias("current_hash"), F.col("o_orderdate").alias("source_at"))
    recorded = o.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("slide_id"),
        F.when(F.col("o_custkey") % 5 == 0, F.md5(F.lit("x"))).otherwise(F.md5("o_orderpriority")).alias("recorded_hash"),
        (F.col("o_orderdate") + F.make_dt_interval(days=(F.col("o_custkey") % 3 - 1).cast("int"))).alias("derived_at"),
    )
    return Q.edited(recorded, current, ["slide_id"])


@workload(
    "quarantine",
    """SELECT l_returnflag AS flag, CASE WHEN TRY_CAST(t AS DOUBLE) IS NULL THEN 'not a number' WHEN TRY_CAST(t AS DOUBLE) <= 0 THEN 'not positive' ELSE '' END AS reason, COUNT(*) AS n
       FROM (SELECT l_returnflag, CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_discount AS VARCHAR) END AS t FROM lineitem) GROUP BY 1, 2""",
)
def quarantine(spark, sf):
    li = I.table(spark, sf, "lineitem").withColumn("t", F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_discount").cast("string")))
    value = F.col("t").try_cast("double")
    good, bad = Q.split_good_bad(li, F.when(value.isNull(), "not a number").when(value <= 0, "not positive"))
    rows = good.withColumn("reason", F.lit("")).unionByName(bad)
    return rows.groupBy(F.col("l_returnflag").alias("flag"), "reason").agg(F.count(F.lit(1)).alias("n"))


METHODS = """methods AS (SELECT o_custkey AS slide_id, CASE o_orderstatus WHEN 'F' THEN 'carta' WHEN 'O' THEN 'otsu' ELSE 'imported' END AS method FROM orders)"""


@workload(
    "tissue_method_pick",
    f"""WITH {METHODS}, p AS (SELECT slide_id, list_sort(list(DISTINCT method)) AS present, CASE WHEN slide_id % 3 = 0 THEN 'carta' END AS req FROM methods GROUP BY 1)
        SELECT slide_id, COALESCE(CASE WHEN len(present) = 1 THEN present[1] WHEN req IS NOT NULL THEN CASE WHEN list_contains(present, req) THEN req END
                    WHEN list_contains(present, 'otsu') THEN 'otsu' END, '') AS method,
               CASE WHEN len(present) = 1 THEN '' WHEN req IS NOT NULL AND NOT list_contains(present, req) THEN 'requested_missing'
                    WHEN req IS NULL AND NOT list_contains(present, 'otsu') THEN 'ambiguous' ELSE '' END AS problem FROM p""",
)
def tissue_method_pick(spark, sf):
    o = I.table(spark, sf, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", "carta").when(F.col("o_orderstatus") == "O", "otsu").otherwise("imported")
    methods = o.select(F.col("o_custkey").alias("slide_id"), kind.alias("method"))
    return Q.pick_tissue_method(methods, F.when(F.col("slide_id") % 3 == 0, "carta")).fillna("")


@workload(
    "src_state_json",
    f"""WITH {LATEST} SELECT slide_id, stage, task_key, status, COALESCE(error, '') AS error, output FROM latest WHERE slide_id % 9 <> 0
        UNION ALL SELECT slide_id, s.stage, '', 'pending', '', '' FROM (SELECT DISTINCT slide_id FROM latest WHERE slide_id % 9 <> 0) d
            CROSS JOIN (VALUES ('ingest'), ('cells')) s(stage) WHERE (slide_id, s.stage) NOT IN (SELECT slide_id, stage FROM latest)""",
)
def src_state_json(spark, sf):
    """State documents written from the ledger, every ninth cut short, read back."""
    tasks = _latest(spark, sf)
    task = F.struct("status", "error", F.create_map(F.lit("main"), F.col("output")).alias("outputs"), F.lit(1).alias("extra"))
    entries = tasks.withColumn("task", task)
    keyed = F.map_from_entries(F.collect_list(F.when(~F.col("stage").isin(*Q.SCALAR_STAGES), F.struct("task_key", "task"))))
    by_stage = entries.groupBy("slide_id", "stage").agg(F.first("task").alias("scalar"), keyed.alias("keyed"))
    body = F.when(F.col("stage").isin(*Q.SCALAR_STAGES), F.to_json("scalar")).otherwise(F.to_json("keyed"))
    docs = by_stage.groupBy("slide_id").agg(
        F.concat(
            F.lit('{"version": 3, "tasks": {'),
            F.array_join(F.collect_list(F.concat(F.lit('"'), "stage", F.lit('": '), body)), ", "),
            F.lit("}}"),
        ).alias("json")
    )
    docs = docs.withColumn("json", F.when(F.col("slide_id") % 9 == 0, F.left("json", F.lit(40))).otherwise(F.col("json")))
    rows = readers.state_tasks(readers.parse_state(docs), ["slide_id"])
    return rows.select(
        "slide_id", "stage", "task_key", "status", F.coalesce("error", F.lit("")).alias("error"), F.coalesce(F.col("outputs")["main"], F.lit("")).alias("output")
    )
