"""Sequence operators over events (users are keys, event types outcomes) and conversations (turns are positions)."""

from __future__ import annotations

from pyspark.sql import functions as F

from corpusloom.operators import sequences as S
from corpusloom.session import table

TRANSITIONS = [(None, "click"), (None, "view"), (None, "signup"), ("click", "view"), ("view", "click"), ("view", "purchase"), ("signup", "view"), ("click", "purchase"), ("purchase", "view"), ("view", "view"), ("click", "click")]


def events(spark, d):
    return table(spark, d, "events").select("event_id", "user_id", "event_type", "value", F.unix_micros(F.col("ts").cast("timestamp")).alias("us")).withColumn("s", F.floor(F.col("us") / 1000000))


def turns(spark, d):
    return table(spark, d, "conversations")


def history(spark, d):
    """Request outcomes: clicks answer, views find nothing new, errors fail, sign-ups are gone, purchases refused."""
    kind = F.when(F.col("event_type") == "click", "SUCCESS").when(F.col("event_type") == "view", "NOT_MODIFIED").when(F.col("event_type") == "error", "TRANSIENT_FAILURE").when(F.col("event_type") == "signup", "GONE").otherwise("REFUSED_BY_SERVER")
    return events(spark, d).select(F.col("user_id").alias("candidate_id"), F.col("event_id").alias("seq"), F.col("s").alias("at"), kind.alias("kind"), F.floor("value").cast("string").alias("body_sha256"), F.lit(None).cast("long").alias("not_before"), F.lit("p1").alias("policy_version"))


def lifecycles(spark, d):
    listed = table(spark, d, "customer").select(F.col("c_custkey").alias("candidate_id"), F.lit(1704067200).cast("long").alias("first_listed"))
    return S.lifecycle(listed, history(spark, d), S.Schedule(), "p1")


def due_plan(spark, d):
    """The 25 candidates due first; ties by id."""
    return lifecycles(spark, d).where("due_at <= 1706745600").orderBy("due_at", "candidate_id").limit(25).select("candidate_id", "due_at", "state")


def health(spark, d):
    rows = events(spark, d).select(F.col("user_id").alias("channel_id"), F.col("event_id").alias("seq"), (F.col("event_type") != "error").alias("readable"), F.floor(F.col("value") / 10).alias("new_candidates"), F.when(F.col("event_type") == "signup", 1).otherwise(0).alias("documents_failed"))
    return S.channel_health(rows)


def chain(spark, d):
    rows = turns(spark, d).withColumn("stated", F.when((F.col("conv_id") % 10 == 3) & (F.col("turn") == 1), F.lit("x")).otherwise(F.sha2(F.lag("text").over(S.Window.partitionBy("conv_id").orderBy("turn")), 256)))
    return S.chain_problems(rows, "conv_id", F.col("text"), "stated", "turn").select("conv_id", "turn")


def ledger(spark, d):
    rows = events(spark, d).where("event_type <> 'error'").withColumn("before", F.lag("event_type").over(S.Window.partitionBy("user_id").orderBy("us", "event_id")))
    stated = rows.select(F.col("user_id").alias("subject"), "us", "event_id", F.when(F.col("event_id") % 50 == 0, "click").otherwise(F.col("before")).alias("previous_state"), F.col("event_type").alias("new_state"))
    return S.ledger_problems(stated, TRANSITIONS, "subject", "us", "event_id").select("subject", "event_id", "problem")


def fold(spark, d):
    return S.folded(events(spark, d), "user_id", "event_type", "value", "signup", "us", "event_id")


_E = "e AS (SELECT event_id, user_id, event_type, value, epoch_us(ts) AS us, epoch_us(ts) // 1000000 AS s FROM events)"
_BACK = "(PARTITION BY candidate_id ORDER BY tt DESC, seq DESC ROWS UNBOUNDED PRECEDING)"
_LIFE = f"""{_E}, h AS (SELECT user_id AS candidate_id, event_id AS seq, s AS tt, CASE event_type WHEN 'click' THEN 'SUCCESS' WHEN 'view' THEN 'NOT_MODIFIED' WHEN 'error' THEN 'TRANSIENT_FAILURE' WHEN 'signup' THEN 'GONE' ELSE 'REFUSED_BY_SERVER' END AS kind, floor(value)::BIGINT AS body FROM e),
m AS (SELECT *, kind IN ('SUCCESS', 'NOT_MODIFIED') AND (lead(body) OVER (PARTITION BY candidate_id ORDER BY tt, seq) IS NOT DISTINCT FROM body OR lead(seq) OVER (PARTITION BY candidate_id ORDER BY tt, seq) IS NULL) AS same FROM h),
q AS (SELECT *, bool_and(kind = 'TRANSIENT_FAILURE') OVER {_BACK} AS af, bool_and(kind IN ('NOT_FOUND', 'GONE')) OVER {_BACK} AS ag, bool_and(same) OVER {_BACK} AS asame FROM m),
l AS (SELECT candidate_id, arg_max(kind, (tt, seq)) AS kind, max(tt) AS tt, count(*) AS attempts, count(*) FILTER (af) AS failures, count(*) FILTER (ag) AS gone, count(*) FILTER (asame) AS unchanged, min(tt) FILTER (kind IN ('SUCCESS', 'NOT_MODIFIED')) AS first_good FROM q GROUP BY 1),
c AS (SELECT r.c_custkey AS candidate_id, l.* EXCLUDE (candidate_id) FROM customer r LEFT JOIN l ON l.candidate_id = r.c_custkey),
life AS (SELECT candidate_id, CASE WHEN kind IS NULL THEN 'NEVER_FETCHED' WHEN kind IN ('SUCCESS', 'NOT_MODIFIED') THEN CASE WHEN tt - first_good >= 604800 THEN 'SETTLED' ELSE 'FETCHED' END WHEN kind = 'TRANSIENT_FAILURE' THEN CASE WHEN failures >= 3 THEN 'SUSPENDED' ELSE 'FAILING' END WHEN kind = 'GONE' THEN CASE WHEN gone > 2 THEN 'RETIRED' ELSE 'ABSENT' END ELSE 'REFUSED' END AS state,
 CASE WHEN kind IS NULL THEN 1704067200 WHEN kind IN ('SUCCESS', 'NOT_MODIFIED') THEN CASE WHEN tt - first_good < 604800 THEN tt + least(3600.0 * pow(2, greatest(unchanged - 1, 0)), 86400.0)::BIGINT END WHEN kind = 'TRANSIENT_FAILURE' THEN CASE WHEN failures >= 3 THEN tt + 43200 ELSE tt + least(600.0 * pow(2, failures - 1), 7200.0)::BIGINT END WHEN kind = 'GONE' THEN CASE WHEN gone <= 2 THEN tt + 86400 END ELSE tt + 172800 END AS due_at, coalesce(attempts, 0) AS attempts FROM c)"""

QUERIES = {
    "first_event": lambda spark, d: S.first_per_key(events(spark, d).select("user_id", "us", "event_id", "event_type"), "user_id", "us", "event_id"),
    "latest_statement": lambda spark, d: S.latest_per_key(events(spark, d).select("user_id", "us", "event_id", "event_type"), "user_id", "us", "event_id"),
    "trailing_streak": lambda spark, d: S.trailing_streak(events(spark, d), "user_id", F.col("event_type") != "error", "us", "event_id"),
    "run_lengths": lambda spark, d: S.runs(events(spark, d), "user_id", "event_type", "us", "event_id"),
    "long_runs": lambda spark, d: S.runs(events(spark, d), "user_id", "event_type", "us", "event_id").where("length >= 3"),
    "pacing": lambda spark, d: S.paced(events(spark, d), "user_id", F.col("s"), 7200, "us", "event_id").select("event_id", "paced"),
    "gaps": lambda spark, d: S.gaps(events(spark, d), "user_id", F.col("us"), F.col("us") + 60000000, "us", "event_id").select("event_id", "gap"),
    "rolling_hour": lambda spark, d: S.rolling_count(events(spark, d), "event_type", F.col("s"), 3600).select("event_id", "recent"),
    "neighbours": lambda spark, d: S.neighbours(turns(spark, d), "conv_id", "turn", "turn").select("conv_id", "turn", "previous", "next"),
    "dense_order": lambda spark, d: S.order_problems(turns(spark, d).where("NOT (conv_id % 5 = 2 AND turn = 1)"), "conv_id", "turn"),
    "hash_chain": chain,
    "ledger_replay": ledger,
    "event_fold": fold,
    "lifecycle": lifecycles,
    "due_plan": due_plan,
    "channel_health": health,
}
_RUNS = f"{_E}, a AS (SELECT *, CASE WHEN lag(event_type) OVER w IS NOT DISTINCT FROM event_type THEN 0 ELSE 1 END AS ch FROM e WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)), b AS (SELECT *, sum(ch) OVER (PARTITION BY user_id ORDER BY us, event_id) - 1 AS run FROM a), r AS (SELECT user_id, run::BIGINT AS run, any_value(event_type) AS event_type, count(*) AS length FROM b GROUP BY user_id, run)"
ORACLE = {
    "first_event": f"WITH {_E} SELECT user_id, us, event_id, event_type FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) = 1",
    "latest_statement": f"WITH {_E} SELECT user_id, us, event_id, event_type FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) = 1",
    "trailing_streak": f"WITH {_E}, a AS (SELECT *, max(CASE WHEN event_type = 'error' THEN (us, event_id) END) OVER (PARTITION BY user_id) AS bad FROM e) SELECT user_id, count(*) FILTER (bad IS NULL OR (us, event_id) > bad) AS streak, count(*) AS rows FROM a GROUP BY user_id",
    "run_lengths": f"WITH {_RUNS} SELECT * FROM r",
    "long_runs": f"WITH {_RUNS} SELECT * FROM r WHERE length >= 3",
    "pacing": f"WITH {_E}, a AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us, event_id) AS i FROM e) SELECT event_id, max(s - 7200 * i) OVER (PARTITION BY user_id ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) + 7200 * i AS paced FROM a",
    "gaps": f"WITH {_E}, a AS (SELECT event_id, lead(us) OVER (PARTITION BY user_id ORDER BY us, event_id) - (us + 60000000) AS gap FROM e) SELECT * FROM a WHERE gap > 0",
    "rolling_hour": f"WITH {_E} SELECT event_id, count(*) OVER (PARTITION BY event_type ORDER BY s RANGE BETWEEN 3599 PRECEDING AND CURRENT ROW) AS recent FROM e",
    "neighbours": "SELECT conv_id, turn, lag(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS previous, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations",
    "dense_order": "SELECT conv_id, count(*) AS n FROM conversations WHERE NOT (conv_id % 5 = 2 AND turn = 1) GROUP BY conv_id HAVING min(turn) <> 0 OR max(turn) <> count(*) - 1 OR count(DISTINCT turn) <> count(*)",
    "hash_chain": "SELECT conv_id, turn FROM conversations WHERE conv_id % 10 = 3 AND turn = 1",
    "ledger_replay": f"""WITH {_E}, a AS (SELECT *, lag(event_type) OVER (PARTITION BY user_id ORDER BY us, event_id) AS before FROM e WHERE event_type <> 'error'), b AS (SELECT *, CASE WHEN event_id % 50 = 0 THEN 'click' ELSE before END AS stated FROM a),
c AS (SELECT user_id AS subject, event_id, CASE WHEN stated IS DISTINCT FROM before THEN 'not_the_last_state' WHEN NOT (coalesce(stated, '') || '>' || event_type IN ({', '.join(f"'{a or ''}>{b}'" for a, b in TRANSITIONS)})) THEN 'not_allowed' END AS problem FROM b) SELECT * FROM c WHERE problem IS NOT NULL""",
    "event_fold": f"WITH {_E}, a AS (SELECT *, max(CASE WHEN event_type = 'signup' THEN (us, event_id) END) OVER (PARTITION BY user_id) AS rst FROM e) SELECT user_id, event_type, arg_max(value, (us, event_id)) AS value, bool_or(rst IS NOT NULL) AS was_reset FROM a WHERE event_type <> 'signup' AND (rst IS NULL OR (us, event_id) > rst) GROUP BY user_id, event_type",
    "lifecycle": f"WITH {_LIFE} SELECT * FROM life",
    "due_plan": f"WITH {_LIFE} SELECT candidate_id, due_at, state FROM life WHERE due_at <= 1706745600 ORDER BY due_at, candidate_id LIMIT 25",
    "channel_health": f"""WITH {_E}, a AS (SELECT user_id AS channel_id, event_id AS seq, event_type <> 'error' AS readable, value // 10 AS n, event_type = 'signup' AS f FROM e),
b AS (SELECT *, bool_and(NOT readable) OVER w AS down, bool_and(readable AND floor(n) = 0) OVER w AS idle FROM a WINDOW w AS (PARTITION BY channel_id ORDER BY seq DESC ROWS UNBOUNDED PRECEDING)),
c AS (SELECT channel_id, count(*) FILTER (down) AS failures, count(*) FILTER (idle) AS without_new, arg_max(f, seq) AS fl, count(*) AS runs FROM b GROUP BY 1)
SELECT channel_id, CASE WHEN failures >= 3 THEN 'FAILING' WHEN failures > 0 OR fl THEN 'DEGRADED' WHEN without_new >= 4 THEN 'STALE' ELSE 'HEALTHY' END AS state, failures, without_new, runs FROM c""",
}
