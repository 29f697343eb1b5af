"""Window and sequence operators: streaks, runs, pacing, lifecycles, ledgers, chains. Each needs an order column; ties are
broken by the second one given. A key's rows share a task, as the order demands; keys are independent."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """The first row of each key, by aggregation: no sort of a key's rows."""
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")


def latest_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    rest = [c for c in df.columns if c != key]
    return df.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")


def trailing_streak(df: DataFrame, key: str, good: Column, *order: str) -> DataFrame:
    """How many rows at the end of each key's order are good without a break, and how many rows there are."""
    place = F.struct(*order)
    last_bad = df.groupBy(key).agg(F.max(F.when(~good, place)).alias("last_bad"), F.count("*").alias("rows"))
    return df.withColumn("ok", good).withColumn("place", place).join(last_bad, key).groupBy(key).agg(F.count_if(F.col("last_bad").isNull() | (F.col("place") > F.col("last_bad"))).alias("streak"), F.max("rows").alias("rows"))


def runs(df: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """Run-length encoding: key, run (from 0), value, length."""
    w = Window.partitionBy(key).orderBy(*order)
    change = F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    marked = df.withColumn("change", change).withColumn("run", F.sum("change").over(w.rowsBetween(Window.unboundedPreceding, 0)) - 1)
    return marked.groupBy(key, "run").agg(F.first(value).alias(value), F.count("*").alias("length"))


def paced(df: DataFrame, key: str, start: Column, gap: int, *order: str) -> DataFrame:
    """Earliest permitted starts p_i = max(s_i, p_(i-1) + gap), in closed form: gap i + running max of s_j - gap j."""
    w = Window.partitionBy(key).orderBy(*order)
    ranked = df.withColumn("i", F.row_number().over(w)).withColumn("s", start)
    return ranked.withColumn("paced", F.max(F.col("s") - gap * F.col("i")).over(w.rowsBetween(Window.unboundedPreceding, 0)) + gap * F.col("i")).drop("i", "s")


def gaps(df: DataFrame, key: str, start: Column, end: Column, *order: str) -> DataFrame:
    """Time between a row's end and the next row's start, where it is positive."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("gap", F.lead(start).over(w) - end).where("gap > 0")


def rolling_count(df: DataFrame, key: str, seconds: Column, width: int) -> DataFrame:
    """Rows of the key in the last `width` seconds before and at each row."""
    return df.withColumn("recent", F.count("*").over(Window.partitionBy(key).orderBy(seconds).rangeBetween(-width + 1, 0)))


def neighbours(df: DataFrame, key: str, item: str, *order: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumns({"previous": F.lag(item).over(w), "next": F.lead(item).over(w)})


def order_problems(df: DataFrame, key: str, position: str) -> DataFrame:
    """Keys whose positions are not 0 to n - 1, each once."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.min(position).alias("lo"), F.max(position).alias("hi"), F.count_distinct(position).alias("k")).where("lo <> 0 OR hi <> n - 1 OR k <> n").select(key, "n")


def chain_problems(df: DataFrame, key: str, line: Column, stated: str, *order: str) -> DataFrame:
    """Rows whose stated digest of the line before is wrong."""
    w = Window.partitionBy(key).orderBy(*order)
    return df.withColumn("found", F.sha2(F.lag(line).over(w), 256)).where(~F.col(stated).eqNullSafe(F.col("found")))


def ledger_problems(df: DataFrame, transitions: list[tuple[str | None, str]], key: str = "subject", *order: str) -> DataFrame:
    """Transitions that don't begin where the last one ended, or that the state machine doesn't allow."""
    w = Window.partitionBy(key).orderBy(*order)
    allowed = F.array(*[F.lit(f"{a or ''}>{b}") for a, b in transitions])
    step = F.concat(F.coalesce("previous_state", F.lit("")), F.lit(">"), "new_state")
    problem = F.when(~F.col("previous_state").eqNullSafe(F.lag("new_state").over(w)), "not_the_last_state").when(~F.array_contains(allowed, step), "not_allowed")
    return df.withColumn("problem", problem).where("problem is not null")


def folded(df: DataFrame, key: str, kind: str, value: str, reset: str, *order: str) -> DataFrame:
    """Last value of each kind after the last reset of its key, and whether the key was ever reset."""
    place = F.struct(*order)
    resets = df.groupBy(key).agg(F.max(F.when(F.col(kind) == reset, place)).alias("at"))
    live = df.withColumn("place", place).join(resets, key).where((F.col(kind) != reset) & (F.col("at").isNull() | (F.col("place") > F.col("at"))))
    return live.groupBy(key, kind).agg(F.max_by(value, "place").alias(value), F.bool_or(F.col("at").isNotNull()).alias("was_reset"))


@dataclass(frozen=True)
class Schedule:
    """Intervals, in seconds, and limits of asking again."""

    version: str = "schedule/1"
    revisit: int = 3600
    revisit_factor: int = 2
    revisit_most: int = 86_400
    revisit_window: int = 7 * 86_400
    retry: int = 600
    retry_factor: int = 2
    retry_most: int = 7200
    max_failures: int = 3
    cooldown: int = 43_200
    gone_recheck: int = 86_400
    max_gone: int = 2
    denied_recheck: int = 172_800


def outcome(final: Column, status: Column, moved: Column, revalidates: Column) -> Column:
    """Class of a finished request; every row gets exactly one."""
    return (
        F.when(final == "DENIED", "DENIED_BY_POLICY").when(final == "DEFERRED", "DEFERRED_BY_POLICY").when(~final.eqNullSafe(F.lit("FETCHED")), "TRANSIENT_FAILURE")
        .when(moved.isNotNull(), "MOVED_PERMANENTLY").when(status.between(200, 299), "SUCCESS").when(status == 304, F.when(revalidates, "NOT_MODIFIED").otherwise("TRANSIENT_FAILURE"))
        .when(status == 404, "NOT_FOUND").when(status == 410, "GONE").when((status == 429) | (status >= 500), "TRANSIENT_FAILURE").when(status.between(300, 399), "REDIRECT_NOT_FOLLOWED").otherwise("REFUSED_BY_SERVER")
    )


def lifecycle(listed: DataFrame, history: DataFrame, policy: Schedule, policy_version: str) -> DataFrame:
    """State and due time (seconds) of every candidate.

    listed: candidate_id, first_listed. history: candidate_id, seq, at (seconds), kind, body_sha256, not_before, policy_version.
    """
    place, good, kind = F.struct("at", "seq"), F.col("kind").isin("SUCCESS", "NOT_MODIFIED"), F.col("kind")
    w = Window.partitionBy("candidate_id").orderBy("at", "seq")
    back = Window.partitionBy("candidate_id").orderBy(F.col("at").desc(), F.col("seq").desc()).rowsBetween(Window.unboundedPreceding, 0)
    same = good & (F.lead("body_sha256").over(w).eqNullSafe(F.col("body_sha256")) | F.lead("seq").over(w).isNull())
    rows = history.withColumns({
        "all_failed": F.min((kind == "TRANSIENT_FAILURE").cast("int")).over(back), "all_gone": F.min(kind.isin("NOT_FOUND", "GONE").cast("int")).over(back),
        "same": same.cast("int"),
    }).withColumn("all_same", F.min("same").over(back))
    last = rows.groupBy("candidate_id").agg(
        F.max_by(F.struct("kind", "at", "not_before", "policy_version"), place).alias("last"), F.count("*").alias("attempts"),
        F.sum("all_failed").alias("failures"), F.sum("all_gone").alias("gone"), F.sum("all_same").alias("unchanged"), F.min(F.when(good, F.col("at"))).alias("first_good"),
    ).select("*", "last.*").drop("last")
    c = listed.join(last, "candidate_id", "left")
    k, at = F.col("kind"), F.col("at")
    power = lambda base, factor, n, most: F.least(F.lit(float(base)) * F.pow(F.lit(float(factor)), n), F.lit(float(most))).cast("long")
    good = k.isin("SUCCESS", "NOT_MODIFIED")
    settled = good & (at - F.col("first_good") >= policy.revisit_window)
    suspended = (k == "TRANSIENT_FAILURE") & (F.col("failures") >= policy.max_failures)
    retired = k.isin("NOT_FOUND", "GONE") & (F.col("gone") > policy.max_gone)
    state = (
        F.when(k.isNull(), "NEVER_FETCHED").when(k == "MOVED_PERMANENTLY", "MOVED").when(settled, "SETTLED").when(good, "FETCHED").when(suspended, "SUSPENDED").when(k == "TRANSIENT_FAILURE", "FAILING")
        .when(retired, "RETIRED").when(k.isin("NOT_FOUND", "GONE"), "ABSENT").when(k.isin("REFUSED_BY_SERVER", "REDIRECT_NOT_FOLLOWED"), "REFUSED").when(k == "DEFERRED_BY_POLICY", "DEFERRED").otherwise("DENIED")
    )
    due = (
        F.when(k.isNull(), F.col("first_listed")).when((k == "MOVED_PERMANENTLY") | settled | retired, None)
        .when(good, at + power(policy.revisit, policy.revisit_factor, F.greatest(F.col("unchanged") - 1, F.lit(0)), policy.revisit_most)).when(suspended, at + policy.cooldown)
        .when(k == "TRANSIENT_FAILURE", F.greatest(at + power(policy.retry, policy.retry_factor, F.col("failures") - 1, policy.retry_most), F.coalesce("not_before", at)))
        .when(k.isin("NOT_FOUND", "GONE"), at + policy.gone_recheck).when(k == "DEFERRED_BY_POLICY", F.coalesce("not_before", at + policy.denied_recheck))
        .when((k == "DENIED_BY_POLICY") & ~F.col("policy_version").eqNullSafe(F.lit(policy_version)), at).otherwise(at + policy.denied_recheck)
    )
    return c.select("candidate_id", state.alias("state"), due.alias("due_at"), F.coalesce("attempts", F.lit(0)).alias("attempts"))


def channel_health(observed: DataFrame, failing_after: int = 3, stale_after: int = 4) -> DataFrame:
    """State of each channel from its runs. observed: channel_id, seq, readable, new_candidates, documents_failed."""
    back = Window.partitionBy("channel_id").orderBy(F.col("seq").desc()).rowsBetween(Window.unboundedPreceding, 0)
    rows = observed.withColumns({"down": F.min((~F.col("readable")).cast("int")).over(back), "idle": F.min((F.col("readable") & (F.col("new_candidates") == 0)).cast("int")).over(back)})
    per = rows.groupBy("channel_id").agg(F.sum("down").alias("failures"), F.sum("idle").alias("without_new"), F.max_by("documents_failed", "seq").alias("failed_last"), F.count("*").alias("runs"))
    state = F.when(F.col("failures") >= failing_after, "FAILING").when((F.col("failures") > 0) | (F.col("failed_last") > 0), "DEGRADED").when(F.col("without_new") >= stale_after, "STALE").otherwise("HEALTHY")
    return per.select("channel_id", state.alias("state"), "failures", "without_new", "runs")
