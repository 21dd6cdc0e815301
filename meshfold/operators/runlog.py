"""Windows over import logs that never gather a whole run in one task.

A log row is (run_id, seq, failed) with ``seq`` the line number, dense from 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = 65_536


def failure_bursts(log: DataFrame, look: int = 12, at_least: int = 3,
                   bucket: int = BUCKET) -> DataFrame:
    """Adds ``recent_failures`` (this line and the look-1 before it) and ``burst``.

    Lines are windowed in buckets; the last look-1 lines of a bucket are copied
    into the next one, which makes every window complete.
    """
    halo = look - 1
    rows = log.withColumn("_bucket", F.floor(F.col("seq") / bucket)).withColumn("_copy", F.lit(False))
    copies = rows.filter(F.col("seq") % bucket >= bucket - halo).withColumn(
        "_bucket", F.col("_bucket") + 1).withColumn("_copy", F.lit(True))
    w = Window.partitionBy("run_id", "_bucket").orderBy("seq").rowsBetween(-halo, 0)
    recent = F.sum(F.col("failed").cast("int")).over(w)
    return (
        rows.unionByName(copies).withColumn("recent_failures", recent).filter(~F.col("_copy"))
        .withColumn("burst", F.col("recent_failures") >= at_least).drop("_bucket", "_copy"))


def failure_runs(log: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Islands of consecutive failures: (run_id, first_seq, last_seq, failures).

    The success before a line is found in its bucket or, failing that, carried
    over from the buckets before through one row per bucket.
    """
    rows = log.withColumn("_bucket", F.floor(F.col("seq") / bucket))
    ok_seq = F.when(~F.col("failed"), F.col("seq"))
    ends = rows.groupBy("run_id", "_bucket").agg(F.max(ok_seq).alias("_end"))
    before = Window.partitionBy("run_id").orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    carried = ends.select("run_id", "_bucket", F.coalesce(
        F.max("_end").over(before), F.lit(0)).alias("_carried"))
    inside = Window.partitionBy("run_id", "_bucket").orderBy("seq").rowsBetween(
        Window.unboundedPreceding, 0)
    marked = rows.join(carried, ["run_id", "_bucket"]).withColumn(
        "_island", F.coalesce(F.max(ok_seq).over(inside), "_carried"))
    return marked.filter("failed").groupBy("run_id", "_island").agg(
        F.min("seq").alias("first_seq"), F.max("seq").alias("last_seq"),
        F.count("*").alias("failures")).drop("_island")


def early_abort(log: DataFrame, threshold: int) -> DataFrame:
    """Runs that stop because their first ``threshold`` lines all failed.

    Only aggregates: a run aborts exactly if no success comes before that line.
    """
    per_run = log.groupBy("run_id").agg(
        F.min("seq").alias("_first"), F.count("*").alias("lines"),
        F.min(F.when(~F.col("failed"), F.col("seq"))).alias("first_success"))
    abort_at = F.col("_first") + threshold - 1
    aborts = (F.col("lines") >= threshold) & (
        F.col("first_success").isNull() | (F.col("first_success") > abort_at))
    return per_run.select("run_id", "lines", "first_success", aborts.alias("aborted"),
                          F.when(aborts, abort_at).alias("abort_seq"))


def batch_totals(log: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """ok / fail / skip per run; a line whose city is already recorded done is skipped."""
    rows = log
    if done is not None:
        rows = rows.join(done.select("city_code").distinct().withColumn("_done", F.lit(True)),
                         "city_code", "left")
    else:
        rows = rows.withColumn("_done", F.lit(None).cast("boolean"))
    skipped = F.col("_done").isNotNull()
    return rows.groupBy("run_id").agg(
        F.count("*").alias("total"), F.count_if(skipped).alias("skipped"),
        F.count_if(~skipped & ~F.col("failed")).alias("ok"),
        F.count_if(~skipped & F.col("failed")).alias("failed"))


def resume_targets(targets: DataFrame, done: DataFrame, always_skip: DataFrame | None = None) -> DataFrame:
    """Targets without a done record, whole codes only; cities merely found in the
    tables run again."""
    rest = targets.join(done.select("city_code"), "city_code", "left_anti")
    if always_skip is not None:
        rest = rest.join(always_skip.select("city_code"), "city_code", "left_anti")
    return rest


def small_first(targets: DataFrame, large: DataFrame) -> DataFrame:
    """Large cities last; the given order (``pos``) is kept inside both groups."""
    flagged = targets.join(large.select("city_code").distinct().withColumn("is_large", F.lit(True)),
                           "city_code", "left").fillna(False, ["is_large"])
    return flagged.orderBy("is_large", "pos")
