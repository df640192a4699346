"""A resumable run over pages: attempts in rounds, a pause after failures in a row, live failures, one append-only history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.compare import streaks, with_reset
from tessera.sources.shared import get_text, published, publish
from tessera.streaming.state import append_history, history


def attempts(spark: SparkSession, root: str) -> DataFrame | None:
    """The history of a run: (key, place, ok, reason, round), None before its first round is logged."""
    return history(spark, root).withColumnRenamed("batch", "round") if get_text(spark, f"{root}/_log/0") is not None else None


def last_outcomes(past: DataFrame, key: str) -> DataFrame:
    """(key, ok, reason, tries) of each key's last attempt."""
    row = F.max_by(F.struct("ok", "reason"), "round")
    return past.groupBy(key).agg(row.alias("r"), F.count("*").alias("tries")).select(key, "r.*", "tries")


def run_rounds(tasks: DataFrame, attempt: Callable[[DataFrame, int], DataFrame], root: str, key: str, place: str, rounds: int = 2) -> DataFrame:
    """Take tasks (key, place) through a first pass and `rounds` more over what failed; returns last_outcomes().

    attempt(pending, n) gives (key, place, ok, reason) of pass n, from 0. Each pass is one batch of the history below root,
    logged when its rows are there, and the live failures are published after it. A run that was cut off goes on with the
    first pass that is not logged, over the tasks that no logged pass brought through; tasks that are new since then join
    the next pass. Nothing but the number of passes is held on the driver. One row for each key in tasks; null keys go.
    """
    spark = tasks.sparkSession
    tasks = tasks.filter(F.col(key).isNotNull())
    for n in range(rounds + 1):
        if get_text(spark, f"{root}/_log/{n}") is not None:
            continue
        past = attempts(spark, root)
        pending = tasks if past is None else tasks.join(past.filter("ok").select(key), key, "left_anti")
        append_history(attempt(pending, n).select(key, place, "ok", "reason"), n, root)
        publish(last_outcomes(attempts(spark, root), key).filter("NOT ok"), f"{root}/failures")
    return last_outcomes(attempts(spark, root), key)


def failures(spark: SparkSession, root: str) -> DataFrame | None:
    """The live failures of a run: (key, ok, reason, tries)."""
    return published(spark, f"{root}/failures")


def pauses(past: DataFrame, place: str, most: int, shard: str | None = None) -> DataFrame:
    """(round, shard, pauses): how often a run paused, after each `most` failures in a row in order of place; a success or a
    new round counts anew. shard: a column that tells apart sequences that run beside each other; without it a round is one."""
    by = F.concat_ws(":", F.col("round").cast("string"), F.col(shard).cast("string") if shard else F.lit(""))
    got = streaks(past.withColumn("_by", by), "_by", [place], ~F.col("ok"))
    marked = got.select("round", *([shard] if shard else []), *with_reset(F.col("streak"), most))
    return marked.groupBy("round", *([shard] if shard else [])).agg(F.sum(F.col("trips").cast("long")).alias("pauses"))
