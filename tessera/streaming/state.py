"""Resumable state and incremental roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tessera.sources.shared import get_text, put_text


def pending(inputs: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Inputs that are not done yet."""
    return inputs.join(done.select(key).distinct(), key, "left_anti")


def upsert(state: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """State after changes: a changed key's row is replaced. One row for each key in changes."""
    return state.join(changes.select(key), key, "left_anti").unionByName(changes, allowMissingColumns=True)


def windowed_counts(events: DataFrame, ts: str, kind: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events of each kind in each tumbling window; for batch and for streams, which drop rows later than `late`."""
    if events.isStreaming:
        events = events.withWatermark(ts, late)
    return events.groupBy(F.window(ts, length).alias("w"), kind).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), kind, "n")


def live_failures(state: DataFrame, outcomes: DataFrame, key: str, failed) -> DataFrame:
    """The failure set after a batch of outcomes, one for each key: failures are put in, successes taken out."""
    return upsert(state, outcomes, key).join(outcomes.filter(~failed).select(key), key, "left_anti")


def append_stream(stream: DataFrame, path: str, key: str, checkpoint: str):
    """A started query that appends the first row of each new key to a Parquet table.

    The keys met so far are the query's own state, dealt out by key and kept in its checkpoint, so a batch costs what it
    brings and the table is never read again; the file sink lists a batch's files once, so a batch that is run again
    adds nothing. The table belongs to this query.
    """
    fresh = stream.filter(F.col(key).isNotNull()).dropDuplicates([key])
    return fresh.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def latest(events: DataFrame, key: str, ts: str) -> DataFrame:
    """The last event of each key: a status store made from its history. Equal instants: the greater row counts."""
    row = F.struct(ts, *[c for c in events.columns if c not in (key, ts)])
    return events.filter(F.col(key).isNotNull()).groupBy(key).agg(F.max(row).alias("r")).select(key, "r.*")


def retry_rounds(tasks: DataFrame, key: str, attempt, rounds: int, keep) -> tuple[DataFrame, DataFrame]:
    """(history, failed) after a first pass and `rounds` more over what failed. attempt: (tasks, number) to (key, ok, ...).

    keep writes a table and reads it back, so that a round is run once; the number of rounds bounds the loop. history has
    every attempt with its number, failed the tasks that no attempt brought through.
    """
    history, left = None, tasks
    for n in range(1, rounds + 2):
        got = keep(attempt(left, n).withColumn("attempt", F.lit(n)))
        history = got if history is None else history.unionByName(got)
        left = keep(left.join(got.filter("ok").select(key), key, "left_anti"))
        if left.isEmpty():
            break
    return history, left


def rotate(inputs: DataFrame, seen: DataFrame, key: str, at: str, n: int) -> DataFrame:
    """The n inputs not looked at for longest, never seen ones first, then by key: a rotating sample, n is its feature."""
    return inputs.join(seen.select(key, at), key, "left").orderBy(F.col(at).asc_nulls_first(), key).limit(n).select(inputs.columns)


def mark_seen(seen: DataFrame, sample: DataFrame, key: str, at: str, now) -> DataFrame:
    """The state after a sample has been looked at."""
    return upsert(seen, sample.select(key, now.alias(at)), key)


def streak_stream(events: DataFrame, key: str, ok: str, most: int) -> DataFrame:
    """(key, n_events, streak, trips) after each batch of a stream: failures in a row of each key, counted anew after `most`, with the trips so far; events of a batch count in their order by ts."""
    import pandas as pd

    def step(k, batches, state):
        streak, trips = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values("ts")
        for good in rows[ok]:
            streak = 0 if good else streak + 1
            if streak == most:
                streak, trips = 0, trips + 1
        state.update((streak, trips))
        yield pd.DataFrame({key: [k[0]], "n_events": [len(rows)], "streak": [streak], "trips": [trips]})

    kind = events.schema[key].dataType.simpleString()
    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, n_events long, streak long, trips long", "streak long, trips long", "update", "NoTimeout")


#: The name of the state variable of failure_store(), as the state source reads it.
FAILURES = "failures"


def failure_store(outcomes: DataFrame, key: str, ok: str, ts: str, reason: str, keep_hours: float | None = None) -> DataFrame:
    """The live failure set of a stream of outcomes: (key, failed, attempts, reason, at) for each key of a batch.

    A failure puts its key in or counts one more attempt, a success takes it out and sets the count to none; outcomes of a
    batch count in order of ts, on equal ts failures after successes, then by reason. A key not heard of for keep_hours is
    dropped. The state lives in the query's RocksDB store and can be read back by failures(); null keys are left out.
    """
    from pyspark.sql.streaming import StatefulProcessor

    kind, at = outcomes.schema[key].dataType.simpleString(), outcomes.schema[ts].dataType.simpleString()

    class Failures(StatefulProcessor):
        def init(self, handle):
            ttl = {"ttlDurationMs": int(keep_hours * 3_600_000)} if keep_hours else {}
            self.state = handle.getValueState(FAILURES, f"attempts long, reason string, at {at}", **ttl)

        def handleInputRows(self, k, rows, timers):
            held = tuple(self.state.get()) if self.state.exists() else (0, None, None)
            good, newest, number = None, None, held[0]
            for r in sorted(rows, key=lambda r: (r[ts], not r[ok], r[reason] or "")):
                if r[ok]:
                    good, newest, number = r[ts], None, 0
                else:
                    newest, number = (r[ts], r[reason]), number + 1
            if newest:
                self.state.update((number, newest[1], newest[0]))
                yield Row(**{key: k[0], "failed": True, "attempts": number, "reason": newest[1], "at": newest[0]})
            else:
                self.state.clear()
                yield Row(**{key: k[0], "failed": False, "attempts": 0, "reason": None, "at": good})

        def close(self):
            pass

    schema = f"{key} {kind}, failed boolean, attempts long, reason string, at {at}"
    rows = outcomes.filter(F.col(key).isNotNull()).groupBy(key)
    return rows.transformWithState(Failures(), schema, "update", "ProcessingTime" if keep_hours else "None")


def failures(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The failure set that a query of failure_store() holds: (key..., attempts, reason, at)."""
    got = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", FAILURES).load()
    value = "value.value" if "value" in got.schema["value"].dataType.fieldNames() else "value"
    return got.select("key.*", f"{value}.*")


def append_history(batch: DataFrame, batch_id: int, root: str) -> bool:
    """Add a micro-batch of attempts to the history at root, once: False where the log has its number already.

    Rows go to a folder of the batch, which a run again replaces, then the number goes to the log; readers take logged
    batches only, so neither a replayed batch nor one that broke off adds anything. For foreachBatch.
    """
    spark = batch.sparkSession
    if get_text(spark, f"{root}/_log/{batch_id}") is not None:
        return False
    batch.write.mode("overwrite").parquet(f"{root}/rows/batch={batch_id}")
    put_text(spark, f"{root}/_log/{batch_id}", str(batch_id))
    return True


def history(spark: SparkSession, root: str) -> DataFrame:
    """All attempts of logged batches, with their batch."""
    log = spark.read.text(f"{root}/_log/[0-9]*").select(F.col("value").cast("long").alias("batch")).filter("batch IS NOT NULL").distinct()
    rows = spark.read.option("mergeSchema", "true").option("basePath", f"{root}/rows").parquet(f"{root}/rows")
    return rows.withColumn("batch", F.col("batch").cast("long")).join(log, "batch", "left_semi")
