"""Tables whose columns are found as rows come in: a header registry beside the data, appends, and compaction."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.sources.shared import get_text, hadoop_path, publish, published, put_text, written

#: The registry's file: columns in the order in which they were first seen.
HEADER = "_header"


def header(spark: SparkSession, root: str) -> list[str]:
    return json.loads(get_text(spark, f"{root}/{HEADER}") or "[]")


def _appended(spark: SparkSession, root: str) -> DataFrame | None:
    try:
        return spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(f"{root}/fresh")
    except Exception as e:  # Spark names a missing path by an error class
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _rounds(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows under the whole header with the flush they came in; rounds that a stopped compaction left in both places count once."""
    columns = header(spark, root)
    base, fresh = published(spark, f"{root}/base"), _appended(spark, root)
    blank = lambda t, c: F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) if c in t.columns else F.lit("").alias(c)
    parts = [t.select("_round", *(blank(t, c) for c in columns)) for t in (base, fresh) if t is not None]
    if len(parts) == 2:
        return parts[0].unionByName(parts[1].join(parts[0].select("_round").distinct(), "_round", "left_anti"))
    return parts[0] if parts else None


def read_growing(spark: SparkSession, root: str) -> DataFrame | None:
    """All rows under the whole header; cells of columns that a row never had are blank. None before the first flush."""
    got = _rounds(spark, root)
    return None if got is None else got.drop("_round")


def flush(rows: DataFrame, root: str, key: str, bag: str, migrate: dict[str, str] | None = None) -> list[str]:
    """Append rows of (key, bag: map of strings) whose key the table does not have yet, one of each key. Returns the header.

    The header grows by keys never seen, in order of name within a flush; old rows are not rewritten. migrate gives old
    column names their new ones, so that rows under an older header do not bring a second set of columns. Rows without a
    key are left out. The registry is replaced after the rows are there: a failure between leaves rows under the old
    header, and the next flush registers their columns.
    """
    spark = rows.sparkSession
    new_name = lambda k: k
    if migrate:
        names = F.create_map(*[F.lit(x) for kv in migrate.items() for x in kv])
        new_name = lambda k: F.coalesce(F.try_element_at(names, k), k)
    # Of an old and a new name in one bag the first that is not blank counts.
    entries = F.filter(F.transform(F.map_entries(bag), lambda e: F.struct(new_name(e["key"]).alias("key"), e["value"].alias("value"))), lambda e: F.coalesce(e["value"], F.lit("")) != "")
    keys = F.array_distinct(F.transform(entries, lambda e: e["key"]))
    whole = F.map_from_arrays(keys, F.transform(keys, lambda k: F.filter(entries, lambda e: e["key"] == k)[0]["value"]))
    fresh = rows.filter(F.col(key).isNotNull()).select(key, whole.alias("_bag"))
    fresh = fresh.groupBy(key).agg(F.min_by("_bag", F.to_json("_bag")).alias("_bag"))
    if (old := _rounds(spark, root)) is not None:
        fresh = fresh.join(old.select(key), key, "left_anti")
    kept = written(fresh, "flush")
    found = [r[0] for r in kept.select(F.explode(F.map_keys("_bag")).alias("k")).distinct().orderBy("k").collect()]  # as wide as the header
    late = [] if old is None else [c for c in _appended_columns(spark, root) if c != "_round"]
    columns = list(dict.fromkeys([*header(spark, root), key, *late, *found]))
    number = uuid.uuid4().hex
    kept.select(F.lit(number).alias("_round"), key, *(F.col("_bag")[c].alias(c) for c in found if c != key)).write.parquet(f"{root}/fresh/{number}")
    put_text(spark, f"{root}/{HEADER}", json.dumps(columns))
    return columns


def _appended_columns(spark: SparkSession, root: str) -> list[str]:
    got = _appended(spark, root)
    return [] if got is None else got.columns


def compact(spark: SparkSession, root: str, files: int = 1) -> None:
    """Rewrite the base and all appended files as a new base of `files` files under the whole header; what was appended goes afterwards."""
    rows = _rounds(spark, root)
    if rows is not None:
        publish(rows.repartition(files), f"{root}/base")
        p, fs = hadoop_path(spark, f"{root}/fresh")
        fs.delete(p, True)
