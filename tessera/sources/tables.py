"""Sources and sinks of catalogues: text CSV, header aliases, append with dedup, schema heal, structural validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path is there, in whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def read_catalogue(spark: SparkSession, path: str, columns: list[str] | None = None, blanks: bool = False, drop_malformed: bool = False, typed: bool = False, optional: bool = False) -> DataFrame:
    """CSV with a header, every column text, or typed by its content. A byte order mark goes, bytes that are not UTF-8 become U+FFFD.

    blanks: empty cells stay empty texts, else they are null. drop_malformed: lines of another number of fields go.
    optional: a missing path, like an empty file, is an empty table of `columns` (none are known without them).
    """
    if optional and not exists(spark, path):
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in columns or []) or T.StructType([]))
    r = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("mode", "DROPMALFORMED" if drop_malformed else "PERMISSIVE").option("inferSchema", typed)
    df = r.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns])).csv(path) if columns else r.csv(path)
    df = df.toDF(*[c.strip().removeprefix("\ufeff").strip() for c in df.columns])
    return df.na.fill("") if blanks else df


def keyed(df: DataFrame, key: str, order: str) -> DataFrame:
    """One row of each key, the last by order; keys are trimmed, without slashes at their end; blank ones go."""
    from tessera.operators.lookup import dedup_dim

    clean = F.regexp_replace(F.trim(key), "/+$", "")
    return dedup_dim(df.withColumn(key, clean).filter(F.col(key) != ""), key, [F.desc(order)])


def read_inputs(df: DataFrame) -> DataFrame:
    """(name, url) of an input list with any of its header spellings; blank addresses go, a blank name is its address. A list without an address column raises."""
    found = resolve_aliases(df, {"name": ["server_name", "server name"], "url": ["server_url", "server url"]})
    if not {"url", "server_url", "server url"} & {c.strip().lower() for c in df.columns}:
        raise ValueError("missing columns: url")
    url = F.trim("url")
    return found.filter(F.coalesce(url, F.lit("")) != "").select(F.coalesce(F.nullif(F.trim("name"), F.lit("")), url).alias("name"), url.alias("url"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file_name, text) of every file below a folder, one row each; order by file_name for the order of a listing."""
    return spark.read.text(path, wholetext=True).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("text"))


def read_state(spark: SparkSession, path: str, value: str = "status string, updated_at string") -> DataFrame:
    """(key, fields of value) of a JSON object of objects; a missing or broken file is an empty state."""
    empty = spark.createDataFrame([], f"key string, {value}")
    if not exists(spark, path):
        return empty
    got = spark.read.text(path, wholetext=True).select(F.explode(F.from_json("value", f"map<string,struct<{value.replace(' ', ':').replace(',:', ',')}>>")).alias("key", "v"))
    return got.select("key", "v.*")


def optional_column(df: DataFrame, name: str, kind: str = "string"):
    """A column, or null where the table has none of that name."""
    return F.col(f"`{name}`") if name in df.columns else F.lit(None).cast(kind).alias(name)


def resolve_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns by canonical name; headers match in any case; a missing one is null."""
    have = {c.strip().lower(): c for c in df.columns}
    found = {k: next((have[a.lower()] for a in [k, *names] if a.lower() in have), None) for k, names in aliases.items()}
    return df.select(*[(F.col(f"`{c}`") if c else F.lit(None).cast("string")).alias(k) for k, c in found.items()])


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    if missing := [c for c in names if c not in df.columns]:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def heal(df: DataFrame, columns: list[str]) -> DataFrame:
    """Re-project by name: absent columns become blank, unknown ones go."""
    return df.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])


def append_new(existing: DataFrame, incoming: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of incoming whose key is new, the first of each key by order."""
    from tessera.operators.lookup import dedup_dim

    return dedup_dim(incoming, key, [F.col(order)]).join(existing.select(key), key, "left_anti")


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).option("escape", '"').csv(path)


def bad_list_cells(df: DataFrame, column: str) -> DataFrame:
    """Rows whose cell looks like a list but is not JSON."""
    return df.filter(F.col(column).rlike("^\\[.*\\]$") & F.from_json(column, "array<string>").isNull())


def field_faults(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a written CSV (without line breaks in cells) whose number of fields is not the header's: (file_name, line, fields, expected)."""
    lines = spark.read.text(path).select(F.col("_metadata.file_name").alias("file_name"), F.col("value").alias("line"))
    fields = F.size(F.split(F.regexp_replace("line", '"(?:[^"]|"")*"', "x"), ",", -1))
    counted = lines.withColumn("fields", fields)
    header = spark.read.option("header", True).csv(path).columns
    return counted.withColumn("expected", F.lit(len(header))).filter("fields != expected")


def write_with_mark(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV for spreadsheet programs: the first header of each file begins with a byte order mark."""
    first, *rest = df.columns
    write_csv(df.select(F.col(f"`{first}`").alias(f"\ufeff{first}"), *(F.col(f"`{c}`") for c in rest)), path, mode)


def write_split(df: DataFrame, path: str, problem) -> None:
    """Two tables below a path: report, with every row, and problems. One pass over the rows writes each; give a written table where they are costly."""
    write_csv(df, f"{path}/report")
    write_csv(df.filter(problem), f"{path}/problems")


def dynamic_columns(df: DataFrame, fixed: list[str], bag: str, known: tuple[str, ...] = (), most: int = 1000) -> DataFrame:
    """fixed columns and one for each key of a map column: known ones first, then new ones by name.

    At most `most` new keys get columns, those of the most rows; where there are more, a map column `others` holds the
    rest, so that the header's width and what the driver reads of it are bounded and nothing is lost.
    """
    counts = df.select(F.explode(F.map_keys(bag)).alias("k")).filter(~F.col("k").isin(*known)).groupBy("k").count()
    keys = [r[0] for r in counts.orderBy(F.desc("count"), "k").limit(most + 1).collect()]
    header = [*known, *sorted(keys[:most])]
    got = df.select(*fixed, *(F.coalesce(F.try_element_at(bag, F.lit(k)), F.lit("")).alias(k) for k in header), F.col(bag).alias("_bag"))
    rest = F.map_filter("_bag", lambda k, v: ~F.array_contains(F.array(*map(F.lit, header)), k))
    return got.withColumn("others", rest).drop("_bag") if len(keys) > most else got.drop("_bag")


def replace_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write beside the path, then swap, so that a table can be rewritten from itself.

    Between the two renames the path has no table, and if the second fails the old one is moved back; where readers must
    never miss the table, publish() of the shared module gives versions behind a pointer.
    """
    import uuid

    spark = df.sparkSession
    own, old = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:8]}", f"{path.rstrip('/')}.old-{uuid.uuid4().hex[:8]}"
    df.write.format(fmt).save(own)
    to = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p)
    fs = to(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(to(path)) and not fs.rename(to(path), to(old)):
        raise OSError(f"cannot move {path}")
    if not fs.rename(to(own), to(path)):
        fs.rename(to(old), to(path))
        raise OSError(f"cannot move {own}")
    fs.delete(to(old), True)


def write_sheets(sheets: dict[str, DataFrame], path: str) -> None:
    """One table a sheet, each in a folder of its name: what a workbook would hold."""
    for name, df in sheets.items():
        write_csv(df, f"{path}/{name}")


def html_report(summary: DataFrame, title: str) -> str:
    """A page of a summary's rows (metric, value); the summary is one row a metric, so the page is small."""
    import html

    cells = "".join(f"<tr><td>{html.escape(str(r['metric']))}</td><td>{html.escape(str(r['value']))}</td></tr>" for r in summary.orderBy("place").collect())
    return f"<!DOCTYPE html><html><head><title>{html.escape(title)}</title></head><body><h1>{html.escape(title)}</h1><table>{cells}</table></body></html>"


def write_report(report: DataFrame, summary: DataFrame, path: str) -> None:
    """A report as JSON lines, and its one summary row added to a log of all runs."""
    report.write.mode("overwrite").json(f"{path}/report")
    summary.write.mode("append").json(f"{path}/summaries")
