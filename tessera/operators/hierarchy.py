"""Rows of a hierarchy to one JSON document of any depth."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.sources.shared import written


def nested_json(rows: DataFrame, key: str, path: str, value: str, place: str, listed: tuple[str, ...] = (), name: str = "document", within: str | None = None) -> DataFrame:
    """One JSON object for each key, of rows (key, path: array of names, value: text, place: order in the document).

    Names keep the order of their first place. Values of one path are ordered by place, or by `within` where it is given. Values that share a path are a list, a single one is a text, unless its
    last name is in `listed`: such are always lists. A name that has both values and names below it keeps the names, with
    the values under the empty name. Rows with a null value, an empty path or a null name are left out. Levels are folded
    from the deepest up, one aggregation a level; the depth, not the number of rows, is what the loop grows with.
    """
    ok = F.col(value).isNotNull() & (F.size(path) > 0) & ~F.exists(path, lambda x: x.isNull())
    leaf = rows.filter(ok).groupBy(key, F.col(path).alias("p")).agg(F.array_sort(F.collect_list(F.struct(F.col(within or place).alias("within"), F.col(place).alias("at"), F.col(value).alias("v")))).alias("vs"))
    one = (F.size("vs") == 1) & ~F.element_at("p", -1).isin(*listed) if listed else F.size("vs") == 1
    texts = F.transform("vs", lambda x: x["v"])
    # A list of one is cut out of its brackets: the text of a string in JSON.
    as_list = F.to_json(texts)
    text = F.when(one, F.substr(as_list, F.lit(2), F.length(as_list) - 2)).otherwise(as_list)
    level = written(leaf.select(key, "p", F.array_min(F.transform("vs", lambda x: x["at"])).alias("at"), text.alias("j"), F.lit(False).alias("inner")), "leaves")
    quoted = lambda c: F.regexp_extract(F.to_json(F.array(c)), r"(?s)^\[(.*)\]$", 1)
    depth = level.agg(F.max(F.size("p"))).collect()[0][0] or 0
    for n in range(depth, 0, -1):
        deep, rest = level.filter(F.size("p") == n), level.filter(F.size("p") < n)
        # Where a name has values and names, the values go below the empty name.
        both = F.max("inner").alias("names"), F.min("at").alias("at"), F.max(F.when(F.col("inner"), F.col("j"))).alias("obj"), F.max(F.when(~F.col("inner"), F.col("j"))).alias("val")
        merged = deep.groupBy(key, "p").agg(*both)
        j = F.when(~F.col("names"), F.col("val")).when(F.col("val").isNull(), F.col("obj")).otherwise(F.concat(F.lit('{"":'), "val", F.lit(","), F.substr("obj", F.lit(2))))
        member = F.struct("at", F.concat(quoted(F.element_at("p", -1)), F.lit(":"), j).alias("m"))
        up = merged.select(key, F.slice("p", 1, n - 1).alias("p"), member.alias("m"), "at").groupBy(key, "p").agg(F.min("at").alias("at"), F.array_sort(F.collect_list("m")).alias("ms"))
        up = up.select(key, "p", "at", F.concat(F.lit("{"), F.array_join(F.transform("ms", lambda x: x["m"]), ","), F.lit("}")).alias("j"), F.lit(True).alias("inner"))
        level = rest.unionByName(up)
    return level.select(key, F.col("j").alias(name))
