"""Memory ranks: rows against their description and their server's list, servers against their rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import arrays, models

#: Rank names that exist. Fixed values.
VALID = ("1Rx2", "1Rx4", "1Rx8", "1Rx16", "2Rx4", "2Rx8", "2Rx16", "3Rx4", "4Rx4", "4Rx8", "8Rx4")


def blank(c: Column) -> Column:
    return F.coalesce(F.trim(c.cast("string")), F.lit("")) == ""


def shown(items: Column) -> Column:
    return F.array_join(models.sort_ranks(F.array_distinct(items)), ", ")


def rank_row(first: Column, ranks: Column, width: Column, dimm: Column, description: Column, server: Column) -> Column:
    """struct(status_raw, status, reason) of a memory row.

    first: the row number of the first row with this content, null for a first row. A duplicate is not checked further;
    a row with a blank cell is Missing; then its own cells, the description and the server's list must agree. status
    shows Missing as Matched, as reports do.
    """
    read = F.struct(models.rank_of_columns(ranks, width).alias("combined"), models.rank(dimm).alias("canonical"), models.last_rank(description).alias("expected"))
    return arrays.let(read, lambda r: _checked_row(first, ranks, width, dimm, server, r["combined"], r["canonical"], r["expected"]))


def _checked_row(first: Column, ranks: Column, width: Column, dimm: Column, server: Column, combined: Column, canonical: Column, expected: Column) -> Column:
    gaps = [(blank(ranks), "Rank"), (blank(width), "Rank Width"), (blank(dimm), "DIMM Rank"), (expected.isNull(), "DIMM Rank in Part Description")]
    missing = F.concat_ws(", ", *[F.when(c, F.lit(x)) for c, x in gaps])
    differ = [
        F.when(~combined.eqNullSafe(canonical), F.concat(F.lit("Rank/Rank Width ("), F.coalesce(combined, F.lit("none")), F.lit(") does not match DIMM Rank ("), dimm, F.lit(")"))),
        F.when(~canonical.eqNullSafe(expected), F.concat(F.lit("DIMM Rank ("), dimm, F.lit(") does not match Part Description ("), expected, F.lit(")"))).when(~combined.eqNullSafe(expected), F.concat(F.lit("Rank/Rank Width ("), F.coalesce(combined, F.lit("none")), F.lit(") does not match Part Description ("), expected, F.lit(")"))),
    ]
    wrong = F.concat_ws("; ", *differ)
    check = F.coalesce(canonical, expected)
    unlinked = F.coalesce(check.isNotNull() & ~F.array_contains(server, check), F.lit(False))
    absent = F.when(unlinked, F.concat(check, F.lit(" not present in Server DIMM Ranks ["), F.coalesce(F.nullif(shown(server), F.lit("")), F.lit("empty")), F.lit("]")))
    raw = F.when(first.isNotNull(), "Duplicate").when(missing != "", "Missing").when((wrong != "") | unlinked, "Unmatched").otherwise("Matched")
    reason = F.when(first.isNotNull(), F.concat(F.lit("Duplicate of CSV row "), first.cast("string"))).when(missing != "", F.concat_ws("; ", F.concat(F.lit("Missing value(s): "), missing), absent)).otherwise(F.concat_ws("; ", F.nullif(wrong, F.lit("")), absent))
    return F.struct(raw.alias("status_raw"), F.when(raw == "Missing", "Matched").otherwise(raw).alias("status"), reason.alias("reason"))


def server_roll_up(rows: DataFrame, server: str, rank: str, listed: str, status: str) -> DataFrame:
    """One row of each server: expected ranks of its rows; missing, extra and duplicate ranks in any of its lists; number of different lists, rows, failed rows.

    Ranks are few, so sets of them stay small however many rows a server has: only distinct lists are gathered.
    """
    base = rows.groupBy(server).agg(F.array_sort(F.collect_set(rank)).alias("expected"), F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col(status) == "Unmatched").alias("rows_failed"), F.collect_set(listed).alias("_lists"))
    over = lambda f: F.array_sort(F.array_distinct(F.flatten(F.transform("_lists", f))))
    got = base.withColumns({"missing": over(lambda x: F.array_except("expected", x)), "extra": over(lambda x: F.array_except(x, "expected")), "duplicates": over(arrays.duplicates), "variants": F.size("_lists")})
    return got.withColumn("empty", ~F.exists("_lists", lambda x: F.size(x) > 0)).drop("_lists")


def server_status(g: DataFrame) -> DataFrame:
    """status and reason of rolled-up servers: Missing without any list, Duplicate if lists only repeat ranks, Unmatched for any other finding."""
    none = F.size("expected") == 0
    parts = [
        F.when(F.size("missing") > 0, F.concat(F.lit("Expected rank(s) missing from Server DIMM Ranks: "), shown(F.col("missing")))),
        F.when(F.size("extra") > 0, F.concat(F.lit("Server DIMM Ranks lists rank(s) with no memory part: "), shown(F.col("extra")))),
        F.when(F.size("duplicates") > 0, F.concat(F.lit("Rank(s) repeated in Server DIMM Ranks: "), shown(F.col("duplicates")))),
        F.when(F.col("variants") > 1, F.concat(F.lit("Server DIMM Ranks differs between rows ("), F.col("variants").cast("string"), F.lit(" variants)"))),
        F.when(none, F.lit("No memory parts with DIMM ranks found for this server")),
    ]
    text = F.concat_ws("; ", *parts)
    nothing = F.lit("No DIMM rank data: no memory part ranks and Server DIMM Ranks is empty")
    reason = F.when(F.col("empty"), F.when(none, nothing).otherwise(F.concat(F.lit("Server DIMM Ranks is empty; expected "), shown(F.col("expected"))))).otherwise(text)
    status = F.when(F.col("empty"), "Missing").when((F.size("duplicates") > 0) & (F.size("missing") == 0) & (F.size("extra") == 0), "Duplicate").when(text != "", "Unmatched").otherwise("Matched")
    return g.withColumns({"status": status, "reason": reason})


def coverage(rows: DataFrame, server: str, rank: str, listed: str) -> DataFrame:
    """Each row against all ranks of its server's rows, null servers left out: missing tells how often each rank stands (not each time anew), mismatch keeps repeats, issue names what was found, Verified without any.

    The server's ranks are counted first, so what is joined back is one small list a server.
    """
    upper = lambda c: F.upper(F.trim(c))
    counts = rows.filter(F.col(server).isNotNull()).groupBy(server, upper(F.col(rank)).alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    of = counts.groupBy(server).agg(F.array_sort(F.collect_list(F.when(F.col("_r").isNotNull(), F.struct("_r", "_n")))).alias("_counts"))
    got = rows.join(of, server)
    own = F.transform(F.coalesce(F.col(listed), F.array().cast("array<string>")), lambda x: upper(x))
    known = F.transform("_counts", lambda s: s["_r"])
    got = got.withColumns({
        "missing": F.transform(F.filter("_counts", lambda s: ~F.array_contains(own, s["_r"])), lambda s: F.concat(s["_r"], F.lit(" x"), s["_n"].cast("string"))),
        "mismatch": F.array_sort(F.filter(own, lambda x: ~F.array_contains(known, x))), "duplicates": arrays.duplicates(own),
    })
    parts = [F.when(F.size(c) > 0, F.lit(f"{w} DIMM Ranks")) for c, w in (("missing", "Missing"), ("mismatch", "Mismatch"), ("duplicates", "Duplicate"))]
    return got.withColumn("issue", F.coalesce(F.nullif(F.concat_ws(", ", *parts), F.lit("")), F.lit("Verified"))).drop("_counts")


def domain_check(dimm: Column, server: Column) -> Column:
    """struct(status, dimm_issue, server_issue): names that do not exist and repeats are told; a valid rank that the server lacks fails without text."""
    valid = F.array(*map(F.lit, VALID))
    bad = lambda c: F.filter(c, lambda x: ~F.array_contains(valid, x))
    good = lambda c: F.array_intersect(c, valid)
    lacks = F.size(F.array_except(good(dimm), good(server))) > 0
    said = lambda words, c: F.when(F.size(c) > 0, F.concat(F.lit(words), F.array_join(c, ", ")))
    own, other = said("Invalid dimm_ranks: ", bad(dimm)), F.concat_ws("; ", said("Invalid server_dimm_ranks: ", bad(server)), said("Duplicates in server_dimm_ranks: ", arrays.duplicates(server)))
    fail = own.isNotNull() | (other != "") | lacks
    return F.struct(F.when(fail, "FAIL").otherwise("PASS").alias("status"), F.coalesce(own, F.lit("")).alias("dimm_issue"), other.alias("server_issue"))
