"""Status ladders: the first condition that holds names the status. Counts and sets come as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import squeeze
from tessera.operators.compare import ladder


def _text(n: Column, words: str) -> Column:
    return F.concat(n.cast("string"), F.lit(words))


def lookup_status(total: Column, matched: Column, families: Column | None = None, what: str = "processors") -> Column:
    """missing, Family is not found, mismatch (matched without a family, if families are given), 'k of n ... missing', match."""
    steps = F.when(total == 0, "missing").when(matched == 0, "Family is not found")
    if families is not None:
        steps = steps.when(F.size(families) == 0, "mismatch")
    return steps.when(matched < total, F.concat((total - matched).cast("string"), F.lit(" of "), total.cast("string"), F.lit(f" {what} missing"))).otherwise("match")


def family_status(total: Column, mapped: Column, actual: Column) -> Column:
    """missing, No family is mapped, Family is not found, mismatch (nothing in common), 'k family missing' (actual ones that are not mapped), match."""
    extra = F.size(F.array_except(actual, mapped))
    return F.when(total == 0, "missing").when((F.size(actual) == 0) & (F.size(mapped) > 0), "No family is mapped").when(F.size(mapped) == 0, "Family is not found").when(~F.arrays_overlap(mapped, actual), "mismatch").when(extra > 0, _text(extra, " family missing")).otherwise("match")


def missing_status(families: Column, lines: Column) -> Column:
    f, x = F.size(families) > 0, F.size(lines) > 0
    return F.when(f & x, "family and line missing").when(f, "family missing").when(x, "line missing").otherwise("none")


def family_line_status(total: Column, mapped: Column, actual: Column, missing_families: Column, missing_lines: Column) -> Column:
    """Counts of missing families, then lines, after the cases without processors, catalogue families or mapped families."""
    steps = F.when(total == 0, "missing").when((F.size(actual) == 0) & (F.size(mapped) > 0), "No family is mapped in main CSV").when(F.size(mapped) == 0, "Family is not found")
    return steps.when(F.size(missing_families) > 0, _text(F.size(missing_families), " family missing")).when(F.size(missing_lines) > 0, _text(F.size(missing_lines), " line missing")).otherwise("match")


def four_way_status(mapped_families: Column, actual_families: Column, mapped_lines: Column, actual_lines: Column) -> Column:
    """'1 family missing & 2 lines mismatch', match, or no match where nothing is mapped. The plural of family is 'familys': reports hold that text."""
    def said(n: Column, word: str, verb: str) -> Column:
        return F.when(n > 0, F.concat(n.cast("string"), F.when(n == 1, f" {word} ").otherwise(f" {word}s "), F.lit(verb)))

    sides = [(mapped_families, actual_families, "family"), (mapped_lines, actual_lines, "line")]
    parts = [said(F.size(F.array_except(a, b)), word, verb) for m, x, word in sides for a, b, verb in ((m, x, "missing"), (x, m, "mismatch"))]
    return F.when((F.size(mapped_families) == 0) & (F.size(mapped_lines) == 0), "no match").otherwise(F.coalesce(F.nullif(F.concat_ws(" & ", *parts), F.lit("")), F.lit("match")))


def vendor_status(total: Column, matched: Column, actual: Column, families: Column) -> Column:
    """missing, Family is not found, partial_match, then whether the catalogue's family is among those found."""
    steps = F.when(total == 0, "missing").when(matched == 0, "Family is not found").when(matched < total, "partial_match")
    return steps.when((F.coalesce(actual, F.lit("")) != "") & (F.size(families) > 0) & ~F.array_contains(families, actual), "mismatch").otherwise("match")


def partly_missing_status(total: Column, matched: Column, families: Column) -> Column:
    """missing without items, Family is not found without hits, mismatch for hits without a family, else how many of all have none, or match."""
    steps = F.when(total == 0, "missing").when(matched == 0, "Family is not found").when(F.size(families) == 0, "mismatch")
    return steps.when(matched < total, F.concat((total - matched).cast("string"), F.lit(" of "), total.cast("string"), F.lit(" family missing"))).otherwise("match")


def duplicate_or(first_row: Column, row: Column, status: Column) -> Column:
    """'DUPLICATE (same as row N)' for a row with an equal one before it, else its own status."""
    return F.when(first_row < row, F.concat(F.lit("DUPLICATE (same as row "), first_row.cast("string"), F.lit(")"))).otherwise(status)


#: Orders in which statuses of a row are written.
SPEED_ORDER = ("Match", "Missing", "Mismatch", "Duplicate", "NoFamily")
SPEED_COMMENTS = ("match max memory speed", "missing max memory speed", "mismatch max memory speed", "duplicate processor max memory speed", "no family mapped in main CSV")


def speed_status(duplicate: Column, hits: Column, known: Column, actual: Column, family: Column) -> Column:
    """Status of one processor. hits: reference rows; known: their speeds that are not blank; actual: the catalogue's speed."""
    blank = F.coalesce(F.trim(actual), F.lit("")) == ""
    no_family = F.coalesce(F.trim(family), F.lit("")) == ""
    unknown = F.size(known) == 0
    own = F.when(no_family, "NoFamily").otherwise("Match")
    return F.when(duplicate, "Duplicate").when(hits == 0, "Missing").when(unknown & blank, own).when(unknown | blank, "Missing").when(~F.array_contains(known, actual), "Mismatch").otherwise(own)


def row_of_statuses(statuses: Column, order: tuple[str, ...] = SPEED_ORDER, none: str = "Missing") -> Column:
    """The distinct statuses of a row in a fixed order, joined by '|'."""
    held = F.filter(F.array(*map(F.lit, order)), lambda s: F.array_contains(statuses, s))
    return F.when(F.size(held) > 0, F.array_join(held, "|")).otherwise(none)


def row_of_reasons(statuses: Column, order: tuple[str, ...] = SPEED_ORDER, comments: tuple[str, ...] = SPEED_COMMENTS) -> Column:
    """'2 match max memory speed; 1 ...' of a row's statuses in order."""
    of = lambda s: F.size(F.filter(statuses, lambda x: x == s))
    counts = [(of(s), c) for s, c in zip(order, comments)]
    return F.concat_ws("; ", *[F.when(n > 0, _text(n, f" {c}")) for n, c in counts])


#: The counters of a row, in the order of their reasons: (name, words for one, words for more).
COUNTERS = (  # Fixed values.
    ("missing", "{} missing from the references", "{} missing from the references"), ("family_match", "{} processor family matched", "{} processor family matched"), ("family_mismatch", "{} processor family mismatches", "{} processor family mismatches"),
    ("line_match", "{} processor line matched", "{} processor line matched"), ("line_mismatch", "{} processor line mismatches", "{} processor line mismatches"), ("no_family", "{} have no processor_family mapping", "{} have no processor_family mapping"),
    ("dup_processors", "{} duplicate processor values", "{} duplicate processor values"), ("dup_families", "one duplicate in processor family", "{} duplicates in processor family"), ("dup_lines", "one duplicate in processor line", "{} duplicates in processor line"),
)


def counter_reason(n: dict[str, Column]) -> Column:
    """The counters that are not 0 in words, with a full stop, which is all there is for a row without any."""
    def said(col: Column, one: str, many: str) -> Column:
        before, after = many.split("{}")
        return F.when(col == 1, F.lit(one) if "{}" not in one else F.concat(F.lit(before), F.lit("1"), F.lit(after))).when(col > 1, F.concat(F.lit(before), col.cast("string"), F.lit(after)))

    return F.concat(F.concat_ws("; ", *[said(n[k], one, many) for k, one, many in COUNTERS]), F.lit("."))


def counter_status(n: dict[str, Column], total: Column) -> Column:
    some = lambda *names: sum((n[x] for x in names[1:]), n[names[0]]) > 0
    parts = [(some("match", "family_match", "line_match"), "match"), (some("missing"), "missing"), (some("family_mismatch", "line_mismatch"), "mismatch"), (some("no_family"), "No family is mapped in main CSV"), (some("dup_processors", "dup_families", "dup_lines"), "duplicate")]
    return F.when(total == 0, "No processors in main CSV").otherwise(F.concat_ws(" | ", *[F.when(c, F.lit(s)) for c, s in parts]))


def any_counter(n: dict[str, Column], names: tuple[str, ...]) -> Column:
    """Rows with a problem: any of these counters is not 0."""
    out = F.coalesce(n[names[0]], F.lit(0)) != 0
    for x in names[1:]:
        out = out | (F.coalesce(n[x], F.lit(0)) != 0)
    return out


def split_status(*pairs: tuple[Column, Column]) -> Column:
    """(actual, expected) columns: MISSING if an actual one is blank, MISMATCH in any but case and spaces, MATCH."""
    blank = differ = F.lit(False)
    for actual, expected in pairs:
        a = F.coalesce(F.trim(actual), F.lit(""))
        blank = blank | (a == "")
        differ = differ | (F.lower(squeeze(a)) != F.lower(squeeze(expected)))
    return F.when(blank, "MISSING").when(differ, "MISMATCH").otherwise("MATCH")


def mask_status(blank: Column, dup_in_cell: Column, differ: Column, dup_row: Column) -> Column:
    """DUPLICATE_IN_CELL over MISSING; then MISMATCH; DUPLICATE only for rows that would match."""
    return ladder((dup_in_cell, "DUPLICATE_IN_CELL"), (blank, "MISSING"), (differ, "MISMATCH"), (dup_row, "DUPLICATE"), default="MATCH")


def sku_status(expected: Column, actual: Column) -> Column:
    return F.when(actual.isNull(), "Missing").when(actual.eqNullSafe(expected), "Match").otherwise("Unmatch")


def capacity_status(expected: Column, actual: Column) -> list[Column]:
    """status (Verified or Issue) and reason (missing or mismatch)."""
    gone = expected.isNull() | actual.isNull()
    return [F.when(gone | (expected != actual), "Issue").otherwise("Verified").alias("status"), F.when(gone, "missing").when(expected != actual, "mismatch").otherwise("").alias("reason")]


def document_status(slots: Column, doc_slots: Column, most: Column, doc_most: Column) -> Column:
    """Slots and greatest memory of a document against the catalogue's, MISSING where a side has none."""
    def one(a: Column, b: Column) -> Column:
        return F.when(a.isNull() | b.isNull(), "MISSING").when(a == b, "MATCH").otherwise("MISMATCH")

    return F.struct(one(slots, doc_slots).alias("slots"), one(most, doc_most).alias("memory"))


def answer_status(cell: Column, keyed: Column, expected: Column, extracted: Column) -> Column:
    """invalid_json, no_key, no_data (nothing extracted), invalid_data (no list expected), match or mismatch as sets."""
    key = lambda a: F.array_sort(F.array_distinct(F.transform(a, lambda x: F.lower(squeeze(x)))))
    return F.when(F.try_parse_json(cell).isNull(), "invalid_json").when(~keyed, "no_key").when(F.size(extracted) == 0, "no_data").when(expected.isNull(), "invalid_data").when(key(expected) == key(extracted), "match").otherwise("mismatch")


def completeness(present: list[tuple[Column, str, str]]) -> Column:
    """struct(status, percent, severity, issues, feasible) of three facts (held, issue, what mends it); two of three are PARTIAL. The first two facts weigh HIGH, the last MEDIUM."""
    held = sum((c.cast("int") for c, _, _ in present[1:]), present[0][0].cast("int"))
    issues = F.concat_ws(" | ", *[F.when(~c, F.lit(issue)) for c, issue, _ in present])
    last = F.coalesce(*[F.when(~c, F.lit(mend)) for c, _, mend in reversed(present)], F.lit("YES"))
    severity = F.when(~present[0][0] | ~present[1][0], "HIGH").when(~present[2][0], "MEDIUM").otherwise("LOW")
    status = F.when(held == 3, "VERIFIED").when(held == 2, "PARTIAL").when(held == 1, "INCOMPLETE").otherwise("FAILED")
    return F.struct(status.alias("status"), F.format_string("%.1f%%", held * 100 / 3).alias("percent"), severity.alias("severity"), F.coalesce(F.nullif(issues, F.lit("")), F.lit("None")).alias("issues"), last.alias("feasible"))


def explanation(field: Column, csv: Column, live: Column) -> Column:
    """A known reason for a field's difference, null if it needs a look: fetch_error, recategorized, driver_table, multi_config_tab, line_split, trademark_format."""
    spec = field.startswith("specifications[")
    key = F.lower(F.regexp_extract(field, r"\[(.*)\]$", 1))
    lines = lambda c: F.array_distinct(F.filter(F.split(F.when(c.isin("(not found on live page)", "(not present in CSV)"), F.lit("")).otherwise(F.coalesce(c, F.lit(""))), "\n"), lambda x: F.trim(x) != ""))
    a, b = lines(csv), lines(live)
    flat = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"[\s®™°]+", "")
    fewer = (F.size(b) > 0) & (F.size(F.array_except(b, a)) == 0) & (F.size(F.array_except(a, b)) > 0)
    return (
        F.when(field == "(fetch)", "fetch_error")
        .when((field == "category") & (F.lower(F.trim(csv)) != F.lower(F.trim(live))) & (csv != "") & (live != ""), "recategorized")
        .when(spec & (live == "(not found on live page)") & (key.rlike("driver|firmware|bios|utility|manual") | (key == "description")), "driver_table")
        .when(spec & fewer, "multi_config_tab")
        .when(spec & (flat(csv) == flat(live)) & (flat(csv) != ""), "line_split")
        .when((field == "features_summary") & F.contains(live, F.lit("TM")) & ~F.contains(F.coalesce(csv, F.lit("")), F.lit("TM")), "trademark_format")
    )


#: Outcomes of one component, from nothing to all found.
COMPONENT_LEVELS = ("NOT_FOUND", "FALLBACK", "PARTIAL", "FULL")


def component_level(found: Column, fallback: Column, variants: Column, specified: Column) -> Column:
    """NOT_FOUND, FALLBACK (a basic row instead of variants), PARTIAL (variants without all their specifications), FULL."""
    return F.when(~found, "NOT_FOUND").when(fallback | (variants == 0), "FALLBACK").when(specified < variants, "PARTIAL").otherwise("FULL")
