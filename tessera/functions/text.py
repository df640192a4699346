"""Normaliser chains and extractors as column expressions."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Rules (pattern, replacement), applied in order to lower-case text; chain() trims what is left.
_GEN = (r"\bgeneration\b", "gen")
_PROCESSORS = (r"\bprocessors\b", "processor")
_CORE_WORDS = (r"\b(soc|quad-core|dual-core|single-core|i[- ]?series)\b", "")
_MARKS = ("[®™Â]", "")
_SQUEEZE = (r"\s+", " ")
#: Signs become spaces, hyphens stay.
PRODUCT_NAME = (_GEN, _PROCESSORS, _CORE_WORDS, _MARKS, (r"[^\p{L}\p{N}_\s-]", " "), _SQUEEZE)
#: Counts of sockets go as well.
SERVER_NAME = ((r"\b[0-9]+x\b", ""), (r"\bdual\b|\bsingle\b", ""), *PRODUCT_NAME)
#: Signs go without a space.
TIGHT_NAME = (_GEN, _PROCESSORS, _CORE_WORDS, (r"[^\p{L}\p{N}_\s-]", ""), _SQUEEZE)
#: '3rd-generation' and '3rd gen' become '3 gen'.
GENERATION_NAME = ((r"\b([0-9]+)(?:st|nd|rd|th)?\s*-?\s*generation\b", "$1 gen"), (r"\b([0-9]+)(?:st|nd|rd|th)?\s*-?\s*gen\b", "$1 gen"), _PROCESSORS, _CORE_WORDS, _MARKS, (r"[^\p{L}\p{N}_\s-]", " "), _SQUEEZE)
#: Words that name no model go.
SPEED_NAME = (("[®™]", ""), _SQUEEZE, ("processor", ""), ("with radeon graphics", ""), ("series", ""))
FAMILY = (_MARKS, ("[()]", ""), ("-", " "), _GEN, ("processors", "processor"), (r"[^\p{L}\p{N}_\s]", " "), _SQUEEZE)
#: Keys are made of every item: marks begin with one class of letters, and single spaces are no match.
_KEY_MARKS = (r"[™®©�(](?:(?<=[™®©�])|(?<=\()(?:r|tm)\))", "")
_KEY_SPACES = (r"\s(?:(?<! )|\s)\s*", " ")
#: A comparison key, and one for processors.
KEY = (_KEY_MARKS, _KEY_SPACES)
PROCESSOR_KEY = (_KEY_MARKS, (r"\bprocessor\b", " "), _KEY_SPACES)


def chain(col: Column, rules, lower: bool = True) -> Column:
    c = F.lower(col) if lower else col
    for pattern, repl in rules:
        c = F.regexp_replace(c, pattern, repl)
    return F.trim(c)


def squeeze(col: Column) -> Column:
    """White space runs become one space."""
    return F.trim(F.regexp_replace(col, "\\s+", " "))


#: A written-out escape, a backslash with what it stands before, or a run without one.
_ESCAPES = r"(?s)\\u[0-9a-fA-F]{4}|\\U[0-9a-fA-F]{8}|\\x[0-9a-fA-F]{2}|\\[0-7]{1,3}|\\.|\\$|[^\\]+"


def unescaped(col: Column) -> Column:
    """Text with written-out escapes (®, \x41, \101, \n) as the letters, digits and blanks they stand for; other signs of them go.
    Where an escape is cut short all stay as they are written."""

    def one(t: Column) -> Column:
        code = F.when(t.rlike(r"^\\[uUx]"), F.conv(F.substr(t, F.lit(3)), 16, 10)).when(t.rlike(r"^\\[0-7]"), F.conv(F.substr(t, F.lit(2)), 8, 10)).cast("long")
        said = F.when(code == 160, " ").when((code < 128) & F.chr(code).rlike("[A-Za-z0-9 ]"), F.chr(code)).otherwise("")
        return F.when(code.isNotNull(), said).when(t.rlike("""(?s)^\\\\[\\\\'"abfnrtv\n]"""), "").otherwise(t)

    parts = F.regexp_extract_all(col, F.lit(_ESCAPES), F.lit(0))
    cut = F.exists(parts, lambda t: t.rlike(r"^\\[uUxN]?$"))
    return F.when(~col.contains("\\") | cut, col).otherwise(F.array_join(F.transform(parts, one), ""))


def alnum_upper(col: Column) -> Column:
    """Upper-case letters, digits and spaces: escapes are read first, then all other signs go, as do leading dashes; null if nothing or 'nan' is left."""
    c = F.regexp_replace(unescaped(F.trim(col)), "\u00a0", " ")
    c = F.regexp_replace(F.regexp_replace(c, r"^-+\s*", ""), "[^A-Za-z0-9 ]+", "")
    c = F.upper(F.trim(F.regexp_replace(c, r"\s+", " ")))
    return F.when(~c.isin("", "NAN"), c)


def trim_upper(col: Column) -> Column:
    return F.upper(F.trim(col))


def web_text(col: Column) -> Column:
    """Text of a page or cell for comparison: malformed blanks, replacement and trademark signs go, compatibility forms fold (NFKC, in Python only for cells that are not ASCII; it writes ™ as TM)."""
    c = F.regexp_replace(F.regexp_replace(col, "�", ""), "&nbsp;?", " ")
    c = F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(nfkc(F.when(~c.rlike(r"^\p{ASCII}*$"), c)))
    return F.trim(F.regexp_replace(F.regexp_replace(c, "[™®°’‘]", ""), r"\s+", " "))


#: The characters of code page 1252 at bytes 0x80 to 0x9f; five bytes have none and stay control characters. Fixed values.
CP1252 = "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"
_HIGH = "".join(map(chr, range(0x80, 0xA0)))
_FOLLOW = f"[{CP1252}\xa0-\xbf]"
#: Characters that, written as bytes of the code page, are one character of UTF-8 of two to four bytes.
MISREAD = f"[\xc2-\xdf]{_FOLLOW}|[\xe0-\xef]{_FOLLOW}{{2}}|[\xf0-\xf4]{_FOLLOW}{{3}}"


def fix_mojibake(col: Column) -> Column:
    """UTF-8 that was read as code page 1252, read again: each run of characters that spells one character of UTF-8 becomes it; all else stays."""

    def read_again(run: Column) -> Column:
        raw = F.encode(F.translate(run, CP1252, _HIGH), "ISO-8859-1")
        return F.coalesce(F.try_validate_utf8(raw.cast("string")), run)

    runs = F.array_distinct(F.regexp_extract_all(col, F.lit(MISREAD), F.lit(0)))
    return F.when(col.rlike(MISREAD), F.aggregate(runs, col, lambda text, run: F.replace(text, run, read_again(run)))).otherwise(col)


def nfkc(col: Column) -> Column:
    """Compatibility composition; Spark has no function for it."""
    def run(x: pa.Array) -> pa.Array:
        return pc.utf8_normalize(x, "NFKC")

    return F.arrow_udf(run, "string")(col)


def product_key(col: Column) -> Column:
    """A key that ignores mojibake, compatibility forms, trademark signs, the word 'processor' and case."""
    c = F.regexp_replace(fix_mojibake(col), r"[®™©]|(?i)\(r\)|\(tm\)", "")  # before NFKC, which makes letters of them
    c = F.lower(nfkc(c))
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"\bprocessors?\b", " "), r"\s+", " "))


def first_match(col: Column, pattern: str, group: int = 0) -> Column:
    """First match, null if there is none."""
    return F.nullif(F.regexp_extract(col, pattern, group), F.lit(""))


def last_match(col: Column, pattern: str) -> Column:
    return F.try_element_at(F.regexp_extract_all(col, F.lit(pattern), F.lit(0)), F.lit(-1))


def distinct_matches(col: Column, pattern: str) -> Column:
    return F.array_distinct(F.regexp_extract_all(col, F.lit(pattern), F.lit(0)))


#: Spelled numbers.
ONES = {"one": 1, "two": 2, "three": 3, "four": 4, "five": 5, "six": 6, "seven": 7, "eight": 8, "nine": 9, "ten": 10, "eleven": 11, "twelve": 12, "thirteen": 13, "fourteen": 14, "fifteen": 15, "sixteen": 16, "seventeen": 17, "eighteen": 18, "nineteen": 19}
TENS = {"twenty": 20, "thirty": 30, "forty": 40, "fifty": 50, "sixty": 60, "seventy": 70, "eighty": 80, "ninety": 90}


def number_words(col: Column) -> Column:
    """One to ninety-nine in words: a single word, or tens and a unit; null for anything else, zero too."""
    words = F.create_map(*[F.lit(x) for kv in (ONES | TENS).items() for x in kv])
    tens = F.create_map(*[F.lit(x) for kv in TENS.items() for x in kv])
    units = F.create_map(*[F.lit(x) for k, v in ONES.items() if v < 10 for x in (k, v)])
    parts = F.split(F.trim(F.regexp_replace(F.lower(col), r"[-\s]+", " ")), " ")
    two = F.try_element_at(tens, F.get(parts, F.lit(0))) + F.try_element_at(units, F.get(parts, F.lit(1)))
    return F.when(F.size(parts) == 1, F.try_element_at(words, F.get(parts, F.lit(0)))).when(F.size(parts) == 2, two)


def literal_json(col: Column) -> Column:
    """A cell written as a Python literal (list, dict, set, None) as JSON text; sets are sorted, null where it is no literal."""
    def run(x: pa.Array) -> pa.Array:
        import ast
        import json

        def plain(v):
            if isinstance(v, dict):
                return {str(k): plain(u) for k, u in v.items()}
            return sorted(map(plain, v), key=str) if isinstance(v, (set, frozenset)) else [plain(u) for u in v] if isinstance(v, (list, tuple)) else v

        def one(t):
            try:
                return None if t is None else json.dumps(plain(ast.literal_eval(t.strip())), ensure_ascii=False)
            except (ValueError, SyntaxError, RecursionError, MemoryError):
                return None

        return pa.array([one(t) for t in x.to_pylist()], pa.string())

    return F.arrow_udf(run, "string")(col)


def flat_items(cell: Column) -> Column:
    """Items of a list cell in JSON or Python notation, one level of nested lists flattened; a cell that is no list is one item; blanks, nan and None go."""
    t = F.trim(F.translate(cell, "‘’“”", "''\"\""))
    listed = t.startswith("[")
    direct = F.from_json(t, "array<string>")
    loose = F.from_json(literal_json(F.when(listed & direct.isNull(), t)), "array<string>")
    items = F.when(listed, F.coalesce(direct, loose, F.array(t))).otherwise(F.array(t))
    nested = F.flatten(F.transform(items, lambda x: F.when(F.startswith(F.trim(x), F.lit("[")), F.coalesce(F.from_json(x, "array<string>"), F.array(x))).otherwise(F.array(x))))
    clean = F.transform(nested, lambda x: F.trim(x))
    return F.coalesce(F.filter(clean, lambda x: x.isNotNull() & (x != "") & ~F.lower(x).isin("nan", "none")), F.array().cast("array<string>"))


def split_items(cell: Column, signs: str = "[,;|]") -> Column:
    """Items of a cell between separators, brackets and quotes stripped, blanks dropped."""
    bare = F.regexp_replace(F.trim(cell), r"^\[|\]$", "")
    items = F.transform(F.split(bare, signs), lambda x: F.trim(F.regexp_replace(F.trim(x), r"^['\"]+|['\"]+$", "")))
    return F.coalesce(F.filter(items, lambda x: x != ""), F.array().cast("array<string>"))


def retokenised(items: Column, cell: Column, pattern: str, most: int = 50) -> Column:
    """items, or, where one is longer than `most`, all sorted distinct matches of pattern in the cell: the list was not split."""
    return F.when(F.exists(items, lambda x: F.length(x) > most), F.array_sort(F.array_distinct(F.regexp_extract_all(cell, F.lit(pattern), F.lit(0))))).otherwise(items)


def list_text(items: Column) -> Column:
    """['a', 'b'] with quotes escaped; blank for an empty list."""
    quoted = F.transform(items, lambda x: F.concat(F.lit("'"), F.replace(x, F.lit("'"), F.lit("\\'")), F.lit("'")))
    return F.when(F.size(items) > 0, F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))).otherwise("")


# Words whose spelling in a name is fixed, matched in any case.
SPELLINGS = ("AMD", "Intel", "NVIDIA", "Xeon", "Core", "Ryzen", "EPYC", "Threadripper", "Pentium", "Celeron", "Athlon", "Grace", "Hopper", "PRO", "APU", "CPU", "GPU", "Scalable", "Desktop", "Graphics", "Radeon", "Vega", "AmpereOne", "Altra", "Family", "series", "Generation")


def respelled(col: Column) -> Column:
    """Brand words in their own spelling; 'processors' and any case of it become 'processor', 'w-' before digits 'W-'."""
    for word in SPELLINGS:
        col = F.regexp_replace(col, rf"(?i)\b{word}\b", word)
    return F.regexp_replace(F.regexp_replace(col, r"(?i)\bprocessors?\b", "processor"), r"(?i)\bw-([0-9]+)\b", "W-$1")


def generation_words(col: Column) -> Column:
    """'3rd gen' and '3rdgen' as '3rd Generation', a lone 'gen' as 'Generation'."""
    c = F.regexp_replace(col, r"(?i)(\b[0-9]{1,2}(?:st|nd|rd|th)?)\s*gen\b", "$1 Generation")
    return F.regexp_replace(c, r"(?i)\bgen\b", "Generation")


def brand_and_model(name: Column) -> Column:
    """struct(brand, model) around the first dash; without one the brand is blank."""
    shape = r"^\s*([^-]+?)\s*-+\s*(.+?)\s*$"
    hit = name.rlike(shape)
    return F.struct(F.when(hit, F.regexp_extract(name, shape, 1)).otherwise("").alias("brand"), F.when(hit, F.regexp_extract(name, shape, 2)).otherwise(F.trim(name)).alias("model"))


#: Kinds of machine by the end of the name; the first that fits counts.
MACHINES = ("Motherboard", "Server", "Workstation", "Desktop", "Notebook", "Laptop", "Mini PC", "Blade Server", "System")


def machine_type(name: Column) -> Column:
    return F.coalesce(*[F.when(F.endswith(F.lower(F.trim(name)), F.lit(k.lower())), F.lit(k)) for k in MACHINES], F.lit(""))


def resolve_url(base: Column, link: Column) -> Column:
    """An absolute link as it is; a rooted one below the base's host, any other below the base; no trailing slashes."""
    host = F.regexp_extract(base, "^([a-z]+://[^/]+)", 1)
    full = F.when(link.rlike("^[a-z]+://"), link).when(link.startswith("/"), F.concat(host, link)).otherwise(F.concat(F.regexp_replace(strip_query(base), "/+$", ""), F.lit("/"), link))
    return F.regexp_replace(full, "/+$", "")


def slug_url(base: Column, name: Column) -> Column:
    """The page of a name below a base: its letters and digits in lower case, joined by dashes."""
    return F.concat(F.regexp_replace(base, "/+$", ""), F.lit("/"), F.regexp_replace(F.regexp_replace(F.lower(name), "[^a-z0-9]+", "-"), "^-+|-+$", ""))


def image_identity(url: Column) -> Column:
    """hash/variant/number of an image's path, whatever host, size and format are; another address as it is."""
    shape = r"/Image/([^/]+)/(\w+)/([0-9]+)"
    return F.when(url.rlike(shape), F.concat_ws("/", *[F.regexp_extract(url, shape, i) for i in (1, 2, 3)])).otherwise(F.trim(url))


#: Labels of report fields.
FIELD_LABELS = {"model_name": "Model Name", "category": "Category", "image_url": "Image URL", "features_summary": "Features Summary", "(fetch)": "Page Fetch"}


def field_label(field: Column) -> Column:
    """A field code as a label; 'specifications[key]' as 'Specification: key'."""
    inner = F.regexp_extract(field, r"(?s)^specifications\[(.*)\]$", 1)
    known = F.create_map(*[F.lit(x) for kv in FIELD_LABELS.items() for x in kv])
    return F.when(field.rlike(r"(?s)^specifications\[.*\]$"), F.concat(F.lit("Specification: "), squeeze(inner))).otherwise(F.coalesce(F.try_element_at(known, field), field))


def shown_lines(value: Column) -> Column:
    """A text's lines, or a list's items, each as a page's text for display, joined by line feeds; blank for null."""
    one = lambda x: F.trim(F.regexp_replace(fix_mojibake(F.coalesce(x, F.lit(""))), r"[\t\x0b\f\r \u00a0]+", " "))
    return F.coalesce(F.array_join(F.transform(value, one), "\n"), F.lit(""))


def shown_map(groups: Column, none: str = "(none found)") -> Column:
    """A map of lists for display: '[key]' and '  - item' lines, keys sorted; `none` for null or empty."""
    entry = lambda e: F.concat(F.array(F.concat(F.lit("["), e["key"], F.lit("]"))), F.transform(e["value"], lambda x: F.concat(F.lit("  - "), x)))
    lines = F.flatten(F.transform(F.array_sort(F.map_entries(groups)), entry))
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n")).otherwise(none)


#: What stands in a report's cell for a value that is not there. Fixed values.
ABSENT = ("(not found on live page)", "(not present in CSV)")


def value_lines(shown: Column) -> Column:
    """The lines of a displayed value that are not blank; none for ABSENT texts and null."""
    return F.when(shown.isin(*ABSENT) | shown.isNull(), F.array().cast("array<string>")).otherwise(F.filter(F.split(shown, "\n"), lambda x: F.trim(x) != ""))


def same_but_lines(a: Column, b: Column) -> Column:
    """Whether two displayed values differ in their line breaks and white space only."""
    flat = lambda c: F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", "")
    return (flat(a) == flat(b)) & ~a.eqNullSafe(b)


def file_label(path: Column) -> Column:
    """The first name of a file, without digits, dashes and underscores at its ends, in upper case."""
    return F.upper(F.regexp_replace(F.regexp_extract(path, r"([^/\\]*?)(?:\.[^./\\]*)?$", 1), "^[-_0-9]+|[-_0-9]+$", ""))


def clipped(col: Column, most: int) -> Column:
    """Text for display: the first `most` characters."""
    return F.substring(col, 1, most)


def parse_list(col: Column) -> Column:
    """A list in a text cell, as JSON or with single quotes; anything else is a list of itself; null and blank are empty. Tokens nan and none are dropped."""
    parsed = F.coalesce(F.from_json(col, "array<string>"), F.transform(F.split(F.regexp_replace(F.trim(col), "^\\[|\\]$", ""), ","), lambda x: F.regexp_replace(F.trim(x), "^['\"]|['\"]$", "")))
    got = F.when(col.isNull() | (F.trim(col) == ""), F.array().cast("array<string>")).when(F.trim(col).startswith("["), parsed).otherwise(F.array(F.trim(col)))
    return F.filter(got, lambda x: x.isNotNull() & (x != "") & ~F.lower(x).isin("nan", "none"))


def strip_query(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, "[?#].*$", ""), "/+$", "")


def no_space(col: Column) -> Column:
    return F.regexp_replace(col, r"\s+", "")
