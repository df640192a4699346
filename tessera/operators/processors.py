"""Lists of processors out of the processor cells of a specification document.

Lines are read once into tagged text, in which every known word carries the letter of its kind; a rule is a small grammar
over kinds. Rules over several lines look at windows: each line knows how far the run that it opens reaches, and a fold
over the windows takes runs and single lines in turn. The first rule that finds any names counts.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.arrays import let
from tessera.functions.text import generation_words, respelled
from tessera.operators.parts import w_series

#: The keys of processor cells, in the order of their lines.
KEYS = ("CPU", "APU", "Superchip")
_MARKS = "[®™©]"

_NTH = "[0-9]+(?:st|nd|rd|th)?"

# Kinds of words, technical words and output forms that names and lists are compared by.
#: Kinds of words: ordinal, generation, maker, brand, tier, code, suffix.
WORDS = {
    "n": "[0-9]+(?:st|nd|rd|th)",
    "g": "generations?|gen",
    "m": "intel|amd|nvidia|ampere",
    "b": "xeon|core|epyc|ryzen|threadripper|pentium|celeron|athlon|altra|ampereone|grace|hopper",
    "t": "scalable|gold|silver|platinum|max|pro|desktop",
    "c": "[ewd]-[0-9]+|i[0-9]+|[0-9]+wx|[0-9]+",
    "s": "processors?|cpu|gpu|series|family|families",
}
#: Words of lines that describe a processor and do not name it.
TECHNICAL = "tdp|frequency|ghz|cache|watt|setting|default|note|dual processor|single processor"
ASIDES = "not included|optional parts|proper support|enable all functions"
#: Words that are written after two spaces, and the word put at the end of a name without one, by form.
_FORMS = {
    "several": ("xeon|scalable|cpu max series", "processor", "processors"),
    "one": ("intel|amd|core|desktop", "processor", "processors?"),
    "maker": ("intel|amd|xeon|scalable|cpu max series|w-[0-9]+", "processors", "processors"),
    "rebuilt": ("intel|amd|xeon|scalable|cpu max series", "processors", "processors?"),
}
#: Names of a cell that mixes E-series with desktop brands: by how it writes the E-series.
_MIXED = {
    "series": {"core": "{0} Generation  Intel {1} processors", "other": "{0} Generation Intel {1}  processors"},
    "plain": {"core": "{0} Generation Intel {1} Processors", "other": "{0} Generation Intel {1} Processors"},
}
# End of fixed values.

_TAG = "\x01"


def shape(grammar: str) -> str:
    """A grammar as a pattern over tagged text: <b> is any brand, <b:xeon> that one, a space any white space."""
    one = lambda m: _TAG + m[1] + (rf"(?:{m[2]})(?![\w-])" if m[2] else rf"[^\s/,{_TAG}]+")
    return "(?is)" + re.sub(r"<(\w)(?::([^>]+))?>", one, grammar).replace(" ", r"\s+")


def tagged(text: Column) -> Column:
    """Text without marks, every known word led by its kind."""
    c = F.regexp_replace(text, _MARKS, "")
    for kind, words in WORDS.items():
        c = F.regexp_replace(c, rf"(?i)(?<![\w{_TAG}-])({words})(?![\w-])", f"{_TAG}{kind}$1")
    return c


def untagged(text: Column) -> Column:
    return F.regexp_replace(text, f"{_TAG}[a-z]", "")


def found(text: Column, grammar: str) -> Column:
    """All matches of a grammar in tagged text, without tags."""
    return F.transform(F.regexp_extract_all(text, F.lit(shape(grammar)), F.lit(0)), untagged)


def matches(grammar: str) -> Callable[[Column], Column]:
    return lambda x: x.rlike(shape(grammar))


def crossed(firsts: Column, seconds: Column, name: Callable[[Column, Column], Column]) -> Column:
    """The names of each first with each second, firsts outermost."""
    return let(seconds, lambda bs: F.flatten(F.transform(firsts, lambda a: F.transform(bs, lambda b: name(a, b)))))


def spelled(col: Column, *words: str) -> Column:
    """Words in the spelling given, whatever their case is."""
    for w in words:
        col = F.regexp_replace(col, rf"(?i)(?<!\w){w}(?!\w)", w)
    return col


def trimmed(items: Column) -> Column:
    """Items without outer white space, blank ones dropped."""
    return F.filter(F.transform(items, lambda x: F.regexp_replace(x, r"^\s+|\s+$", "")), lambda x: x != "")


def cell_lines(spec: Column, key: str) -> Column:
    """The lines under a key of a JSON text: of a text itself, of a list its items, of an object its values; none without the key or where the JSON is bad."""

    def lines(raw: Column) -> Column:
        items = F.from_json(F.when(raw.startswith("["), raw), "array<string>")
        values = F.map_values(F.from_json(F.when(raw.startswith("{"), raw), "map<string,string>"))
        return F.coalesce(items, values, F.when(raw.isNotNull(), F.array(raw)), F.array().cast("array<string>"))

    return F.filter(let(F.get_json_object(spec, f"$.{key}"), lines), lambda x: x.isNotNull())


def unmarked(lines: Column) -> Column:
    """Lines without marks and outer white space; blank ones stay and count."""
    return F.transform(lines, lambda x: F.regexp_replace(F.regexp_replace(x, _MARKS, ""), r"^\s+|\s+$", ""))


def says(lines: Column, word: str) -> Column:
    """Whether any line holds a text in lower case: a cheap look before lines are tagged."""
    return F.exists(lines, lambda x: F.lower(x).contains(word))


# --- Rules over one line or all lines together --------------------------------------------------------------------


def superchips(lines: Column) -> Column:
    """Grace CPUs and Hopper GPUs, each once, in order of their lines."""
    names = F.flatten(F.transform(lines, lambda x: found(tagged(x), "<m:nvidia> (<b:grace> <s:cpu>|<b:hopper> <s:gpu>)")))
    return F.array_distinct(F.transform(names, lambda x: spelled(x, "NVIDIA", "Grace", "Hopper", "CPU", "GPU")))


def text_rows(cell: Column) -> Column:
    """Names in the lines of one text of several lines, each once: what is built in, up to its first bracket or its kind, and Threadripper series."""
    chip = "<m:amd> <b:ryzen> <b:threadripper>(?: <t:pro>)? <c:[0-9]+>(?: <s:series>)? <s:processors?>"
    kind = r"(?:apu|cpu|processor|graphics\s+core|soc)"

    def name(row: Column) -> Column:
        inside = F.regexp_extract(row, r"(?i)built\s+in\s+(?:with\s+)?an?\s+((?:amd|intel)\b.*)$", 1)
        before = F.regexp_extract(inside, r"^(.*?)\s+\([^)]*\)", 1)
        whole = F.when(before != "", before).otherwise(F.regexp_extract(inside, rf"(?i)^(.*?{kind}(?:\s+[0-9]+)?(?:.*?soc)?)", 1))
        series = respelled(F.get(found(tagged(row), chip), F.lit(0)))
        series = F.regexp_replace(F.regexp_replace(series, r"(?<!series)\s+processor$", " Series Processors"), r"\s+processor$", " Processors")
        return F.when(inside != "", spelled(whole, "AMD", "Intel", "APU", "CPU", "processor")).otherwise(series)

    rows = F.split(F.when(cell.contains("\n") & ~cell.rlike(r"^[\[{]"), cell), "\n")
    return F.array_distinct(F.filter(F.transform(unmarked(rows), name), lambda x: x != ""))


def threadripper(lines: Column) -> Column:
    """The one Threadripper PRO of a cell of one line: with its maker and 'processor' where no mark parts the words, else from 'Ryzen' on."""
    chip = "<b:ryzen> <b:threadripper> <t:pro> <c:[0-9]+wx>"

    def one(line: Column) -> Column:
        made = F.when(~line.rlike(_MARKS), F.get(found(tagged(line), f"<m:amd> {chip}"), F.lit(0)))
        bare = F.get(found(tagged(line), chip), F.lit(0))
        return F.when(made.isNotNull(), F.array(F.concat(made, F.lit(" processor")))).when(bare.isNotNull(), F.array(spelled(bare, "Ryzen", "Threadripper", "PRO")))

    return let(F.when(F.size(lines) == 1, F.get(lines, F.lit(0))), one)


def epyc_and_ryzen(lines: Column) -> Column:
    """The lines of series in a cell of four lines or more that names EPYC and Ryzen series and has a note."""
    aside = f"(?i)({TECHNICAL}|recommend|installing|liquid cooling)"

    def named(plain: Column) -> Column:
        series = lambda brand: F.filter(plain, lambda x: tagged(x).rlike(shape(f"<m:amd> <b:{brand}> <c> <s:series> <s:processors?>")))
        both = (F.size(series("epyc")) > 0) & (F.size(series("ryzen")) > 0) & F.exists(plain, lambda x: F.lower(x).contains("[note]"))
        kept = F.filter(series("epyc|ryzen"), lambda x: ~x.rlike(aside))
        return F.when((F.size(plain) >= 4) & says(plain, "[note]") & both, F.transform(kept, lambda x: spelled(x, "processors")))

    return let(unmarked(lines), named)


def paired_generations(lines: Column) -> Column:
    """'4th and 5th Generation Intel A processors/Intel B processors' as each generation of each kind; sought in a line, then in all lines together."""
    head = "<n> and <n> <g>:? "

    def names(text: Column, cuts: str, kept: Callable[[Column], Column]) -> Column:
        rest = F.regexp_replace(F.regexp_extract(text, shape(head + "(.*)$"), 1), r"(?is)\s+in\s+the\s+[^/]+", "")
        kinds = F.filter(trimmed(F.split(rest, cuts)), kept)
        numbers = F.regexp_extract_all(F.regexp_extract(text, shape(f"({head})"), 1), F.lit(f"{_TAG}n([0-9a-zA-Z]+)"), F.lit(1))
        return crossed(numbers, F.transform(kinds, lambda k: spelled(untagged(F.regexp_replace(k, shape("<s:processors?>"), "processors")), "processors")), lambda n, k: F.concat(n, F.lit(" Generation "), k))

    def paired(text: Column) -> Column:
        one = F.get(F.filter(text, matches(head + "<m:intel|amd>.*<s:processors?>")), F.lit(0))
        every = F.array_join(text, "\n")
        both = lambda x: x.rlike(shape("<m:intel>.*<s:processors?>"))
        alone = let(one, lambda x: names(x, "/", lambda k: F.lit(True)))
        return F.coalesce(alone, let(F.when(every.rlike(shape(head)), every), lambda x: F.when(x.rlike(shape(head + "(?:<m:intel|amd>.*<s:processors?>)")), names(x, "[/\n]", both))))

    return let(F.transform(F.when(says(unmarked(lines), "and"), lines), tagged), paired)


def ampere_one(lines: Column) -> Column:
    """The AmpereOne family's name joined from its lines, two spaces before 'Family'."""

    def named(text: Column) -> Column:
        kept = F.filter(text, lambda x: x.rlike(shape("<b:ampereone>|<s:family|processors?>")) & ~untagged(x).rlike(f"(?i)({TECHNICAL}|up to|custom cores)"))
        name = F.regexp_replace(F.array_join(kept, " "), shape("<s:processors>"), "processor")
        name = F.regexp_replace(name, shape("(<b:ampereone>) (?=<s:family>)"), "$1  ")
        return F.when(name.rlike(shape("<b:ampereone>.*<s:family>")), F.array(generation_words(F.trim(untagged(name)))))

    return let(unmarked(lines), lambda plain: let(F.transform(F.when(says(plain, "ampereone"), plain), lambda x: tagged(F.regexp_replace(x, r"\s+", " "))), named))


def ampere_altra(lines: Column) -> Column:
    """Altra and Altra Max names, words two spaces apart: those written out, else one name joined from the lines that are not technical."""
    aside = f"(?i)({TECHNICAL}|core|technology|pci|memory|installed|function|[0-9]+ *x|up to|only 1 cpu|nm )"

    def named(text: Column) -> Column:
        every = F.array_join(text, " ")
        written = F.transform(found(every, "<m:ampere> <b:altra>(?: <t:max>)? <s:processors?>"), lambda x: F.regexp_replace(F.regexp_replace(x, "(?i)processors$", "processor"), r"\s+", "  "))
        pieces = F.filter(text, lambda x: x.rlike(shape("^(?:(?:<m:ampere>|<b:altra>|<t:max>|or) ?)+$") + f"|(?i){_TAG}(mampere|baltra)") & ~untagged(x).rlike(aside))
        joined = F.regexp_replace(untagged(F.array_join(pieces, "  ")), "(?i)max +or +altra", "Max or Ampere Altra")
        both = every.rlike(shape("<m:ampere>.*<b:altra>"))
        return F.when(both, F.when(F.size(written) > 0, written).otherwise(F.array(F.concat(F.trim(joined), F.lit("  processor")))))

    return let(unmarked(lines), lambda plain: let(F.transform(F.when(says(plain, "altra"), plain), tagged), named))


# --- Rules over runs of lines -------------------------------------------------------------------------------------


def windows(lines: Column, opens: Callable[[Column], Column], stops: Callable[[Column], Column], most: int) -> Column:
    """struct(line, ahead) for each line: the lines after one that opens a run, at most `most`, up to the first that stops it."""

    def ahead(i: Column) -> Column:
        after = F.slice(lines, i + 2, F.lit(most))
        stop = F.array_position(F.transform(after, stops), True)
        return F.when(stop > 0, F.slice(after, F.lit(1), (stop - 1).cast("int"))).otherwise(after)

    return F.transform(lines, lambda x, i: F.struct(x.alias("line"), F.when(opens(x), ahead(i)).alias("ahead")))


def fold_runs(lines: Column, opens, stops, part, most: int, name, single=lambda line, before: F.array(line), rest: bool = False) -> Column:
    """Lines with their runs put together, in one fold from left to right.

    A line that opens a run takes those of its next lines that are parts, and the fold goes on behind the run's window; a
    run without parts and any other line give single(line, line before). With rest, runs come after all single lines.
    """
    empty = F.array().cast("array<string>")
    begin = F.struct(F.lit(0).alias("at"), F.lit(0).alias("next"), empty.alias("names"), empty.alias("runs"), F.lit("").alias("before"))

    def step(s: Column, w: Column) -> Column:
        parts = F.coalesce(F.filter(w["ahead"], part), empty)
        run = F.size(parts) > 0
        skipped = s["at"] < s["next"]
        made = F.when(run, F.array(name(w["line"], parts))).otherwise(single(w["line"], s["before"]))
        to_names = F.when(skipped | (run & F.lit(rest)), empty).otherwise(made)
        to_runs = F.when(~skipped & run & F.lit(rest), made).otherwise(empty)
        return F.struct(
            (s["at"] + 1).alias("at"), F.when(skipped | ~run, s["next"]).otherwise(s["at"] + 1 + F.size(w["ahead"])).alias("next"),
            F.concat(s["names"], to_names).alias("names"), F.concat(s["runs"], to_runs).alias("runs"), w["line"].alias("before"),
        )

    return F.aggregate(windows(lines, opens, stops, most), begin, step, lambda s: F.concat(s["names"], s["runs"]))


def _formed(form: str, squeezed: bool = False):
    """A run's name: its words, two spaces before those that the form names, the form's last word if it has none."""
    wide, last, replaced = _FORMS[form]

    def name(line: Column, parts: Column) -> Column:
        text = F.concat_ws(" ", line, F.array_join(parts, " "))
        text = F.regexp_replace(text, r"\s+", " ") if squeezed else text
        text = F.trim(F.regexp_replace(text, rf"(?i)\s+(?=(?:{wide})\b)", "  "))
        if squeezed:  # one space only between a generation and its maker
            text = F.regexp_replace(text, r"(?i)\s+(?=(?:intel|amd)\b)", " ")
        text = F.regexp_replace(text, rf"(?i)\b{replaced}\b", last)
        ended = text.rlike(r"(?i)processors?\b") | (text.rlike("(?i)cpu max series") & F.lit(form in ("several", "maker")))
        return F.when(ended, text).otherwise(F.concat(text, F.lit(f"  {last}")))

    return name


_GENERATION = r"(?i)[0-9]+(?:st|nd|rd|th)?\s+gen(?:eration)?"
_HEAD = _GENERATION + r"\s+(?:intel|amd)"
_NOISE = f"(?i)({TECHNICAL})"
_NOTICE = "(?i)(carriers|notice|please select)"
_MAKER = "(?i)^(intel|amd)$"
_NAME_PART = "(?i)(xeon|core|scalable|processors?|cpu max|series|desktop)"
_MAKER_PART = r"(?i)(xeon|w-[0-9]+|cpu|max|series)"


def several_generations(lines: Column) -> Column:
    """Two generations or more whose names lie in pieces over several lines, each put together; none where all lines are whole names."""
    either = lambda x: x.rlike(_HEAD) | x.rlike(_MAKER)

    def single(line: Column, before: Column) -> Column:
        ovx = r"(?i)nvidia\s+ovx\s+specifications"
        return F.when(line.rlike(ovx) | (before.rlike(ovx) & ~line.rlike(_HEAD)), F.array().cast("array<string>")).otherwise(F.array(line))

    def put(plain: Column) -> Column:
        # A maker's run ends at the next maker, a generation's at the next generation.
        stops = lambda x: x.rlike(_GENERATION) | x.rlike(_NOISE) | x.rlike(_MAKER) | x.rlike(_NOTICE)
        part = lambda x: x.rlike(_NAME_PART) | x.rlike(_MAKER_PART)
        runs = fold_runs(plain, either, stops, part, 4, _formed("several", squeezed=True), single)
        kept = F.filter(runs, lambda x: ~(x.rlike(_NOISE) | x.rlike(f"(?i)({ASIDES})") | x.rlike(_NOTICE) | x.rlike(r"^\s*\*") | (F.trim(x) == "") | (F.trim(x) == "Xeon")))
        desktop = lambda x: F.when(x.rlike("(?i)core.*desktop.*processor"), F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(x, r"(?i)([0-9]+(?:st|nd|rd|th)?)\s+gen\b", "$1 Generation"), r"(Intel)\s+(Core)", "$1  $2"), r"(Core)\s+(Desktop)", "$1 $2"), r"\bProcessor\b", "processor")).otherwise(x)
        return F.transform(kept, desktop)

    def fits(plain: Column) -> Column:
        heads = F.size(F.filter(plain, lambda x: x.rlike(_GENERATION)))
        whole = (F.size(plain) >= 2) & F.forall(plain, lambda x: F.size(F.split(F.trim(x), r"\s+")) >= 4) & F.exists(plain, lambda x: x.rlike("(?i)(intel|amd).*(xeon|core|ryzen|epyc)"))
        return F.when((heads > 1) & ~whole & ~F.exists(plain, lambda x: x.rlike(r"(?i)support\s+for\s")), put(plain))

    return let(F.filter(unmarked(lines), lambda x: x != ""), fits)


def one_generation(lines: Column) -> Column:
    """One generation, or makers alone, whose names lie in pieces over several lines; technical lines and notices go, stars before names too."""

    def put(plain: Column) -> Column:
        bare = F.transform(plain, lambda x: F.when(x.rlike(r"(?i)^\*.*(intel|amd|xeon|core|ryzen|epyc)"), F.regexp_replace(x, r"^\*\s*", "")).otherwise(x))
        kept = F.filter(bare, lambda x: ~(x.rlike(_NOTICE) | x.rlike(_NOISE) | x.startswith("*")))
        stops = lambda x: x.rlike(_GENERATION) | x.rlike(_MAKER)
        heads = fold_runs(kept, lambda x: x.rlike(_HEAD), stops, lambda x: x.rlike(_NAME_PART), 4, _formed("one"))
        makers = fold_runs(heads, lambda x: x.rlike(_MAKER), stops, lambda x: x.rlike(_MAKER_PART), 4, _formed("maker"))
        return F.filter(makers, lambda x: ~x.rlike(f"(?i)({ASIDES})") & (F.trim(x) != "Xeon") & x.rlike("(?i)(processor|cpu|series)"))

    def fits(plain: Column) -> Column:
        heads = F.size(F.filter(plain, lambda x: x.rlike(_GENERATION)))
        pieces = F.exists(plain, lambda x: x.rlike(rf"{_HEAD}$") | x.rlike(_MAKER))
        return F.when((heads <= 1) & pieces & ~F.exists(plain, lambda x: x.rlike(r"(?i)support\s+for\s")), put(plain))

    return let(F.filter(unmarked(lines), lambda x: x != ""), fits)


def workstation_series(lines: Column) -> Column:
    """The W-series names among those put together, words one space apart, with 'Processors'."""
    any_w = F.exists(lines, lambda x: x.rlike("(?i)w-[0-9]"))
    names = F.filter(one_generation(F.when(any_w, lines)), lambda x: x.rlike("(?i)intel.*xeon.*w-[0-9]+.*processor"))
    return F.transform(names, lambda x: F.regexp_replace(F.regexp_replace(x, r"\s+", " "), r"(?i)\bprocessors?\b", "Processors"))


def complete_names(lines: Column) -> Column:
    """All lines as they are, without marks, where each is a whole name of four words or more; technical ones go."""
    whole = r"(?i)(intel|amd).*(xeon|core|ryzen|epyc|threadripper|grace|hopper).*(processor|cpu|family)"
    aside = "(?i)(tdp|watt|power|socket|cache|threads?|frequency|ghz|note:|if only|pcie|memory|functions|unavailable)"
    every = (F.size(lines) >= 2) & F.forall(lines, lambda x: x.rlike(whole) & (F.size(F.split(F.trim(x), r"\s+")) >= 4))
    return F.when(every, F.filter(unmarked(lines), lambda x: ~x.rlike(aside)))


def mixed_tokens(lines: Column) -> Column:
    """E-series, Core, Pentium and Celeron tokens over eight lines or more: E-series names, then the generation crossed with the desktop brands.

    'Processor E-a/E-b series' gives b first and a after all others; 'E-a Processors' gives a name for each such line.
    """

    def put(text: Column) -> Column:
        every = F.array_join(text, "\n")
        pair = shape("<s:processor> <c:e-[0-9]+>/<c:e-[0-9]+> <s:series>")
        codes = F.regexp_extract_all(F.regexp_extract(every, pair, 0), F.lit(f"(?i){_TAG}c(e-[0-9]+)"), F.lit(1))
        series = every.rlike(shape("<s:processor>[^\n]*<c:e-[0-9]+>[^\n]*<s:series>"))
        line = F.get(F.filter(text, matches("<n:[0-9]+th> <g>")), F.lit(0))
        nth = F.regexp_extract(line, shape(f"{_TAG}n([0-9]+th) <g>"), 1)
        brands = F.when(line.contains("/"), F.transform(found(line, "<b:core>(?: <c:i[0-9]+>)?|<b:pentium>"), lambda b: F.regexp_replace(F.initcap(b), r"\bI(?=[0-9])", "i")))
        brands = F.concat(F.coalesce(brands, F.array().cast("array<string>")), F.array(F.lit("Celeron")))

        def crossed_with(form: dict) -> Column:
            core, other = (form[k].split("{1}") for k in ("core", "other"))
            said = lambda f, b: F.concat(nth, F.lit(f[0].removeprefix("{0}")), b, F.lit(f[1]))
            return F.transform(brands, lambda b: F.when(b.rlike("Core i[0-9]"), said(core, b)).otherwise(said(other, b)))

        first = F.transform(F.slice(codes, 2, 1), lambda c: F.concat(F.lit("Intel Xeon Processor "), c, F.lit(" series")))
        last = F.transform(F.slice(codes, 1, 1), lambda c: F.concat(F.lit("Intel  Xeon  Processor "), c, F.lit(" series")))
        plain = F.transform(found(every, "<c:e-[0-9]+> <s:processors?>"), lambda x: F.concat(F.lit("Intel Xeon "), F.regexp_replace(F.regexp_replace(x, "(?i)processor", "Processor"), r"\s+", " ")))
        return F.when(series, F.concat(first, crossed_with(_MIXED["series"]), last)).otherwise(F.concat(plain, crossed_with(_MIXED["plain"])))

    def fits(text: Column) -> Column:
        kinds = [F.exists(text, matches(g)) for g in ("<c:e-[0-9]+>", "<b:core>.*<c:i[0-9]+>", "<b:pentium>", "<b:celeron>")]
        ok = F.size(text) >= 8
        for k in kinds:
            ok = ok & k
        return F.when(ok, put(text))

    return let(F.transform(F.when((F.size(lines) >= 8) & says(unmarked(lines), "celeron"), lines), tagged), fits)


def assembled_tokens(lines: Column) -> Column:
    """Names of short tokens, where any name is in pieces: words gather until one ends with 'processor' or has over three words; Xeon D rows take their codes
    and suffix from two lines ahead; with a generation among more than three names, runs that it opens come last."""
    known = "(?i)(intel|amd|epyc|xeon|core|ryzen|celeron|pentium|processor|cpu|asic|bridge|nvmeof)"
    aside = "(?i)(tdp|nm|watt|power|socket|cache|threads?)"
    empty = F.array().cast("array<string>")

    def phrases(kept: Column) -> Column:
        begin = F.struct(empty.alias("done"), F.lit("").alias("open"))

        def step(s: Column, x: Column) -> Column:
            open_ = (F.size(F.split(x, r"\s+")) <= 3) & ~F.lower(x).endswith("processor")
            text = F.concat(s["open"], x)
            return F.struct(F.when(open_, s["done"]).otherwise(F.array_append(s["done"], text)).alias("done"), F.when(open_, F.concat(text, F.lit(" "))).otherwise("").alias("open"))

        return F.aggregate(kept, begin, step, lambda s: F.when(F.trim(s["open"]) == "", s["done"]).otherwise(F.array_append(s["done"], F.trim(s["open"]))))

    def xeon_d(names: Column) -> Column:
        def name(line: Column, parts: Column) -> Column:
            text = F.regexp_replace(F.concat_ws(" ", line, F.array_join(parts, " ")), r"\s+", " ")
            return F.when(text.rlike(r"(?i)processor\b"), text).otherwise(F.concat(text, F.lit(" processor")))

        code = r"(?i)intel.*xeon.*d-[0-9]+"
        opens = lambda x: x.rlike(code) & ~x.rlike(rf"{code}.*processor")
        single = lambda x, _: F.when(x.rlike(code), F.array(x)).otherwise(empty)
        return fold_runs(names, opens, lambda x: x.rlike(_NOISE), lambda x: x.rlike("(?i)(d-[0-9]+|processor|families?)"), 2, name, single)

    def rebuilt(names: Column) -> Column:
        opens = lambda x: x.rlike(_GENERATION) & (F.size(F.split(x, r"\s+")) <= 3)
        stops = lambda x: x.rlike(_GENERATION) | x.rlike(r"(?i)processor\s+family\b") | (x.contains(",") & x.rlike(r"(?i)processor\b")) | (x.rlike(r"(?i)processor\b") & (F.size(F.split(x, r"\s+")) > 3))
        return fold_runs(names, opens, stops, lambda x: F.lit(True), 4, _formed("rebuilt"), rest=True)

    def put(names: Column) -> Column:
        d = F.exists(names, lambda x: x.rlike("(?i)intel.*xeon.*d-[0-9]+"))
        runs = (F.size(names) > 3) & F.exists(names, lambda x: x.rlike(_GENERATION))
        return F.when(d, xeon_d(names)).when(runs, rebuilt(names)).otherwise(names)

    def short(plain: Column) -> Column:
        kept = F.filter(plain, lambda x: x.rlike(known) & (~x.rlike(aside) | x.rlike(r"(?i)processor\s+family")))
        pieced = let(kept, lambda tokens: let(let(phrases(tokens), put), lambda names: F.when(F.size(names) < F.size(tokens), names)))
        return F.when(F.forall(plain, lambda x: F.length(x) <= 50), pieced)

    return let(F.filter(unmarked(lines), lambda x: x != ""), short)


# --- Rules over the lines of one item, with what earlier lines said -----------------------------------------------


def _line_fits(lines: Column, shape_: str, names: Callable[[Column], Column]) -> Column:
    """names of the first line that has the shape."""
    return let(F.get(F.filter(lines, lambda x: x.rlike(shape_)), F.lit(0)), lambda x: F.when(x.isNotNull(), names(x)))


def _rows(item: Column) -> Column:
    return trimmed(F.split(F.regexp_replace(item, _MARKS, ""), "\n"))


def lga_socket(lines: Column) -> Column:
    """'LGA1700 socket: Support for the 12th, 13th Generation Intel Core, Pentium Gold and Celeron Processors': each generation with each brand."""

    def names(item: Column) -> Column:
        rows = F.filter(_rows(item), lambda r: r.rlike(r"(?is)support\s+for.*generation.*intel") | r.rlike("(?i)(pentium|celeron|core).*processors?"))
        head = F.get(F.filter(rows, lambda r: r.rlike("(?i)generation")), F.lit(0))
        said = F.regexp_extract(head, r"(?i)support\s+for\s+the\s+([^g]+?)\s+generation", 1)
        numbers = F.array_distinct(F.filter(F.regexp_extract_all(F.when(said == "", head).otherwise(said), F.lit("([0-9]+(?:st|nd|rd|th)?)"), F.lit(1)), lambda n: ~n.rlike("^[0-9]{4}$")))
        brands = F.flatten(F.transform(rows, lambda r: F.regexp_extract_all(F.regexp_replace(r, "(?is)^.*generation", ""), F.lit(r"(?i)\b(core|pentium\s+gold|celeron)\b"), F.lit(1))))
        brands = F.transform(brands, lambda b: F.initcap(F.regexp_replace(b, r"\s+", " ")))
        return crossed(numbers, brands, lambda n, b: F.concat(n, F.lit(" Generation Intel "), b, F.lit(" processor")))

    return _line_fits(lines, r"(?is)lga[0-9]+\s+socket.*support\s+for.*generation.*intel", names)


def lga_package(lines: Column) -> Column:
    """'LGA1700 package: ... 14th Generation Intel Core processors/Pentium processors', row by row: a row without a generation takes the
    last one said before it; Pentium and Celeron rows before any take the last of all."""
    nth = r"(?i)([0-9]+(?:st|nd|rd|th)?)\s+generation"

    def names(item: Column) -> Column:
        begin = F.struct(F.lit("").alias("last"), F.array().cast("array<struct<row:string,generation:string>>").alias("rows"))

        def step(s: Column, row: Column) -> Column:
            own = F.regexp_extract(row, nth, 1)
            last = F.when(own != "", own).otherwise(s["last"])
            named = row.rlike("(?i)intel.*processors?") & ~row.rlike(r"(?i)^support\s+for\s")
            return F.struct(last.alias("last"), F.when(named, F.array_append(s["rows"], F.struct(row.alias("row"), last.alias("generation")))).otherwise(s["rows"]).alias("rows"))

        def written(s: Column) -> Column:
            def row(r: Column) -> Column:
                generation = F.when((r["generation"] == "") & r["row"].rlike("(?i)pentium|celeron"), s["last"]).otherwise(r["generation"])
                clean = F.regexp_replace(F.regexp_replace(r["row"], r"\*$|^-\s*", ""), r"(?i)^(?:lga[0-9]+\s+package:\s*)?(?:support\s*)?", "")
                lead = lambda p: F.when((generation != "") & ~p.rlike(r"(?i)[0-9]+(?:st|nd|rd|th)?\s+generation"), F.concat(generation, F.lit(" Generation "), p)).otherwise(p)
                tidy = lambda p: spelled(F.regexp_replace(lead(F.regexp_replace(p, r"\s+", " ")), r"(?i)\bprocessors?\b", "processors"), "Intel", "Core", "Pentium", "Celeron", "Generation")
                return F.transform(trimmed(F.split(clean, "/")), tidy)

            return F.flatten(F.transform(s["rows"], row))

        return F.aggregate(_rows(item), begin, step, written)

    return _line_fits(lines, r"(?i)lga[0-9]+\s+package", names)


def amd_socket(lines: Column) -> Column:
    """'AMD Socket AM4, support for: 3rd Gen Ryzen processors, Ryzen 2000 / Athlon ...': its items with maker, generation and 'Series'."""

    def names(item: Column) -> Column:
        rows = F.filter(_rows(item), lambda r: r.rlike(r"(?i)amd\s+ryzen.*processors?"))
        items = F.flatten(F.transform(rows, lambda r: trimmed(F.split(F.regexp_replace(F.regexp_replace(r, r"(?i)^amd\s+socket\s+\w+,\s+support\s+for\s*:\s*", ""), r"(?i)^supports\s+", ""), r"[,/]|\sand\s"))))

        def named(x: Column) -> Column:
            x = F.regexp_replace(x, r"\s+", " ")
            made = F.regexp_replace(x, r"(?i)([0-9]+(?:st|nd|rd|th)) gen (?=ryzen)", "$1 Generation AMD ")
            made = F.when(made.rlike("(?i)generation amd|^amd ") | ~x.rlike("(?i)ryzen|^athlon"), made).otherwise(F.concat(F.lit("AMD "), made))
            made = F.regexp_replace(spelled(F.regexp_replace(made, r"(?i)\bprocessors?\b", "processor"), "AMD", "Ryzen", "Athlon"), "(?i)ryzen series ([0-9]+)", "Ryzen $1 Series")
            return F.regexp_replace(made, "(?i)(ryzen [0-9]+)$", "$1 Series")

        return F.transform(items, named)

    return _line_fits(lines, r"(?i)amd\s+socket\s+\w+,\s+support\s+for\s*:", names)


def support_for(lines: Column) -> Column:
    """'Support for' with one generation and its brands, with generations between slashes crossed with names between slashes, or
    with names alone; what a name says about its package goes. A maker is written before names without one."""
    support = r"(?is)support\s+for\s+"
    one, several, bare = rf"{support}({_NTH})\s+generation\s+(intel|amd)\s+(.*)$", rf"{support}({_NTH}\s*/\s*{_NTH})\s+generation(.*)$", rf"{support}(intel|amd)\s+([^\n]*)"
    package = lambda c: F.regexp_replace(F.regexp_replace(c, r"(?is)\s+in\s+the\s.*$", ""), r"\s*\([^)]*\)\s*$", "")
    tidy = lambda c: F.trim(F.regexp_replace(F.regexp_replace(F.regexp_replace(c, _MARKS, ""), r"\s+", " "), r"(?i)\bprocessors\b", "processors"))
    led = lambda maker: lambda x: F.when(x.rlike(r"(?i)^(intel|amd)\s"), x).otherwise(F.concat(F.initcap(maker), F.lit(" "), x))

    def names(item: Column) -> Column:
        said = package(F.regexp_extract(item, one, 3))
        brands = F.regexp_extract_all(said, F.lit(r"(?i)(?:intel\s+)?(?:core\s+)?(?:i[0-9]+|pentium|celeron)\s+processors?"), F.lit(0))
        parts = F.filter(F.split(said, "/"), lambda x: x.rlike("(?i)core|pentium|celeron"))
        single = F.transform(trimmed(F.transform(F.when(F.size(brands) > 0, brands).otherwise(parts), tidy)), led(F.regexp_extract(item, one, 2)))
        single = F.transform(single, lambda x: F.concat(F.regexp_extract(item, one, 1), F.lit(" Generation "), x))
        kinds = F.regexp_extract_all(F.regexp_extract(item, several, 2), F.lit(r"(?i)((?:intel|amd)[^/]+processors?)"), F.lit(1))
        kinds = trimmed(F.transform(kinds, lambda x: tidy(F.regexp_replace(package(x), r"(?s)\n.*$", ""))))
        numbers = F.regexp_extract_all(F.regexp_extract(item, several, 1), F.lit(f"({_NTH})"), F.lit(1))
        alone = F.transform(trimmed(F.transform(F.split(package(F.regexp_extract(item, bare, 2)), "/"), tidy)), led(F.regexp_extract(item, bare, 1)))
        return F.when(item.rlike(one), single).when(item.rlike(several), crossed(numbers, kinds, lambda n, k: F.concat(n, F.lit(" Generation "), k))).when(item.rlike(bare), F.transform(alone, generation_words))

    return _line_fits(lines, f"{one}|{several}|{bare}", names)


def d_series(lines: Column) -> Column:
    """Xeon D names in pieces, of five lines or more: a code takes the nearest Xeon of the four lines before it, the Intel of the two
    before that, and the next line where it says processor; pieces with marks do not count."""
    code, mark = r"(?i)d-[0-9]+", "[®™©]"
    suffix = lambda x: x.rlike("(?i)processor") & ~x.rlike("(?i)(setting|frequency|cores|cache|tdp)")

    def before(plain: Column, i: Column, most: int) -> Column:
        n = F.least(i, F.lit(most))
        return F.reverse(F.slice(plain, i - n + 1, n))

    def name(plain: Column):
        def one(x: Column, i: Column) -> Column:
            back = before(plain, i, 6)
            xeon = F.array_position(F.transform(F.slice(back, 1, 4), lambda b: b.rlike("(?i)xeon") & ~b.rlike(mark)), True).cast("int")
            maker = F.get(F.filter(F.slice(back, F.greatest(xeon, F.lit(1)) + 1, 2), lambda b: b.rlike("(?i)intel") & ~b.rlike(mark)), F.lit(0))
            after = F.get(plain, i + 1)
            text = F.concat_ws(" ", maker, F.get(back, xeon - 1), x, F.when(suffix(after), after))
            text = F.regexp_replace(F.regexp_replace(F.regexp_replace(text, mark, ""), r"(?i)^Default CPU setting:\s*", ""), r"\s+", " ")
            used = (i > 0) & F.coalesce(F.get(plain, i - 1).rlike(code), F.lit(False)) & suffix(x)
            return F.when(x.rlike(code) & (xeon > 0) & maker.isNotNull() & ~used, F.trim(text))

        return F.filter(F.transform(plain, one), lambda x: x.isNotNull())

    def fits(plain: Column) -> Column:
        has = lambda word: F.exists(plain, lambda x: x.rlike(f"(?i){word}"))
        return F.when((F.size(plain) >= 5) & has("d-[0-9]") & has("intel") & has("xeon") & has("processor"), name(plain))

    return let(F.transform(lines, lambda x: F.trim(x)), fits)


#: Rules in their order: each takes the lines of all cells and gives names, or none or null where it does not fit.
RULES: tuple[Callable[[Column], Column], ...] = (
    w_series, mixed_tokens, threadripper, d_series, epyc_and_ryzen, complete_names, paired_generations, several_generations, workstation_series, ampere_one, ampere_altra, lga_socket,
    lga_package, amd_socket, support_for, assembled_tokens,
)


def processor_list(spec: Column, rules: tuple[Callable[[Column], Column], ...] = RULES) -> Column:
    """Processor names of a specification document in JSON, as the first fitting rule finds them; null where none fits, the text is null or its JSON is bad.

    A superchip cell (a text or a list) counts before the rules, then the rows of a CPU cell that is one text of several lines.
    """
    # coalesce() ends at the first rule that fits: later ones are not worked out.
    fits = lambda names: F.coalesce(*(let(n, lambda x: F.when(F.size(x) > 0, x)) for n in names))

    def read(text: Column) -> Column:
        chips = superchips(F.when(~F.get_json_object(text, "$.Superchip").startswith("{"), cell_lines(text, "Superchip")))
        listed = let(F.concat(*(cell_lines(text, k) for k in KEYS)), lambda lines: fits([rule(lines) for rule in rules]))
        return fits([chips, let(F.get_json_object(text, "$.CPU"), text_rows), listed])

    return let(spec, read)
