"""Repair of conversation structure at the least cost.

The roles of a repaired conversation read (s?(ua)+)?: an optional system row, then user and assistant in turn. A Viterbi
pass over four states (begin, after system, after user, after assistant) carries the least (cost, audit string) of each
state; each row is kept, given another role or deleted, and its layer is closed by at most two inserted rows.

What the pass needs of a row is one symbol, so it runs on rows without texts that lie in order over range partitions: a
conversation of any length is walked in parts, for each state a part may begin in, and the parts are joined afterwards.
Texts are shuffled once, to write the repaired rows or their digest in order.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import bounded_batches, trimmed

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
#: What a truncated row that stays costs besides.
TRUNCATED_COST = 3
#: States: begin, after system, after user, after assistant; a repaired conversation ends in the first or the last.
STATES, ENDS = "BSUA", "BA"
#: The state after a row of this role initial is kept.
_KEPT = {("B", "s"): "S", ("B", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
#: The state after the row that grammar wants next is made, by a new role or an insertion.
_MADE = {"B": "U", "S": "U", "A": "U", "U": "A"}
LEGAL = ("su", "ua", "au")
#: Symbols of rows: role initial (o: another), in capitals if truncated; x: must be deleted.
_GONE = "x"
WORD = r"[^\x20\x09-\x0D]"
FIGURES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def damage(df: DataFrame) -> DataFrame:
    """Rows of conversations (conv_id, turn, role, text) with planted faults, drawn by crc32 of `conv_id:turn` modulo 20.

    0 drops a row, 1 empties its text, 2 removes full stops, 3 repeats it, 4 makes its role user. Nulls read as one
    space, but a null turn stays null in the column. Other columns are not carried.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")) % 20
    text = F.when(k == 1, "").when(k == 2, F.regexp_replace(said("text"), "[.!?]", "")).otherwise(said("text"))
    copies = F.when(k == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = df.filter(k != 0).select("conv_id", "turn", F.when(k == 4, "user").otherwise(said("role")).alias("role"), text.alias("text"), copies.alias("_copies"))
    return rows.select("conv_id", "turn", "role", "text", F.explode("_copies").alias("_copy")).drop("_copy")


def offer(layer: dict, state: str, cost: int, audit: str) -> None:
    if state not in layer or (cost, audit) < layer[state]:
        layer[state] = cost, audit


def closed(layer: dict) -> dict:
    """The layer after insertions: into U from B, S or A, then into A from U; more would only add to the cost."""
    for state in "BSAU":
        if state in layer:
            cost, audit = layer[state]
            offer(layer, _MADE[state], cost + COST[INSERT], audit + INSERT)
    return layer


def step(layer: dict, symbol: str) -> dict:
    """The closed layer after one more row."""
    out: dict = {}
    kind = symbol.lower()
    more = 0 if symbol == kind else TRUNCATED_COST
    for state, (cost, audit) in layer.items():
        offer(out, state, cost + COST[DELETE], audit + DELETE)
        if kind != _GONE:
            if (state, kind) in _KEPT:
                offer(out, _KEPT[state, kind], cost + COST[KEEP] + more, audit + KEEP)
            offer(out, _MADE[state], cost + COST[REROLE] + more, audit + REROLE)
    return closed(out)


def walk(symbols: str, layer: dict) -> dict:
    """The layer after all symbols. What all audits share is put aside now and then, so that long ones are not copied."""
    shared = []
    for i in range(0, len(symbols), 64):
        for s in symbols[i : i + 64]:
            layer = step(layer, s)
        lead = commonprefix([audit for _, audit in layer.values()])
        shared.append(lead)
        layer = {k: (cost, audit[len(lead) :]) for k, (cost, audit) in layer.items()}
    lead = "".join(shared)
    return {k: (cost, lead + audit) for k, (cost, audit) in layer.items()}


def begin() -> dict:
    return closed({"B": (0, "")})


@lru_cache(maxsize=50_000)
def _short(symbols: str, start: str) -> tuple:
    return tuple(walk(symbols, {start: (0, "")} if start else begin()).items())


def paths(symbols: str, whole: bool) -> list[list]:
    """(start, end, cost, audit) for each state a part may begin in; start is '' where the part begins its conversation."""
    out = []
    for start in [""] if whole else STATES:
        got = _short(symbols, start) if len(symbols) <= 32 else walk(symbols, {start: (0, "")} if start else begin()).items()
        out += [[start, end, cost, audit] for end, (cost, audit) in got]
    return out


def joined(layer: dict, part: list[list]) -> dict:
    """The layer after a part, of the layer before it."""
    out: dict = {}
    for start, end, cost, audit in part:
        if not start:
            offer(out, end, cost, audit)
        elif start in layer:
            offer(out, end, layer[start][0] + cost, layer[start][1] + audit)
    return out


def cheapest(layer: dict) -> tuple[int, str]:
    return min(layer[s] for s in ENDS if s in layer)


class Part:
    """What is known of a run of rows of one conversation."""

    def __init__(self, row: dict, whole: bool):
        self.first, self.whole, self.symbols, self.last = row, whole, [], None
        self.n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0}
        self.turns: list[int | None] = [None, None]

    def add(self, row: dict) -> None:
        copies, initial, n = row["copies"], row["initial"], self.n
        n["illegal"] += copies - 1 + (self.last is not None and self.last + initial not in LEGAL)
        self.last = initial
        if row["turn"] is not None and row["turn"] != self.turns[1]:
            n["turns"] += 1
            self.turns = [row["turn"] if self.turns[0] is None else self.turns[0], row["turn"]]
        if row["blank"]:
            n["blank"] += copies
            self.symbols.append(_GONE * copies)
            return
        n["duplicate"] += copies - row["new"]
        if row["new"]:
            kind = initial if initial in tuple("sua") else "o"
            n["truncated"] += row["cut"]
            self.symbols.append(kind.upper() if row["cut"] else kind)
        self.symbols.append(_GONE * (copies - row["new"]))

    def text(self) -> str:
        return json.dumps({"n": self.n, "turns": self.turns, "initials": [self.first["initial"], self.last], "paths": paths("".join(self.symbols), self.whole)})


def _faults(rows: DataFrame) -> DataFrame:
    """Rows without texts: one for each distinct row, with its copies, whether it is blank or truncated, and whether its
    role and text are new in the conversation."""
    text = F.coalesce("text", F.lit(" "))
    light = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"),
        (~text.rlike(WORD)).alias("blank"), (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    )
    light = light.groupBy("conv_id", "turn", "role", "digest").agg(F.count("*").alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut"))
    when = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    first = light.filter("NOT blank").groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d")).agg(F.min(when).alias("first"))
    same = F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("digest") == F.col("d"))
    new = F.coalesce((F.col("first.turn").eqNullSafe(F.col("turn"))).cast("int"), F.lit(0)).cast("int")
    return light.join(first, same, "left").select("conv_id", "turn", "role", "digest", "copies", "blank", "cut", F.substring("role", 1, 1).alias("initial"), new.alias("new"))


_ORDER = ("conv_id", "turn", "role", "digest")


def _parts(rows: DataFrame, key: str) -> DataFrame:
    """One row for each part of a conversation that lies in one range partition: conv_id, first row, part as JSON."""
    spark = rows.sparkSession
    pieces = _faults(rows).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *_ORDER).sortWithinPartitions(*_ORDER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, whole = None, False
        for b in batches:
            out = []
            for row in b.to_pylist():
                if part is None or row["conv_id"] != part.first["conv_id"]:
                    if part:
                        out.append(part)
                        whole = True  # a conversation after another one in the partition begins here
                    part = Part(row, whole)
                part.add(row)
            if out:
                yield batch(out)
        if part:
            yield batch([part])

    def batch(parts: list[Part]) -> pa.RecordBatch:
        kind = pa.schema([("conv_id", kinds), ("turn", pa.int64()), ("role", pa.string()), ("digest", pa.binary()), ("part", pa.string())])
        return pa.RecordBatch.from_pylist([{**{c: p.first[c] for c in _ORDER}, "part": p.text()} for p in parts], schema=kind)

    from pyspark.sql.pandas.types import to_arrow_type

    kinds = to_arrow_type(rows.schema["conv_id"].dataType)
    return pieces.mapInArrow(trimmed(run), f"conv_id {key}, turn bigint, role string, digest binary, part string")


class Conversation:
    """One conversation as it comes by: its parts first, then its rows in order."""

    def __init__(self, key):
        self.key, self.layer, self.audit, self.cost = key, begin(), None, 0
        self.n = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
        self.turns, self.initial = [None, None], None
        self.at, self.made, self.sha = 0, 0, hashlib.sha256()

    def part(self, p: dict) -> None:
        for k, v in p["n"].items():
            self.n[k] += v
        if self.initial is not None:
            self.n["illegal"] += self.initial + p["initials"][0] not in LEGAL
        self.initial = p["initials"][1]
        low, high = p["turns"]
        if low is not None:
            self.n["turns"] -= low == self.turns[1]
            self.turns = [low if self.turns[0] is None else self.turns[0], high]
        self.layer = joined(self.layer, p["paths"])

    def settle(self) -> None:
        if self.audit is None:
            self.cost, self.audit = cheapest(self.layer)
            self.system = sum(map(self.audit.count, (KEEP, REROLE, INSERT))) % 2

    def _write(self, role: str, text: str) -> tuple:
        self.sha.update((("\n" if self.made else "") + f"{role}:{text}").encode())
        self.made += 1
        return self.made - 1, role, text

    def _wanted(self) -> str:
        return "assistant" if (self.made - self.system) % 2 else "user"

    def inserted(self) -> Iterator[tuple]:
        self.settle()
        while self.audit[self.at : self.at + 1] == INSERT:
            self.at += 1
            yield self._write(self._wanted(), "")

    def row(self, role: str, text: str) -> Iterator[tuple]:
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit != DELETE:
            yield self._write(role if edit == KEEP else self._wanted(), text)

    def figures(self) -> tuple:
        self.settle()
        gaps = self.turns[1] - self.turns[0] + 1 - self.n["turns"] if self.n["turns"] else 0
        return (self.key, gaps, *(self.n[k] for k in FIGURES[1:5]), self.cost, self.audit, self.sha.hexdigest())


def repair(rows: DataFrame, conversations: DataFrame | None = None, output: str = "figures") -> DataFrame:
    """Repair conversations of rows (conv_id, turn, role, text), taken by turn, then role and sha256 of the text.

    output="figures": one row for each conversation of rows, and of conversations (conv_id) without rows: gaps, blank,
    duplicate, truncated, illegal, cost (longs), audit, repaired_sha256 (of `role:text` joined by line feeds).
    output="rows": the repaired rows: conv_id, position (from 0), role, text.

    Null roles and texts are one space, null turns come first, a null conv_id is a conversation of its own. Repeated rows
    are duplicates after the first. Empty tables give no rows, other columns are not read. The digest of a conversation is
    that of its whole text in order, so its rows pass one task as a sorted stream of which one row is held at a time;
    every other step cuts long conversations over partitions.
    """
    spark = rows.sparkSession
    bounded_batches(spark)
    key = rows.schema["conv_id"].dataType.simpleString()
    text = F.coalesce("text", F.lit(" "))
    nothing = lambda kind: F.lit(None).cast(kind)
    parts = _parts(rows, key).select("conv_id", F.lit(1).alias("step"), "turn", "role", "digest", nothing("string").alias("text"), "part")
    all_rows = rows.select(
        "conv_id", F.lit(2).alias("step"), F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"),
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("digest"), text.alias("text"), nothing("string").alias("part"),
    )
    stream = parts.unionByName(all_rows)
    if conversations is not None:
        marks = conversations.select("conv_id").distinct()
        stream = stream.unionByName(marks.select("conv_id", F.lit(0).alias("step"), *(nothing(stream.schema[c].dataType).alias(c) for c in stream.columns[2:])))
    number = int(spark.conf.get("spark.sql.shuffle.partitions"))
    stream = stream.repartition(number, "conv_id").sortWithinPartitions("conv_id", "step", "turn", "role", "digest").select("conv_id", "step", "role", "text", "part")
    figures = output == "figures"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, out = None, []

        def ended() -> None:
            made = list(now.inserted())
            out.extend([now.figures()] if figures else [(now.key, *m) for m in made])

        for b in batches:
            for conv, step_, role, t, part in zip(*(c.to_pylist() for c in b.columns)):
                if now is None or conv != now.key:
                    if now:
                        ended()
                    now = Conversation(conv)
                if step_ == 1:
                    now.part(json.loads(part))
                elif step_ == 2:
                    made = list(now.row(role, t))
                    if not figures:
                        out.extend((conv, *m) for m in made)
            if out:
                yield batch(out)
                out.clear()
        if now:
            ended()
            if out:
                yield batch(out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    after = ", ".join(f"{f} bigint" for f in FIGURES) + ", audit string, repaired_sha256 string" if figures else "position bigint, role string, text string"
    ddl = f"conv_id {key}, {after}"
    schema = to_arrow_schema(_parse_datatype_string(ddl))

    def batch(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), schema)], schema=schema)

    return stream.mapInArrow(trimmed(run), ddl)
