"""Conversation repair: the cheapest edits that make the roles of a conversation alternate.

Method. A weighted CYK parse. The grammar in Chomsky normal form has a symbol for each pair of states of a
sound prefix (empty, after the system turn, after a user turn, after an assistant turn); symbol (p, q)
yields (p, r) (r, q) for any r, and a span of turns has a cell with the least (cost, audit) for each symbol.
A single turn is kept, given the role that fits, or deleted; inserted turns are closed over on both sides
of it. Cells are combined bottom-up by span length. As every symbol splits at every state, all
splits of a span give the same cell, so one split per span suffices: halves of equal length.
(Of two audits of equal cost and equal turns neither begins the other, as the longer one would cost its
further insertions more; so comparing parts compares wholes.)

Spark orders the turns by range partitions, so a conversation of any length is spread over as many
tasks as it needs. Each task parses its stretch of each conversation. Conversations at the border of a
partition, at most two per partition, are put together from the cells of their stretches; all others
are done. Turns that repeat an earlier one are found by aggregation before, and travel as narrow marker
rows to the place of their turn. Texts are shuffled once.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from perimetry.plans.storage import written

_BLANKS = " \t\n\x0b\x0c\r"
_START, _SYSTEM, _USER, _ASSISTANT = range(4)
_STATES = range(4)
_AFTER = {"s": _SYSTEM, "u": _USER, "a": _ASSISTANT}
_STEPS = ((_START, "s"), (_START, "u"), (_SYSTEM, "u"), (_USER, "a"), (_ASSISTANT, "u"))
_SOUND = (_START, _ASSISTANT)  # states in which a conversation may end
_KEEP, _REROLE, _DELETE, _INSERT, _TRUNCATED = 0, 1, 2, 5, 5

Cell = tuple  # per pair of states, row by row: (cost, audit), or None


def combined(a: Cell, b: Cell) -> Cell:
    """The cell of two adjacent spans."""
    found = []
    for p in _STATES:
        for q in _STATES:
            best = None
            for r in _STATES:
                x, y = a[4 * p + r], b[4 * r + q]
                if x and y and (best is None or (x[0] + y[0], x[1] + y[1]) < best):
                    best = (x[0] + y[0], x[1] + y[1])
            found.append(best)
    return tuple(found)


@lru_cache
def empty() -> Cell:
    """The cell of no turn: any insertions."""
    steps = {(p, _AFTER[c]): (_INSERT, "I") for p, c in _STEPS if c != "s"}
    once = tuple((0, "") if p == q else steps.get((p, q)) for p in _STATES for q in _STATES)
    return combined(combined(once, once), once)  # the states are four, so no path needs more


@lru_cache(maxsize=4096)
def turn_cell(initial: str, delete: bool, truncated: bool) -> Cell:
    """The cell of one turn; ``delete``: it must go."""
    extra = _TRUNCATED if truncated else 0
    options: dict[tuple[int, int], list] = {(p, p): [(_DELETE, "D")] for p in _STATES}
    if not delete:
        for p, c in _STEPS:
            own = options.setdefault((p, _AFTER[c]), [])
            if c == initial:
                own.append((_KEEP + extra, "K"))
            if c != "s":
                own.append((_REROLE + extra, "R"))
    turn = tuple(min(options[p, q]) if options.get((p, q)) else None for p in _STATES for q in _STATES)
    return combined(combined(empty(), turn), empty())


class Parse:
    """Cells of a growing span, those of equal length combined as soon as there are two."""

    def __init__(self) -> None:
        self.spans: list[tuple[int, Cell]] = []

    def add(self, cell: Cell) -> None:
        size = 1
        while self.spans and self.spans[-1][0] == size:
            cell = combined(self.spans.pop()[1], cell)
            size *= 2
        self.spans.append((size, cell))

    def whole(self) -> Cell:
        cell = empty()
        for _, part in reversed(self.spans):
            cell = combined(part, cell)
        return cell


def best_of(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    return min(cell[q] for q in _SOUND if cell[q])


def edited(audit: str, turns: list[tuple[str, str]], state: int) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) by an audit, from a state on; deleted turns keep their role."""
    rest = iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rest)
        if edit in "IR":
            role = "assistant" if state == _USER else "user"
        if edit != "D":
            state = _AFTER[role[0]]
        yield edit, role, text


_EDIT = pa.struct([("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
_NUMBERS = ("blank", "duplicate", "truncated", "illegal", "first_turn", "last_turn", "turns_known")
_STRETCH = (
    "part int, border boolean, " + ", ".join(f"{n} bigint" for n in _NUMBERS)
    + ", first_initial string, last_initial string, cost bigint, audit string, costs array<bigint>, audits array<string>,"
    " turns array<struct<edit:string,role:string,text:string>>"
)
_LEGAL = {"su", "ua", "au"}


class _Stretch:
    """The turns of one conversation in one partition."""

    def __init__(self, conv) -> None:
        self.conv, self.parse, self.turns = conv, Parse(), []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns_known = 0
        self.first_turn = self.last_turn = self.first_initial = self.last_initial = None

    def add(self, turn, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.turns:
            self.illegal += self.last_initial + initial not in _LEGAL
        else:
            self.first_initial = initial
        self.last_initial = initial
        if turn is not None and turn != self.last_turn:
            self.turns_known += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        if fault:
            setattr(self, fault, getattr(self, fault) + 1)
        self.parse.add(turn_cell(initial if initial in _AFTER else "", fault in ("blank", "duplicate"), fault == "truncated"))
        self.turns.append((role, text))

    def row(self, part: int, border: bool) -> dict:
        cell = self.parse.whole()
        row = {n: getattr(self, n) for n in (*_NUMBERS, "first_initial", "last_initial")}
        row |= {"conv_id": self.conv, "part": part, "border": border}
        if border:
            row |= {"costs": [c[0] if c else None for c in cell], "audits": [c[1] if c else None for c in cell]}
            edits = [("", *t) for t in self.turns]
        else:
            row["cost"], row["audit"] = best_of(cell)
            edits = edited(row["audit"], self.turns, _START)
        return row | {"turns": [{"edit": e, "role": r, "text": t} for e, r, t in edits]}


def _batches(rows: Iterator[dict], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    part, size = [], 0
    for row in rows:
        part.append(row)
        size += 256 + sum(len(t["text"]) for t in row.get("turns") or ())
        if size > 1 << 23:
            yield pa.RecordBatch.from_pylist(part, schema)
            part, size = [], 0
    if part:
        yield pa.RecordBatch.from_pylist(part, schema)


def _faults(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(_BLANKS))
    return F.when(trimmed == "", "blank").when(~F.substring(trimmed, -1, 1).isin(".", "!", "?"), "truncated").otherwise("")


def stretches(turns: DataFrame) -> DataFrame:
    """One stored row per conversation and partition it lies in; see ``conversations`` and ``edits``.

    ``turns`` has conv_id, turn, role and text. Null roles and texts count as one space. Turns are taken by ``turn``,
    nulls first; ties by role, then by the hash of the text. Repeated rows are turns that repeat an
    earlier one. Rows without ``conv_id`` are one conversation. An empty table gives an empty result; other
    columns are not read, so their names cannot clash. Texts of any length are handled whole.
    """
    blank = F.lit(" ")
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
    ).select("*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2"))
    place = ["conv_id", "turn", "role", "h1", "h2"]
    # places of turns with the role and text of an earlier turn
    known = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    firsts = rows.groupBy("conv_id", "role", "h1", "h2").agg(F.min(known).alias("first"), F.count("*").alias("n")).where("n > 1")
    firsts = written(firsts.drop("n").withColumnRenamed("conv_id", "of"), "firsts")  # stored, so that a hot key can be split
    r, f = rows.select(*place).alias("r"), firsts.alias("f")
    same = F.col("r.conv_id").eqNullSafe(F.col("f.of")) & (F.col("r.role") == F.col("f.role"))
    same &= (F.col("r.h1") == F.col("f.h1")) & (F.col("r.h2") == F.col("f.h2"))
    later = r.join(f, same).where(~F.col("r.turn").eqNullSafe(F.col("f.first.turn"))).select("r.*").distinct()
    marks = later.select(*place, F.lit(None).cast("string").alias("text"), F.lit("").alias("fault"))
    both = rows.select(*place, "text", _faults(F.col("text")).alias("fault")).unionByName(marks)
    ordered = both.repartitionByRange(*place).sortWithinPartitions(*place, "text")  # marks first: nulls
    kind = turns.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        schema: list[pa.Schema] = []

        def rows_of() -> Iterator[dict]:
            stretch, before, marked, first = None, None, None, True
            for batch in batches:
                if not schema:
                    schema.append(_stretch_schema(batch.schema.field("conv_id").type))
                columns = [c.to_pylist() for c in batch.select([*place, "text", "fault"]).columns]
                for conv, turn, role, h1, h2, text, fault in zip(*columns):
                    key = (conv, turn, role, h1, h2)
                    if text is None:
                        marked = key
                        continue
                    if stretch is None or conv != stretch.conv:
                        if stretch is not None:
                            yield stretch.row(part, first)
                            first = False
                        stretch = _Stretch(conv)
                    if fault != "blank" and (key == marked or key == before):
                        fault = "duplicate"
                    before = key
                    stretch.add(turn, role, text, fault)
            if stretch is not None:
                yield stretch.row(part, True)

        found = rows_of()
        head = next(found, None)
        if head is not None:
            yield from _batches((r for rs in ([head], found) for r in rs), schema[0])

    return written(ordered.mapInArrow(run, f"conv_id {kind}, {_STRETCH}"), "stretches")


def _stretch_schema(conv: pa.DataType) -> pa.Schema:
    return pa.schema([
        ("conv_id", conv), ("part", pa.int32()), ("border", pa.bool_()), *[(n, pa.int64()) for n in _NUMBERS],
        ("first_initial", pa.string()), ("last_initial", pa.string()), ("cost", pa.int64()), ("audit", pa.string()),
        ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string())), ("turns", pa.list_(_EDIT)),
    ])


_PLAN = "part int, state int, piece string, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _joined(table: pa.Table) -> pa.Table:
    """The plan of a conversation at borders: per stretch its first state and its piece of the audit, and,
    with the first stretch, the figures of the whole."""
    rows = sorted(table.to_pylist(), key=lambda r: r["part"])
    # per state: cost, audit, and where each stretch begins: (state, length of the audit before it)
    paths: dict[int, tuple] = {_START: (0, "", ())}
    for row in rows:
        options: dict[int, tuple] = {}
        for p, (cost, audit, begins) in paths.items():
            for q in _STATES:
                if row["costs"][4 * p + q] is not None:
                    option = (cost + row["costs"][4 * p + q], audit + row["audits"][4 * p + q], (*begins, (p, len(audit))))
                    if q not in options or option[:2] < options[q][:2]:
                        options[q] = option
        paths = options
    cost, audit, begins = min((paths[q] for q in _SOUND if q in paths), key=lambda x: x[:2])
    total = {n: sum(r[n] for r in rows) for n in ("blank", "duplicate", "truncated", "illegal", "turns_known")}
    for a, b in zip(rows, rows[1:]):
        total["illegal"] += a["last_initial"] + b["first_initial"] not in _LEGAL
        total["turns_known"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
    first = [r["first_turn"] for r in rows if r["first_turn"] is not None]
    last = [r["last_turn"] for r in rows if r["last_turn"] is not None]
    total["gaps"] = last[-1] - first[0] + 1 - total.pop("turns_known") if first else total.pop("turns_known")
    ends = [*[at for _, at in begins[1:]], len(audit)]
    plan = [
        {"conv_id": r["conv_id"], "part": r["part"], "state": state, "piece": audit[at:end]}
        for r, (state, at), end in zip(rows, begins, ends)
    ]
    plan[0] |= total | {"cost": cost, "audit": audit}
    names = ["state", "piece", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    kinds = [pa.int32(), pa.string(), *[pa.int64()] * 6, pa.string()]
    return pa.Table.from_pylist(plan, pa.schema([
        table.schema.field("conv_id"), ("part", pa.int32()), *zip(names, kinds)]))


def _plan(found: DataFrame) -> DataFrame:
    kind = found.schema["conv_id"].dataType.simpleString()
    return found.where("border").drop("turns").groupBy("conv_id").applyInArrow(_joined, f"conv_id {kind}, {_PLAN}")


_FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]


def conversations(found: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of each conversation with turns."""
    gaps = F.coalesce(F.col("last_turn") - F.col("first_turn") + 1 - F.col("turns_known"), F.lit(0))
    whole = found.where("not border").withColumn("gaps", gaps)
    return whole.select("conv_id", *_FIGURES).unionByName(plan.where("audit is not null").select("conv_id", *_FIGURES))


def edits(found: DataFrame, plan: DataFrame) -> DataFrame:
    """(conv_id, part, turns): the turns of the repaired conversation with their edit (K, R, D, I), in order, by stretch."""
    done = found.where("not border").select("conv_id", "part", "turns")
    open_, p = found.where("border").select("conv_id", "part", "turns"), plan.select(F.col("conv_id").alias("of"), F.col("part").alias("at"), "state", "piece")
    joined = open_.join(p, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("part") == F.col("at"))).drop("of", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                own = [(t["role"], t["text"]) for t in row["turns"]]
                turns = [{"edit": e, "role": r, "text": t} for e, r, t in edited(row["piece"], own, row["state"])]
                yield pa.RecordBatch.from_pylist(
                    [{"conv_id": row["conv_id"], "part": row["part"], "turns": turns}],
                    pa.schema([batch.schema.field("conv_id"), ("part", pa.int32()), ("turns", pa.list_(_EDIT))]))

    kind = found.schema["conv_id"].dataType.simpleString()
    return done.unionByName(joined.mapInArrow(run, f"conv_id {kind}, part int, turns array<struct<edit:string,role:string,text:string>>"))


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``conversations`` and ``edits`` of a table of turns; ``stretches`` says how it is read."""
    found = stretches(turns)
    plan = written(_plan(found), "repair-plan")
    return conversations(found, plan), edits(found, plan)


def damaged(turns: DataFrame) -> DataFrame:
    """Turns with faults put in by a checksum of conversation and turn: dropped, emptied, without sentence ends,
    repeated, or given to the user. Nulls count as one space, but a null turn or conversation stays null."""
    blank = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"), F.coalesce(F.col("turn").cast("string"), blank))
    rule = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.coalesce("text", blank)
    rows = turns.select("conv_id", "turn", F.coalesce("role", blank).alias("role"), text.alias("text"), rule.alias("rule"))
    return rows.where("rule != 0").select(
        "conv_id", "turn", F.when(F.col("rule") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("rule") == 1, "").when(F.col("rule") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("rule") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def report(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """Figures and digest of the repaired turns for every ``conv_id`` of ``ids``, with or without turns."""
    figures, changes = repair(turns)
    lines = F.transform(F.filter("turns", lambda t: t["edit"] != "D"), lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    parts = changes.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("part", lines.alias("lines")))).alias("parts"))
    text = F.array_join(F.flatten(F.col("parts.lines")), "\n")
    hashed = parts.select(F.col("conv_id").alias("c2"), F.sha2(text.cast("binary"), 256).alias("sha"))
    figures = figures.withColumnRenamed("conv_id", "c1")
    found = ids.select("conv_id").distinct().join(figures, F.col("conv_id").eqNullSafe(F.col("c1")), "left")
    found = found.join(hashed, F.col("conv_id").eqNullSafe(F.col("c2")), "left")
    numbers = [F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in _FIGURES[:-1]]
    return found.select(
        "conv_id", *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
