"""Conversation repair: the cheapest edits that make the roles ``(s?(ua)+)?``.

A row is kept (K, 0), given the role user or assistant (R, 3), or deleted (D, 4); an empty
user or assistant row is inserted anywhere (I, 3).  Blank and duplicate rows must go; a
truncated row that stays costs 3 more.  Of equally cheap edits, the initials that are
least in ASCII order count.

The repair grammar is in Chomsky normal form.  Its nonterminals X(p, q) derive the edited
rows that take the role pattern from state p to state q: X(p, q) -> X(p, r) X(r, q) for
spans, X(p, q) -> row for one row (kept, changed or, with p = q, deleted), and the closure
of insertions, which derives X(p, q) from no row.  A chart cell holds, for each nonterminal
of a span, the least (cost, audit); longer spans combine two neighbouring shorter ones,
bottom-up by span length.  Because X(p, q) has a rule for every r, each split of a span
gives the same cell, so one split per span is enough: spans double in length, and a
conversation of n rows takes n - 1 combinations instead of one for each of n^3/6 splits.
Two audits of one span and cost are never prefixes of each other (the longer would have
more insertions, which cost), so the least audit of a span is part of the least whole.

Faults are found with window functions in one shuffle by conversation; a conversation's
rows pass through one sort, which spills.  Only one character a row is gathered per
conversation (its audit is one value as well), never its texts; equal sequences of a task are
parsed once.  The repaired rows come from a join on (conversation, row), which splits a
long conversation over tasks.

Defined results: null roles and texts count as one blank (so such texts are blank rows);
null turns come first; a null conversation id is a conversation of its own; rows of one
turn are ordered by role and text; equal rows are duplicates; roles other than those with
initials s, u, a must be changed or deleted; texts are read whole; other columns are not
read, so names cannot clash; an empty table gives empty results.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

# --- fixed values -------------------------------------------------------------------
RESET, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: State of the pattern after each role initial: start, after s, after u, after a.
STEPS = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
ACCEPTED = (0, 3)
STATES = (0, 1, 2, 3)
ROLES = {"u": "user", "a": "assistant"}
# ------------------------------------------------------------------------------------
_BLANK = r"\x20\x09-\x0D"

#: A cell: the least (cost, audit) of each nonterminal (p, q) over one span.
Cell = dict[tuple[int, int], tuple[int, str]]


def _least(cells: list[Cell]) -> Cell:
    out: Cell = {}
    for cell in cells:
        for pq, found in cell.items():
            if pq not in out or found < out[pq]:
                out[pq] = found
    return out


def combine(left: Cell, right: Cell) -> Cell:
    """X(p, q) -> X(p, r) X(r, q) over two neighbouring spans."""
    out: Cell = {}
    for (p, r), (cost, audit) in left.items():
        for q in STATES:
            other = right.get((r, q))
            if other:
                found = (cost + other[0], audit + other[1])
                if (p, q) not in out or found < out[p, q]:
                    out[p, q] = found
    return out


def _closure() -> Cell:
    """X(p, q) over no row: any number of insertions."""
    one = _least([{(p, q): (INSERT, "I")} for c in ROLES for p, q in STEPS[c].items()])
    none: Cell = {(p, p): (0, "") for p in STATES}
    out = none
    for _ in STATES:
        out = _least([none, combine(out, one), out])
    return out


CLOSURE = _closure()


def _row(symbol: str) -> Cell:
    """One row: ``x`` must go; else its role initial (``o``: none of the three), in upper
    case when it is truncated."""
    cells: list[Cell] = [{(p, p): (DELETE, "D") for p in STATES}]
    if symbol != "x":
        more = TRUNCATED if symbol.isupper() else 0
        cells.append({pq: (more, "K") for pq in STEPS.get(symbol.lower(), {}).items()})
        cells += [{pq: (RESET + more, "R")} for c in ROLES for pq in STEPS[c].items()]
    return combine(CLOSURE, _least(cells))


SYMBOLS = "xsuaoSUAO"
_ROWS = {s: _row(s) for s in SYMBOLS}


def parse(symbols: str) -> tuple[int, str]:
    """(cost, audit) of the cheapest repair of a conversation."""
    spans = [_ROWS[s] for s in symbols]
    while len(spans) > 1:
        # neighbouring spans of one length make those of twice the length; a last odd one waits
        odd = spans[-1:] if len(spans) % 2 else []
        spans = [combine(a, b) for a, b in zip(spans[::2], spans[1::2])] + odd
    whole = combine(reduce(combine, spans), CLOSURE) if spans else CLOSURE
    return min(whole[0, q] for q in ACCEPTED if (0, q) in whole)


def edits(symbols: str, audit: str) -> list[tuple[int | None, str | None]]:
    """The repaired conversation in order: (row or None if inserted, its new role or None
    if it keeps its own)."""
    out, row, state = [], 0, 0
    for edit in audit:
        if edit == "D":
            row += 1
        elif edit == "K":
            out.append((row, None))
            state, row = STEPS[symbols[row].lower()][state], row + 1
        else:
            initial = next(c for c in ROLES if state in STEPS[c])
            state = STEPS[initial][state]
            out.append((row if edit == "R" else None, ROLES[initial]))
            row += edit == "R"
    return out


def _parsed(batches):
    seen: dict[str, tuple] = {}
    for batch in batches:
        found = []
        for symbols in batch.column("symbols").to_pylist():
            if symbols not in seen:
                if len(seen) > 10_000:
                    seen.clear()
                cost, audit = parse(symbols)
                seen[symbols] = cost, audit, [{"pos": i, "row": r, "role": role}
                                              for i, (r, role) in enumerate(edits(symbols, audit))]
            found.append(seen[symbols])
        cost, audit, made = zip(*found) if found else ((), (), ())
        item = pa.struct([("pos", pa.int64()), ("row", pa.int64()), ("role", pa.string())])
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(cost, pa.int64()), pa.array(audit, pa.string()), pa.array(made, pa.list_(item))],
            names=[*batch.schema.names, "cost", "audit", "made"])


@dataclass
class Repair:
    faults: DataFrame         # one row per row: conv_id, row, turn, role, text, fault, symbol
    conversations: DataFrame  # conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit
    rows: DataFrame           # repaired rows: conv_id, pos, role, text


def find_faults(rows: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) in order, each with its first fault and symbol."""
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    seen = Window.partitionBy("conv_id", "role", "text").orderBy("row")
    initial = F.substring("role", 1, 1)
    df = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                     F.coalesce("text", F.lit(" ")).alias("text"))
    df = df.select("*", (F.row_number().over(order) - 1).cast("long").alias("row"),
                   F.lag(initial).over(order).alias("before"), F.lag("turn").over(order).alias("turn_before"))
    df = df.withColumn("again", F.row_number().over(seen) > 1)
    fault = (F.when(~F.col("text").rlike(f"[^{_BLANK}]"), "blank").when(F.col("again"), "duplicate")
              .when(~F.col("text").rlike(rf"[.!?][{_BLANK}]*\z"), "truncated"))
    df = df.withColumn("fault", fault)
    own = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    symbol = (F.when(F.col("fault").isin("blank", "duplicate"), "x")
               .when(F.col("fault") == "truncated", F.upper(own)).otherwise(own))
    return df.select("conv_id", "row", "turn", "role", "text", "fault", symbol.alias("symbol"),
                     (F.col("before").isNotNull() & ~F.concat("before", initial).isin("su", "ua", "au")).alias("illegal"),
                     (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("new_turn"))


def repair(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
           role_col: str = "role", text_col: str = "text") -> Repair:
    """Find the faults of every conversation and its cheapest repair."""
    rows = conversations.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
                                F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    faults = materialize(find_faults(rows), "conversation-faults")
    count = lambda kind: F.count_if(F.col("fault") == kind).alias(kind)
    per = faults.groupBy("conv_id").agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_if("new_turn"), F.lit(0)).alias("gaps"),
        count("blank"), count("duplicate"), count("truncated"), F.count_if("illegal").alias("illegal"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("row", "symbol"))), lambda x: x.symbol), "")
         .alias("symbols"))
    kind = dict(faults.dtypes)["conv_id"]
    parsed = materialize(per.mapInArrow(
        _parsed, f"conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, symbols string, "
                 "cost long, audit string, made array<struct<pos:long,row:long,role:string>>"), "conversation-repairs")
    made = parsed.select("conv_id", F.explode("made").alias("e")).select(
        "conv_id", "e.pos", "e.row", F.col("e.role").alias("new_role")).alias("m")
    own = faults.select("conv_id", "row", "role", "text").alias("o")
    joined = made.join(own, F.col("m.conv_id").eqNullSafe(F.col("o.conv_id")) & (F.col("m.row") == F.col("o.row")), "left")
    repaired = joined.select("m.conv_id", "pos", F.coalesce("new_role", "o.role").alias("role"),
                             F.coalesce("o.text", F.lit("")).alias("text"))
    return Repair(faults, parsed.drop("symbols", "made"), repaired)


def digests(rows: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256) of ``role:text`` lines; a conversation is one value here."""
    line = F.concat("role", F.lit(":"), "text").alias("line")
    lines = F.transform(F.array_sort(F.collect_list(F.struct("pos", line))), lambda x: x.line)
    return rows.groupBy("conv_id").agg(F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults dealt by crc32 of ``conv_id:turn``:
    of 20 rows, 0 is dropped, 1 emptied, 2 loses its ``[.!?]``, 3 is doubled, 4 gets user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind: Column = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"),
                                kind.alias("kind")).filter(F.col("kind") != 0)
    rows = rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", ""))
         .otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))
    return rows.drop("copy")


def op12_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Faults, cheapest repair and digest of every conversation after the dealt damage."""
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    fixed = repair(damage(conversations))
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    found, text = fixed.conversations, digests(fixed.rows).withColumnRenamed("conv_id", "text_of")
    joined = every.join(found, F.col("id").eqNullSafe(found.conv_id), "left")
    joined = joined.join(text, F.col("id").eqNullSafe(F.col("text_of")), "left")
    zero = [F.coalesce(c, F.lit(0)).cast("long").alias(c)
            for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return joined.select(F.col("id").alias("conv_id"), *zero, F.coalesce("audit", F.lit("")).alias("audit"),
                         F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
