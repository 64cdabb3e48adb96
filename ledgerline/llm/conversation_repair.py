"""Conversation structure repair as a lightest-derivation search.

A repaired conversation reads ``(system? (user assistant)+)?`` by its role
initials. Rows are kept, given another role, deleted, or preceded by inserted
empty rows. The search is Knuth's generalisation of Dijkstra's algorithm to
weighted deductions. With the states START, SYSTEM, USER, ASSISTANT (what the
output ends in), the rules are::

    [i, q]  row i  |-  [i + 1, r]     an edit of row i that turns q into r
    [i, q]         |-  [i, r]         an inserted row
    [n, q]  end    |-  goal           q is START or ASSISTANT

The value of an item is (cost, audit), compared in this order; the audit is the
string of edit initials. ``row i`` and ``end`` are axioms of the least value
(0, ""). A rule adds its edit's cost and appends its initial. That is superior,
since a cost grows or the audit gets longer, and monotone: two audits of one item
at one cost consume the same rows, so neither is a proper prefix of the other
(all that a suffix could hold are insertions, which cost), and appending a letter
keeps their order. Items therefore leave the agenda with their final value, and
the search ends when the goal does.

Scale. The search needs one character for each row. Rows without their texts are
range-partitioned by their place in the conversation, so a conversation of any
length is spread over tasks and each task searches pieces of at most
``PIECE_ROWS`` rows. A piece that is a whole conversation is searched to the goal.
Pieces of longer conversations are searched from every state; their
(start, end) values are the edits of a second agenda over the conversation's
pieces, a few dozen short rows for 10,000 turns. Texts are moved once, when the
audits are applied to the sorted rows as a stream.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import count

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerline.llm.common import ASCII_SPACE, bound_batches, stage

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
ACCEPTING = (START, ASSISTANT)
#: Where a row of a role initial may follow: initial -> {state before: state after}.
FOLLOWS = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
ROLE_OF = {USER: "user", ASSISTANT: "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
#: Rows of a conversation that are searched at once.
PIECE_ROWS = 512
#: What a row is to the search: its role initial (``o`` for any other), upper case if truncated, ``x`` if it must go.
MUST_GO = "x"

Value = tuple[int, str]
Edge = tuple[int, int, str]


def row_edits(symbol: str) -> dict[int, list[Edge]]:
    """For each state, the edits of a row: (state after, cost, initial)."""
    edges: dict[int, list[Edge]] = {q: [(q, DELETE, "D")] for q in STATES}
    if symbol == MUST_GO:
        return edges
    extra = TRUNCATED if symbol.isupper() else 0
    for q, r in FOLLOWS.get(symbol.lower(), {}).items():
        edges[q].append((r, KEEP + extra, "K"))
    for initial in "ua":
        for q, r in FOLLOWS[initial].items():
            edges[q].append((r, REROLE + extra, "R"))
    return edges


ROW_EDITS = {s: row_edits(s) for s in MUST_GO + "suaoSUAO"}
INSERTIONS = {q: [(r, INSERT, "I") for i in "ua" for p, r in FOLLOWS[i].items() if p == q] for q in STATES}


def lightest(edits: Callable[[int], dict[int, list[Edge]]], n: int, start: int, to_goal: bool) -> dict[int, Value]:
    """Knuth's agenda over items (i, state), from (0, start) to i = n.

    ``edits(i)`` are the ways over row (or piece) i. With ``to_goal`` the search
    ends with the goal, returned under -1; else the values of all (n, state)
    that can be derived are returned by state.
    """
    agenda: list[tuple[int, str, int, int]] = [(0, "", 0, start)]
    final: set[tuple[int, int]] = set()
    ends: dict[int, Value] = {}
    while agenda:
        cost, audit, i, q = heappop(agenda)
        if (i, q) in final:
            continue
        final.add((i, q))
        if i == n:
            if to_goal and q in ACCEPTING:
                # [n, q], end |- goal adds nothing, so the goal is the next to leave the agenda.
                return {-1: (cost, audit)}
            ends[q] = (cost, audit)
        else:
            for r, more, initials in edits(i).get(q, ()):
                if (i + 1, r) not in final:
                    heappush(agenda, (cost + more, audit + initials, i + 1, r))
        for r, more, initial in INSERTIONS[q]:
            if (i, r) not in final:
                heappush(agenda, (cost + more, audit + initial, i, r))
    return ends


@lru_cache(maxsize=1 << 14)
def repair_piece(symbols: str, start: int = START, to_goal: bool = True) -> dict[int, Value]:
    """``lightest`` over rows given by their symbols."""
    return lightest(lambda i: ROW_EDITS[symbols[i]], len(symbols), start, to_goal)


def apply_audit(audit: str, rows: Iterator[tuple[str, str]]) -> Iterator[tuple[str, str, str]]:
    """The repaired rows as (edit, role, text), drawing the conversation's rows as the audit consumes them."""
    state = START
    for edit in audit:
        if edit == "I":
            role, text = None, ""
        else:
            role, text = next(rows)
            if edit == "D":
                continue
        if edit == "K":
            state = FOLLOWS[role[0]][state]
        else:
            state = ASSISTANT if state == USER else USER
            role = ROLE_OF[state]
        yield edit, role, text


# --- On Spark -----------------------------------------------------------------------------------


def _slim(rows: DataFrame) -> DataFrame:
    """Rows without their texts: place in the conversation, role initial and what the text alone says."""
    visible = F.rtrim(F.col("text"), F.lit(ASCII_SPACE))
    return rows.select(
        "conv_id",
        "turn",
        "role",
        _print("role", "text"),
        F.substring("role", 1, 1).alias("initial"),
        (visible == "").alias("blank"),
        (~F.substring(visible, -1, 1).isin(".", "!", "?")).alias("cut"),
    )


def _print(role: str, text: str) -> Column:
    return F.unhex(F.md5(F.concat(F.col(role), F.lit("\0"), F.col(text)).cast("binary"))).alias("print")


PLACE = ["conv_id", "turn", "role", "print"]

PIECES = (
    "conv_id {id}, turn long, role string, print binary, piece long, last_turn long, initial string, "
    "last_initial string, rows long, turns long, min_turn long, max_turn long, blank long, duplicate long, "
    "truncated long, illegal long, cost long, audit string, spans array<struct<q:int,r:int,cost:long,audit:string>>"
)
REPORT = "conv_id {id}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
LEGAL = {"su", "ua", "au"}


class _Piece:
    """Rows of one conversation as they are read in order."""

    def __init__(self, conv_id, whole_so_far: bool, number: int, place: tuple):
        self.conv_id, self.whole, self.number, self.place = conv_id, whole_so_far, number, place
        self.symbols: list[str] = []
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.min_turn = self.max_turn = self.last_turn = None
        self.initial = self.last_initial = None

    def add(self, turn, initial: str, blank: bool, again: bool, cut: bool, new_turn: bool) -> None:
        if turn is not None:
            self.turns += new_turn
            self.min_turn = turn if self.min_turn is None else self.min_turn
            self.max_turn = turn
        if self.symbols:
            self.illegal += self.last_initial + initial not in LEGAL
        else:
            self.initial = initial
        self.last_initial, self.last_turn = initial, turn
        symbol = initial if initial in FOLLOWS else "o"
        if blank or again:
            self.blank += blank
            self.duplicate += not blank
            symbol = MUST_GO
        elif cut:
            self.truncated += 1
            symbol = symbol.upper()
        self.symbols.append(symbol)

    def row(self, ends_here: bool) -> tuple:
        symbols, cost, audit, spans = "".join(self.symbols), None, None, None
        if self.whole and ends_here:
            cost, audit = repair_piece(symbols)[-1]
        else:
            spans = [
                {"q": q, "r": r, "cost": c, "audit": a}
                for q in STATES
                for r, (c, a) in repair_piece(symbols, q, False).items()
            ]
        return (
            self.conv_id, *self.place, self.number, self.last_turn, self.initial, self.last_initial,
            len(symbols), self.turns, self.min_turn, self.max_turn, self.blank, self.duplicate, self.truncated,
            self.illegal, cost, audit, spans,
        )


def _cut_into_pieces(schema: pa.Schema, piece_rows: int):
    """Sorted slim rows of a partition -> its pieces."""

    def pieces(rows: Iterable[tuple]) -> Iterator[tuple]:
        piece, before = None, None
        for conv_id, turn, role, mark, initial, blank, cut, first_turn, repeated in rows:
            same = before is not None and before[0] == conv_id
            if piece is not None and (not same or len(piece.symbols) == piece_rows):
                piece.whole &= not same
                yield piece.row(ends_here=not same)
                piece = _Piece(conv_id, not same, piece.number + 1, (turn, role, mark))
            elif piece is None:
                # The first conversation may have begun in the partition before.
                piece = _Piece(conv_id, False, 0, (turn, role, mark))
            again = repeated and (first_turn != turn or (same and before == (conv_id, turn, role, mark)))
            piece.add(turn, initial, blank, again, cut, not piece.symbols or before[1] != turn)
            before = (conv_id, turn, role, mark)
        if piece is not None:
            # The last one may go on in the partition after.
            yield piece.row(ends_here=False)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

        held: list[tuple] = []
        for row in pieces(rows()):
            held.append(row)
            if len(held) == 1000:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    return run


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema
    )


def _join_pieces(rows: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one conversation -> its report."""
    rows = rows.sort_values(
        ["turn", "role", "print", "piece"], na_position="first", kind="stable", ignore_index=True
    )
    spans = []
    for piece in rows["spans"]:
        edges: dict[int, list[Edge]] = {}
        for s in piece:
            edges.setdefault(s["q"], []).append((s["r"], s["cost"], s["audit"]))
        spans.append(edges)
    cost, audit = lightest(spans.__getitem__, len(spans), START, True)[-1]
    begins, ends = rows["turn"].iloc[1:], rows["last_turn"].iloc[:-1]
    shared = int((begins.to_numpy() == ends.to_numpy()).sum())  # null turns are unequal, and were not counted
    pairs = zip(rows["last_initial"].iloc[:-1], rows["initial"].iloc[1:], strict=True)
    turns = int(rows["turns"].sum()) - shared
    gaps = int(rows["max_turn"].max()) - int(rows["min_turn"].min()) + 1 - turns if turns else 0
    return pd.DataFrame(
        {
            "conv_id": rows["conv_id"].iloc[:1], "gaps": gaps, "blank": int(rows["blank"].sum()),
            "duplicate": int(rows["duplicate"].sum()), "truncated": int(rows["truncated"].sum()),
            "illegal": int(rows["illegal"].sum()) + sum(a + b not in LEGAL for a, b in pairs),
            "cost": cost, "audit": audit,
        }
    )


def repair_report(rows: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """One row per conversation: ``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit``.

    Rows are taken by turn (null turns first), then role, then the MD5 of role
    and text. The first fault of a row counts: ``blank`` (no visible
    character), ``duplicate`` (role and text seen earlier in the conversation),
    ``truncated`` (the last visible character is none of ``.!?``). ``gaps`` is
    max - min + 1 - distinct turns, null turns left out (0 if all are null);
    ``illegal`` counts neighbours whose role initials are not su, ua or au.
    ``cost`` and ``audit`` are those of the cheapest repair, of equal ones that
    with the least audit (bytewise). A null role or text counts as one space. Rows
    with a null ``conv_id`` are one conversation. Other columns are ignored; an
    empty table gives no rows.
    """
    bound_batches(rows.sparkSession)
    rows = _clean(rows)
    slim = _slim(rows)
    seen = (
        slim.groupBy("conv_id", "print")
        .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n"))
        .where("n > 1")
        .select(F.col("conv_id").alias("c"), F.col("print").alias("p"), F.col("first.turn").alias("first_turn"))
    )
    marked = slim.join(
        seen, slim["conv_id"].eqNullSafe(seen["c"]) & (slim["print"] == seen["p"]), "left"
    ).select(*slim.columns, "first_turn", F.col("p").isNotNull().alias("repeated"))
    placed = marked.repartitionByRange(*PLACE).sortWithinPartitions(*PLACE)
    id_type = rows.schema["conv_id"].dataType
    ddl = PIECES.format(id=id_type.simpleString())
    schema = _arrow_schema(ddl)
    pieces = stage(placed.mapInArrow(_cut_into_pieces(schema, piece_rows), ddl), "repair-pieces")
    gaps = F.when(F.col("turns") > 0, F.col("max_turn") - F.col("min_turn") + 1 - F.col("turns")).otherwise(0)
    counts = ["blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    whole = pieces.where(F.col("audit").isNotNull()).select("conv_id", gaps.cast("long").alias("gaps"), *counts)
    parts = pieces.where(F.col("audit").isNull()).groupBy("conv_id").applyInPandas(
        _join_pieces, REPORT.format(id=id_type.simpleString())
    )
    return whole.unionByName(parts)


def _clean(rows: DataFrame) -> DataFrame:
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )


def _arrow_schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _with_audits(rows: DataFrame, report: DataFrame) -> DataFrame:
    """Each conversation's audit, then its rows in order, within one partition; texts are moved once."""
    bound_batches(rows.sparkSession)
    rows = _clean(rows).withColumn("print", _print("role", "text"))
    lines = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", "print", "text")
    audits = report.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit(b"").alias("print"), F.col("audit").alias("text"),
    )
    order = ["conv_id", "kind", "turn", "role", "print"]
    both = audits.unionByName(lines).repartition("conv_id").sortWithinPartitions(*order)
    return both.select("conv_id", "kind", "role", "text")


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[tuple[str, str, str]]]]:
    """(conv_id, its repaired rows) for each conversation of a partition, read as a stream."""

    def stream():
        for batch in batches:
            yield from zip(*(c.to_pylist() for c in batch.columns), strict=True)

    source = stream()

    def rows():
        for _, _, role, text in source:
            yield role, text

    for conv_id, kind, _, audit in source:
        if kind == 1:  # rows that the audit does not reach: of a conversation without a report
            continue
        yield conv_id, apply_audit(audit, rows())


def repaired_turns(rows: DataFrame, report: DataFrame) -> DataFrame:
    """``conv_id, position, edit, role, text``: the rows after the repair that ``report`` states.

    ``edit`` is K (kept), R (given another role) or I (inserted, empty text).
    Deleted rows are left out. See ``repair_report`` for order and nulls.
    """
    ddl = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, position long, edit string, role string, text string"
    schema = _arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for conv_id, repaired in _conversations(batches):
            for position, (edit, role, text) in zip(count(), repaired):
                held.append((conv_id, position, edit, role, text))
                size += len(text) + 32
                if size >= 1 << 20:
                    yield _batch(held, schema)
                    held, size = [], 0
        if held:
            yield _batch(held, schema)

    return _with_audits(rows, report).mapInArrow(run, ddl)


def repaired_digests(rows: DataFrame, report: DataFrame) -> DataFrame:
    """``conv_id, repaired_sha256``: of the repaired ``role:text`` lines, joined by newlines, read as a stream."""
    ddl = f"conv_id {rows.schema['conv_id'].dataType.simpleString()}, repaired_sha256 string"
    schema = _arrow_schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for conv_id, repaired in _conversations(batches):
            digest, between = hashlib.sha256(), b""
            for _, role, text in repaired:
                digest.update(between + f"{role}:{text}".encode())
                between = b"\n"
            held.append((conv_id, digest.hexdigest()))
            if len(held) == 1000:
                yield _batch(held, schema)
                held = []
        if held:
            yield _batch(held, schema)

    return _with_audits(rows, report).mapInArrow(run, ddl)
