"""Conversation structure repair by weighted CYK parsing over spans.

A conversation is well formed if its roles' initials read ``(s?(ua)+)?``.
Its rows, in order of turn, are mended by edits: (K)eep costs 0, (R)erole to
user or assistant 1, (D)elete 2, (I)nsert an empty user or assistant turn 5;
a truncated row that stays costs 5 more, blank rows and duplicates must go.
The parser finds the cheapest edits, and of equally cheap ones the least
string of their initials (the audit).

The repair grammar is in Chomsky normal form.  Its nonterminals ``N_pq`` are
the row sequences that can be mended to lead the pattern from state p to
state q; the binary rules are ``N_pq -> N_pr N_rq``, a row's own edits are
the terminal rules, and insertions are closed over on both sides of every
span, the empty one included.  A span's cell holds the minimum (cost, audit)
of each nonterminal.  Cells are combined bottom-up by span length: 1, 2, 4,
... rows.  As ``N_pq`` is closed under concatenation, every split of a span
gives the same cell, so one split a span is enough and n rows take O(n)
combinations instead of O(n^3).  (Equally cheap audits of one span never
begin with one another, since they differ in insertions only if they differ
in cost; so least audits of parts make the least audit of the whole.)

Rows are dealt by conversation once, sorted, and streamed: a task holds one
block of ``BLOCK_ROWS`` rows, and per pattern state the best cost, audit and
running digest of what came before.  A conversation's digest and audit are
sequential by definition, so one task streams a conversation, however long,
in bounded memory beside its audit.  ``repaired_turns`` gives the mended rows
themselves, joined by (conversation, row number), so that no task or driver
holds a conversation.

Defined results: a null role or text counts as one space, a null id or turn
as one space in what decides the damage; null turns come first, and rows of
one turn are in order of role and text.  Null ids are one conversation.  A
role other than system, user and assistant can only be reroled or deleted
unless its first letter is s, u or a.  Repeated rows are duplicates.  An
empty table gives no rows; other columns are never read.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.llm.common import small_batches

WHITE_SPACE = " \t\n\x0b\x0c\r"
MARKS = ".!?"
BLOCK_ROWS, BLOCK_CHARS = 1024, 1 << 20
REROLE, DELETE, INSERT, TRUNCATED_STAYS = 1, 2, 5, 5
OK, BLANK, DUPLICATE, TRUNCATED = range(4)  # a row's first fault
#: The pattern's states: nothing yet, after s, after u, after a.
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
NEXT_ROLE = ("user", "user", "assistant", "user")  # that R and I give in each state
ACCEPTING = (0, 3)
STATES = range(4)
RULES = [((p, q), [((p, r), (r, q)) for r in STATES if p <= r or (p, r) == (3, 2)])
         for p in STATES for q in STATES if p <= q or (p, q) == (3, 2)]
LEGAL_PAIRS = {"su", "ua", "au"}
REPORT = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
          "audit string, repaired_sha256 string")


def damaged(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role",
            text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, dropped of the rows after the damage that
    crc32 of ``conv_id:turn`` modulo 20 chooses; rows that it drops stay,
    flagged and without role and text."""
    spaced = lambda c: F.coalesce(c.cast("string"), F.lit(" "))
    ident, at = F.col(conv_id).cast("long"), F.col(turn).cast("long")
    code = F.pmod(F.crc32(F.concat(spaced(ident), F.lit(":"), spaced(at)).cast("binary")), F.lit(20))
    src = conversations.select(ident.alias("conv_id"), at.alias("turn"), spaced(F.col(role)).alias("role"),
                               spaced(F.col(text)).alias("text"), code.alias("code"))
    return src.select(
        "conv_id", "turn",
        F.when(F.col("code") == 4, "user").when(F.col("code") != 0, F.col("role")).alias("role"),
        F.when(F.col("code") == 1, "").when(F.col("code") == 2, F.translate("text", MARKS, ""))
        .when(F.col("code") != 0, F.col("text")).alias("text"),
        (F.col("code") == 0).alias("dropped"),
        F.explode(F.when(F.col("code") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def with_faults(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text, dropped) dealt by conversation,
    with each row's first fault.  One shuffle serves this and the parser."""
    dealt = rows.repartition("conv_id")
    again = Window.partitionBy("conv_id", "dropped", "role", "text").orderBy(F.asc_nulls_first("turn"))
    stripped = F.rtrim("text", F.lit(WHITE_SPACE))
    return (dealt.withColumn("again", F.row_number().over(again) > 1)
            .withColumn("fault", F.when(stripped == "", BLANK).when(F.col("again"), DUPLICATE)
                        .when(F.instr(F.lit(MARKS), F.substring(stripped, -1, 1)) == 0, TRUNCATED).otherwise(OK)))


def combine(left: dict, right: dict) -> dict:
    """The cell of a span from the cells of its two parts."""
    cell = {}
    for pq, splits in RULES:
        best = None
        for pr, rq in splits:
            a, b = left.get(pr), right.get(rq)
            if a is not None and b is not None:
                cost = a[0] + b[0]
                if best is None or cost <= best[0]:
                    found = (cost, a[1] + b[1])
                    if best is None or found < best:
                        best = found
        if best is not None:
            cell[pq] = best
    return cell


def empty_span() -> dict:
    """Insertions alone: the cheapest way from state to state."""
    one = {(p, p): (0, "") for p in STATES}
    for p in STATES:
        one[p, STEP[p, NEXT_ROLE[p][0]]] = (INSERT, "I")
    return combine(one, one)  # no state is more than two insertions from another


EMPTY = empty_span()


@lru_cache(4096)
def row_cell(initial: str, fault: int) -> dict:
    """One row's edits, closed over insertions before and after it."""
    cell = {}
    stay = TRUNCATED_STAYS if fault == TRUNCATED else 0
    for p in STATES:
        edits = [(p, (DELETE, "D"))]
        if fault in (OK, TRUNCATED):
            edits.append((STEP[p, NEXT_ROLE[p][0]], (REROLE + stay, "R")))
            if (p, initial) in STEP:
                edits.append((STEP[p, initial], (stay, "K")))
        for q, found in edits:
            cell[p, q] = min(found, cell.get((p, q), found))
    return combine(combine(EMPTY, cell), EMPTY)


def parse(rows: list[tuple[str, int]]) -> dict:
    """The cell of a whole span of (role initial, fault), bottom-up."""
    cells = [row_cell(*r) for r in rows]
    while len(cells) > 1:  # spans of 1, 2, 4, ... rows
        cells = [combine(*cells[i:i + 2]) if i + 1 < len(cells) else cells[i] for i in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def mended(rows, audit: str, state: int = 0):
    """(state before, role, text) of every row that ``audit`` leaves."""
    at = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(at)
        if edit == "D":
            continue
        if edit != "K":
            role = NEXT_ROLE[state]
        yield state, role, text
        state = STEP[state, role[:1]]


class Conversation:
    """What a task keeps of the conversation that it streams."""

    def __init__(self, ident):
        self.ident = ident
        self.counts = [0, 0, 0, 0]
        self.low = self.high = self.last = self.initial = None
        self.turns = self.illegal = self.chars = 0
        self.block: list[tuple[str, str, int]] = []
        self.prefix = {0: (0, "", hashlib.sha256())}

    def add(self, turn, role, text, fault):
        if turn is not None:
            if turn != self.last:
                self.turns += 1
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
        self.counts[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = role[:1]
        self.block.append((role, text, fault))
        self.chars += len(text)
        if len(self.block) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS:
            self.fold(STATES)

    def fold(self, states) -> tuple | None:
        """Add the block to the best prefixes that end in ``states``."""
        cell = parse([(role[:1], fault) for role, _, fault in self.block])
        chosen = []
        for q in states:
            ways = [(before[0] + cell[p, q][0], before[1] + cell[p, q][1], p)
                    for p, before in self.prefix.items() if (p, q) in cell]
            if ways:
                chosen.append((q, *min(ways)))
        if states is ACCEPTING:
            chosen = [min(chosen, key=lambda c: c[1:3])]
        after = {}
        for q, cost, audit, p in chosen:
            digest = self.prefix[p][2].copy()
            for state, role, text in mended([b[:2] for b in self.block], audit[len(self.prefix[p][1]):], p):
                digest.update(f"{chr(10) if state else ''}{role}:{text}".encode())
            after[q] = (cost, audit, digest)
        self.prefix, self.block, self.chars = after, [], 0

    def report(self) -> tuple:
        self.fold(ACCEPTING)
        (cost, audit, digest), = self.prefix.values()
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (self.ident, gaps, *self.counts[1:], self.illegal, cost, audit, digest.hexdigest())


def _repair(batches):
    names = [c.split()[0] for c in REPORT.split(", ")]
    types = [pa.string() if c.endswith("string") else pa.int64() for c in REPORT.split(", ")]
    pack = lambda rows: pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)
    now, done = None, []
    for batch in batches:
        for ident, turn, role, text, dropped, fault in zip(*(c.to_pylist() for c in batch.columns)):
            if now is None or ident != now.ident:
                if now is not None:
                    done.append(now.report())
                now = Conversation(ident)
            if not dropped:
                now.add(turn, role, text, fault)
        if done:
            yield pack(done)
            done = []
    if now is not None:
        yield pack([now.report()])


def repair(rows: DataFrame) -> DataFrame:
    """One row a conversation (the columns of ``REPORT``) for ``rows`` of
    conv_id, turn, role, text, dropped."""
    small_batches(rows.sparkSession)
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text", "again"]
    return (with_faults(rows).sortWithinPartitions(*order)
            .select("conv_id", "turn", "role", "text", "dropped", "fault").mapInArrow(_repair, REPORT))


def repaired_turns(rows: DataFrame, report: DataFrame | None = None) -> DataFrame:
    """conv_id, position, edit, role, text of every row of the mended
    conversations; an inserted row has an empty text."""
    report = repair(rows) if report is None else report
    along = Window.partitionBy("conv_id").orderBy("at")
    edits = (report.select("conv_id", F.posexplode(F.regexp_extract_all("audit", F.lit("."), F.lit(0))).alias("at", "edit"))
             .withColumn("n", F.sum(F.when(F.col("edit") != "I", 1).otherwise(0)).over(along))
             .withColumn("position", F.sum(F.when(F.col("edit") != "D", 1).otherwise(0)).over(along))
             .filter("edit <> 'D'")
             .withColumn("n", F.when(F.col("edit") != "I", F.col("n"))))
    inside = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    numbered = (rows.filter("NOT dropped").withColumn("n", F.row_number().over(inside))
                .select(F.col("conv_id").alias("of"), F.col("n").alias("row"), F.col("role").alias("had"), "text"))
    both = edits.join(numbered, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("n") == F.col("row")), "left")
    first = F.first("had").over(Window.partitionBy("conv_id").orderBy("position"))
    system = F.when(F.substring(first, 1, 1) == "s", 1).otherwise(0)
    turn_role = F.when(F.pmod(F.col("position") - F.col("lead"), F.lit(2)) == 1, "user").otherwise("assistant")
    return (both.withColumn("lead", F.when(F.first("edit").over(Window.partitionBy("conv_id").orderBy("position")) == "K",
                                           system).otherwise(0))
            .select("conv_id", "position", "edit", F.when(F.col("edit") == "K", F.col("had")).otherwise(turn_role).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text")))
