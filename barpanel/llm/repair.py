"""Conversation structure repair by weighted interval parsing (operator 13).

*Grammar.* A repaired conversation has role initials ``(s?(ua)+)?``. Four states
follow what was written: nothing (0), ``s`` (1), ``u`` (2), ``ua`` (3). The
nonterminal [p q] stands for edits that lead from state p to state q, and the
repair grammar is in Chomsky normal form: [p q] -> [p r][r q] over two adjacent
spans, and lexical rules over one row (keep, rerole, delete). Insertions
consume no row; they enter by their closure, taken once on each side of a row.
A conversation is [0 0] or [0 3] over all of its rows.

*Chart.* A cell holds the least (cost, audit) of a nonterminal over a span, the
audit being the initials of the edits. Two audits of one cell with one cost are
never a beginning of each other (the longer one would hold another insertion),
so the order of audits survives concatenation and least cells build from least
cells. Since states carry all that a span passes on, every split of a span gives
the same cell: spans of 1, 2, 4, ... rows are combined bottom-up, each from its
two halves, instead of from all splits.

*Movement.* That makes the chart a tree, which may be cut anywhere: rows are
range-partitioned by (conversation, turn, role, text), so a conversation that
holds a third of all rows spans many tasks; each task parses its segment, and
segments' cells are combined in order, one row per segment. Equal rows are
counted before any shuffle of the parse. The digest of the repaired rows reads
them in order again, as a stream with the audit ahead, because a hash is
sequential; no task holds a conversation.

Defined cases: null roles and texts are one space; rows with a null ``conv_id``
are one conversation; a null turn sorts first and does not count in ``gaps``;
rows of one turn are ordered by role, then text; repeated rows are duplicates
of each other; a role that starts with none of s, u, a can be reroled or
deleted; texts of any length are read whole; a conversation without rows has
zeros, no edits and the empty text's hash; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barpanel.llm.common import SPACES, schema_of, stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
#: State after an initial is written in a state.
NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
STATES = range(4)
ENDS = (0, 3)
ROLE = {"u": "user", "a": "assistant"}

Cells = dict[tuple[int, int], tuple[int, str]]


# -- the grammar ---------------------------------------------------------------

def _least(cells: Cells, key: tuple[int, int], cost: int, audit: str) -> None:
    if key not in cells or (cost, audit) < cells[key]:
        cells[key] = (cost, audit)


def combine(left: Cells, right: Cells) -> Cells:
    """[p q] -> [p r][r q] for two adjacent spans."""
    out: Cells = {}
    for (p, r), (c1, x) in left.items():
        for q in STATES:
            got = right.get((r, q))
            if got is None:
                continue
            cost, old = c1 + got[0], out.get((p, q))
            if old is None or cost < old[0]:
                out[p, q] = (cost, x + got[1])
            elif cost == old[0] and (audit := x + got[1]) < old[1]:
                out[p, q] = (cost, audit)
    return out


@lru_cache(maxsize=1)
def insertions() -> Cells:
    """The closure of inserted rows, over the empty span."""
    step: Cells = {(p, p): (0, "") for p in STATES}
    for (p, initial), q in NEXT.items():
        if initial in ROLE:
            _least(step, (p, q), INSERT, "I")
    while (more := combine(step, step)) != step:
        step = more
    return step


@lru_cache(maxsize=4096)
def row_cells(initial: str, deleted: bool, truncated: bool) -> Cells:
    """Lexical rules of one row, closed under insertions on both sides.
    ``deleted``: blank and duplicate rows must go."""
    cells: Cells = {(p, p): (DELETE, "D") for p in STATES}
    if not deleted:
        extra = TRUNCATED if truncated else 0
        for (p, written), q in NEXT.items():
            if written == initial:
                _least(cells, (p, q), KEEP + extra, "K")
            elif written in ROLE:
                _least(cells, (p, q), REROLE + extra, "R")
    return combine(combine(insertions(), cells), insertions())


def deleted_cells(n: int) -> Cells:
    """A run of ``n`` rows that must go."""
    run: Cells = {(p, p): (DELETE * n, "D" * n) for p in STATES}
    return combine(combine(insertions(), run), insertions())


class Chart:
    """Spans of 1, 2, 4, ... rows, combined as soon as both halves are there."""

    def __init__(self):
        self.spans: list[tuple[int, Cells]] = []

    def add(self, cells: Cells, level: int = 0) -> None:
        while self.spans and self.spans[-1][0] == level:
            cells = combine(self.spans.pop()[1], cells)
            level += 1
        self.spans.append((level, cells))

    def cells(self) -> Cells:
        out = None
        for _, c in reversed(self.spans):
            out = c if out is None else combine(c, out)
        return insertions() if out is None else out


def best(cells: Cells) -> tuple[int, str]:
    """Least (cost, audit) of a whole conversation."""
    return min(cells[0, q] for q in ENDS if (0, q) in cells)


# -- rows ------------------------------------------------------------------------

def damage(conversations: DataFrame) -> DataFrame:
    """The damaged rows (conv_id, turn, role, text), by crc32(conv_id:turn) % 20: 0
    drops a row, 1 empties its text, 2 takes its ``[.!?]``, 3 repeats it, 4
    makes it the user's. Nulls are one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), space))
    d = conversations.select(
        "conv_id", "turn", F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("fault")).filter("fault != 0")
    text = (F.when(F.col("fault") == 1, F.lit(""))
            .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")))
    return d.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
        .alias("role"), text.alias("text"),
        F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy"),
    ).drop("copy")


#: Key columns that are never null: conversation, then turn (nulls first).
CONV = ["has_id", "conv"]
TURN = ["has_turn", "at"]


def _keys() -> list[Column]:
    zero = F.lit(0).cast("long")
    return [F.col("conv_id").isNotNull().alias("has_id"),
            F.coalesce(F.col("conv_id").cast("long"), zero).alias("conv"),
            F.col("turn").isNotNull().alias("has_turn"),
            F.coalesce(F.col("turn").cast("long"), zero).alias("at")]


def _conv_id() -> Column:
    return F.when(F.col("has_id"), F.col("conv")).alias("conv_id")


def distinct_rows(rows: DataFrame) -> DataFrame:
    """Rows that differ, with their number of ``copies``, the faults of their
    text, and whether an earlier turn has the same role and text."""
    space = F.lit(" ")
    d = rows.select(*_keys(), F.coalesce("role", space).alias("role"),
                    F.coalesce("text", space).alias("text"))
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    length = F.length("role").cast("string")
    d = (d.groupBy(*CONV, *TURN, "role", "text").agg(F.count(F.lit(1)).alias("copies"))
         .withColumn("same", F.sha2(F.concat(length, F.lit(":"), "role", "text"), 256))
         .withColumn("trimmed", trimmed)
         .withColumn("blank", F.col("trimmed") == "")
         .withColumn("cut", ~F.substring("trimmed", -1, 1).isin(".", "!", "?"))
         .drop("trimmed"))
    d = stored(d)
    first = d.groupBy(*CONV, "same").agg(F.min(F.struct(*TURN)).alias("first"))
    return (d.join(first, [*CONV, "same"])
            .withColumn("again", F.struct(*TURN) != F.col("first")).drop("first", "same"))


# -- segments --------------------------------------------------------------------

_SEGMENT = ("has_id boolean,conv long,part long,head string,tail string,n_turns long,low long,"
            "high long,timed boolean,blank long,duplicate long,truncated long,illegal long,"
            "costs array<long>,audits array<string>")
LEGAL = ("su", "ua", "au")


class Segment:
    """What a run of a conversation's rows passes on."""

    def __init__(self):
        self.chart = Chart()
        self.head = self.tail = None
        self.n_turns = self.low = self.high = 0
        self.timed = False
        self.blank = self.duplicate = self.truncated = self.illegal = 0

    def _turns(self, low: int, high: int, n: int) -> None:
        self.n_turns += n - (self.timed and self.high == low)
        self.low = self.low if self.timed else low
        self.high, self.timed = high, True

    def _beside(self, initial: str) -> None:
        if self.tail is not None and self.tail + initial not in LEGAL:
            self.illegal += 1

    def row(self, has_turn, at, role, copies, blank, cut, again) -> None:
        if has_turn:
            self._turns(at, at, 1)
        initial = role[:1]
        self._beside(initial)
        self.head = initial if self.head is None else self.head
        self.tail = initial
        self.illegal += copies - 1  # no role may follow itself
        gone = copies if blank or again else copies - 1
        if blank:
            self.blank += copies
        else:
            self.duplicate += gone
            self.truncated += bool(cut and not again)
        if gone < copies:
            self.chart.add(row_cells(initial, False, bool(cut)))
        if gone == 1:
            self.chart.add(row_cells(initial, True, False))
        elif gone:
            self.chart.add(deleted_cells(gone), gone.bit_length())

    def then(self, s: dict) -> None:
        """Appends a finished segment."""
        if s["timed"]:
            self._turns(s["low"], s["high"], s["n_turns"])
        self._beside(s["head"])
        self.head = s["head"] if self.head is None else self.head
        self.tail = s["tail"]
        for k in ("blank", "duplicate", "truncated", "illegal"):
            setattr(self, k, getattr(self, k) + s[k])
        cells = {(i // 4, i % 4): (c, a) for i, (c, a) in
                 enumerate(zip(s["costs"], s["audits"])) if c >= 0}
        self.chart.add(cells)

    def record(self, has_id: bool, conv: int, part: int) -> dict:
        cells = self.chart.cells()
        at = [cells.get((i // 4, i % 4), (-1, "")) for i in range(16)]
        return dict(has_id=has_id, conv=conv, part=part, head=self.head, tail=self.tail,
                    n_turns=self.n_turns, low=self.low, high=self.high, timed=self.timed,
                    blank=self.blank, duplicate=self.duplicate, truncated=self.truncated,
                    illegal=self.illegal, costs=[c for c, _ in at], audits=[a for _, a in at])


def _out(rows: list[dict], ddl: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema=schema_of(ddl))


def _by_conversation(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[tuple, dict]]:
    for b in batches:
        for r in b.to_pylist():
            yield (r["has_id"], r["conv"]), r


def _folded(batches, step, finish, ddl: str, flush: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Streams sorted rows: ``step(state, row)`` adds to the open conversation
    (state None at its start) and ``finish(key, state)`` gives its row."""
    at, state, rows, size = None, None, [], 0
    for key, r in _by_conversation(batches):
        if key != at:
            if at is not None:
                rows.append(finish(at, state))
                size += 200 + len(rows[-1].get("audit", "")) + sum(map(len, rows[-1].get("audits", ())))
                if size > flush:
                    yield _out(rows, ddl)
                    rows, size = [], 0
            at, state = key, None
        state = step(state, r)
    if at is not None:
        rows.append(finish(at, state))
        yield _out(rows, ddl)


_PARSED = ("has_id boolean,conv long,gaps long,blank long,duplicate long,truncated long,"
           "illegal long,cost long,audit string")


def parse(rows: DataFrame) -> DataFrame:
    """Counts, least cost and audit of each conversation that has rows, from
    :func:`distinct_rows`."""
    order = [*CONV, *TURN, "role", F.substring("text", 1, 32)]

    def segments(batches) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part = TaskContext.get().partitionId()

        def step(s, r):
            s = s or Segment()
            s.row(r["has_turn"], r["at"], r["role"], r["copies"], r["blank"], r["cut"], r["again"])
            return s
        yield from _folded(batches, step, lambda k, s: s.record(*k, part), _SEGMENT)

    def whole(batches) -> Iterator[pa.RecordBatch]:
        def step(s, r):
            s = s or Segment()
            s.then(r)
            return s

        def finish(k, s):
            cost, audit = best(s.chart.cells())
            return dict(has_id=k[0], conv=k[1], gaps=s.high - s.low + 1 - s.n_turns if s.timed else 0,
                        blank=s.blank, duplicate=s.duplicate, truncated=s.truncated,
                        illegal=s.illegal, cost=cost, audit=audit)
        yield from _folded(batches, step, finish, _PARSED)

    cut = (rows.repartitionByRange(*order).sortWithinPartitions(*CONV, *TURN, "role", "text")
           .select(*CONV, *TURN, F.substring("role", 1, 1).alias("role"), "copies", "blank", "cut",
                   "again")
           .mapInArrow(segments, _ddl(_SEGMENT)))
    return (cut.repartition(*CONV).sortWithinPartitions(*CONV, "part")
            .mapInArrow(whole, _ddl(_PARSED)))


def _ddl(flat: str) -> str:
    return flat.replace("long", "bigint")


# -- the repaired rows -------------------------------------------------------------

class Replay:
    """Applies an audit to the rows of its conversation, in order. Where the
    written initials must lead to is known from their number: an odd one starts
    with ``s``."""

    def __init__(self, audit: str):
        self.audit, self.at, self.written = audit, 0, 0
        self.odd = (len(audit) - audit.count("D")) % 2

    def _next(self) -> str:
        return "ua"[(self.written - self.odd) % 2]

    def _inserted(self) -> Iterator[tuple[str, str, str]]:
        while self.audit[self.at:self.at + 1] == "I":
            yield ROLE[self._next()], "", "I"
            self.at += 1
            self.written += 1

    def row(self, role: str, text: str, copies: int) -> Iterator[tuple[str, str, str]]:
        """(role, text, edit) of what is written up to and with this row."""
        for _ in range(copies):
            yield from self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "D":
                continue
            yield (role if edit == "K" else ROLE[self._next()]), text, edit
            self.written += 1

    def end(self) -> Iterator[tuple[str, str, str]]:
        yield from self._inserted()


def _with_audit(rows: DataFrame, parsed: DataFrame) -> DataFrame:
    """Per conversation its audit, then its rows in order, in one partition."""
    r = rows.select(*CONV, F.lit(1).alias("kind"), *TURN, "role", "text", "copies")
    a = parsed.select(*CONV, F.lit(0).alias("kind"), F.lit(False).alias("has_turn"),
                      F.lit(0).cast("long").alias("at"), F.lit("").alias("role"),
                      F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    return (r.unionByName(a).repartition(*CONV)
            .sortWithinPartitions(*CONV, "kind", *TURN, "role", "text"))


def _digests(batches) -> Iterator[pa.RecordBatch]:
    def add(state, written):
        for role, text, _ in written:
            state[1].update((b"\n" if state[2] else b"") + f"{role}:{text}".encode())
            state[2] = True

    def step(state, r):
        if r["kind"] == 0:
            return [Replay(r["text"]), hashlib.sha256(), False]
        add(state, state[0].row(r["role"], r["text"], r["copies"]))
        return state

    def finish(key, state):
        add(state, state[0].end())
        return dict(has_id=key[0], conv=key[1], repaired_sha256=state[1].hexdigest())
    yield from _folded(batches, step, finish, "has_id boolean,conv long,repaired_sha256 string")


def repaired(conversations: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, position (from 0), role, text, edit."""
    rows = stored(distinct_rows(conversations))
    ddl = "has_id boolean,conv long,position long,role string,text string,edit string"

    def run(batches) -> Iterator[pa.RecordBatch]:
        at, state, out, size = None, None, [], 0

        def told(written):
            nonlocal size
            for role, text, edit in written:
                out.append(dict(has_id=at[0], conv=at[1], position=state.written,
                                role=role, text=text, edit=edit))
                size += 100 + len(text)
        for key, r in _by_conversation(batches):
            if key != at:
                if at is not None:
                    told(state.end())
                at = key
            if r["kind"] == 0:
                state = Replay(r["text"])
            else:
                told(state.row(r["role"], r["text"], r["copies"]))
            if size > 4 << 20:
                yield _out(out, ddl)
                out, size = [], 0
        if at is not None:
            told(state.end())
            yield _out(out, ddl)

    return (_with_audit(rows, parse(rows)).mapInArrow(run, _ddl(ddl))
            .select(_conv_id(), "position", "role", "text", "edit"))


def repair(conversations: DataFrame, all_ids: DataFrame | None = None) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit
    and repaired_sha256. ``all_ids`` (a ``conv_id`` column) adds conversations
    that have no rows left."""
    rows = stored(distinct_rows(conversations))
    parsed = stored(parse(rows))
    digest = _with_audit(rows, parsed).mapInArrow(
        _digests, "has_id boolean,conv bigint,repaired_sha256 string")
    got = parsed.join(digest, CONV)
    if all_ids is not None:
        got = all_ids.select(*_keys()[:2]).distinct().join(got, CONV, "left")
    none = hashlib.sha256(b"").hexdigest()
    return got.select(
        _conv_id(), *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in
                      ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"))
