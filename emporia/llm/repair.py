"""Conversation repair by weighted generalised LR parsing over a role grammar.

A conversation is a string of role initials.  ``Automaton`` builds LR states from the
grammar; the stack is a graph whose vertices, an LR state above another vertex, all
parses share.  Every row offers weighted actions: keep it, give it another role, delete
it; rows may be inserted anywhere.  Parses that come to the same vertex merge, and the
least (cost, audit) stays, the audit being the initials of the edits so far.

A conversation may hold any share of all rows.  Rows are dealt by ranges of
(conversation, turn), so a large one lies in many tasks.  A task parses its stretch from
every vertex that it may be entered with, and what it finds is a table of (enter, leave,
least cost and audit); the stretches of a conversation are then chained in order.  Only
conversations at the edge of a task need this; the others are complete at once.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporia.llm.scratch import stored

GRAMMAR = [("D", ""), ("D", "sB"), ("D", "B"), ("B", "Bua"), ("B", "ua")]
NAMES = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: From every vertex, two inserted rows and one deleted instead of kept lead to what any
#: other vertex can still become; a parse dearer than another by more is never the best.
SLACK = 2 * INSERT + DELETE
BLANKS = " \t\n\r\x0b\x0c"


class Vertex:
    """An LR state (a set of dotted rules) above another vertex, and the symbol between.
    The automaton makes one of a kind, so equal stacks are the same vertex."""

    __slots__ = ("below", "state", "symbol")

    def __init__(self, state: frozenset[tuple[int, int]], symbol: str, below: Vertex | None):
        self.state, self.symbol, self.below = state, symbol, below


class Automaton:
    """LR(0) states of a grammar, reductions to anything but the goal taken at once."""

    def __init__(self, grammar: list[tuple[str, str]] = GRAMMAR):
        self.rules = grammar
        self.heads = {head for head, _ in grammar}
        self.goal = grammar[0][0]
        self.root = Vertex(self.closed((k, 0) for k, (head, _) in enumerate(grammar) if head == self.goal), "", None)
        self.above: dict[tuple[Vertex, str], Vertex | None] = {}
        self.shifted: dict[tuple[Vertex, str], Vertex | None] = {}

    def closed(self, items: Iterable[tuple[int, int]]) -> frozenset[tuple[int, int]]:
        out, todo = set(), list(items)
        while todo:
            rule, dot = item = todo.pop()
            if item not in out:
                out.add(item)
                body = self.rules[rule][1]
                if dot < len(body) and body[dot] in self.heads:
                    todo += [(k, 0) for k, (head, _) in enumerate(self.rules) if head == body[dot]]
        return frozenset(out)

    def over(self, vertex: Vertex, symbol: str) -> Vertex | None:
        """The vertex of ``symbol`` above ``vertex``, if any rule goes on so."""
        key = (vertex, symbol)
        if key not in self.above:
            items = [(rule, dot + 1) for rule, dot in vertex.state if self.rules[rule][1][dot : dot + 1] == symbol]
            self.above[key] = Vertex(self.closed(items), symbol, vertex) if items else None
        return self.above[key]

    def shift(self, vertex: Vertex, symbol: str) -> Vertex | None:
        """``over``, then reduced as long as a rule other than the goal's is complete."""
        key = (vertex, symbol)
        if key not in self.shifted:
            top = self.over(vertex, symbol)
            while top is not None:
                done = [rule for rule, dot in top.state if dot == len(self.rules[rule][1]) and self.rules[rule][0] != self.goal]
                if not done:
                    break
                head, body = self.rules[done[0]]
                for _ in body:
                    top = top.below
                top = self.over(top, head)
            self.shifted[key] = top
        return self.shifted[key]

    def accepts(self, vertex: Vertex) -> bool:
        return any(dot == len(self.rules[rule][1]) and self.rules[rule][0] == self.goal for rule, dot in vertex.state)

    def name(self, vertex: Vertex) -> str:
        return "" if vertex.below is None else self.name(vertex.below) + vertex.symbol

    def vertices(self, symbols: str = "sua") -> dict[str, Vertex]:
        """All vertices that can be reached, by the symbols on their stack."""
        out, todo = {}, [self.root]
        while todo:
            v = todo.pop()
            if self.name(v) not in out:
                out[self.name(v)] = v
                todo += [w for w in (self.shift(v, c) for c in symbols) if w is not None]
        return out


Best = dict[Vertex, tuple[int, str]]


class Parse:
    """The least (cost, audit) of every live vertex, row after row.  The audit's part on which
    all agree is put aside, so what a row costs does not follow the conversation's length."""

    def __init__(self, lr: Automaton, enter: Vertex | None = None):
        self.lr, self.agreed = lr, []
        self.best: Best = {enter or lr.root: (0, "")}
        self.insert()

    def insert(self) -> None:
        """Rows put in between: cheapest first, until nothing gets better.  Then drop what
        can't be the best any more."""
        best = self.best
        heap = [(*w, k, v) for k, (v, w) in enumerate(best.items())]
        heapq.heapify(heap)
        count = len(heap)
        least = heap[0][0]
        while heap:
            cost, audit, _, v = heapq.heappop(heap)
            if best[v] != (cost, audit) or cost + INSERT > least + SLACK:
                continue
            for c in NAMES:
                w = self.lr.shift(v, c)
                new = (cost + INSERT, audit + "I")
                if w is not None and (w not in best or new < best[w]):
                    best[w] = new
                    count += 1
                    heapq.heappush(heap, (*new, count, w))
        self.best = {v: w for v, w in best.items() if w[0] <= least + SLACK}

    def row(self, initial: str, gone: bool, truncated: bool) -> None:
        """``gone``: the row must be deleted."""
        out: Best = {}
        extra = TRUNCATED if truncated else 0
        for v, (cost, audit) in self.best.items():
            moves = [(v, cost + DELETE, "D")]
            if not gone:
                moves.append((self.lr.shift(v, initial) if initial in ("s", "u", "a") else None, cost + extra, "K"))
                moves += [(self.lr.shift(v, c), cost + REROLE + extra, "R") for c in NAMES]
            for w, new, edit in moves:
                if w is not None and (w not in out or (new, audit + edit) < out[w]):
                    out[w] = (new, audit + edit)
        self.best = out
        self.insert()
        low, high = min(a for _, a in self.best.values()), max(a for _, a in self.best.values())
        if len(low) > 64:
            self.put_aside(low, high)

    def put_aside(self, low: str, high: str) -> None:
        n = next((k for k, (x, y) in enumerate(zip(low, high, strict=False)) if x != y), min(len(low), len(high)))
        if n:
            self.agreed.append(low[:n])
            self.best = {v: (cost, audit[n:]) for v, (cost, audit) in self.best.items()}

    def results(self) -> Iterator[tuple[Vertex, int, str]]:
        agreed = "".join(self.agreed)
        for v, (cost, audit) in self.best.items():
            yield v, cost, agreed + audit


def chained(lr: Automaton, stretches: Iterable[list[dict]]) -> tuple[int, str]:
    """(cost, audit) over stretches in order; each lists enter, leave, cost and audit."""
    vertices = {name: v for name, v in lr.vertices().items()}
    all_rows = Parse(lr)
    all_rows.best = {lr.root: (0, "")}
    for paths in stretches:
        out: Best = {}
        for p in paths:
            before = all_rows.best.get(vertices[p["enter"]])
            if before is not None:
                new = (before[0] + p["cost"], before[1] + p["audit"])
                leave = vertices[p["leave"]]
                if leave not in out or new < out[leave]:
                    out[leave] = new
        least = min(c for c, _ in out.values())
        all_rows.best = {v: w for v, w in out.items() if w[0] <= least + SLACK}
        audits = [a for _, a in all_rows.best.values()]
        all_rows.put_aside(min(audits), max(audits))
    return accepted(all_rows)


def accepted(parse: Parse) -> tuple[int, str]:
    return min((cost, audit) for v, cost, audit in parse.results() if parse.lr.accepts(v))


class Repaired:
    """The repaired rows, edit by edit; all roles follow from the audit."""

    def __init__(self, audit: str):
        self.audit, self.at, self.count = audit, 0, 0

    def role(self) -> str:
        self.count += 1
        return "user" if self.count % 2 else "assistant"

    def inserted(self) -> Iterator[tuple[str, str]]:
        while self.audit[self.at : self.at + 1] == "I":
            self.at += 1
            yield self.role(), ""

    def row(self, role: str, text: str) -> Iterator[tuple[str, str]]:
        """What takes the place of the next row, rows inserted before it included."""
        yield from self.inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "R":
            yield self.role(), text
        elif edit == "K":
            if self.count or role[:1] != "s":
                self.count += 1
            yield role, text


class Digest:
    """SHA-256 of lines joined by a line break."""

    def __init__(self) -> None:
        self.sha, self.begun = hashlib.sha256(), False

    def add(self, rows: Iterable[tuple[str, str]]) -> None:
        for role, text in rows:
            self.sha.update(("\n" if self.begun else "").encode() + f"{role}:{text}".encode("utf-8", "replace"))
            self.begun = True


class Stretch:
    """What a task knows of its rows of one conversation, in order."""

    def __init__(self, lr: Automaton, conv_id: int | None, edge: bool):
        self.conv_id, self.edge = conv_id, edge
        enter = lr.vertices() if edge else {"": lr.root}
        self.parses = {name: Parse(lr, v) for name, v in enter.items()}
        self.counts = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.first = self.last = None
        self.low = self.high = None
        self.turns = 0
        self.rows: list[tuple[str, str, int]] = []

    def add(self, turn: int | None, role: str, text: str, copies: int, again: bool) -> None:
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn
        initial = role[:1]
        if self.last is not None:
            self.counts["illegal"] += self.last + initial not in LEGAL
        else:
            self.first = initial
        self.last = initial
        self.counts["illegal"] += copies - 1
        bare = text.strip(BLANKS)
        for k in range(copies):
            fault = "blank" if not bare else "duplicate" if again or k else "truncated" if bare[-1] not in ".!?" else None
            if fault:
                self.counts[fault] += 1
            for p in self.parses.values():
                p.row(initial, fault in ("blank", "duplicate"), fault == "truncated")
        if not self.edge:
            self.rows.append((role, text, copies))

    def found(self, part: int, edge: bool) -> dict:
        out = {"conv_id": self.conv_id, "part": part, "edge": edge, "low": self.low, "high": self.high, "turns": self.turns, **self.counts, "first": self.first, "last": self.last}
        if edge:
            lr = next(iter(self.parses.values())).lr
            return {**out, "paths": [{"enter": e, "leave": lr.name(v), "cost": c, "audit": a} for e, p in self.parses.items() for v, c, a in p.results()]}
        cost, audit = accepted(self.parses[""])
        repaired, digest = Repaired(audit), Digest()
        for role, text, copies in self.rows:
            for _ in range(copies):
                digest.add(repaired.row(role, text))
        digest.add(repaired.inserted())
        return {**out, "cost": cost, "audit": audit, "sha": digest.sha.hexdigest()}


STRETCH = (
    "conv_id long, part int, edge boolean, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, paths array<struct<enter:string,leave:string,cost:long,audit:string>>, cost long, audit string, sha string"
)
_LONG, _TEXT = pa.int64(), pa.string()
STRETCH_ARROW = pa.schema(
    [("conv_id", _LONG), ("part", pa.int32()), ("edge", pa.bool_()), *((c, _LONG) for c in ("low", "high", "turns", "blank", "duplicate", "truncated", "illegal")), ("first", _TEXT), ("last", _TEXT)]
    + [("paths", pa.list_(pa.struct([("enter", _TEXT), ("leave", _TEXT), ("cost", _LONG), ("audit", _TEXT)]))), ("cost", _LONG), ("audit", _TEXT), ("sha", _TEXT)]
)
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha string"
RESULT_ARROW = pa.schema([(c.split()[0], _TEXT if c.endswith("string") else _LONG) for c in RESULT.split(", ")])


def _rows(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns), strict=True)


def _batches(rows: Iterable[dict], schema: pa.Schema, most: int = 500) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) == most:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Stretches of a task's sorted rows.  Its first conversation may have begun in another
    task, and its last may go on in one."""
    lr, part = Automaton(), TaskContext.get().partitionId()

    def found() -> Iterator[dict]:
        stretch = None
        for conv_id, turn, role, text, copies, again in _rows(batches, ["conv_id", "turn", "role", "text", "copies", "again"]):
            if stretch is None or stretch.conv_id != conv_id:
                if stretch is not None:
                    yield stretch.found(part, stretch.edge)
                stretch = Stretch(lr, conv_id, stretch is None)
            stretch.add(turn, role, text, copies, again)
        if stretch is not None:
            yield stretch.found(part, True)

    return _batches(found(), STRETCH_ARROW)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations from their stretches, sorted by conversation and part."""
    lr, columns = Automaton(), ["conv_id", "low", "high", "turns", "blank", "duplicate", "truncated", "illegal", "first", "last", "paths"]

    def found() -> Iterator[dict]:
        held: dict | None = None
        stretches: list[list[dict]] = []

        def done() -> dict:
            cost, audit = chained(lr, stretches)
            gaps = 0 if held["high"] is None else held["high"] - held["low"] + 1 - held["turns"]
            return {"gaps": gaps, "cost": cost, "audit": audit, **{c: held[c] for c in ("conv_id", "blank", "duplicate", "truncated", "illegal")}}

        for values in _rows(batches, columns):
            r = dict(zip(columns, values, strict=True))
            if held is None or held["conv_id"] != r["conv_id"]:
                if held is not None:
                    yield done()
                held, stretches = r, [r["paths"]]
                continue
            stretches.append(r["paths"])
            r["illegal"] += held["last"] + r["first"] not in LEGAL
            r["turns"] -= r["low"] is not None and r["low"] == held["high"]
            for c in ("turns", "blank", "duplicate", "truncated", "illegal"):
                held[c] += r[c]
            if r["low"] is not None:
                held["low"] = r["low"] if held["low"] is None else held["low"]
                held["high"] = r["high"]
            held["last"] = r["last"]
        if held is not None:
            yield done()

    return _batches(found(), RESULT_ARROW)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each conversation: its audit's row comes first, then its rows in order,
    which are read one by one."""

    def found() -> Iterator[dict]:
        conv_id, repaired, digest = None, None, None
        for own, kind, role, text, copies in _rows(batches, ["conv_id", "kind", "role", "text", "copies"]):
            if kind == 0:
                if repaired is not None:
                    digest.add(repaired.inserted())
                    yield {"conv_id": conv_id, "sha": digest.sha.hexdigest()}
                conv_id, repaired, digest = own, Repaired(text), Digest()
            else:
                for _ in range(copies):
                    digest.add(repaired.row(role, text))
        if repaired is not None:
            digest.add(repaired.inserted())
            yield {"conv_id": conv_id, "sha": digest.sha.hexdigest()}

    return _batches(found(), pa.schema([("conv_id", _LONG), ("sha", _TEXT)]))


def counted(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, again): equal rows as one, counted before they are
    shuffled; ``again``: the conversation has the role and text at an earlier turn (nulls
    are first).  A null role or text is one space."""
    copies = F.col("copies") if "copies" in conversations.columns else F.lit(1)
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        copies.cast("long").alias("copies"),
    )
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
    rows = rows.withColumn("_turn", F.struct(F.col("turn").isNotNull().alias("known"), "turn")).withColumn("_key", F.unhex(F.sha2("text", 256)))
    # Only texts that a conversation repeats meet its rows again.
    many = rows.groupBy("conv_id", "role", "_key").agg(F.min("_turn").alias("_first"), F.count("*").alias("_n")).where("_n > 1")
    many = many.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("_key").alias("_k"), "_first")
    both = rows.join(many, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("_key") == F.col("_k")), "left")
    return both.select("conv_id", "turn", "role", "text", "copies", F.coalesce(F.col("_first") < F.col("_turn"), F.lit(False)).alias("again"))


def repair_conversations(conversations: DataFrame) -> DataFrame:
    """Faults and the cheapest repair of every conversation of ``conversations`` (conv_id,
    turn, role, text; with ``copies``, a row counts so often).

    Rows are taken by turn (nulls first), then role and text.  A row is blank, or a
    duplicate of an earlier one, or truncated (no end mark), or sound; blank ones and
    duplicates must go.  Keeping costs 0, a new role 2, deleting 3, an inserted empty row
    2, and a truncated row that stays 1 more, so that the roles' initials spell
    (s?(ua)+)?.  Returns conv_id, gaps (missing turn numbers between the least and the
    greatest), blank, duplicate, truncated, illegal (neighbours other than su, ua, au),
    cost, audit (K, R, D, I in order; of equal costs the ASCII-least) and sha, the SHA-256
    of the repaired ``role:text`` joined by line breaks.

    A null conv_id is a conversation of its own; a null role or text is one space; roles
    other than by s, u and a can't be kept.  Rows that are equal follow each other and
    all but one are duplicates.  An empty table has no conversations.  Other columns are
    not read.  A digest of one conversation is a chain over its rows, so those of a
    conversation that lies in several tasks are read one by one in a single task; its
    faults and repair are found in all of them.
    """
    rows = stored(counted(conversations), "conversation-rows")
    order = ["conv_id", "turn", "role", "text"]
    ordered = rows.repartitionByRange("conv_id", "turn", "role", F.substring("text", 1, 32)).sortWithinPartitions(*order)
    stretches = stored(ordered.mapInArrow(_parsed, STRETCH), "stretches")
    gaps = F.coalesce(F.col("high") - F.col("low") + 1 - F.col("turns"), F.lit(0)).alias("gaps")
    names = [c.split()[0] for c in RESULT.split(", ")]
    whole = stretches.where("not edge").select("*", gaps).select(*names)
    edges = stretches.where("edge").repartition("conv_id").sortWithinPartitions("conv_id", "part")
    joined = stored(edges.mapInArrow(_joined, RESULT), "edge-conversations")
    ids = joined.select(F.col("conv_id").alias("_c"))
    theirs = rows.join(ids, F.col("conv_id").eqNullSafe(F.col("_c")), "left_semi").select("conv_id", F.lit(1).alias("kind"), "turn", "role", "text", "copies")
    audits = joined.select("conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("copies"))
    digests = theirs.unionByName(audits).repartition("conv_id").sortWithinPartitions("conv_id", "kind", "turn", "role", "text").mapInArrow(_digested, "_c long, _sha string")
    edge_rows = joined.drop("sha").join(digests, F.col("conv_id").eqNullSafe(F.col("_c")), "left").withColumn("sha", F.col("_sha")).select(*names)
    return whole.unionByName(edge_rows)


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` with faults planted by the crc32 of ``conv_id:turn``, modulo 20: 0
    drops the row, 1 empties its text, 2 takes its end marks, 3 repeats it, 4 makes it the
    user's.  A null counts as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"), (F.crc32(key.cast("binary")) % 20).alias("_f"))
    return rows.where("_f <> 0").select(
        "conv_id",
        "turn",
        F.when(F.col("_f") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("_f") == 1, F.lit("")).when(F.col("_f") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_f") == 3, F.lit(2)).otherwise(F.lit(1)).alias("copies"),
    )


def repair_digest(conversations: DataFrame) -> DataFrame:
    """Every conv_id of ``conversations`` with the faults and repair of its damaged rows;
    zeros, an empty audit and the digest of nothing where no row is left."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    found = repair_conversations(damage(conversations)).withColumnRenamed("conv_id", "_c").withColumnRenamed("sha", "_sha")
    both = ids.join(found, F.col("conv_id").eqNullSafe(F.col("_c")), "left")
    counts = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = hashlib.sha256().hexdigest()
    return both.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("_sha", F.lit(nothing)).alias("repaired_sha256"))
