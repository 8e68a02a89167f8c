"""Conversation structure repair over a suffix-shared automaton (DAWG).

Every row of a conversation has a symbol: its role's initial and its fault. The
row is blank, or repeats the role and text of an earlier row (both have to go),
or is truncated, or has no fault. The symbols in order are the signature of the
conversation, and the cheapest edits depend on nothing else.

Signatures are sorted from their ends, each once. So all that share a suffix lie
side by side, and every suffix is one node of the automaton, built on the node of
the suffix after its first symbol. A node has, for each state of the grammar, the
cost to go and the first edit of the best audit; edits that cost the same are
told apart by their initials alone, as no two edits of a node share one. Nodes of
the signature read last are a stack; the next signature keeps those it shares.
Each node is worked out once for all conversations (once per task at the borders
of tasks), and memory is linear in one signature.

The grammar of role initials is `(s?(ua)+)?`. Keep costs 0, Rerole 1, Delete 2,
Insert of an empty turn 5; a truncated row that stays adds 5. A row of another role,
also of an empty one, fits nowhere as it is. The audit has the
initials of the cheapest edits in order, the ASCII-least of equal ones.

Rows are in the order of turn (nulls first), role, and digest of the text. A null
role or text is one space. Repeated rows are rows; equal rows are counted before
they move. A null conversation id is a conversation of its own. Duplicates are
found by grouping with map-side aggregation, so a text that is said very often
is no hot spot. A signature, an audit and a digest are one value per conversation,
so one task streams the rows of a conversation of any length; signatures move
without texts. Extra columns are left out; empty tables give empty results.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from hashlib import sha256
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareloom.llm.common import written

KEEP, REROLE, DELETE, INSERT = b"K"[0], b"R"[0], b"D"[0], b"I"[0]
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
CUT_COST = 5  # of a truncated row that stays
GONE = "x"  # symbol of a row that has to go
_SPACE = r"\x20\x09-\x0D"

# States of the grammar: nothing yet, after s, after u, after a.
START, SYSTEM, USER, ASSISTANT = range(4)
_ENDS = (START, ASSISTANT)
_TURN = (USER, USER, ASSISTANT, USER)  # where a user or assistant turn leads
_KEPT = {  # where a row with an initial leads, by state
    "s": (SYSTEM, None, None, None),
    "u": (USER, USER, None, USER),
    "a": (None, None, ASSISTANT, None),
}
_NEVER = 1 << 60
_BATCH = 4 << 20


def _row_columns(conversations: DataFrame) -> DataFrame:
    """Rows with their fault signs and digests, without nulls but in ids and turns."""
    known = "copies" in conversations.columns
    rows = conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", F.lit(" ")).alias("role"),
        F.coalesce("text", F.lit(" ")).alias("text"),
        (F.col("copies") if known else F.lit(1)).cast("bigint").alias("copies"),
    )
    return rows.withColumn("print", F.unhex(F.sha2("text", 256)))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows as a faulty export has them, by the checksum of conversation and turn.

    `copies` says how often a row stands there; a dropped row stands there 0 times.
    """
    part = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    key = F.concat(part("conv_id"), F.lit(":"), part("turn")).cast("binary")
    text = part("text")
    rows = conversations.withColumn("__damage", F.crc32(key) % 20)
    kind = F.col("__damage")
    return rows.select(
        "conv_id", "turn",
        F.when(kind == 4, "user").otherwise(part("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", ""))
        .otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


def _marked(rows: DataFrame) -> DataFrame:
    """Equal rows of a turn, counted, with their first fault; texts are left behind."""
    said = F.col("text").rlike(f"[^{_SPACE}]")
    whole = F.col("text").rlike(rf"[.!?][{_SPACE}]*\z")
    cells = rows.select(
        "conv_id", "turn", "role", "print", "copies", (~said).alias("blank"), (~whole).alias("cut")
    )
    cells = cells.groupBy("conv_id", "turn", "role", "print").agg(
        F.sum("copies").alias("copies"), F.min("blank").alias("blank"), F.min("cut").alias("cut")
    )
    first = cells.where("copies > 0 AND NOT blank").groupBy("conv_id", "role", "print")
    first = first.agg(F.min(F.struct("turn")).alias("first"))
    first = first.withColumnsRenamed({"conv_id": "__id", "role": "__role", "print": "__print"})
    same = (
        F.col("conv_id").eqNullSafe(F.col("__id"))
        & (F.col("role") == F.col("__role"))
        & (F.col("print") == F.col("__print"))
    )
    both = cells.join(first, same, "left")
    repeats = ~F.col("turn").eqNullSafe(F.col("first.turn"))
    fault = (
        F.when(F.col("blank"), "blank").when(repeats, "duplicate")
        .when(F.col("cut"), "truncated").otherwise("")
    )
    return both.select("conv_id", "turn", "role", "print", "copies", fault.alias("fault"))


_SUMMARY = {
    "conv_id": pa.int64(),
    "gaps": pa.int64(),
    "blank": pa.int64(),
    "duplicate": pa.int64(),
    "truncated": pa.int64(),
    "illegal": pa.int64(),
    "signature": pa.binary(),
}


class _Reader:
    """What one conversation has: its faults and its signature."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        self.least = self.most = None
        self.turns = self.illegal = 0
        self.before: str | None = None
        self.signature = bytearray()

    def read(self, turn: int | None, initial: str, fault: str, copies: int) -> None:
        if not copies:
            return
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns += turn != self.most
            self.most = turn
        if self.before is not None:
            self.illegal += self.before + initial not in ("su", "ua", "au")
        self.illegal += copies - 1
        self.before = initial
        self.faults[fault] += 1
        self.faults["blank" if fault == "blank" else "duplicate"] += copies - 1
        symbol = initial if initial in _KEPT else "o"
        if fault in ("blank", "duplicate"):
            symbol = GONE
        elif fault:
            symbol = symbol.upper()
        self.signature += (symbol + GONE * (copies - 1)).encode()

    def row(self) -> tuple:
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.turns
        faults = (self.faults[name] for name in ("blank", "duplicate", "truncated"))
        return self.conv_id, gaps, *faults, self.illegal, bytes(self.signature)


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds.values(), strict=True)]
    return pa.RecordBatch.from_arrays(arrays, names=list(kinds))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now, done, size = None, [], 0
    for batch in batches:
        for conv_id, *row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.row())
                    size += 100 + len(now.signature)
                now = _Reader(conv_id)
            now.read(*row)
            if size >= _BATCH:
                yield _batch(done, _SUMMARY)
                done, size = [], 0
    if now is not None:
        yield _batch([*done, now.row()], _SUMMARY)


def _order() -> list[Column]:
    return [F.asc_nulls_first("turn"), F.asc("role"), F.asc("print")]


def signatures(rows: DataFrame) -> DataFrame:
    """Per conversation: gaps, faults, illegal neighbours, and its signature."""
    marked = _marked(rows).repartition("conv_id").sortWithinPartitions("conv_id", *_order())
    read = marked.select("conv_id", "turn", F.substring("role", 1, 1), "fault", "copies")
    return read.mapInArrow(
        _read,
        "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, "
        "illegal bigint, signature binary",
    )


class Automaton:
    """Costs to go and first edits by suffix and state, for signatures in suffix order."""

    def __init__(self):
        self.suffix = b""  # of the nodes on the stack, from its end
        self.costs = array("q", [0 if state in _ENDS else _NEVER for state in range(4)])
        self.edits = bytearray(4)
        self._insert(0)
        self.nodes = 1

    def _insert(self, at: int) -> None:
        """Empty turns before the suffix; two in a row lead back, so one or two do."""
        for state in (USER, ASSISTANT, START, SYSTEM, USER):
            cost = COST[INSERT] + self.costs[at + _TURN[state]]
            if (cost, INSERT) < (self.costs[at + state], self.edits[at + state] or KEEP):
                self.costs[at + state], self.edits[at + state] = cost, INSERT

    def _add(self, symbol: str) -> None:
        at, initial = len(self.edits) - 4, symbol.lower()
        later = self.costs[at : at + 4]
        stays = CUT_COST if symbol != initial else 0
        for state in range(4):
            options = [(COST[DELETE] + later[state], DELETE)]
            if initial != GONE:
                options.append((COST[REROLE] + stays + later[_TURN[state]], REROLE))
                kept = _KEPT[initial][state] if initial in _KEPT else None
                if kept is not None:
                    options.append((stays + later[kept], KEEP))
            cost, edit = min(options)
            self.costs.append(min(cost, _NEVER))
            self.edits.append(edit)
        self._insert(at + 4)
        self.nodes += 1

    def solve(self, signature: bytes) -> tuple[int, bytes]:
        """Cost and audit of the best edits."""
        suffix = signature[::-1]
        shared = sum(1 for _ in takewhile(lambda p: p[0] == p[1], zip(suffix, self.suffix)))
        del self.costs[4 * shared + 4 :], self.edits[4 * shared + 4 :]
        for symbol in suffix[shared:].decode():
            self._add(symbol)
        self.suffix = suffix
        return self.costs[4 * len(suffix)], self._audit(suffix.decode())

    def _audit(self, suffix: str) -> bytes:
        at, state, audit = len(suffix), START, bytearray()
        while at or state not in _ENDS:
            edit = self.edits[4 * at + state]
            audit.append(edit)
            state = moved(state, edit, suffix[at - 1].lower() if at else "")
            at -= edit != INSERT
        return bytes(audit)


def moved(state: int, edit: int, initial: str) -> int:
    """The state that an edit of a row leads to."""
    if edit == DELETE:
        return state
    return _KEPT[initial][state] if edit == KEEP else _TURN[state]


_SOLVED = {"signature": pa.binary(), "cost": pa.int64(), "audit": pa.string()}


def _solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    automaton, done, size = Automaton(), [], 0
    for batch in batches:
        for signature in batch.column("signature").to_pylist():
            cost, audit = automaton.solve(signature)
            done.append((signature, cost, audit.decode()))
            size += 100 + 2 * len(signature)
            if size >= _BATCH:
                yield _batch(done, _SOLVED)
                done, size = [], 0
    if done:
        yield _batch(done, _SOLVED)


def solve(found: DataFrame) -> DataFrame:
    """Cost and audit of each distinct signature."""
    distinct = found.select(F.col("signature")).distinct()
    from_end = F.reverse(F.col("signature").cast("string"))
    placed = distinct.repartitionByRange(from_end).sortWithinPartitions(from_end)
    return placed.mapInArrow(_solve, "signature binary, cost bigint, audit string")


def repair(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A row per conversation (faults, cost, audit), and the repaired rows of all.

    Repaired rows (conv_id, place, role, text) are partitioned by conversation and
    sorted by place. A conversation without rows (`copies` 0) has zeros and no edits.
    """
    rows = _row_columns(conversations)
    found = written(signatures(rows), "repair-signatures")
    audits = found.join(solve(found), "signature").drop("signature")
    audits = written(audits, "repair-audits")
    heads = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("bigint").alias("turn"),
        F.lit("").alias("role"), F.lit(b"").alias("print"), F.lit(1).cast("bigint").alias("copies"),
        F.col("audit").alias("text"),
    )
    there = rows.where("copies > 0").withColumn("kind", F.lit(1))
    both = heads.unionByName(there).repartition("conv_id")
    both = both.sortWithinPartitions("conv_id", "kind", *_order())
    both = both.select("conv_id", "kind", "role", "text", "copies")
    repaired = both.mapInArrow(_repair, "conv_id bigint, place bigint, role string, text string")
    return audits, repaired


_REPAIRED = {"conv_id": pa.int64(), "place": pa.int64(), "role": pa.binary(), "text": pa.binary()}


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits applied; the audit of a conversation comes before its rows."""
    done, size, audit, at, state, place, conv_id = [], 0, "", 0, START, 0, None

    def put(role: bytes, text: bytes) -> None:
        nonlocal place, size
        done.append((conv_id, place, role, text))
        place, size = place + 1, size + 50 + len(text)

    def inserted() -> None:
        """Empty turns up to the next edit of a row."""
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = _TURN[state], at + 1
            put(b"user" if state == USER else b"assistant", b"")

    for batch in batches:
        ids, kinds = batch.column("conv_id").to_pylist(), batch.column("kind").to_pylist()
        copies = batch.column("copies").to_pylist()
        roles = batch.column("role").cast(pa.binary())
        texts = batch.column("text").cast(pa.binary())
        for i, kind in enumerate(kinds):
            if kind == 0:
                audit, at, state, place, conv_id = texts[i].as_py().decode(), 0, START, 0, ids[i]
                inserted()
                continue
            for _ in range(copies[i]):
                edit, role = audit[at], roles[i].as_py()
                state = moved(state, ord(edit), role[:1].decode("latin-1"))
                if edit == "R":
                    role = b"user" if state == USER else b"assistant"
                if edit != "D":
                    put(role, texts[i].as_py())
                at += 1
                inserted()
            if size >= _BATCH:
                yield _texts(done)
                done, size = [], 0
    if done:
        yield _texts(done)


def _texts(done: list[tuple]) -> pa.RecordBatch:
    """Bytes as they came, under the type of texts."""
    batch = _batch(done, _REPAIRED)
    columns = [c.view(pa.string()) if c.type == pa.binary() else c for c in batch.columns]
    return pa.RecordBatch.from_arrays(columns, names=list(_REPAIRED))


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = {"conv_id": pa.int64(), "repaired_sha256": pa.string()}
    now, digest, done = None, None, []
    for batch in batches:
        ids = batch.column("conv_id").to_pylist()
        roles, texts = (batch.column(name).cast(pa.binary()) for name in ("role", "text"))
        for i, conv_id in enumerate(ids):
            if digest is None or conv_id != now:
                if digest is not None:
                    done.append((now, digest.hexdigest()))
                now, digest = conv_id, sha256()
            else:
                digest.update(b"\n")
            digest.update(roles[i].as_py() + b":" + texts[i].as_py())
        if len(done) >= 10_000:
            yield _batch(done, kinds)
            done = []
    if digest is not None:
        yield _batch([*done, (now, digest.hexdigest())], kinds)


def repair_digests(conversations: DataFrame) -> DataFrame:
    """Per conversation: faults, cost, audit and the digest of its repaired rows."""
    audits, repaired = repair(conversations)
    digests = repaired.mapInArrow(_digest, "conv_id bigint, repaired_sha256 string")
    digests = digests.withColumnRenamed("conv_id", "__id")
    both = audits.join(digests, F.col("conv_id").eqNullSafe(F.col("__id")), "left").drop("__id")
    nothing = F.lit(sha256(b"").hexdigest())
    return both.withColumn("repaired_sha256", F.coalesce("repaired_sha256", nothing))
