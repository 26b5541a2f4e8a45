"""Conversation structure repair by Hirschberg's divide and conquer.

A conversation is sound if its roles' initials read ``(s?(ua)+)?``: nothing, or an
optional system turn followed by pairs of user and assistant turns. Faults of a row (the
first that holds counts): blank, a duplicate of an earlier row's role and text, or
truncated (its last character that is no white space is not one of ``.!?``).

Edits: keep a row (0), give it the role user or assistant (1), delete it (2; blank and
duplicate rows must go), insert an empty user or assistant turn (5). A truncated row
that stays adds 5. The cheapest edits win, the ASCII-least sequence of their initials
(the audit) where several are cheapest.

Four states say what has been written: nothing, a system turn, a user turn or an
assistant turn. Hirschberg's scheme needs two vectors of four costs: forward from the
start and backward from the end, they meet in the middle, the crossing state with the
least sum is on a cheapest path, and both halves are solved alike. Beside its costs the
forward vector ranks the states by their least audits. Audits up to a crossing hold one
edit per row and end in one, so none begins another, and among crossings of equal sum
the one of least rank is on the ASCII-least path. So memory is linear in the rows.

On Spark: rows are range-partitioned and sorted by (conversation, turn, role, text), so
that a conversation that holds a third of all rows spreads over many tasks, and cut
into chunks of at most ``1 << CHUNK_BITS`` rows. A chunk yields its table of costs and
ranks from each state to each state. The same scheme over a conversation's tables
(one per chunk, not per row) fixes the states between chunks; then each chunk is solved
on its own. Duplicates across chunks are found by a pre-aggregated minimum per key.
Only the digest of a whole conversation needs its rows in one task; they stream through
in order and none is held.

Defined results: a null role or text is one space; null turns come first; rows of one
turn are taken by role, then by the text's first 64 characters, then by its MD5, and
equal rows stand side by side; a null ``conv_id`` is a conversation of its own; a role
that is empty or starts with another letter cannot be kept; a conversation of no rows
needs no edits; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from squall.llm.shards import map_rows
from squall.llm.work import written

#: rows of a chunk: 2 to this power
CHUNK_BITS = 12
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 1, 2, 5, 5

START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FAR = 1 << 60
#: the state after a user or assistant turn is written
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
#: inserts that complete what has been written
TAIL = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: a row's code: its role's initial, and these flags
INITIALS = "sua"
#: initials of turns that may stand side by side
LEGAL = ("su", "ua", "au")
MUST_GO, CUT_OFF = 4, 8

#: (cost, order) from state to state; orders compare the audits from one state
Table = Sequence[Sequence[tuple[int, object]]]


def _kept(state: int, initial: int) -> int | None:
    """The state after a row of this initial is kept, None if it must not."""
    if initial == 0:
        return SYSTEM if state == START else None
    want = NEXT[state]
    return want if initial == want - 1 else None


def _row_table(code: int) -> Table:
    """The cheapest edits of one row, with inserts before it; two inserts change no state for good."""
    table = [[(FAR, "") for _ in STATES] for _ in STATES]
    left = TRUNCATED_COST if code & CUT_OFF else 0
    for state in STATES:
        at = state
        for inserts in range(3):
            ways = [(DELETE_COST, "D", at)]
            if not code & MUST_GO:
                ways.append((REROLE_COST + left, "R", NEXT[at]))
                if code & 3 < 3 and (kept := _kept(at, code & 3)) is not None:
                    ways.append((left, "K", kept))
            for cost, edit, to in ways:
                table[state][to] = min(table[state][to], (cost + INSERT_COST * inserts, "I" * inserts + edit))
            at = NEXT[at]
    return table


TABLES = [_row_table(code) for code in range(16)]


def forward(tables: Sequence[Table], lo: int, hi: int, state: int) -> tuple[list[int], list[int]]:
    """Costs of reaching each state over ``tables[lo:hi]``, and the order of their least audits."""
    costs, ranks = [FAR] * 4, [0] * 4
    costs[state] = 0
    for at in range(lo, hi):
        table, new, keys = tables[at], [FAR] * 4, []
        for to in STATES:
            cost, rank, by = min((costs[s] + table[s][to][0], ranks[s], s) for s in STATES)
            if cost < FAR:
                new[to] = cost
                keys.append((rank, table[by][to][1], to))
        costs, ranks = new, [0] * 4
        for rank, (_, _, to) in enumerate(sorted(keys)):
            ranks[to] = rank
    return costs, ranks


def backward(tables: Sequence[Table], lo: int, hi: int, state: int) -> list[int]:
    """Costs of reaching ``state`` over ``tables[lo:hi]`` from each state."""
    costs = [FAR] * 4
    costs[state] = 0
    for at in range(hi - 1, lo - 1, -1):
        table = tables[at]
        costs = [min(FAR, min(table[s][to][0] + costs[to] for to in STATES)) for s in STATES]
    return costs


def crossings(tables: Sequence[Table], lo: int, hi: int, state: int, to: int) -> Iterator[tuple[int, int, int]]:
    """(place, state, next state) for each of ``tables[lo:hi]`` along the cheapest, audit-least path."""
    if hi - lo == 1:
        yield lo, state, to
        return
    mid = (lo + hi) // 2
    costs, ranks = forward(tables, lo, mid, state)
    rest = backward(tables, mid, hi, to)
    cross = min(STATES, key=lambda s: (costs[s] + rest[s], ranks[s]))
    yield from crossings(tables, lo, mid, state, cross)
    yield from crossings(tables, mid, hi, cross, to)


def last_state(tables: Sequence[Table]) -> tuple[int, int]:
    """(state before the final inserts, whole cost) of the cheapest, audit-least repair."""
    costs, ranks = forward(tables, 0, len(tables), START)
    total = [costs[s] + INSERT_COST * len(TAIL[s]) for s in STATES]
    end = min(STATES, key=lambda s: (total[s], ranks[s]))
    return end, total[end]


def summary(codes: bytes) -> Table:
    """The table of a chunk of rows."""
    rows = [TABLES[c] for c in codes]
    out = []
    for state in STATES:
        costs, ranks = forward(rows, 0, len(rows), state)
        out.append(list(zip(costs, ranks)))
    return out


def audit(codes: bytes, state: int, to: int) -> str:
    """The edits of a chunk of rows between two states."""
    rows = [TABLES[c] for c in codes]
    return "".join(rows[at][a][b][1] for at, a, b in crossings(rows, 0, len(rows), state, to))


def _conversation(column: str = "conv_id") -> Column:
    """A key that null ids share with no other id."""
    return F.when(F.col(column).isNull(), F.lit("n")).otherwise(F.concat(F.lit("c"), F.col(column).cast("string")))


def ordered(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) as they are read, with ``conv``, ``pos``, ``chunk`` and their codes; written."""
    role, text = (F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text"))
    rows = rows.select("conv_id", "turn", role, text).withColumn("conv", _conversation())
    end = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    blank = end == ""
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))  # 1 to 3; 0 for others, 1 for an empty role
    code = F.when((initial == 0) | (F.col("role") == ""), 3).otherwise(initial - 1)
    cut = ~blank & ~F.substring(end, -1, 1).isin(".", "!", "?")
    rows = rows.select(
        "conv_id", "conv", "turn", "role", "text",
        F.substring("text", 1, 64).alias("head"),
        F.md5(F.concat_ws(":", F.octet_length("role"), "role", "text").cast("binary")).alias("key"),
        (code + F.when(blank, MUST_GO).when(cut, CUT_OFF).otherwise(0)).cast("int").alias("code"),
        # equal rows may part anywhere, so that no number of copies has to meet in one task
        F.monotonically_increasing_id().alias("salt"),
    )
    by = ["conv", F.asc_nulls_first("turn"), "role", "head", "key", "salt"]
    dealt = rows.repartitionByRange(*by).sortWithinPartitions(*by).drop("head", "salt")
    return written(dealt.withColumn("pos", F.monotonically_increasing_id()), "turns")


def _chunk(bits: int) -> Column:
    return F.shiftright("pos", bits).alias("chunk")


CHUNK_SCHEMA = (
    "conv string, chunk long, codes binary, blank long, duplicate long, truncated long, illegal long, "
    "first string, last string, costs array<long>, ranks array<int>"
)


def chunks(rows: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """One row per chunk of the :func:`ordered` rows: codes of its rows, counts, and its table."""
    keyed = rows.select("conv", "key", _chunk(bits), "pos", "code", F.substring("role", 1, 1).alias("initial"))
    held = keyed.select("conv", "key", "chunk").distinct()
    early = held.groupBy("conv", "key").agg(F.min("chunk").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    again = held.join(early, ["conv", "key"]).where("chunk > first")
    none = [F.lit(None).cast("int").alias("code"), F.lit(None).cast("string").alias("initial")]
    again = again.select("conv", "key", "chunk", F.lit(-1).cast("long").alias("pos"), *none)
    both = keyed.unionByName(again).repartition("conv", "chunk").sortWithinPartitions("conv", "chunk", "pos")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, out = None, []
        for batch in batches:
            for conv, chunk, pos, key, code, initial in zip(
                *(batch.column(c).to_pylist() for c in ("conv", "chunk", "pos", "key", "code", "initial"))
            ):
                if held is None or (held.conv, held.chunk) != (conv, chunk):
                    if held is not None:
                        out.append(held.row())
                    held = _Chunk(conv, chunk)
                if pos < 0:
                    held.seen.add(key)
                else:
                    held.add(code, key, initial)
            if out:
                yield _chunk_batch(out)
                out = []
        if held is not None:
            yield _chunk_batch([held.row()])

    return both.mapInArrow(run, CHUNK_SCHEMA)


class _Chunk:
    """The rows of a chunk, as they come; ``seen`` holds the keys of earlier chunks and rows."""

    def __init__(self, conv: str, chunk: int):
        self.conv, self.chunk, self.seen, self.codes = conv, chunk, set(), bytearray()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.first = self.last = None

    def add(self, code: int, key: str, initial: str) -> None:
        if code & MUST_GO:
            self.blank += 1
        elif key in self.seen:
            self.duplicate += 1
            code = code & 3 | MUST_GO
        elif code & CUT_OFF:
            self.truncated += 1
        self.seen.add(key)
        self.codes.append(code)
        if self.first is None:
            self.first = initial
        elif self.last + initial not in LEGAL:
            self.illegal += 1
        self.last = initial

    def row(self) -> tuple:
        table = [x for row in summary(bytes(self.codes)) for x in row]
        counts = self.blank, self.duplicate, self.truncated, self.illegal
        return (self.conv, self.chunk, bytes(self.codes), *counts, self.first, self.last, [c for c, _ in table], [r for _, r in table])


def _chunk_batch(rows: list[tuple]) -> pa.RecordBatch:
    long, text = pa.int64(), pa.string()
    types = [text, long, pa.binary(), long, long, long, long, text, text, pa.list_(long), pa.list_(pa.int32())]
    names = [x.split()[0] for x in CHUNK_SCHEMA.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)


PATH_SCHEMA = (
    "conv string, blank long, duplicate long, truncated long, illegal long, cost long, chunk array<long>, state array<int>, to array<int>"
)


def paths(parts: DataFrame) -> DataFrame:
    """One row per conversation: its counts, the cost of its repair, and the states around each of its chunks."""
    names = ["chunk", "blank", "duplicate", "truncated", "illegal", "first", "last", "costs", "ranks"]
    lists = parts.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct(*names))).alias("parts"))

    def each():
        def work(conv, *columns):
            by = dict(zip(names, columns))
            tables = [
                [list(zip(c[s * 4 : s * 4 + 4], r[s * 4 : s * 4 + 4])) for s in STATES] for c, r in zip(by["costs"], by["ranks"])
            ]
            end, cost = last_state(tables)
            between = sum(a + b not in LEGAL for a, b in zip(by["last"], by["first"][1:]))
            counts = [sum(by[c]) for c in ("blank", "duplicate", "truncated", "illegal")]
            found = list(crossings(tables, 0, len(tables), START, end))
            yield (conv, *counts[:3], counts[3] + between, cost, by["chunk"], [a for _, a, _ in found], [b for _, _, b in found])

        return work

    return map_rows(lists.select("conv", *(F.col(f"parts.{n}").alias(n) for n in names)), PATH_SCHEMA, each)


def audits(parts: DataFrame, found: DataFrame) -> DataFrame:
    """conv, chunk, state, audit: the edits of every chunk; the last one's with the final inserts."""
    arrays = F.arrays_zip("chunk", "state", "to")
    steps = found.select("conv", F.element_at("chunk", -1).alias("end"), F.explode(arrays).alias("s"))
    steps = steps.select("conv", "s.*", (F.col("s.chunk") == F.col("end")).alias("last"))
    joined = parts.select("conv", "chunk", "codes").join(steps, ["conv", "chunk"]).select("conv", "chunk", "codes", "state", "to", "last")

    def each():
        def work(conv, chunk, codes, state, to, last):
            yield conv, chunk, state, audit(codes, state, to) + (TAIL[to] if last else "")

        return work

    return map_rows(joined, "conv string, chunk long, state int, audit string", each)


class Repair:
    """The steps of a repair, each written: ``rows`` as read, ``found`` per conversation, ``audits`` per chunk."""

    def __init__(self, rows: DataFrame, bits: int = CHUNK_BITS):
        self.bits = bits
        self.rows = ordered(rows)
        parts = written(chunks(self.rows, bits), "chunks")
        self.found = written(paths(parts), "paths")
        self.audits = written(audits(parts, self.found), "audits")

    def repaired(self, *by: str) -> DataFrame:
        """conv, chunk, place, edit, role, text: the turns of the repaired conversations, chunk by chunk.

        Dealt by (conv, chunk), or by the columns ``by`` of these, and in order within a task.
        """
        by = by or ("conv", "chunk")
        none = F.lit(None).cast("string")
        plan = self.audits.select("conv", "chunk", F.lit(-1).cast("long").alias("pos"), "state", "audit", none.alias("role"), none.alias("text"))
        turns = self.rows.select("conv", _chunk(self.bits), "pos", F.lit(None).cast("int").alias("state"), none.alias("audit"), "role", "text")
        both = plan.unionByName(turns).repartition(*by).sortWithinPartitions("conv", "chunk", "pos")

        def each():
            at = {"state": START, "audit": "", "next": 0, "place": 0}

            def inserts(conv, chunk):
                while at["next"] < len(at["audit"]) and at["audit"][at["next"]] == "I":
                    yield turn(conv, chunk, "I", None, "")

            def turn(conv, chunk, edit, role, text):
                if edit == "K":
                    at["state"] = SYSTEM if role[:1] == "s" else NEXT[at["state"]]
                else:
                    at["state"] = NEXT[at["state"]]
                    role = "user" if at["state"] == USER else "assistant"
                at["next"] += 1
                at["place"] += 1
                return conv, chunk, at["place"] - 1, edit, role, text

            def work(conv, chunk, pos, state, audit, role, text):
                if pos < 0:
                    at.update(state=state, audit=audit, next=0, place=0)
                else:
                    edit = at["audit"][at["next"]]
                    if edit == "D":
                        at["next"] += 1
                    else:
                        yield turn(conv, chunk, edit, role, text)
                yield from inserts(conv, chunk)

            return work

        return map_rows(both, "conv string, chunk long, place int, edit string, role string, text string", each)

    def digests(self) -> DataFrame:
        """conv, repaired_sha256: of ``role:text`` of a conversation's turns, joined by line feeds; those with a turn."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            conv, digest = None, None
            for batch in batches:
                done = []
                for name, role, text in zip(*(batch.column(c) for c in ("conv", "role", "text"))):
                    name, line = name.as_py(), f"{role.as_py()}:{text.as_py()}"
                    if name != conv:
                        if digest:
                            done.append((conv, digest.hexdigest()))
                        conv, digest = name, hashlib.sha256()
                    else:
                        digest.update(b"\n")
                    digest.update(line.encode())
                if done:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done)], names=["conv", "repaired_sha256"])
            if digest:
                yield pa.RecordBatch.from_arrays([pa.array([conv]), pa.array([digest.hexdigest()])], names=["conv", "repaired_sha256"])

        return self.repaired("conv").mapInArrow(run, "conv string, repaired_sha256 string")

    def report(self) -> DataFrame:
        """conv, gaps, blank, duplicate, truncated, illegal, cost, audit per conversation with rows."""
        turns = self.rows.where("turn IS NOT NULL").select("conv", "turn").distinct()
        gaps = turns.groupBy("conv").agg((F.max("turn") - F.min("turn") + 1 - F.count(F.lit(1))).alias("gaps"))
        texts = self.audits.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("chunk", "audit"))).alias("a"))
        texts = texts.select("conv", F.array_join("a.audit", "").alias("audit"))
        out = self.found.drop("chunk", "state", "to").join(texts, "conv").join(gaps, "conv", "left")
        return out.withColumn("gaps", F.coalesce("gaps", F.lit(0).cast("long")))


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) with faults put in by the checksum of conversation and turn.

    Of 20 values, 0 drops the row, 1 empties its text, 2 removes ``.!?`` from it, 3 repeats
    the row, 4 gives it the role user; nulls read as one space.
    """
    conv, turn = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn"))
    kind = F.crc32(F.concat(conv, F.lit(":"), turn)) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
    role = F.when(kind == 4, "user").otherwise(role)
    times = F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1)
    out = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.array_repeat(F.lit(0), times).alias("t"))
    return out.select("conv_id", "turn", "role", "text", F.explode("t")).drop("col")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Per ``conv_id`` of ``conversations``: what its damaged rows lack, the edits that repair them, and a digest.

    A conversation that no row is left of has zeros, an empty audit and the digest of nothing.
    """
    done = Repair(damaged(conversations))
    ids = conversations.select("conv_id").distinct().withColumn("conv", _conversation())
    out = ids.join(done.report(), "conv", "left").join(done.digests(), "conv", "left")
    counts = [F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return out.select(
        "conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"),
    )
