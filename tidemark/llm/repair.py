"""Cheapest repair of conversations by a square-root checkpointed dynamic program.

A repaired conversation has the role initials ``(s?(ua)+)?``.  What has been emitted so far
is one of four states: nothing, ``s``, ends in ``u``, ends in ``a``.  The cost from a row and
state to the end is a vector of four numbers.  The vectors are computed backward and kept at
checkpoints only, every square root of the rows; walking forward, one block between two
checkpoints at a time is computed again, and in each state the least letter is taken whose
edge is tight (its cost plus the cost behind it is the cost in front of it).  In a state a
letter leads to one state only, so the letters taken are the ASCII-least cheapest audit.

Rows are dealt by range of (conversation, turn), so a task reads whole conversations in
order and repairs them as they pass.  A conversation that may go on in another partition, or
is longer than a block, is written as blocks.  For those a block is a 4 x 4 matrix of costs:
the matrices of a conversation give the vector at the end of each block (its checkpoint),
each block is then walked from that vector for every entry state, and the exits give the
state that each block is entered in.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import cut

BLOCK_ROWS = 1 << 14      # rows of a conversation that a task holds
BLOCK_CHARS = 1 << 22     # and characters

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
FAR = 1 << 40
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3
BLANK = " \t\n\x0b\x0c\r"

#: the state behind an inserted or re-roled row, and behind a kept one by its initial
FORCED = (USER, USER, ASSISTANT, USER)
KEPT = ({"s": SYSTEM, "u": USER}, {"u": USER}, {"a": ASSISTANT}, {"u": USER})
ROLE = {USER: "user", ASSISTANT: "assistant"}
INITIALS = "sua-"
CUT, GONE = 4, 8          # bits of a row's code beside the number of its initial


def closed(bare: list[int]) -> tuple[int, ...]:
    """The costs when rows may be inserted first."""
    once = [FORCED[s] for s in STATES]
    return tuple(min(bare[s], INSERT + bare[once[s]], 2 * INSERT + bare[once[once[s]]]) for s in STATES)


#: cost of ending in each state
END = closed([0, FAR, FAR, 0])


class Edits:
    """Edges over rows.  A row is a code: the number of its role's initial, ``CUT`` if it is
    truncated, ``GONE`` if it must be deleted."""

    def __init__(self) -> None:
        self.known: dict[tuple[tuple[int, ...], int], tuple] = {}

    def step(self, behind: tuple[int, ...], code: int) -> tuple[tuple[int, ...], int, tuple]:
        """(costs in front of the row with the least taken off, that least, for each state
        the edits up to the row's own and the state behind them), from the costs behind it."""
        found = self.known.get((behind, code))
        if found is None:
            if len(self.known) > 1 << 16:
                self.known.clear()
            found = self.known[behind, code] = self._step(behind, code)
        return found

    @staticmethod
    def _step(behind: tuple[int, ...], code: int) -> tuple:
        own = []                   # per state: letter -> (cost, state behind)
        for s in STATES:
            ways = {"D": (DELETE, s)}
            if not code & GONE:
                more = TRUNCATED if code & CUT else 0
                kept = KEPT[s].get(INITIALS[code & 3])
                if kept is not None:
                    ways["K"] = (more, kept)
                ways["R"] = (REROLE + more, FORCED[s])
            own.append(ways)
        front = closed([min(c + behind[t] for c, t in ways.values()) for ways in own])
        moves = []
        for s in STATES:
            letters, here = "", s
            while front[s] < FAR:
                tight = {x: t for x, (c, t) in own[here].items() if c + behind[t] == front[here]}
                if INSERT + front[FORCED[here]] == front[here]:
                    tight["I"] = FORCED[here]
                least = min(tight)
                letters += least
                here = tight[least]
                if least != "I":
                    break
            moves.append((letters, here))
        low = min(front)
        return tuple(FAR if c >= FAR else c - low for c in front), low, tuple(moves)

    def cost(self, codes: bytes, end: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
        """(costs in front of the first row less the least, the least)."""
        total, step = 0, self.step
        for code in reversed(codes):
            end, low, _ = step(end, code)
            total += low
        return end, total

    def matrix(self, codes: bytes) -> list[int]:
        """Sixteen costs: from each state in front to each state behind."""
        out = [FAR] * 16
        for t in STATES:
            end = tuple(0 if s == t else FAR for s in STATES)
            front, total = self.cost(codes, end)
            for s in STATES:
                out[4 * s + t] = front[s] + total if front[s] < FAR else FAR
        return out

    def walk(self, codes: bytes, end: tuple[int, ...], state: int) -> tuple[list[str], int]:
        """(the edits of every row, the last state), from ``state`` with costs ``end`` behind
        the last row.  Vectors are kept every square root of the rows."""
        n = len(codes)
        size = max(1, isqrt(n))
        marks, step, vector = {}, self.step, end
        for i in range(n - 1, -1, -1):
            if (i + 1) % size == 0:
                marks[i + 1] = vector
            vector = step(vector, codes[i])[0]
        marks[n] = end
        out: list[str] = []
        for low in range(0, n, size):
            high = min(n, low + size)
            vector, moves = marks.pop(high), []
            for i in range(high - 1, low - 1, -1):
                vector, _, move = step(vector, codes[i])
                moves.append(move)
            for move in reversed(moves):
                letters, state = move[state]
                out.append(letters)
        return out, state


def tail(state: int) -> str:
    """The inserts behind the last row."""
    return "I" * (END[state] // INSERT)


def code_of(role: str, text: str, seen: bool) -> tuple[int, str]:
    """A row's code and its first fault (b, d, t or none), given whether role and text came before."""
    at = INITIALS.find(role[:1]) if role[:1] in ("s", "u", "a") else 3
    body = text.rstrip(BLANK)
    if not body:
        return at | GONE, "b"
    if seen:
        return at | GONE, "d"
    return (at, "") if body[-1] in ".!?" else (at | CUT, "t")


def illegal(left: str, right: str) -> bool:
    return (left, right) not in (("s", "u"), ("u", "a"), ("a", "u"))


def lines(edits: str, state: int, role: str | None, text: str | None) -> tuple[list[tuple[str, str]], int]:
    """The repaired rows that a row's edits make from ``state``, and the state behind them."""
    out = []
    for x in edits:
        if x == "K":
            state = KEPT[state][role[:1]]
            out.append((role, text))
        elif x != "D":
            state = FORCED[state]
            out.append((ROLE[state], "" if x == "I" else text))
    return out, state


_RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class Counts:
    """Faults and gaps of consecutive rows in turn order."""

    def __init__(self) -> None:
        self.faults = {"b": 0, "d": 0, "t": 0, "": 0}
        self.illegal = self.turns = 0
        self.first = self.last = self.low = self.high = None

    def add(self, turn: int | None, role: str, fault: str) -> None:
        self.faults[fault] += 1
        self.illegal += self.last is not None and illegal(self.last, role[:1])
        self.last = role[:1]
        if self.first is None:
            self.first = role[:1]
        if turn is not None:
            self.turns += turn != self.high
            self.low = turn if self.low is None else self.low
            self.high = turn

    def gaps(self) -> int:
        return 0 if self.low is None else self.high - self.low + 1 - self.turns

    def row(self) -> list:
        return [self.gaps(), self.faults["b"], self.faults["d"], self.faults["t"], self.illegal]


class Whole:
    """Repairs conversations whose rows are at hand."""

    def __init__(self) -> None:
        self.edits = Edits()
        self.audits: dict[bytes, tuple[list[str], str, int]] = {}

    def audit(self, codes: bytes) -> tuple[list[str], str, int]:
        """(edits of every row, inserts behind the last one, cost)."""
        found = self.audits.get(codes)
        if found is None:
            if len(self.audits) > 1 << 14:
                self.audits.clear()
            front, total = self.edits.cost(codes, END)
            each, state = self.edits.walk(codes, END, NOTHING)
            found = each, tail(state), front[NOTHING] + total
            if len(codes) <= 64:
                self.audits[codes] = found
        return found

    def repaired(self, rows: list[tuple]) -> tuple[list, str, list[tuple[str, str]]]:
        """(counts and cost, audit, repaired rows) of (turn, role, text) in order."""
        seen, counts, codes = set(), Counts(), bytearray()
        for turn, role, text in rows:
            code, fault = code_of(role, text, (role, text) in seen)
            seen.add((role, text))
            counts.add(turn, role, fault)
            codes.append(code)
        each, behind, cost = self.audit(bytes(codes))
        out, state = [], NOTHING
        for edits, (_, role, text) in zip([*each, behind], [*rows, (None, None, None)]):
            made, state = lines(edits, state, role, text)
            out += made
        return [*counts.row(), cost], "".join(each) + behind, out


def hashed(rows: list[tuple[str, str]]) -> str:
    return hashlib.sha256("\n".join([f"{role}:{text}" for role, text in rows]).encode("utf-8")).hexdigest()


def _sorted(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, copies, pid) by range of conversation and turn.  The last key
    only tells equal rows apart, so that not even they must all go to one partition."""
    named = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"),
                        F.coalesce("text", F.lit(" ")).alias("text"),
                        (F.col("copies") if "copies" in rows.columns else F.lit(1)).cast("int").alias("copies"),
                        F.monotonically_increasing_id().alias("equal"))
    order = ["conv_id", "turn", "role", "text", "equal"]
    return (named.repartitionByRange(*order).sortWithinPartitions(*order)
            .withColumn("pid", F.spark_partition_id().cast("long")).drop("equal"))


class _Out:
    """Rows of the pass over the sorted rows, in batches."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.held, self.size = schema, [], 0

    def put(self, row: tuple, size: int) -> bool:
        self.held.append(row)
        self.size += size + 64
        return self.size > BLOCK_CHARS

    def batch(self) -> pa.RecordBatch:
        held, self.held, self.size = self.held, [], 0
        columns = list(zip(*held)) if held else [[]] * len(self.schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema)], schema=self.schema)


def _passed(ordered: DataFrame, made: str, kind: pa.DataType, make) -> DataFrame:
    """One pass over sorted rows: (conv_id, result of ``make`` or null, block, at, turn, role, text).
    Rows without a result belong to conversations that are not whole here."""
    types = {f.name: f.dataType.simpleString() for f in ordered.schema}
    spec = (f"conv_id {types['conv_id']}, made {made}, block long, at int, turn {types['turn']}, role string, text string")
    to_arrow = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "smallint": pa.int16()}
    schema = pa.schema([("conv_id", to_arrow[types["conv_id"]]), ("made", kind), ("block", pa.int64()), ("at", pa.int32()),
                        ("turn", to_arrow[types["turn"]]), ("role", pa.string()), ("text", pa.string())])
    block_rows, block_chars = BLOCK_ROWS, BLOCK_CHARS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole, out = Whole(), _Out(schema)
        conv, held, size, pid, block = None, [], 0, 0, 0
        started = first = False      # the first conversation may have begun in the partition before
        in_blocks = False

        def flush(is_open: bool) -> Iterator[pa.RecordBatch]:
            """The held rows of the conversation: repaired, or as one more block."""
            nonlocal held, size, block
            if is_open:
                for at, (turn, role, text) in enumerate(held or [(None, None, None)]):
                    if out.put((conv, None, (pid << 32) + block, at, turn, role, text), len(text or "")):
                        yield out.batch()
                block += 1
            else:
                for found in make(whole, held):
                    if out.put((conv, found, None, None, None, None, None), size):
                        yield out.batch()
            held, size = [], 0

        for batch in batches:
            for here, turn, role, text, copies, p in zip(*[batch.column(i).to_pylist() for i in range(6)]):
                if not started or here != conv:
                    if started:
                        yield from flush(first or in_blocks)
                        first = in_blocks = False
                    else:
                        started = first = True
                    conv, pid = here, p
                for _ in range(copies):
                    if len(held) >= block_rows or size + len(text) > block_chars and held:
                        in_blocks = True
                        yield from flush(True)
                    held.append((turn, role, text))
                    size += len(text)
        if started:
            yield from flush(True)       # the last one may go on in the next partition
        yield out.batch()
    return ordered.mapInArrow(run, spec)


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join (null conversations meet) by sorting both sides; the keys are those of ``left``."""
    right = right.withColumnsRenamed({k: f"__{k}" for k in keys})
    cond = F.col("conv_id").eqNullSafe(F.col("__conv_id"))
    for k in keys[1:]:
        cond = cond & (F.col(k) == F.col(f"__{k}"))
    return left.join(right.hint("merge"), cond, how).drop(*[f"__{k}" for k in keys])


def _open(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of conversations in blocks, (counts, cost and audit by conversation, its rows with edits and state).

    What meets in one task is a block of rows, or the 4 x 4 matrices, exits or audit
    pieces of one conversation."""
    kind = {f.name: f.dataType.simpleString() for f in rows.schema}
    conv_type, turn_type = f"conv_id {kind['conv_id']}", kind["turn"]
    real = rows.filter(F.col("role").isNotNull())
    print_of = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = (real.select("conv_id", print_of.alias("print"), "block", "at").groupBy("conv_id", "print")
              .agg(F.min(F.struct("block", "at")).alias("f")).select("conv_id", "f.block", "f.at"))
    marked = _joined(rows, firsts.withColumn("new", F.lit(True)), ["conv_id", "block", "at"], "left").select(
        "conv_id", "block", "at", "turn", F.substring("role", 1, 1).alias("initial"),
        F.col("role").isNotNull().alias("real"),
        F.substring(F.rtrim(F.translate("text", "\t\n\x0b\x0c\r", " " * 5)), -1, 1).alias("last"),
        F.col("new").isNull().alias("seen"))
    keys = ["conv_id", "block"]
    blocks_of = f"{conv_type}, block long, codes binary, matrix array<long>, counts array<long>, first string, last string, low {turn_type}, high {turn_type}"
    turn_arrow = {"bigint": pa.int64(), "int": pa.int32(), "smallint": pa.int16()}[turn_type]

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edits, held, out = Edits(), None, []
        conv_arrow = None

        def done():
            codes = bytes(held[2])
            c = held[3]
            out.append((held[0], held[1], codes, edits.matrix(codes),
                        [c.turns, c.faults["b"], c.faults["d"], c.faults["t"], c.illegal, len(codes)],
                        c.first, c.last, c.low, c.high))
        for batch in batches:
            conv_arrow = batch.column(0).type
            for conv, block, at, turn, initial, is_real, last, seen in zip(*[batch.column(i).to_pylist() for i in range(8)]):
                if held is None or (conv, block) != held[:2]:
                    if held:
                        done()
                    held = (conv, block, bytearray(), Counts())
                if is_real:
                    code, fault = code_of(initial, last, seen)
                    held[2].append(code)
                    held[3].add(turn, initial, fault)
        if held:
            done()
        if out:
            c = list(zip(*out))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], conv_arrow), pa.array(c[1], pa.int64()), pa.array(c[2], pa.binary()),
                 pa.array(c[3], pa.list_(pa.int64())), pa.array(c[4], pa.list_(pa.int64())), pa.array(c[5], pa.string()),
                 pa.array(c[6], pa.string()), pa.array(c[7], turn_arrow), pa.array(c[8], turn_arrow)],
                ["conv_id", "block", "codes", "matrix", "counts", "first", "last", "low", "high"])
    blocks = cut(marked.repartition(*keys).sortWithinPartitions(*keys, "at").mapInArrow(summed, blocks_of))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The vector behind each block, backward over the matrices; totals on the first block."""
        for batch in batches:
            out = []
            for conv, blocks in zip(*[batch.column(i).to_pylist() for i in range(2)]):
                vector, behind = list(END), {}
                for b in reversed(blocks):
                    behind[b["block"]] = vector
                    m = b["matrix"]
                    vector = [min(FAR, *(m[4 * s + t] + vector[t] for t in STATES)) for s in STATES]
                total, low, high, last, size = [0] * 5, None, None, None, 0
                for b in blocks:
                    turns, blank, dup, trunc, wrong, n = b["counts"]
                    if n:
                        wrong += last is not None and illegal(last, b["first"])
                        last, size = b["last"], size + n
                    if b["low"] is not None:
                        turns -= b["low"] == high
                        low, high = b["low"] if low is None else low, b["high"]
                    total = [x + y for x, y in zip(total, [turns, blank, dup, trunc, wrong])]
                gaps = 0 if low is None else high - low + 1 - total[0]
                for i, b in enumerate(blocks):
                    out.append((conv, b["block"], behind[b["block"]],
                                [gaps, *total[1:], vector[NOTHING] if size else 0] if i == 0 else None))
            c = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c[0], batch.column(0).type), pa.array(c[1], pa.int64()), pa.array(c[2], pa.list_(pa.int64())),
                 pa.array(c[3], pa.list_(pa.int64()))], ["conv_id", "block", "behind", "totals"])
    vectors = (blocks.groupBy("conv_id").agg(F.sort_array(F.collect_list(
        F.struct("block", "matrix", "counts", "first", "last", "low", "high"))).alias("b"))
        .mapInArrow(ends, f"{conv_type}, block long, behind array<long>, totals array<long>"))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each block again, from the vector behind it, for every state it may be entered in."""
        edits = Edits()
        for batch in batches:
            for i in range(batch.num_rows):
                conv, block, codes, behind, totals = (batch.column(j)[i].as_py() for j in range(5))
                low = min(behind)
                end = tuple(FAR if x >= FAR else x - low for x in behind)
                front, _ = edits.cost(codes, end)
                ways = [edits.walk(codes, end, s) if front[s] < FAR else ([], s) for s in STATES]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i:i + 1], batch.column(1)[i:i + 1], batch.column(4)[i:i + 1],
                     pa.array([[s for _, s in ways]], pa.list_(pa.int32())),
                     pa.array([[e for e, _ in ways]], pa.list_(pa.list_(pa.string())))],
                    ["conv_id", "block", "totals", "exits", "edits"])
    ways = cut(_joined(blocks, vectors, keys, "inner").select(*keys, "codes", "behind", "totals").mapInArrow(walked, f"{conv_type}, block long, totals array<long>, exits array<int>, edits array<array<string>>"))

    def entered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The state each block is entered in, from the exits of those before it; the inserts behind the last."""
        for batch in batches:
            out = []
            for conv, blocks in zip(*[batch.column(i).to_pylist() for i in range(2)]):
                state = NOTHING
                for i, b in enumerate(blocks, 1):
                    entry, state = state, b["exits"][state]
                    out.append((conv, b["block"], entry, tail(state) if i == len(blocks) else ""))
            c = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c[0], batch.column(0).type), pa.array(c[1], pa.int64()),
                                              pa.array(c[2], pa.int32()), pa.array(c[3], pa.string())],
                                             ["conv_id", "block", "entry", "behind"])
    entries = (ways.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("block", "exits"))).alias("b"))
               .mapInArrow(entered, f"{conv_type}, block long, entry int, behind string"))
    picked = cut(_joined(ways, entries, keys, "inner").select(
        *keys, "totals", F.col("edits")[F.col("entry")].alias("edits"), "entry", "behind"))
    audit = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", F.concat(
        F.array_join("edits", ""), "behind").alias("e")))), lambda x: x.e), "")
    result = picked.groupBy("conv_id").agg(F.max("totals").alias("t"), audit.alias("audit"))
    each = picked.select(*keys, "entry", F.posexplode(F.concat("edits", F.array("behind"))).alias("at", "edits")).select(
        *keys, "at", F.when(F.col("at") == 0, F.col("entry")).alias("entry"), "edits")
    return result, _joined(each, real.drop("turn"), ["conv_id", "block", "at"], "left")


def _streamed(text_rows: DataFrame, schema: str, start, take, finish) -> DataFrame:
    """Rows of a conversation in order through ``take``, a row at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, state, held, any_row = None, NOTHING, None, False
        for batch in batches:
            kind = batch.column(0).type
            for here, _, _, entry, edits, role, text in zip(*[batch.column(i).to_pylist() for i in range(7)]):
                if not any_row or here != conv:
                    if any_row:
                        yield from finish(conv, held, kind)
                    conv, held, state, any_row = here, start(), NOTHING, True
                state = state if entry is None else entry
                made, state = lines(edits or "", state, role, text)
                yield from take(conv, held, made, kind)
        if any_row:
            yield from finish(conv, held, kind)
    order = ["conv_id", "block", "at"]
    return text_rows.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(run, schema)


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256).

    ``rows``: (conv_id, turn, role, text), and optionally ``copies``, how often a row stands in
    its conversation one after another; 0 only names the conversation.  Order: turn, nulls
    first, then role and text.  Null role or text: one space.  A conversation without rows has
    zeros, an empty audit and the hash of the empty string; a null conv_id is a conversation
    of its own; repeated rows are duplicates; an empty table gives no row.  Other columns are
    not read.  The hash of a conversation's text is one sequence and its audit one string, so
    these two alone are made by one task a conversation, the text row by row."""
    kind = pa.struct([("gaps", pa.int64()), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()),
                      ("illegal", pa.int64()), ("cost", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])
    names = [f.name for f in kind]

    def make(whole: Whole, held: list[tuple]):
        counts, audit, out = whole.repaired(held)
        yield dict(zip(names, [*counts, audit, hashed(out)]))
    passed = cut(_passed(_sorted(rows), "struct<" + _RESULT.replace(" ", ":").replace(",:", ",") + ">", kind, make))
    whole = passed.filter(F.col("made").isNotNull()).select("conv_id", "made.*")
    result, text_rows = _open(passed.filter(F.col("made").isNull()).select("conv_id", "block", "at", "turn", "role", "text"))

    def start():
        return [hashlib.sha256(), False]

    def take(conv, held, made, kind):
        for role, text in made:
            held[0].update((b"\n" if held[1] else b"") + f"{role}:{text}".encode("utf-8"))
            held[1] = True
        return ()

    def finish(conv, held, kind):
        yield pa.RecordBatch.from_arrays([pa.array([conv], kind), pa.array([held[0].hexdigest()])], ["conv_id", "repaired_sha256"])
    conv_type = dict(passed.dtypes)["conv_id"]
    digest = _streamed(text_rows, f"conv_id {conv_type}, repaired_sha256 string", start, take, finish)
    t = F.col("t")
    joined = _joined(result, digest, ["conv_id"], "inner").select(
        "conv_id", *[t[i].alias(n) for i, n in enumerate(names[:6])], "audit", "repaired_sha256")
    return whole.unionByName(joined)


def repaired(rows: DataFrame) -> DataFrame:
    """The repaired conversations themselves: (conv_id, position, role, text), position from 0.
    Input and odd rows as for ``repair``."""
    kind = pa.struct([("position", pa.int64()), ("role", pa.string()), ("text", pa.string())])

    def make(whole: Whole, held: list[tuple]):
        for i, (role, text) in enumerate(whole.repaired(held)[2]):
            yield {"position": i, "role": role, "text": text}
    passed = cut(_passed(_sorted(rows), "struct<position:long,role:string,text:string>", kind, make))
    _, text_rows = _open(passed.filter("made IS NULL").select("conv_id", "block", "at", "turn", "role", "text"))

    def take(conv, held, made, kind):
        if made:
            yield pa.RecordBatch.from_arrays(
                [pa.array([conv] * len(made), kind), pa.array(range(held[0], held[0] + len(made)), pa.int64()),
                 pa.array([r for r, _ in made]), pa.array([t for _, t in made])], ["conv_id", "position", "role", "text"])
            held[0] += len(made)
    conv_type = dict(passed.dtypes)["conv_id"]
    rest = _streamed(text_rows, f"conv_id {conv_type}, position long, role string, text string",
                     lambda: [0], take, lambda *_: ())
    return passed.filter("made IS NOT NULL").select("conv_id", "made.*").unionByName(rest)


def damaged(conversations: DataFrame) -> DataFrame:
    """``conversations`` with the faults of the contract, by crc32 of ``conv_id:turn`` modulo 20: 0 drops the
    row, 1 empties its text, 2 takes out ``.!?``, 3 repeats it, 4 makes its role ``user``.  Nulls are one space."""
    def text_of(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    return conversations.select(
        "conv_id", "turn", F.when(fault == 4, F.lit("user")).otherwise(text_of("role")).alias("role"),
        F.when(fault == 1, F.lit("")).when(fault == 2, F.translate(text_of("text"), ".!?", "")).otherwise(text_of("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"))
