"""Conversation structure repair with a suffix-shared automaton of role and fault signatures.

A conversation is repaired when its roles' first letters read ``(s?(ua)+)?``.
Edits: Keep a turn (0), Rerole it to user or assistant (2), Delete it (3), or
Insert an empty turn of user or assistant (2). Blank and duplicate turns must
be deleted; a truncated turn that stays costs 1 more.

1. Faults and first letters come from built-in functions; the earliest turn
   with a role and text is a grouped minimum, joined back, so a text that fills
   a conversation is combined in the map tasks and its join can be split.
2. Turns without their text are sorted by range, so a conversation that holds a
   third of all rows is spread over tasks, and written as strings of one letter
   a turn, which are then put together.
3. Each different signature is solved once. Signatures are sorted from their
   ends: a node of the automaton is a suffix, shared by all signatures that end
   in it, and holds for each state of the grammar the cost to go and the first
   edit of the best audit. Only the path of the current signature is kept, and
   nodes with the same relative costs share their transitions.
4. Audits are sorted in front of their conversations' turns, and one pass that
   holds a batch of turns applies them, in order.

The audit of a conversation is one value, and its digest is one sequence of
bytes, so the turns of one conversation pass through one task there; they
stream through it and are never gathered.

Defined results: a null role or text counts as one space; null turns come
first; turns of one number are ordered by a digest of role and text; rows that
repeat role and text are duplicates; a row without conversation id belongs to
the conversation without id; a role without a first letter s, u or a
(an empty one too) has to be reroled or deleted; ``copies`` 0 keeps the
conversation in the result without the row; an empty table gives no rows.
Other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keelson.llm.scratch import stored
from keelson.llm.textbytes import task

WORD_CHAR = "[^\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\x0c\r"
PIECE = 4096

# Grammar states: nothing yet, after system, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
EXPECTED = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
LEGAL = ("su", "ua", "au")

# A turn is a letter: first letter of the role (s, u, a, other) and fault (none, blank, duplicate, truncated).
KINDS, FAULTS = "suax", ("", "blank", "duplicate", "truncated")
LETTERS = "".join(chr(ord("A") + i) for i in range(16))
_KIND = str.maketrans(LETTERS, KINDS * 4)
_SYMBOL = str.maketrans(LETTERS, KINDS + "dddddddd" + KINDS.upper())

KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2
TRUNCATED = 1

Shape = tuple[int, int, int, int]


class Dawg:
    """The path of one signature, from its end, in the automaton of all signatures' suffixes.

    ``solve`` reuses the nodes of the suffix that a signature shares with the
    one before it; in the order of reversed signatures every node is made once.
    """

    def __init__(self):
        self._path = ""  # reversed
        end, shape, choice = self._inserted([0, None, None, 0], ["", "", "", ""])
        self._nodes: list[tuple[int, Shape, str]] = [(end, shape, choice)]
        self._transitions: dict[tuple[str, Shape], tuple[int, Shape, str]] = {}

    @staticmethod
    def _inserted(cost: list, choice: list[str]) -> tuple[int, Shape, str]:
        """Lower the costs by inserted turns; ties go to the smaller letter."""
        for _ in range(3):  # no cheapest repair inserts more in one place
            for q in (START, SYSTEM, USER, ASSISTANT):
                more = cost[EXPECTED[q][0]]
                if more is not None and (cost[q] is None or (more + INSERT, "I") < (cost[q], choice[q] or "I")):
                    cost[q], choice[q] = more + INSERT, "I"
        least = min(cost)
        return least, tuple(c - least for c in cost), "".join(c or "." for c in choice)

    def _before(self, symbol: str, shape: Shape) -> tuple[int, Shape, str]:
        """The node before one with these relative costs: what it adds, its relative costs, its edits by state."""
        found = self._transitions.get((symbol, shape))
        if found is None:
            cost, choice = [], []
            for q in (START, SYSTEM, USER, ASSISTANT):
                options = [(shape[q] + DELETE, "D")]
                if symbol != "d":
                    extra = TRUNCATED if symbol.isupper() else 0
                    to = kept(q, symbol.lower())
                    if to is not None:
                        options.append((shape[to] + KEEP + extra, "K"))
                    options.append((shape[EXPECTED[q][0]] + REROLE + extra, "R"))
                c, edit = min(options)
                cost.append(c)
                choice.append(edit)
            found = self._transitions[symbol, shape] = self._inserted(cost, choice)
        return found

    def solve(self, signature: str) -> tuple[int, str]:
        """The least cost and the smallest audit of that cost."""
        backward = signature[::-1]
        same = _shared(self._path, backward)
        del self._nodes[same + 1 :]
        for symbol in backward[same:]:
            base, shape, _ = self._nodes[-1]
            more, shape, choice = self._before(symbol, shape)
            self._nodes.append((base + more, shape, choice))
        self._path = backward
        at, q, audit = len(backward), START, []
        base, shape, _ = self._nodes[at]
        cost = base + shape[START]
        while (edit := self._nodes[at][2][q]) != ".":
            audit.append(edit)
            if edit == "I":
                q = EXPECTED[q][0]
            else:
                q = after(q, edit, signature[len(backward) - at].lower())
                at -= 1
        return cost, "".join(audit)


def _shared(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


def kept(state: int, kind: str) -> int | None:
    """The state after keeping a turn; None where the grammar forbids it."""
    if kind == "s":
        return SYSTEM if state == START else None
    if kind == "u":
        return USER if state != USER else None
    return ASSISTANT if kind == "a" and state == USER else None


def after(state: int, edit: str, kind: str) -> int:
    if edit == "D":
        return state
    return EXPECTED[state][0] if edit in "IR" else kept(state, kind)


def _turns(turns: DataFrame, copies_col: str | None) -> DataFrame:
    copies = F.col(copies_col).cast("int") if copies_col else F.lit(1)
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    return turns.select("conv_id", "turn", copies.alias("copies"), role.alias("role"), text.alias("text"), digest.alias("digest"))


def _marked(rows: DataFrame) -> DataFrame:
    """Each row without its text: order, first letter of the role, and whether it is blank, truncated or seen earlier."""
    first = F.substring("role", 1, 1)
    kind = F.when(first.isin("s", "u", "a"), first).otherwise(F.lit("x"))
    last = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    light = rows.select(
        "conv_id", "turn", "copies", "digest", kind.alias("kind"), (~F.col("text").rlike(WORD_CHAR)).alias("blank"),
        (~last.isin(".", "!", "?")).alias("truncated"),
    )
    # Rows repeated whole become one.
    names = [c for c in light.columns if c != "copies"]
    light = stored(light.groupBy(*names).agg(F.sum("copies").alias("copies")), "marks")
    place = F.struct(F.col("turn").isNotNull().alias("set"), "turn")
    earliest = light.filter("copies > 0").groupBy("conv_id", "digest").agg(F.min(place).alias("earliest"), F.count("*").alias("n"))
    again = earliest.filter("n > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "earliest")
    joined = light.join(again, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    return joined.select(*light.columns, F.coalesce(place > F.col("earliest"), F.lit(False)).alias("later"))


def _pieces(marked: DataFrame) -> DataFrame:
    """The letters of consecutive turns of one conversation, at most ``PIECE`` turns in a row of the result."""
    spark = marked.sparkSession
    width = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["conv_id", "turn", "digest"]
    dealt = marked.repartitionByRange(width, *order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    schema = T.StructType(
        [marked.schema["conv_id"], T.StructField("part", T.IntegerType()), T.StructField("number", T.LongType())]
        + [T.StructField("letters", T.StringType())]
        + [T.StructField(n, T.LongType()) for n in ("first_turn", "last_turn", "turns")]
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        conv, letters, turns, before, number, part, open_ = None, [], [None, None, 0], (None, None), 0, 0, False

        def close() -> None:
            nonlocal number
            done.append((conv, part, number, "".join(letters), *turns))
            number += 1

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "digest", "copies", "kind", "blank", "truncated", "later", "part")]
            for c, turn, digest, copies, kind, blank, truncated, later, part in zip(*columns):
                if not open_ or c != conv or len(letters) >= PIECE:
                    if open_:
                        close()
                        if c != conv:
                            before = (None, None)
                    conv, letters, turns, open_ = c, [], [None, None, 0], True
                for _ in range(copies):
                    seen = later or before == (turn, digest)
                    fault = 1 if blank else 2 if seen else 3 if truncated else 0
                    letters.append(LETTERS[4 * fault + KINDS.index(kind)])
                    before = (turn, digest)
                if copies and turn is not None:
                    turns = [turn if turns[0] is None else turns[0], turn, turns[2] + (turn != turns[1])]
            yield _batch(done, schema)
            done = []
        if open_:
            close()
            yield _batch(done, schema)

    return dealt.mapInArrow(task(cut), schema)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    columns = list(zip(*rows)) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal")


def _signatures(pieces: DataFrame) -> DataFrame:
    """``conv_id, signature`` and the counts of each conversation; a piece is one row of the group."""
    spans = F.struct("part", "number", "letters", "first_turn", "last_turn", "turns")
    whole = pieces.groupBy("conv_id").agg(F.sort_array(F.collect_list(spans)).alias("spans"))
    schema = T.StructType(
        [pieces.schema["conv_id"], T.StructField("signature", T.StringType())] + [T.StructField(n, T.LongType()) for n in SUMMARY]
    )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for conv, spans in zip(batch.column("conv_id").to_pylist(), batch.column("spans").to_pylist()):
                letters = "".join(s["letters"] for s in spans)
                least = last = None
                distinct = 0
                for s in (s for s in spans if s["turns"]):
                    distinct += s["turns"] - (s["first_turn"] == last)
                    least, last = s["first_turn"] if least is None else least, s["last_turn"]
                kinds = letters.translate(_KIND)
                pairs = max(0, len(kinds) - 1) - sum(kinds.count(p) for p in LEGAL)
                counts = [sum(map(letters.count, LETTERS[4 * f : 4 * f + 4])) for f in (1, 2, 3)]
                gaps = 0 if least is None else last - least + 1 - distinct
                out.append((conv, letters.translate(_SYMBOL), gaps, *counts, pairs))
            yield _batch(out, schema)

    return whole.mapInArrow(task(read), schema)


def solve_signatures(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of each different signature; equal ones are combined before they are shuffled."""
    width = max(2, int(signatures.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    backward = signatures.select("signature").distinct().withColumn("backward", F.reverse("signature"))
    dealt = backward.repartitionByRange(width, "backward").sortWithinPartitions("backward")

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dawg = Dawg()
        for batch in batches:
            names = batch.column("signature").to_pylist()
            solved = [dawg.solve(s) for s in names]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([c for c, _ in solved], pa.int64()), pa.array([a for _, a in solved], pa.string())],
                ["signature", "cost", "audit"],
            )

    return dealt.mapInArrow(task(solve), "signature string, cost long, audit string")


def plans(turns: DataFrame, copies_col: str | None = None) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit`` of each conversation."""
    read = stored(_signatures(_pieces(_marked(_turns(turns, copies_col)))), "signatures")
    return read.join(solve_signatures(read), "signature").select("conv_id", *SUMMARY, "cost", "audit")


def _in_order(turns: DataFrame, copies_col: str | None) -> DataFrame:
    """Each conversation's plan, then its turns in order, in one task."""
    rows = _turns(turns, copies_col).filter("copies > 0")
    planned = plans(turns, copies_col)
    flow = planned.unionByName(rows, allowMissingColumns=True)
    return flow.repartition("conv_id").sortWithinPartitions("conv_id", F.col("audit").isNull(), F.col("turn").asc_nulls_first(), "digest")


Step = tuple[str, str, str, object]


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple | None, Step | None]]:
    """``(plan, None)`` at the start of each conversation, then ``(None, (edit, role, text, turn))`` for each edit."""
    names = ("conv_id", *SUMMARY, "cost", "audit", "role", "text", "turn", "copies")
    audit, at, state = "", 0, START

    def insert() -> Iterator[tuple[None, Step]]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, role = EXPECTED[state]
            at += 1
            yield None, ("I", role, "", None)

    for batch in batches:
        for *plan, role, text, turn, copies in zip(*[batch.column(n).to_pylist() for n in names]):
            if plan[-1] is not None:
                yield from insert()
                audit, at, state = plan[-1], 0, START
                yield tuple(plan), None
                continue
            for _ in range(copies):
                yield from insert()
                edit, at = audit[at], at + 1
                if edit == "R":
                    role = EXPECTED[state][1]
                state = after(state, edit, role[:1])
                yield None, (edit, role, text, turn)
    yield from insert()


def repaired_turns(turns: DataFrame, copies_col: str | None = None) -> DataFrame:
    """``conv_id, position, edit, turn, role, text``: the turns of the repaired conversations."""
    flow = _in_order(turns, copies_col)
    schema = T.StructType(
        [flow.schema["conv_id"], T.StructField("position", T.LongType()), T.StructField("edit", T.StringType()), flow.schema["turn"]]
        + [T.StructField(n, T.StringType()) for n in ("role", "text")]
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, position, out = None, 0, []
        for plan, step in _walk(batches):
            if plan is not None:
                conv, position = plan[0], 0
            elif step[0] != "D":
                edit, role, text, turn = step
                out.append((conv, position, edit, turn, role, text))
                position += 1
            if len(out) >= 1024:
                yield _batch(out, schema)
                out = []
        yield _batch(out, schema)

    return flow.mapInArrow(task(write), schema)


def repair(turns: DataFrame, copies_col: str | None = None) -> DataFrame:
    """The plan of each conversation with ``repaired_sha256``, the digest of its repaired ``role:text`` lines."""
    flow = _in_order(turns, copies_col)
    schema = T.StructType(
        [flow.schema["conv_id"]] + [T.StructField(n, T.LongType()) for n in (*SUMMARY, "cost")]
        + [T.StructField(n, T.StringType()) for n in ("audit", "repaired_sha256")]
    )
    return flow.mapInArrow(task(_digests(schema)), schema)


def _digests(schema: T.StructType) -> Callable:
    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, sha, started, out = None, None, False, []
        for start, step in _walk(batches):
            if start is not None:
                if plan is not None:
                    out.append((*plan, sha.hexdigest()))
                plan, sha, started = start, hashlib.sha256(), False
                if len(out) >= 4096:
                    yield _batch(out, schema)
                    out = []
            elif step[0] != "D":
                sha.update(("\n" if started else "").encode() + f"{step[1]}:{step[2]}".encode())
                started = True
        if plan is not None:
            out.append((*plan, sha.hexdigest()))
        yield _batch(out, schema)

    return digest
