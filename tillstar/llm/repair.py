"""Conversation repair: a generalised LR parser over the role grammar chooses the cheapest edits of the turns.

The parser's stacks share their lower parts, and after every turn stacks that are equal are merged by the smallest
(cost, audit). As the grammar is left-recursive there are few stacks, so a run of turns is a small table from the
stack before it to the stack after it; a long conversation is parsed in chunks whose tables are put together.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from tillstar.llm.common import ship, stored

ship(__name__)

# The role grammar by initials: nothing, or an optional system turn and then pairs of user and assistant.
RULES = (("S", ""), ("S", "H"), ("H", "Hua"), ("H", "sua"), ("H", "ua"))
NAMES = {"u": "user", "a": "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
SPACE = " \t\n\x0b\x0c\r"
# Turns and characters of a chunk.
CHUNK_TURNS, CHUNK_CHARS = 256, 1 << 20
BATCH_CHUNKS, BATCH_CHARS = 1024, 4 << 20


def _closure(items: set) -> frozenset:
    """The items of a parser state: (rule, how many of its symbols are read)."""
    found, todo = set(items), list(items)
    while todo:
        rule, dot = todo.pop()
        for i, (left, _) in enumerate(RULES):
            if RULES[rule][1][dot:dot + 1] == left and (i, 0) not in found:
                found.add((i, 0))
                todo.append((i, 0))
    return frozenset(found)


def _goto(state: frozenset, symbol: str) -> frozenset:
    return _closure({(r, d + 1) for r, d in state if RULES[r][1][d:d + 1] == symbol})


def _shift(stack: tuple, initial: str) -> tuple | None:
    """The stack after reading ``initial``, with every reduction that needs no look ahead; None if it does not fit."""
    state = _goto(stack[-1], initial)
    if not state:
        return None
    stack = (*stack, state)
    while len(stack[-1]) == 1:
        rule, dot = next(iter(stack[-1]))
        left, right = RULES[rule]
        if left == "S" or dot < len(right):
            break
        stack = stack[:len(stack) - len(right)]
        stack = (*stack, _goto(stack[-1], left))
    return stack


def _accepts(stack: tuple) -> bool:
    """Whether the rest of the input may be empty."""
    return any(RULES[r][0] == "S" and d == len(RULES[r][1]) == len(stack) - 1 for r, d in stack[-1])


def _tables() -> tuple[list[dict[str, int]], list[dict[int, int]], list[int]]:
    """By stack: the stack after each initial, the number of inserts to every other stack, and to an accepting one."""
    stacks = [(_closure({(i, 0) for i, r in enumerate(RULES) if r[0] == "S"}),)]
    moves: list[dict[str, int]] = []
    for stack in stacks:
        moves.append({})
        for initial in "sua":
            after = _shift(stack, initial)
            if after is not None:
                if after not in stacks:
                    stacks.append(after)
                moves[-1][initial] = stacks.index(after)
    inserts = []
    for start in range(len(stacks)):
        steps, todo = {start: 0}, [start]
        for at in todo:
            for initial in NAMES:
                after = moves[at].get(initial)
                if after is not None and after not in steps:
                    steps[after] = steps[at] + 1
                    todo.append(after)
        inserts.append(steps)
    closing = [min(n for z, n in steps.items() if _accepts(stacks[z])) for steps in inserts]
    return moves, inserts, closing


MOVES, INSERTS, CLOSING = _tables()
START = 0


def _steps(initial: str, cut: bool) -> list[list[tuple[int, int, str]]]:
    """By stack, the cheapest ways over one turn of this initial: (stack after it, cost, audit)."""
    stays = TRUNCATED if cut else 0
    out = []
    for steps in INSERTS:
        best: dict[int, tuple[int, str]] = {}
        for at, n in steps.items():
            ways = [(at, DELETE, "D")]
            ways += [(z, stays, "K") for t, z in MOVES[at].items() if t == initial]
            ways += [(z, REROLE + stays, "R") for t, z in MOVES[at].items() if t in NAMES]
            for z, cost, letter in ways:
                way = (INSERT * n + cost, "I" * n + letter)
                best[z] = min(best.get(z, way), way)
        out.append([(z, *way) for z, way in best.items()])
    return out


STEPS = {(initial, cut): _steps(initial, cut) for initial in ("s", "u", "a", "") for cut in (False, True)}


def parse(turns: list[tuple[str, bool, bool, int]], starts) -> dict[int, dict[int, tuple[int, str]]]:
    """For every stack before some turns, the cheapest (cost, audit) by the stack after them.

    A turn is (role initial, has to be deleted, truncated, equal copies); copies but the first have to be deleted.
    """
    table = {}
    for start in starts:
        tops = {start: (0, "")}
        for initial, gone, cut, copies in turns:
            again = copies
            if not gone:
                again, after = copies - 1, {}
                for at, (cost, audit) in tops.items():
                    for z, more, letters in STEPS[initial, cut][at]:
                        way = (cost + more, audit + letters)
                        if z not in after or way < after[z]:
                            after[z] = way
                tops = after
            if again:
                tops = {z: (cost + DELETE * again, audit + "D" * again) for z, (cost, audit) in tops.items()}
        table[start] = tops
    return table


def initial_of(role: str) -> str:
    return role[:1] if role[:1] in ("s", "u", "a") else ""


def apply_audit(start: int, audit: str, turns: list[dict]) -> list[dict]:
    """The turns that remain after the edits of ``audit``; rerole and insert take the role that the stack asks for."""
    out, at, rest = [], start, iter([t for t in turns for _ in range(t["copies"])])
    for letter in audit:
        turn = next(rest) if letter != "I" else {"role": "", "text": ""}
        if letter == "D":
            continue
        initial = initial_of(turn["role"]) if letter == "K" else next(t for t in MOVES[at] if t in NAMES)
        at = MOVES[at][initial]
        out.append({"role": turn["role"] if letter == "K" else NAMES[initial], "text": turn["text"]})
    return out


_HEAD = ("struct<first_initial:string,last_initial:string,first_turn:bigint,last_turn:bigint,turns:bigint,"
         "blank:bigint,duplicate:bigint,truncated:bigint,illegal:bigint>")
_MOVE = "struct<a:int,z:int,cost:bigint,place:int,audit:string>"
_TURN = "struct<role:string,text:string,copies:bigint>"


class _Chunk:
    """Turns of one conversation that follow each other."""

    def __init__(self, conversation, whole_start: bool):
        self.conversation, self.starts = conversation, (START,) if whole_start else range(len(MOVES))
        self.parsed, self.turns, self.numbers, self.chars = [], [], [], 0
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)

    def add(self, turn, role: str, text: str, copies: int, seen: bool) -> None:
        initial, body = initial_of(role), text.rstrip(SPACE)
        cut = bool(body) and not seen and body[-1] not in ".!?"
        self.counts["blank"] += copies if not body else 0
        self.counts["duplicate"] += 0 if not body else copies if seen else copies - 1
        self.counts["truncated"] += cut
        if self.parsed:
            self.counts["illegal"] += not legal(self.parsed[-1][0], initial)
        self.counts["illegal"] += copies - 1
        gone = not body or seen
        self.parsed.append((initial, gone, cut, copies))
        # Texts of turns that have to go are not carried any further.
        self.turns.append({"role": role, "text": "" if gone else text, "copies": copies})
        self.chars += 0 if gone else len(text)
        if turn is not None and (not self.numbers or self.numbers[-1] != turn):
            self.numbers.append(turn)

    def row(self) -> dict:
        table = parse(self.parsed, self.starts)
        moves = [{"a": a, "z": z, "cost": cost, "place": place, "audit": audit} for a, ends in table.items()
                 for place, (z, (cost, audit)) in enumerate(sorted(ends.items(), key=lambda e: e[1][1]))]
        n = self.numbers
        head = {"first_initial": self.parsed[0][0], "last_initial": self.parsed[-1][0], "first_turn": n[0] if n else None,
                "last_turn": n[-1] if n else None, "turns": len(n), **self.counts}
        return {"conv_id": self.conversation, "head": head, "moves": moves, "turns": self.turns}


def legal(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


def _chunks(schema):
    """Chunks of a partition whose rows are sorted by conversation and turn."""

    def run(batches):
        from pyspark import TaskContext

        number, chars, ready = TaskContext.get().partitionId() << 36, 0, []
        chunk = None

        def batch():
            nonlocal number, ready, chars
            for row in ready:
                row["chunk"] = number
                number += 1
            out, ready, chars = pa.RecordBatch.from_pylist(ready, schema=schema), [], 0
            return out

        for rows in batches:
            for r in rows.to_pylist():
                other = chunk is not None and chunk.conversation != r["conv_id"]
                if chunk is not None and (other or len(chunk.turns) >= CHUNK_TURNS or chunk.chars >= CHUNK_CHARS):
                    chars += chunk.chars
                    ready.append(chunk.row())
                    chunk = None
                    if len(ready) >= BATCH_CHUNKS or chars >= BATCH_CHARS:
                        yield batch()
                if chunk is None:
                    # The first conversation of a partition may go on from the one before.
                    chunk = _Chunk(r["conv_id"], other)
                chunk.add(r["turn"], r["role"], r["text"], r["copies"], r["seen"])
        if chunk is not None:
            ready.append(chunk.row())
            yield batch()

    return run


def _arrow(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


_PATH = "array<struct<chunk:bigint,a:int,z:int,more:int>>"
SUMMARY = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"


def fold(chunks: list[dict]) -> dict:
    """The chunks of one conversation, in order, put together: its counts, its cost, and the way through every chunk."""
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    low = high = last = None
    # By stack: cost, place of its audit among all, and the way so far. Audits of one length in turns differ before either ends.
    tops, ways = {START: (0, 0)}, []
    for c in chunks:
        h = c["head"]
        for k in total:
            total[k] += h[k]
        total["illegal"] += last is not None and not legal(last, h["first_initial"])
        last = h["last_initial"]
        if h["turns"]:
            total["turns"] -= high is not None and high == h["first_turn"]
            low, high = h["first_turn"] if low is None else low, h["last_turn"]
        after = {}
        for m in c["moves"]:
            if m["a"] in tops:
                cost, place = tops[m["a"]]
                way = (cost + m["cost"], place, m["place"], m["a"])
                after[m["z"]] = min(after.get(m["z"], way), way)
        ways.append({z: w[3] for z, w in after.items()})
        places = sorted(after, key=lambda z: after[z][1:3])
        tops = {z: (after[z][0], n) for n, z in enumerate(places)}
    cost, _, z = min((cost + INSERT * CLOSING[z], place, z) for z, (cost, place) in tops.items())
    path, more = [], CLOSING[z]
    for c, back in zip(reversed(chunks), reversed(ways), strict=True):
        path.append({"chunk": c["chunk"], "a": back[z], "z": z, "more": more})
        z, more = back[z], 0
    gaps = 0 if low is None else high - low + 1 - total["turns"]
    return {"gaps": gaps, **{k: v for k, v in total.items() if k != "turns"}, "cost": cost, "path": path}


def _folded(conversations: pa.Array) -> pa.Array:
    return pa.array([fold(c.as_py()) for c in conversations], _FOLDED)


def _applied(starts: pa.Array, audits: pa.Array, turns: pa.Array) -> pa.Array:
    out = [apply_audit(a.as_py(), s.as_py(), t.as_py()) for a, s, t in zip(starts, audits, turns, strict=True)]
    return pa.array(out, pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())])))


_FOLDED = pa.struct([(c.split()[0], pa.int64()) for c in SUMMARY.split(", ")] + [
    ("path", pa.list_(pa.struct([("chunk", pa.int64()), ("a", pa.int32()), ("z", pa.int32()), ("more", pa.int32())])))])


def repair(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The cheapest repair of every conversation, in pieces: ``conv_id, piece, audit, turns`` and its counts and cost.

    Turns are taken by turn (a null one first), then role and text; a null role or text counts as one space. A turn is
    blank (nothing but ASCII white space), or a duplicate (role and text were there before), or truncated (its last
    character is no ``.!?``). Blank turns and duplicates have to be deleted; Keep costs 0, Rerole to user or
    assistant 2, Delete 3, Insert of an empty one of them 2, a truncated turn that stays 1 more. The edits make the
    role initials ``(s?(ua)+)?``, ``audit`` has theirs in order; of equal cost the least audit in ASCII is taken.
    ``gaps`` counts turn numbers that are missing, ``illegal`` neighbours whose initials are not su, ua or au.
    Rows with a null conversation are one conversation, repeated rows are duplicates, an empty table gives an empty
    result, other columns are not looked at.

    Equal rows are counted before the shuffle. Rows are sorted by range, so that a conversation of any length is
    parsed by as many tasks as it fills; only a table of stacks for each of its chunks meets in one place.
    """
    base = turns.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("bigint").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    rows = base.groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies"))
    rows = rows.withColumn("body", F.md5(F.encode("text", "UTF-8"))).withColumn("known", F.col("turn").isNotNull())
    same = rows.groupBy("conv_id", "role", "body").agg(F.min(F.struct("known", "turn")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    same = same.select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("body").alias("b"), "first")
    marked = rows.join(same, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("body") == F.col("b")), "left")
    seen = F.coalesce(F.struct("known", "turn") > F.col("first"), F.lit(False))
    placed = marked.select("conv_id", "turn", "role", "text", "copies", seen.alias("seen"))
    order = ("conv_id", "turn", "role", "text")
    dealt = placed.repartitionByRange("conv_id", "turn", "role", F.md5(F.encode("text", "UTF-8"))).sortWithinPartitions(*order)
    kind = base.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, chunk bigint, head {_HEAD}, moves array<{_MOVE}>, turns array<{_TURN}>"
    chunks = stored(dealt.mapInArrow(_chunks(_arrow(schema)), schema), "repair-chunks")
    short = F.transform("moves", lambda m: F.struct(m["a"].alias("a"), m["z"].alias("z"), m["cost"].alias("cost"), m["place"].alias("place")))
    parts = chunks.select("conv_id", F.struct("chunk", "head", short.alias("moves")).alias("part"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    result = f"struct<{SUMMARY.replace(', ', ',').replace(' ', ':')},path:{_PATH}>"
    folded = whole.select("conv_id", F.arrow_udf(_folded, result)("parts").alias("f")).select("f.*")
    names = [c.split()[0] for c in SUMMARY.split(", ")]
    way = folded.select(*names, F.explode("path").alias("p")).select(*names, F.col("p.chunk").alias("piece"), "p.a", "p.z", "p.more")
    met = way.join(chunks, F.col("piece") == F.col("chunk"))
    move = F.get(F.filter("moves", lambda m: (m["a"] == F.col("a")) & (m["z"] == F.col("z"))), F.lit(0))
    edits = met.withColumn("audit", F.concat(move["audit"], F.repeat(F.lit("I"), F.col("more"))))
    kept = F.arrow_udf(_applied, "array<struct<role:string,text:string>>")("a", "audit", "turns")
    return edits.select("conv_id", "piece", *names, "audit", kept.alias("turns"))


def _summed(schema):
    """Audit and digest of every conversation, from its pieces in order; texts are hashed as they pass."""

    def run(batches):
        last, state, found = None, None, []
        for rows in batches:
            for r in rows.to_pylist():
                if state is None or last["conv_id"] != r["conv_id"]:
                    if state is not None:
                        found.append(done(last, *state))
                    state = (hashlib.sha256(), [], [False])
                last = r
                digest, audits, some = state
                audits.append(r["audit"])
                for t in r["turns"]:
                    digest.update(("\n" * some[0] + t["role"] + ":" + t["text"]).encode("utf-8", "surrogatepass"))
                    some[0] = True
            if found:
                yield pa.RecordBatch.from_pylist(found, schema=schema)
                found = []
        if state is not None:
            yield pa.RecordBatch.from_pylist([done(last, *state)], schema=schema)

    def done(row, digest, audits, _):
        return {**{n: row[n] for n in schema.names if n in row}, "audit": "".join(audits), "repaired_sha256": digest.hexdigest()}

    return run


def summary(pieces: DataFrame) -> DataFrame:
    """One row per repaired conversation: ``conv_id``, counts, cost, whole audit, and ``repaired_sha256``.

    The digest is of ``role:text`` of the repaired turns, joined by line feeds. A conversation's pieces pass one task in
    order, as its digest needs, but are never held there together.
    """
    kind = pieces.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {SUMMARY}, audit string, repaired_sha256 string"
    ordered = pieces.repartition("conv_id").sortWithinPartitions("conv_id", "piece")
    return ordered.mapInArrow(_summed(_arrow(schema)), schema)
