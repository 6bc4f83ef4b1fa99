"""Conversation repair: the cheapest edits that give a legal sequence of roles, by forward and backward costs.

A conversation's rows are read by turn. Legal are the role initials ``(s?(ua)+)?``, an automaton of four states. Edits keep a
row, give it the role user or assistant, delete it, or insert an empty user or assistant row; rows that are blank or repeat an
earlier role and text must go, and an undeleted row that doesn't end in ``.``, ``!`` or ``?`` costs extra. Nodes are (rows
read, state), arcs are edits. Minimum costs from the start and to the end name all arcs of cheapest paths (the tight ones);
a walk over tight arcs takes, with the set of nodes it has reached, the least letter at each step, which gives the ASCII-least
of all cheapest edit strings. A letter and a state fix the next state, so that string also fixes the repaired rows.

Equal rows of a turn are collapsed to one with its number first (all but one repeat it). Rows are then dealt by ranges of
conversation and turn and worked a partition at a time. A conversation that ranges cut is joined by min-plus algebra: each
piece has a 4 by 4 matrix of costs from any state to any, the driver puts these in a row (two pieces a partition at most),
and so each piece knows the cost before and after it and the state in which the walk enters; no task holds more than
one piece. Only the digest, a SHA-256 of one text, reads such a conversation in order in one task, as a stream.

Defined cases: a null role or text counts as one space (so it can't be kept as it is, and it is blank); a null turn comes
first; rows of one turn are ordered by role, first characters and hash of the text. A null conversation id is one
conversation. An empty role has no initial. An empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidora.llm.common import cut, hold

#: Costs of the edits, and the states 0 start, 1 after system, 2 after user, 3 after assistant.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
OK, BLANK, DUPLICATE, CUT_OFF = range(4)
_NEVER = float("inf")
_START, _END = (0, _NEVER, _NEVER, _NEVER), (0, _NEVER, _NEVER, 0)
_USER, _ASSISTANT = {0: 2, 1: 2, 3: 2}, {2: 3}
_KEEP, _ADD = {"s": {0: 1}, "u": _USER, "a": _ASSISTANT}, _USER | _ASSISTANT
_ROLES = {"2": "user", "3": "assistant"}
_LEGAL = {"su", "ua", "au"}
#: Text and rows in one partition, about.
PIECE_BYTES, PIECE_ROWS = 32 << 20, 200_000

Costs = tuple[float, float, float, float]
Row = tuple[str, int, int]  # initial of the role, fault, copies


@lru_cache(4096)
def _arcs(row: Row) -> list[tuple[str, dict[int, int], int]]:
    """The edits that read a row: letter, moves between states, cost."""
    initial, fault, copies = row
    more = DELETE * (copies - 1)
    gone = ("D", {q: q for q in range(4)}, DELETE + more)
    if fault in (BLANK, DUPLICATE):
        return [gone]
    more += TRUNCATED * (fault == CUT_OFF)
    return [gone, ("K", _KEEP.get(initial, {}), more), ("R", _ADD, REROLE + more)]


def _inserted(f: Costs) -> Costs:
    """Costs from the start when rows may be inserted too."""
    two = min(f[2], min(f[0], f[1], f[3]) + INSERT)
    return f[0], f[1], two, min(f[3], two + INSERT)


def _inserting(b: Costs) -> Costs:
    """Costs to the end when rows may be inserted first."""
    two = min(b[2], b[3] + INSERT)
    three = min(b[3], two + INSERT)
    return min(b[0], two + INSERT), min(b[1], two + INSERT), two, three


def _advance(f: Costs, row: Row) -> Costs:
    """Costs after a row from those before it."""
    out, f = [_NEVER] * 4, _inserted(f)
    for _, moves, cost in _arcs(row):
        for q, to in moves.items():
            out[to] = min(out[to], f[q] + cost)
    return tuple(out)


def matrix(rows: Iterator[Row]) -> list[Costs]:
    """Least costs from each state before ``rows`` to each state after them, insertions before each row included."""
    costs = [tuple(0 if q == k else _NEVER for q in range(4)) for k in range(4)]
    for row in rows:
        costs = [_advance(f, row) for f in costs]
    return costs


def walk(rows: tuple[Row, ...], before: Costs, after: Costs, entered: frozenset[int], last: bool) -> tuple[list[str], list[str], frozenset[int]]:
    """For each row the letters of its edits and the states they lead to, and the states at the end.

    ``before`` and ``after`` are the costs from the start to the first row and from the last row to the end, ``entered``
    the states in which the walk comes in; insertions behind the ``last`` row are told with it.
    """
    forth, back = [before], [_inserting(after)]
    for row in rows:
        forth.append(_advance(forth[-1], row))
    forth = [_inserted(f) for f in forth]
    for row in reversed(rows):
        b = [_NEVER] * 4
        for _, moves, cost in _arcs(row):
            for q, to in moves.items():
                b[q] = min(b[q], cost + back[-1][to])
        back.append(_inserting(tuple(b)))
    back.reverse()
    least = min(f + b for f, b in zip(forth[0], back[0], strict=True))
    letters, states, there = [], [], entered

    def step(i: int, edits: list) -> tuple[str, frozenset[int]]:
        """The least letter on a tight arc out of the states reached, and where it leads."""
        found: dict[str, set[int]] = {}
        for letter, moves, cost, row in edits:
            for q in there:
                if q in moves and forth[i][q] + cost + back[i + row][moves[q]] == least:
                    found.setdefault(letter, set()).add(moves[q])
        letter = min(found)
        return letter, frozenset(found[letter])

    insert = ("I", _ADD, INSERT, 0)
    for i, row in enumerate(rows):
        edits, own, to, letter = [insert, *((*arc, 1) for arc in _arcs(row))], "", "", "I"
        while letter == "I":
            letter, there = step(i, edits)
            own, to = own + letter, to + str(min(there))
        letters.append(own)
        states.append(to)
    while last and not any(_END[q] == 0 and forth[-1][q] == least for q in there):
        _, there = step(len(rows), [insert])
        letters[-1] += "I"
        states[-1] += str(min(there))
    return letters, states, there


@lru_cache(1 << 16)
def _alone(rows: tuple[Row, ...]) -> tuple[list[str], list[str]]:
    """Letters and states of a whole conversation; short ones have few patterns."""
    return walk(rows, _START, _END, frozenset([0]), True)[:2]


def faults(text: Column) -> Column:
    """BLANK, CUT_OFF or OK by the text alone."""
    ending = F.right(F.rtrim(text, F.lit(" \t\n\x0b\x0c\r")), F.lit(1))
    return F.when(ending == "", BLANK).when(ending.isin(".", "!", "?"), OK).otherwise(CUT_OFF)


def _ordered(rows: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """Distinct rows with copies and fault, dealt and sorted by conversation and turn; ``part`` is the partition."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    slim = rows.select(F.col(conv).alias("conv"), F.col(turn).cast("long").alias("turn"), blank(role).alias("role"), blank(text).alias("text"))
    body = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    distinct = cut(slim.groupBy("conv", "turn", "role", "text").agg(F.count("*").alias("copies")).select("*", body.alias("body"), faults(F.col("text")).alias("own")))
    at = F.struct(F.col("turn").isNotNull(), F.col("turn"))
    again = distinct.filter(F.col("own") != BLANK).groupBy("conv", "body").agg(F.min(at).alias("first"), F.count("*").alias("of")).filter("of > 1")
    again = again.select(F.col("conv").alias("_conv"), F.col("body").alias("_body"), "first")
    joined = distinct.join(again, F.col("conv").eqNullSafe(F.col("_conv")) & (F.col("body") == F.col("_body")), "left")
    known = joined.select("conv", "turn", "role", "text", "copies", F.when((F.col("own") != BLANK) & (at > F.col("first")), DUPLICATE).otherwise(F.col("own")).alias("fault"))
    count, size = distinct.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    parts = max(-(-(size or 0) // PIECE_BYTES), -(-count // PIECE_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, count // 1000), 1)
    keys = [F.col("conv"), F.col("turn"), F.left("role", F.lit(64)), F.left("text", F.lit(64)), F.xxhash64("role", "text")]
    return cut(known.repartitionByRange(int(parts), *keys).sortWithinPartitions(*keys, "role", "text").withColumn("part", F.spark_partition_id()))


def _initial() -> Column:
    return F.left("role", F.lit(1)).alias("initial")


def _pieces(batches, columns: int) -> Iterator:
    """The Arrow rows of each conversation in turn, from sorted batches whose first column it is, cut to ``columns``."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
        own = table.column(0).combine_chunks()
        same = pc.equal(own[1:], own[:-1])  # null where one of them is
        both = pc.and_(pc.is_null(own[1:]), pc.is_null(own[:-1]))
        new = pc.invert(pc.or_(pc.fill_null(same, False), both)).to_numpy(zero_copy_only=False)
        edges = [0, *(np.flatnonzero(new) + 1).tolist()]
        for start, stop in zip(edges, edges[1:], strict=False):
            yield table.slice(start, stop - start)
        held = table.slice(edges[-1])
    if held is not None:
        yield held


def _contexts(ordered: DataFrame) -> dict:
    """By (part, conversation), for conversations that ranges cut: costs before and after, states entered, whether it is the last piece."""
    spans = ordered.groupBy("conv").agg(F.min("part").alias("a"), F.max("part").alias("b")).filter("a < b").select(F.col("conv").alias("_conv"))
    spans = cut(spans)  # one a partition at most
    light = ordered.join(F.broadcast(spans), F.col("conv").eqNullSafe(F.col("_conv")), "left_semi").select("conv", "part", _initial(), "fault", "copies")
    kind = light.schema["conv"].dataType.simpleString()

    def told(known: dict):
        """One row a piece: its matrix or, where the costs around it are ``known``, the states that each entered state leads to."""
        def run(batches):
            import pyarrow as pa

            hold("conversations")
            for piece in _pieces(batches, 5):
                conv, part = piece.column("conv")[0].as_py(), piece.column("part")[0].as_py()
                rows = tuple(zip(*(piece.column(c).to_pylist() for c in ("initial", "fault", "copies")), strict=True))
                if known:
                    before, after, last = known[part, conv]
                    fine = [q for q in range(4) if _reaches(rows, before, after, q)]
                    costs = [float(min(walk(rows, before, after, frozenset([q]), last)[2])) if q in fine else -1.0 for q in range(4)]
                else:
                    costs = [float(c) for f in matrix(iter(rows)) for c in f]
                yield pa.RecordBatch.from_arrays([piece.column("conv").slice(0, 1).combine_chunks(), pa.array([part], pa.int32()), pa.array([costs], pa.list_(pa.float64()))], ["conv", "part", "costs"])

        return light.mapInArrow(run, f"conv {kind}, part int, costs array<double>").collect()  # two rows a partition at most

    found: dict = {}
    for r in told({}):
        found.setdefault(r.conv, []).append((r.part, [tuple(r.costs[4 * k : 4 * k + 4]) for k in range(4)]))
    known = {}
    for conv, pieces in found.items():
        pieces.sort()
        before, after = [_START], [_END]
        for _, m in pieces:
            before.append(tuple(min(before[-1][x] + m[x][y] for x in range(4)) for y in range(4)))
        for _, m in reversed(pieces):
            end = _inserting(after[-1])
            after.append(tuple(min(m[x][y] + end[y] for y in range(4)) for x in range(4)))
        for k, (part, _) in enumerate(pieces):
            known[part, conv] = before[k], after[len(pieces) - 1 - k], k + 1 == len(pieces)
    contexts, entered = {}, {}
    for r in sorted(told(known), key=lambda r: r.part) if known else []:
        state = entered.get(r.conv, 0)
        contexts[r.part, r.conv] = (*known[r.part, r.conv][:2], frozenset([state]), known[r.part, r.conv][2])
        entered[r.conv] = int(r.costs[state])
    return contexts


def _reaches(rows: tuple[Row, ...], before: Costs, after: Costs, state: int) -> bool:
    """Whether a cheapest path goes through ``state`` before ``rows``."""
    def least(f: Costs) -> float:
        for row in rows:
            f = _advance(f, row)
        return min(a + b for a, b in zip(_inserted(f), _inserting(after), strict=True))

    return before[state] + least(tuple(0 if q == state else _NEVER for q in range(4))) == least(before)


def edits(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The distinct rows of every conversation in order, with the edits of each.

    conv, turn, role, text, copies, fault, part and seq (the order within a conversation), spans (whether other parts hold
    rows of it too), edits (insertions, then the row's own letter, then insertions at the end of the conversation;
    further copies are deleted) and states (one digit a letter: what it leads to).
    """
    ordered = _ordered(rows, conv, turn, role, text)
    contexts = rows.sparkSession.sparkContext.broadcast(_contexts(ordered))
    schema = ordered.schema
    names = ["conv", "turn", "role", "text", "copies", "fault", "part"]

    def run(batches):
        import pyarrow as pa

        hold("conversations", _alone.cache_clear)
        known, at, ready, waiting = contexts.value, 0, [], 0

        def flushed():
            whole = pa.concat_tables([t for t, *_ in ready]).select(names)
            letters, states, spans = ([x for r in ready for x in r[k]] for k in (1, 2, 3))
            extra = [pa.array(range(at, at + whole.num_rows), pa.int64()), pa.array(spans, pa.bool_()), pa.array(letters, pa.string()), pa.array(states, pa.string())]
            for name, column in zip(("seq", "spans", "edits", "states"), extra, strict=True):
                whole = whole.append_column(name, column)
            return whole.combine_chunks().to_batches()

        for piece in _pieces(batches, 8):
            own = tuple(zip(*(piece.column(c).to_pylist() for c in ("initial", "fault", "copies")), strict=True))
            around = known.get((piece.column("part")[0].as_py(), piece.column("conv")[0].as_py())) if known else None
            solve = _alone if len(own) <= 64 else _alone.__wrapped__
            letters, states = walk(own, *around)[:2] if around else solve(own)
            ready.append((piece, letters, states, [around is not None] * len(own)))
            waiting += len(own)
            if waiting >= 4096:
                yield from flushed()
                at, ready, waiting = at + waiting, [], 0
        if ready:
            yield from flushed()

    kinds = {f.name: f.dataType.simpleString() for f in schema}
    made = ", ".join(f"{n} {kinds[n]}" for n in names) + ", seq long, spans boolean, edits string, states string"
    return ordered.select("conv", "turn", "role", "text", "copies", "fault", "part", _initial()).mapInArrow(run, made)


def repaired(edited: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv, part, seq, step (their order), turn (null where inserted), role and text."""
    split = F.filter(F.split("edits", ""), lambda x: x != "")
    steps = F.transform(split, lambda x, i: F.struct(i.alias("step"), x.alias("letter"), F.substring("states", i + 1, F.lit(1)).alias("to")))
    one = edited.select("conv", "part", "seq", "turn", F.col("role").alias("_role"), F.col("text").alias("_text"), F.explode(F.filter(steps, lambda x: x["letter"] != "D")).alias("x"))
    added, kept = F.col("x.letter") == "I", F.col("x.letter") == "K"
    return one.select("conv", "part", "seq", "x.step", F.when(~added, F.col("turn")).alias("turn"),
                      F.when(kept, F.col("_role")).when(F.col("x.to") == "2", "user").otherwise("assistant").alias("role"), F.when(added, "").otherwise(F.col("_text")).alias("text"))


_DIGEST = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_COST = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}


def _digests(batches, kind):
    """One row a conversation, from sorted rows; holds its audit, but no texts."""
    import pyarrow as pa

    hold("conversations")
    names, ready = [x.split()[0] for x in _DIGEST.split(", ")], []
    kinds = [pa.int64()] * 6 + [pa.string()] * 2

    def flushed(convs):
        columns = [pa.array(c, t) for c, t in zip(zip(*ready, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(convs, kind), *columns], ["conv", *names])

    now, convs = None, []

    def close():
        low, high, of = now["turns"]
        ready.append((high - low + 1 - of if of else 0, *now["faults"][1:], now["illegal"], now["cost"], "".join(now["audit"]), now["hash"].hexdigest()))
        convs.append(now["conv"])

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            for conv, turn, role, text, copies, fault, letters, states in zip(*(rows.column(c).to_pylist() for c in ("conv", "turn", "role", "text", "copies", "fault", "edits", "states")), strict=True):
                if now is None or now["conv"] != conv:
                    if now:
                        close()
                    now = {"conv": conv, "turns": (0, 0, 0), "last": None, "faults": [0, 0, 0, 0], "illegal": 0, "cost": 0, "audit": [], "hash": hashlib.sha256(), "some": False}
                if turn is not None:
                    low, high, of = now["turns"]
                    now["turns"] = (turn, turn, 1) if not of else (low, turn, of + (turn != high))
                initial = role[:1]
                now["illegal"] += (now["last"] is not None and now["last"] + initial not in _LEGAL) + copies - 1
                now["last"] = initial
                now["faults"][fault] += 1
                now["faults"][BLANK if fault == BLANK else DUPLICATE] += copies - 1
                own = len(letters) - len(letters.lstrip("I")) + 1
                now["audit"] += [letters[:own], "D" * (copies - 1), letters[own:]]
                now["cost"] += sum(_COST[x] for x in letters) + DELETE * (copies - 1) + TRUNCATED * (fault == CUT_OFF and letters[own - 1] != "D")
                for letter, to in zip(letters, states, strict=True):
                    if letter != "D":
                        said = f"{role if letter == 'K' else _ROLES[to]}:{'' if letter == 'I' else text}"
                        now["hash"].update((("\n" if now["some"] else "") + said).encode())
                        now["some"] = True
        if len(ready) >= 4096:
            yield flushed(convs)
            ready, convs = [], []
    if now:
        close()
        yield flushed(convs)


def report(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", among: DataFrame | None = None) -> DataFrame:
    """One row for each conversation of ``among`` (``rows`` itself unless given): its faults, the least cost, the edits and the digest.

    A conversation of ``among`` without ``rows`` has zeros, an empty audit and the hash of an empty text.
    """
    edited = cut(edits(rows, conv, turn, role, text))
    kind, held = edited.schema["conv"].dataType.simpleString(), ["conv", "turn", "role", "text", "copies", "fault", "edits", "states"]

    def run(batches):
        import pyarrow as pa

        first = next(batches, None)
        if first is not None:
            yield from _digests((b for group in ([first], batches) for b in group), first.schema.field("conv").type)

    told = lambda df: df.select(*held).mapInArrow(run, f"conv {kind}, {_DIGEST}")
    whole = told(edited.filter("NOT spans"))
    cuts = told(edited.filter("spans").repartition("conv").sortWithinPartitions("conv", "part", "seq"))
    done = whole.union(cuts).withColumnRenamed("conv", "_conv")
    every = (rows if among is None else among).select(F.col(conv).alias("conv")).distinct()
    numbers, nothing = [x.split()[0] for x in _DIGEST.split(", ")][:6], hashlib.sha256().hexdigest()
    joined = every.join(done, F.col("conv").eqNullSafe(F.col("_conv")), "left")
    return joined.select(F.col("conv").alias(conv), *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"))
