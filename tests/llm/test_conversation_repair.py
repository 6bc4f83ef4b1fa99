import hashlib
import itertools
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from evidora.llm import conversation_repair as cr
from evidora.llm import queries

SCHEMA = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")
COST = {"K": 0, "R": 3, "D": 4, "I": 3}


def fault_of(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = BLANK.findall(text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def brute(rows):
    """cost, audit, repaired rows: by suffixes, each state's best (cost, audit) from the end."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    states, faults = ["", "s", "u", "a"], fault_of(rows)
    none = (float("inf"), "", [])

    def relax(best):
        for _ in range(4):
            for q in states:
                for r in ("user", "assistant"):
                    if (to := step.get((q, r[0]))) is not None and best[to][0] < float("inf"):
                        best[q] = min(best[q], (best[to][0] + 3, "I" + best[to][1], [(r, ""), *best[to][2]]))
        return best

    best = relax({q: (0, "", []) if q in ("", "a") else none for q in states})
    for (role, text), fault in reversed(list(zip(rows, faults, strict=True))):
        now = {}
        for q in states:
            own = [(best[q][0] + 4, "D" + best[q][1], best[q][2])]
            if fault not in ("blank", "duplicate"):
                for r, letter, cost in ((role, "K", 0), ("user", "R", 3), ("assistant", "R", 3)):
                    if (to := step.get((q, r[:1]))) is not None:
                        own.append((best[to][0] + cost + 3 * (fault == "truncated"), letter + best[to][1], [(r, text), *best[to][2]]))
            now[q] = min(own)
        best = relax(now)
    return best[""]


def expected(rows):
    """The whole report of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    turns = [r[0] for r in rows if r[0] is not None]
    said, (cost, audit, fixed) = [r[1:] for r in rows], brute([r[1:] for r in rows])
    faults = fault_of(said)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(said))
    text = "\n".join(f"{r}:{t}" for r, t in fixed)
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest()


def all_expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    return {conv: expected(own) for conv, own in convs.items()}


def got(frame):
    return {r[0]: tuple(r)[1:] for r in frame.collect()}


def some(rng, count, rows, roles=("user", "assistant", "system", "user", "assistant", "tool", "", None)):
    texts = ["Yes.", "No!", "why?", "so ", "cut off", "", " \n", None, "Über 😀.", "a.b", "end. \t"]
    return [(c, rng.choice([None, *range(8)]), rng.choice(roles), rng.choice(texts)) for c in range(count) for _ in range(rng.randint(1, rows))]


@pytest.mark.parametrize("size", [3, 9])
def test_same_as_brute_force(spark, size):
    rows = some(random.Random(size), 150, size)
    rows += [(None, t, r, "Fine.") for t, r in enumerate(("user", "assistant"))]
    assert got(cr.report(spark.createDataFrame(rows, SCHEMA).repartition(5))) == all_expected(rows)


def test_one_conversation_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(cr, "PIECE_ROWS", 40)
    rng = random.Random(2)
    rows = [(k % 7 if k % 3 else 7, k, rng.choice(("user", "assistant", "assistant", "system")), rng.choice((f"text {k}.", f"text {k}", "same.", ""))) for k in range(900)]
    rows += [(8, None, "user", f"{k % 90}.") for k in range(300)]
    edited = cr.edits(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert edited.filter("spans").select("part").distinct().count() > 10
    assert got(cr.report(spark.createDataFrame(rows, SCHEMA).repartition(4))) == all_expected(rows)


def test_repaired_rows(spark):
    rows = some(random.Random(8), 60, 6)
    edited = cr.edits(spark.createDataFrame(rows, SCHEMA))
    fixed = {}
    for r in sorted(cr.repaired(edited).collect(), key=lambda r: (r.part, r.seq, r.step)):
        fixed.setdefault(r.conv, []).append(f"{r.role}:{r.text}")
    for conv, want in all_expected(rows).items():
        text = "\n".join(fixed.get(conv, []))
        assert hashlib.sha256(text.encode()).hexdigest() == want[-1]
        assert re.fullmatch("(s?(ua)+)?", "".join(line[0] for line in fixed.get(conv, [])))


def test_query_damages_by_checksum(spark, tmp_path):
    rows = some(random.Random(9), 200, 8, ("user", "assistant", "system")) + [(None, 1, "user", "a."), (None, None, None, None)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    left = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        left += [(conv, turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    want = all_expected(left)
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got(queries.op11_conversation_repair(spark, str(tmp_path))) == {conv: want.get(conv, nothing) for conv, *_ in rows}


def test_empty_repeated_long_and_clashing_names(spark):
    from pyspark.sql import functions as F

    none = cr.report(spark.createDataFrame([], SCHEMA))
    assert none.collect() == [] and none.columns[-2:] == ["audit", "repaired_sha256"]
    rows = [(1, 0, "user", "word " * 40_000 + "."), (1, 1, "assistant", "Yes.")] * 3
    wide = spark.createDataFrame(rows, SCHEMA).select("*", *[F.lit(7).alias(c) for c in ("conv", "part", "seq", "copies", "fault", "edits", "states", "body", "_conv", "cost", "initial")])
    assert got(cr.report(wide)) == all_expected(rows)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "tool"]), st.sampled_from(["Yes.", "no", "", "So!"])), max_size=3))
def test_walk_against_all_scripts(rows):
    """Every edit script of up to four insertions, kept where its roles match the pattern."""
    faults, found = fault_of(rows), []

    def scripts(i, inserted, letters, roles, cost):
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            found.append((cost, letters))
        if inserted < 4:
            for r in "ua":
                scripts(i, inserted + 1, letters + "I", roles + r, cost + 3)
        if i < len(rows):
            scripts(i + 1, inserted, letters + "D", roles, cost + 4)
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                scripts(i + 1, inserted, letters + "K", roles + rows[i][0][0], cost + more)
                for r in "ua":
                    scripts(i + 1, inserted, letters + "R", roles + r, cost + 3 + more)

    scripts(0, 0, "", "", 0)
    names = {"blank": cr.BLANK, "duplicate": cr.DUPLICATE, "truncated": cr.CUT_OFF, "": cr.OK}
    if rows:
        letters, _, there = cr.walk(tuple((r[0], names[f], 1) for (r, _), f in zip(rows, faults, strict=True)), cr._START, cr._END, frozenset([0]), True)
        assert "".join(letters) == min(found)[1] and len(there) == 1
    assert brute(rows)[:2] == min(found)
