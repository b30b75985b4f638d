import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import dialogue

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
AFTER = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
NAMES = {"u": "user", "a": "assistant"}


def ordered(rows):
    """Rows (turn, role, text) of one conversation, nulls as a space."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).hexdigest()))


def brute(rows):
    """Least (cost, edits, lines) per last role, going forward and carrying whole strings."""
    rows, seen, faults = ordered(rows), set(), []
    for _, role, text in rows:
        visible = text.strip(" \t\n\x0b\x0c\r")
        faults.append("b" if not visible else "d" if (role, text) in seen else "-" if visible[-1] in ".!?" else "t")
        seen.add((role, text))

    def inserted(state):
        best = dict(state)
        for _ in range(4):
            for s, (cost, audit, lines) in list(best.items()):
                for x in "ua":
                    if x in AFTER[s]:
                        new = (cost + 2, audit + "I", (*lines, NAMES[x] + ":"))
                        if x not in best or new < best[x]:
                            best[x] = new
        return best

    state = {"": (0, "", ())}
    for (_, role, text), f in zip(rows, faults):
        after = {}

        def offer(s, new):
            if s not in after or new < after[s]:
                after[s] = new

        for s, (cost, audit, lines) in inserted(state).items():
            offer(s, (cost + 3, audit + "D", lines))
            if f in "-t":
                extra = f == "t"
                if role[:1] in AFTER[s]:
                    offer(AFTER[s][role[:1]], (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
                for x in "ua":
                    if x in AFTER[s]:
                        offer(x, (cost + 2 + extra, audit + "R", (*lines, f"{NAMES[x]}:{text}")))
        state = after
    cost, audit, lines = min(v for s, v in inserted(state).items() if s in ("", "a"))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, digest, lines


def made(rng, length):
    texts = ["Yes.", "No!", "What?", "cut off", " ", "", "\t\n", "Ends. \n", "a.b", "ü。", "."]
    roles = ["user"] * 5 + ["assistant"] * 5 + ["system", "system", "tool", "", None, "u", "Assistant"]
    turn = 0
    for _ in range(length):
        turn += rng.choice([0, 1, 1, 1, 1, 3])
        yield (None if rng.random() < 0.05 else turn, rng.choice(roles), None if rng.random() < 0.03 else rng.choice(texts) + rng.choice(["", "", str(rng.randrange(9)) + "."]))


def test_blocks_equal_brute_force():
    """The checkpointed program without Spark: blocks of any size give the same edits."""
    rng = random.Random(4)
    for _ in range(300):
        rows = ordered(made(rng, rng.randrange(1, 14)))
        want = brute(rows)
        seen, roles, faults = set(), "", ""
        for _, role, text in rows:
            visible = text.strip(dialogue.WHITE)
            faults += "b" if not visible else "d" if (role, text) in seen else "-" if visible[-1] in ".!?" else "t"
            seen.add((role, text))
            roles += role[:1] if role[:1] in ("s", "u", "a") else "x"
        for size in (1, 2, 5, 20):
            parts = [(roles[i : i + size], faults[i : i + size]) for i in range(0, len(roles), size)]
            vectors, cost = dialogue.checkpoints([dialogue.block_matrix(*p) for p in parts])
            state, audit = 0, ""
            for i, (p, v) in enumerate(zip(parts, vectors)):
                state, piece, front, fate = dialogue.walks(*p, v, i == len(parts) - 1, range(4))[state]
                assert len(front) == len(fate) + 1 == len(p[0]) + 1
                audit += piece
            assert (cost, audit) == want[5:7]


@pytest.mark.parametrize("size", [2, 7, None])
def test_equals_brute_force(spark, size):
    rng = random.Random(size or 0)
    by = {i: list(made(rng, rng.randrange(1, 25))) for i in range(40)}
    by[None] = list(made(rng, 30))
    by[-7] = list(made(rng, 400))
    rows = [(i, *r) for i, own in by.items() for r in own]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, SCHEMA).withColumns({"n": F.lit("x"), "c": F.lit(3), "block": F.lit(0), "r": F.lit("r")})
    ids = spark.createDataFrame([(i,) for i in by] + [(1000,)], "conv_id bigint")
    got = {r.conv_id: tuple(r)[1:] for r in dialogue.audited(df, ids, size).collect()}
    assert got.pop(1000) == (0, 0, 0, 0, 0, 0, "", hashlib.sha256().hexdigest())
    assert got == {i: brute(own)[:8] for i, own in by.items()}
    back = defaultdict(list)
    for r in sorted(dialogue.repaired(df, size).collect(), key=lambda r: r.place):
        back[r.conv_id].append(f"{r.role}:{r.text}")
    assert {i: tuple(back[i]) for i in by} == {i: brute(own)[8] for i, own in by.items()}
    for own in back.values():
        assert re.fullmatch("(s?(ua)+)?", "".join(x[:1] for x in own))


def test_long_text_and_many_equal_rows(spark):
    own = [(1, "user", "x" * 3_000_000 + "."), (2, "assistant", "Yes.")] + [(3, "user", "Again.")] * 500
    df = spark.createDataFrame([(1, *r) for r in own], SCHEMA)
    (got,) = dialogue.audited(df, df).collect()
    assert tuple(got)[1:] == brute(own)[:8] and got.duplicate == 499


def test_damage(spark):
    rows = [(c, t, r, "One. Two! Three?") for c in (1, 2, None) for t in [*range(40), None] for r in ("system", None)]
    got = sorted(map(tuple, dialogue.damaged(spark.createDataFrame(rows, SCHEMA).withColumn("k", F.lit(0))).collect()), key=str)
    want = []
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r = "user" if kind == 4 else " " if r is None else r
        x = "" if kind == 1 else re.sub("[.!?]", "", x) if kind == 2 else x
        want += [(c, t, r, x)] * {0: 0, 3: 2}.get(kind, 1)
    assert got == sorted(want, key=str)


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert dialogue.audited(none, none).collect() == [] and dialogue.repaired(none).collect() == []


def test_all_rows_lost(spark):
    ids = spark.createDataFrame([(5,), (5,), (None,)], "conv_id bigint")
    got = dialogue.audited(spark.createDataFrame([], SCHEMA), ids).collect()
    assert {r.conv_id for r in got} == {5, None} and all(r.audit == "" and r.cost == 0 for r in got) and len(got) == 2
