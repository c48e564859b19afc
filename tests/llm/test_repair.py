"""Repairs against a plain search over whole audits, whole and in blocks."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest

from tidemark.llm import queries, repair

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """(result without the id, repaired rows) of one conversation's (turn, role, text), by carrying
    the whole best audit of every state backward."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults, codes = set(), [], []
    for _, role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = "b" if not body else "d" if (role, text) in seen else "" if body[-1] in ".!?" else "t"
        seen.add((role, text))
        faults.append(fault)
    follow = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    forced = {0: 2, 1: 2, 2: 3, 3: 2}
    name = {2: "user", 3: "assistant"}

    def opened(best):
        """With inserts in front, until nothing gets better."""
        for _ in range(4):
            best = {s: min(best[s], (best[forced[s]][0] + 3, "I" + best[forced[s]][1], ((name[forced[s]], ""), *best[forced[s]][2])))
                    for s in best}
        return best
    best = opened({0: (0, "", ()), 1: (1 << 30, "", ()), 2: (1 << 30, "", ()), 3: (0, "", ())})
    for (_, role, text), fault in reversed([*zip(rows, faults)]):
        new = {}
        for s in range(4):
            c, a, t = best[s]
            ways = [(c + 4, "D" + a, t)]
            if fault not in ("b", "d"):
                extra = 3 if fault == "t" else 0
                if role[:1] in follow[s]:
                    c, a, t = best[follow[s][role[:1]]]
                    ways.append((c + extra, "K" + a, ((role, text), *t)))
                c, a, t = best[forced[s]]
                ways.append((c + extra + 3, "R" + a, ((name[forced[s]], text), *t)))
            new[s] = min(ways, key=lambda w: w[:2])
        best = opened(new)
    turns = {r[0] for r in rows if r[0] is not None}
    wrong = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, out = best[0]
    sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            wrong, cost, audit, sha), list(out)


def made(seed, convs=12, most=14):
    rnd = random.Random(seed)
    out = []
    for c in range(convs):
        for _ in range(rnd.randrange(1, most)):
            out.append((c, rnd.choice([None, *range(8)]), rnd.choice(["user", "assistant", "system", "tool", "", "u", "a2"]),
                        rnd.choice(["Yes.", "No", "", " \n", "Ok!", "what?  ", "wh ", "é."]) + rnd.choice(["", "x", "."])))
    return out


@pytest.mark.parametrize("rows_a_block", [1, 3, 1 << 14])
def test_against_plain(spark, monkeypatch, rows_a_block):
    monkeypatch.setattr(repair, "BLOCK_ROWS", rows_a_block)
    rows = made(rows_a_block) + [(99, t, "user" if t % 2 else "assistant", f"{t % 7}." if t % 5 else "cut") for t in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: repair.F.lit(1) for c in ("pid", "block", "made")})
    got = {r[0]: tuple(r)[1:] for r in repair.repair(df.repartition(3)).collect()}
    out = {}
    for r in repair.repaired(df).collect():
        out.setdefault(r.conv_id, []).append((r.position, r.role, r.text))
    assert len(got) == 13
    for c, group in groupby(sorted(rows, key=lambda r: r[0]), key=lambda r: r[0]):
        expect, lines = plain([r[1:] for r in group])
        assert got[c] == expect, c
        assert [x[1:] for x in sorted(out.get(c, []))] == lines
        assert [x[0] for x in sorted(out.get(c, []))] == list(range(len(lines)))


def test_walk_keeps_few_vectors_and_blocks_join():
    rnd = random.Random(5)
    edits = repair.Edits()
    for n in (0, 1, 2, 10, 101, 1000):
        codes = bytes(rnd.choice([0, 1, 2, 3, 4, 5, 6, 8, 9]) for _ in range(n))
        front, total = edits.cost(codes, repair.END)
        each, state = edits.walk(codes, repair.END, 0)
        spent = sum({"D": 4, "I": 3, "K": 0, "R": 3}[x] for e in [*each, repair.tail(state)] for x in e)
        spent += 3 * sum(bool(c & 4) and e[-1] != "D" for c, e in zip(codes, each))
        assert spent == front[0] + total
        half = n // 2
        m, vector = edits.matrix(codes[half:]), repair.END
        vector = tuple(min(m[4 * s + t] + vector[t] for t in range(4)) for s in range(4))
        first, exit_state = edits.walk(codes[:half], vector, 0)
        rest, last = edits.walk(codes[half:], repair.END, exit_state)
        assert first + rest == each and last == state


def test_query_damages_as_the_contract_says(spark, tmp_path):
    rnd = random.Random(8)
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None]), rnd.choice(["A b.", "c? d", None, "x."]))
            for c in [*range(40), None] for t in [*range(rnd.randrange(1, 6)), None]]
    only = next(c for c in range(100, 5000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((only, 0, "user", "Dropped."))
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    damaged = {c: [] for c, *_ in rows}
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = "user" if k == 4 else role, "" if k == 1 else "".join(x for x in text if x not in ".!?") if k == 2 else text
        damaged[c] += [(t, role, text)] * {0: 0, 3: 2}.get(k, 1)
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    assert got == {c: plain(group)[0] for c, group in damaged.items()}
    assert got[only] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())


def test_long_texts_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(repair, "BLOCK_CHARS", 1000)
    rows = [(1, t, "user" if t % 2 == 0 else "assistant", "x" * 700 + f"{t}.") for t in range(9)] + [(2, 0, "assistant", "y" * 5000)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.conv_id: tuple(r)[1:] for r in repair.repair(df).collect()}
    assert got == {c: plain([r[1:] for r in rows if r[0] == c])[0] for c in (1, 2)}
    assert repair.repair(df.limit(0)).collect() == [] == repair.repaired(df.limit(0)).collect()
