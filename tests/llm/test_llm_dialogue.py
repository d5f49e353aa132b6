import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from wardflow.llm import dialogue
from wardflow.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
GOAL = re.compile(r"(s?(ua)+)?")


def faults(rows):
    """Per row: blank, duplicate, truncated or None."""
    out, seen = [], set()
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\x0c\r")
        fault = ("blank" if not body else "duplicate" if (role, text) in seen
                 else "truncated" if body[-1] not in ".!?" else None)
        seen.add((role, text))
        out.append(fault)
    return out


def best(rows, costs=dialogue.Costs()):
    """Least (cost, audit) and repaired rows, over whole prefixes kept per role written last."""
    at = {"": (0, "", ())}
    marks = faults(rows)

    def better(table, roles, option):
        # Roles written are judged by their last letter; a system row only at the beginning.
        key = roles[-1:]
        if key not in table or option[:2] < table[key][:2]:
            table[key] = option

    def grown(table):
        for _ in range(2):
            for key, (cost, audit, kept) in list(table.items()):
                new = "a" if key == "u" else "u"
                option = (cost + costs.insert, audit + "I", (*kept, ({"u": "user", "a": "assistant"}[new], "")))
                better(table, new, option)
        return table

    for (role, text), fault in zip(rows, marks, strict=True):
        now = {}
        for key, (cost, audit, kept) in grown(at).items():
            better(now, key, (cost + costs.delete, audit + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            cut = costs.truncated * (fault == "truncated")
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[key]
            if role[:1] and role[0] in legal:
                better(now, role[0], (cost + cut, audit + "K", (*kept, (role, text))))
            new = "assistant" if key == "u" else "user"
            better(now, new[0], (cost + costs.rerole + cut, audit + "R", (*kept, (new, text))))
        at = now
    return min((v for k, v in grown(at).items() if k in ("", "a")), key=lambda v: v[:2])


def by_enumeration(rows, costs=dialogue.Costs()):
    """Least (cost, audit) of all edit strings, inserting up to two rows at each place."""
    marks, found = faults(rows), []
    inserts = ["", "u", "a", "ua", "au"]
    options = []
    for (role, _), fault in zip(rows, marks, strict=True):
        cut = fault == "truncated"
        own = [("D", "", costs.delete)]
        if fault not in ("blank", "duplicate"):
            own += [("K", role[:1] or "?", cut), ("R", "u", costs.rerole + cut), ("R", "a", costs.rerole + cut)]
        options += [[("I" * len(x), x, costs.insert * len(x)) for x in inserts], own]
    options.append([("I" * len(x), x, costs.insert * len(x)) for x in inserts])
    for pick in itertools.product(*options):
        if GOAL.fullmatch("".join(p[1] for p in pick)):
            found.append((sum(p[2] for p in pick), "".join(p[0] for p in pick)))
    return min(found)


def random_rows(rng, n):
    texts = ["Yes.", "No", "  ", "Why?", "So!", "x.", "y.", "z", "w."]
    roles = ["user"] * 4 + ["assistant"] * 4 + ["system", "tool", "", " "]
    return [(rng.choice(roles), rng.choice(texts) if rng.random() < 0.4 else f"{i}.") for i in range(n)]


def codes(rows):
    out = []
    for (role, _), fault in zip(rows, faults(rows), strict=True):
        c = "sua".find(role[0]) if role else -1
        c = dialogue.OTHER if c < 0 else c
        out.append(c | {"blank": 4, "duplicate": 4, "truncated": 8}.get(fault, 0))
    return out


def solve(rows, costs=dialogue.Costs(), block=dialogue.BLOCK):
    solver = dialogue.Solver(costs, block)
    for c in codes(rows):
        solver.add(c)
    return solver.end()


def test_equal_to_all_edit_strings():
    rng = random.Random(3)
    for _ in range(60):
        rows = random_rows(rng, rng.randint(0, 3))
        assert best(rows)[:2] == by_enumeration(rows) == solve(rows)


@pytest.mark.parametrize("costs", [dialogue.Costs(), dialogue.Costs(1, 1, 1, 0), dialogue.Costs(5, 2, 3, 4),
                                   dialogue.Costs(1, 6, 4, 1)])
def test_equal_to_best_prefixes_also_in_blocks(costs):
    rng = random.Random(4)
    for n in [*range(1, 40), 150, 300]:
        rows = random_rows(rng, n)
        expected = best(rows, costs)[:2]
        assert solve(rows, costs) == expected
        assert solve(rows, costs, block=7) == expected
        assert solve(rows, costs, block=1) == expected


def test_bounds_never_exceed_the_best():
    rng = random.Random(6)
    for _ in range(200):
        rows = random_rows(rng, rng.randint(1, 9))
        assert dialogue._Bounds(bytes(codes(rows)), dialogue.Costs(), True)(0, dialogue.START) <= best(rows)[0]


def test_long_conversations_take_few_nodes():
    rng = random.Random(8)
    rows = [(("user", "assistant")[i % 2] if rng.random() < 0.9 else "user", f"{i}.") for i in range(20_000)]
    cost, audit = solve(rows)
    assert (cost, audit) == best_long(rows)


def best_long(rows):
    """As ``best`` without the rows themselves."""
    at = {"": (0, "")}
    for role, _ in rows:
        for _ in range(2):
            for key, (c, a) in list(at.items()):
                new = "a" if key == "u" else "u"
                at[new] = min(at.get(new, (1 << 60, "")), (c + 2, a + "I"))
        now = {}
        for key, (c, a) in at.items():
            for new, option in ((key, (c + 3, a + "D")), ("a" if key == "u" else "u", (c + 2, a + "R"))):
                now[new] = min(now.get(new, (1 << 60, "")), option)
            if role[0] in {"": "su", "s": "u", "u": "a", "a": "u"}[key]:
                now[role[0]] = min(now.get(role[0], (1 << 60, "")), (c, a + "K"))
        at = now
    return min(v for v in (at["a"], (at["u"][0] + 2, at["u"][1] + "I")))


def expected_report(rows):
    """rows: (turn, role, text) of one conversation, in order."""
    pairs = [(r or "", t or "") for _, r, t in rows]
    turns = [t for t, _, _ in rows if t is not None]
    marks = faults(pairs)
    cost, audit, kept = best(pairs)
    initials = [r[:1] for r, _ in pairs]
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count("blank"),
            marks.count("duplicate"), marks.count("truncated"),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False)),
            cost, audit), kept


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "",
                                       hashlib.sha256((r[2] or "").encode()).digest()))


def check(spark, conversations):
    data = [(c, t, r, x, "extra") for c, rows in conversations.items() for t, r, x in rows]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, audit string")
    reports, kept = dialogue.repair(df.repartition(5))
    found = {r[0]: tuple(r[1:]) for r in reports.collect()}
    written = {}
    for r in kept.orderBy("conv_id", "position").collect():
        written.setdefault(r.conv_id, []).append((r.role, r.text))
    digests = {r[0]: r[1] for r in dialogue.digests(df, reports).collect()}
    assert set(found) == set(conversations)
    for c, rows in conversations.items():
        expected, lines = expected_report(in_order(rows))
        assert found[c] == expected
        assert written.get(c, []) == list(lines)
        assert digests[c] == hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()


def test_reports_rows_and_digests(spark):
    rng = random.Random(9)
    conversations = {c: [(rng.choice([None, *range(12)]), r, t) for r, t in random_rows(rng, rng.randint(1, 12))]
                     for c in range(80)}
    conversations[None] = [(1, "user", "Hi."), (None, None, None), (3, "assistant", "x" * 50_000 + ".")]
    conversations[200] = [(5, "user", "again.")] * 700 + [(6, "assistant", "ok.")]
    conversations[201] = [(None, "", ""), (None, "", "")]
    conversations[202] = [(t, ("user", "assistant")[t % 2], f"{t}.") for t in range(900) if t % 50]
    check(spark, conversations)


def test_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    reports, kept = dialogue.repair(df)
    assert reports.count() == kept.count() == dialogue.digests(df, reports).count() == 0


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        name = lambda x: " " if x is None else str(x)
        kind = zlib.crc32(f"{name(conv)}:{name(turn)}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def test_query_against_brute_force(spark, tmp_path):
    rows = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    lost = next(c for c in range(10 ** 6, 2 * 10 ** 6) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    more = [(lost, 0, "user", "gone."), (None, None, None, None), (None, 1, "user", "a."), (77_777, None, "bot", "b")]
    whole = rows.unionByName(spark.createDataFrame(more, rows.schema)).withColumn("cost", F.lit("x"))
    whole.write.parquet(str(tmp_path / "conversations.parquet"))
    groups = {}
    for r in whole.collect():
        groups.setdefault(r.conv_id, []).append((r.conv_id, r.turn, r.role, r.text))
    found = {r[0]: tuple(r[1:]) for r in QUERIES["op12_dialogue"](spark, str(tmp_path)).collect()}
    assert set(found) == set(groups)
    for c, group in groups.items():
        expected, lines = expected_report(in_order(damaged(group)))
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
        assert found[c] == (*expected, digest)
