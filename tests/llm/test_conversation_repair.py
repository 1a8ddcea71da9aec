import hashlib
import itertools
import random
import re
import zlib

from helpers import data

from fleetspark.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, cost string, audit string, part int, conv string"


def plain_best(kinds, start=0, goals=(0, 3)):
    """Forward dynamic programming with whole audits."""
    def insert(ways):
        for _ in range(3):
            for q, (c, a) in list(ways.items()):
                t, w = cr.NEXT[q], (c + 3, a + "I")
                if t not in ways or w < ways[t]:
                    ways[t] = w
        return ways

    ways = insert({start: (0, "")})
    for k in kinds:
        new = {}
        for q, (c, a) in ways.items():
            more = 3 if k.isupper() else 0
            steps = [(q, c + 4, "D")]
            if k != "-":
                steps.append((cr.NEXT[q], c + 3 + more, "R"))
                steps += [(t, c + more, "K") for x, froms, t in (("s", (0,), 1), ("u", (0, 1, 3), 2), ("a", (2,), 3)) if x == k.lower() and q in froms]
            for t, cost, letter in steps:
                w = (cost, a + letter)
                if t not in new or w < new[t]:
                    new[t] = w
        ways = insert(new)
    return min((ways[g] for g in goals if g in ways), default=None)


def test_short_sequences_exhaustively():
    for n in range(5):
        for kinds in itertools.product("suaxSUA-", repeat=n):
            assert cr.cheapest("".join(kinds)) == plain_best(kinds), kinds


def test_long_sequences_and_chunks():
    rnd = random.Random(3)
    for _ in range(400):
        kinds = "".join(rnd.choice("suaxSUAX-uauaua") for _ in range(rnd.randint(0, 60)))
        assert cr.cheapest(kinds) == plain_best(kinds)
        a, b = rnd.randrange(4), rnd.randrange(4)
        assert cr.cheapest(kinds, a, (b,)) == plain_best(kinds, a, (b,))
        cuts = sorted(rnd.randint(0, len(kinds)) for _ in range(3))
        cost, path = cr.chain([cr.chunk_table(kinds[i:j]) for i, j in zip([0, *cuts], [*cuts, len(kinds)])])
        assert (cost, "".join(x for _, x in path)) == plain_best(kinds)


def _expected(rows, damaged=True):
    convs = {}
    for conv, turn, role, text, *_ in rows:
        kept = convs.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
        if fate == 1:
            text = ""
        elif fate == 2:
            text = re.sub("[.!?]", "", text)
        elif fate == 4:
            role = "user"
        kept += [(turn, role, text)] * (0 if fate == 0 else 2 if fate == 3 else 1)
    out = []
    for conv, kept in convs.items():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0))
        seen, kinds, faults = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in kept:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else None
            if fault:
                faults[fault] += 1
            seen.add((role, text))
            kind = role[:1] if role[:1] in ("s", "u", "a") else "x"
            kinds += "-" if fault in ("blank", "duplicate") else kind.upper() if fault else kind
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(kept, kept[1:])]
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit = plain_best(kinds)
        fixed = "\n".join(f"{r}:{t}" for r, t in cr.apply_edits(0, audit, [(r, t) for _, r, t in kept]))
        assert re.fullmatch("(s?(ua)+)?", "".join(line[:1] for line in fixed.split("\n")) if fixed else "") or "\n" in "".join(t for _, _, t in kept)
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *faults.values(), sum(p not in ("su", "ua", "au") for p in pairs),
                    cost, audit, hashlib.sha256(fixed.encode()).hexdigest()))
    return sorted(out, key=str)


COLUMNS = ("conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def _odd_rows():
    rnd = random.Random(5)
    rows = [(None, None, None, None), (None, 3, "user", "a."), (1, None, "user", "first."), (1, 0, "system", "é 漢."), (1, 1, "assistant", None),
            (2, 0, "", "no role."), (2, 1, None, "null role."), (2, 2, "tool", "x"), (3, 0, "user", " \t\n"), (4, 7, "user", "z" * 50000 + "."),
            (5, 10**15 + 1, "user", "big turn."), (5, 10**15 + 4, "assistant", "far.")]
    for conv in range(10, 160):
        text = [f"{rnd.randint(0, 9)} words{rnd.choice(['.', '', ' !', '? '])}" for _ in range(rnd.randint(0, 12))]
        rows += [(conv, t, rnd.choice(["user", "assistant", "system", "user", "assistant"]), x) for t, x in enumerate(text)]
    return [(*r, "x", "y", 1, "z") for r in rows]


def test_operator(spark):
    rows = _odd_rows()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert data(cr.Repair(cr.damage(df)).summary, *COLUMNS) == _expected(rows)
    assert data(cr.Repair(cr.plain(df)).summary, *COLUMNS) == _expected(rows, damaged=False)
    assert cr.Repair(cr.damage(spark.createDataFrame([], SCHEMA))).summary.count() == 0


def test_hot_conversation_over_many_tasks(spark, monkeypatch):
    rnd = random.Random(6)
    hot = [(7777, t, rnd.choice(["user", "assistant", "system"]), f"{rnd.randint(0, 2000)} said{rnd.choice(['.', '.', ''])}") for t in range(4000)]
    rows = [(*r, "x", "y", 1, "z") for r in hot] + _odd_rows()
    df = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        repair = cr.Repair(cr.damage(df), with_turns=True)
        assert data(repair.summary, *COLUMNS) == _expected(rows)
        assert repair.slices.where("conv = 7777").select("part").distinct().count() > 1
        turns = repair.turns().where("conv = 7777").orderBy("part", "chunk", "place").collect()
        joined = "\n".join(f"{r.role}:{r.text}" for r in turns)
        assert hashlib.sha256(joined.encode()).hexdigest() == repair.summary.where("conv = 7777").first().repaired_sha256
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
