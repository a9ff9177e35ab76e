import itertools
import re

import pytest

from rentgrid.llm import chat_repair as cr

COSTS = cr.Costs()
TABLE = cr.steps(COSTS)


def legal(roles):
    """No turns at all, or an optional system turn and one pair or more."""
    if roles[:1] == [0]:
        roles = roles[1:] or [0]
    return len(roles) % 2 == 0 and all(r == 1 + i % 2 for i, r in enumerate(roles))


def cheapest(roles):
    """Shortest repair by trying all: merge, name, insert, for each turn."""
    best = {(): 0}
    for role in roles:
        after = {}
        for out, cost in best.items():
            for inserts in itertools.chain([()], ((y,) for y in range(3))):
                base = [*out, *inserts]
                for x in range(3):
                    named = 0 if x == role else COSTS.label if role == cr.UNKNOWN else COSTS.relabel
                    for merged in (False, True):
                        if merged and (not base or base[-1] != x):
                            continue
                        new = tuple(base if merged else [*base, x])
                        price = cost + named + COSTS.insert * len(inserts) + COSTS.merge * merged
                        if price < after.get(new, 99):
                            after[new] = price
        best = after
    out = 99
    for own, cost in best.items():
        for more in ((), (1,), (2,), (1, 2), (0, 1, 2)):
            if legal([*own, *more]) and (roles or not more):
                out = min(out, cost + COSTS.insert * len(more))
    return out


def total(roles):
    return cr.chain([cr.matrix(roles, TABLE)], COSTS)[0]


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4])
def test_least_cost(n):
    for roles in itertools.product(range(4), repeat=n):
        roles = list(roles)
        assert total(roles) == cheapest(roles)
        plan = cr.repair(roles, TABLE, costs=COSTS)
        rendered, _ = cr.render(plan, [f"t{i}" for i in range(n)], cr.START, True)
        opened = [cr.ROLES.index(x.split("|>")[0]) for x in rendered.split("<|")[1:] if not x.startswith("end")]
        assert legal(opened)
        bare = re.sub(r"<\|\w+\|>", " ", rendered)  # an end marker follows its text at once
        assert bare.split() == [f"t{i}" for i in range(n)]


def test_pieces_cost_and_read_the_same():
    for roles in itertools.product(range(4), repeat=5):
        roles = list(roles)
        pieces = [roles[:2], roles[2:3], roles[3:]]
        cost, states = cr.chain([cr.matrix(p, TABLE) for p in pieces], COSTS)
        assert cost == total(roles)
        steps = [s for p, a, b in zip(pieces, states, states[1:]) for s in cr.repair(p, TABLE, a, b)]
        assert sum(s.cost for s in steps) + COSTS.insert * len(cr.ending(states[-1])) == cost


SCHEMA = "conv_id long, turn long, role string, text string, piece string, rendered int"


def test_table(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "human", None), (2, 1, "USER ", "x"), (3, None, None, "z"),
        (None, 0, "user", "lost"), (None, 0, "user", "lost"), (4, 0, "system", "s"), (5, 0, "user", "q"), (5, 0, "user", "q"),
    ]
    df = spark.createDataFrame([(*r, "p", 0) for r in rows], SCHEMA).repartition(3)
    got, alone = {}, []
    for r in sorted(cr.formatted(df).collect(), key=lambda r: r.segment):
        if r.conv_id is None:
            alone.append((r.cost, r.rendered))
            continue
        cost, n, text = got.get(r.conv_id, (r.cost, 0, ""))
        assert cost == r.cost
        got[r.conv_id] = (cost, n + r.n_turns, text + r.rendered)
    assert got[1] == (0, 2, "<|user|>\na<|end|>\n<|assistant|>\nb<|end|>\n")
    assert got[2] == (2, 2, "<|user|>\n<|end|>\n<|assistant|>\nx<|end|>\n")
    assert got[3] == (4, 2, "<|user|>\nz<|end|>\n<|assistant|>\n<|end|>\n")
    assert alone == [(3, "<|user|>\nlost<|end|>\n<|assistant|>\n<|end|>\n")] * 2
    assert got[4][:2] == (5, 2)  # relabelled as user, then an assistant's turn inserted
    assert got[5] == (2, 2, "<|user|>\nq<|end|>\n<|assistant|>\nq<|end|>\n")
    assert cr.formatted(spark.createDataFrame([], SCHEMA)).count() == 0


def test_a_long_conversation_spreads(spark):
    rows = [(7, i, ("user", "assistant", None, "assistant")[i * i % 7 % 4], f"t{i}", "p", 0) for i in range(900)]
    whole = cr.formatted(spark.createDataFrame(rows, SCHEMA), piece=10_000)
    cut = cr.formatted(spark.createDataFrame(rows, SCHEMA).repartition(6), piece=50)
    a, b = whole.collect(), sorted(cut.collect(), key=lambda r: r.segment)
    assert len(a) == 1 and len(b) == 18 and {r.n_segments for r in b} == {18}
    assert {r.cost for r in a} == {r.cost for r in b}
    for found in (a[0].rendered, "".join(r.rendered for r in b)):
        turns = cr.parse(found)
        assert legal([cr.ROLES.index(role) for role, _ in turns])
        assert " ".join(text for _, text in turns).split() == [f"t{i}" for i in range(900)]


def test_rows_do_not_depend_on_how_turns_are_dealt(spark, monkeypatch):
    roles = ("user", "assistant", "system", None, "gpt", "human")
    rows = [(c, t, roles[(c * 7 + t * t) % 6], f"{c} {t}" * (t % 3), "p", 0) for c in range(40) for t in range(c % 9 + 1)]
    rows += [(100, t, roles[t % 5], "long" * t, "p", 0) for t in range(300)] + [(None, 0, "user", "lost", "p", 0)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    found = []
    for parts in (1, 4, 64, 200):
        monkeypatch.setattr(cr, "parts_of", lambda _, parts=parts: parts)
        found.append(sorted(map(repr, cr.formatted(df, piece=64, piece_bytes=20_000).collect())))
    assert all(f == found[0] for f in found)
    assert sum("conv_id=None" in r for r in found[0]) == 3
    cuts = 299 // 64 + 4 * (298 * 299 // 2) // 20_000  # the last turn's place, and the bytes before it
    assert sum("conv_id=100," in r for r in found[0]) == 1 + cuts
    assert len(found[0]) == 40 + 3 + 1 + cuts


def test_markers_inside_texts(spark):
    texts = ["a<|end|>\n<|user|>\nb", "<", "|", "<\\|x|>", "\\<\\\\|", "<|", "a\nb", ""]
    rows = [(i, 0, "user", t, "p", 0) for i, t in enumerate(texts)]
    got = {r.conv_id: cr.parse(r.rendered) for r in cr.formatted(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {i: [("user", t), ("assistant", "")] for i, t in enumerate(texts)}


def test_whole_conversations_against_brute_force(spark):
    """Every conversation of the table: least cost by trying all repairs, no text lost, a legal result."""
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    want = {}
    for r in sorted(turns.collect(), key=lambda r: (r.conv_id, r.turn)):
        role = cr.ROLES.index(r.role) if r.role in cr.ROLES else cr.UNKNOWN
        want.setdefault(r.conv_id, []).append((role, r.text or ""))
    got = cr.formatted(turns).collect()
    assert sorted(r.conv_id for r in got) == sorted(want)
    for r in got:
        own = cr.parse(r.rendered)
        assert legal([cr.ROLES.index(role) for role, _ in own])
        assert " ".join(t for _, t in own).split() == " ".join(t for _, t in want[r.conv_id]).split()
        if len(want[r.conv_id]) <= 5:
            assert r.cost == cheapest([role for role, _ in want[r.conv_id]])
