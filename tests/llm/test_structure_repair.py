import hashlib
import itertools
import random

import numpy as np
import pytest

from rentgrid.llm import structure_repair as sr

GIVEN = {0: 2, 1: 2, 2: 3, 3: 2}
KEPT = {(0, 0): 1, (1, 0): 2, (1, 1): 2, (1, 3): 2, (2, 2): 3}


def closed(best):
    for _ in range(4):
        for s, (cost, audit) in list(best.items()):
            option = (cost + 5, audit + "I")
            if option < best.get(GIVEN[s], (10**9,)):
                best[GIVEN[s]] = option
    return best


def brute(codes):
    """(cost, edits) by keeping the least of all lists of edits at each state."""
    best = {0: (0, "")}
    for code in codes:
        initial, fault, after = code & 3, code >> 2, {}
        for s, (cost, audit) in closed(dict(best)).items():
            options = [(s, cost + 2, audit + "D")]
            if fault != 1:
                cost += 5 * (fault == 2)
                options.append((GIVEN[s], cost + 1, audit + "R"))
                if (initial, s) in KEPT:
                    options.append((KEPT[initial, s], cost, audit + "K"))
            for t, *option in options:
                if tuple(option) < after.get(t, (10**9,)):
                    after[t] = tuple(option)
        best = after
    best = closed(dict(best))
    return min(best[s] for s in (0, 3) if s in best)


def in_blocks(codes, size):
    parts = [np.array(codes[i : i + size]) for i in range(0, len(codes), size)]
    ends = sr.chain_back(np.array([sr.Blocks([p]).matrices()[0] for p in parts]))
    state, audit, cost = 0, "", None
    for k, part in enumerate(parts):
        costs, states, chars = sr.Blocks([part]).walks(ends[k : k + 1], np.array([k == len(parts) - 1]))
        cost = int(costs[0, 0]) if k == 0 else cost
        audit += bytes(chars[0, state][chars[0, state] > 0]).decode()
        state = int(states[0, state])
    return cost, audit


@pytest.mark.parametrize("n", [1, 2, 3])
def test_all_short_conversations(n):
    for codes in itertools.product(range(12), repeat=n):
        assert in_blocks(codes, 2) == brute(codes)


def test_blocks_do_not_change_the_walk():
    rng = random.Random(2)
    for _ in range(800):
        codes = [rng.randrange(12) for _ in range(rng.randrange(1, 15))]
        assert in_blocks(codes, rng.randrange(1, 6)) == brute(codes)


def test_blocks_of_a_batch_are_independent():
    rng = np.random.default_rng(3)
    codes = [rng.integers(0, 12, n) for n in (9, 7, 7, 3, 1)]
    held = sr.Blocks(codes)
    assert all((m == sr.Blocks([c]).matrices()[0]).all() for m, c in zip(held.matrices(), codes))
    end = np.array([sr._FINAL] * 5)
    costs, states, chars = held.walks(end, np.ones(5, dtype=bool))
    for k, c in enumerate(codes):
        assert (int(costs[k, 0]), bytes(chars[k, 0][chars[k, 0] > 0]).decode()) == brute(c)


def expected(rows):
    """conv -> (figures, edits, hash) of (conv, turn, role, text) rows, by loops."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        key = lambda r: hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], key(r)))
        seen, codes, n = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
        for _, role, text in own:
            visible = text.strip("\x20\x09\x0a\x0b\x0c\x0d")
            fault = "blank" if not visible else "duplicate" if (role, text) in seen else None if visible[-1] in ".!?" else "truncated"
            seen.add((role, text))
            if fault:
                n[fault] += 1
            codes.append(("sua".find(role[:1]) if role[:1] in ("s", "u", "a") else 3) + 4 * {None: 0, "truncated": 2}.get(fault, 1))
        illegal = sum((a[1][:1] + b[1][:1]) not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        numbers = [t for t, _, _ in own if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        cost, audit = brute(codes)
        lines, turns, last = [], iter(own), ""
        for edit in audit:
            given = "assistant" if last == "u" else "user"
            if edit == "I":
                lines.append(f"{given}:")
            else:
                _, role, text = next(turns)
                if edit != "D":
                    lines.append(f"{role if edit == 'K' else given}:{text}")
            last = lines[-1][:1] if lines else ""
        out[conv] = (gaps, *n.values(), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


SCHEMA = "conv_id long, turn long, role string, text string, position string, c int"


def found(df):
    repair = sr.repaired(df)
    texts = {r.conv_id: r.sha256 for r in sr.fingerprints(repair.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {r.conv_id: (*tuple(r)[1:], texts.get(r.conv_id, empty)) for r in repair.report.collect()}


def made(conv, n, seed):
    rng = random.Random(seed)
    role = lambda i: rng.choice([("user", "assistant")[i % 2]] * 5 + ["system", "tool", None, "", "agent"])
    text = lambda: rng.choice(["Yes.", "a b", "", None, f"t{rng.randrange(10**6)}!", "é? \n", "end. "])
    return [(conv, rng.choice([i, i, i, i - 1, None]), role(i), text()) for i in range(n)]


@pytest.fixture(scope="module")
def rows():
    small = [r for k in range(40) for r in made(k, k % 9, k)] + made(None, 7, 5)
    odd = [(90, None, "user", "a."), (90, None, "user", "a."), (91, 3, None, None), (92, 2**62, "user", "x" * 200_000), (92, -5, "assistant", "?")]
    return small + odd + made(77, 1500, 1)  # the last one has 39 blocks


@pytest.mark.parametrize("parts", [1, 7])
def test_table(spark, rows, parts):
    df = spark.createDataFrame([(*r, "p", 0) for r in rows], SCHEMA).repartition(parts)
    got, want = found(df), expected(rows)
    assert got.keys() == want.keys()
    assert {k: (got[k], want[k]) for k in want if got[k] != want[k]} == {}


def test_no_rows(spark):
    repair = sr.repaired(spark.createDataFrame([], SCHEMA))
    assert repair.report.count() == 0 and repair.turns.count() == 0
    assert sr.fingerprints(repair.turns).count() == 0


def test_turns_are_legal(spark, rows):
    df = spark.createDataFrame([(*r, "p", 0) for r in rows], SCHEMA)
    turns = sr.repaired(df).turns.collect()
    for conv in {r.conv_id for r in turns}:
        own = sorted((r.position, r.role) for r in turns if r.conv_id == conv)
        assert [p for p, _ in own] == list(range(len(own)))
        roles = "".join(r[:1] for _, r in own)
        roles = roles.removeprefix("s")
        assert roles == "ua" * (len(roles) // 2)
