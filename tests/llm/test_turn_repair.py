"""Least-cost repair against enumeration of all short audits, in pieces of any size."""

import hashlib
import itertools
import re
import zlib

import numpy as np
import pytest

from ledgerflow.llm import turn_repair as tr

GOOD = re.compile(r"(s?(ua)+)?\Z")
SPACES = " \t\n\x0b\x0c\r"


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.strip(SPACES)
        if not body:
            out.append(tr.BLANK)
        elif (role, text) in seen:
            out.append(tr.DUPLICATE)
        else:
            out.append(tr.OK if body[-1] in ".!?" else tr.CUT)
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired rows) by trying every edit of every row and every insert, best first."""
    marks = faults(rows)
    layer = [(0, "", "", [])]                # cost, audit, initials, repaired
    for k in range(len(rows) + 1):
        # inserts, then the row
        grown = {}
        for cost, audit, initials, out in layer:
            for extra in itertools.chain.from_iterable(itertools.product("ua", repeat=n) for n in range(3)):
                now = initials + "".join(extra)
                if any(GOOD.match(now + t) for t in ("", "a", "ua")):
                    item = (cost + 5 * len(extra), audit + "I" * len(extra), now, out + [({"u": "user", "a": "assistant"}[c], "") for c in extra])
                    key = (now[-1:], now[:1] == "s" and len(now) == 1)
                    grown[key] = min(grown.get(key, item), item)
        layer = list(grown.values())
        if k == len(rows):
            break
        (role, text), mark, after = rows[k], marks[k], {}
        for cost, audit, initials, out in layer:
            options = [(2, "D", "", None)]
            if mark not in (tr.BLANK, tr.DUPLICATE):
                more = 5 if mark == tr.CUT else 0
                options += [(more, "K", role[:1] or "?", role), (1 + more, "R", "u", "user"), (1 + more, "R", "a", "assistant")]
            for c, edit, initial, name in options:
                now = initials + initial
                if any(GOOD.match(now + t) for t in ("", "a", "ua")):
                    item = (cost + c, audit + edit, now, out + ([(name, text)] if name is not None else []))
                    key = (now[-1:], now[:1] == "s" and len(now) == 1)
                    after[key] = min(after.get(key, item), item)
        layer = list(after.values())
    cost, audit, _, out = min(x for x in layer if GOOD.match(x[2]))
    return cost, audit, out


def expected(conversation):
    """Contract row of one conversation's rows (turn, role, text), before ordering."""
    rows = sorted(conversation, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).hexdigest()))
    turns = [t for t, _, _ in rows if t is not None]
    said = [(role, text) for _, role, text in rows]
    marks, initials = faults(said), [r[:1] for r, _ in said]
    cost, audit, out = cheapest(said)
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, marks.count(tr.BLANK), marks.count(tr.DUPLICATE),
            marks.count(tr.CUT), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest())


def random_conversations(seed, n, longest):
    rng = np.random.default_rng(seed)
    out = {}
    for c in range(n):
        rows = []
        for _ in range(rng.integers(0, longest)):
            rows.append((None if rng.random() < 0.1 else int(rng.integers(0, longest + 3)),
                         str(rng.choice(["system", "user", "assistant", "user", "assistant", "tool", " ", ""])),
                         str(rng.choice(["Yes.", "No!", "Why? ", "cut", "", " \n", "ü…", "Ok.\t", f"text {rng.integers(9)}."]))))
        out[c if c else None] = rows
    return out


@pytest.mark.parametrize("bits", [0, 1, 12])
def test_report_equals_enumeration(frame, bits):
    chats = random_conversations(bits, 60, 14)
    df = frame([(c, t, r, x, "junk", 1) for c, rows in chats.items() for t, r, x in rows],
               "conv_id long, turn long, role string, text string, chunk string, seq int")
    every = frame([(c,) for c in chats], "conv_id long")
    got = {r.conv_id: tuple(r)[1:] for r in tr.report(df, every, chunk_bits=bits).collect()}
    assert got == {c: expected(rows) for c, rows in chats.items()}


def test_enumeration_by_definition():
    """The helper above against all sequences of edits, for short conversations."""
    rng = np.random.default_rng(2)
    for _ in range(40):
        rows = [(str(rng.choice(["system", "user", "assistant", "tool"])), str(rng.choice(["a.", "b", "", "c!"]))) for _ in range(rng.integers(0, 4))]
        marks, found = faults(rows), []
        for edits in itertools.product("DKR", repeat=len(rows)):
            if any(m in (tr.BLANK, tr.DUPLICATE) and e != "D" for m, e in zip(marks, edits)):
                continue
            for gaps in itertools.product(range(3), repeat=len(rows) + 1):
                inserts = sum(gaps)
                audit = "".join("I" * g + e for g, e in zip(gaps, [*edits, ""]))
                for fill in itertools.product("ua", repeat=inserts + edits.count("R")):
                    new, initials = iter(fill), ""
                    for g, e, (role, _) in zip(gaps, edits, rows):
                        initials += "".join(next(new) for _ in range(g)) + ("" if e == "D" else role[0] if e == "K" else next(new))
                    initials += "".join(next(new) for _ in range(gaps[-1]))
                    if GOOD.match(initials):
                        cost = 5 * inserts + sum({"D": 2, "K": 0, "R": 1}[e] + (5 if e != "D" and m == tr.CUT else 0) for e, m in zip(edits, marks))
                        found.append((cost, audit))
        assert min(found) == cheapest(rows)[:2]


@pytest.mark.parametrize("seed", range(3))
def test_ranks_order_whole_audits(seed):
    rng = np.random.default_rng(seed)
    steps = "".join(f"{rng.choice(list('suax'))}{rng.choice(list('0123'))}" for _ in range(20))
    edit, rank, hops = tr.rank_paths(np.array(tr.optimal_arcs(steps, tr.costs_before(steps, tr.FINAL))))
    audits = [tr._path(n, edit, hops)[0] for n in range(len(edit))]
    assert [sorted(set(audits)).index(a) for a in audits] == np.unique(rank, return_inverse=True)[1].tolist()


def test_repaired_rows_and_one_long_conversation(spark):
    rng = np.random.default_rng(3)
    rows = [(k // 2, ["user", "assistant", "user", "system"][rng.integers(4)], f"t{rng.integers(300)}" + ".?! "[rng.integers(4)]) for k in range(600)]
    df = spark.createDataFrame([("long", *r) for r in rows], "conv_id string, turn long, role string, text string").repartition(7)
    for bits in (3, 12):
        want = expected(rows)
        assert tuple(tr.report(df, chunk_bits=bits).first())[1:] == want
        got = tr.repaired_rows(df, chunk_bits=bits).orderBy("chunk", "place").collect()
        assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in got).encode()).hexdigest() == want[-1]
        assert "".join(r.edit for r in got) == want[-2].replace("D", "")


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(40) for t in range(3)] + [(None, None, None, None)]
    got = tr.damaged(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    want = []
    for c, t, role, text in rows:
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        role, text = role or " ", text or " "
        row = (c, t, "user" if fate == 4 else role, "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text)
        want += [row] * (0 if fate == 0 else 2 if fate == 3 else 1)
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    assert tr.report(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []
