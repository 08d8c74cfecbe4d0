"""The repair of conversations against plain versions that try every way."""

import hashlib
import random
import zlib
from itertools import product

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from platework.llm import turns
from platework.llm.repair import ENDS, SIGNS, Joined, cheapest, sign, transfers

BLANK = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id long, turn long, role string, text string, place int, signs string"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        name = ":".join(" " if x is None else str(x) for x in (conv, turn))
        fault = zlib.crc32(name.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault == 1:
            text = ""
        elif fault == 2:
            text = "".join(c for c in text if c not in ".!?")
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if fault == 0 else 2 if fault == 3 else 1)
    return out


def plain(rows):
    """(cost, audit, lines, faults) by a table over rows and grammar states, each with its best way written out."""
    faults, seen = [], set()
    for _, _, role, text in rows:
        rest = text.rstrip(BLANK)
        faults.append("blank" if not rest.lstrip(BLANK) else "duplicate" if (role, text) in seen
                      else "truncated" if rest[-1] not in ".!?" else "")
        seen.add((role, text))
    reads = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    writes = {"": "user", "s": "user", "u": "assistant", "a": "user"}

    def inserted(ways):
        again = True
        while again:
            again = False
            for state, (cost, audit, lines) in list(ways.items()):
                new = (cost + 2, audit + "I", [*lines, f"{writes[state]}:"])
                to = writes[state][0]
                if to not in ways or new[:2] < ways[to][:2]:
                    ways[to], again = new, True
        return ways

    ways = inserted({"": (0, "", [])})
    for (_, _, role, text), fault in zip(rows, faults, strict=True):
        new = {}

        def put(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, audit, lines) in ways.items():
            put(state, (cost + 3, audit + "D", lines))
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if (to := reads.get((state, role[:1]))) is not None:
                    put(to, (cost + more, audit + "K", [*lines, f"{role}:{text}"]))
                put(writes[state][0], (cost + 2 + more, audit + "R", [*lines, f"{writes[state]}:{text}"]))
        ways = inserted(new)
    return (*min((ways[s] for s in ("", "a") if s in ways), key=lambda x: x[:2]), faults)


def expected(rows):
    every = {r[0] for r in rows}
    key = lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest())
    out = []
    for conv in every:
        mine = sorted((r for r in damage(rows) if r[0] == conv), key=key)
        cost, audit, lines, faults = plain(mine)
        known = [r[1] for r in mine if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(mine, mine[1:], strict=False))
        out.append((conv, gaps, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal,
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=repr)


def found(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    return sorted((tuple(r) for r in turns.repaired(turns.damaged(frame), frame).collect()), key=repr)


def made(seed, convs=40, longest=12):
    rng = random.Random(seed)
    texts = ["Yes.", "No", "Why?", "", " \n", "So it is! ", None, "Go on...\n", "é. x"]
    rows = []
    for conv in range(convs):
        size = rng.randint(0, longest)
        roles = ["system"] * (rng.random() < 0.4) + ["user", "assistant"] * size
        for turn, role in enumerate(roles[:size]):
            if rng.random() < 0.9:
                role = rng.choice(["user", "assistant", "system", "tool", "", None, "User"]) if rng.random() < 0.25 else role
                text = rng.choice(texts) if rng.random() < 0.3 else f"word {rng.randint(0, 9999)}" + rng.choice([".", "", "?"])
                at = None if rng.random() < 0.05 else turn + (rng.random() < 0.1)
                rows += [(None if conv == 7 else conv, at, role, text)] * (2 if rng.random() < 0.1 else 1)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_conversations_are_repaired_as_by_trying_every_way(spark, seed):
    rows = made(seed)
    assert found(spark, rows) == expected(rows)


def test_a_long_conversation_is_solved_in_chunks(spark):
    rng = random.Random(3)
    rows = [(5, t, rng.choice(["user", "assistant", "user", "system"]), f"t {rng.randint(0, 2500)}" + rng.choice([".", ""]))
            for t in range(3_000)]
    rows += [(k, t, "user", "One." if t else "Two.") for k in (4, 6) for t in range(4)] + [(5, 3000, "user", "same.")] * 1500
    assert found(spark, rows) == expected(rows)


def test_empty_table_and_conversations_without_rows(spark):
    assert found(spark, []) == []
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    assert found(spark, [(gone, 0, "user", "Yes.")]) == [
        (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(SIGNS), max_size=9), st.integers(0, 3), st.integers(0, 3))
def test_searches_that_meet_find_the_least_audit(letters, entry, leave):
    ways = {}

    def walk(state, at, cost, audit, inserts):
        from platework.llm.repair import _onward, _row
        rows = [_row(x) for x in letters]
        key = (at, state)
        if key in ways and ways[key] <= (cost, audit) and (at or state != entry or audit):
            return
        ways[key] = min(ways.get(key, (cost, audit)), (cost, audit))
        for more, letter, (to, then) in _onward(rows, (at, state)):
            if letter != "I" or inserts < 2:
                walk(then, to, cost + more, audit + letter, inserts + 1 if letter == "I" else 0)

    walk(entry, 0, 0, "", 0)
    assert cheapest("".join(letters), entry, (leave,)) == ways.get((len(letters), leave))


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("AEIMBFJCGKDHL"), min_size=1, max_size=24), st.lists(st.integers(1, 6), min_size=1, max_size=24))
def test_chunks_join_to_the_whole(letters, sizes):
    text, joined, at = "".join(letters), Joined(), 0
    for size in [*sizes, len(text)]:
        joined.add(transfers(text[at : at + size], False))
        at += size
    cost, pieces = joined.result()
    assert (cost, "".join(pieces)) == cheapest(text, 0, ENDS)


def test_signs_tell_roles_and_faults():
    made = {sign(r, f) for r, f in product(["system", "user", "assistant", ""], range(4))}
    assert made == set(SIGNS) and sign("tool", 1) == sign("", 1)
