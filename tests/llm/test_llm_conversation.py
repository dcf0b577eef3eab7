"""Conversation repair against plain implementations: the whole query, the DP
against all edit strings, the prefix comparison and the segments."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from cohortforge.llm import conversation as cv

SF = "/root/testdata/sf0.01"
EMPTY = hashlib.sha256(b"").hexdigest()


def fits(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def all_repairs(rows):
    """Cheapest (cost, audit, lines) over all edit strings of (role, text, fault) rows,
    found by trying every edit and every insertion of up to two rows in between."""
    best = None
    gaps = [()] + [(r,) for r in ("user", "assistant")] + [("user", "assistant"), ("assistant", "user")]
    for inserts in itertools.product(gaps, repeat=len(rows) + 1):
        spent = sum(map(len, inserts)) * 2
        if best is not None and spent > best[0]:
            continue
        for edits in itertools.product("KDua", repeat=len(rows)):
            cost, audit, lines = spent, "I" * len(inserts[0]), [(r, "") for r in inserts[0]]
            for (role, text, fault), edit, more in zip(rows, edits, inserts[1:]):
                if edit == "D":
                    cost, audit = cost + 3, audit + "D"
                elif fault in (cv.BLANK, cv.DUPLICATE):
                    break
                else:
                    cost += (edit != "K") * 2 + (fault == cv.TRUNCATED)
                    audit += "K" if edit == "K" else "R"
                    lines.append(({"K": role, "u": "user", "a": "assistant"}[edit], text))
                audit += "I" * len(more)
                lines += [(r, "") for r in more]
            else:
                if fits("".join(r[:1] for r, _ in lines)) and (best is None or (cost, audit) < best[:2]):
                    best = cost, audit, lines
    return best


def plain_repair(rows):
    """A plain DP over (cost, audit, lines) tuples."""
    def inserted(best):
        for _ in range(3):
            for state, (cost, audit, lines) in list(best.items()):
                to = {"": "u", "s": "u", "u": "a", "a": "u"}[state]
                new = cost + 2, audit + "I", lines + [({"u": "user", "a": "assistant"}[to], "")]
                if to not in best or new[:2] < best[to][:2]:
                    best[to] = new
        return best

    best = inserted({"": (0, "", [])})
    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in best.items():
            nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
            options = [(state, cost + 3, "D", lines)]
            if fault not in (cv.BLANK, cv.DUPLICATE):
                extra = fault == cv.TRUNCATED
                if role[:1] and role[:1] in nexts:
                    options.append((role[:1], cost + extra, "K", lines + [(role, text)]))
                to = nexts[-1]
                options.append((to, cost + 2 + extra, "R", lines + [({"u": "user", "a": "assistant"}[to], text)]))
            for to, c, e, ls in options:
                if to not in after or (c, audit + e) < after[to][:2]:
                    after[to] = c, audit + e, ls
        best = inserted(after)
    return min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        if k == 1:
            text = ""
        if k == 2:
            text = re.sub("[.!?]", "", text)
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (2 if k == 3 else 1)
    return out


def plain_query(rows):
    """The whole contract, one conversation at a time."""
    groups = {r[0]: [] for r in rows}
    for r in damaged(rows):
        groups[r[0]].append(r[1:])
    out = {}
    for conv, own in groups.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        faults, seen = [], set()
        for turn, role, text in own:
            words = text.strip(" \t\n\v\f\r")
            fault = cv.BLANK if not words else cv.DUPLICATE if (role, text) in seen else cv.NONE if words[-1] in ".!?" else cv.TRUNCATED
            seen.add((role, text))
            faults.append(fault)
        turns = {t for t, _, _ in own if t is not None}
        initials = [r[:1] for _, r, _ in own]
        cost, audit, lines = plain_repair([(r, x, f) for (_, r, x), f in zip(own, faults)])
        out[conv] = (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count(cv.BLANK), faults.count(cv.DUPLICATE),
                     faults.count(cv.TRUNCATED), sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
                     cost, audit, hashlib.sha256("\n".join(f"{r}:{x}" for r, x in lines).encode()).hexdigest())
    return out


def run(spark, rows, kind="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, kind)
    found = cv.repair(cv.damage(df), keys=df.select("conv_id")).collect()
    assert len({r[0] for r in found}) == len(found)
    return {r[0]: tuple(r[1:]) for r in found}


def random_rows(seed, conversations, longest):
    rng, rows = random.Random(seed), []
    texts = ["", " \t", "Yes.", "no", "Why? ", "a\nb!", "so\x0b", "é."]
    for conv in [None, *range(conversations)]:
        for _ in range(rng.randint(1, longest)):
            rows.append((conv, rng.choice([None, *range(12)]), rng.choice(["system", "user", "assistant", "tool", "", None, "User"]),
                         rng.choice([*texts, None])))
    return rows


def test_query_equals_plain_form(spark):
    import __spark_entry__ as entry
    found = {r[0]: tuple(r[1:]) for r in entry.queries()["op12_conversation_repair"](spark, SF).collect()}
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = plain_query(rows)
    assert found == want
    for at in range(5):  # each kind of fault and an edit of each kind occur
        assert any(v[at] for v in want.values())
    assert set("".join(v[6] for v in want.values())) == set("KDRI")


def test_nulls_ties_and_repeated_rows(spark):
    rows = random_rows(3, 60, 9)
    assert run(spark, rows + rows[:50]) == plain_query(rows + rows[:50])


def test_segments_chain_like_one_run(spark, monkeypatch):
    monkeypatch.setattr(cv, "SEGMENT", 3)
    rows = random_rows(4, 30, 40)
    assert run(spark, rows) == plain_query(rows)


def test_dp_equals_all_edit_strings():
    rng = random.Random(5)
    for _ in range(60):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), f"t{i}", rng.choice([0, 0, 1, 2, 3])) for i in range(rng.randint(0, 3))]
        want = all_repairs(rows)
        assert plain_repair(rows) == want
        states = cv.best_audits([(r[:1], f) for r, _, f in rows], cv.START, True)
        assert min(states[s] for s in (cv.START, cv.ASSISTANT) if s in states) == want[:2]


@pytest.mark.parametrize("modulus", [cv.MODULUS, 3, 1])
def test_prefix_comparison_survives_collisions(monkeypatch, modulus):
    monkeypatch.setattr(cv, "MODULUS", modulus)
    rng, audits = random.Random(6), cv.Audits()
    nodes, texts = [0], [""]
    for _ in range(300):
        at, char = rng.randrange(len(nodes)), rng.choice("KD")
        nodes.append(audits.extend(nodes[at], char))
        texts.append(texts[at] + char)
    for a, b in itertools.product(range(0, 300, 3), repeat=2):
        assert audits.less(nodes[a], nodes[b]) == (texts[a] < texts[b])
        assert audits.spell(nodes[a]) == texts[a]


def test_empty_and_dropped(spark):
    assert run(spark, []) == {}
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    assert run(spark, [(dropped, 0, "user", "Hi.")]) == {dropped: (0, 0, 0, 0, 0, 0, "", EMPTY)}


def test_other_columns_and_long_texts(spark):
    text = "word. " * 200_000
    df = spark.createDataFrame([(1, 5, "user", text, 0, "x")], "conv_id long, turn long, role string, text string, i int, fault string")
    kind = zlib.crc32(b"1:5") % 20
    assert kind > 4
    row = cv.repair(cv.damage(df)).first()
    assert (row["cost"], row["audit"]) == (2, "KI")
    assert row["repaired_sha256"] == hashlib.sha256(f"user:{text}\nassistant:".encode()).hexdigest()
