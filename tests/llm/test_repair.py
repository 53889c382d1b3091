"""Repair of conversations against a search over all edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tripstream.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
ORDER = re.compile(r"(s?(ua)+)?")


def cheapest(roles, faults):
    """By Dijkstra's rule over (rows used, roles so far as a state), ties by the edits' initials."""
    after = {"": "su", "s": "u", "u": "a", "a": "u"}
    queue, done = [(0, "", 0, "")], set()
    while queue:
        cost, edits, i, state = heapq.heappop(queue)
        if i == len(roles) and state in ("", "a"):
            return cost, edits
        if (i, state) in done:
            continue
        done.add((i, state))
        new = "a" if state == "u" else "u"
        heapq.heappush(queue, (cost + 2, edits + "I", i, new))
        if i < len(roles):
            heapq.heappush(queue, (cost + 3, edits + "D", i + 1, state))
            if faults[i] not in ("blank", "duplicate"):
                late = faults[i] == "truncated"
                if roles[i][:1] and roles[i][:1] in after[state]:
                    heapq.heappush(queue, (cost + late, edits + "K", i + 1, roles[i][:1]))
                heapq.heappush(queue, (cost + 2 + late, edits + "R", i + 1, new))
    raise AssertionError


def brute(conversations, damage=True):
    groups = {}
    for conv, turn, role, text in conversations:
        kept = groups.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damage else 99
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        kept += [(turn, "user" if fate == 4 else role, text)] * {0: 0, 3: 2}.get(fate, 1)
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).digest()))
        faults, seen = [], set()
        for _, role, text in rows:
            bare = text.strip(" \t\n\v\f\r")
            faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "" if bare[-1] in ".!?" else "truncated")
            seen.add((role, text))
        roles = [r for _, r, _ in rows]
        illegal = sum(a[:1] + b[:1] not in ("su", "ua", "au") for a, b in zip(roles, roles[1:]))
        turns = {t for t, _, _ in rows if t is not None}
        cost, audit = cheapest(roles, faults)
        lines, at = [], 0
        for edit in audit:
            role, text = ("", "") if edit == "I" else rows[at][1:]
            at += edit != "I"
            if edit != "D":
                before = lines[-1][0][:1] if lines else ""
                lines.append((role if edit == "K" else "assistant" if before == "u" else "user", text, edit))
        assert ORDER.fullmatch("".join(r[:1] for r, _, _ in lines))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in lines).encode()).hexdigest()
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = ((gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, sha), lines)
    return out


def random_rows(seed, count, longest):
    rng = random.Random(seed)
    rows = []
    for conv in range(count):
        for n in range(rng.randrange(longest) + 1):
            clean = ["user", "assistant"][n % 2]
            role = clean if rng.random() < 0.7 else rng.choice(["user", "assistant", "system", "tool", "", None, "u2"])
            text = rng.choice([f"Text {n}.", f"Text {n}!", "Yes.", "Yes", "", " \n", "a. \t", None, "a. ", "?"])
            rows.append((conv, rng.choice([n, n, n, n + 2, None, 3]), role, text))
    return rows


def by_conversation(frame):
    return {r["conv_id"]: tuple(r)[1:] for r in frame.collect()}


@pytest.mark.parametrize("block", [1, 3, 5, 40])
def test_searches_and_blocks_equal_a_search_over_all_edits(block):
    for seed in range(600):
        rng = random.Random(seed)
        rows = "".join(rng.choices("uuaauaUAsxdSX", k=rng.randrange(16)))
        faults = ["blank" if r == "d" else "truncated" if r.isupper() else "" for r in rows]
        paths, blocks = repair.Paths(), [rows[i : i + block] for i in range(0, len(rows), block)] or [""]
        for n, part in enumerate(blocks):
            paths.take(part, last=n == len(blocks) - 1)
        assert paths.ended() == cheapest(["u" if r == "d" else r.lower() for r in rows], faults), rows


@pytest.mark.parametrize(("count", "longest"), [(150, 14), (4, 150)])
def test_equals_a_search_over_all_edits(spark, count, longest):
    rows = random_rows(7, count, longest)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    for damage in (False, True):
        found = repair.repaired(repair.damaged(frame) if damage else frame, conversations=frame, digests=True)
        assert by_conversation(found) == {c: w for c, (w, _) in brute(rows, damage).items()}


def test_repaired_messages(spark):
    rows = random_rows(3, 40, 10)
    frame = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", audit string, conv int")
    found = repair.repaired(frame)
    assert found.columns == ["conv_id", "n", "edit", "role", "text"]
    got = {}
    for r in sorted(found.collect()):
        got.setdefault(r["conv_id"], []).append((r["role"], r["text"], r["edit"]))
    assert got == {c: lines for c, (_, lines) in brute(rows, damage=False).items() if lines}


def test_conversations_without_rows_a_null_one_and_an_empty_table(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Hi."), (5, 1, "user", "Hi")]
    frame = spark.createDataFrame(rows, SCHEMA)
    names = spark.createDataFrame([(5,), (5,), (6,), (None,)], "conv_id long")
    got = by_conversation(repair.repaired(frame, conversations=names, digests=True))
    nothing = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {c: w for c, (w, _) in brute(rows, damage=False).items()} | {6: nothing}
    assert repair.repaired(frame.limit(0), digests=True).count() == 0 == repair.repaired(frame.limit(0)).count()


def test_edits_in_ascii_order_break_ties():
    # Two users in a row: deleting one costs 3, inserting or changing one costs 2; I comes before K and R.
    assert repair.Search("uua", repair.END).cheapest("") == (2, "KIKK") == cheapest(["u", "u", "a"], ["", "", ""])
    assert repair.Search("dd", repair.END).cheapest("") == (6, "DD")
    assert repair.Search("", repair.END).cheapest("u") == (2, "I")
