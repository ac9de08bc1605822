"""Conversation repair against a plain recursion over all edits, and its node store against plain strings."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import repair
from millrace.llm.queries import op12_repair_conversations
from workloads.registry import table

BLANK = r"\x20\x09-\x0D"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        last = re.findall(f"[^{BLANK}]", text)[-1:]
        if not last:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if last[0] not in ".!?" else None)
        seen.add((role, text))
    return out


def brute(rows):
    """Cheapest edits of rows (turn, role, text) in order: cost, audit, repaired (role, text)."""
    found = faults(rows)

    @lru_cache(None)
    def best(i, state, inserts=0):
        """The least (cost, audit) that finishes from row ``i``; ``state`` is the initial of the last repaired turn."""
        ways = [(0, "")] if i == len(rows) and state in ("", "a") else []
        if inserts < 3:
            for role in "ua":
                if (state, role) in NEXT:
                    cost, audit = best(i, role, inserts + 1)
                    ways.append((cost + 5, "I" + audit))
        if i < len(rows):
            cost, audit = best(i + 1, state)
            ways.append((cost + 2, "D" + audit))
            if found[i] not in ("blank", "duplicate"):
                stays = 5 if found[i] else 0
                own = rows[i][1][:1]
                for letter, role, extra in (("K", own, 0), ("R", "u", 1), ("R", "a", 1)):
                    if (state, role) in NEXT:
                        cost, audit = best(i + 1, role)
                        ways.append((cost + stays + extra, letter + audit))
        return min(ways, default=(10**9, ""))

    cost, audit = best(0, "")
    state, out, left = "", [], list(rows)
    for letter in audit:
        made = "assistant" if state == "u" else "user"
        turn, role, text = (None, made, "") if letter == "I" else left.pop(0)
        if letter == "D":
            continue
        out.append((made if letter == "R" else role, text))
        state = out[-1][0][:1]
    best.cache_clear()
    return cost, audit, out


def streamed(rows, **settings):
    edits = []
    one = repair.Repair(lambda *e: edits.append(e), **settings)
    for row, fault in zip(rows, faults(rows)):
        one.add(*row, fault)
    cost = one.finish()
    return cost, "".join(e[0] for e in edits), [(role, text) for letter, _, role, text in edits if letter != "D"]


def conversation(rng, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", " ", "", "u"]
    texts = ["Yes.", "No.", "So?", "cut", "", " ", "a.b", "Fine!\n"]
    likely = ["user", "assistant"] * n
    return [(i, rng.choice(roles) if rng.random() < 0.3 else likely[i], rng.choice(texts) if rng.random() < 0.4 else f"text {i}.") for i in range(n)]


@pytest.mark.parametrize("room", [1, 8, 4096])
def test_random_conversations(room):
    rng = random.Random(room)
    for _ in range(1500):
        rows = conversation(rng, rng.randrange(9))
        assert streamed(rows, room=room) == brute(rows)


def test_long_conversations():
    rng = random.Random(5)
    for n in (150, 200):
        rows = conversation(rng, n)
        assert streamed(rows, room=16) == streamed(rows) == brute(rows)


def test_colliding_hashes(monkeypatch):
    monkeypatch.setattr(repair.Audits, "PRIME", 3)
    monkeypatch.setattr(repair.Audits, "BASE", 3)
    rng = random.Random(9)
    for _ in range(500):
        rows = conversation(rng, rng.randrange(9))
        assert streamed(rows) == brute(rows)


def test_memory_is_bounded():
    one = repair.Repair(lambda *e: None, room=500)
    rng, most = random.Random(1), 0
    for turn, role, text in conversation(rng, 30_000):
        one.add(turn, role, text, rng.choice([None, None, None, "truncated", "blank", "duplicate"]))
        most = max(most, len(one.audits), len(one.waiting))
    assert most < 1500
    one.finish()


def test_a_run_of_copies_is_one_node():
    rows = [(0, "user", "Hi."), *[(1, "user", "Hi.")] * 20_000, (2, "assistant", "Yes.")]
    assert streamed(rows) == (40_000, "K" + "D" * 20_000 + "K", [("user", "Hi."), ("assistant", "Yes.")])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.sampled_from("DIK"), st.integers(1, 3)), max_size=30), st.data())
def test_nodes_compare_as_strings(adds, data):
    audits, texts = repair.Audits(), [""]
    for parent, letter, times in adds:
        parent %= len(texts)
        audits.add(parent, letter, times)
        texts.append(texts[parent] + letter * times)
    for x in range(len(texts)):
        assert audits.text(x) == texts[x]
        y = data.draw(st.integers(0, len(texts) - 1))
        assert audits.less(x, y) == (texts[x] < texts[y])


def damaged(rows):
    """The rows of the table after the damage of the contract, by conversation."""
    out = {}
    for r in rows:
        name = lambda v: " " if v is None else str(v)
        role, text = name(r.role), name(r.text)
        out.setdefault(r.conv_id, [])
        code = zlib.crc32(f"{name(r.conv_id)}:{name(r.turn)}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out[r.conv_id] += [(r.turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    return {c: sorted(x, key=lambda t: (t[0] is not None, t[0] or 0)) for c, x in out.items()}


def expected(rows):
    found = faults(rows)
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, out = brute(rows)
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    return (gaps, *(found.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_whole_table(spark, sf_dir):
    found = {r.conv_id: tuple(r[n] for n in NAMES) for r in op12_repair_conversations(spark, sf_dir).collect()}
    assert found == {c: expected(rows) for c, rows in damaged(table(spark, sf_dir, "conversations").collect()).items()}


HARD = [
    *[(1, None, "user", f"Text {i}.") for i in range(3)],  # no turn numbers
    (2, 5, None, None),
    (2, 2**40, "user", "  wide blank is text"),
    (2, 2**40, "assistant", "Right?\r\n"),
    *[(None, i, "user" if i % 2 else "assistant", "Same.") for i in range(6)],
    (3, 1, "user", "word " * 200_000),
    (3, 2, "assistant", "Done."),
    (3, 2, "assistant", "Done."),
    (4, 1, "", ""),
]


def test_hard_rows(spark):
    turns = spark.createDataFrame([(*r, "x", 1) for r in HARD], "conv_id long, turn long, role string, text string, place string, same int")
    report = {r.conv_id: tuple(r[n] for n in NAMES) for r in repair.repair_report(turns).collect()}
    edits = {}
    for r in sorted(repair.repaired_turns(turns).collect(), key=lambda r: (str(r.conv_id), r.place)):
        edits.setdefault(r.conv_id, []).append(r)
    for conv in {r[0] for r in HARD}:
        rows = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in HARD if c == conv]
        if conv == 1:  # ties: by role, then by a digest of the text
            name = lambda v: hashlib.sha256(v.encode()).hexdigest()
            rows.sort(key=lambda r: name(name(r[1]) + "\n" + name(r[2])))
        if conv == 2:
            rows[1:] = rows[:0:-1]
        assert report[conv] == expected(rows), conv
        assert [r.place for r in edits[conv]] == list(range(len(edits[conv])))
        assert "".join(r.edit for r in edits[conv]) == report[conv][6]
        kept = "\n".join(f"{r.role}:{r.text}" for r in edits[conv] if r.edit != "D")
        assert hashlib.sha256(kept.encode()).hexdigest() == report[conv][7]
    none = turns.limit(0)
    assert repair.repair_report(none).count() == repair.repaired_turns(none).count() == 0
