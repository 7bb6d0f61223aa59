"""Operators 11 and 12 against plain versions in Python, and the SQL on the whole conversations table."""

import hashlib
import itertools
import os
import random
import sys
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from runscope.llm import conversation_repair as cr, conversation_trie as ct, edit_paths as ep

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COLUMNS = "conv_id bigint, turn bigint, role string, text string"
EMPTY = hashlib.sha256().hexdigest()
WHITE = " \t\n\x0b\x0c\r"


def conversations(spark, rows):
    """Conversations with columns that clash with the operators' own."""
    full = [(*r, 1, b"x", b"y", 3, "e", False, 0, 7) for r in rows]
    clash = ", _seen int, key binary, last binary, depth int, audit string, present boolean, low int, n int"
    return spark.createDataFrame(full, COLUMNS + clash)


# ---- operator 11


def plain_edits(rows):
    """Cost and edits by a table of whole strings."""

    def inserted(states):
        states = dict(states)
        for _ in range(3):
            for state, (cost, edits) in list(states.items()):
                target = ep.NEXT[state][1]
                states[target] = min(states.get(target, (10**9, "")), (cost + 2, edits + "I"))
        return states

    states = {0: (0, "")}
    for initial, must_go, truncated in rows:
        offers = defaultdict(list)
        for state, (cost, edits) in inserted(states).items():
            offers[state].append((cost + 3, edits + "D"))
            if not must_go:
                if (state, initial) in ep.KEPT:
                    offers[ep.KEPT[state, initial]].append((cost + truncated, edits + "K"))
                offers[ep.NEXT[state][1]].append((cost + 2 + truncated, edits + "R"))
        states = {state: min(several) for state, several in offers.items()}
    states = inserted(states)
    return min(states[s] for s in ep.FINAL if s in states)


def every_edit(rows):
    """Cost and edits by trying all sequences with at most two insertions in a row."""
    best = (10**9, "")

    def go(i, state, cost, edits, inserts):
        nonlocal best
        if cost > best[0]:
            return
        if i == len(rows) and state in ep.FINAL:
            best = min(best, (cost, edits))
        if inserts < 2:
            go(i, ep.NEXT[state][1], cost + 2, edits + "I", inserts + 1)
        if i < len(rows):
            initial, must_go, truncated = rows[i]
            go(i + 1, state, cost + 3, edits + "D", 0)
            if not must_go:
                if (state, initial) in ep.KEPT:
                    go(i + 1, ep.KEPT[state, initial], cost + truncated, edits + "K", 0)
                go(i + 1, ep.NEXT[state][1], cost + 2 + truncated, edits + "R", 0)

    go(0, 0, 0, "", 0)
    return best


def audited(rows, limit):
    audit, edits = ep.Audit(limit), []
    for i, row in enumerate(rows):
        edits += audit.add(i, *row)
    cost, rest = audit.finish()
    edits += rest
    assert [row for edit, row, _ in edits if edit != ep.INSERT] == list(range(len(rows)))
    return cost, "".join(edit for edit, _, _ in edits)


def random_rows(rng, n):
    return [(rng.choice("suauaxt "), rng.random() < 0.2, rng.random() < 0.2) for _ in range(n)]


@pytest.mark.parametrize("limit", [4, 30, 20_000])
def test_cheapest_edits_and_ties(limit):
    rng = random.Random(limit)
    for k in range(600):
        rows = random_rows(rng, rng.randrange(6) if k % 3 else rng.randrange(70))
        assert audited(rows, limit) == plain_edits(rows)
        if len(rows) < 5:
            assert plain_edits(rows) == every_edit(rows)


def test_equal_hashes_are_no_proof(monkeypatch):
    monkeypatch.setattr(ep, "_PRIME", 3)
    rng = random.Random(8)
    for _ in range(300):
        rows = random_rows(rng, rng.randrange(50))
        assert audited(rows, 60) == plain_edits(rows)


def test_common_prefixes_of_shared_nodes():
    rng, tree, texts = random.Random(2), ep.EditTree(), [""]
    for _ in range(400):
        parent, edit = rng.randrange(len(texts)), rng.choice("DK")
        tree.extend(parent, edit)
        texts.append(texts[parent] + edit)
    for _ in range(3000):
        a, b = rng.randrange(len(texts)), rng.randrange(len(texts))
        assert tree.common(a, b) == len(os.path.commonprefix([texts[a], texts[b]]))
        assert "".join(tree.edit[x] for x in tree.path(a)) == texts[a]


def test_memory_follows_the_undecided_end():
    rng, audit, most = random.Random(3), ep.Audit(2_000), 0
    for i, row in enumerate(random_rows(rng, 30_000)):
        assert sum(1 for _ in audit.add(i, *row)) >= 0
        most = max(most, len(audit._tree.edit))
    assert most <= 2_000 + 20


def plain_repair(rows):
    """conv_id to its row of the summary, from damaged rows (conv_id, turn, role, text)."""
    found = {}
    by_conversation = defaultdict(list)
    for conv, turn, role, text in rows:
        by_conversation[conv].append((turn, role if role is not None else " ", text if text is not None else " "))
    for conv, turns in by_conversation.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, rows_, faults = set(), [], [0, 0, 0]
        for _, role, text in turns:
            blank, dup, body = not text.strip(WHITE), (role, text) in seen, text.rstrip(WHITE)
            seen.add((role, text))
            cut = body[-1:] not in (".", "!", "?")
            if blank or dup or cut:
                faults[0 if blank else 1 if dup else 2] += 1
            rows_.append((role[:1], blank or dup, cut and not (blank or dup)))
        cost, edits = plain_edits(rows_)
        state, lines, left = 0, [], iter(zip(turns, rows_))
        for edit in edits:
            (turn, role, text), (initial, _, _) = next(left) if edit != "I" else ((None, "", ""), ("", 0, 0))
            if edit == "K":
                lines.append(f"{role}:{text}")
                state = ep.KEPT[state, initial]
            elif edit != "D":
                lines.append(f"{ep.NEXT[state][0]}:{text}")
                state = ep.NEXT[state][1]
        numbers = [t for t, _, _ in turns if t is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[1][:1] + b[1][:1] not in cr.LEGAL for a, b in itertools.pairwise(turns))
        found[conv] = (gaps, *faults, illegal, cost, edits, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return found


def odd_conversations():
    rng = random.Random(4)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", None, "", " ", "ünder"]
    texts = ["Yes.", "No", "", None, " \t", "Why?", "x" * 70_000 + ".", "a ", "end.\x0b", "!"]
    rows = [
        (rng.choice([*range(40), None]), rng.choice([*range(9), None]), rng.choice(roles), rng.choice(texts)) for _ in range(300)
    ]
    return rows + rows[:40]


SUMMARY = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def test_audit_equals_the_plain_version(spark):
    rows = odd_conversations()
    got = {r["conv_id"]: tuple(r[c] for c in SUMMARY) for r in cr.audit_conversations(conversations(spark, rows).drop("present")).collect()}
    assert got == plain_repair(rows)


def test_repaired_turns_have_the_hash_and_legal_roles(spark):
    frame = conversations(spark, odd_conversations()).drop("present")
    hashes = {r["conv_id"]: r["repaired_sha256"] for r in cr.audit_conversations(frame).collect()}
    turns = defaultdict(list)
    for r in sorted(cr.repaired_turns(frame).collect(), key=lambda r: (r["conv_id"] is not None, r["conv_id"] or 0, r["place"])):
        assert r["place"] == len(turns[r["conv_id"]])
        turns[r["conv_id"]].append(r)
    for conv, value in hashes.items():
        lines = "\n".join(f"{r['role']}:{r['text']}" for r in turns[conv])
        assert hashlib.sha256(lines.encode()).hexdigest() == value
        initials = "".join(r["role"][0] for r in turns[conv])
        assert initials.removeprefix("s") == "ua" * (len(initials) // 2)


def test_damage_and_conversations_without_rows(spark):
    rows = [(i, t, "user", "Some. Text!") for i in range(60) for t in range(3)]
    rows += [(i, None, None, None) for i in range(60, 160)]
    damaged = []
    for conv, turn, role, text in rows:
        kind = zlib.crc32(f"{conv}:{' ' if turn is None else turn}".encode()) % 20
        text = " " if text is None else text
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        row = conv, turn, "user" if kind == 4 else " " if role is None else role, text
        damaged += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    frame = cr.damage(spark.createDataFrame(rows, COLUMNS))
    kept = [tuple(r)[:4] for r in frame.where("present").collect()]
    key = lambda r: tuple((x is not None, x or 0 if isinstance(x, int) else x) for x in r)
    assert sorted(kept, key=key) == sorted(damaged, key=key)
    got = {r["conv_id"]: tuple(r[c] for c in SUMMARY) for r in cr.audit_conversations(frame).collect()}
    want = {i: (0, 0, 0, 0, 0, 0, "", EMPTY) for i in range(160)} | plain_repair(damaged)
    assert got == want and any(r[6] == "" for r in want.values())


def test_no_conversations(spark):
    empty = spark.createDataFrame([], COLUMNS)
    assert cr.audit_conversations(cr.damage(empty)).collect() == []
    assert cr.repaired_turns(empty).collect() == []
    assert ct.conversation_trie(empty).collect() == []


# ---- operator 12


def plain_trie(lists):
    """(conv_id, depth) to what a node's subtree holds, from conv_id to (role, text) turns."""
    members, ends = defaultdict(list), defaultdict(list)
    for conv, turns in lists.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for path, several in members.items():
        own = (len(several) - 1) * len(path[-1][1].encode()) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += own
            leaves[path[:d]] += not children[path]
    return {
        (min(m), len(p)): (
            min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p],
            hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest(),
        )
        for p, m in members.items()
    }


NODE = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def found_trie(rows):
    got = rows.collect()
    nodes = {(r["conv_id"], r["depth"]): tuple(r[c] for c in NODE) for r in got}
    assert len(nodes) == len(got)
    return nodes


def lists_of(rows):
    lists = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            lists[conv].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(turns)] for c, turns in lists.items()}


def many_conversations(seed):
    """Few different turns, so that beginnings are shared at every depth; a hot beginning and many copies."""
    rng, rows = random.Random(seed), []
    for conv in range(-20, 220):
        shared = [("system", "S"), ("user", "hot")] if conv % 3 == 0 else []
        turns = shared + [(rng.choice(["user", "assistant", None]), rng.choice(["a", "bé", "", None])) for _ in range(rng.randrange(6))]
        turns = [("user", "copy"), ("assistant", "copy")] if conv % 7 == 0 else turns
        turns = [("user", f"{i % 3}") for i in range(rng.choice([90, 130, 131]))] if conv % 50 == 1 else turns
        rows += [(conv, None if i == 0 and conv % 2 else i, role, text) for i, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_trie_equals_all_prefixes(spark, seed):
    rows = many_conversations(seed)
    rows += [(None, 0, "user", "nobody")]
    assert found_trie(ct.conversation_trie(conversations(spark, rows))) == plain_trie(lists_of(rows))


def test_conversations_without_turns(spark):
    lists = {1: [], 2: [], 3: [("user", "x")], 5: [("user", "x"), ("assistant", "é")]}

    def frame(lists):
        made = [(c, [(hashlib.md5(repr(t).encode()).digest(), len(t[1].encode())) for t in turns]) for c, turns in lists.items()]
        return spark.createDataFrame(made, "conv_id bigint, turns array<struct<digest:binary,size:bigint>>")

    assert found_trie(ct.trie_nodes(ct.sequences(frame(lists)))) == plain_trie(lists)
    assert found_trie(ct.trie_nodes(ct.sequences(frame({1: [], 2: []})))) == plain_trie({1: [], 2: []})


def test_rebuilt_beginnings(spark):
    rows = [r for r in many_conversations(3) if r[0] >= 0 and r[0] % 10 != 5]
    lists = lists_of(rows)
    want = {}
    for conv, turns in lists.items():
        taken = zlib.crc32(str(conv).encode()) % 9
        want[conv] = lists.get(conv - conv % 5, [])[:taken] + turns[taken:]
    got = ct.trie_nodes(ct.sequences(ct.rebuilt(ct.turn_lists(conversations(spark, rows)))))
    assert found_trie(got) == plain_trie(want)


def test_handles_are_the_fattest_depths(spark):
    rng = random.Random(6)
    pairs = [(low, low + 1 + rng.randrange(200)) for low in [0, 0, *(rng.randrange(300) for _ in range(100))]]
    got = spark.createDataFrame(pairs, "low int, high int").select("low", "high", ct._fattest(F.col("low"), F.col("high")).alias("f"))
    for r in got.collect():
        assert r["f"] == max(range(r["low"] + 1, r["high"] + 1), key=lambda x: x & -x)


def test_whole_conversations_against_sql(spark):
    import check

    sf_dir = os.environ.get("RUNSCOPE_TEST_TABLES", "/root/testdata/sf0.01")
    con = check.connect(sf_dir)
    for name in ("op11_conversation_repair", "op12_conversation_trie"):
        assert check.differences(spark, con, name, sf_dir)[0] == []
