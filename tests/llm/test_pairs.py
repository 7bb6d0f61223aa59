"""Operators on pairs and lines: near duplicates, line alignment, components, decontamination."""

import random

import numpy as np
import pytest
from conftest import words
from hypothesis import given, settings, strategies as st

import brute
from runscope.llm import line_alignment as la, near_duplicates as nd, phrase_index as pi, sketches as sk
from runscope.llm.components import components
from runscope.llm.texts import WordHashes


def edited(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        k = rng.randrange(len(out))
        out[k : k + 1] = rng.choice([[], ["new%d" % rng.randrange(10**6)], [out[k], "more"]])
    return out


def copies(seed, groups=12, per_group=14):
    rng, docs = random.Random(seed), {}
    for _ in range(groups):
        base = words(rng, rng.choice([3, 7, 60, 150]), 100_000)
        for _ in range(per_group):
            docs[len(docs) * 3 + 1] = " ".join(edited(rng, base, rng.randrange(0, 6)))
    return docs


def check_near_duplicates(found, docs):
    want = brute.near_duplicates(docs)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found.collect()}
    assert got == want


def test_near_duplicates_equal_brute_force(frame):
    docs = copies(1)
    check_near_duplicates(nd.near_duplicates(frame(docs.items())), docs)


@pytest.mark.parametrize("crowd", [12, 1000])
def test_links_off_the_center_are_found(frame, monkeypatch, crowd):
    """Many variants of one text, of which only some are linked, and few with the smallest."""
    rng, docs = random.Random(2), {}
    base = words(rng, 120, 100_000)
    for i in range(40):
        docs[i] = " ".join(edited(rng, base, rng.randrange(0, 9)))
    monkeypatch.setattr(nd, "CROWD", crowd)
    check_near_duplicates(nd.near_duplicates(frame(docs.items())), docs)


def test_near_duplicates_odd_rows(frame, odd_rows):
    found = nd.near_duplicates(frame(odd_rows)).collect()
    assert len(found) == len(odd_rows)
    by = {(r["doc_id"], r["n_shingles"]): r for r in found}
    assert by[1, 0]["component_id"] == 1 and by[2, 0]["kept"] and by[3, 0]["kept"]
    assert by[6, 76]["component_id"] == 5 and not by[6, 76]["kept"] and not by[10, 76]["kept"]
    assert by[None, 76]["component_id"] == 5 and not by[None, 76]["kept"]
    assert nd.near_duplicates(frame([])).count() == 0


def test_keep_first_leaves_one_of_each_group(frame, odd_rows):
    docs = frame(odd_rows)
    left = nd.keep_first(docs)
    assert left.columns == docs.columns
    kept = [r["doc_id"] for r in left.collect()]
    assert sorted(kept, key=lambda x: (x is None, x)) == [1, 2, 3, 4, 5, 7, 8, 9, None]


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    sets = [pool[:1], pool[:3], pool[:200], pool[20:220], pool[:0], pool]
    rows = sk.sketches(sets)
    assert (rows[[0, 1, 2, 3, 5]] != sk._EMPTY).all() and (rows[4] == sk._EMPTY).all()
    assert abs((rows[2] == rows[3]).mean() - 180 / 220) < 0.12


def test_shingles_match_words():
    hashes = WordHashes(limit=3)
    for text in ("", "a", "a b c d", "A b c d e", "a b c d e f a b c d e f"):
        assert len(sk.shingles(text.encode(), hashes)) == len(brute.shingles(text))
    assert sk.fingerprint(sk.shingles(b"A b", hashes)) == sk.fingerprint(sk.shingles(b"a  B", hashes))


def test_components_of_chains_stars_and_rings(spark):
    edges = [(i + 1, i) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 201), (201, 202), (202, 200), (5, 5)]
    found = components(spark.createDataFrame(edges, "u int, v int")).collect()
    got = {r["node"]: r["root"] for r in found}
    assert got == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 30)}, 201: 200, 202: 200}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 6), max_size=14), st.lists(st.integers(0, 6), max_size=14))
def test_alignment_is_increasing_and_equal(a, b):
    pairs = la.aligned(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))


def test_alignment_of_unique_lines_is_a_longest_one():
    rng = random.Random(3)
    for _ in range(50):
        a, b = rng.sample(range(1, 12), 9), rng.sample(range(1, 12), 9)
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        found = len(la.aligned(a, b))
        # Equal ends are taken first, which costs nothing.
        assert found == best[-1][-1]


LINE = "one two three four five six seven eight nine ten {}"


def test_common_blocks_go_from_the_later_document(frame):
    a, b, c = (LINE.format(x) for x in "abc")
    rows = [
        (1, f"{a}\nmine\n{b}\n{c}"), (2, f"other\n{b}\n{c}\nend"), (3, f"{a}\nx\n{b}"), (4, "mine\nother"), (5, f"{a}\nmine\n{b}\n{c}"),
    ]
    got = {r["doc_id"]: r for r in la.clean(frame(rows)).collect()}
    assert [got[i]["_runscope_text"] for i in range(1, 5)] == [rows[0][1], "other\nend", "x", "mine\nother"]
    assert got[5]["_runscope_removed"] == 4 and got[1]["_runscope_removed"] == 0
    kept = la.drop_common_lines(frame(rows))
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4}


def test_frequent_lines_have_their_first_document_as_partner(frame):
    rows = [(i, f"{LINE.format('z')}\nown {i}") for i in range(60)]
    got = {r["doc_id"]: r["text"] for r in la.drop_common_lines(frame(rows)).collect()}
    assert got == {0: rows[0][1], **{i: f"own {i}" for i in range(1, 60)}}


def test_line_alignment_odd_rows(frame, odd_rows):
    docs = frame(odd_rows)
    done = la.summarise(docs).collect()
    assert len(done) == len(odd_rows)
    assert {(r["doc_id"], r["n_removed"]) for r in done if r["doc_id"] in (5, 6, None, 1)} == {(5, 0), (6, 1), (None, 1), (None, 0), (1, 0)}
    assert la.drop_common_lines(docs).columns == docs.columns
    assert la.summarise(frame([])).count() == 0


def contaminated(frame, docs, items, spark, **settings_):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = pi.contamination(frame(docs.items()), bench, **settings_).collect()
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in rows}, {r["doc_id"]: r["n_near"] for r in rows}


@pytest.mark.parametrize("block_words", [50, 500_000])
def test_contamination_equals_brute_force(spark, frame, block_words):
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, rng.choice([1, 4, 10, 11, 25]), 60))) for i in range(30)]
    items += [(30, None), (31, ""), (32, items[3][1]), (None, items[4][1])]
    docs = {i: " ".join(words(rng, 60, 60)) for i in range(40)}
    for i in range(0, 40, 3):
        passage = brute.plain(items[i % 30][1])
        docs[i] = f"{docs[i]}, {' '.join(passage).upper()}! {' '.join(passage[:9])} {docs[i]}"
    docs |= {50: None, 51: "", 52: "..."}
    got, near = contaminated(frame, docs, items, spark, block_words=block_words)
    named = [x for x in items if x[0] is not None]
    assert got == brute.contamination(docs, named + [(4, items[4][1])])
    assert all(near[i] >= got[i][2] for i in docs)


def test_proximity_matches_need_all_words_close_by(spark, frame):
    text = "a1 a2 a3 a4 a5 a6 a7 a8 a9 a10"
    docs = {
        1: text, 2: "a10 a9 a8 a7 a6 a5 a4 a3 a2 a1", 3: "a1 a2 a3 a4 a5 x y z a6 a7 a8 a9 a10",
        4: "a1 a2 a3 a4 a5 " + "x " * 40 + "a6 a7 a8 a9 a10", 5: text.replace("a7", "b7"),
    }
    got, near = contaminated(frame, docs, [(1, text)], spark)
    assert [got[i][4] for i in range(1, 6)] == [True, False, False, False, False]
    assert [near[i] for i in range(1, 6)] == [1, 1, 1, 0, 0]


def test_contamination_odd_rows(spark, frame, odd_rows):
    docs = frame(odd_rows)
    bench = spark.createDataFrame([(1, odd_rows[4][1])], "item_id bigint, text string")
    assert pi.contamination(docs, bench).where("contaminated").count() == 5
    clean = pi.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == len(odd_rows) - 5
    assert pi.contamination(frame([]), bench).count() == 0
    assert pi.contamination(docs, bench.limit(0)).where("n_hit = 0").count() == len(odd_rows)


def test_shingle_sets_of_many_texts_are_those_of_each(odd_rows):
    """words are hashed from their bytes for many texts at once; sets are equal and overlap as word by word."""
    texts = [(t or "").encode() for _, t in odd_rows] + [b"a", b"A b", b"a  B", b"x" * 70, b"x" * 71, b"a\x00 a", b"a a", b"a a a a a a"]
    found, hashes = sk.shingle_sets(texts), WordHashes()
    plain = [sk.shingles(t, hashes) for t in texts]
    assert sk.shingle_sets([]) == [] and len(found) == len(texts)
    for i, (a, x) in enumerate(zip(plain, found)):
        assert len(a) == len(x) == len(brute.shingles(texts[i].decode())) and np.array_equal(x, sk.shingle_sets(texts[i : i + 1])[0])
        assert all(len(np.intersect1d(a, b)) == len(np.intersect1d(x, y)) for b, y in zip(plain, found))


def test_candidates_start_from_members_that_are_not_linked_yet():
    """all pairs with such a member are found, and no others."""
    rng = np.random.default_rng(3)
    n = 400
    members = {"size": rng.integers(90, 110, n), "differs": rng.integers(20, 60, n), "at": rng.integers(0, 12, n), "fresh": rng.random(n) < 0.05, "component": rng.integers(0, 90, n)}
    members |= {"member": np.array([b"%04d" % k for k in rng.permutation(n)]), "sketch": np.tile(rng.integers(0, 255, 64).astype(np.uint8), (n, 1))}
    found = set(nd._candidates(members, 85))
    share = 0.85
    rest = members["differs"] - members["at"]
    wanted = set()
    for i in range(n):
        for k in range(i + 1, n):
            needed = (members["differs"][i] + members["differs"][k] - (1 - share) / (1 + share) * (members["size"][i] + members["size"][k])) / 2 - 1e-6
            if (members["fresh"][i] or members["fresh"][k]) and members["component"][i] != members["component"][k] and 100 * min(members["size"][i], members["size"][k]) >= 85 * max(members["size"][i], members["size"][k]) and min(rest[i], rest[k]) >= needed:
                wanted.add(tuple(sorted((members["member"][i], members["member"][k]))))
    assert found == wanted and len(wanted) > 100
