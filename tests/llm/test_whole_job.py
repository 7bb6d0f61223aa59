"""Results that must not depend on a shortcut: compared with all pairs, all runs, all matches."""

import hashlib
import itertools
import random
from array import array
from re import _constants as rc, _parser as rp

from conftest import words
from pyspark.sql import functions as F

import brute
import corpus_pipeline
from runscope.llm import license_rules, licenses, line_alignment as la, near_duplicates as nd, sentence_pieces as sp, sketches as sk
from runscope.llm.piece_lattice import BLANK, Lattices


def cleaned(frame, docs):
    return {r["doc_id"]: r["_runscope_text"] for r in la.clean(frame(docs.items())).collect()}


def all_pairs(docs, blocks):
    """What stays of each text when it is compared with every earlier document."""
    words_of = {i: [len(x.split()) for x in t.split("\n")] for i, t in docs.items()}
    hashes = {i: [hash(x.strip()) if x.strip() else la.BLANK for x in t.split("\n")] for i, t in docs.items()}
    out = {}
    for b, text in docs.items():
        gone = {k for a in docs if a < b for s, e in blocks(hashes[a], hashes[b], words_of[b]) for k in range(s, e)}
        out[b] = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
    return out


def passage(rng, lines, length=9):
    return [" ".join(words(rng, length, 10**6)) for _ in range(lines)]


def test_a_passage_of_short_lines_that_the_first_holder_has_apart(frame):
    rng = random.Random(11)
    six = passage(rng, 6)
    docs = {1: "\n".join(x for line in six for x in (line, *passage(rng, 1)))}
    docs |= {i: "\n".join([*passage(rng, 1), *six, *passage(rng, 1)]) for i in range(2, 40)}
    got = cleaned(frame, docs)
    assert got[1] == docs[1] and got[2] == docs[2]
    assert all(got[i].split("\n") == [docs[i].split("\n")[k] for k in (0, -1)] for i in range(3, 40))


def test_partners_by_runs_find_what_all_pairs_find(frame):
    """Parts of one text in its order, with lines of their own between them."""
    rng = random.Random(12)
    base = [" ".join(words(rng, rng.choice([1, 3, 4, 6, 9, 14]), 10**6)) for _ in range(60)]
    docs = {}
    for i in range(40):
        kept = [x for k in range(0, 60, 4) if rng.random() < 0.5 for x in base[k : k + rng.randrange(1, 5)]]
        docs[i] = "\n".join(y for x in kept for y in ([x] if rng.random() < 0.8 else [x, *passage(rng, 1, 2)])) or "x"
    assert cleaned(frame, docs) == all_pairs(docs, la.common_blocks)


def every_block(a, b, words_of_b):
    """All longest common runs of lines with ten words, whatever their order, by comparing all places."""
    found = []
    for i in range(len(a)):
        for j in range(len(b)):
            if a[i] == b[j] and not (i and j and a[i - 1] == b[j - 1]):
                n = 1
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n]:
                    n += 1
                if sum(words_of_b[j : j + n]) >= la.MIN_WORDS:
                    found.append((j, j + n))
    return found


def marked(ranges):
    return {k for s, e in ranges for k in range(s, e)}


def lines_and_lengths(rng):
    few = rng.randrange(2, 9)
    size = {x: 0 if x == la.BLANK else rng.choice([1, 3, 5, 9, 12]) for x in range(few)}
    a, b = ([rng.randrange(few) for _ in range(rng.randrange(16))] for _ in "ab")
    return a, b, [size[x] for x in b]


def left_lines(b, ranges):
    gone = marked(ranges)
    return [(1 << 70) + k if k in gone else x for k, x in enumerate(b)]


def test_alignments_leave_no_common_block():
    """Only lines of common blocks go, and of the lines left no ten words in a row are common."""
    rng = random.Random(13)
    for _ in range(3000):
        a, b, lengths = lines_and_lengths(rng)
        got = la.common_blocks(a, b, lengths)
        assert marked(got) <= marked(every_block(a, b, lengths))
        assert every_block(a, left_lines(b, got), lengths) == []
        assert all(e < s for (_, e), (s, _) in zip(got, got[1:]))


def test_the_alignment_decides_what_goes():
    """A line whose block needs lines that are aligned elsewhere stays; a look-up of common runs would take it."""
    a, b, words = [1, 2, 9, 2, 3], [1, 2, 3], [8, 3, 8]
    assert marked(every_block(a, b, words)) == {0, 1, 2}
    assert la.aligned_blocks(a, b, words) in ([(0, 0, 2)], [(3, 1, 2)]) and len(marked(la.common_blocks(a, b, words))) == 2


def test_one_alignment_keeps_the_order():
    p, q, r = [11, 12, 13, 14], [21, 22], [31]
    a, b = [*p, 1, *q, 2, *r], [*q, 3, *r, 4, *p]
    words = [5] * len(b)
    assert la.aligned_blocks(a, b, words) == [(0, 5, 4)]
    # The other ones go in the next alignment, where they have the words.
    assert la.common_blocks(a, b, words) == [(0, 2), (5, 9)]


def shortest_common_run(a, b, words):
    """The most words of a common run, by comparing all places."""
    return max((sum(words[j : j + n]) for i in range(len(a)) for j in range(len(b)) for n in range(1, 17) if i + n <= len(a) and j + n <= len(b) and a[i : i + n] == b[j : j + n]), default=0)


def test_longest_common_run():
    rng = random.Random(17)
    for _ in range(1500):
        a, b, words_of_b = lines_and_lengths(rng)
        i, j, n = la._longest_common_run(a, b, list(itertools.accumulate(words_of_b, initial=0)))
        assert a[i : i + n] == b[j : j + n] and sum(words_of_b[j : j + n]) == shortest_common_run(a, b, words_of_b)


def test_many_repetitions_take_little_time():
    a, b = [5] * 3_000, [x for k in range(3_000) for x in (5, 100 + k)]
    assert marked(la.common_blocks(a, b, [12] * len(b))) == set(range(0, 6_000, 2))
    assert la.common_blocks(b, a, [12] * len(a)) == [(0, 3_000)]
    some = [k % 7 + 1 for k in range(4_000)]
    assert la.common_blocks(some, some[::-1], [3] * 4_000) == []


def test_a_passage_that_is_repeated_in_the_first_or_the_later_document(frame):
    rng = random.Random(14)
    p, own = passage(rng, 4), iter(passage(rng, 200))
    twice = lambda: [next(own), *p, next(own), *p, next(own)]
    docs = {i: [next(own), *p, next(own)] for i in range(2, 30)} | {1: twice(), 30: twice(), 31: twice()}
    got = cleaned(frame, {i: "\n".join(x) for i, x in docs.items()})
    assert got == {i: "\n".join(x if i == 1 else [y for y in x if y not in p]) for i, x in docs.items()}


def test_partners_and_blocks_equal_all_pairs_in_any_order(frame):
    rng = random.Random(15)
    base = ["", *(" ".join(words(rng, rng.choice([1, 2, 4, 6, 11]), 10**6)) for _ in range(12))]
    docs = {}
    for i in range(60):
        parts = [base[k : k + rng.randrange(1, 4)] for k in (rng.randrange(13) for _ in range(6))]
        docs[i] = "\n".join(x for part in parts for x in [*part, *passage(rng, rng.random() < 0.3, 2)])
    lines = {i: [hash(x) if x else la.BLANK for x in t.split("\n")] for i, t in docs.items()}
    counts = {i: [len(x.split()) for x in t.split("\n")] for i, t in docs.items()}
    ranges = {r["doc_id"]: [(x["start"], x["end"]) for x in r["ranges"]] for r in la.common_lines(frame(docs.items())).collect()}
    for b in docs:
        held = [every_block(lines[a], lines[b], counts[b]) for a in docs if a < b]
        assert marked(ranges.get(b, [])) <= marked(x for found in held for x in found)
        # No ten words in a row that stay are in any earlier document.
        left = left_lines(lines[b], ranges.get(b, []))
        assert all(every_block(lines[a], left, counts[b]) == [] for a in docs if a < b)


def test_stage_of_near_duplicates_links_from_80_percent_on(spark, frame):
    rng, docs = random.Random(16), {}
    for g in range(40):
        # The copy shares all but k of n shingles: similarities from 0.75 to 0.88, which 85 percent would split.
        base = words(rng, 104, 10**6)
        docs[2 * g] = " ".join(base)
        docs[2 * g + 1] = " ".join(base[: 104 - 6 - g % 9] + words(rng, 6 + g % 9, 10**6))
    sets = {i: brute.shingles(t) for i, t in docs.items()}
    like = {i: len(sets[i] & sets[i - 1]) / len(sets[i] | sets[i - 1]) for i in range(1, 80, 2)}
    assert any(0.80 <= x < 0.85 for x in like.values()) and min(like.values()) < 0.80 and max(like.values()) > 0.85
    kept = {r["doc_id"] for r in corpus_pipeline.keep_first_copies(spark, frame(docs.items()), "").collect()}
    assert kept == {i for i in docs if i % 2 == 0 or like[i] < 0.80}


def test_bands_and_margin_follow_the_threshold():
    assert (sk.bands_for(85), sk.bands_for(80), sk.bands_for(100)) == (sk.BANDS, 39, 1)
    for percent in (50, 80, 85, 95):
        assert (1 - (percent / 100) ** sk.ROWS) ** sk.bands_for(percent) <= sk.MISS
    assert nd.margin(50) > nd.margin(80) > nd.margin(85)


def shortest(tree):
    """One text for every choice of alternatives and characters, with optional parts left out."""
    options = []
    for op, arg in tree:
        if op is rc.LITERAL:
            options.append([chr(arg)])
        elif op is rc.ANY or op is rc.NOT_LITERAL:
            options.append(["x"])
        elif op is rc.IN:
            options.append([chr(a) for o, a in arg if o is rc.LITERAL] if all(o is rc.LITERAL for o, _ in arg) else ["0" if arg[0][0] is rc.CATEGORY else "x"])
        elif op is rc.BRANCH:
            options.append([x for branch in arg[1] for x in shortest(branch)])
        elif op is rc.SUBPATTERN:
            options.append(list(shortest(arg[3])))
        elif op in (rc.MAX_REPEAT, rc.MIN_REPEAT):
            options.append(["".join(x) for x in itertools.product(shortest(arg[2]), repeat=arg[0])])
        else:
            raise ValueError(op)
    return ["".join(x) for x in itertools.product(*options)]


#: The header of the MPL 1.1 has the same sentence: here the name elsewhere in the text tells whose it is.
NAMED_ELSEWHERE = {"may not use this file except in compliance with the (?:apache )?licen[cs]e"}


def test_every_alternative_of_a_rule_has_its_keyword_and_is_found():
    for order, (label, _, keyword, expression) in enumerate(license_rules.RULES):
        for text in shortest(rp.parse(expression)):
            text += f" {keyword}" * (expression in NAMED_ELSEWHERE)
            assert keyword in text.split(), (label, keyword, text)
            tried = [r for word in text.split() for r in licenses._BY_KEYWORD.get(word.encode(), []) if r[0] == order]
            assert tried and tried[0][3].search(text.encode()), (label, text)


def test_grants_behind_their_keywords_are_found():
    labels = lambda text: licenses.scan(text.encode())[5].split(",")
    assert "unlicense" in labels("This is free and unencumbered software released into the public domain.")
    assert labels("under the FreeBSD license") == labels("as FreeBSD") == ["bsd-2-clause"]
    holder = "the Association of Very Long Names for Research in Computing, its members, " * 2
    assert labels(f"Neither the name of {holder} nor the names of its contributors may be used to endorse or promote products") == ["bsd-3-clause"]
    assert labels("See the licence file for details") == ["licence-file"]


def every_segmentation(lattices, word):
    if not word:
        return [()]
    ends = [(end, piece) for end, piece, _ in lattices._from(word, 0)]
    return [(p, *rest) for end, p in ends for rest in every_segmentation(lattices, word[end:])]


def test_segmentations_of_equal_scores_are_different_ones():
    pieces = {BLANK: (0, -1.0), "a": (1, -1.0), "b": (2, -1.0), "ab": (3, -2.0), "ba": (4, -2.0), "aba": (5, -3.0), "bab": (6, -3.0)}
    lattices = Lattices(pieces, list(range(100, 356)))
    for word in map("".join, (w for k in range(1, 7) for w in itertools.product("ab", repeat=k))):
        valid = set(every_segmentation(lattices, BLANK + word))
        for text, of in ((word, 1), (f"{word} {word}", 2)):
            found = lattices.segment(text, 3)
            assert len(found) == len({tuple(ids) for _, ids in found}) == min(3, len(valid) ** of), text
            assert [(s, ids.tolist()) for s, ids in lattices.segment_arrays(text, 3)] == found
            assert lattices.best_and_scores(text, 3) == (found[0][1], [s for s, _ in found])
        assert {tuple(ids) for _, ids in lattices.segment(word, 100)} == valid


def test_all_segmentations_are_hashed_and_decoded(spark, frame, odd_rows):
    shared, docs = sp.vocabulary(spark), frame(odd_rows)
    texts = {(i, t or "") for i, t in odd_rows}
    rows = sp.with_all_ids(corpus_pipeline.encode(spark, docs, "")).collect()
    value, want = shared.value, {}
    lattices = Lattices(value["pieces"], value["bytes"])
    for i, text in texts:
        found = lattices.segment(text, 3)
        want[i, len(found[0][1]), found[0][0]] = [ids for _, ids in found]
    assert len(rows) == len(odd_rows) and all(r["round_trip"] for r in rows)
    for r in rows:
        assert [s["ids"] for s in r["segmentations"]] == want[r["doc_id"], len(r["ids"]), r["score"]]
    for r in sp.summarise(docs, shared).collect():
        every = want[r["doc_id"], r["n_ids"], r["score"]]
        assert r["segmentations_sha256"] == [hashlib.sha256(array("i", ids).tobytes()).hexdigest() for ids in every]
        assert r["ids_sha256"] == r["segmentations_sha256"][0]


def test_digests_are_those_of_the_ids_returned(spark, frame):
    shared = sp.vocabulary(spark)
    encoded = sp.encode_n_best(frame([(1, "some words of a text"), (2, None)]), shared)
    other = encoded.withColumn("ids", F.transform("ids", lambda i: i + 1))
    for rows in (encoded, other):
        full = {r["doc_id"]: [s["ids"] for s in r["segmentations"]] for r in sp.with_all_ids(rows).collect()}
        for r in sp.digests(rows).collect():
            assert r["segmentations_sha256"] == [hashlib.sha256(array("i", ids).tobytes()).hexdigest() for ids in full[r["doc_id"]]]
            assert (r["n_ids"], r["n_found"]) == (len(full[r["doc_id"]][0]), len(full[r["doc_id"]]))


def test_the_best_segmentation_is_not_listed_again_among_equal_ones():
    pieces = {BLANK: -1, "a": -1, "b": -1, "c": -1, "d": -1, "ca": -3, "ac": -2, BLANK + "dc": -1, "dcac": -3, "aca": -3, "caca": -2}
    lattices = Lattices({p: (k, float(s)) for k, (p, s) in enumerate(pieces.items())}, list(range(100, 356)))
    found = lattices.segment("dcaca", 3)
    assert [s for s, _ in found] == [-4.0] * 3 and len({tuple(ids) for _, ids in found}) == 3


def pieces_of(spark):
    value = sp.vocabulary(spark).value
    return value["pieces"], value["bytes"], value["table"]


def test_words_segmented_together_and_alone_are_the_same(spark):
    pieces, byte_ids, table = pieces_of(spark)
    rng, letters = random.Random(21), ["a", "e", "n", "t", "th", "ing", ".", "\n", "é", "字", "\U0001f600", BLANK, "\0", "1", "ʬ"]
    several = {"".join(rng.choice(letters) for _ in range(rng.randrange(14))) for _ in range(3000)}
    together, alone = Lattices(pieces, byte_ids), Lattices(pieces, byte_ids)
    together.learn(several)
    for word in several:
        at = together._words[word]
        assert (together._scores[at], together._parts[at], together._gaps[at]) == alone._entry(word)


def test_kept_words_have_a_bounded_size_and_change_nothing(spark):
    pieces, byte_ids, _ = pieces_of(spark)
    rng = random.Random(22)
    texts = [" ".join(words(rng, 300, 5_000)) for _ in range(60)] + ["", " ", "x" * 2_000, "字" * 1_500 + " a"]
    small, large = Lattices(pieces, byte_ids, kept_bytes=40_000), Lattices(pieces, byte_ids)
    for text in texts * 2:
        assert small.segmentations(text, 3) == large.segmentations(text, 3)
        assert small._size < 40_000 + 300 * 700 and "x" * 2_000 not in small._words


def test_a_long_text_without_blanks_takes_memory_in_proportion(spark):
    import tracemalloc

    pieces, byte_ids, table = pieces_of(spark)
    lattices, peaks = Lattices(pieces, byte_ids), []
    rng = random.Random(23)
    text = "".join(rng.choice("一二三四五六七八九十abcdefgh。") for _ in range(80_000))
    for size in (20_000, 80_000):
        tracemalloc.start()
        found = lattices.segmentations(text[:size], 3)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
        assert len(found.others) == 2 and sp._same(text[:size], found, table)
    assert peaks[1] < 400 * 80_000 and lattices._size == 0


def test_blocks_of_a_long_text_are_one_text(spark, monkeypatch):
    pieces, byte_ids, _ = pieces_of(spark)
    text = " ".join(words(random.Random(24), 4_000, 3_000)) + "  x "
    whole = Lattices(pieces, byte_ids).segmentations(text, 4)
    monkeypatch.setattr("runscope.llm.piece_lattice.BLOCK", 1_000)
    assert Lattices(pieces, byte_ids).segmentations(text, 4) == whole


def test_groups_of_texts_lose_no_row(spark, frame, monkeypatch):
    rng = random.Random(25)
    rows = [(i, " ".join(words(rng, rng.randrange(60))) or None) for i in range(300)]
    monkeypatch.setattr(sp, "GROUP", 2_000)
    monkeypatch.setattr(sp, "EMIT", 500)
    shared = sp.vocabulary(spark)
    back = {r["doc_id"]: r["text"] for r in sp.decode(sp.encode(frame(rows), shared), shared).collect()}
    assert back == {i: t or "" for i, t in rows}
