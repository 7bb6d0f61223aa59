"""Linked and discovered spans, match rows and the fit of the classifier against plain versions."""

import math
import random
from collections import defaultdict

import brute
import numpy as np
import pytest
from conftest import words
from pyspark.sql import functions as F

from runscope.llm import personal_data as pd_, phrase_index as pi, quality_classifier as qc, secrets, spans as sn
from runscope.llm.phrase_index import SLACK


def overlap(a, b):
    return a["start"] < b["end"] and b["start"] < a["end"]


@pytest.mark.parametrize("few_pairs", [0, 40, 10**9])
def test_free_spans_equal_all_pairs(spark, few_pairs):
    rng, rows, want = random.Random(3), [], {}
    for i in range(60):
        spans = sorted({(s := rng.randrange(100), 0, "a", s + rng.randrange(1, 9)) for _ in range(rng.randrange(14))})
        others = sorted({(s := rng.randrange(100), 1, "b", s + rng.randrange(1, 30)) for _ in range(rng.randrange(6))})
        doc = None if i % 20 == 0 else i
        rows += [(doc, i, spans, others)] * (1 + i % 2)
        want[i] = [s for s in spans if not any(s[0] < o[3] and o[0] < s[3] for o in others)]
    frame = spark.createDataFrame(rows, f"doc_id bigint, key bigint, weak array<{sn.SPAN}>, strong array<{sn.SPAN}>")
    got = sn.with_free(frame, ["doc_id", "key"], "weak", "strong", few_pairs).collect()
    assert len(got) == len(rows)
    assert all([tuple(s) for s in r["weak"]] == want[r["key"]] for r in got)


def credential_texts():
    rng = random.Random(4)
    parts = [
        "user_id=alice", "client_id: bob77", "https://db.example.org/x", "redis://u:p@h/0", "pwd: hunter2", "auth=abcd1234",
        "wJalrXUtnFEMIbPxRfiCYEXAMPLEKEYabcd0", "AKIA" + "B" * 16, "password=longenough", "0123456789abcdef01234567", "token: xyz98765",
    ]
    return [(i, " ".join(x for _ in range(rng.randrange(9)) for x in (rng.choice(parts), "w " * rng.randrange(140)))) for i in range(150)]


def test_linked_spans_equal_all_pairs(frame):
    docs = frame(credential_texts())
    texts = docs.select("doc_id", secrets.strong_spans(F.col("text")).alias("s"), secrets.weak_spans(F.col("text")).alias("w"))
    roles = secrets.STRONG | {kind: role for kind, (role, _) in secrets.WEAK.items()}
    want = {}
    for r in texts.collect():
        loose = [w for w in r["w"] if not any(overlap(w, s) for s in r["s"])]
        linked = [
            w
            for w in loose
            if any(
                (roles[w["kind"]] == "secret") != (roles[q["kind"]] == "secret")
                and q["start"] <= w["end"] + secrets.REACH
                and w["start"] - secrets.REACH <= q["end"]
                for q in [*r["s"], *loose]
            )
        ]
        want[r["doc_id"]] = ",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in sorted([*r["s"], *linked]))
    got = {r["doc_id"]: (r["spans"], r["n_linked"]) for r in secrets.find_secrets(docs).collect()}
    assert {i: s for i, (s, _) in got.items()} == want
    assert sum(n for _, n in got.values()) > 50


def plain_graph(edges, rounds):
    """Accepted values from (pattern, value, seed) to count."""
    import re

    secret = {k: not k[2] and bool(re.search(pd_.SECRET, k[1])) for k in edges}
    score, found = {k: float(k[2]) for k in edges}, {}
    for _ in range(rounds):
        total, mass, seeds = defaultdict(float), defaultdict(int), defaultdict(int)
        for k, n in edges.items():
            total[k[0]] += score[k] * n
            mass[k[0]] += n
            seeds[k[0]] += k[2]
        trust = {p: total[p] / (mass[p] + 1) for p in mass}
        trusted = {p: t for p, t in trust.items() if seeds[p] >= pd_.SUPPORT and t >= pd_.CONFIDENCE}
        missing = defaultdict(float)
        for p, v, seed in edges:
            if not seed and not secret[p, v, seed] and p in trusted:
                missing[v] += math.log(1 - trusted[p])
        found = {v for v, x in missing.items() if 1 - math.exp(x) >= pd_.CONFIDENCE}
        score = {k: 1.0 if k[2] else 0.0 if secret[k] else float(k[1] in found) for k in edges}
    return found


@pytest.mark.parametrize("rounds", [0, 1, 2, 3])
def test_accepted_values_equal_the_plain_graph(spark, rounds):
    rng, edges = random.Random(5), {}
    for p in range(25):
        good = p % 3
        for _ in range(rng.randrange(1, 30)):
            seed = rng.random() < (0.97 if good else 0.5)
            value = f"s{rng.randrange(200)}" if seed else rng.choice(["AKIA" + "C" * 16, *(f"ID-{k}{k}{k}" for k in range(30))])
            edges[f"p{p}", value, seed] = rng.randrange(1, 40 if seed and good else 4)
    rows = [(*k, n) for k, n in edges.items()]
    frame = spark.createDataFrame(rows, "pattern string, value string, seed boolean, n bigint")
    got = {r["value"] for r in pd_.accepted_values(frame, rounds=rounds).collect()}
    assert got == set(plain_graph(edges, rounds)) and bool(got) == (rounds > 0)


def test_no_round_discovers_nothing(frame):
    rows = [(i, f"text {i} please contact user{i}@mail.example.com now") for i in range(30)] + [(100, "so please contact ID-778812-K today")]
    got = {r["doc_id"]: r["n_context"] for r in pd_.find_personal_data(frame(rows), rounds=0).collect()}
    assert len(got) == 31 and not any(got.values())


def plain_matches(docs, items):
    """Match rows by trying every place."""
    text_words = {i: brute.plain(t) for i, t in docs.items()}
    frequency = defaultdict(int)
    for w in text_words.values():
        for x in w:
            frequency[x] += 1
    windows = defaultdict(set)
    for item, text in items:
        w = brute.plain(text)
        for k in range(max(1, len(w) - 9)) if w else []:
            windows[tuple(w[k : k + 10])].add(str(item))
    rows = set()
    for window, names in windows.items():
        if not all(x in frequency for x in window):
            continue
        rarest = min(range(len(window)), key=lambda k: (frequency[window[k]], k))
        for doc, w in text_words.items():
            near = False
            for j in (j for j, x in enumerate(w) if x == window[rarest]):
                begin = j - rarest
                if begin >= 0 and tuple(w[begin : begin + len(window)]) == window:
                    rows |= {(doc, n, begin, begin + len(window), "exact") for n in names}
                    continue
                low, high = max(0, j - len(window) - SLACK), min(len(w), j + len(window) + SLACK + 1)
                if not near and set(window) <= set(w[low:high]):
                    near = True
                    rows |= {(doc, n, low, high, "near") for n in names}
    return rows


@pytest.mark.parametrize("block_words, anchors", [(50, 7), (10**6, 500_000)])
def test_match_rows_equal_brute_force(spark, frame, monkeypatch, block_words, anchors):
    monkeypatch.setattr(pi, "ANCHORS", anchors)
    rng = random.Random(9)
    items = [(i, " ".join(words(rng, rng.choice([1, 3, 5, 10, 12]), 25))) for i in range(25)] + [(40, items_text := "w1 w1 w2"), (41, items_text)]
    docs = {i: " ".join(words(rng, 50, 25)) for i in range(30)}
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = pi.match_rows(frame(docs.items()), bench, block_words=block_words).collect()
    assert len(got) == len({tuple(r) for r in got})
    assert {tuple(r) for r in got} == plain_matches(docs, items)
    assert {r["kind"] for r in got} == {"exact", "near"}


def test_fit_and_cut_equal_plain_ones():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4)) * [1, 5, 0.1, 2] + 3
    wish = x @ [1.0, 0.2, -4.0, 0.0] + rng.normal(size=300)
    good = wish > np.median(wish)
    model = qc.learn(x, good, pairs=4_000)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    draw = np.random.default_rng(9)
    pairs = [(draw.choice(np.nonzero(good)[0], 4_000)), (draw.choice(np.nonzero(~good)[0], 4_000))]
    diff = z[pairs[0]] - z[pairs[1]]
    # Plain gradient descent on the same loss.
    w = np.zeros(4)
    for _ in range(4_000):
        w += 0.5 * ((diff * (1 / (1 + np.exp(diff @ w)))[:, None]).mean(axis=0) - 1e-3 * w)
    assert np.allclose(model.weights, w, atol=1e-4)
    strength = z @ model.weights
    right = {float(np.quantile(strength, q / 400)): 0 for q in range(401)}
    for cut in right:
        right[cut] = sum(bool(s >= cut) == bool(g) for s, g in zip(strength, good)) / len(good)
    best = max(right.values())
    assert model.cut == min(c for c, r in right.items() if r >= best - qc.TOLERANCE)
    assert np.allclose(model.scores(x), 1 / (1 + np.exp(-(strength - model.cut + math.log(0.7 / 0.3)))))


@pytest.mark.parametrize("count", [1, 50, 700, 5_000])
def test_first_by_hash_sorts_few_rows(spark, count):
    rows = spark.range(2_000).select(F.xxhash64("id").alias("at"), "id")
    want = [r["id"] for r in rows.orderBy("at", "id").limit(count).collect()]
    assert [r["id"] for r in qc.first_by_hash(rows, count, "at", "id").collect()] == want
    few = rows.where("at > 0").withColumn("at", F.lit(2**63 - 1))
    assert qc.first_by_hash(few, 10, "at", "id").count() == 10
