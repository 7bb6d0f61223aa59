"""Plain versions of the operators, one text or pair at a time."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict
from zlib import crc32

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FOLD = str.maketrans(UPPER, LOWER)


def spaced(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(FOLD))


def plain(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(FOLD))


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def shingles(text):
    w = spaced(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def near_duplicates(docs, percent=85):
    """docs: id -> text. Returns id -> (n_shingles, component, kept)."""
    sets, root = {i: shingles(t) for i, t in docs.items()}, {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(docs)
    for k, a in enumerate(ids):
        for b in ids[k + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i), find(i) == i) for i in ids}


def contamination(docs, items):
    windows = defaultdict(set)
    for item, text in items:
        w = plain(text)
        for i in range(max(1, len(w) - 9)) if w else []:
            windows[tuple(w[i : i + 10])].add(str(item))
    out = {}
    for i, text in docs.items():
        w, hit, found = plain(text), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit.update(range(k, k + n))
                    found |= windows[tuple(w[k : k + n])]
        out[i] = (len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit))
    return out


def text_counts(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i, x in enumerate(zip(w, w[1:], w[2:])) if windows[x] > 1 for k in range(3)}
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(inside), failed


def base_licenses(text):
    w = plain(text)
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    places = [
        (i, label)
        for phrase, label in phrases.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]
    at = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(w), len(places), min(at, default=None), max(at, default=None), labels


def language_model(docs, order, mu):
    """Scores by walking an explicit automaton, one token at a time."""
    end, start = ("\nend",), ("\nstart",)
    held = {i: crc32(str(i).encode()) % 7 == 2 for i in docs}
    counts, tokens = Counter(), Counter()
    for i, text in docs.items():
        if not held[i]:
            stream = [*start, *spaced(text), *end]
            tokens.update(stream[1:])
            for k in range(1, order + 1):
                counts.update(tuple(stream[j : j + k]) for j in range(len(stream) - k + 1))
    n, v = sum(tokens.values()), len(tokens)

    def probability(context, word):
        if not context:
            return (tokens[word] + 1) / (n + v + 1)
        lower = probability(context[1:], word)
        return (counts[(*context, word)] + mu * lower) / (counts[context] + mu)

    states = {g for g in counts if len(g) < order and g[-1] != end[0]} | {()}
    arcs, failure = {}, {}
    for gram in counts:
        if gram[-1] != start[0] and gram[:-1] in states:
            to = gram
            while to not in states:
                to = to[1:]
            arcs[gram[:-1], gram[-1]] = math.log10(probability(gram[:-1], gram[-1])), to
    for s in states - {()}:
        to = s[1:]
        while to not in states:
            to = to[1:]
        failure[s] = math.log10(mu / (counts[s] + mu)), to
    out = {}
    for i, text in docs.items():
        words = [*spaced(text), *end]
        state, score = start if start in states else (), 0.0
        for w in words:
            while (state, w) not in arcs and state:
                weight, state = failure[state]
                score += weight
            weight, state = arcs.get((state, w), (math.log10(probability((), w)), ()))
            score += weight
        base = sum(math.log10(probability((), w)) for w in words)
        out[i] = held[i], len(words), sum(tokens[w] > 0 for w in words), n, base, score
    return out


ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def _luhn(digits):
    doubled = [int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(digits))]
    return sum(doubled) % 10 == 0


def personal_data(text):
    text, found = text or "", []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        found.append((m.start(), 0, "email", m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, "ip", m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and _luhn(digits):
            found.append((m.start(), 2, "card", m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, "phone", m.end()))
    return sorted(found)


def as_text(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
