"""Plain Python versions of the operators, for small tables held in memory."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

SPACES = " \t\n\x0b\x0c\r"


def words(text):
    out, word = [], ""
    for c in text or "":
        if c in SPACES:
            if word:
                out.append(word)
            word = ""
        else:
            word += c
    return [*out, word] if word else out


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def shingles(text, k=5):
    w = words(lower(text))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def near_duplicates(docs):
    """doc_id -> (n_shingles, component_id), from every pair that shares a shingle."""
    sets = [(d, shingles(t)) for d, t in docs]
    parent = list(range(len(sets)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    holders = defaultdict(list)
    for i, (_, s) in enumerate(sets):
        common = Counter(j for x in s for j in holders[x])
        for j, both in common.items():
            if 100 * both >= 75 * (len(s) + len(sets[j][1]) - both):
                parent[root(i)] = root(j)
        for x in s:
            holders[x].append(i)
    least = {}
    for i, (d, _) in enumerate(sets):
        r = root(i)
        least[r] = min(least.get(r, d), d)
    return {d: (len(s), least[root(i)]) for i, (d, s) in enumerate(sets)}


def repeats(docs, k=13):
    """doc_id -> (n_words, n_removed, kept text)."""
    first = {}
    for d, t in docs:
        w = words(t)
        for i in range(len(w) - k + 1):
            g = tuple(w[i : i + k])
            first[g] = min(first.get(g, d), d)
    out = {}
    for d, t in docs:
        w = words(t)
        gone = {j for i in range(len(w) - k + 1) if first[tuple(w[i : i + k])] < d for j in range(i, i + k)}
        out[d] = (len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone))
    return out


def sha256(text):
    return hashlib.sha256(text.encode()).hexdigest()


def repeated_words(w, k=5):
    at = defaultdict(list)
    for i in range(len(w) - k + 1):
        at[tuple(w[i : i + k])].append(i)
    return len({j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + k)})


def base_failed(text):
    w = words(text)
    return len(w) < 10 or 100 * repeated_words(w) > 20 * len(w)


def without_boilerplate(docs, sites=10):
    """(doc_id, text, site) rows -> doc_id -> text without lines that are on many sites, or None if nothing is left."""
    on, first = defaultdict(set), {}
    for d, t, s in docs:
        for line in (t or "").split("\n"):
            if words(line):
                on[line].add(s)
                first[line] = min(first.get(line, d), d)
    out = {}
    for d, t, _ in docs:
        lines = (t or "").split("\n")
        kept = [x for x in lines if not (words(x) and len(on[x] - {None}) >= sites and first[x] < d)]
        out[d] = t if len(kept) == len(lines) else ("\n".join(kept) if any(map(words, kept)) else None)
    return out


def leaked(docs, items, width=8, least=6, literals=4):
    """doc_id -> items whose template windows lie in a row in the document, with slots that agree.

    Words are read as templates by the operator; windows, alignments and slots are gone through one by one.
    """
    from corpuskit.llm.template_leaks import _EDGES, template

    def windows(text):
        words = (text or "").split()
        if len(words) < width:
            return
        for form, (hashes, slots) in enumerate(template(words)):
            for i in range(len(words) - width + 1):
                if width - sum(slots[i : i + width]) >= min(literals, width):
                    values = tuple(words[j].strip(_EDGES).lower() for j in range(i, i + width) if slots[j])
                    yield form, tuple(hashes[i : i + width].tolist()), i, values

    places, total = defaultdict(list), Counter()
    for item, text in items:
        for form, window, at, values in windows(text):
            places[form, window].append((item, at, values))
            total[item, form] += 1
    out = {}
    for doc, text in docs:
        lines = defaultdict(lambda: (set(), set()))
        for form, window, at, values in windows(text):
            for item, there, theirs in places.get((form, window), ()):
                matched, pairs = lines[item, form, at - there]
                matched.add(at)
                pairs.update(zip(theirs, values))
        out[doc] = {
            item
            for (item, form, _), (matched, pairs) in lines.items()
            if len(matched) >= min(least, total[item, form]) and len({a for a, _ in pairs}) == len(pairs)
        }
    return out
