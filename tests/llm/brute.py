"""Plain Python versions of the corpus contracts, for small tables."""

import re
import string
from collections import Counter, defaultdict

_LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def spaced_words(text):
    return [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(_LOWER)) if w]


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(_LOWER))


def shingles(text, size=5):
    words = spaced_words(text)
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_groups(rows, part=85, whole=100):
    """id to smallest reachable id, from (id, text)."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    common = Counter((a, b) for h in holders.values() for a in h for b in h if a < b)
    links = [
        (a, b) for (a, b), n in common.items() if whole * n >= part * (len(sets[a]) + len(sets[b]) - n)
    ]
    return roots(sets, links), {i: len(s) for i, s in sets.items()}


def contamination(rows, items, width=13):
    """id to (n_words, n_hit, items) from (id, text) and (item, text)."""
    windows = defaultdict(set)
    for item, text in items:
        words = plain_words(text)
        size = min(width, len(words))
        for i in range(len(words) - size + 1) if size else ():
            windows[tuple(words[i : i + size])].add(str(item))
    sizes = {len(w) for w in windows}
    out = {}
    for i, text in rows:
        words, hit, found = plain_words(text), set(), set()
        for size in sizes:
            for at in range(len(words) - size + 1):
                if (own := windows.get(tuple(words[at : at + size]))) is not None:
                    hit |= set(range(at, at + size))
                    found |= own
        out[i] = (len(words), len(hit), sorted(found))
    return out


def base_scores(rows, held_out):
    """id to (n_tokens, n_known, N, score), from (id, text) and a rule."""
    import math

    counts = Counter()
    for i, text in rows:
        if not held_out(i):
            counts.update([*spaced_words(text), None])
    total, distinct = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        tokens = [*spaced_words(text), None]
        score = sum(math.log10((counts[t] + 1) / (total + distinct + 1)) for t in tokens)
        out[i] = (len(tokens), sum(counts[t] > 0 for t in tokens), total, score)
    return out
