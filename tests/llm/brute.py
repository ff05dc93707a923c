"""Plain versions of the operators, row by row, for small inputs."""

import re
from collections import Counter, defaultdict

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALPHANUMERIC = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = SPACED.findall(lowered(text))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def linked(a, b):
    common = len(a & b)
    return bool(a) and bool(b) and 100 * common >= 75 * (len(a) + len(b) - common)


def near_groups(sets):
    """Smallest id reachable of each (key, id, set) by key; ``sets`` maps key to (id, set)."""
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    postings = defaultdict(list)
    for key, (_, own) in sets.items():
        for s in own:
            postings[s].append(key)
    pairs = {(a, b) for found in postings.values() for a in found for b in found if a < b}
    for a, b in pairs:
        if linked(sets[a][1], sets[b][1]):
            parent[find(a)] = find(b)
    low = {}
    for key, (own_id, _) in sets.items():
        if own_id is not None:
            root = find(key)
            low[root] = min(low.get(root, own_id), own_id)
    return {k: low.get(find(k)) for k in sets}


def windows(items):
    """Window words to item ids (as strings; null ids hit but are not listed)."""
    known = defaultdict(set)
    for item_id, text in items:
        words = ALPHANUMERIC.findall(lowered(text))
        size = min(10, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            known[tuple(words[i : i + size])] |= set() if item_id is None else {str(item_id)}
    return known


def contamination(text, known):
    words = ALPHANUMERIC.findall(lowered(text))
    hit, items = set(), set()
    for size in {len(k) for k in known}:
        for i in range(len(words) - size + 1):
            found = tuple(words[i : i + size])
            if found in known:
                hit.update(range(i, i + size))
                items |= known[found]
    return len(words), len(hit), sorted(items)


def text_counts(text):
    text = text or ""
    words = SPACED.findall(text)
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            repeated += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i : i + 5]) for i in range(len(words) - 4))
    inside = {p for i in range(len(words) - 4) if grams[tuple(words[i : i + 5])] > 1 for p in range(i, i + 5)}
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(inside), failed


def mix_targets(sizes, weights=(1, 2, 3), epochs=3):
    """Target of each source by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        open_weight = sum(weight[s] for s in order if s not in capped)
        level = (total - sum(epochs * sizes[s] for s in capped)) / open_weight if open_weight else 0
        over = {s for s in order if level * weight[s] > epochs * sizes[s]} | capped
        if over == capped:
            return {s: epochs * sizes[s] if s in capped else level * weight[s] for s in order}
        capped = over
