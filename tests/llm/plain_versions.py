"""Plain versions of the operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict


def fold(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", fold(text))


def repeats(rows, length):
    """(id, n_bytes, n_removed, n_spans, sha) of (id, text) rows."""
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[k:k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for k in range(len(b) - length + 1):
            if seen[b[k:k + length]] > 1:
                gone[k:k + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(b), sum(gone), spans,
                    hashlib.sha256(bytes(c for c, g in zip(b, gone) if not g)).hexdigest()))
    return out


def shingle_set(text, k=5):
    w = words(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def jaccard(rows, percent=75):
    """(id, n, component) of (id, text) rows with ids."""
    sets = [(i, shingle_set(t)) for i, t in rows]
    index = defaultdict(list)
    for place, (_, s) in enumerate(sets):
        for gram in s:
            index[gram].append(place)
    shared = Counter()
    for places in index.values():
        for a in range(len(places)):
            for b in range(a):
                shared[places[b], places[a]] += 1
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for (a, b), both in shared.items():
        if 100 * both >= percent * (len(sets[a][1]) + len(sets[b][1]) - both):
            root[find(a)] = find(b)
    least = {}
    for place, (i, _) in enumerate(sets):
        r = find(place)
        least[r] = min(least.get(r, i), i)
    return [(i, len(s), least[find(place)]) for place, (i, s) in enumerate(sets)]


def lm_base(rows):
    """{id: (held, n_tokens, n_known, train_tokens, base)}."""
    import math
    count, held = Counter(), {}
    for i, t in rows:
        held[i] = zlib.crc32(str(i).encode()) % 5 == 1
        if not held[i]:
            count.update([*words(t), None])
    total, distinct = sum(count.values()), len(count)
    out = {}
    for i, t in rows:
        own = [*words(t), None]
        base = sum(math.log10((count[w] + 0.5) / (total + 0.5 * (distinct + 1))) for w in own)
        out[i] = held[i], len(own), sum(count[w] > 0 for w in own), total, base
    return out


def passages(docs, items, similarity=0.75):
    """{(doc, item): best similarity} by weighted shingles of every window."""
    import math
    n = len(items)
    grams = {}
    for i, t in items:
        w = words(t)
        if w:
            k = min(5, len(w))
            grams[i] = (len(w), k, [tuple(w[j:j + k]) for j in range(len(w) - k + 1)])
    own = Counter(g for _, _, bag in grams.values() for g in set(bag))
    weight = lambda g: math.log1p(n / own[g]) if g in own else math.log1p(max(1, n))
    out = {}
    for d, t in docs:
        w = words(t)
        for i, (size, k, bag) in grams.items():
            theirs = Counter(bag)
            for j in range(len(w) - size + 1):
                mine = Counter(tuple(w[j + a:j + a + k]) for a in range(size - k + 1))
                if not mine.keys() & theirs.keys():
                    continue
                low = sum(min(mine[g], theirs[g]) * weight(g) for g in mine.keys() & theirs.keys())
                high = sum(max(mine[g], theirs[g]) * weight(g) for g in mine.keys() | theirs.keys())
                if low / high >= similarity - 1e-12:
                    out[d, i] = max(out.get((d, i), 0), low / high)
    return out
