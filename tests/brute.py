"""Slow, plain versions of the matching rules, to compare with."""

import re
from fractions import Fraction
from math import ceil


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def fuzzy(name, aliases, share="0.15", edits=None):
    """Canonical of the first alias that holds the name with few enough edits."""
    if not name:
        return None
    k = ceil(Fraction(share) * len(name)) if edits is None else edits
    for _, alias, canonical in aliases:
        a = alias.lower()
        subs = {a[i:j] for i in range(len(a) + 1) for j in range(i, len(a) + 1)}
        if any(abs(len(s) - len(name)) <= k and edit_distance(name.lower(), s) <= k for s in subs):
            return canonical
    return None


def match(names, spec):
    """{name: (canonical, layer)} for one header."""
    names = list(dict.fromkeys(names))
    exact = {a: c for _, a, c in spec.aliases}
    claimed, won = set(), {}

    def layer(label, candidates):
        for n in names:
            if n in won:
                continue
            free = [c for c in candidates(n) if c not in claimed]
            if free:
                won[n] = (free[0], label)
                claimed.add(free[0])

    layer("exact", lambda n: [exact[n]] if n in exact else [])
    layer("fuzzy", lambda n: [f] if (f := fuzzy(n, spec.aliases)) else [])
    layer("keyword", lambda n: [c for c, p in spec.patterns if re.search(p, n, re.I)])
    return won


def make_unique(names):
    out, used = [], set(names)
    first = set()
    for n in names:
        if n not in first:
            first.add(n)
            out.append(n)
            continue
        k = 1
        while f"{n}_{k}" in used:
            k += 1
        used.add(f"{n}_{k}")
        out.append(f"{n}_{k}")
    return out
