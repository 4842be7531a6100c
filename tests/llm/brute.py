"""Plain versions of the operators' rules, for small fixtures."""

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})

TEXT = "the quick brown fox jumps over the lazy dog while seven small boats drift slowly past the old stone bridge near our quiet town every single morning before anyone else has woken up and gone outside to work".split()


def document(n: int, edits: dict | None = None) -> str:
    """n words, some replaced."""
    w = [f"{TEXT[i % len(TEXT)]}{i // len(TEXT) or ''}" for i in range(n)]
    for i, x in (edits or {}).items():
        w[i] = x
    return " ".join(w)


def jaccard_components(rows, k=3, percent=90):
    sets, up = {}, {}
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets[i] = frozenset(tuple(w[j : j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset()
        up[i] = i

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            if x < y and sets[x] and sets[y] and 100 * len(sets[x] & sets[y]) >= percent * len(sets[x] | sets[y]):
                a, b = find(x), find(y)
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in ids}


def collocations(rows, least=100, longest=5, top=2000):
    """(lang, rank, phrase, a, l, r, n, score) by counting every phrase of every text."""
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, c in f.items():
        candidates = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        gone = set()
        for p, a in candidates.items():
            parts = {p[i:j] for i in range(len(p)) for j in range(i + 2, len(p) + 1) if j - i < len(p)}
            gone |= {q for q in parts if 100 * a >= 100 * candidates[q]}
        found = []
        for p, a in candidates.items():
            if p not in gone:
                score, k = min((1000 * a * n[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], n[lang], -x[0]) for i, x in enumerate(sorted(found)[:top])]
    return sorted(out)
