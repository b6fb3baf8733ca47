"""Plain versions of what the text operators compute."""

import re
from collections import Counter, defaultdict

WORD = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, n=5):
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def components(docs, percent=80):
    """(n_shingles, smallest reachable id) by id."""
    sets = {d: shingles(t) for d, t in docs.items()}
    parent = {d: d for d in docs}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    lists = defaultdict(list)
    for d in sorted(docs):
        near = Counter(e for s in sets[d] for e in lists[s])
        for e, k in near.items():
            if 100 * k >= percent * (len(sets[d]) + len(sets[e]) - k):
                a, b = find(d), find(e)
                parent[max(a, b)] = min(a, b)
        for s in sets[d]:
            lists[s].append(d)
    return {d: (len(sets[d]), find(d)) for d in docs}
