"""The contracts of the operators, in plain Python over small inputs."""

import re
from collections import Counter, defaultdict

BLANKS = " \t\n\x0b\x0c\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def line_dedup(docs):
    """{doc_id: (n_lines, n_dropped, kept)} of unique ids."""
    lines = {d: (t or "").split("\n") for d, t in docs}
    first = {}
    for d in sorted(lines):
        for line in lines[d]:
            first.setdefault(lower(line.strip(BLANKS)), d)
    out = {}
    for d, own in lines.items():
        kept = [x for x in own if len(k := lower(x.strip(BLANKS))) < 10 or first[k] == d]
        out[d] = (len(own), len(own) - len(kept), "\n".join(kept))
    return out


def shingles(text, n):
    words = WORD.findall(lower(text or ""))
    return {tuple(words[k:k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def near_dedup(docs, n, percent=80):
    """{doc_id: (n_shingles, component_id)} of unique ids."""
    sets = {d: shingles(t, n) for d, t in docs}
    having = defaultdict(list)
    for d, s in sets.items():
        for x in s:
            having[x].append(d)
    common = Counter((a, b) for ds in having.values() for a in ds for b in ds if a < b)
    up = {d: d for d in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), k in common.items():
        if 100 * k >= percent * (len(sets[a]) + len(sets[b]) - k):
            a, b = root(a), root(b)
            up[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def removed_words(docs, window=20):
    """{doc_id: (words, kept flags)} of unique ids."""
    words = {d: WORD.findall(t or "") for d, t in docs}
    seen, stays = set(), {d: [True] * len(w) for d, w in words.items()}
    for d in sorted(words):
        for k in range(len(words[d]) - window + 1):
            key = tuple(words[d][k:k + window])
            if key in seen:
                stays[d][k:k + window] = [False] * window
            seen.add(key)
    return {d: (words[d], stays[d]) for d in words}
