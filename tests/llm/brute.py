"""Plain-Python versions of the corpus operators, for small tables only."""

import hashlib
import itertools
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def words(t):
    return WORD.findall(t or "")


class Union:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.find(a), self.find(b)))
        self.up[b] = a


def lines(docs):
    """{doc_id: (n_lines, n_dropped, sha)}"""
    held = {}
    for i, t in docs:
        for x in (t or "").split("\n"):
            k = x.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(UP)
            if len(k) >= 10:
                held.setdefault(k, set()).add(i)
    out = {}
    for i, t in docs:
        parts = (t or "").split("\n")
        kept = [x for x in parts if len(k := x.strip("\x20\x09\x0a\x0b\x0c\x0d").translate(UP)) < 10 or len(held[k]) < 2 or min(held[k]) == i]
        out[i] = (len(parts), len(parts) - len(kept), sha("\n".join(kept)))
    return out


def secrets(text):
    """Base spans (start, kind number, end)."""
    text, out = text or "", []
    for m in re.finditer(r"""(?a)([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 8:
            out.append((m.start(), 0, m.end()))
    for m in re.finditer(r"AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9a-f]+", text):
        if len(m[0]) >= 32:
            out.append((m.start(), 2, m.end()))
    return sorted(out)


def shingles(text, k):
    w = words((text or "").translate(UP))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def near(docs, k, num, den):
    """{doc_id: (n_shingles, component)}, all pairs by an inverted index."""
    sets = {i: shingles(t, k) for i, t in docs}
    index = {}
    for i, s in sets.items():
        for x in s:
            index.setdefault(x, []).append(i)
    u, common = Union(), {}
    for ids in index.values():
        for a, b in itertools.combinations(sorted(ids), 2):
            common[a, b] = common.get((a, b), 0) + 1
    for (a, b), n in common.items():
        if den * n >= num * (len(sets[a]) + len(sets[b]) - n):
            u.join(a, b)
    return {i: (len(s), u.find(i)) for i, s in sets.items()}


def rule(url, rules):
    """(host, path, rule, verdict or None)"""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(UP), m[2]) if m else ("", "")
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fit)[2], max(fit)[3]) if fit else (host, path, None, None)


def windows(docs, size=50):
    """{doc_id: [words kept]} with every word covered by an earlier document's window removed."""
    first = {}
    for i, t in docs:
        w = words(t)
        for j in range(len(w) - size + 1):
            key = tuple(w[j : j + size])
            first[key] = min(first.get(key, i), i)
    out = {}
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for j in range(len(w) - size + 1):
            if first[tuple(w[j : j + size])] < i:
                gone[j : j + size] = [True] * size
        out[i] = (len(w), [x for x, g in zip(w, gone) if not g])
    return out
