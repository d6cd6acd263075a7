"""Plain-Python versions of the corpus operators, for small inputs."""

import hashlib
import re
from collections import defaultdict

SPACE = " \t\n\x0b\x0c\r"
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def sha(data) -> str:
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def line_dedup(rows, min_chars=40, min_docs=5):
    """[(doc_id, text)] -> [(doc_id, n_lines, n_dropped, kept)]"""
    key = lambda line: line.strip(SPACE).translate(LOWER)
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars:
                held[key(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            docs = held.get(key(line), ())
            keeper = max((d for d in docs if d is not None), default=None)
            if len(docs) < min_docs or doc_id == keeper:
                kept.append(line)
        out.append((doc_id, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def shingles(text, size=5):
    words = [w for w in re.split(f"[{SPACE}]+", (text or "").translate(LOWER)) if w]
    if not words:
        return frozenset()
    width = min(size, len(words))
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def near_duplicates(rows, percent=75):
    """[(doc_id, text)] -> [(doc_id, n_shingles, component_id, kept)]"""
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[root(i)] = root(j)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        ids[root(i)].append(doc_id)
    out = []
    for i, (doc_id, _) in enumerate(rows):
        smallest = min((d for d in ids[root(i)] if d is not None), default=None)
        out.append((doc_id, len(sets[i]), smallest, doc_id == smallest))
    return out


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(rows, items, size=10):
    """-> [(doc_id, n_words, n_hit, sorted item ids as strings)]"""
    patterns = defaultdict(set)
    for item_id, text in items:
        w = words(text)
        if w and item_id is not None:
            for i in range(max(1, len(w) - size + 1)):
                patterns[tuple(w[i : i + size])].add(item_id)
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for pattern, ids in patterns.items():
            for i in range(len(w) - len(pattern) + 1):
                if tuple(w[i : i + len(pattern)]) == pattern:
                    hit.update(range(i, i + len(pattern)))
                    found |= ids
        out.append((doc_id, len(w), len(hit), sorted(map(str, found))))
    return out


def top_k(rows, k=5, every=50):
    """[(vec_id, components)] -> {(query_id, rank): (vec_id, score)}"""
    import math

    good = {(i, tuple(math.floor(256 * x) for x in v)) for i, v in rows
            if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)}
    out = {}
    for i, q in good:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in good if j != i)
            out |= {(i, r + 1): (j, -s) for r, (s, j) in enumerate(scored[:k])}
    return out


ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base_secrets(text):
    spans = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text or "") if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text or "") if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text or "") if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(spans))


def jaccard_components(rows, percent=90, size=3):
    """[(doc_id, text)] -> [(doc_id, n_shingles, component_id)]"""
    sets = [shingles(t, size) for _, t in rows]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and group[i] != group[j]:
                common = len(sets[i] & sets[j])
                if 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                    group = [group[j] if g == group[i] else g for g in group]
    smallest = {g: min((d for (d, _), h in zip(rows, group) if h == g and d is not None), default=None) for g in set(group)}
    return [(d, len(s), smallest[g]) for (d, _), s, g in zip(rows, sets, group)]


def prefix_trie(rows):
    """[(conv_id, turn, role, text)] -> the nodes as tuples, in the contract's column order"""
    import zlib

    def order(r):
        role, text = r[2] or "", r[3] or ""
        return (r[1] is not None, r[1] or 0, sha(f"{len(role)}:{role}{text}"))

    own = defaultdict(list)
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own[r[0]].append((r[2] or "", r[3] or ""))
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c // 100 * 100 if c >= 0 else -(-c // 100 * 100)  # the remainder takes the sign of c, as in SQL
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(len(m) == len(n) + 1 and m[: len(n)] == n for m in below)]
        saved = sum((len(members[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = sorted(c for c in convs if rebuilt[c] == node)
        parent = min(members[node[:-1]]) if node else None
        out.append((min(convs), len(node), parent, len(convs), len(children), len(leaves), saved, sha(",".join(map(str, ends)))))
    return out


def ranked(docs, items, k=50):
    """-> [(item_id, rank, doc_id, score)]"""
    import math

    find = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+").findall
    terms = [(d, find((t or "").translate(LOWER))) for d, t in docs]
    n_docs, length = sum(bool(t) for _, t in terms), sum(len(t) for _, t in terms)
    df = defaultdict(int)
    for _, t in terms:
        for x in set(t):
            df[x] += 1
    wanted = defaultdict(set)
    for i, t in items:
        wanted[i] |= set(find((t or "").translate(LOWER)))
    out = []
    for i, asked in wanted.items():
        scored = []
        for d, t in terms:
            m = 50 + 50 * len(t) * n_docs // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * (10**9 * t.count(x) // (1000 * t.count(x) + 20 * m))
                        for x in asked if x in t)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(i, r + 1, d, -s) for r, (s, _, _, d) in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return out
