"""Plain Python definitions that the operators' results are held against."""
from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ASSIGN = re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
NO_ID = -(1 << 63)


def words(text):
    return WORD.findall(text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


def substring(rows, size=50):
    """rows: (doc_id, text); gives (doc_id, n_words, n_removed, kept_sha256) in the same order."""
    first = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - size + 1):
            key = tuple(w[i:i + size])
            first[key] = min(first.get(key, 1 << 62), NO_ID if d is None else d)
    out = []
    for d, t in rows:
        w, gone = words(t), set()
        for i in range(len(w) - size + 1):
            if first[tuple(w[i:i + size])] < (NO_ID if d is None else d):
                gone.update(range(i, i + size))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((d, len(w), len(gone), sha(" ".join(kept))))
    return out


def terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def contaminated(rows, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        w = terms(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[i:i + size])].add("null" if item is None else str(item))
    lengths = {len(k) for k in windows}
    out = []
    for d, t in rows:
        w, hit, found = terms(t), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                got = windows.get(tuple(w[i:i + n]))
                if got:
                    hit.update(range(i, i + n))
                    found |= got
        out.append((d, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def counts(text):
    text = text or ""
    w, seen, dup = words(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i:i + 3])].append(i)
    covered = {p for v in at.values() if len(v) > 1 for i in v for p in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered), failed


def near(rows, threshold=0.8):
    """rows: (doc_id, text), distinct non-null ids: doc_id -> (rep_id, class_id, n_links)."""
    sets = {}
    rep = {}
    for d, t in sorted(rows):
        w = words(t)
        if (t or "") not in rep:
            rep[t or ""] = d
            sets[d] = {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    links = Counter()
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            both = len(sets[a] & sets[b])
            if both and both >= threshold * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {d: (rep[t or ""], find(rep[t or ""]), links[rep[t or ""]]) for d, t in rows}


def unigram(rows):
    """rows: (doc_id, text) -> (held_out, n_tokens, n_known, train_tokens, base_score)."""
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    tokens = [words((t or "").translate(ASCII_LOWER)) + [None] for _, t in rows]
    c = Counter(x for h, w in zip(held, tokens, strict=True) if not h for x in w)
    n, v = sum(c.values()), len(c)
    return [(h, len(w), sum(x in c for x in w), n, sum(math.log10((c[x] + 1) / (n + v + 1)) for x in w)) for h, w in zip(held, tokens, strict=True)]
