"""Plain versions of the operators, row by row, for small inputs."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import xxhash

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def only_digits(text):
    return re.sub("[^0-9]", "", text)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (
        r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        lambda m: all(int(x) <= 255 for x in m.split(".")),
    ),
    "card": (
        r"[0-9]([\x20-]?[0-9])+",
        lambda m: 13 <= len(only_digits(m)) <= 19 and luhn(only_digits(m)),
    ),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(only_digits(m)) <= 15),
}


def pii(docs):
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256)"""
    for doc_id, text in docs:
        found = [
            (kind, [m for m in re.finditer(p, text or "") if ok(m[0])])
            for kind, (p, ok) in PII.items()
        ]
        listed = ",".join(f"{k}:{m.start()}:{m.end()}" for k, ms in found for m in ms)
        yield (doc_id, *(len(ms) for _, ms in found), sha(listed))


SECRETS = [
    (
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
    ),
    ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
]


def secrets(docs):
    """(doc_id, n_assign, n_access, n_hex, base_sha256)"""
    for doc_id, text in docs:
        found = [
            (m.start(), i, name, m.end())
            for i, (name, p, ok) in enumerate(SECRETS)
            for m in re.finditer(p, text or "", re.ASCII)
            if ok(m)
        ]
        listed = ",".join(f"{name}:{start}:{end}" for start, _, name, end in sorted(found))
        yield (doc_id, *(sum(f[1] == i for f in found) for i in range(3)), sha(listed))


def substrings(docs, length=50):
    """(doc_id, n_words, n_removed, kept_sha256)"""
    docs = list(docs)
    first = {}
    order = lambda i: float("inf") if i is None else i
    for doc_id, text in docs:
        w = words(text)
        for i in range(len(w) - length + 1):
            key = tuple(w[i : i + length])
            first[key] = min(first.get(key, float("inf")), order(doc_id))
    for doc_id, text in docs:
        w = words(text)
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if first[tuple(w[i : i + length])] < order(doc_id):
                gone[i : i + length] = [True] * length
        kept = [x for x, g in zip(w, gone) if not g]
        yield doc_id, len(w), sum(gone), sha(" ".join(kept))


def fingerprint(text):
    w = words((text or "").translate(LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(docs):
    """(doc_id, fingerprint, component_id)"""
    docs = [(i, fingerprint(t)) for i, t in docs]
    fps = np.array(sorted({f for _, f in docs}), np.uint64)
    parent = list(range(len(fps)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, f in enumerate(fps):
        for j in np.flatnonzero(np.bitwise_count(fps ^ f) <= 3):
            a, b = sorted((root(i), root(int(j))))
            parent[b] = a
    at = {int(f): root(i) for i, f in enumerate(fps)}
    least = defaultdict(list)
    for i, f in docs:
        if i is not None:
            least[at[f]].append(i)
    for i, f in docs:
        yield i, f"{f:016x}", min(least[at[f]], default=None)


def contaminated(docs, items, length=10):
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)"""

    def cut(text):
        return re.findall(
            r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER)
        )

    windows = defaultdict(set)
    for item_id, text in items:
        w = cut(text)
        for i in range(max(1, len(w) - length + 1) if w else 0):
            windows[tuple(w[i : i + length])].add(item_id)
    lengths = {len(w) for w in windows}
    for doc_id, text in docs:
        w = cut(text)
        hit, found = [False] * len(w), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                ids = windows.get(tuple(w[i : i + n]))
                if ids:
                    hit[i : i + n] = [True] * n
                    found |= ids - {None}
        listed = ",".join(sorted(map(str, found)))
        yield doc_id, len(w), sum(hit), len(found), sha(listed), sum(hit) > 0


def quality(docs):
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    for doc_id, text in docs:
        w, text = words(text), text or ""
        seen, n_dup = set(), 0
        for line in text.split("\n"):
            if words(line):
                n_dup += line in seen
                seen.add(line)
        places = defaultdict(list)
        for i in range(len(w) - 7):
            places[tuple(w[i : i + 8])].append(i)
        twice = {j for p in places.values() if len(p) > 1 for i in p for j in range(i, i + 8)}
        n, n_symbols = len(w), len(re.findall(r"[#*$%&|<>]", text))
        failed = n < 20 or 100 * len(twice) > 30 * n
        yield doc_id, n, sum(map(len, w)), n_symbols, n_dup, len(twice), failed


def unlinked(docs):
    """The (doc_id, text) that stay when one of each group of near copies does."""
    docs = list(docs)
    best = {}
    for (i, text), (_, fp, component) in zip(docs, near_duplicates(docs)):
        if component is not None and i == component:
            best.setdefault(component, text)
    return best
