"""Plain Python versions of the contracts."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UP))


def words(text, lower=False):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UP) if lower else text or "")


def luhn(number):
    total = 0
    for place, digit in enumerate(map(int, reversed(number))):
        total += digit if place % 2 == 0 else sum(divmod(2 * digit, 10))
    return total % 10 == 0


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(spans)).encode()).hexdigest()


def pii(text):
    text, out = text or "", []
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
             ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
             ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
             ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(digits(m)) <= 15)]
    for rank, (kind, pattern, good) in enumerate(rules):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if good(m)]
    return out


def secrets(text):
    text, out = text or "", []
    rules = [("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 12),
             ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 18), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 16)]
    for rank, (kind, pattern, good) in enumerate(rules):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if good(m)]
    return out


def licenses(text):
    found, places, labels = tokens(text), [], set()
    for phrase, label in {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}.items():
        parts = phrase.split()
        here = [i for i in range(len(found)) if found[i:i + len(parts)] == parts]
        places += here
        labels |= {label} if here else set()
    return len(found), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def quality(text):
    text = text or ""
    all_words = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    runs = [tuple(all_words[i:i + 8]) for i in range(len(all_words) - 7)]
    often = Counter(runs)
    covered = {p for i, r in enumerate(runs) if often[r] > 1 for p in range(i, i + 8)}
    return (len(all_words), sum(map(len, all_words)), len(re.findall("[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered))


def contamination(docs, items):
    windows = {}
    for item, text in items:
        found = tokens(text)
        for i in range(max(len(found) - 12, 1) if found else 0):
            windows.setdefault(tuple(found[i:i + 13]), set()).add(str(item))
    out = []
    for doc, text in docs:
        found, hit, held = tokens(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(found) - size + 1):
                if (run := tuple(found[i:i + size])) in windows:
                    hit |= set(range(i, i + size))
                    held |= windows[run]
        out.append((doc, len(found), len(hit), len(held), hashlib.sha256(",".join(sorted(held)).encode()).hexdigest(),
                    len(hit) > 0 and 20 * len(hit) >= len(found)))
    return out


def shingles(text):
    found = words(text, lower=True)
    return {tuple(found[i:i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()


def groups(docs):
    sets = {doc: shingles(text) for doc, text in docs}
    of = {doc: doc for doc in sets}
    holders = {}
    for doc, own in sets.items():
        for s in own:
            holders.setdefault(s, []).append(doc)
    for a in sets:
        near = Counter(b for s in sets[a] for b in holders[s] if b > a)
        for b, both in near.items():
            if of[a] != of[b] and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                low, high = sorted((of[a], of[b]))
                of = {doc: low if group == high else group for doc, group in of.items()}
    return [(doc, len(sets[doc]), of[doc]) for doc in sets]


def targets(sizes, share=1.5, most=2.0):
    """Targets by sharing out again and again."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: [5, 2, 1][i % 3] for i, s in enumerate(order)}
    out, open_, left = {}, set(order), share * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        out.update({s: most * sizes[s] for s in full} if full else {s: level * weight[s] for s in open_})
        left -= sum(out[s] for s in full)
        open_ = open_ - full if full else set()
    return out


def token_rows(docs, encode):
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, d[1] or "")):
        ids = [*encode(text or ""), 0]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        start += len(ids)
    return out
