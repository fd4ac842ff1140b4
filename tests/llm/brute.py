"""Plain versions of what the operators' contracts say, for small tables."""

import hashlib
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(repeated), failed)


def phrases(text):
    words = PLAIN.findall((text or "").translate(ASCII))
    found = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        part = phrase.split()
        found += [(i, label) for i in range(len(words)) if words[i : i + len(part)] == part]
    starts = [i for i, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def luhn(digits):
    doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def spans(text):
    out = []
    for n, (kind, pattern) in enumerate(PATTERNS.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": True,
                "ip": kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits),
                "phone": 10 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((m.start(), n, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def digest(found):
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in found).encode()).hexdigest()


def fingerprint(text):
    words = re.findall(WORD, (text or "").translate(ASCII))
    if not words:
        return 0
    shingles = [words] if len(words) < 4 else [words[i : i + 4] for i in range(len(words) - 3)]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(nodes, linked):
    """node -> all nodes that `linked` pairs reach."""
    reach = {n: {n} for n in nodes}
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if reach[a] is not reach[b] and linked(a, b):
                reach[a] |= reach[b]
                for n in reach[b]:
                    reach[n] = reach[a]
    return reach


def near_duplicates(rows):
    """(id, text) -> {(id, text): smallest id}."""
    prints = {r: fingerprint(r[1]) for r in set(rows)}
    by_print = groups(sorted(set(prints.values())), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for (i, _), p in prints.items():
        for q in by_print[p]:
            if i is not None and i < least.get(q, i + 1):
                least[q] = i
    return {r: (p, least.get(p)) for r, p in prints.items()}
