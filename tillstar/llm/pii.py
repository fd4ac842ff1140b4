"""Personal data: overlapping candidates, boosted trees, calibrated thresholds.

Exact patterns find what is certain (the base spans, per kind from the left without
overlap). Beside them, generators of high recall propose many overlapping candidates:
windows of number tokens (bounded by their digits alone, on one line or two, parted by
spaces of any sort or a dash), addresses with or without an @, dotted and colon-joined
groups, IPv6 with its zeros left out too.
Per kind, boosted trees score a candidate by its format (digits, groups, separators,
check digit, ranges) and its context (neighbouring characters, words before it). The
scores are calibrated on held-out examples, the threshold being the least at which the
held-out precision reaches `PRECISION` (and `LEAST` at least); of the candidates above it, the best are taken
first, none that overlaps a base span or a better candidate.

No table labels personal data, so the trees learn from examples made here: formats of
each kind and look-alikes of none, written between words of a bounded sample of the
documents (`SAMPLE`), and of the sample's own candidates those whose label is certain: the
base spans are of their kind; their parts, and candidates that break a kind's format
(`contradicts`), are not. All others may be data of just the sort the trees are to add, so
they are no examples.

Offsets are code points, ends exclusive. Null and empty texts have no spans; repeated rows
are read each for itself; an empty table gives an empty one; input columns all stay.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from dataclasses import dataclass
from ipaddress import ip_address
from itertools import accumulate

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tillstar.llm.boosting import Trees, fit_trees
from tillstar.llm.common import with_text_column

KINDS = ("email", "ip", "card", "phone")
#: Documents that examples are drawn from, about; twice as many at most.
SAMPLE = 500
#: Made examples of each kind and of its look-alikes.
EXAMPLES = 2000
PRECISION = 0.99
#: No threshold is under this probability.
LEAST = 0.9

IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+\Z")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")

NUMBER = re.compile(r"[+(0-9][0-9().\-/]*")
#: What may stand between the tokens of one number.
JOINT = re.compile(r"[^\S\r\n]+|[^\S\r\n]*(?:[-\u2010-\u2015\u2212\u00B7]?\r?\n|[-\u2010-\u2015\u2212\u00B7])[^\S\r\n]*")
#: Most digits of a number.
DIGITS = 19
AT = re.compile(r"@| ?\((?:at|AT)\) ?| ?\[(?:at|AT)\] ?| at ")
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.| ?\((?:dot|DOT)\) ?| ?\[(?:dot|DOT)\] ?| dot )[A-Za-z0-9-]+)+")
GROUPS = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\.|\[\.\]|\(\.\))[0-9]{1,3}){3,}(?![0-9])|(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?:::?[0-9A-Fa-f]{1,4}){3,7}")
#: IPv6 with a run of zeros left out, with or without IPv4 at its end.
SHORTENED = re.compile(
    r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?::"
    r"(?:[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){0,6})?(?:(?<=[0-9])(?:\.[0-9]{1,3}){3})?(?![0-9A-Za-z:])"
)
#: A word just before a span that says it is a version or an ISBN.
NAMED = re.compile(r"(?i)(?<![a-z])(?:v|ver|version|isbn)[.:]? ?\Z")
DATED = re.compile(r"(?:19|20)[0-9]{2}([-./]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12][0-9]|3[01])(?![0-9])|(?:0?[1-9]|[12][0-9]|3[01])([-./])(?:0?[1-9]|1[0-2])\2(?:19|20)[0-9]{2}(?![0-9])|(?:19|20)[0-9]{2}-(?:19|20)[0-9]{2}(?![0-9])")
#: Between the groups of made numbers, besides one space or hyphen.
APART = ("\u00A0", "  ", "\u2013", "\n", "\u202F", " - ")
#: What marks a word as a part of data rather than prose.
CODED = re.compile(r"[0-9@:\[\]()]|(?i:\A(?:at|dot)\Z)")
DECIMAL = re.compile(r"[0-9]+\.[0-9]+")
#: Words before a span that speak for a kind, or for none.
HINTS = {
    "email": ("mail", "contact", "write"),
    "ip": ("ip", "host", "server", "addr", "address", "ping"),
    "card": ("card", "visa", "mastercard", "amex", "credit", "payment"),
    "phone": ("call", "tel", "phone", "fax", "mobile", "cell", "telefon", "sms"),
    "none": ("isbn", "order", "invoice", "version", "ver", "v", "date", "serial", "no", "nr", "section", "page", "id", "sku"),
}
RESULT = ArrayType(StructType([
    StructField("kind", StringType()), StructField("start", IntegerType()), StructField("end", IntegerType()), StructField("base", IntegerType()),
]))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def octet(digits: str) -> bool:
    """Whether a run of digits, of any length, is at most 255."""
    return len(digits.lstrip("0")) <= 3 and int(digits[-3:]) <= 255


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The spans of the exact patterns, by start, then kind as in KINDS."""
    found = []
    at = text.find("@")
    done = 0
    while at >= 0:  # a match's local part is all that may stand before its @, since the match before
        low = at
        while low > done and LOCAL.match(text[low - 1]):
            low -= 1
        m = DOMAIN.match(text, at + 1) if low < at else None
        if m:
            found.append((low, 0, m.end()))
            done = m.end()
        at = text.find("@", max(at + 1, done))
    for m in IP.finditer(text):
        if all(octet(p) for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = digits_of(m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(digits_of(m[0])) <= 15:
                found.append((m.start(), 3, m.end()))
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def candidates(text: str) -> list[tuple[str, int, int]]:
    """Overlapping candidates (kind, start, end); numbers are proposed as card and phone."""
    out = []
    run: list[tuple[int, int, int]] = []  # neighbouring number tokens: start, end, digits

    def windows() -> None:
        for i in range(len(run)):
            total = 0
            for j in range(i, len(run)):
                total += run[j][2]
                if total > DIGITS:
                    break
                if total >= 7:
                    span = (run[i][0], run[j][1])
                    out.append(("phone", *span))
                    if total >= 13:
                        out.append(("card", *span))

    for m in NUMBER.finditer(text):
        token = m[0].rstrip("(.-/")
        if "(" not in token:
            token = token.rstrip(").-/")
        n = len(digits_of(token))
        if n:
            if run and not JOINT.fullmatch(text, run[-1][1], m.start()):
                windows()
                run = []
            run.append((m.start(), m.start() + len(token), n))
    windows()
    for m in AT.finditer(text):
        low = m.start()
        while low > 0 and LOCAL.match(text[low - 1]):
            low -= 1
        tail = LOOSE_DOMAIN.match(text, m.end()) if low < m.start() else None
        if tail:
            out.append(("email", low, tail.end()))
    for m in GROUPS.finditer(text):
        out.append(("ip", m.start(), m.end()))
    if "::" in text:
        for m in SHORTENED.finditer(text):
            if m.end() - m.start() > 2:
                out.append(("ip", m.start(), m.end()))
    return list(dict.fromkeys(out))


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a candidate."""
    span = text[start:end]
    digits = digits_of(span)
    groups = re.findall(r"[0-9]+", span) or [""]
    sizes = [len(g) for g in groups]
    before, after = text[start - 1 : start], text[end : end + 1]
    words = re.findall(r"[a-z]+", text[max(0, start - 24) : start].lower())[-2:]
    tail = re.split(r"[^A-Za-z0-9]+", span)[-1]
    seps = re.findall(r"[^0-9A-Za-z]+", span)
    hexes = re.findall(r"[0-9A-Fa-f]+", span) if ":" in span else [""]
    return [
        len(span), len(digits), len(groups), max(sizes), min(sizes), sizes[0], sizes[-1],
        float(sizes == [4, 4, 4, 4]), float(sizes in ([3, 3, 4], [1, 3, 3, 4])), float(len(set(sizes)) == 1),
        float(luhn(digits)) if len(digits) > 1 else 0.0, float(digits[:1] or 0), float(digits[:1] == "0"),
        float(span[0] == "+"), float("(" in span), len(set(seps)), float("." in span), float("-" in span), float("/" in span),
        float(" " in span), float(":" in span), float("@" in span), float("[" in span or "(at" in span.lower()),
        float(" at " in span), float(" dot " in span), sum(c.isalpha() for c in span), len(tail), float(tail.isalpha() and tail.islower()),
        max((int(g) for g in groups if 0 < len(g) < 10), default=0), float(bool(re.match(r"(19|20)[0-9]{2}[-./]?[01]", span))),
        float(any("0" <= c <= "9" for c in text[max(0, start - 3) : start])), float(any("0" <= c <= "9" for c in text[end : end + 3])),
        float(before.isalnum()), float(after.isalnum()), float(before != "" and before in "#=/_$€£."), float(after != "" and after in "=/_%"),
        float(digits[:2] == "00"), float("\n" in span), float(not span.isascii()), float("  " in span), span.count(":"), float("::" in span), len(hexes), max(map(len, hexes)),
        *(float(any(w in HINTS[k] for w in words)) for k in HINTS), float(any(w in HINTS[kind] for w in words)),
    ]


def contradicts(text: str, kind: str, start: int, end: int) -> bool:
    """Whether a candidate can't be of its kind, by its format or a word that says so: a
    check digit or range is wrong, or it is a date, a version, an ISBN or a decimal."""
    span = text[start:end]
    digits = digits_of(span)
    groups = re.findall(r"[0-9]+", span)
    if kind == "card":
        return not (13 <= len(digits) <= 19 and luhn(digits))
    if kind == "email":
        labels = re.findall(r"[A-Za-z0-9-]+", span)
        return len(labels[-1]) < 2 or not labels[-1].isalpha() or labels[-1].istitle() and not labels[-2].istitle()
    if NAMED.search(text[max(0, start - 12) : start]):
        return True
    if kind == "ip":
        if ":" in span:
            try:
                ip_address(span)
            except ValueError:
                return True
            return False
        return len(groups) != 4 or any(len(g) > 3 or int(g) > 255 for g in groups)
    if not 7 <= len(digits) <= 15 or DATED.match(span) or DECIMAL.fullmatch(span):
        return True
    return len(digits) == 13 and digits[:3] in ("978", "979") and sum(int(d) * (1 + 2 * (i & 1)) for i, d in enumerate(digits)) % 10 == 0


def _made(kind: str, rnd: random.Random) -> tuple[str, str]:
    """An example of a kind: a word before it ("" for none) and its text."""
    d = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    word = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    hint = rnd.choice(HINTS[kind]) if rnd.random() < 0.5 else ""
    if kind == "email":
        at = rnd.choice(["@", "@", " (at) ", "(at)", "[at]", " at "])
        dot = "." if at == "@" else rnd.choice([".", " dot ", "[dot]"]) if at != " at " else " dot "
        name = rnd.choice([word(rnd.randint(3, 9)), f"{word(4)}.{word(6)}", f"{word(5)}{d(2)}", f"{word(4)}.{d(2)}"])
        host = rnd.choice([word(6), f"mail{d(1)}{dot}{word(7)}"])
        return hint, name + at + host + dot + rnd.choice(["com", "org", "net", "de", "info", "co.uk"])
    if kind == "ip":
        if rnd.random() < 0.25:
            return hint, ":".join(f"{rnd.randrange(65536):x}" for _ in range(8))
        if rnd.random() < 0.3:
            part = lambda n: ":".join(f"{rnd.randrange(16 ** rnd.choice([1, 2, 3, 4, 4])):x}" for _ in range(n))
            head = rnd.choice(["2001:db8", "2001", "2a00", "2a02", "2606", "2404", "fe80", "fe80", "fd00", f"fd{d(2)}", "ff02", "64:ff9b", f"2{d(3)}", f"2{d(3)}:{d(2)}ab"])
            return rnd.choice([(hint, f"{head}::{part(rnd.randint(1, 4))}"), (hint, f"{head}::{part(rnd.randint(1, 4))}"), (hint, f"{head}:{part(rnd.randint(1, 3))}::"), (hint, f"{head}::"), (hint, "::1"), (rnd.choice(HINTS["ip"]), f"::{part(rnd.randint(1, 4))}")])
        return hint, rnd.choice([".", ".", ".", "[.]", "(.)"]).join(str(rnd.randint(1, 255)) for _ in range(4))
    if kind == "card":
        n = rnd.choice([16, 16, 16, 15, 14, 19])
        head = rnd.choice("3456") + d(n - 2)
        number = next(head + c for c in "0123456789" if luhn(head + c))
        return hint, rnd.choice(["", " ", " ", "-", "-", ".", *APART]).join(number[i : i + 4] for i in range(0, n, 4))
    a, b, c = str(rnd.randint(2, 9)) + d(2), d(3), d(4)
    plain = rnd.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"+1 ({a}) {b}-{c}", f"+1 {a} {b} {c}", f"+{d(2)} {d(2)} {d(4)} {d(4)}", f"+49 {d(3)} {d(7)}"])
    pair = lambda n: " ".join(d(2) for _ in range(n))
    plain = rnd.choice([plain, plain, plain, f"00{rnd.randint(1, 9)}{d(1)} {d(1)} {pair(4)}", f"00{rnd.randint(1, 9)}{d(1)} {d(3)} {d(3)} {d(2)} {d(2)}", f"00{rnd.randint(1, 9)}{d(1)} {d(2)} {d(4)} {d(4)}"])
    if rnd.random() < 0.3:
        plain = re.sub("(?<=[0-9])[ -](?=[0-9])", rnd.choice(APART), plain)
    # Forms that other numbers share only count beside a word that says so.
    return rnd.choice([(hint, plain), (rnd.choice(HINTS["phone"]), rnd.choice([f"{a}.{b}.{c}", a + b + c, f"0{d(3)}/{d(6)}", f"0{d(2)} {d(7)}", f"0{d(1)} {pair(4)}", f"{d(2)} {pair(3)}"]))])


def _look_alike(kind: str, rnd: random.Random) -> tuple[str, str]:
    """A text that a generator proposes for a kind but that is none."""
    d = lambda n: "".join(rnd.choice("0123456789") for _ in range(n))
    word = lambda n: "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(n))
    hint = rnd.choice(HINTS["none"]) if rnd.random() < 0.4 else ""
    date = f"{rnd.randint(1900, 2099)}-{rnd.randint(1, 12):02d}-{rnd.randint(1, 28):02d}"
    if kind == "email":
        return hint, rnd.choice([
            f"{word(5)} at {word(6)}.{word(5).title()}", f"{word(4)} at {word(5)}.{d(1)}", f"{word(3)}@{d(1)}.{d(1)}", f"{word(3)} at {d(1)}.{d(2)}",
        ])
    if kind == "ip":
        return rnd.choice(["version", "section", "v", "ver"]), rnd.choice([
            f"{d(1)}::{d(1)}", f"{d(2)}::{d(2)}", "::".join(rnd.choice(["a", "b", "add", "dec", "face", "ace", "bad", "c"]) for _ in range(2)), f"::{rnd.choice(['add', 'dec', 'fade', 'e', 'cafe'])}",
            ".".join(d(1) for _ in range(rnd.randint(4, 6))), ".".join(str(rnd.randint(256, 999)) for _ in range(4)), f"{d(1)}.{d(1)}.{d(3)}.{d(3)}", ":".join(d(2) for _ in range(4)),
        ])
    wrong = d(rnd.choice([13, 14, 15, 16, 16, 16, 18, 19]))
    if len(wrong) >= 14 and luhn(wrong):
        wrong = wrong[:-1] + str((int(wrong[-1]) + 1) % 10)
    token = "".join(rnd.choice("0123456789abcdef") for _ in range(12)) + rnd.choice("abcdef")
    token = f'"{token}{d(rnd.choice([7, 9, 10, 10, 11, 12, 14, 16]))}{token[::-1]}"'  # digits inside a longer code
    apart = rnd.choice([" ", " ", *APART])
    row = apart.join(d(rnd.randint(1, 5)) for _ in range(rnd.randint(3, 12)))  # a table's numbers
    same = apart.join(d(n) for n in [rnd.randint(1, 3)] * rnd.randint(4, 12))
    years = apart.join(str(rnd.randint(1900, 2099)) for _ in range(rnd.randint(2, 5)))
    four = apart.join(wrong[i : i + 4] for i in range(0, len(wrong), 4))
    if kind == "card":
        return hint, rnd.choice([wrong, wrong, four, row, same, years, f"978{d(10)}", f"{date.replace('-', '')}{d(6)}", f"{d(4)} {d(5)} {d(6)}"])
    return hint, rnd.choice([
        token, token, row, row, same, same, years, f"{date}{apart}{date}", date, date.replace("-", "/"), date.replace("-", "."), f"{date} {d(2)}", wrong, four, *(d(n) for n in (7, 8, 9, 10, 10, 10, 11, 12)), f"{d(1)}.{d(8)}",
        f"978-{d(1)}-{d(2)}-{d(6)}-{d(1)}", f"{d(3)}.{d(3)}.{d(3)}.{d(2)}", f"{d(4)} {d(4)}", f"{d(3)} {d(4)}", f"{d(2)}-{d(7)}", f"{d(4)}-{d(4)}", f"{d(5)} {d(2)} {d(3)}",
    ])


@dataclass(frozen=True)
class Model:
    """Per kind: trees, slope and shift of the calibration, and the least probability taken."""

    trees: dict[str, Trees]
    scale: dict[str, tuple[float, float]]
    threshold: dict[str, float]

    def probability(self, kind: str, rows: list[list[float]]) -> np.ndarray:
        slope, shift = self.scale[kind]
        return 1 / (1 + np.exp(-(slope * self.trees[kind].margin(np.array(rows)) + shift)))


def examples(texts: list[str], kind: str, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels: made examples between the words of `texts`, and what the
    generators find in `texts` where it is certain what it is."""
    rnd = random.Random(f"{seed}-{kind}")
    # Words that could be data themselves are no context.
    words = [w[:40] for t in texts for w in t.split() if not CODED.search(w)][:20000] or ["the"]
    x, y = [], []
    for label, make in ((1, _made), (0, _look_alike)):
        for _ in range(EXAMPLES):
            hint, span = make(kind, rnd)
            parts = [span]
            if label and kind in ("card", "phone") and rnd.random() < 0.3:  # neighbours
                parts.append(make(kind, rnd)[1])
            span = " ".join(parts)
            left = " ".join([rnd.choice(words), rnd.choice(words), hint + rnd.choice([":", ""]) if hint else rnd.choice(words), ""])
            text = left + span + rnd.choice([" ", ".", ", ", "!! "]) + rnd.choice(words)
            # Only a whole is an example of the kind; its parts are not, nor is it with more.
            ends = list(accumulate((len(p) + 1 for p in parts), initial=len(left)))
            right = {(a, b - 1) for a, b in zip(ends, ends[1:], strict=False)} if label else set()
            for k, a, b in candidates(text):
                if k == kind:
                    x.append(features(text, kind, a, b))
                    y.append(float((a, b) in right))
    for text in texts:
        exact = [(a, b) for k, a, b in base_spans(text) if k == kind]  # apart, in order
        for k, a, b in candidates(text):
            if k != kind:
                continue
            at = bisect_left(exact, (a, b + 1)) - 1
            whole = exact[at] if at >= 0 and exact[at][1] >= b else None
            if whole or contradicts(text, kind, a, b):
                x.append(features(text, kind, a, b))
                y.append(float(whole == (a, b)))
    return np.array(x), np.array(y)


def train(texts: list[str]) -> Model:
    """Trees per kind on three quarters of the examples, calibrated on the rest."""
    trees, scale, threshold = {}, {}, {}
    for kind in KINDS:
        x, y = examples(texts, kind)
        held = np.random.default_rng(5).random(len(x)) < 0.25
        trees[kind] = fit_trees(x[~held], y[~held])
        margin, truth = trees[kind].margin(x[held]), y[held]
        slope, shift = 1.0, 0.0
        for _ in range(25):  # Newton's method for the logistic calibration
            p = 1 / (1 + np.exp(-(slope * margin + shift)))
            w = p * (1 - p) + 1e-6
            grad = np.array([((p - truth) * margin).sum() + 1e-3 * (slope - 1), (p - truth).sum() + 1e-3 * shift])
            curve = np.array([[(w * margin**2).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]])
            step = np.clip(np.linalg.solve(curve, grad), -1, 1)
            slope, shift = max(0.05, slope - step[0]), shift - step[1]
        scale[kind] = (float(slope), float(shift))
        p = 1 / (1 + np.exp(-(slope * margin + shift)))
        order = np.argsort(-p, kind="stable")
        precision = np.cumsum(truth[order]) / np.arange(1, len(order) + 1)
        good = np.nonzero(precision >= PRECISION)[0]
        threshold[kind] = max(LEAST, float(p[order][good[-1]])) if len(good) else 1.1
    return Model(trees, scale, threshold)


def find(texts: list[str], model: Model) -> list[list[dict]]:
    """All spans of each text: kind, start, end and base (1) or added (0)."""
    bases = [base_spans(t) for t in texts]
    taken = [[*b] for b in bases]
    proposals: dict[str, list[tuple[int, int, int]]] = {k: [] for k in KINDS}
    for i, text in enumerate(texts):
        busy = sorted((a, b) for _, a, b in bases[i])
        reach = list(accumulate((b for _, b in busy), max))  # the last end of all spans so far
        for kind, a, b in candidates(text):
            k = bisect_left(busy, (b, 0))
            if not k or reach[k - 1] <= a:
                proposals[kind].append((i, a, b))
    scored = []
    for kind, found in proposals.items():
        if found:
            p = model.probability(kind, [features(texts[i], kind, a, b) for i, a, b in found])
            scored += [(-q, i, a, -b, kind) for q, (i, a, b) in zip(p, found, strict=True) if q >= model.threshold[kind]]
    free: dict[int, list[tuple[int, int]]] = {}
    for _, i, a, b, kind in sorted(scored):
        accepted = free.setdefault(i, [])  # in order and apart, so one neighbour tells
        k = bisect_left(accepted, (-b, 0))
        if not k or accepted[k - 1][1] <= a:
            accepted.insert(k, (a, -b))
            taken[i].append((kind, a, -b))
    order = {k: n for n, k in enumerate(KINDS)}
    return [
        [{"kind": k, "start": a, "end": b, "base": int((k, a, b) in exact)} for k, a, b in sorted(all_, key=lambda s: (s[1], order[s[0]], s[2]))]
        for exact, all_ in zip(map(set, bases), taken, strict=True)
    ]


def sample_texts(df: DataFrame, text: str, most: int = SAMPLE) -> list[str]:
    """About `most` texts, twice as many at most, chosen by their hash."""
    step = max(1, -(-df.count() // most))
    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("t")).where(F.pmod(F.xxhash64("t"), F.lit(step)) == 0)
    return sorted(r["t"] for r in rows.distinct().limit(2 * most).collect())


def with_spans(df: DataFrame, text: str = "text", model: Model | None = None) -> tuple[DataFrame, str]:
    """`df` with an array column of spans, and its name; the model is trained on a sample
    of `df` unless given."""
    use = model or train(sample_texts(df, text))
    return with_text_column(df, text, "spans", RESULT, lambda: lambda texts: find(texts, use))


def redact(text: str, spans) -> str:
    """The text with each span, or run of overlapping spans, as its kind in angle brackets."""
    out, done = [], 0
    for s in sorted(spans, key=lambda s: (s["start"], -s["end"])):
        if s["start"] >= done:
            out += [text[done : s["start"]], f"<{s['kind'].upper()}>"]
        done = max(done, s["end"])
    return "".join([*out, text[done:]])


def redacted(df: DataFrame, text: str = "text", model: Model | None = None) -> DataFrame:
    """`df` with personal data in its texts replaced; null texts stay null."""
    use = model or train(sample_texts(df, text))

    def make():
        return lambda texts: [redact(t, s) for t, s in zip(texts, find(texts, use), strict=True)]

    out, at = with_text_column(df, text, "clean", StringType(), make)
    return out.withColumn(text, F.when(F.col(text).isNotNull(), F.col(at))).drop(at)
