"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return WORD.findall((text or "").translate(_LOW))


def contamination(texts, items, span=10):
    """(n_words, n_hit, n_items, items_sha256, contaminated) of each text; items are (id, text)."""
    windows = defaultdict(set)
    for name, text in items:
        w = words(text)
        for i in range(max(1, len(w) - span + 1)) if w else ():
            windows[tuple(w[i : i + span])].add("" if name is None else str(name))
    out = []
    for text in texts:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if (k := tuple(w[i : i + n])) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[k]
        out.append((len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


def line_runs(rows, least):
    """(text left, lines, lines deleted) of (id, text) rows, which are in the order of the corpus."""
    sequence, held = [], []
    for d, (_, text) in enumerate(rows):
        lines = (text or "").split("\n")
        mine = [k for k, line in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", line)]
        held.append((lines, mine))
        sequence += [(d, a, lines[k]) for a, k in enumerate(mine)] + [(d, None, object())]
    line = [x[2] for x in sequence]
    gone = [set() for _ in rows]
    for p in range(len(line)):
        best = 0
        for q in range(p):
            m = 0
            while p + m < len(line) and line[q + m] == line[p + m]:
                m += 1
            best = max(best, m)
        if best and sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in line[p : p + best]) >= least:
            for m in range(best):
                gone[sequence[p + m][0]].add(sequence[p + m][1])
    out = []
    for d, (_, text) in enumerate(rows):
        lines, mine = held[d]
        drop = {mine[a] for a in gone[d]}
        out.append((None if text is None else "\n".join(x for k, x in enumerate(lines) if k not in drop), len(mine), len(drop)))
    return out


def shingles(text, size=5):
    w = words(text)
    return Counter(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else Counter()


def probability_jaccard(x, y):
    keys = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in keys) for d in set(x) & set(y))


def near_duplicates(texts, least=0.8):
    """For each text the place of the first one that links connect it with."""
    sets = [shingles(t) for t in texts]
    near = list(range(len(texts)))

    def find(i):
        while near[i] != i:
            i = near[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(set(a) & set(b))
            if not both:
                continue
            plain = both / len(set(a) | set(b))
            weigh = lambda c: {k: 1 + math.log(n) for k, n in c.items()}
            if words(texts[i]) == words(texts[j]) or plain >= least or (plain > 0.3 and probability_jaccard(weigh(a), weigh(b)) >= least):
                one, two = sorted((find(i), find(j)))
                near[two] = one
    return [find(i) for i in range(len(texts))]


PRIVATE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def personal(text):
    """Base spans as kind:start:end, by kind and start."""
    out = []
    for kind, pattern in PRIVATE.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),  # noqa: B023
                "card": lambda: 13 <= len(digits) <= 19 and luhn(digits),  # noqa: B023
                "phone": lambda: 9 <= len(digits) <= 15,  # noqa: B023
            }[kind]()
            if fine:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out
