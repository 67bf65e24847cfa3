"""Plain restatements of what the operators return."""
import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def order(i):
    return LAST if i is None else i


def line_dedup(rows, k=3):
    """Kept text per row; rows of one id and text are one document."""
    units = {}
    for i, t in rows:
        units[order(i), t] = [x for x in (t or "").split("\n") if WORD.search(x)]
    first = {}
    for key in sorted(units, key=lambda u: (u[0], u[1] or "")):
        for p in range(len(units[key]) - k + 1):
            first.setdefault(tuple(units[key][p:p + k]), (key, p))
    out = []
    for i, t in rows:
        key, gone = (order(i), t), set()
        for p in range(len(units[key]) - k + 1):
            if first[tuple(units[key][p:p + k])] != (key, p):
                gone.update(range(p, p + k))
        n, kept = 0, []
        for x in (t or "").split("\n"):
            if WORD.search(x):
                if n not in gone:
                    kept.append(x)
                n += 1
            else:
                kept.append(x)
        out.append((i, None if t is None else "\n".join(kept)))
    return out


def substring_dedup(rows, k=13):
    first = {}
    for i, t in sorted(rows, key=lambda r: order(r[0])):
        w = WORD.findall(t or "")
        for p in range(len(w) - k + 1):
            first.setdefault(tuple(w[p:p + k]), order(i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        stay = [True] * len(w)
        for p in range(len(w) - k + 1):
            if first[tuple(w[p:p + k])] < order(i):
                stay[p:p + k] = [False] * k
        kept = " ".join(x for x, s in zip(w, stay) if s)
        out.append((i, len(w), stay.count(False), sha(kept)))
    return out


def classes(rows, n=5, threshold=0.8):
    """(doc_id, class_id, n_links, n_copies) per row."""
    def grams(t):
        w = WORD.findall(t or "")
        return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])

    sets = [grams(t) for _, t in rows]
    distinct = sorted({s for s in sets if s}, key=lambda s: min(order(rows[i][0]) for i in range(len(rows)) if sets[i] == s))
    root = {s: s for s in distinct}
    links = collections.Counter()

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for x, a in enumerate(distinct):
        for b in distinct[:x]:
            if len(a & b) >= threshold * len(a | b):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    ids = collections.defaultdict(list)
    for (i, _), s in zip(rows, sets):
        if s:
            ids[find(s)].append(i)
    out = []
    for (i, _), s in zip(rows, sets):
        if not s:
            out.append((i, i, 0, 1))
        else:
            known = [x for x in ids[find(s)] if x is not None]
            out.append((i, min(known) if known else None, links[s], sets.count(s)))
    return out


def quality(text):
    t = text or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    hit = set()
    for i, g in enumerate(zip(w, w[1:], w[2:])):
        if grams[g] > 1:
            hit.update((i, i + 1, i + 2))
    n = len(w)
    return (n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(hit), n < 50 or 100 * len(hit) > 50 * n)


_BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOW = {c: c + 32 for c in range(65, 91)}


def contamination(rows, items, n=10):
    windows = collections.defaultdict(set)
    for item, t in items:
        w = _BENCH.findall((t or "").translate(_LOW))
        k = min(n, len(w))
        for p in range(len(w) - k + 1 if k else 0):
            windows[tuple(w[p:p + k])].add(str(item))
    out = []
    for i, t in rows:
        w = _BENCH.findall((t or "").translate(_LOW))
        hit, found = set(), set()
        for k in {len(x) for x in windows}:
            for p in range(len(w) - k + 1):
                if tuple(w[p:p + k]) in windows:
                    hit.update(range(p, p + k))
                    found |= windows[tuple(w[p:p + k])]
        out.append((i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)))
    return out


_ASSIGN = re.compile(r"""((?i:password|passwd|secret|token)|[aA][pP][iI]_?[kK][eE][yY])["']? *[:=] *["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def secrets(text):
    t = text or ""
    out = [(m.start(), 0, "assign", m.end()) for m in _ASSIGN.finditer(t) if len(m[2]) >= 12]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))
