"""Plain restatements of the phrase, fingerprint and trie operators."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict


def trie(rows, every=5, most=9):
    """Every node of the rebuilt conversations, from (conv_id, turn, role, text) rows."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    new = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % most
        new[c] = own.get(c - c % every, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in new.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    out = {}
    for node, convs in members.items():
        subtree = [m for m in members if m[:len(node)] == node]
        kids = [m for m in members if len(m) == len(node) + 1 and m[:len(node)] == node]
        leaves = [m for m in subtree if not any(len(o) == len(m) + 1 and o[:len(m)] == m for o in subtree)]
        saved = sum((len(members[m]) - 1) * len(m[-1][1].encode()) for m in subtree if m)
        ends = ",".join(str(c) for c in sorted(c for c in convs if len(new[c]) == len(node)))
        out[min(convs), len(node)] = (min(members[node[:-1]]) if node else None, len(convs), len(kids), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest())
    return out


def collocations(rows, least=10, top=2000, share=50):
    """(lang, rank) -> (phrase, a, l, r, n, score), from (text, lang) rows."""
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                f[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = {}
    for lang, count in f.items():
        cands = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            score, k = min((1000000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
            if not any(len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) and 100 * b >= share * a for q, b in cands.items()):
                rows.append((-score, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out[lang, rank] = (p.decode(), -a, left, right, n[lang], -s)
    return out
