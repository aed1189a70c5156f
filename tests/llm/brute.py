"""Plain one-row-at-a-time versions of the operators, for small tables."""

import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def below(a, b):
    """Null ids come before all others."""
    return (a is not None, a or 0) < (b is not None, b or 0)


def line_dedup(rows):
    key = lambda x: x.strip(SPACE).translate(LOWER)
    holders = {}
    for d, t, *_ in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= 20:
                holders.setdefault(key(line), set()).add(d)
    wide = {k: max(h, key=lambda x: (x is not None, x or 0)) for k, h in holders.items() if len(h) >= 3}
    out = []
    for d, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in wide or wide[key(x)] == d]
        out.append((d, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def counts(text):
    text = text or ""
    w, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    hit = {i + o for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for o in range(3)}
    return dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=len(re.findall(r"[#*$%&|<>]", text)),
                n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(hit), n_lines=len(lines))


def shingles(text, width):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())


def link_components(rows, width, above, of):
    sets = [shingles(t, width) for _, t, *_ in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and of * len(sets[i] & sets[j]) >= above * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    out = []
    for i, (d, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.append((d, len(sets[i]), (min(ids) if ids else None) if sets[i] else d))
    return out


ASSIGN = re.compile(r"""(?i:(?:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)


def base_spans(text):
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 8]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [f"{k}:{s}:{e}" for s, _, k, e in sorted(found)]


def targets(sizes):
    """Target of each source: shares by weight, cut at three times the size and shared again."""
    order = sorted(s for s in sizes if s is not None) + ([None] if None in sizes else [])
    weight = {s: 1 + i % 3 for i, s in enumerate(order)}
    fixed, free, total = {}, set(order), sum(sizes.values())
    while True:
        left, all_ = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if weight[s] / all_ * left > 3 * sizes[s]]
        if not over:
            return fixed | {s: weight[s] / all_ * left for s in free}
        for s in over:
            fixed[s] = 3 * sizes[s]
            free.discard(s)


def lm_scores(rows, weight):
    tokens = [[w for w in WORD.findall((t or "").translate(LOWER))] + [None] for _, t, *_ in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, *_ in rows]
    one, two, context = Counter(), Counter(), Counter()
    for t, h in zip(tokens, held):
        for v, w in zip(["<s>", *t], [] if h else t):
            one[w] += 1
            two[v, w] += 1
            context[v] += 1
    n, out = sum(one.values()), []
    p = lambda w: (one[w] + 1) / (n + len(one) + 1)
    for (d, *_), t, h in zip(rows, tokens, held):
        score = sum(math.log10((two[v, w] + weight * p(w)) / (context[v] + weight)) for v, w in zip(["<s>", *t], t))
        out.append((d, h, len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(p(w)) for w in t), score))
    return out
