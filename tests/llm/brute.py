"""The results of the operators' contracts, computed row by row in plain Python."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return WORD.findall(text or "")


def crc(doc_id) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode())


def lm_base(docs):
    """[(doc_id, held_out, n_tokens, n_known, train_tokens, base_score)] in order of the rows."""
    tokens = [[*words((t or "").translate(UPPER)), None] for _, t in docs]
    held = [crc(i) % 7 == 2 for i, _ in docs]
    count = Counter(x for ts, h in zip(tokens, held) if not h for x in ts)
    n, v = sum(count.values()), len(count)
    out = []
    for (i, _), ts, h in zip(docs, tokens, held):
        base = sum(math.log10((count[x] + 1) / (n + v + 1)) for x in ts)
        out.append((i, h, len(ts), sum(count[x] > 0 for x in ts), n, base))
    return out


def stirling(c, d=0.5):
    """[S(c, t) for t = 1 .. c] by the recurrence S(c + 1, t) = S(c, t - 1) + (c - t d) S(c, t)."""
    row = [1.0]
    for n in range(1, c):
        row = [(row[t - 2] if t > 1 else 0.0) + ((n - t * d) * row[t - 1] if t <= n else 0.0) for t in range(1, n + 2)]
        top = max(row)
        row = [x / top for x in row]
    return row


def tables(c, y, u):
    """The number of tables drawn by u from the weights S(c, t) y^t."""
    logs = [math.log(s) + t * math.log(y) if s > 0 else -math.inf for t, s in enumerate(stirling(c), 1)]
    weights = [math.exp(x - max(logs)) for x in logs]
    total, at = u * sum(weights), 0.0
    for t, w in enumerate(weights, 1):
        at += w
        if at > total:
            return t
    return c


def lm_scores(docs, draws, burn_in, samples, d=0.5, theta=1.0):
    """({row: log10 probability}, {the sum over all words and the unknown one of p(word | context)}), customer by customer.

    draws(kind, sweep, word, context) gives the random numbers: a gamma variable of a shape, or a uniform one.
    """
    tokens = [["<s>", *words((t or "").translate(UPPER)), "</s>"] for _, t in docs]
    c = Counter((w, u) for ts, (i, _) in zip(tokens, docs) if crc(i) % 7 != 2 for u, w in zip(ts, ts[1:]))
    vocabulary = {w for w, _ in c}
    v, t, t0 = len(vocabulary), dict.fromkeys(c, 1), dict.fromkeys(vocabulary, 1)
    total, out, sums = Counter(), [0.0] * len(docs), []
    for (_, u), n in c.items():
        total[u] += n
    kept = []
    for sweep in range(1, burn_in + samples + 1):
        c0, of = Counter(), Counter()
        for (w, u), n in t.items():
            c0[w] += n
            of[u] += n
        before = sum(t0.values())
        p0 = {w: (c0[w] - d * t0[w] + (theta + d * before) / (v + 1)) / (theta + sum(c0.values())) for w in vocabulary}
        t = {(w, u): tables(n, d * draws("gamma", sweep, None, u, theta / d + of[u]) * p0[w], draws("seat", sweep, w, u, None)) for (w, u), n in c.items()}
        c0, of = Counter(), Counter()
        for (w, u), n in t.items():
            c0[w] += n
            of[u] += n
        x0 = draws("gamma", sweep, None, None, theta / d + before)
        t0 = {w: tables(c0[w], d * x0 / (v + 1), draws("root", sweep, w, None, None)) for w in vocabulary}
        if sweep > burn_in:
            rest = (theta + d * sum(t0.values())) / (v + 1)
            below = theta + sum(c0.values())
            parent = lambda w, c0=c0, t0=t0, rest=rest, below=below: (c0[w] - d * t0.get(w, 0) + rest) / below
            kept.append(lambda w, u, t=t, of=of, parent=parent: (c[w, u] - d * t.get((w, u), 0) + (theta + d * of[u]) * parent(w)) / (theta + total[u]))
    for p in kept:
        sums += [sum(p(w, u) for w in (*vocabulary, "never seen")) for u in (*list(total)[:5], "no context")]
    for k, ts in enumerate(tokens):
        out[k] = sum(math.log10(sum(p(w, u) for p in kept) / len(kept)) for u, w in zip(ts, ts[1:]))
    return out, sums


def substrings(docs, window=13):
    """[(doc_id, n_words, n_removed, kept_sha256)] in order of the rows; null ids are after all others."""
    key = lambda i: (i is None, i or 0)
    first = {}
    for i, t in docs:
        w = words(t)
        for k in range(len(w) - window + 1):
            g = tuple(w[k : k + window])
            if g not in first or key(i) < first[g]:
                first[g] = key(i)
    out = []
    for i, t in docs:
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if first[tuple(w[k : k + window])] < key(i):
                gone[k : k + window] = [True] * window
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((i, len(w), sum(gone), hashlib.sha256(" ".join(kept).encode("utf-8", "surrogatepass")).hexdigest()))
    return out


def shingles(text, size=5):
    """Counter of a text's shingles."""
    w = words(text)
    k = min(size, len(w))
    return Counter(tuple(w[i : i + k]) for i in range(len(w) - k + 1)) if w else Counter()


def probability_jaccard(x, y):
    """Of two weightings, by its definition: sum_i 1 / sum_j max(x_j / x_i, y_j / y_i)."""
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x.get(j, 0) / x[i], y.get(j, 0) / y[i]) for j in every) for i in x.keys() & y.keys())


def similar(x, y):
    """The larger of the probability Jaccard by counts and that of even weights, which is the Jaccard of the sets."""
    even = len(x.keys() & y.keys()) / len(x.keys() | y.keys())
    return max(even, probability_jaccard(x, y)) if max(*x.values(), *y.values()) > 1 else even


def near_classes(docs, threshold=0.8):
    """[class id of each row], by all pairs that share a shingle; wordless rows are alone."""
    sets = [shingles(t) for _, t in docs]
    parent = list(range(len(docs)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    by = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            by[g].append(i)
    seen = set()
    for rows in by.values():
        for a in range(len(rows)):
            for b in range(a + 1, len(rows)):
                pair = (rows[a], rows[b])
                if pair in seen:
                    continue
                seen.add(pair)
                x, y = sets[pair[0]], sets[pair[1]]
                if x == y or similar(x, y) >= threshold - 1e-9:
                    parent[root(pair[0])] = root(pair[1])
    least = {}
    for i, (d, _) in enumerate(docs):
        r = root(i)
        if r not in least or (d is not None and (least[r] is None or d < least[r])):
            least[r] = d
    return [least[root(i)] for i in range(len(docs))]


EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for k, c in enumerate(reversed(d)):
        v = int(c) * (1 + k % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def pii_base(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m[0])) <= 15],
    }
    spans = [f"{k}:{a}:{b}" for k, v in found.items() for a, b in v]
    return {k: len(v) for k, v in found.items()}, spans, hashlib.sha256(",".join(spans).encode()).hexdigest()


def quality(text):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed)"""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    at = defaultdict(list)
    for i in range(len(w) - 4):
        at[tuple(w[i : i + 5])].append(i)
    covered = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
    n, r = len(w), len(covered)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), r, n < 10 or 100 * r > 20 * n


def mix(docs, share=1.5, cap=2):
    """{source: (source_size, target)} of rows (source, text)."""
    size = defaultdict(int)
    for s, t in docs:
        size[s] += len(words(t))
    order = sorted(size, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(order)}
    left, open_, target = share * sum(size.values()), set(order), {}
    while open_:
        per = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if per * weight[s] > cap * size[s]}
        if not over:
            target |= {s: per * weight[s] for s in open_}
            break
        for s in over:
            target[s] = float(cap * size[s])
            left -= target[s]
        open_ -= over
    return {s: (size[s], target[s]) for s in order}


def top_k(rows, k=5, every=50):
    """{query: [(vec_id, score)]}; rows are (vec_id, vector)."""
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    return {q: sorted(((i, sum(a * b for a, b in zip(v, w))) for i, w in good if i != q), key=lambda p: (-p[1], p[0]))[:k] for q, v in good if q % every == 0}


def pii_row(text):
    """(n_email, n_ip, n_card, n_phone, base_sha256, base spans)"""
    counts, spans, digest = pii_base(text)
    return (*(counts[k] for k in ("email", "ip", "card", "phone")), digest, spans)
