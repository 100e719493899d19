"""Plain versions of the operators, for small tables."""

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def quality(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    repeated = {j for i, w in enumerate(windows) if times[w] > 1 for j in (i, i + 1, i + 2)}
    n, chars, symbols = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text))
    dup = len(lines) - len(set(lines))
    failed = n < 50 or 100 * len(repeated) > 50 * n
    kept = not (failed or 10 * symbols > n or 2 * dup > len(lines) or chars < 2 * n or chars > 15 * n or 10 * len(set(words)) < n)
    return n, chars, symbols, dup, len(repeated), failed, kept


def secrets(text, m):
    text, base, hot = text or "", [], []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    base += [(x.start(), 0, x.end()) for x in re.finditer(pattern, text, re.I | re.A) if len(x[2]) >= 6]
    base += [(x.start(), 1, x.end()) for x in re.finditer("AKIA[A-Z0-9]+", text) if len(x[0]) >= 20]
    base += [(x.start(), 2, x.end()) for x in re.finditer("[0-9a-f]+", text) if len(x[0]) >= 24]
    allowed = lambda w: bool(
        not re.search(m.NO_WORD, w) and not re.search(m.INNER_CAPITAL, w) or any(re.search(p, w) for p in m.ALLOWED)
    )
    for x in re.finditer(m.CANDIDATE, text):
        word, begin = x[0], x.start()
        while word and allowed(re.split("[=/]", word)[0]):
            cut = len(re.split("[=/]", word)[0]) + 1
            word, begin = word[cut:], begin + cut
        while word and allowed(re.split("[=/]", word)[-1]):
            word = word[: max(0, len(word) - len(re.split("[=/]", word)[-1]) - 1)]
        if len(word) < m.WINDOW or allowed(word) or re.search(m.ALL_BASE, word):
            continue
        covered = {3: set(), 4: set()}
        for i in range(len(word) - m.WINDOW + 1):
            window = word[i : i + m.WINDOW]
            kind = 3 if re.fullmatch("[0-9a-fA-F]+", window) else 4
            counts = Counter(window).values()
            if -sum(n / m.WINDOW * math.log2(n / m.WINDOW) for n in counts) >= m.LEAST_BITS[m.KINDS[kind]] - 1e-9:
                covered[kind] |= set(range(i, i + m.WINDOW))
        for kind, under in covered.items():
            for i in sorted(under):
                if i - 1 not in under:
                    stop = next(j for j in range(i, len(word) + 1) if j not in under)
                    hot.append((begin + i, kind, begin + stop))
    hot = [h for h in hot if not any(b[0] <= h[0] and h[2] <= b[2] for b in base)]
    told = lambda spans: ",".join(f"{m.KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))
    return (*(sum(b[1] == k for b in base) for k in range(3)), hashlib.sha256(told(base).encode()).hexdigest(), told(base + hot))


def repeats(rows):
    """Rows of (doc_id, text); the same id may come again."""
    given = [(i, (t or "").encode()) for i, t in rows]
    first = {}
    for i, x in given:
        for k in range(len(x) - 49):
            if i is not None:
                first[x[k : k + 50]] = min(i, first.get(x[k : k + 50], i))
    out = []
    for i, x in given:
        gone = bytearray(len(x))
        for k in range(len(x) - 49):
            if i is not None and first[x[k : k + 50]] < i:
                gone[k : k + 50] = b"\1" * 50
        kept = bytes(c for c, g in zip(x, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1]))
        out.append((i, len(x), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def without_repeats(rows, doc):
    """Text of a document (ids unique) without the bytes that repeat; cut characters go whole."""
    gone = {i: x for i, x in rows}[doc].encode()
    earlier = {x[k : k + 50] for i, t in rows if i < doc for x in [t.encode()] for k in range(len(x) - 49)}
    cover = set()
    for k in range(len(gone) - 49):
        if gone[k : k + 50] in earlier:
            cover |= set(range(k, k + 50))
    return bytes(c for k, c in enumerate(gone) if k not in cover).decode("utf-8", "ignore")


def jaccard(rows):
    sets = []
    for i, t in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} if words else set()))
    parent = list(range(len(sets)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = {}
    for k, (i, s) in enumerate(sets):
        for x in s if i is not None else ():
            holders.setdefault(x, []).append(k)
    for j, k in {(j, k) for ks in holders.values() for j in ks for k in ks if j < k}:
        if 100 * len(sets[j][1] & sets[k][1]) >= 75 * len(sets[j][1] | sets[k][1]):
            parent[top(k)] = top(j)
    least = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return [(i, len(s), least.get(top(k)) if i is not None else None) for k, (i, s) in enumerate(sets)]


def vector_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """Rows of (vec_id, vector, label) with whole vectors of one length that is a multiple of ``parts``."""
    rows = [(i, [math.floor(scale * x) for x in v], k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(rows[0][1]) // parts
    cut = lambda v, p: v[p * width : (p + 1) * width]
    seeds = [v for _, v, _ in sorted(rows, key=lambda r: r[0])[:entries]]
    books = [[cut(v, p) for v in seeds] for p in range(parts)]
    nearest = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = {}
            for _, v, _ in rows:
                held.setdefault(nearest(cut(v, p), books[p])[1], []).append(cut(v, p))
            for k, xs in held.items():
                books[p][k] = [sum(c) // len(xs) for c in zip(*xs)]
    told = []
    for i, v, label in rows:
        best = [nearest(cut(v, p), books[p]) for p in range(parts)]
        told.append((i, "".join(f"{k:02x}" for _, k in best), sum(e for e, _ in best), label))
    sums = Counter()
    for _, _, e, label in told:
        sums[label] += e
    sha = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return [(i, code, e, sums[label], sha) for i, code, e, label in told]


def hard_negatives(rows, anchors=100, moved=None, k=5, low=80):
    """Rows of (vec_id, vector, label); ids are unique."""
    held = []
    for i, v, label in rows:
        if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            held.append((i, [math.floor(256 * x) for x in v], (label + 1) % 10 if moved and i % moved == 0 else label))
    out = []
    for a, u, label in held:
        if a % anchors:
            continue
        scored = sorted((-sum(x * y for x, y in zip(u, v)), i, other == label) for i, v, other in held if i != a)
        for p, positive in [(-s, i) for s, i, same in scored if same][:k]:
            good = [(i, -s) for s, i, same in scored if not same and low * p <= -100 * s <= 100 * p][:k]
            out += [(a, positive, rank, i, p, s) for rank, (i, s) in enumerate(good, 1)]
    return out


def languages(rows, buckets, smoothing):
    """Rows of (doc_id, text, lang), all learnt from but those held out; ``doc_id, lang_pred, score`` of each."""
    letter = lambda ch: ord(ch.lower()[0]) if ch.isalpha() else 0
    shift, whole = 32 - (buckets.bit_length() - 1), 2**32 - 1

    def grams(text):
        c = [letter(ch) for ch in text] + [0, 0]
        out = [(x * 2654435761 & whole) >> shift for x in c] + [0, 0, 0, 0]
        for i in range(len(text)):
            key = c[i] * 0x01000193 & whole
            for x in c[i + 1 : i + 3]:
                key = (key ^ x) * 0x85EBCA6B & whole
                out.append(((key ^ key >> 15) * 2654435761 & whole) >> shift)
        return out

    counts, sizes = {}, Counter()
    for i, text, lang in rows:
        if i is not None and zlib.crc32(str(i).encode()) % 4 != 2 and text is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(grams(text))
            sizes[lang] += 1
    told = []
    for i, text, _ in rows:
        if not any(letter(ch) for ch in text or "") or not counts:
            told.append((i, "und", 0.0))
            continue
        own = grams(text)
        sums = {}
        for lang, n in counts.items():
            total = sum(n.values()) + smoothing * buckets
            sums[lang] = math.log(sizes[lang] / sum(sizes.values())) + sum(math.log((n[g] + smoothing) / total) for g in own)
        best = max(sorted(sums), key=sums.get)
        told.append((i, best, 1 / sum(math.exp(min(700, x - sums[best])) for x in sums.values())))
    return told
