"""The operators by their plain definition, for small tables."""

import hashlib
import math
import re
import zlib
from collections import defaultdict

import xxhash


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2


def lower(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


class Groups:
    """Union-find over keys."""

    def __init__(self):
        self.up = {}

    def root(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = sorted((self.root(a), self.root(b)))
        self.up[b] = a


def contaminated(docs, items, window=10):
    """{position of the row: (n_words, n_hit, item ids)}"""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item_id, text in items:
        w = word.findall(lower(text))
        for s in range(max(len(w) - window, 0) + 1 if w else 0):
            windows[tuple(w[s : s + window])].add(item_id)
    lengths = {len(w) for w in windows}
    out = []
    for doc_id, text in docs:
        w = word.findall(lower(text))
        hit, ids = set(), set()
        for n in lengths:
            for s in range(len(w) - n + 1):
                found = windows.get(tuple(w[s : s + n]))
                if found:
                    hit |= set(range(s, s + n))
                    ids |= found
        ids = sorted(str(i) for i in ids if i is not None)
        out.append((doc_id, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit)))
    return out


def fingerprint(text, shingle=3):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower(text)) if w]
    if not words:
        return 0
    parts = [" ".join(words[i : i + shingle]) for i in range(max(len(words) - shingle, 0) + 1)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash(docs, most=3):
    """(doc_id, hex, smallest id of the component) of each (doc_id, text)."""
    fps = [fingerprint(t) for _, t in docs]
    groups, distinct = Groups(), sorted(set(fps))
    for i, a in enumerate(distinct):
        for b in distinct[i + 1 :]:
            if (a ^ b).bit_count() <= most:
                groups.join(a, b)
    least = defaultdict(list)
    for (doc_id, _), fp in zip(docs, fps):
        if doc_id is not None:
            least[groups.root(fp)].append(doc_id)
    return [(d, f"{fp:016x}", min(least[groups.root(fp)], default=None)) for (d, _), fp in zip(docs, fps)]


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _passes(kind, value):
    digits = [int(c) for c in value if c.isascii() and c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "phone":
        return 9 <= len(digits) <= 15
    if kind == "card":
        total = sum(d if i % 2 == 0 else d * 2 - 9 * (d > 4) for i, d in enumerate(reversed(digits)))
        return 12 <= len(digits) <= 19 and total % 10 == 0
    return True


def base_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        found += [(m.start(), rank, m.end(), kind) for m in re.finditer(pattern, text or "") if _passes(kind, m.group())]
    return [(kind, start, end) for start, _, end, kind in sorted(found)]


def lines_kept(docs, size=3):
    """(doc_id, text, lines removed) of each (doc_id, text); ids are unique."""
    seen, out = set(), []
    for doc_id, text in sorted(docs, key=lambda d: (d[0] is None, d[0])):
        lines = [] if text is None else text.split("\n")
        full = [i for i, line in enumerate(lines) if line.strip(" ")]
        gone = set()
        for k in range(len(full) - size + 1):
            at = full[k : k + size]
            key = tuple(lines[i].strip(" ") for i in at)
            if key in seen:
                gone |= set(range(at[0], at[-1] + 1))
            seen.add(key)
        kept = None if text is None else "\n".join(line for i, line in enumerate(lines) if i not in gone)
        out.append((doc_id, kept, len(gone)))
    return out


def letter_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def resampled(docs, target, percent=10, min_words=20, longest=1, buckets=10_000, seed=2024):
    """[doc_id, n_features, weight, score, rank] of each (doc_id, text); of equal keys any may be drawn."""

    def features(text):
        w = letter_words(text)
        runs = [" ".join(w[i : i + n]) for n in range(1, longest + 1) for i in range(len(w) - n + 1)]
        return [zlib.crc32(r.encode()) % buckets for r in runs]

    held, wanted = [features(t) for _, t in docs], [features(t) for t in target]
    source, sought = [1] * buckets, [1] * buckets
    for counts, texts in ((source, held), (sought, wanted)):
        for bucket in (b for t in texts for b in t):
            counts[bucket] += 1
    s, t = sum(source), sum(sought)
    gain = [math.floor(1000 * math.log(sought[b] * s / (source[b] * t))) for b in range(buckets)]
    out, order = [], []
    for i, ((doc_id, text), own) in enumerate(zip(docs, held)):
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        named = f"{seed}:{'' if doc_id is None else doc_id}"
        h = int(hashlib.sha256(named.encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(own), weight, score, None])
        if len(letter_words(text)) >= min_words:
            order.append((-score, doc_id is None, doc_id or 0, i))
    for rank, (*_, i) in enumerate(sorted(order)[: percent * len(order) // 100], 1):
        out[i][4] = rank
    return out


def spelling(docs, min_length=6, min_count=5, ratio=5, every=None):
    """(word, form, root, n, n_near, form_n) of each word; near words by comparing all pairs."""
    counts = defaultdict(int)
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= min_length and c >= min_count}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = {}, {}
    for w in n:
        partners = [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(partners, key=lambda x: (-n[x], x), default=None)
        if best and n[best] >= ratio * n[w]:
            form[w] = best
        out[w] = len(partners)

    def root(w):
        return root(form[w]) if w in form else w

    return [(w, form.get(w), root(w), n[w], out[w], n.get(form.get(w))) for w in n]


def rule_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed"""
    text = text or ""
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", text) if x]
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    at = defaultdict(list)
    for i in range(len(w) - 2):
        at[tuple(w[i : i + 3])].append(i)
    covered = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(3)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed
