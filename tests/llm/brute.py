"""Plain versions of the operators, row by row, as the contracts put them."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash
import zstandard

SPACE = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_dedup(docs, min_chars=20, min_docs=3):
    """(kept text, lines, dropped lines) for each (id, text)."""
    holders = defaultdict(list)
    for id_, text in docs:
        keys = {line.strip(SPACE).translate(LOWER) for line in (text or "").split("\n")}
        for key in keys:
            if len(key) >= min_chars:
                holders[key].append(id_)
    out = []
    for id_, text in docs:
        lines = (text or "").split("\n")
        kept = []
        for line in lines:
            ids = holders.get(line.strip(SPACE).translate(LOWER), [])
            known = [i for i in ids if i is not None]
            if len(ids) < min_docs or id_ == (max(known) if known else None):
                kept.append(line)
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def fingerprint(text, size):
    own = words((text or "").translate(LOWER))
    if not own:
        return 0
    parts = [" ".join(own[i : i + size]) for i in range(len(own) - size + 1)] or [" ".join(own)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def linked(keys, radius):
    """The root of each of the unsigned ``keys``: equal roots for what is linked."""
    array = np.array(keys, np.uint64)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(keys)):
        for j in np.flatnonzero(np.bitwise_count(array ^ array[i]) <= radius).tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[a] = b
    return [find(i) for i in range(len(keys))]


def simhash(docs, size=3, radius=3):
    """(fingerprint, smallest id of the component) for each (id, text)."""
    prints = [fingerprint(t, size) for _, t in docs]
    roots = linked(prints, radius)
    least = {}
    for root, (id_, _) in zip(roots, docs):
        if id_ is not None:
            least[root] = min(least.get(root, id_), id_)
    return [(f"{p:016x}", least.get(r)) for p, r in zip(prints, roots)]


def quality(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    text = text or ""
    own, seen, repeated_lines = words(text), set(), 0
    for line in text.split("\n"):
        if words(line):
            repeated_lines += line in seen
            seen.add(line)
    windows = list(zip(own, own[1:], own[2:]))
    counts, hit = Counter(windows), [False] * len(own)
    for i, window in enumerate(windows):
        if counts[window] > 1:
            hit[i] = hit[i + 1] = hit[i + 2] = True
    n, repeats = len(own), sum(hit)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    return n, sum(map(len, own)), symbols, repeated_lines, repeats, n < 50 or 100 * repeats > 50 * n


def luhn(digits):
    own = [int(c) for c in reversed(digits)]
    return (sum(own[0::2]) + sum(sum(divmod(2 * x, 10)) for x in own[1::2])) % 10 == 0


BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def pii(text):
    """The base spans in order of start and kind."""
    spans = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        for match in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", match[0])
            if kind == "ip":
                fits = all(int(part) <= 255 for part in match[0].split("."))
            elif kind == "card":
                fits = 14 <= len(digits) <= 19 and luhn(digits)
            else:
                fits = kind == "email" or 10 <= len(digits) <= 15
            if fits:
                spans.append((match.start(), number, kind, match.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def _iban(text):
    solid = text.replace(" ", "")
    return 15 <= len(solid) <= 34 and int("".join(str(int(c, 36)) for c in solid[4:] + solid[:4])) % 97 == 1


def all_pii(text, near=40):
    """The base spans, ibans that pass their checksum, and ssns with a context word nearby, in order."""
    text = text or ""
    spans = [(a, list(BASE).index(k), k, b) for k, a, b in pii(text)]
    for m in re.finditer(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])", text):
        if _iban(m[0]):
            spans.append((m.start(), 4, "iban", m.end()))
    for m in re.finditer(r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])", text):
        around = (text[max(0, m.start() - near) : m.start()], text[m.end() : m.end() + near])
        if any(re.search(r"\bssn\b|social\ssecurity", part.lower(), re.ASCII) for part in around):
            spans.append((m.start(), 5, "ssn", m.end()))
    return [(kind, start, end) for start, _, kind, end in sorted(spans)]


def redacted(text):
    out, at = [], 0
    for kind, start, end in all_pii(text):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return None if text is None else "".join(out) + text[at:]


def kept_by_bands(text, limits, chunk_limits, chunk=4_096, odd_share=0.5):
    """Whether the base rules and the compressed sizes of the whole and of its whole chunks keep a text."""
    data = (text or "").encode()
    if quality(text)[-1]:
        return False

    def ratio(part):
        return len(zstandard.ZstdCompressor(level=3).compress(part)) / len(part)

    _, low, high = max(band for band in limits if band[0] <= len(data))
    parts = [data[i : i + chunk] for i in range(0, len(data), chunk) if i + chunk <= len(data)]
    odd = [p for p in parts if not chunk_limits[0] <= ratio(p) <= chunk_limits[1]]
    return low <= ratio(data) <= high and len(odd) <= odd_share * len(parts)


def passages(texts, span):
    """(bytes, removed, runs, kept bytes) for each text."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(t[i : i + span] for t in data for i in range(len(t) - span + 1))
    out = []
    for text in data:
        gone = np.zeros(len(text) + 1, bool)
        for i in range(len(text) - span + 1):
            if counts[text[i : i + span]] > 1:
                gone[i : i + span] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((len(text), len(text) - len(kept), runs, kept))
    return out


def bm25(docs, queries, k=10, k1=1.2, b=0.75):
    """{query id: [(id, score)]} of the best documents, for lists of (id, text)."""
    bags = [(i, Counter(words((t or "").translate(LOWER)))) for i, t in docs]
    n = len(bags)
    mean = max(sum(sum(bag.values()) for _, bag in bags) / max(n, 1), 1)
    found = Counter(w for _, bag in bags for w in bag)
    out = {}
    for query, text in queries:
        scores = []
        for id_, bag in bags:
            length, score = sum(bag.values()), 0.0
            for word in set(words((text or "").translate(LOWER))):
                if bag[word]:
                    weight = math.log(1 + (n - found[word] + 0.5) / (found[word] + 0.5))
                    often = bag[word]
                    score += weight * often * (k1 + 1) / (often + k1 * (1 - b + b * length / mean))
            if score > 0:
                scores.append((-round(score, 9), id_))
        out[query] = [(id_, -score) for score, id_ in sorted(scores)[:k]]
    return out
