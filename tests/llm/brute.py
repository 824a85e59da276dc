"""Row-by-row results of the operators, for comparison."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def measures(text: str | None) -> tuple[int, int, int, int, int]:
    text, w = text or "", words(text)
    windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
    found = Counter(windows)
    repeated = {i + k for i, x in enumerate(windows) if found[x] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if words(x)]
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(repeated)


def shingles(text: str | None, size: int) -> frozenset:
    w = words((text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def similar(docs: list[tuple[int, str | None]], size: int = 4, link: int = 85) -> dict[int, tuple[int, int]]:
    """id: (number of shingles, smallest id of its component)."""
    of = {i: shingles(t, size) for i, t in docs}
    root = {i: i for i in of}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in of.items():
        for x in s:
            holders[x].append(i)
    for i, s in of.items():
        for j, n in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * n >= link * (len(s) + len(of[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    least = {}
    for i in of:
        least[find(i)] = min(i, least.get(find(i), i))
    return {i: (len(s), least[find(i)]) for i, s in of.items()}


def spans(text: str, pattern: str, flags: int = 0, group: int = 0) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m.group(group)) for m in re.finditer(pattern, text, flags)]


def digest(found: list[tuple[str, list[tuple[int, int, str]]]]) -> tuple[list[int], str, str]:
    """Counts of each kind, the listing, and its hash."""
    every = sorted((a, k, b, kind) for k, (kind, items) in enumerate(found) for a, b, _ in items)
    listed = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in every)
    return [len(items) for _, items in found], listed, hashlib.sha256(listed.encode()).hexdigest()


def secrets(text: str | None) -> tuple[list[int], str, str]:
    text = text or ""
    assign = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    return digest(
        [
            ("assign", [s for s in spans(text, assign, re.IGNORECASE | re.ASCII, 2) if len(s[2]) >= 6]),
            ("access", [s for s in spans(text, "AKIA[A-Z0-9]+") if len(s[2]) >= 20]),
            ("hex", [s for s in spans(text, "[0-9a-f]+") if len(s[2]) >= 24]),
        ]
    )


def luhn(digits: str) -> bool:
    doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
    return sum(d - 9 * (d > 9) for d in doubled) % 10 == 0


def personal(text: str | None) -> tuple[list[int], str, str]:
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s[2])
    return digest(
        [
            ("email", spans(text, r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")),
            ("ip", [s for s in spans(text, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)") if all(int(p) <= 255 for p in s[2].split("."))]),
            ("card", [s for s in spans(text, r"[0-9]([\x20-]?[0-9])+") if 14 <= len(digits(s)) <= 19 and luhn(digits(s))]),
            ("phone", [s for s in spans(text, r"\+[0-9][\x20().0-9-]+[0-9]") if 10 <= len(digits(s)) <= 15]),
        ]
    )


def repeats(docs: list[tuple[int, str | None]], size: int = 200) -> dict[int, tuple[int, int, int, str]]:
    """id: bytes, bytes covered by repeated strings, runs of them, hash of the rest."""
    data = {i: (t or "").encode() for i, t in docs}
    found = Counter(b[k : k + size] for b in data.values() for k in range(len(b) - size + 1))
    out = {}
    for i, b in data.items():
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if found[b[k : k + size]] > 1:
                gone[k : k + size] = b"\x01" * size
        rest = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out[i] = (len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(rest).hexdigest())
    return out


def windows(docs: list[tuple[int, str | None]], size: int = 35) -> list[tuple]:
    """(id, words, words covered by repeated windows, hash of the rest) of each row."""
    every = [words(t) for _, t in docs]
    found = Counter(tuple(w[k : k + size]) for w in every for k in range(len(w) - size + 1))
    out = []
    for (i, _), w in zip(docs, every, strict=True):
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if found[tuple(w[k : k + size])] > 1:
                gone[k : k + size] = [True] * size
        rest = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(rest.encode()).hexdigest()))
    return out


def runs(w: list, least: int = 24, repeats: int = 3) -> list[tuple[int, int, int]]:
    """(start, length, smallest period) of every run, by start and period."""
    found = {}
    for p in range(1, len(w) // repeats + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j + p - i >= max(least, repeats * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((a, b - a, p) for (a, b), p in found.items())


def hard_negatives(rows: list[tuple], is_anchor, positives: int = 5, negatives: int = 10, scale: int = 256) -> list[tuple]:
    """(anchor, positive, rank, negative, both scores) of rows (id, label, vector)."""
    sound = {}
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            whole = [max(-(1 << 26), min(1 << 26, math.floor(scale * x))) for x in v]
            sound[i] = min(sound.get(i, (str(label), whole)), (str(label), whole))
    out = []
    for i, (label, v) in sound.items():
        if is_anchor(i):
            scored = sorted((-sum(x * y for x, y in zip(v, u, strict=False)), j, name) for j, (name, u) in sound.items() if j != i)
            for s, j, _ in [x for x in scored if x[2] == label][:positives]:
                fit = [x for x in scored if x[2] != label and 30 * -s <= 100 * -x[0] <= 90 * -s][:negatives]
                out += [(i, j, k + 1, n, -s, -t) for k, (t, n, _) in enumerate(fit)]
    return sorted(out)


def template(pages: list[str], module) -> set[int]:
    """The fixed texts of one host, page by page and token by token."""
    seen = {}
    for html in pages:
        texts, elements = module.pieces(html)
        story = tuple(" ".join(p.text.split()) for p in module._chosen(module._article(texts)) if p.text.strip())
        counts = seen.setdefault(story, {})
        mine = {(module.ROOT, 0, False): 1}
        for token in [(*e, False) for e in elements] + [(module._token(p), p.element, True) for p in texts if p.text.strip()]:
            mine[token] = mine.get(token, 0) + 1
        for token, n in mine.items():
            counts[token] = max(counts.get(token, 0), n)
    stories = list(seen.values())
    if len(stories) < module.PAGES:
        return set()
    vector = {}
    for token in {t for s in stories for t in s}:
        counts = tuple(s.get(token, 0) for s in stories)
        if sum(n > 0 for n in counts) >= module.SHARE * len(stories):
            vector[token] = counts
    of = {token[0]: v for token, v in vector.items() if not token[2]}
    fixed = set()
    for token, v in vector.items():
        around = of.get(token[1])
        alike = [t for t, w in vector.items() if w == v and of.get(t[1]) == around]
        if token[2] and (v in (around, of[module.ROOT]) or len(alike) > 1):
            fixed.add(token[0])
    return fixed


def replaced(text: str, spans: list[tuple[int, int]], new: str) -> str:
    """The text with its spans replaced, one by one; what overlaps one before only takes away."""
    at, out = 0, ""
    for start, end in sorted(spans, key=lambda s: (s[0], -s[1])):
        if start >= at:
            out += text[at:start] + new
        at = max(at, end)
    return out + text[at:]
