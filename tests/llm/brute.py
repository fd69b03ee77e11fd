"""Plain restatements of the contracts, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_figures(text: str | None) -> tuple[int, ...]:
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    seen, covered = Counter(runs), set()
    for i, run in enumerate(runs):
        if seen[run] > 1:
            covered.update(range(i, i + 8))
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def base_failed(text: str | None) -> bool:
    n, *_, repeats = base_figures(text)
    return n < 20 or 100 * repeats > 30 * n


class Classes:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def find(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def link(self, i, j):
        i, j = self.find(i), self.find(j)
        self.parent[max(i, j)] = min(i, j)


def shingles(text: str | None, width: int = 5) -> frozenset:
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def near_duplicates(rows: list[tuple[int, str | None]]) -> dict[int, tuple[int, int]]:
    sets = {i: shingles(t) for i, t in rows}
    classes, having = Classes(sets), defaultdict(list)
    for i, own in sets.items():
        shared = Counter(j for s in own for j in having[s])
        for j, n in shared.items():
            if 100 * n >= 75 * (len(own) + len(sets[j]) - n):
                classes.link(i, j)
        for s in own:
            having[s].append(i)
    return {i: (len(s), classes.find(i)) for i, s in sets.items()}


def repeats(rows: list[tuple[int, str | None]], length: int) -> dict[int, tuple]:
    data = [(i, (t or "").encode()) for i, t in rows]
    times = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = {}
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if times[b[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest())
    return out


def without_passages(rows: list[tuple[int, str]], length: int, words: int) -> dict[int, str]:
    """Texts without runs of repeated bytes that hold so many whole words."""
    data = [(i, t.encode()) for i, t in rows]
    times = Counter(b[p : p + length] for _, b in data for p in range(len(b) - length + 1))
    out = {}
    for i, b in data:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if times[b[p : p + length]] > 1:
                gone[p : p + length] = b"\x01" * length
        kept, at = b"", 0
        for m in re.finditer(b"\x01+", bytes(gone)):
            whole = sum(m.start() <= w.start() and w.end() <= m.end() for w in re.finditer(rb"[^\x20\x09-\x0d]+", b))
            if whole >= words:
                kept, at = kept + b[at : m.start()], m.end()
        out[i] = (kept + b[at:]).decode("utf-8", "ignore")
    return out


def near_vectors(rows: list[tuple], least: float = 0.93) -> dict[int, tuple[int, int]]:
    def good(e):
        return e is not None and None not in e and np.isfinite(np.array(e, float)).all() and np.array(e, float).any()

    classes, links, groups = Classes(r[0] for r in rows), Counter(), defaultdict(list)
    for i, e, label in rows:
        if label is not None and good(e):
            groups[label, len(e)].append((i, np.array(e, float)))
    for group in groups.values():
        x = np.array([e for _, e in group])
        x /= np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(np.triu(x @ x.T >= least, 1)), strict=True):
            i, j = group[a][0], group[b][0]
            links[i] += 1
            links[j] += 1
            classes.link(i, j)
    return {r[0]: (links[r[0]], classes.find(r[0])) for r in rows}


def fewest_bins(items: list[int], capacity: int) -> int:
    items, best = sorted(items, reverse=True), [len(items)]

    def go(i: int, room: list[int]) -> None:
        if len(room) >= best[0]:
            return
        if i == len(items):
            best[0] = len(room)
            return
        for k in {r: k for k, r in enumerate(room) if r >= items[i]}.values():
            room[k] -= items[i]
            go(i + 1, room)
            room[k] += items[i]
        go(i + 1, [*room, capacity - items[i]])

    go(0, [])
    return best[0]


def luhn(digits: str) -> bool:
    return sum(int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(digits))) % 10 == 0


def personal(text: str) -> list[tuple[str, int, int]]:
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 14 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 10 <= len(digits(m[0])) <= 15]
    order = ["email", "ip", "card", "phone"]
    return sorted(((k, m.start(), m.end()) for k, m in found), key=lambda s: (s[1], order.index(s[0])))
