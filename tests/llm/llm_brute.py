"""Plain Python versions of the operators, and the tables they are tried on."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0D]+")
ALNUM = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def sha256(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def prose(seed: int, words: int, width: int = 400) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(width)}{'é' if draw.random() < 0.1 else ''}" for _ in range(words))


def lined(seed: int, lines: int, words: int = 8) -> str:
    return "\n".join(prose(seed * 1000 + i, words) for i in range(lines))


def awkward_texts() -> list[tuple]:
    """(doc_id, text): nulls, empties, repeats, near copies, shared passages and a very long text."""
    base, passage = prose(1, 120), prose(2, 60)
    words = base.split(" ")
    rows = [(1, base), (2, None), (3, ""), (4, " \t\n "), (5, "one"), (6, "one"), (7, "One two"), (8, base), (8, base),
            (9, " ".join(words[:60] + ["x"] + words[61:])), (10, " ".join(words[:30] + ["y", "z"] + words[32:])),
            (11, prose(3, 40) + " " + passage), (12, passage + "\n" + prose(4, 30)), (13, "ab" * 300), (14, "a" * 777),
            (None, prose(5, 50)), (None, None), (15, "日本語 テキスト " * 40), (15, "another text of the same id"),
            (16, prose(6, 20000, 5000) + " " + passage), (17, "<|turn|> \\ </s>  \x00 x")]
    return rows + [(100 + i, prose(50 + i // 3, 25 + i % 3)) for i in range(30)]


def removed_bytes(texts: list, length: int = 200) -> list[tuple]:
    """(n_bytes, n_removed, n_spans, kept) per text."""
    bodies = [(text or "").encode() for text in texts]
    seen = Counter(body[i:i + length] for body in bodies for i in range(len(body) - length + 1))
    out = []
    for body in bodies:
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            if seen[body[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(body, gone) if not g)
        out.append((len(body), sum(gone), sum(gone[i] and not (i and gone[i - 1]) for i in range(len(body))), kept))
    return out


def benchmark_hits(texts: list, items: list[tuple], window: int = 10) -> list[tuple]:
    """(n_words, n_hit, set of item ids) per text."""
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOWER))
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows[tuple(words[i:i + size])].add(item)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        words = ALNUM.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for size in sizes:
            for i in range(len(words) - size + 1):
                if tuple(words[i:i + size]) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[tuple(words[i:i + size])]
        out.append((len(words), len(hit), found))
    return out


def quality_counts(text: str | None) -> tuple:
    text = text or ""
    words = SPACED.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if SPACED.search(line):
            dup += line in seen
            seen.add(line)
    grams = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    cover = {j for i in range(len(words) - 4) if grams[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return len(words), sum(map(len, words)), len(re.findall("[#*$%&|<>]", text)), dup, len(cover)


def shingle_set(text: str | None, size: int) -> frozenset:
    words = SPACED.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(max(1, len(words) - size + 1)))


def near_groups(texts: list, size: int) -> list[set]:
    """Index sets of the groups, by comparing all pairs."""
    sets = [shingle_set(text, size) for text in texts]
    parent = list(range(len(sets)))

    def top(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                parent[top(i)] = top(j)
    groups = defaultdict(set)
    for i in range(len(sets)):
        groups[top(i)].add(i)
    return list(groups.values())


def strong_spans(text: str | None) -> list[tuple]:
    """(start, kind number, end) of the strong spans."""
    text = text or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def without_runs(texts: list[tuple], run: int = 3) -> dict:
    """Deleted line numbers by (doc_id, text), documents in the order of ids."""
    seen, out = set(), {}
    for doc_id, text in texts:
        lines = text.split("\n") if text is not None else []
        gone, mine = set(), []
        for i in range(len(lines) - run + 1):
            window = tuple(lines[i:i + run])
            if any(re.search(r"[^ \t\n\x0b\f\r]", line) for line in window):
                if window in seen or window in mine:
                    gone.update(range(i, i + run))
                mine.append(window)
        seen.update(mine)
        out[doc_id, text] = gone
    return out


def linked_spans(text: str | None, parts: list[tuple[int, int, int]], reach: int) -> list[tuple]:
    """(start, kind number, end) to report, every weak part held against every other part."""
    text = text or ""
    breaks = [m.start() for m in re.finditer(r"\n[ \t]*\n", text)]

    def scope(start):
        return sum(place < start for place in breaks)

    identifiers, secrets, endpoints = {1, 3}, {0, 2, 4}, {5}
    needs = {3: secrets, 4: identifiers | endpoints, 5: secrets}
    out = []
    for kind, start, end in parts:
        if kind < 3 or any(
                other in needs[kind] and scope(at) == scope(start) and abs(at - start) <= reach for other, at, _ in parts):
            out.append((start, kind, end))
    return sorted(set(out))
