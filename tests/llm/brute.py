"""Plain Python versions of what the operators compute, and rows that are hard for them."""

from __future__ import annotations

import hashlib
import random
import re

BLANKS = " \t\n\x0b\x0c\r"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, id long, n int, spans string, kept string, line string, label long"


def lower(text: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def blank_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def frame(spark, docs: list[tuple]):
    """docs: (doc_id, text) or (doc_id, text, lang); with columns whose names clash with ours."""
    rows = [
        (d[0], d[1], d[2] if len(d) > 2 else None, None, None, "r", 7, 1, "s", "k", "l", 3) for d in docs
    ]
    return spark.createDataFrame(rows, SCHEMA)


def edge_docs() -> list[tuple]:
    """Null, empty, blank and long texts, copies, ties, repeated rows, a row without an id."""
    rng = random.Random(3)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta", "THETA", "iota"]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    near = passage.split()
    near[30] = "changed"
    docs = [
        (1, None), (2, ""), (3, " \t\n\x0b "), (4, passage), (5, passage), (6, " ".join(near)),
        (7, "one two\n\none two\nshort\nTen letters exactly\n  ten LETTERS exactly\t\nend"),
        (8, "Ten Letters Exactly\nother line that is long"), (9, "x" * 300), (10, "y" + "x" * 300),
        (11, passage + "\n" + " ".join(rng.choice(vocabulary) for _ in range(2500))),
        (12, "alpha beta"), (12, "alpha beta"), (13, "alpha"), (14, "日本語 のテキスト " * 12),
    ]
    for i in range(15, 40):  # few words, so that windows repeat everywhere
        docs.append((i, " ".join(rng.choice("ab") for _ in range(rng.randrange(0, 60)))))
    return docs


def line_dedup(docs: list[tuple], least: int = 10) -> dict[int, tuple]:
    key = lambda line: lower(line.strip(BLANKS))
    holder: dict[str, int] = {}
    for i, text in docs:
        for line in (text or "").split("\n"):
            k = key(line)
            holder[k] = min(i, holder.get(k, i))
    out = {}
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(key(x)) < least or holder[key(x)] == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def word_repeats(docs: list[tuple], window: int) -> dict[int, tuple]:
    first: dict[tuple, tuple] = {}
    words = {i: blank_words(t) for i, t in docs}
    for i, ws in words.items():
        for s in range(len(ws) - window + 1):
            k = tuple(ws[s : s + window])
            first[k] = min(first.get(k, (i, s)), (i, s))
    out = {}
    for i, ws in words.items():
        gone = set()
        for s in range(len(ws) - window + 1):
            if first[tuple(ws[s : s + window])] < (i, s):
                gone.update(range(s, s + window))
        out[i] = (len(ws), len(gone), " ".join(w for k, w in enumerate(ws) if k not in gone))
    return out


def byte_repeats(docs: list[tuple], length: int) -> dict[int, tuple]:
    raw = {i: (t or "").encode() for i, t in docs}
    first: dict[bytes, int] = {}
    for i, b in raw.items():
        for s in range(len(b) - length + 1):
            k = b[s : s + length]
            first[k] = min(first.get(k, i), i)
    out = {}
    for i, b in raw.items():
        gone = bytearray(len(b))
        for s in range(len(b) - length + 1):
            if first[b[s : s + length]] < i:
                gone[s : s + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out[i] = (len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone, strict=True) if not g))
    return out


def shingles(text: str | None, size: int) -> set:
    ws = blank_words(lower(text or ""))
    return {tuple(ws[i : i + size]) for i in range(max(1, len(ws) - size + 1))} if ws else set()


def similar_components(docs: list[tuple], size: int, percent: int) -> dict[int, tuple]:
    sets = {i: shingles(t, size) for i, t in docs}
    parent = {i: i for i in sets}

    def find(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for a, x in enumerate(ids):
        for y in ids[a + 1 :]:
            both = len(sets[x] & sets[y])
            if both and 100 * both >= percent * len(sets[x] | sets[y]):
                low, high = sorted((find(x), find(y)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def leaks(docs: list[tuple], items: list[tuple], window: int = 10) -> dict[int, tuple]:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    tests: dict[tuple, set] = {}
    for item, text in items:
        ws = re.findall(pattern, lower(text or ""))
        m = min(window, len(ws))
        for s in range(len(ws) - m + 1) if m else ():
            tests.setdefault(tuple(ws[s : s + m]), set()).add(item)
    sizes = {len(k) for k in tests}
    out = {}
    for i, text in docs:
        ws = re.findall(pattern, lower(text or ""))
        hit, named = set(), set()
        for m in sizes:
            for s in range(len(ws) - m + 1):
                if owners := tests.get(tuple(ws[s : s + m])):
                    hit.update(range(s, s + m))
                    named |= owners
        out[i] = (len(ws), len(hit), sorted(str(x) for x in named if x is not None))
    return out
