"""Small tables with the awkward rows that every operator has to stand, and plain versions of what operators compute."""

from __future__ import annotations

import random
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0d]+")

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, kept string, row long, node string"


def prose(rng: random.Random, words: int) -> str:
    parts = ["the", "of", "and", "tion", "er", "on", "re", "sh", "ea", "nd", "ou", "wh", "ing", "ly", "or"]
    return " ".join("".join(rng.choices(parts, k=rng.randint(1, 3))) for _ in range(words))


def near(rng: random.Random, text: str, share: float) -> str:
    return " ".join(prose(rng, 1) if rng.random() < share else w for w in text.split(" "))


def rows(seed: int = 5) -> list[tuple]:
    """Prose, exact and near copies, shared passages, nulls, empty, short, long, periodic and non-Latin texts."""
    rng = random.Random(seed)
    base = [prose(rng, rng.randint(60, 200)) for _ in range(8)]
    passage = prose(rng, 60)
    texts: list[str | None] = [*base, *base[:3], base[0] + " \n", base[1].replace(" ", "  ")]
    texts += [near(rng, base[k % 4], share) for k in range(24) for share in (0.01, 0.03)]
    texts += [prose(rng, 40) + passage + prose(rng, 40) for _ in range(5)]
    texts += [None, "", None, "", " \t\n", "one", "one two", "one  two", "One Two", "a b c d", "a b c d e", "a b c d e f"]
    texts += ["na " * 400, "x" * 900, prose(rng, 6000), "длинный текст на кириллице " * 12, "汉字 " * 90, "é" * 150 + "ü" * 150]
    texts += ["<|endoftext|> it's 12345 ΣΑΣ Σ İstanbul   é don't!!! ???", "\x1c\x1d a\x85b", "12 34 | 56 # 78"]
    out = [(k, t, "en" if k % 3 else "fr", f"s{k % 2}", len(t or ""), "x", k, None) for k, t in enumerate(texts)]
    return out + [out[0], out[0], out[9], (None, base[2], None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]


def shingle_set(text: str | None, width: int = 5) -> frozenset:
    words = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[k:k + width]) for k in range(max(len(words) - width + 1, 1)))


def near_components(docs: list[tuple[int, str | None]], percent: int = 85) -> dict[int, int]:
    sets = {i: shingle_set(t) for i, t in docs}
    up = {i: i for i in sets}

    def find(i: int) -> int:
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def repeated_bytes(texts: list[str | None], length: int = 200) -> list[list[bool]]:
    seen: Counter = Counter()
    data = [(t or "").encode() for t in texts]
    for d in data:
        seen.update(d[k:k + length] for k in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = [False] * len(d)
        for k in range(len(d) - length + 1):
            if seen[d[k:k + length]] > 1:
                gone[k:k + length] = [True] * length
        out.append(gone)
    return out


def rule_counts(text: str | None) -> tuple[int, int, int, int, int]:
    words = WORD.findall(text or "")
    three = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {k + j for k in range(len(words) - 2) if three[tuple(words[k:k + 3])] > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)
