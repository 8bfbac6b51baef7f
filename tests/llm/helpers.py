"""A small corpus with copies, shared passages, junk and odd texts, and brute-force answers."""

from __future__ import annotations

import random
import re
from collections import defaultdict

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(r: random.Random, n: int) -> list[str]:
    return ["".join(r.choice(["an", "the", "or", "é", "ion", "St", "x"]) for _ in range(r.randint(1, 4))) + r.choice(["", "", "", ",", "."]) for _ in range(n)]


def corpus(seed: int = 1, n: int = 40) -> list[tuple]:
    r = random.Random(seed)
    passage = " ".join(words(r, 60))
    texts: list[str | None] = []
    for i in range(n):
        w = words(r, r.choice([1, 3, 4, 5, 19, 20, 21, 60, 150, 400]))
        t = " ".join(w)
        if i % 5 == 0:
            t = t + "\n" + passage + "\n" + " ".join(words(r, 10))
        if i % 7 == 0:
            t += "\n" + "Ab, " * 80
        texts.append(t)
    base = words(r, 200)
    for k in range(8):  # near copies
        w = list(base)
        for _ in range(k):
            w[r.randrange(len(w))] = "edited"
        texts.append(" ".join(w))
    texts += [None, "", "   \n\t", "one", "one", "ONE", "a b c", "a b c", texts[3], texts[3], " ".join(base).upper(), "x" * 5000, "\u00a0nbsp\u2003em", "日本語 テキスト " * 40, "🙂 " * 300]
    return [(i * 3, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]


def shingles(text: str | None, n: int = 5) -> frozenset:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components(n: int, links) -> list[int]:
    up = list(range(n))

    def root(x: int) -> int:
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def repeated_bytes(texts: list[bytes], width: int) -> list[list[bool]]:
    at = defaultdict(list)
    for d, t in enumerate(texts):
        for i in range(len(t) - width + 1):
            at[t[i : i + width]].append((d, i))
    gone = [[False] * len(t) for t in texts]
    for v in at.values():
        if len(v) > 1:
            for d, i in v:
                gone[d][i : i + width] = [True] * width
    return gone


def thue_morse(n: int, one: str = "a", two: str = "b") -> tuple[str, str]:
    """The Thue-Morse sequence of n letters and its complement, which polynomials modulo powers of two cannot tell apart."""
    bits = [i.bit_count() & 1 for i in range(n)]
    return "".join((one, two)[b] for b in bits), "".join((two, one)[b] for b in bits)
