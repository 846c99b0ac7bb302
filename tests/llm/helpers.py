"""Small frames and texts for the tests of the llm operators."""

from __future__ import annotations

import random
import re

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, kept string, passages string"


def documents(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, lang), with extra columns that clash with names of results."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, None, len(r[1] or ""), "x", "y", "z") for r in rows]
    return spark.createDataFrame(full, DOCS).repartition(3)


def sentence(rng: random.Random, words: int, vocabulary: int = 4000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(words))


def shingles(text: str | None, size: int) -> set:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < size:
        return {tuple(words)} if words else set()
    return {tuple(words[k : k + size]) for k in range(len(words) - size + 1)}


def least_reachable(nodes, links) -> dict:
    """The smallest node of each node's component."""
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
