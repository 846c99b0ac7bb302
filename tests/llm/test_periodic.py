"""Periodic runs against their definition."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from docgraph.llm.periodic import SuffixArray, collapse_runs, found_in, smaller_before
from docgraph.llm.queries import op13_periodic_runs
from tests.llm.helpers import documents, sentence


def runs_of(words):
    """Every maximal stretch with a period, by trying all periods; the smallest period of each stretch counts."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j + q - i >= max(6, 4 * q):
                found.setdefault((i, j + q), q)
            i = max(j, i + 1)
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {k for s, length, q in runs for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def told(found):
    return [(r["start"], r["length"], r["period"]) for r in found["runs"]]


def some_text(rng):
    letters = rng.randrange(1, 4)
    words = [rng.randrange(letters) for _ in range(rng.randrange(0, 60))]
    if rng.random() < 0.6:
        period = [rng.randrange(3) for _ in range(rng.randrange(1, 7))]
        words[5:5] = period * rng.randrange(1, 9) + period[: rng.randrange(0, 3)]
    return rng.choice([" ", "\n", "\t \v"]).join(map(str, words))


@pytest.mark.parametrize("seed", range(4))
def test_slices_of_texts_equal_the_definition(seed):
    rng = random.Random(seed)
    for _ in range(250):
        texts = [some_text(rng) for _ in range(rng.randrange(1, 5))]
        for text, found in zip(texts, found_in(pa.array(texts))):
            words = split(text)
            assert told(found) == runs_of(words) and found["n_words"] == len(words)
            assert found["collapsed"] == collapsed(words, runs_of(words))


def test_edges():
    texts = [None, "", " \n ", "a", "a a a a a", "a a a a a a", "ä " * 7, "a b " * 4, "a b a b a b a", "x y " * 3 + "x", "a" * 10_000, "q " * 50_000]
    found = found_in(pa.array(texts, pa.string()))
    assert [told(f) for f in found] == [runs_of(split(t)) for t in texts[:-1]] + [[(0, 50_000, 1)]]
    assert [f["collapsed"] for f in found[:5]] == ["", "", "", "a", "a a a a a"] and found[5]["collapsed"] == "a" and found[-1]["collapsed"] == "q"
    assert found_in(pa.array([], pa.string())) == []


def test_equal_rows_and_words_that_differ_by_bytes_only(spark):
    texts = ["a a a a a a b", "a a a a a a b", "A a A a a A a a", "é é " * 4]
    docs = documents(spark, [(1, t) for t in texts] + [(None, texts[0])])
    rows = collapse_runs(docs).select("doc_id", "text", "runs", "collapsed", "score").collect()
    assert len(rows) == 5
    for row in rows:
        assert [tuple(r) for r in row.runs] == runs_of(split(row.text)) and row.collapsed == collapsed(split(row.text), runs_of(split(row.text)))
    assert collapse_runs(documents(spark, [])).count() == 0


def test_query_equals_the_definition(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice([None, "", some_text(rng), sentence(rng, 200, 30), sentence(rng, 7)])) for i in range(-20, 220)]
    rows += [(None, "b b b b b b b")]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: tuple(r) for r in op13_periodic_runs(spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        words = split(text)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k if k < a else a + (k - a) % p] for k in range(n)]
        runs = runs_of(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None,) * 3
        digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
        exponent = 1000 * best[1] // best[2] if runs else None
        assert got[i] == (i, len(runs), *best, exponent, digest("".join("%d,%d,%d\n" % r for r in runs)), digest(collapsed(words, runs)))


def test_suffix_array_and_common_prefixes():
    rng = random.Random(6)
    words = np.array([rng.randrange(3) for _ in range(300)])
    rows = np.sort(np.array([rng.randrange(4) for _ in range(300)]))
    suffixes = SuffixArray(words, rows)
    tail = lambda i: [(int(rows[i]), int(w)) for w, r in zip(words[i:], rows[i:]) if r == rows[i]]
    # What follows the end of a row is the next row, which is larger.
    assert suffixes.order.tolist() == sorted(range(300), key=lambda i: list(zip(rows[i:].tolist(), words[i:].tolist())))
    a, b = np.array([rng.sample(range(300), 2) for _ in range(500)]).T
    shared = [next((k for k, (x, y) in enumerate(zip(tail(i), tail(j))) if x != y), min(len(tail(i)), len(tail(j)))) for i, j in zip(a, b)]
    assert suffixes.common_prefix(a, b).tolist() == shared
    values = np.array([-1] + [rng.randrange(6) for _ in range(200)] + [-1])
    plain = [max((k for k in range(i) if values[k] < values[i]), default=0) for i in range(len(values))]
    assert np.array_equal(np.where(values > -1, smaller_before(values), 0), np.where(values > -1, plain, 0))
