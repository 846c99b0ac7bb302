"""Term counts and divergences against plain Python."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

import docgraph.llm.divergence as divergence
from docgraph.llm.divergence import count_terms, packed, radix_order, source_divergence
from docgraph.llm.queries import op11_source_divergence

DOCS = "doc_id bigint, text string, lang string, source string, term string, value bigint, rank int, part string, share bigint, place string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, "x", 1, 2, "y", 3, "z") for i, (t, lang, source) in enumerate(rows)], DOCS).repartition(3)


def terms_of(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, least_docs=10, top=10):
    docs, counts, groups = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        own = terms_of(text)
        docs[lang or ""].update(set(own))
        counts[lang or "", source or ""].update(own)
        groups[lang or ""].add(source or "")
    out = set()
    for lang, sources in groups.items():
        kept = {t for t, n in docs[lang].items() if n >= least_docs}
        total = Counter()
        for s in sources:
            total.update({t: n for t, n in counts[lang, s].items() if t in kept})

        def shares(own):
            n = sum(own[t] for t in kept)
            return {t: 1 + 10**9 * (own[t] + 2) // (n + 2 * len(kept)) for t in kept}

        apart = lambda p, q: (p - q) ** 2 // (p + q)
        p, q = {s: shares(counts[lang, s]) for s in sources}, shares(total)
        for s in sources:
            pairs = [(o, sum(apart(p[s][t], p[o][t]) for t in kept)) for o in sources if o != s]
            terms = [(t, apart(p[s][t], q[t])) for t in kept if counts[lang, s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                out |= {(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)}
    return out


def result(df):
    return {(r.lang, r.source, r.part, r.item, r.value, r["rank"]) for r in df.collect()}


def corpus(rng, n, languages=("en", "de", None), sources=("a", "b", "c", None)):
    words = ["The", "of", "ÄRGER", "naïve", "日本語", "x", "abcdefgh", "abcdefghi", "sixteenletterswd", "seventeenletters1x", "seventeenlettersx", "Donaudampfschifffahrtsgesellschaft"]
    words += [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)]
    for _ in range(n):
        text = rng.choice([" ", "\n", "-", "1"]).join(rng.choice(words) for _ in range(rng.randrange(0, 40)))
        yield (text if rng.random() > 0.05 else None), rng.choice(languages), rng.choice(sources)


def test_query_equals_plain_computation(spark, tmp_path):
    rng = random.Random(2)
    rows = list(corpus(rng, 300)) + [("only one here", "xx", "solo"), (None, "yy", "p"), ("", "yy", "q"), ("y" * 100_000, "en", "a")]
    frame(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    found = result(op11_source_divergence(spark, str(tmp_path)))
    assert found == plain(rows)
    assert {("yy", "p", "pair", "q", 0, 1), ("yy", "q", "pair", "p", 0, 1)} <= found
    assert not any(r[1] == "solo" for r in found)


def test_blocks_and_tiles(spark, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK_TERMS", 7)
    monkeypatch.setattr(divergence, "TILE", 3)
    rows = list(corpus(random.Random(4), 200, ("en", "de"), tuple("abcdefgh")))
    assert result(source_divergence(frame(spark, rows), 3, 4)) == plain(rows, 3, 4)


def test_large_counts_stay_exact(spark):
    for count, total, kept in ((10**12, 10**14, 50_000), (7, 8_999_999_999_999_000, 3), (0, 0, 1)):
        got = spark.range(1).select(divergence.share(f"{count}L", f"{total}L", f"{kept}L").alias("p")).first().p
        assert got == 1 + 10**9 * (count + 2) // (total + 2 * kept)


def test_no_rows_and_repeated_rows(spark):
    assert source_divergence(frame(spark, [])).count() == 0
    rows = [("same words", "en", s) for s in "ab" for _ in range(6)]
    assert result(source_divergence(frame(spark, rows))) == plain(rows)


@pytest.mark.parametrize("seed", range(5))
def test_counts_of_a_slice(seed):
    rng = random.Random(seed)
    rows = list(corpus(rng, 40))
    groups = np.array([rng.randrange(3) for _ in rows], np.uint32)
    found = {}
    for group, terms, times, docs in count_terms(pa.array([t for t, _, _ in rows], pa.string()), groups):
        found |= {(g, t.decode()): (n, d) for g, t, n, d in zip(group.tolist(), terms, times.tolist(), docs.tolist())}
    times, docs = Counter(), Counter()
    for (text, _, _), g in zip(rows, groups.tolist()):
        times.update((g, t) for t in terms_of(text))
        docs.update((g, t) for t in set(terms_of(text)))
    assert found == {k: (n, docs[k]) for k, n in times.items()}


def test_packing_keeps_the_order_of_bytes():
    terms = [b"a", b"ab", b"abcdefgh", b"b", b"\xff\xfe", b"zzzzzzzz"]
    raw = np.frombuffer(b"".join(terms), np.uint8)
    lengths = np.array([len(t) for t in terms])
    (words,) = packed(raw, np.cumsum(lengths) - lengths, lengths, 1)
    assert words.tolist() == [int.from_bytes(t.ljust(8, b"\0"), "big") for t in terms]
    keys = np.array([5, 1 << 40, 3, 1 << 63, 70_000], np.uint64)
    assert radix_order([keys]).tolist() == np.argsort(keys, kind="stable").tolist()
