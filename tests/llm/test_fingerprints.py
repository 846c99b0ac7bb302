"""Fingerprints against a plain computation, edited texts, and the block tables against comparing all pairs."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import struct

import xxhash
from pyspark.sql import functions as F

from docgraph.llm.fingerprints import CHUNK, MOST_VOTES, digits, document_fingerprints, fingerprints, likeness, near_fingerprints, with_near_counts
from docgraph.llm.queries import op12_fingerprints
from tests.llm.helpers import documents, sentence


def term_hash(term: str, seed: int) -> int:
    first = xxhash.xxh64(struct.pack("<i", seed), seed=42).intdigest()
    return xxhash.xxh64(term.encode(), seed=first).intdigest()


def simhash(text: str | None) -> str:
    words = set(re.findall(r"[^\x20\x09-\x0D]+", text or "")) or {""}
    out = ""
    for seed in (0, 1):
        word = 0
        for bit in range(64):
            votes = sum(max(1, min(len(w), MOST_VOTES)) * (1 if term_hash(w, seed) >> bit & 1 else -1) for w in words)
            word |= (votes >= 0) << bit
        out += f"{word:016x}"
    return out


def alike(a: str, b: str) -> float:
    return 1 - (int(a, 16) ^ int(b, 16)).bit_count() / 128


def edited(rows):
    """{doc_id: (text, edited text, next text)} for distinct ids."""
    rows = sorted(rows, key=lambda r: -r[0])
    texts = [t or "" for _, t in rows]
    out = {}
    for k, (i, _) in enumerate(rows):
        half, following = len(texts[k]) // 2, texts[(k + 1) % len(rows)]
        out[i] = texts[k], texts[k][: len(texts[k]) - half] + following[:half], following
    return out


def test_query_equals_plain_computation(spark, tmp_path):
    rng = random.Random(5)
    texts = [None, "", "  \t\n ", "a", "é", "zwölf große Bären", "x" * 5000, sentence(rng, 3 * CHUNK, 10**6), sentence(rng, 50), "same text here", "same text here"]
    texts += [sentence(rng, rng.randrange(1, 60)) for _ in range(50)]
    rows = [(i * 7 - 20, t) for i, t in enumerate(texts)]
    documents(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in op12_fingerprints(spark, str(tmp_path)).collect()}
    expected = edited(rows)
    assert len(got) == len(rows)
    prints = {t: simhash(t) for own in expected.values() for t in own}
    for i, (text, new, following) in expected.items():
        row = got[i]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (prints[text], prints[new])
        assert (row.near_edited, row.near_next) == (alike(prints[text], prints[new]), alike(prints[text], prints[following]))
        near = sum(alike(prints[text], prints[own[0]]) >= 1 - 3 / 128 for own in expected.values()) - 1
        assert row.near_docs == (near if i % 20 == 0 else None)


def test_ring_over_many_pieces(spark):
    rows = [(i, f"text number {i}") for i in range(0, 3000, 3)]
    found = {r.doc_id: r.edited_sha256 for r in document_fingerprints(documents(spark, rows)).collect()}
    assert found == {i: hashlib.sha256(new.encode()).hexdigest() for i, (_, new, _) in edited(rows).items()}


def test_empty_single_null_and_repeated_ids(spark):
    assert document_fingerprints(documents(spark, [])).count() == 0
    only = document_fingerprints(documents(spark, [(4, "abcd")])).first()
    assert only.simhash == only.following and only.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    rows = [(None, "null id"), (3, "first of two"), (3, "second of two"), (3, "second of two"), (9, "nine")]
    found = document_fingerprints(documents(spark, rows)).select("doc_id", digits("simhash").alias("f"), digits("following").alias("g")).collect()
    assert sorted(r.f for r in found) == sorted(simhash(t) for _, t in rows)
    after = {r.f: r.g for r in found}
    assert after[simhash("first of two")] == after[simhash("second of two")] == simhash("null id")
    assert after[simhash("null id")] == simhash("nine")
    assert after[simhash("nine")] in {simhash("first of two"), simhash("second of two")}


def test_block_tables_find_all_within_the_radius(spark):
    rng = random.Random(3)
    centres = [rng.getrandbits(128) for _ in range(12)]
    values = set()
    for centre in centres:
        for _ in range(25):
            flipped = centre
            for bit in rng.sample(range(128), rng.randrange(0, 7)):
                flipped ^= 1 << bit
            values.add(flipped)
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    pair = lambda x: [signed(x & (2**64 - 1)), signed(x >> 64)]
    data = spark.createDataFrame([(pair(v),) for v in values for _ in range(2)], "simhash array<bigint>")
    for radius, spare in ((3, 1), (5, 2), (1, 1)):
        got = [(tuple(r.query), tuple(r.found), r.distance) for r in near_fingerprints(data, data, radius, spare).collect()]
        expected = {(tuple(pair(a)), tuple(pair(b)), (a ^ b).bit_count()) for a, b in itertools.product(values, values) if (a ^ b).bit_count() <= radius}
        assert len(got) == len(set(got)) and set(got) == expected


def test_near_counts_leave_nulls_to_others(spark):
    data = spark.createDataFrame([(1, [5, 0]), (2, [7, 0]), (3, [5, 0]), (None, [-1, 9])], "doc_id bigint, simhash array<bigint>")
    found = {r.doc_id: r.near_docs for r in with_near_counts(data, F.col("doc_id") % 2 == 1).collect()}
    assert found == {1: 2, 2: None, 3: 2, None: None}


def test_no_python_and_equal_texts(spark):
    docs = documents(spark, [(1, "one two three"), (2, "one two three"), (3, "four five")])
    found = document_fingerprints(docs)
    assert "Python" not in found._jdf.queryExecution().toString() and "Arrow" not in found._jdf.queryExecution().toString()
    rows = {r.doc_id: r for r in found.select("doc_id", "simhash", likeness("simhash", "following").alias("n")).collect()}
    assert rows[1].simhash == rows[2].simhash != rows[3].simhash and rows[2].n == 1.0
    assert fingerprints(docs, ["doc_id"], "text").count() == 3
