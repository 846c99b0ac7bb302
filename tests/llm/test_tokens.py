"""Token ids, packing and token counts against the tokenizer itself."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyarrow import fs
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from docgraph.llm import packing, token_counts, tokens
from docgraph.llm.files import open_store
from docgraph.plans.scratch import scratch_path
from tests.llm.helpers import documents, sentence

PATH = public_tokenizers.path("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_file(PATH)

ODD = [
    "it's 12½ ²x don't WE'LL",
    "a<|endoftext|>b <|startoftext|> ",
    "ΣΑΣ ΟΔΟΣ İstanbul ŒUVRE ǅ ﬁ",
    "a\x1cb\x85c\xa0d e　f",
    "éa ́x",
    "日本語 テキスト",
    "\x00\x01 \x7f \x01\x02",
    "",
    None,
    " \n\t",
    "ẞß",
]


def ids(text, specials_are_text=False):
    TOKENIZER.encode_special_tokens = specials_are_text
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def ranks():
    return tokens.ranked_merges(PATH)


def texts():
    rng = random.Random(6)
    signs = [chr(c) for c in [*range(0, 0x250), *range(0x300, 0x330), 0x3A3, 0x4E00, 0x2028]] + [" "] * 150
    return ODD + ["".join(rng.choice(signs) for _ in range(rng.randrange(200))) for _ in range(150)] + [sentence(rng, 100) for _ in range(20)]


@pytest.mark.parametrize("short_way", [True, False])
@pytest.mark.parametrize("specials_are_text", [True, False])
def test_ids_equal_the_tokenizer(monkeypatch, ranks, short_way, specials_are_text):
    monkeypatch.setattr(tokens, "MOST_WORDS", 1000)  # the cache is emptied on the way
    encoder = tokens.WordEncoder(PATH, ranks if short_way else None, specials_are_text)
    rows = texts()
    for _ in range(2):
        for first in range(0, len(rows), 10):
            part = rows[first : first + 10]
            found, offsets = encoder.encode(pa.array(part, pa.string()))
            for k, text in enumerate(part):
                assert found[offsets[k] : offsets[k + 1]].tolist() == ids(text, specials_are_text), ascii(text)


def test_a_text_with_more_words_than_the_cache(monkeypatch, ranks):
    monkeypatch.setattr(tokens, "MOST_WORDS", 50)
    encoder = tokens.WordEncoder(PATH, ranks, False)
    long = sentence(random.Random(2), 2000)
    for text in (long, "short one", long, None):
        assert encoder.encode(pa.array([text], pa.string()))[0].tolist() == ids(text)


def test_the_vocabulary_may_be_merged_by_rank(ranks):
    assert ranks is not None and len(ranks) > 49_000
    assert tokens.ranked_merges(public_tokenizers.path("byte_bpe_50k.json")) is None  # no end-of-word mark


@pytest.mark.parametrize("cut", [True, False])
def test_windows_hold_every_token_once(cut):
    rng = random.Random(7)
    for _ in range(60):
        capacity = rng.choice([8, 64, 100, 4096])
        sizes = [rng.choice([1, rng.randrange(1, capacity + 1), rng.randrange(1, 5 * capacity)]) for _ in range(rng.randrange(0, 60))]
        windows = packing.pack(sizes, capacity, cut)
        held = [sum(p[2] for p in w) for w in windows]
        assert all(0 < h <= capacity for h in held)
        pieces = sorted(p for w in windows for p in w)
        for doc, size in enumerate(sizes):
            own = [p for p in pieces if p[0] == doc]
            assert [p[1] for p in own] == list(np.cumsum([0] + [p[2] for p in own[:-1]])) and sum(p[2] for p in own) == size
        if cut:  # nothing is padded: windows are full or hold a power of two
            assert all(h == capacity or h & (h - 1) == 0 for h in held)
        elif all(s <= capacity for s in sizes):
            assert len(pieces) == len(sizes)


def test_differencing_gives_near_equal_sums():
    rng = random.Random(9)
    for count in (2, 5, 17):
        sizes = [rng.randrange(1, 3000) for _ in range(40 * count)]
        parts = packing.difference_partition(sizes, count)
        sums = [sum(sizes[k] for k in part) for part in parts]
        assert sorted(k for part in parts for k in part) == list(range(len(sizes)))
        assert max(sums) - min(sums) <= 0.002 * sum(sums) / count
    # The well-known example: 8 against 7 leaves 1, 6 against 5 leaves 1, 4 against 1 leaves 3, 3 against 1 leaves 2.
    assert packing.difference_partition([8, 7, 6, 5, 4], 2) == [[1, 3, 4], [0, 2]]
    assert packing.difference_partition([], 3) == [[], [], []]


def test_differenced_windows_stay_and_few_documents_are_cut():
    rng = random.Random(11)
    sizes = [rng.randrange(20, 900) for _ in range(600)]
    windows, left = packing.pack_group([(k, 0, n) for k, n in enumerate(sizes)], [], 4096)
    assert len(windows) == sum(sizes) // 4096 and all(sum(p[2] for p in w) == 4096 for w in windows)
    assert sum(p[2] for p in left) == sum(sizes) % 4096
    cut = {p[0] for w in windows for p in w if p[2] < sizes[p[0]]}
    assert len(cut) <= 12  # pieces of about a 64th of the tokens, where plain filling cuts a document per window
    # Where the number of windows has to rise, the emptiest close the gaps of the others.
    windows, left = packing.pack_group([(k, 0, n) for k, n in enumerate([2100, 2100, 2100, 2100])], [], 4096)
    assert [sum(p[2] for p in w) for w in windows] == [4096, 4096] and sum(p[2] for p in left) == 208
    assert packing.pack_group([(0, 0, 5)], [(1, 3, 4)], 4096) == ([], [(1, 3, 4), (0, 0, 5)])
    assert packing.pack_group([], [], 4096) == ([], [])


def test_only_the_rest_of_a_task_is_short(spark):
    rng = random.Random(12)
    rows = [(k, sentence(rng, rng.randrange(1, 400))) for k in range(3000)]
    found = packing.pack_documents(documents(spark, rows).coalesce(1), PATH)
    lengths = sorted(r[1] for r in found.groupBy("sequence_id").agg({"length": "sum"}).collect())
    short = [n for n in lengths if n < 4096]
    assert len(lengths) > 2 * packing.GROUP_WINDOWS and sum(short) < 4096 and len(short) == len(set(short))


def test_packing_round_trip(spark):
    rng = random.Random(10)
    long = sentence(rng, 30_000)
    rows = [(k, t) for k, t in enumerate(texts())] + [(500, long), (500, long), (None, "no id"), (501, None)]
    found = packing.pack_documents(documents(spark, rows), PATH).collect()
    want = {}
    for doc, text in rows:
        want.setdefault(doc, []).append(np.array(ids(text) + [2], "<u4"))
    by_sequence = {}
    for r in found:
        by_sequence.setdefault(r.sequence_id, []).append(r)
        own = want[r.doc_id][0]
        assert r.doc_tokens == len(own) and r.ids_crc32 == zlib.crc32(own[r.start : r.start + r.length].tobytes())
    for doc, copies in want.items():
        spans = sorted((r.start, r.length) for r in found if r.doc_id == doc)
        assert sum(n for _, n in spans) == len(copies) * len(copies[0])
        covered = np.zeros(len(copies[0]), int)
        for start, n in spans:
            covered[start : start + n] += 1
        assert (covered == len(copies)).all()
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        total = 0
        for r in pieces:
            assert r.offset == total
            total += r.length
        assert total == 4096 or total < 4096 and total & (total - 1) == 0
    assert packing.pack_documents(documents(spark, []), PATH).collect() == []


@pytest.mark.parametrize("block_bytes", [token_counts.BLOCK_BYTES, 64, 7])
def test_counts_equal_the_tokenizer(spark, block_bytes):
    """Also with blocks shorter than documents, and cut to whole numbers."""
    rows = [(k, t) for k, t in enumerate(texts()[:60])] + [(3, ODD[3]), (None, "no id"), (77, sentence(random.Random(1), 500))]
    found = token_counts.token_counts(documents(spark, rows), PATH, 49407, block_bytes=block_bytes).collect()
    assert sorted(((r.doc_id, r.n_tokens) for r in found), key=str) == sorted(((d, len(ids(t, True))) for d, t in rows), key=str)


def test_counts_of_empty_tables(spark):
    assert token_counts.token_counts(documents(spark, []), PATH, 49407).collect() == []


@pytest.mark.parametrize("width", [2, 4])
def test_scan_of_foreign_files(spark, width):
    """Files without a final separator, with empty documents, without any separator, empty, and cut off."""
    end, kind = 9, token_counts.WIDTHS[width]
    files = {
        "tail": [1, 2, 9, 9, 3, 9, 4],
        "none": [1, 2, 3],
        "empty": [],
        "only": [9],
        "long": [*range(10, 500), 9] * 3 + [5] * 1000 + [9],
    }
    folder = scratch_path(spark, "foreign")
    system, root = open_store(folder)
    system.create_dir(root, recursive=True)
    sizes = []
    for name, numbers in files.items():
        data = np.array(numbers, kind).tobytes() + b"\x09" * (name == "tail")
        with system.open_output_stream(f"{root}/{name}", compression=None) as out:
            out.write(data)
        sizes.append((name, len(data)))
    want = []
    for name, numbers in files.items():
        start = 0
        ends = [k for k, x in enumerate(numbers) if x == end]
        for ordinal, at in enumerate(ends):
            want.append((name, ordinal, start, at - start, True))
            start = at + 1
        if start < len(numbers):
            want.append((name, len(ends), start, len(numbers) - start, False))
    frame = spark.createDataFrame(sizes, "file string, bytes bigint")
    for block_bytes in (1 << 20, 16, 4):
        found = token_counts.scan_token_files(folder, frame, end, width, block_bytes)
        assert sorted(tuple(r) for r in found.collect()) == sorted(want)
    assert system.get_file_info(fs.FileSelector(root)) and found.filter(F.col("n_tokens") < 0).count() == 0
