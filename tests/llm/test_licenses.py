from __future__ import annotations

import random
import re

import numpy as np

from docgraph.llm import licenses
from docgraph.llm.license_texts import TEMPLATES
from tests.llm.helpers import documents, sentence


def words(text):
    return re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


def longest_common(a, b):
    best = [0] * (len(b) + 1)
    for x in a:
        row = [0]
        for j, y in enumerate(b):
            row.append(best[j] + 1 if x == y else max(best[j + 1], row[-1]))
        best = row
    return best[-1]


def scan(spark, rows, templates=TEMPLATES, coverage=licenses.COVERAGE):
    frame = spark.createDataFrame([(k, v) for k, v in templates.items()], "template_id string, text string")
    return licenses.scan_licenses(documents(spark, rows), frame, coverage, into="found").collect()


def test_finds_every_template_with_edits_and_spans(spark):
    rng = random.Random(1)
    rows, want = [], {}
    for k, (name, text) in enumerate(TEMPLATES.items()):
        before, after = sentence(rng, 50), sentence(rng, 50)
        rows.append((k, f"{before} é {text} {after}"))
        want[k] = (name, f"{before} é ".__len__(), len(f"{before} é {text}".rstrip('.')))
        parts = text.split()
        if len(parts) > 30:
            for e in range(0, len(parts), 15):
                parts[e] = "changed"
            rows.append((100 + k, f"{before}\n{' '.join(parts)}\n{after}"))
    rows += [(200, sentence(rng, 500)), (201, ""), (202, None), (203, "Licensed under the"), (204, sentence(rng, 200_000))]
    found = {r.doc_id: r.found for r in scan(spark, rows)}
    for k, (name, start, end) in want.items():
        match = [m for m in found[k] if m.template_id == name]
        assert len(match) == 1 and match[0].coverage == 1.0 and (match[0].start, match[0].end) == (start, end)
    for k, (name, text) in enumerate(TEMPLATES.items()):
        if 100 + k in found:
            (match,) = [m for m in found[100 + k] if m.template_id == name]
            assert 0.8 <= match.coverage < 1.0
            assert match.matched_words == longest_common(words(text), words(dict(rows)[100 + k]))
    assert all(found[k] == [] for k in (200, 201, 202, 203, 204))


def test_repeats_ties_and_empty_tables(spark):
    line = TEMPLATES["MIT reference"]
    rows = [(1, f"{line} {line}\nx {line}"), (2, line), (2, line), (None, line)]
    found = sorted((str(r.doc_id), len(r.found)) for r in scan(spark, rows, {"a": line, "b": line}))
    assert found == [("1", 6), ("2", 2), ("2", 2), ("None", 2)]
    assert scan(spark, []) == []
    assert all(r.found == [] for r in scan(spark, rows, {}))
    frame = spark.createDataFrame([(None, line), ("short", "MIT"), ("null", None)], "template_id string, text string")
    assert all(r.found == [] for r in licenses.scan_licenses(documents(spark, rows), frame, into="found").collect())


def test_several_blocks_give_the_same(spark, monkeypatch):
    rows = [(k, f"before {text} after") for k, text in enumerate(TEMPLATES.values())]
    whole = {r.doc_id: sorted(map(tuple, r.found)) for r in scan(spark, rows)}
    monkeypatch.setattr(licenses, "BLOCK_BYTES", 700)
    assert {r.doc_id: sorted(map(tuple, r.found)) for r in scan(spark, rows)} == whole


def test_shared_runs_share_a_fingerprint():
    rng = np.random.default_rng(4)
    for _ in range(200):
        run = rng.integers(1 << 60, size=licenses.SHINGLE + licenses.WINNOW - 1).astype(np.uint64)
        marks = []
        for _ in range(2):
            before, after = (rng.integers(1 << 60, size=rng.integers(0, 6)).astype(np.uint64) for _ in range(2))
            text = np.concatenate([before, run, after])
            marks.append(set(licenses.fingerprints(text, np.array([0, len(text)]))[0].tolist()))
        assert marks[0] & marks[1]


def test_every_template_with_each_word_changed_or_left_out():
    """Texts within the coverage are found wherever the change stands, also those of a few words."""
    short = {"three": "All rights reserved.", "ten": "a1 b2 c3 d4 e5 f6 g7 h8 i9 j10"}
    short |= {name: text for name, text in TEMPLATES.items() if len(words(text)) <= 20}
    names, texts = zip(*short.items())
    index = licenses.Templates(list(names), list(texts))
    for name, text in zip(names, texts):
        own = words(text)
        changed = [own, *(own[:k] + ["changed"] + own[k + 1 :] for k in range(len(own))), *(own[:k] + own[k + 1 :] for k in range(len(own)))]
        changed += [own[:i] + ["one"] + own[i + 1 : k] + ["two"] + own[k + 1 :] for i in range(min(12, len(own))) for k in range(i + 1, min(12, len(own)))]
        changed = [c for c in changed if longest_common(own, c) >= licenses.COVERAGE * len(own)]
        for around in ("x1 y2", "p q r s"):
            found = licenses.matches(index, licenses.pa.array([f"{around} {' '.join(c)} {around}" for c in changed]), licenses.COVERAGE)
            for c, hits in zip(changed, found):
                assert longest_common(own, c) in [m[2] for m in hits if m[0] == name], (name, c)


def test_run_left():
    for length in range(3, 60):
        equal = -(-8 * length // 10)
        assert licenses.run_left(length, 0.8) == -(-equal // (length - equal + 1))


def test_whole_texts_and_common_families():
    """Matches of complete licenses reach to their last clause, and the common families are told."""
    index = licenses.Templates(list(TEMPLATES), list(TEMPLATES.values()))
    ends = {"MIT": "OTHER DEALINGS IN THE SOFTWARE", "ISC": "PERFORMANCE OF THIS SOFTWARE", "GPL-3.0 notice": "If not, see <https://www.gnu.org/licenses"}
    for name, end in ends.items():
        text = f"before {TEMPLATES[name]}. after"
        (hit,) = [m for m in licenses.matches(index, licenses.pa.array([text]), licenses.COVERAGE)[0] if m[0] == name]
        assert hit[1] == 1.0 and text[hit[3] : hit[4]].endswith(end)
    lines = {
        "BSD-2-Clause": TEMPLATES["BSD-2-Clause"],
        "BSD-3-Clause": TEMPLATES["BSD-3-Clause"].replace("the copyright holder nor", "the University nor"),
        "MPL-2.0 notice": "subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "LGPL-2.1 notice": TEMPLATES["LGPL-2.1 notice"],
        "AGPL-3.0 notice": TEMPLATES["AGPL-3.0 notice"],
        "Apache-2.0 heading": "Apache License\n Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION\n 1. Definitions.",
        "GPL-3.0 heading": "GNU GENERAL PUBLIC LICENSE\n Version 3, 29 June 2007\n\n Copyright",
        "CC0-1.0 heading": "Creative Commons Legal Code\n\nCC0 1.0 Universal\n",
        "CC-BY-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "CC-BY-SA-4.0 notice": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "All rights reserved": "Copyright 2020 Example. All rights reserved.",
    }
    found = licenses.matches(index, licenses.pa.array([f"one two {t} three four" for t in lines.values()]), licenses.COVERAGE)
    assert [name for name, hits in zip(lines, found) if name not in [m[0] for m in hits]] == []


def test_no_other_template_than_the_one_that_stands_there(spark):
    """Every template alone in a text, and the one-line references with words around: nothing else is found."""
    rows = [(k, f"before {text} after") for k, text in enumerate(TEMPLATES.values())]
    found = {r.doc_id: [m.template_id for m in r.found] for r in scan(spark, rows)}
    assert found == {k: [name] for k, name in enumerate(TEMPLATES)}


def test_repeats_right_behind_each_other(spark):
    line = "All rights reserved."
    (name,) = [k for k, text in TEMPLATES.items() if text == line]
    found = {r.doc_id: [(m.template_id, m.coverage) for m in r.found] for r in scan(spark, [(n, " ".join([line] * n)) for n in (1, 2, 5)])}
    assert found == {n: [(name, 1.0)] * n for n in (1, 2, 5)}


def test_inserted_words_cost():
    assert licenses.tightened(np.array([7, 1, 7, 2, 3]), [0, 3, 4]) == [2, 3, 4]
    near, far, other = ("a", 0.9, 9, 0, 10), ("b", 1.0, 5, 4, 9), ("c", 1.0, 5, 12, 17)
    assert licenses.best_apart([far, near, other, near]) == [near, other]
