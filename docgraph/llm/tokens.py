"""Token ids of whole texts by a public tokenizer, with a cache of words.

Texts of most corpora repeat their words, and the tokenizers used here never join characters across white space. So a text is
cut at ASCII white space, known words are looked up, and only new words go to the tokenizer. The cache is bounded; a full one is emptied.

New words of common scripts take a shorter way to the same ids: the tokenizer's own rule for parting words, then byte pair merging
by rank. That is valid only if merging by rank never makes a merge that the vocabulary doesn't list; ``ranked_merges`` proves it
for a vocabulary (on the driver, once) and gives None otherwise, and then the tokenizer itself encodes all new words.
"""

from __future__ import annotations

import json

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from tokenizers import Tokenizer

from docgraph.llm.text import U, column_bytes, span_hashes, word_spans

# Words remembered by one Python worker (some 70 bytes each).
MOST_WORDS = 1_000_000

# Below U+0250 a character is its own normal form and has a lower case that does not depend on its neighbours.
_COMMON = regex.compile("[\0\x02-\u024f]*")
_END = b"\x01"  # stands for the end-of-word mark; words that hold it go to the tokenizer itself


def _byte_of_sign() -> dict[str, int]:
    """The signs by which byte-level vocabularies show bytes: printable ones as themselves, the others from U+0100 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


def ranked_merges(path: str) -> dict[bytes, int] | None:
    """Token bytes to ids, if encoding by rank equals the listed merges, else None.

    By induction over the tokens: if for every token merging by rank of its bytes alone ends with the merge that the vocabulary
    lists for it, then no unlisted merge can happen in any word, as merges within a token's span go the same way there.
    """
    model = json.load(open(path, encoding="utf-8"))["model"]
    vocabulary, signs, suffix = model["vocab"], _byte_of_sign(), model.get("end_of_word_suffix") or ""
    if not suffix:
        return None

    def as_bytes(token: str) -> bytes:
        ends = token.endswith(suffix)
        return bytes(signs[c] for c in (token[: -len(suffix)] if ends else token)) + _END * ends

    ranks, listed = {}, {}
    for pair in model["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        one, two = as_bytes(left), as_bytes(right)
        if one + two in listed:
            return None
        listed[one + two] = (one, two)
        ranks[one + two] = vocabulary[left + right]
    if list(ranks.values()) != sorted(ranks.values()):
        return None
    for sign, byte in signs.items():
        if sign not in vocabulary or sign + suffix not in vocabulary:
            return None
        ranks[bytes([byte])] = vocabulary[sign]
        # The end-of-word mark first joins the last byte.
        ranks[bytes([byte]) + _END] = vocabulary[sign + suffix]
    if max(ranks[bytes([b]) + _END] for b in range(256)) > min(ranks[t] for t in listed):
        return None
    for token, pair in listed.items():
        parts, last = [token[k : k + 1] for k in range(len(token))], None
        while len(parts) > 1:
            found = [ranks.get(parts[k] + parts[k + 1], 1 << 40) for k in range(len(parts) - 1)]
            at = found.index(min(found))
            if found[at] == 1 << 40:
                return None
            last = (parts[at], parts[at + 1])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        if last != pair:
            return None
    return ranks


class WordTable:
    """Word hashes to numbers 0, 1, 2, ...: an open-addressing table that looks up and adds many words at once."""

    def __init__(self, most: int):
        self.mask = U((1 << (2 * most - 1).bit_length()) - 1)
        self.keys = np.zeros(int(self.mask) + 1, U)
        self.numbers = np.zeros(int(self.mask) + 1, np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each word, -1 for unknown ones."""
        slot = hashes & self.mask
        there = self.keys[slot]
        out = np.where(there == hashes, self.numbers[slot], -1)
        left = np.flatnonzero((there != hashes) & (there != 0))
        while len(left):
            slot[left] = (slot[left] + U(1)) & self.mask
            there = self.keys[slot[left]]
            same = there == hashes[left]
            out[left[same]] = self.numbers[slot[left[same]]]
            left = left[~same & (there != 0)]
        return out

    def add(self, hashes: np.ndarray, first: int) -> None:
        """New, distinct words get the numbers from ``first`` on."""
        numbers = np.arange(first, first + len(hashes), dtype=np.int32)
        slot = hashes & self.mask
        while len(hashes):
            free = self.keys[slot] == 0
            self.keys[slot[free]] = hashes[free]  # of several for one slot the last one stays
            lost = self.keys[slot] != hashes
            self.numbers[slot[~lost]] = numbers[~lost]
            hashes, numbers, slot = hashes[lost], numbers[lost], (slot[lost] + U(1)) & self.mask


class WordEncoder:
    """Ids of texts without special tokens; made once for each Python worker by ``encoder_for``.

    Words are known by a 64-bit hash of their bytes.
    """

    def __init__(self, path: str, ranks: dict[bytes, int] | None, specials_are_text: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_are_text
        self.marked = [] if specials_are_text else [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.rule = None
        if ranks is not None:
            self.rule = regex.compile(json.load(open(path, encoding="utf-8"))["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
            # Each piece ends with the mark, and a space, which is a piece of its own, ends each word. Other white space is passed over.
            self.merger = tiktoken.Encoding("ranked", pat_str=r" |[^\x01\s]+\x01", mergeable_ranks=ranks, special_tokens={})
            self.space = ranks[b" "]
        self._forget(MOST_WORDS)

    def _forget(self, most: int) -> None:
        self.most, self.table, self.count = most, WordTable(most), 0
        self.starts, self.lengths = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids = np.zeros(0, np.uint32)

    def _learn(self, hashes: np.ndarray, words: list[bytes]) -> None:
        joined = (b" ".join(words) + b" ").decode()
        easy = np.full(len(words), self.rule is not None)
        if self.rule is not None and (not _COMMON.fullmatch(joined) or any(m in joined for m in self.marked)):
            easy[:] = [bool(_COMMON.fullmatch(w)) and not any(m in w for m in self.marked) for w in joined.split(" ")[:-1]]
            joined = "".join([f"{w.decode()} " for w, e in zip(words, easy.tolist()) if e])
        if easy.any():
            ids = np.array(self.merger.encode_ordinary(self.rule.sub("\\g<0>\x01", joined.lower())), np.uint32)
            spaces = np.flatnonzero(ids == self.space)
            self._add(hashes[easy], ids[ids != self.space], np.diff(spaces, prepend=-1) - 1)
        hard = np.flatnonzero(~easy)
        for first in range(0, len(hard), 1000):
            part = hard[first : first + 1000]
            found = self.tokenizer.encode_batch_fast([words[k].decode() for k in part], add_special_tokens=False)
            found = [np.array(x.ids, np.uint32) for x in found]
            self._add(hashes[part], np.concatenate(found), np.array([len(x) for x in found], np.int64))

    def _add(self, hashes: np.ndarray, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.table.add(hashes, self.count)
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(lengths) - lengths])
        self.lengths = np.concatenate([self.lengths, lengths])
        self.ids = np.concatenate([self.ids, ids])
        self.count += len(hashes)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, end to end, and the n + 1 offsets of the texts in them; a null text has none."""
        if self.count > MOST_WORDS:
            self._forget(MOST_WORDS)
        raw, offsets = column_bytes(texts)
        starts, ends, rows = word_spans(raw, offsets)
        hashes = np.maximum(span_hashes(raw, starts, ends), U(1))
        numbers = self.table.find(hashes)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            new, where = np.unique(hashes[unknown], return_index=True)
            if self.count + len(new) > self.most:
                # One text may have more new words than the bound; they are forgotten with the next texts.
                self._forget(max(MOST_WORDS, len(new)))
                return self.encode(texts)
            at = unknown[where]
            data = raw.tobytes()
            self._learn(new, [data[s:e] for s, e in zip(starts[at].tolist(), ends[at].tolist())])
            numbers[unknown] = self.table.find(hashes[unknown])
        lengths = self.lengths[numbers]
        ends = np.zeros(len(lengths) + 1, np.int64)
        np.cumsum(lengths, out=ends[1:])
        at = np.arange(ends[-1]) + np.repeat(self.starts[numbers] - ends[:-1], lengths)
        return self.ids[at], ends[np.searchsorted(rows, np.arange(len(offsets)))]


_ENCODERS: dict[tuple, WordEncoder] = {}


def encoder_for(path: str, ranks: dict[bytes, int] | None, specials_are_text: bool = False) -> WordEncoder:
    key = (path, ranks is None, specials_are_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordEncoder(path, ranks, specials_are_text)
    return _ENCODERS[key]
