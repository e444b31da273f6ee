"""Exact BPE with word ends, one token per prefix, by dynamic programming.

The encoding of every prefix of a word ends in one certain token, and cutting that
token off leaves the encoding of a shorter prefix. So a word is read once from left
to right: the tokens that end at a place come from a suffix automaton over the whole
vocabulary, longest first, and the one that is compatible with the last token of the
prefix before it is the prefix's last token. Following the last tokens back from the
end gives the ids. Two tokens are compatible when undoing their merges, youngest
first, never leaves two neighbours that would have merged across the boundary.

A word's last symbol carries the word end, so a symbol is one character here: a byte,
or a byte with the end behind it.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer

from .common import WordTable, by_bytes, id_lists, whole_text

MODEL = public_tokenizers.path("word_bpe_49k.json")
#: Added to the last character of a word to mark the end.
ENDING = 0x400
#: Pairs of tokens whose test is kept.
PAIRS = 300_000
#: Texts of these characters are normalised and cut here, as the library does; others go through the library's own steps.
PLAIN = re.compile("[\x00-ɏ]*")


class SuffixAutomaton:
    """All substrings of a set of words; each word is the longest string of its state."""

    def __init__(self) -> None:
        self.next: list[dict[str, int]] = [{}]
        self.link, self.length, self.word = [-1], [0], [-1]

    def _state(self, follow: dict[str, int], link: int, length: int) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.word.append(-1)
        return len(self.link) - 1

    def _split(self, p: int, c: str) -> int:
        """The state of p's longest string and c; if it holds longer ones too, they are parted from it."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        shorter = self._state(dict(self.next[q]), self.link[q], self.length[p] + 1)
        self.link[q] = shorter
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = shorter
            p = self.link[p]
        return shorter

    def _extend(self, last: int, c: str) -> int:
        if c in self.next[last]:
            return self._split(last, c)
        new, p = self._state({}, 0, self.length[last] + 1), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, c)
        return new

    def add(self, text: str, name: int) -> None:
        state = 0
        for c in text:
            state = self._extend(state, c)
        self.word[state] = name

    def close(self) -> None:
        """For each state the nearest one with a word, going to shorter suffixes and beginning with itself."""
        self.near = [0] * len(self.link)
        for state in sorted(range(1, len(self.link)), key=self.length.__getitem__):
            self.near[state] = state if self.word[state] >= 0 else self.near[self.link[state]]


class Encoder:
    def __init__(self, model: str) -> None:
        self.library = Tokenizer.from_file(model)
        with open(model, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary, end = spec["model"]["vocab"], spec["model"]["end_of_word_suffix"]

        def one_symbol(token: str) -> str:
            stem = token.removesuffix(end)
            return stem[:-1] + chr(ord(stem[-1]) + ENDING) if stem and stem != token else token

        self.strings = {i: t for t, i in vocabulary.items()}
        self.strings |= {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        symbols = {t: one_symbol(t) for t in vocabulary}
        # The merge that makes a token, by rank; single symbols have none.
        self.parts: dict[int, tuple[int, int]] = {}
        self.born = {i: -1 for i in vocabulary.values()}
        self.crossing: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            left, right, both = vocabulary[a], vocabulary[b], vocabulary[a + b]
            if both in self.parts or max(self.born[left], self.born[right]) >= rank:
                raise ValueError("a token of this vocabulary is made twice, or before its parts")
            self.parts[both], self.born[both], self.crossing[left, right] = (left, right), rank, rank
        if any((len(symbols[t]) == 1) == (i in self.parts) for t, i in vocabulary.items()):
            raise ValueError("a token of this vocabulary is neither a symbol nor made by a merge")
        self.pairs: dict[tuple[int, int], bool] = {}
        self.automaton = SuffixAutomaton()
        whole: set[int] = set()  # tokens whose own string is encoded as that token
        for token, i in sorted(vocabulary.items(), key=lambda entry: self.born[entry[1]]):
            if i not in self.parts or (whole.issuperset(self.parts[i]) and self.apart(*self.parts[i], self.born[i])):
                whole.add(i)
                self.automaton.add(symbols[token], i)
        self.automaton.close()
        self.bytes = self._byte_symbols()
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self.cut_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        self.table = WordTable(lambda word: self.word(word.encode()))
        #: Words as the library's own steps give them, already in byte symbols.
        self.spelled = WordTable(self.symbols)

    @staticmethod
    def _byte_symbols() -> list[str]:
        """Printable bytes stand for themselves, the others for characters from 256 on."""
        shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = iter(range(256, 512))
        return [chr(b) if b in shown else chr(next(hidden)) for b in range(256)]

    def apart(self, left: int, right: int, until: int) -> bool:
        """Whether no merge crosses from ``left`` to ``right`` before the merges of rank ``until``.

        Goes back in time from two whole tokens. A pair of neighbouring parts that
        could merge would have done so unless one of them was taken earlier; of two
        merges with one rank the left one comes first.
        """
        left_taken = right_taken = until
        while True:
            rank = self.crossing.get((left, right))
            if rank is not None and rank < left_taken and rank <= right_taken:
                return False
            if self.born[left] > self.born[right]:
                left_taken, left = self.born[left], self.parts[left][1]
            elif right in self.parts:
                right_taken, right = self.born[right], self.parts[right][0]
            else:
                return True

    def compatible(self, left: int, right: int) -> bool:
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            known = self.pairs[left, right] = self.apart(left, right, len(self.crossing))
        return known

    def symbols(self, spelled: str) -> list[int]:
        """Ids of one word given in byte symbols."""
        text = spelled[:-1] + chr(ord(spelled[-1]) + ENDING)
        a = self.automaton
        follow, link, length, word, near, compatible = a.next, a.link, a.length, a.word, a.near, self.compatible
        last, back = [-1], [0]  # last token of each prefix, and its length
        state = matched = 0
        for place, c in enumerate(text, 1):
            while state and c not in follow[state]:
                state = link[state]
                matched = length[state]
            state = follow[state][c]
            matched += 1
            at = near[state if matched == length[state] else link[state]]
            while last[place - length[at]] >= 0 and not compatible(last[place - length[at]], word[at]):
                at = near[link[at]]
            last.append(word[at])
            back.append(length[at])
        ids, place = [], len(text)
        while place:
            ids.append(last[place])
            place -= back[place]
        return ids[::-1]

    def word(self, raw: bytes) -> list[int]:
        return self.symbols("".join(map(self.bytes.__getitem__, raw)))

    def encode(self, text: str) -> bytes:
        """All ids of a text, as little-endian 32-bit numbers."""
        if "<|" in text:
            parts = self.cut_special.split(text)
            return b"".join(
                self.special[p].to_bytes(4, "little") if p in self.special else self._stretch(p) for p in parts if p)
        return self._stretch(text)

    def _stretch(self, text: str) -> bytes:
        if PLAIN.fullmatch(text):
            return b"".join(map(self.table.__getitem__, self.cut.findall(text.lower())))
        normal = self.library.normalizer.normalize_str(text)
        return b"".join(self.spelled[w] for w, _ in self.library.pre_tokenizer.pre_tokenize_str(normal))

    def decode(self, ids: bytes) -> str:
        """Tokens joined by spaces: the model has no decoder of its own, so word ends stay visible."""
        return " ".join(map(self.strings.__getitem__, memoryview(ids).cast("i")))


@lru_cache(maxsize=1)
def encoder(model: str) -> Encoder:
    return Encoder(model)


def encode_decode(docs: DataFrame, model: str = MODEL) -> DataFrame:
    """Documents -> (doc_id, ids, decoded): token ids of the whole text, and the text they decode to.

    A null text is the empty text, which has no ids. Rows are taken one by one, so
    repeated rows, null ids and other columns do not matter.
    """
    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(model)
        for part in by_bytes(parts):
            ids = [own.encode(text) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), id_lists(ids), pa.array(map(own.decode, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        batches, "doc_id long, ids array<int>, decoded string"
    )


def token_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per document."""
    return encode_decode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
