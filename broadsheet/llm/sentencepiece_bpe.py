"""Exact SentencePiece BPE by backtracking, inside Arrow batches.

A BPE encoding is right exactly when every two neighbouring tokens are: merging
the two tokens' joined text again must give back those two tokens. So a word is
encoded from left to right with the longest vocabulary match that is compatible
with the token before it, going back to shorter matches where none is. A bit per
position remembers the places from which no encoding exists, so that no place is
tried twice. The matches of all places come from one Aho-Corasick pass, and the
answers of the compatibility check are kept.

Texts are cut into words where no piece of the vocabulary can reach across, so
the cut changes nothing; a table bounded in bytes keeps the words met before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import pyarrow as pa
import public_tokenizers
import sentencepiece
from pyspark.sql import DataFrame, functions as F

from .common import WordTable, by_bytes, id_lists, whole_text

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SPACE = "▁"
#: Pairs of tokens that a Python worker remembers; a full table starts anew.
REMEMBERED = 300_000
_BYTES = re.compile("[\udc80-\udcff]")


class Encoder:
    def __init__(self, model: str) -> None:
        self.library = library = sentencepiece.SentencePieceProcessor(model_file=model)
        ids = range(library.get_piece_size())
        ordinary = [i for i in ids if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i))]
        self.ids = {library.id_to_piece(i): i for i in ordinary}
        self.rank = {piece: -library.get_score(i) for piece, i in self.ids.items()}
        self.pieces = {i: piece for piece, i in self.ids.items()}
        self.bytes = {b: library.piece_to_id(f"<0x{b:02X}>") for b in range(256)}
        self.inner = {piece[k:k + 2] for piece in self.ids for k in range(len(piece) - 1)}
        if any(pair[1] == SPACE != pair[0] or "\n" in pair for pair in self.inner):
            raise ValueError("a piece of this vocabulary reaches across words")
        # Where no piece holds a letter beside another character, words are cut there too.
        letters = {c for pair in self.inner for c in pair if c.isalpha()}
        if any((a in letters) != (b in letters) for a, b in self.inner if a != SPACE):
            letters = set()
        known = re.escape("".join(sorted(letters)))
        word = f"(?:[{known}]+|[^{known}{SPACE}\n]+)" if letters else f"[^{SPACE}\n]+"
        self.cut = re.compile(f"{SPACE}*{word}|{SPACE}+|\n+")
        self.matches = ahocorasick.Automaton()
        for piece, i in self.ids.items():
            self.matches.add_word(piece, (len(piece), i))
        self.matches.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.words = WordTable(self.word)
        # Bytes beyond ASCII stand as lone surrogates until their characters are whole.
        raw = {i: bytes([b]).decode("utf-8", "surrogateescape") for b, i in self.bytes.items()}
        self.shown = {i: piece.replace(SPACE, " ") for i, piece in self.pieces.items()} | raw
        self.ends: dict[str, tuple] = {}

    def compatible(self, left: int, right: int) -> bool:
        """Whether merging the joined text of two tokens gives these two tokens."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= REMEMBERED:
                self.pairs.clear()
            known = self.pairs[left, right] = self.remerge(self.pieces[left], self.pieces[right])
        return known

    def remerge(self, a: str, b: str) -> bool:
        """Replay both tokens' merges in rank order and look for one that crosses the boundary.

        Until one does, the two sides merge as if alone, so only the parts next to
        the boundary matter, each up to the merge that takes it. Of equal ranks the
        one on the left comes first. Tokens whose merges do not rise in rank are
        merged in full instead.
        """
        left, right = self.edges(a)[1], self.edges(b)[0]
        if left is None or right is None:
            return self.merge(a + b) == [a, b]
        rank, never, x, y = self.rank, float("inf"), 0, 0
        while True:
            (part, left_ends), (other, right_ends) = left[x], right[y]
            crossing = rank.get(part + other, never)
            if crossing < left_ends and crossing <= right_ends and crossing < never:
                return False
            if left_ends == right_ends == never:
                return True
            if left_ends <= right_ends:
                x += 1
            else:
                y += 1

    def edges(self, piece: str) -> tuple:
        """Parts at the piece's left and right end in order, each with the rank of the merge that takes it."""
        known = self.ends.get(piece)
        if known is None:
            never, history = float("inf"), []
            parts = self.merge(piece, history)
            ranks = [r for _, r in history]
            if parts != [piece] or any(p >= q for p, q in zip(ranks, ranks[1:])):
                known = (None, None)
            else:
                sides = []
                for side in (0, -1):
                    steps, before = [], list(piece)
                    for after, r in history:
                        if after[side] != before[side]:
                            steps.append((before[side], r))
                        before = after
                    sides.append([*steps, (piece, never)])
                known = tuple(sides)
            self.ends[piece] = known
        return known

    def merge(self, text: str, history: list | None = None) -> list[str]:
        """Plain BPE: the best-ranked neighbours merge first, the leftmost of equals."""
        parts, rank = list(text), self.rank
        while True:
            ranked = [(rank[parts[k] + parts[k + 1]], k) for k in range(len(parts) - 1) if parts[k] + parts[k + 1] in rank]
            if not ranked:
                return parts
            best, k = min(ranked)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            if history is not None:
                history.append((parts.copy(), best))

    def backtrack(self, text: str) -> list[int]:
        """Encode a text of known characters."""
        tokens = [i for _, (_, i) in self.matches.iter_long(text)]
        if all(map(self.compatible, tokens, tokens[1:])):
            return tokens  # the longest match fits at every place: nothing to go back for
        n = len(text)
        starting: list[list[tuple[int, int]]] = [[] for _ in range(n)]
        for end, match in self.matches.iter(text):
            starting[end - match[0] + 1].append(match)  # shorter matches of a place come first
        failed, at, choice = 0, 0, len(starting[0]) - 1
        tokens, tries, places = [], [], []
        while at < n:
            here = starting[at]
            while choice >= 0:
                length, i = here[choice]
                if not failed >> (at + length) & 1 and (not tokens or self.compatible(tokens[-1], i)):
                    break
                choice -= 1
            if choice >= 0:
                tokens.append(i)
                tries.append(choice)
                places.append(at)
                at += length
                choice = len(starting[at]) - 1 if at < n else 0
            else:
                failed |= 1 << at
                tokens.pop()
                at, choice = places.pop(), tries.pop() - 1
        return tokens

    def word(self, text: str) -> list[int]:
        """Encode a word, cut where no piece reaches across; unknown characters become bytes."""
        out: list[int] = []
        start = 0
        for k in range(1, len(text) + 1):
            if k < len(text) and text[k - 1:k + 1] in self.inner:
                continue
            part = text[start:k]
            start = k
            if len(part) == 1 and part not in self.ids:
                out += [self.bytes[b] for b in part.encode()]
            else:
                out += self.backtrack(part)
        return out

    def packed(self, text: str) -> bytes:
        """All ids of a text, as little-endian 32-bit numbers."""
        return b"".join(map(self.words.__getitem__, self.cut.findall(SPACE + text.replace(" ", SPACE)))) if text else b""

    def encode(self, text: str) -> list[int]:
        return memoryview(self.packed(text)).cast("i").tolist()

    def unpacked(self, ids: bytes) -> str:
        """The text of ids that :meth:`packed` gave: the pieces without the first space, bytes joined to characters."""
        text = "".join(map(self.shown.__getitem__, memoryview(ids).cast("i")))[1:]
        return text if text.isascii() or not _BYTES.search(text) else text.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


@lru_cache(maxsize=2)
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
            ids = [own.packed(text) for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), id_lists(ids), pa.array(map(own.unpacked, ids), pa.string())], ["doc_id", "ids", "decoded"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        batches, "doc_id long, ids array<int>, decoded string"
    )


def token_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256), one row per document."""
    return encode_decode(docs).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
