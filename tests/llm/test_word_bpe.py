"""BPE with word ends against the library."""

import hashlib
import random

import pytest

from broadsheet.llm import common, word_bpe


@pytest.fixture(scope="module")
def own():
    return word_bpe.encoder(word_bpe.MODEL)


def ids(raw: bytes) -> list[int]:
    return memoryview(raw).cast("i").tolist()


def library(own, text):
    return own.library.encode(text, add_special_tokens=False).ids


def test_random_texts_like_the_library(own):
    rng = random.Random(1)
    spread = [(0, 0x250), (32, 127), (0x250, 0x3000), (0x3000, 0xD000), (0x1F000, 0x1FA00)]
    texts = ["", "  ", "a" * 3000, "İ Σ ΑΣ É é ſ ǅ \x85 \xa0", "<|endoftext|> <|startoftext|>x<|endoftext|>", "<| |>", "don't can'T", "123 4５", "\x1c\x1f a\x0bb"]
    texts += ["".join(chr(rng.randrange(*rng.choice(spread))) for _ in range(rng.randint(1, 30))) for _ in range(3000)]
    texts += [chr(i) + " " + chr(i) + "a'" + chr(i) for i in range(0x250)]
    tokens = [t.replace("</w>", " ") for t in own.library.get_vocab() if t.isascii()]
    texts += ["".join(rng.choice(tokens) for _ in range(rng.randint(1, 10))) for _ in range(3000)]
    for text in texts:
        mine = own.encode(text)
        assert ids(mine) == library(own, text), text
        assert own.decode(mine) == own.library.decode(ids(mine), skip_special_tokens=False)


def test_automaton_finds_every_word_at_every_place():
    rng = random.Random(2)
    for _ in range(200):
        words = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 6))) for _ in range(12)}
        automaton = word_bpe.SuffixAutomaton()
        for k, w in enumerate(sorted(words)):
            automaton.add(w, k)
        automaton.close()
        for k, w in enumerate(sorted(words)):
            state = 0
            for c in w:
                state = automaton.next[state][c]
            found, at = set(), automaton.near[state]
            while at:
                found.add(sorted(words)[automaton.word[at]])
                at = automaton.near[automaton.link[at]]
            assert automaton.word[state] == k and found == {v for v in words if w.endswith(v)}


def test_small_tables_change_nothing(own):
    small = common.WordTable(own.table.encode, size=1000, longest=5)
    text = "the quick brown fox jumps over the lazy dog and the quick brown the"
    assert b"".join(small[w] for w in text.split()) == own.encode(text)
    assert 0 < small.held <= 1000 and "the" in small


def test_slices_and_lists():
    import pyarrow as pa

    rows = ["a" * n for n in (0, 5, 100, 3, 0, 7)] + [None]
    batch = pa.RecordBatch.from_arrays([pa.array(rows)], ["text"])
    parts = list(common.by_bytes([batch], size=10))
    assert sum((p.column("text").to_pylist() for p in parts), []) == rows and len(parts) == 3
    assert common.id_lists([b"\1\0\0\0\2\0\0\0", b"", b"\3\0\0\0"]).to_pylist() == [[1, 2], [], [3]]
    assert common.id_lists([]).to_pylist() == []


def test_token_digests(odd_docs, sf_docs, no_docs, texts, own):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for docs, rows in zip((odd_docs, sf_docs), texts):
        want = []
        for i, t in rows:
            got = library(own, t)
            want.append((i, len(got), sha(" ".join(map(str, got))), sha(own.library.decode(got, skip_special_tokens=False))))
        assert sorted((tuple(r) for r in word_bpe.token_digests(docs).collect()), key=str) == sorted(want, key=str)
    assert word_bpe.token_digests(no_docs).count() == 0
