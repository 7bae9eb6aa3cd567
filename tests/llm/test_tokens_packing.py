import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import odd
import pytest
from tokenizers import Tokenizer

from veriloom.llm import packing, queries, tokens

PATH = queries.tokenizer_path()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_equal_the_library(spark, name):
    path = queries.tokenizer_path(name)
    plain = Tokenizer.from_file(path)
    got = Counter((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.token_counts(odd.documents(spark), path).collect())
    want = Counter()
    for doc, text, _ in odd.TEXTS:
        n = len(ids(plain, text))
        want[doc, len((text or "").encode()), n, n > 1024] += 1
    assert got == want
    assert tokens.token_counts(odd.empty(spark), path).count() == 0


def test_pieces_encode_as_the_whole(library):
    rng = random.Random(3)
    parts = ["a", "B", "é", "1", "²", " ", "  ", "\n", "\t", ",", ".", "!", "'s", "'", "_", "-", " ", " ", "\x1c", "́", "日", "<|endoftext|>", "᠎", "﻿", "😀", ")"]
    encoder = tokens.Encoder.of(PATH)
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 40))) for _ in range(3000)]
    for text, found in zip(texts, encoder.encode(texts)):
        assert np.frombuffer(b"".join(found), "<u4").tolist() == ids(library, text), repr(text)


def test_long_texts_are_cut_at_safe_places(library, monkeypatch):
    monkeypatch.setattr(tokens, "WINDOW_CHARS", 50)
    encoder = tokens.Encoder(PATH)
    text = odd.LONG[:20_000] + "   x" * 100
    assert len(list(encoder.windows(text))) > 10
    assert np.frombuffer(b"".join(encoder.encode([text])[0]), "<u4").tolist() == ids(library, text)


def test_memo_starts_anew(library, monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_BYTES", 600)
    encoder = tokens.Encoder(PATH)
    for text in ["a b c d", "e f g h i j k", "a b c d"]:
        assert np.frombuffer(b"".join(encoder.encode([text])[0]), "<u4").tolist() == ids(library, text)


def test_recurring_pieces_outlast_those_met_once(library, monkeypatch):
    """A hundred recurring words among thousands met once, with a memo for a few hundred: the words are encoded a few times in all."""
    monkeypatch.setattr(tokens, "MEMO_BYTES", 60_000)
    encoder, asked = tokens.Encoder(PATH), Counter()
    whole = encoder._whole
    monkeypatch.setattr(encoder, "_whole", lambda text: (asked.update(text.replace(encoder.mark, " ").split()), whole(text))[1])
    usual = [f"usual{i}" for i in range(100)]
    for k in range(30):
        text = " ".join(["", *usual, *(f"once{k}x{i}" for i in range(400))])
        assert np.frombuffer(b"".join(encoder.encode([text])[0]), "<u4").tolist() == ids(library, text)
    assert max(asked[w] for w in usual) <= 5


def test_batches_of_odd_pieces_encode_as_the_whole(library):
    """Texts of one batch share pieces; the mark itself, white space in runs and at the ends, letters of several bytes, special strings."""
    rng = random.Random(7)
    parts = [" ", " ", " ", "a", "été", "日", "B.", ",c", "3.1", "\n", "\n\n", "\t", "\v", "  ", "\x01", "<|endoftext|>", "'s", "😀", "\x00", "..."]
    encoder = tokens.Encoder(PATH)
    for _ in range(60):
        texts = ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(40)] + ["", " ", "\n"]
        texts += [" ".join(rng.choices(["é", "ab.", "c,d", "x\ny", "日本"], k=9)) for _ in range(20)]
        for text, found in zip(texts, encoder.encode(texts), strict=True):
            assert np.frombuffer(b"".join(found), "<u4").tolist() == ids(library, text), repr(text)


def test_best_fit_equals_item_by_item():
    rng = random.Random(5)
    for _ in range(200):
        capacity = rng.choice([10, 64, 2048])
        lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 120))]
        lengths += [rng.randint(1, capacity)] * rng.choice([0, 50])
        spaces = []
        bins = 0
        for n in sorted(lengths, reverse=True):
            i = bisect_left(spaces, n)
            if i == len(spaces):
                bins += 1
                insort(spaces, capacity - n)
            else:
                insort(spaces, spaces.pop(i) - n)
        runs = packing.best_fit(Counter(lengths), capacity)
        filled, ranks = {}, Counter()
        for length, rank, items, per, first, offset in runs:
            assert rank == ranks[length]
            ranks[length] += items
            for i in range(items):
                filled.setdefault(first + i // per, []).append((offset + i % per * length, length))
        assert ranks == Counter(lengths) and len(filled) == bins
        for places in filled.values():
            end = 0
            for at, n in sorted(places):
                assert at == end
                end += n
            assert end <= capacity


def check_packing(rows, texts, library, capacity):
    want = Counter()
    for doc, text in texts:
        all_ids = np.array([*ids(library, text), 0], "<u4")
        first = len(all_ids) % capacity or min(capacity, len(all_ids))
        cuts = [0, *range(first, len(all_ids), capacity), len(all_ids)]
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            want[doc, k, a, b - a, zlib.crc32(all_ids[a:b].tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        end = 0
        for at, n in sorted(places):
            assert at == end
            end += n
        assert end <= capacity


def test_packing(spark, library):
    check_packing(packing.pack(odd.documents(spark), PATH, 64).collect(), [(d, t) for d, t, _ in odd.TEXTS], library, 64)
    assert packing.pack(odd.empty(spark), PATH).count() == 0


def test_packing_one_hot_length(spark, library):
    rows = [(i, "same words" if i % 3 else "other " * (i % 7), "a") for i in range(600)]
    got = packing.pack(odd.documents(spark, rows), PATH, 16).collect()
    check_packing(got, [(d, t) for d, t, _ in rows], library, 16)


def test_query_packs_the_table(spark, sf, library):
    rows = queries.QUERIES["op2_best_fit_packing"](spark, sf).collect()
    texts = [(r.doc_id, r.text) for r in queries.table(spark, sf, "documents").collect()]
    check_packing(rows, texts, library, 2048)
