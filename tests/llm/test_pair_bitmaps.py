"""Alignment of two tokenizers against whole-text encoding and counting, on odd little tables."""

import collections
import hashlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from pitlake.llm import pair_bitmaps

FILES = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
SCHEMA = "doc_id long, text string, block long, pair long, pairs string, of_block int"
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
TEXTS = [
    (1, "Some words, and more words."), (2, None), (3, ""), (4, " "), (5, "  two  blanks  "), (6, "a\n b \n\n  c\t d  e  f\x1c g​ h"),
    (7, "</s> <s> <unk> <|endoftext|> <0x41>"), (8, "has ▁ inside"), (9, "日本語 ünïcödé \U0001f600\U0001f468‍\U0001f469"),
    (10, "x" * 5000), (11, "word " * 3000), (12, "Some words, and more words."), (12, "it's 12345 don't!!"), (None, "no id"), (13, "\n"), (14, "　"),
]


@pytest.fixture(scope="module")
def tokenizers():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[1])


def encoded(tokenizers, text):
    """Ids and bytes of both, or None where the bytes differ."""
    a, b = tokenizers
    ids_a, ids_b = a.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)
    bytes_a = [pair_bitmaps.byte_level_tokens(a)[i] for i in ids_a] if len(ids_a) < 3 else None
    table = encoded.table = getattr(encoded, "table", None) or pair_bitmaps.byte_level_tokens(a)
    bytes_a = [table[i] for i in ids_a] if bytes_a is None else bytes_a
    bytes_b = [pair_bitmaps.piece_bytes(b, i) for i in ids_b]
    same = b"".join(bytes_a) == b"".join(bytes_b) == f" {text}".encode()
    return (ids_a, ids_b, bytes_a, bytes_b) if same and text else None


def walked(ids_a, ids_b, bytes_a, bytes_b):
    """Links in order and groups as text, by two fingers."""
    links, groups, in_a, in_b = [], [], [], []
    i = j = end_a = end_b = 0
    while i < len(ids_a):
        to_a, to_b = end_a + len(bytes_a[i]), end_b + len(bytes_b[j])
        links.append((ids_a[i], ids_b[j]))
        if to_a <= to_b:
            in_a.append(str(ids_a[i]))
        if to_b <= to_a:
            in_b.append(str(ids_b[j]))
        if to_a == to_b:
            groups.append(f"{','.join(in_a)}|{','.join(in_b)}")
            in_a, in_b = [], []
        step_a, step_b = to_a <= to_b, to_b <= to_a
        if step_a:
            i, end_a = i + 1, to_a
        if step_b:
            j, end_b = j + 1, to_b
    return links, groups


def brute(tokenizers, rows):
    found, held = [], collections.Counter()
    for i, text in rows:
        both = encoded(tokenizers, text) if text else None
        links, groups = walked(*both) if both else ([], [])
        found.append((i, both, links, groups))
        held.update(set(links))
    top = collections.Counter()
    for (a, _), n in held.items():
        top[a] = max(top[a], n)
    out = []
    for i, both, links, groups in found:
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if both else ""
        sizes = (len(both[0]), len(both[1])) if both else (0, 0)
        out.append((i, *sizes, len(groups), len(links), sum(held[x] == top[x[0]] for x in links), sum(held[x] for x in links), digest))
    return sorted(out), held


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "clash", 3) for i, t in rows], SCHEMA)


@pytest.mark.parametrize("entries", [40, 2_000_000], ids=["many blocks", "one block a task"])
@pytest.mark.parametrize("rows", [[], TEXTS], ids=["empty", "odd"])
def test_against_plain_counting(spark, tokenizers, monkeypatch, rows, entries):
    monkeypatch.setattr(pair_bitmaps, "BLOCK_ENTRIES", entries)
    figures, pairs = pair_bitmaps.align(frame(spark, rows).coalesce(2), *FILES)
    expected, held = brute(tokenizers, [r for r in rows if r[0] is not None])
    assert sorted(tuple(r[c] for c in COLUMNS) for r in figures.collect()) == expected
    assert {(r.id_a, r.id_b): r.n_documents for r in pairs.collect()} == dict(held)


def test_a_text_in_parts_is_one_document(spark, tokenizers, monkeypatch):
    monkeypatch.setattr(pair_bitmaps, "PART", 50)
    rows = [(1, "some of the words in a text\n of many parts " * 40), (2, "a short text"), (3, "bad ▁ only in a later part " + "x y " * 60)]
    figures, _ = pair_bitmaps.align(frame(spark, rows).coalesce(1), *FILES)
    assert sorted(tuple(r[c] for c in COLUMNS) for r in figures.collect()) == brute(tokenizers, rows)[0]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=" \n\t  \x1cab'st1.-é日<>|​", max_size=40), min_size=1, max_size=6))
def test_chunks_are_encoded_as_in_the_whole_text(tokenizers, texts):
    index, aligner = pair_bitmaps.Index(), aligner_of()
    index.add(aligner, list(range(len(texts))), texts)
    counts = np.concatenate(index.counts)
    for n, text in enumerate(texts):
        both = encoded(tokenizers, text) if text else None
        links, groups = walked(*both) if both else ([], [])
        assert counts[n].tolist() == ([len(both[0]), len(both[1]), len(groups), len(links)] if both else [0, 0, 0, 0])
        assert index.digests[n] == (hashlib.sha256(";".join(groups).encode()).hexdigest() if both else "")


def aligner_of():
    if not hasattr(aligner_of, "made"):
        with open(FILES[0], encoding="utf-8") as a, open(FILES[1], "rb") as b:
            aligner_of.made = pair_bitmaps.Aligner(a.read(), b.read())
    return aligner_of.made


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(0, 400), st.integers(0, 10**6))
def test_bitmaps_and_planes_round_trip(documents, entries, seed):
    rng = np.random.default_rng(seed)
    key = np.unique(rng.integers(0, 9, entries) << 16 | rng.integers(0, documents, entries))
    pair, doc, times = key >> 16, key & 0xFFFF, rng.integers(1, 300, len(key))
    pairs, sizes, body = pair_bitmaps.bitmaps_of(pair, doc, documents)
    assert (np.repeat(pairs, sizes) == pair).all() and (pair_bitmaps.documents_of(sizes, documents, body) == doc).all()
    assert (pair_bitmaps.times_of(len(key), pair_bitmaps.planes_of(times)) == times).all()
