"""BPE with chunk reuse against the tokenizer's own library: ids and decoded texts of whole tables, joins, special tokens and edge cases."""

import random

import numpy as np
import public_tokenizers
import pytest
import regex
from tokenizers import Tokenizer

from tidemark.llm import chunk_bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")
SPECIAL = "<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def tokenizer():
    return chunk_bpe.Tokenizer(PATH)


def random_text(rng, n):
    return "".join(rng.choice(list("aaaabbcde  \n\t'’srtvelmd12.,!é漢") + [" the", " and", "'re"]) for _ in range(n))


def test_pieces_merge_as_in_the_library(library, tokenizer):
    rng = random.Random(1)
    texts = [random_text(rng, rng.randint(0, 300)) for _ in range(500)] + ["a" * 5000, "ab" * 3000, "x" * 100 + "!" * 200, "".join(rng.choice("abcdefgh") for _ in range(20_000))]
    e = chunk_bpe.Encoder(tokenizer)
    numbers = [e.number(e.split.findall(x)) for x in texts]
    e.learn()
    for n, want in zip(numbers, library.encode_batch(texts, add_special_tokens=False)):
        assert e.ids(n).tolist() == want.ids
    assert all(e.merge_long(w) == library.encode(w.decode(), add_special_tokens=False).ids for w in (b"hello", b"unbelievable", b"zzzzzzzzzzzzzzz", b"aabaabaab"))


@pytest.mark.parametrize("seed", range(4))
def test_joins_are_repaired(library, tokenizer, seed):
    """Texts cut anywhere, any of their chunks encoded alone: the repaired ids are those of the whole text."""
    rng = random.Random(seed)
    for _ in range(150):
        text = random_text(rng, rng.randint(1, 1200))
        raw = text.encode()
        at = sorted({b for b in (rng.randint(0, len(raw)) for _ in range(rng.randint(0, 12))) if b == len(raw) or raw[b] & 0xC0 != 0x80} | {0, len(raw)})
        e, chunks = chunk_bpe.Encoder(tokenizer), []
        for lo, hi in zip(at, at[1:]):
            if rng.random() < 0.7:
                n = e.number(e.split.findall(raw[lo:hi].decode()))
                e.learn()
                chunks.append((lo, hi, e.ids(n, mark=True)))
        got = e.repaired(text, chunks)
        e.learn()
        ids = [i for p in got for i in (e.ids(p) if p.dtype == np.int64 else p).tolist()]
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_cuts_depend_on_the_own_text_alone():
    rng = random.Random(5)
    text = random_text(rng, 20_000).encode()
    alone, _ = chunk_bpe.cuts(np.frombuffer(text, dtype=np.uint8), np.array([0, len(text)]), None)
    both, _ = chunk_bpe.cuts(np.frombuffer(b"z" * 777 + text, dtype=np.uint8), np.array([0, 777, 777 + len(text)]), None)
    assert len(alone) > 20 and (both[both >= 777] - 777).tolist() == alone.tolist()
    assert np.diff(alone[:-1]).min() >= chunk_bpe.LEAST
    shifted, _ = chunk_bpe.cuts(np.frombuffer(b"new start " + text, dtype=np.uint8), np.array([0, 10 + len(text)]), None)
    assert len(set((shifted - 10).tolist()) & set(alone.tolist())) > 0.9 * len(alone)
    bounds, special = chunk_bpe.cuts(np.frombuffer(b"a<|endof" + b"text|>b<|x|><|x|>", dtype=np.uint8), np.array([0, 8, 25]), regex.compile(rb"(<\|endoftext\|>|<\|x\|>)"))
    assert bounds.tolist() == [0, 8, 15, 20, 25] and special.tolist() == [False, False, True, True]


def test_whole_table_and_edge_cases(spark, library, monkeypatch):
    monkeypatch.setattr(chunk_bpe, "BLOCK", 20_000)
    monkeypatch.setattr(chunk_bpe, "PIECES", 500)
    rng = random.Random(2)
    passage, long = random_text(rng, 4000), random_text(rng, 60_000)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    texts += [None, "", " ", SPECIAL, SPECIAL * 3, f"a{SPECIAL} b<|endoftext{SPECIAL}|>", "<|endoftext", passage, passage, f"x{passage}", f"{passage[:-1]}é", f"{passage[5:]}{SPECIAL}{passage}", f"{passage}{passage}",
              passage + " " + passage, long, long, long[7:] + "'", "a" * 30_000, "a" * 30_001, "é" * 5000, "漢字" * 3000 + passage]
    docs = spark.createDataFrame([(None if k % 50 == 49 else k // 2, t, "clash", 1, b"x") for k, t in enumerate(texts)], "doc_id long, text string, ids string, h int, packed binary").repartition(5)
    want = sorted((str(None if k % 50 == 49 else k // 2), library.encode(t or "", add_special_tokens=False).ids, t or "") for k, t in enumerate(texts))
    rows = chunk_bpe.decode(chunk_bpe.encode(docs, PATH), PATH).collect()
    assert sorted((str(r.doc_id), np.frombuffer(r.ids, dtype="<u4").tolist(), r.decoded) for r in rows) == want
    assert all(library.decode(ids, skip_special_tokens=False) == text for _, ids, text in want)
    assert chunk_bpe.encode(docs.limit(0), PATH).collect() == []


def test_shared_chunks_are_found_and_a_full_table_changes_nothing(spark, library, tokenizer, monkeypatch):
    rng = random.Random(9)
    passage = random_text(rng, 6000)
    docs = spark.createDataFrame([(i, f"{random_text(rng, 500)}{passage if i % 2 else ''}{random_text(rng, 500)}") for i in range(20)], "doc_id long, text string")
    table = chunk_bpe.shared_table(docs, tokenizer.special_pattern())
    assert len(table) == chunk_bpe.FILTER_BITS // 8 and 3 <= sum(bin(b).count("1") for b in table if b) <= 40
    want = {r.doc_id: library.encode(r.text, add_special_tokens=False).ids for r in docs.collect()}
    for bits in (b"\xff" * len(table), bytes(len(table)), table):
        monkeypatch.setattr(chunk_bpe, "shared_table", lambda *_, bits=bits: bits)
        assert {r.doc_id: np.frombuffer(r.ids, dtype="<u4").tolist() for r in chunk_bpe.encode(docs, PATH).collect()} == want


def test_unknown_ids_are_an_error(spark):
    with pytest.raises(Exception):
        chunk_bpe.decode(spark.createDataFrame([(1, np.array([60_000], dtype="<u4").tobytes())], "doc_id long, ids binary"), PATH).collect()
