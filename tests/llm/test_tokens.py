"""Counts, ids, packing and the grammar files against the tokenizers library and round trips."""

import random

import numpy as np
import pytest

from tablewright.llm.grammar_ids import Shard, compress, expand, pack, read_ids, write_ids
from tablewright.llm.packing import CAPACITY, pack_documents, sweep
from tablewright.llm.token_counts import token_counts
from tablewright.llm.tokens import SAFE_RANGES, TokenCounts, WordIds, crc_of_ids, plain_tokenizer, proven_whole, public_path
from tablewright.session import scratch_path

WORD, BYTE = public_path("word_bpe_49k.json"), public_path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def texts():
    points = [chr(c) for a, b in SAFE_RANGES for c in range(a, b + 1)]
    out = [f"a{c}b {c}c 1{c} {c} {c}{c}x\n{c} '{c}s {c}'s don't{c} x' {c}\t\n {c}" for c in points]
    rng = random.Random(3)
    out += ["".join(rng.choice(points + list("  \n\n''abc12..") * 30) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    return out + ["<|endoftext|> a", "x<|startoftext|>y", "\x1c a \x1f b", "日本語 テスト", "Σίσυφος ΑΣ", "", " ", "  \n ", " private", "x" * 3000, "we'll they've 're'll"]


def test_word_ids_equal_the_library(texts):
    tok, coder = plain_tokenizer(WORD), WordIds(WORD)
    for a in range(0, len(texts), 97):
        for t, got in zip(texts[a : a + 97], coder.encode(texts[a : a + 97])):
            assert got.tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


def test_counts_equal_the_library(texts):
    whole = proven_whole(BYTE)
    counts, tok = TokenCounts(BYTE, whole), plain_tokenizer(BYTE)
    assert len(whole) > 40_000
    for t in texts:
        assert counts.count(t) == len(tok.encode(t, add_special_tokens=False).ids), repr(t)


def test_token_counts_of_odd_rows(spark, table, odd_rows):
    tok = plain_tokenizer(BYTE)
    got = token_counts(table(odd_rows), BYTE, limit=2).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(tok.encode(t or "", add_special_tokens=False).ids)) for i, t in odd_rows)
    assert sorted((r.doc_id if r.doc_id is not None else -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2) for r in got)
    assert token_counts(table([]), BYTE).count() == 0


def test_grammar_round_trip():
    rng = np.random.default_rng(4)
    sizes = [0, 1, 2, 500, 1, 4000, 3]
    docs = [np.append(rng.integers(0, 30, n) if n != 500 else np.full(n, 7), 2).astype(np.uint32) for n in sizes]
    shard = Shard(pack(np.concatenate(docs), np.cumsum([len(d) for d in docs])))
    assert shard.n == len(docs) and len(shard.rules) > 10
    assert all((a == b).all() for a, b in zip(shard.documents(), docs))
    for i, d in enumerate(docs):
        assert (shard.document(i) == d).all()
        for a, b in ((0, len(d)), (len(d) // 3, len(d) // 2), (len(d) - 1, len(d))):
            assert (shard.slice(i, a, b) == d[a:b]).all()
    lengths = [len(expand(np.array([shard.base + k]), shard.rules)) for k in range(len(shard.rules))]
    assert lengths == shard.lengths.tolist()
    assert compress(np.zeros(0, np.uint32), np.zeros(0, np.int64))[0].size == 0


def test_token_files(spark, table, odd_rows):
    tok, path = plain_tokenizer(WORD), scratch_path(spark, "ids")
    write_ids(table(odd_rows), WORD, path, shard_ids=5000)
    got = sorted(read_ids(spark, path).collect(), key=lambda r: r.start)
    assert sum(r.n_tokens for r in got[:-1]) == got[-1].start
    assert [r.doc_id for r in got] == sorted((i for i, _ in odd_rows), key=lambda i: (i is not None, i))
    want = sorted((i or -1, crc_of_ids(np.array(tok.encode(t or "", add_special_tokens=False).ids + [2]))) for i, t in odd_rows)
    assert sorted((r.doc_id or -1, r.ids_crc32) for r in got) == want
    empty = scratch_path(spark, "ids")
    write_ids(table([]), WORD, empty)
    assert read_ids(spark, empty).count() == 0


def well_packed(rows):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append(r)
    for own in by.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= CAPACITY
    return len(by)


def test_packing_of_odd_rows(spark, table, odd_rows):
    tok = plain_tokenizer(WORD)
    got = pack_documents(table(odd_rows), WORD).collect()
    used = well_packed(got)
    total = sum(len(tok.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in odd_rows)
    assert sum(r.length for r in got) == total and used == -(-total // CAPACITY)
    assert all(r.start == r.piece * CAPACITY for r in got)
    assert pack_documents(table([]), WORD).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_sweeps_place_all_in_few_sequences(seed):
    rng = np.random.default_rng(seed)
    sizes = [rng.integers(1, 2048, 3000), np.full(5000, 700), rng.integers(1, 40, 9000), np.minimum(2047, (rng.pareto(1.2, 4000) * 60 + 1)).astype(int)][seed]
    waiting = np.bincount(sizes, minlength=CAPACITY + 1)
    taken, gaps, ids, rounds = np.zeros(CAPACITY + 1, np.int64), np.zeros(CAPACITY + 1, np.int64), 0, 0
    while waiting.any():
        seen = gaps.copy()
        seen[0] = 0
        moves, opened, ids = sweep(waiting, taken, seen, CAPACITY, ids)
        for m in moves:
            gaps[m["gap"]] -= m["gaps"]
            gaps[m["gap"] - m["size"] * m["each"]] += m["gaps"]
        for m in opened:
            gaps[CAPACITY - m["size"] * m["each"]] += m["gaps"]
        assert (gaps >= 0).all()
        rounds += 1
    assert (taken == np.bincount(sizes, minlength=CAPACITY + 1)).all() and rounds < 60
    best = max(-(-sizes.sum() // CAPACITY), -(-len(sizes) // 2) if seed == 1 else 0)
    assert ids <= best * 1.05 + 1
