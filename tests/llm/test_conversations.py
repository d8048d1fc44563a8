import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablewright.llm.prefix_trie import end_digests, last_turns, numbered_turns, prefix_trie, rebuilt, turn_key

TURNS = "conv_id long, turn long, role string, text string, key string, part int, depth long"


@pytest.fixture
def said(spark):
    return lambda rows: spark.createDataFrame([(*r, "k", 3, 9) for r in rows], TURNS)


def hashed(role, text):
    return hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()


def plain(rows):
    """conv_id -> turns in order."""
    out = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            out[c].append((t is not None, t or 0, hashed(r or "", x or ""), r or "", x or ""))
    return {c: [v[3:] for v in sorted(own)] for c, own in out.items()}


def brute(convs):
    members = defaultdict(list)
    for c, path in convs.items():
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
    out = []
    for node, ids in members.items():
        under = [(n, m) for n, m in members.items() if n[: len(node)] == node]
        children = [n for n in members if len(n) == len(node) + 1 and n[:-1] == node]
        leaves = sum(not any(n[:-1] == m and len(n) for n in members) for m, _ in under)
        saved = sum((len(m) - 1) * len(n[-1][1]) for n, m in under if n)
        ends = ",".join(map(str, sorted(c for c in ids if len(convs[c]) == len(node))))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children), leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[:2], r[3]))


@pytest.fixture
def talks():
    rng = np.random.default_rng(8)
    rows = [(int(c), int(t), f"r{rng.integers(2)}", "ab"[rng.integers(2)] * int(rng.integers(3))) for c in rng.choice(4000, 300, replace=False) for t in range(rng.integers(1, 6))]
    rows += [(7000 + c, t, "u", f"same {t}") for c in range(40) for t in range(60)]
    rows += [(-300, None, None, None), (-300, 1, "x", None), (-300, 1, "x", None), (-250, 2, "a", "b"), (None, 1, "lost", "row"), (8, 5, "r1:", ""), (8, 5, "r1", ":")]
    return rows


@pytest.mark.parametrize("convs, turns", [(5, 1000), (1000, 9), (4096, 1 << 16)])
def test_trie_by_brute_force(said, talks, convs, turns):
    own = numbered_turns(said(talks))
    named = own.select("conv_id").distinct().withColumn("at", F.lit(-1).cast("long"))
    got = result_of(prefix_trie(named.unionByName(own, allowMissingColumns=True), convs, turns))
    assert got == order(brute(plain(talks)))


def result_of(trie):
    rows = trie.nodes.join(end_digests(trie), "key", "left").collect()
    nothing = hashlib.sha256(b"").hexdigest()
    return order([(r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256 or nothing) for r in rows])


def test_rebuilt_heads(said, talks):
    convs = plain(talks)
    want = {}
    for c, path in convs.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        want[c] = convs.get(base, [])[:h] + path[h:]
    assert any(not p for p in want.values())
    got = result_of(prefix_trie(rebuilt(numbered_turns(said(talks))), 50, 500))
    assert got == order(brute(want))


def test_empty_and_texts(said):
    assert result_of(prefix_trie(rebuilt(numbered_turns(said([]))))) == []
    table = said([(1, 1, "u", "hi"), (1, 2, "a", "yo" * 50_000), (2, 1, "u", "hi"), (3, 9, None, None)])
    trie = prefix_trie(numbered_turns(table))
    texts = numbered_turns(table).join(table.select(turn_key(table["role"], table["text"]).alias("key"), "text").distinct(), "key").select("conv_id", "at", "text")
    got = {(r.conv_id, r.depth): (r.n_convs, r.text) for r in last_turns(trie, texts).collect()}
    assert got == {(1, 0): (3, None), (1, 1): (2, "hi"), (1, 2): (1, "yo" * 50_000), (3, 1): (1, None)}
    assert {tuple(r.conv_ids) for r in trie.ends.collect()} == {(1,), (2,), (3,)}
