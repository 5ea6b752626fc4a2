"""Lexical search, k-d shards and conversation repair against brute force, and their edge cases."""

import os
import random
import sys
import zlib
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute_repair  # noqa: E402
import edge  # noqa: E402

from ledgermill.llm import kd_shards, lexical, repair  # noqa: E402

# Lexical search

ITEMS = edge.ITEMS


def brute_search(docs, items, k):
    def terms(text):
        return bytes(c + 32 if 65 <= c <= 90 else c if c > 127 or chr(c).isalnum() else 32
                     for c in (text or "").encode()).decode().split()

    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    rows = [(i, Counter(terms(t))) for i, t in docs]
    rows = [(i, c, sum(c.values())) for i, c in rows if c]
    n, length = len(rows), sum(r[2] for r in rows)
    df = Counter(t for _, c, _ in rows for t in c)
    out = []
    for item, wanted in queries.items():
        found = []
        for i, c, size in rows:
            m = 100 - 50 + (50 * size * n) // length
            score = sum(lexical.weight(df[t], n) * ((1_000_000_000 * c[t]) // (1000 * c[t] + 20 * m))
                        for t in wanted if t in c)
            if score > 0:
                found.append((-score, i is None, i or 0))
        out += [(item, rank, None if null else i, -s) for rank, (s, null, i) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("k", [1, 3, 50])
def test_search(spark, docs, monkeypatch, k):
    monkeypatch.setattr(lexical, "BLOCK", 4)  # several blocks
    monkeypatch.setattr(lexical, "POSTINGS", 100)  # several segments
    items = spark.createDataFrame(ITEMS, "item_id long, text string").repartition(2)
    got = [tuple(r) for r in lexical.search(docs, items, k).collect()]
    want = brute_search([(r.doc_id, r.text) for r in docs.collect()], ITEMS, k)
    assert sorted(got, key=repr) == want


def test_search_of_nothing(spark, empty_dir, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.read.parquet(f"{empty_dir}/documents.parquet")
    assert lexical.search(none, items).collect() == [] and lexical.search(docs, items.limit(0)).collect() == []


@pytest.mark.parametrize("leaf", [1, 4])
def test_intervals(monkeypatch, leaf):
    """Intervals find what scoring every document finds, with and without ties."""
    monkeypatch.setattr(lexical, "LEAF", leaf)
    monkeypatch.setattr(lexical, "STEP", 3)
    rng = np.random.default_rng(5)
    for trial in range(30):
        size, terms = int(rng.integers(1, 60)), int(rng.integers(1, 9))
        tf = rng.integers(0, 4 if trial % 2 else 2, (size, terms))
        n = tf.sum(1) + (3 if trial % 3 else rng.integers(1, 50, size))
        weights = rng.integers(0, 3, terms) * 500
        at = np.nonzero(tf)
        segment = lexical.Segment(n, np.concatenate([[0], np.cumsum((tf > 0).sum(1))]), at[1].astype(np.int32),
                                  tf[at], weights, size, int(n.sum()))
        segment.null, segment.ids = np.zeros(size, bool), rng.permutation(size)
        best = lexical.Best(5)
        segment.search(np.flatnonzero(weights), best)
        m = 50 + (50 * n * size) // n.sum()
        scores = (weights * ((1_000_000_000 * tf) // np.maximum(1000 * tf + 20 * m[:, None], 1))).sum(1)
        want = sorted((-s, i) for s, i in zip(scores.tolist(), segment.ids.tolist()) if s > 0)[:5]
        assert list(zip((-best.score).tolist(), best.id.tolist())) == want


# Shards


def brute_tree(points, shards, dims, whole=None, first=0):
    """{(group, piece): shard}"""
    if shards == 1 or not points:
        return {(g, p): first for _, g, p, _ in points}
    extent = [max(x[d] for x, *_ in points) - min(x[d] for x, *_ in points) for d in range(dims)]
    whole = whole or [max(e, 1) for e in extent]
    dim = max(range(dims), key=lambda d: (extent[d] / whole[d], -d))
    points = sorted(points, key=lambda t: (t[0][dim], t[1], t[2]))
    total, left, before = sum(t[3] for t in points), shards // 2, 0
    goal = total * left // shards
    for at, t in enumerate(points):
        if before + t[3] > goal or at + 1 == len(points):
            break
        before += t[3]
    takes = abs((before + t[3]) * shards - total * left) < abs(before * shards - total * left)
    cut = at + takes
    return {**brute_tree(points[:cut], left, dims, whole, first),
            **brute_tree(points[cut:], shards - left, dims, whole, first + left)}


@pytest.mark.parametrize("shards,bins", [(2, 2048), (5, 4), (16, 3)])
def test_tree(spark, monkeypatch, shards, bins):
    monkeypatch.setattr(kd_shards, "BINS", bins)
    monkeypatch.setattr(kd_shards, "LEVELS", 2)
    rng = random.Random(shards)
    points = [([rng.choice([0, 5, 5, 9]), rng.randint(-40, 40), rng.choice([-(1 << 62), 1 << 61])],
               rng.randrange(1 << 63) if i % 3 else 77, i, rng.randint(1, 30)) for i in range(120)]
    table = spark.createDataFrame(points, "x array<long>, x11_group long, x11_piece int, w long").repartition(3)
    got = {(r.x11_group, r.x11_piece): r.shard for r in kd_shards.tree(table, shards, 3).collect()}
    assert got == brute_tree([(tuple(x), g, p, w) for x, g, p, w in points], shards, 3)


def check_shards(rows, shards, slack):
    sizes = [0] * shards
    slots = {}
    for r in rows:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(sizes) - min(sizes) <= slack, sizes


def test_shards(spark, docs, monkeypatch):
    monkeypatch.setattr(kd_shards, "BUCKET", 7)
    rows = kd_shards.shard(docs, kd_shards.dimensions(), shards=4, carry=("doc_id", "text")).collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in docs.collect())
    for r in rows:
        data = (r.text or "").encode()
        assert (r.size, r.text_crc32) == (len(data) + 1, zlib.crc32(data))
    check_shards(rows, 4, 2 * max(r.size for r in rows))
    of_text = {}
    for r in rows:
        of_text.setdefault(r.text or "", set()).add(r.shard)
    assert all(len(s) == 1 for s in of_text.values())


def test_shards_of_copies(spark):
    """A text that fills a third of the table, by bytes or by rows, is spread; sizes stay equal."""
    rng = random.Random(3)
    texts = ["copied words " * 20] * 1000 + [""] * 1000 + [
        "".join(rng.choice("abcdef ") for _ in range(rng.randint(100, 900))) for _ in range(1000)]
    table = spark.createDataFrame([(i % 50, t, "en", f"s{i % 3}") for i, t in enumerate(texts)],
                                  "doc_id long, text string, lang string, source string").repartition(4)
    rows = kd_shards.shard(table, kd_shards.dimensions(), shards=8).collect()
    assert len(rows) == len(texts)
    check_shards(rows, 8, 2 * 901 + sum(map(len, texts)) // 8 // 20)


def test_shards_by_bytes_and_of_nothing(spark, docs, empty_dir):
    dims = kd_shards.dimensions()
    total = sum(len((r.text or "").encode()) + 1 for r in docs.collect())
    rows = kd_shards.shard(docs, dims, target_bytes=total // 3 + 1).collect()
    assert {r.shard for r in rows} == {0, 1, 2}
    none = spark.read.parquet(f"{empty_dir}/documents.parquet")
    assert kd_shards.shard(none, dims, shards=16).collect() == []
    assert kd_shards.shard(none, dims, target_bytes=10).collect() == []
    many = kd_shards.shard(docs.limit(3), dims, shards=16).collect()  # fewer points than shards
    assert len(many) == 3 and all(0 <= r.shard < 16 for r in many)


# Conversation repair


def conversations():
    rng = random.Random(13)
    texts = ["Yes.", "No!", "Why?", "cut off", "", " \n", "Long text. " * 50, None, "é ß 日本."]
    roles = ["user", "assistant", "system", "tool", None, "User", "", "sys"]
    out = []
    for conv in range(40):
        role = 0
        for turn in range(rng.randint(1, 12)):
            role = (role + 1) % 2 if rng.random() < 0.8 else rng.randrange(len(roles))
            at = turn * (1 if conv % 4 else 3)
            out.append((conv, at, roles[role], rng.choice(texts) if conv % 3 else f"Turn {turn}."))
    out += [(None, 1, "user", "No id."), (None, 2, "assistant", "Nor this."), (50, None, "user", "No turn."),
            (50, None, "assistant", "Again none."), (50, 4, "user", "Four."), (50, 4, "user", "Four."),
            (50, 4, "assistant", "Also four."), (50, 9, "assistant", "Nine")]
    dropped = next(c for c in range(100, 999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    out.append((dropped, 0, "user", "This row goes."))
    out += [(60, t, "user" if t % 2 else "assistant", f"Turn {t}." if t % 5 else "Same.") for t in range(300)]
    return out


@pytest.fixture(scope="module")
def turns(spark):
    schema = "conv_id long, turn long, role string, text string, audit string, n long, phase string"
    return spark.createDataFrame([(*r, "x", 1, "y") for r in conversations()], schema).repartition(3)


@pytest.mark.parametrize("chunk", [3, 1 << 16])
def test_repair(spark, turns, monkeypatch, chunk):
    monkeypatch.setattr(repair, "CHUNK", chunk)
    monkeypatch.setattr(repair, "PAIRS", 2)
    hashed = repair.keyed(repair.damaged(turns)).collect()
    order = {(r.role, r.text): (r.h1, r.h2) for r in hashed}
    got = {r.conv_id: tuple(r)[1:] for r in repair.repaired(repair.damaged(turns), turns).collect()}
    assert got == brute_repair.repair(conversations(), order.get)


def test_repair_repeated_row(spark, monkeypatch):
    """One row repeated more often than a chunk holds."""
    monkeypatch.setattr(repair, "CHUNK", 5)
    rows = [(1, 1, "user", "Same."), (1, 2, "assistant", "Good.")] + [(1, 2, "assistant", "Good.")] * 23
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = tuple(repair.repaired(table, table).collect()[0])
    assert got[:8] == (1, 0, 0, 23, 0, 23, 46, "KK" + "D" * 23)


def test_repair_of_nothing(spark, turns):
    none = turns.limit(0)
    assert repair.repaired(repair.damaged(none), none).collect() == []


def test_grammar():
    """Rules expand to the sequences they came from, and a product's costs and audits are the least."""
    rng = np.random.default_rng(2)
    seqs = [rng.integers(0, 9, n).astype(np.uint8) for n in (1, 2, 3, 50, 400)] + [
        np.full(33, 8, np.uint8), np.tile([1, 2], 40).astype(np.uint8)]
    rules, rest = repair.repair_pairs(seqs)
    assert rules

    def expand(s):
        return [s] if s < 9 else [x for part in rules[s - 9] for x in expand(part)]

    assert [[x for s in r for x in expand(int(s))] for r in rest] == [s.tolist() for s in seqs]
    names = {0: "system", 1: "user", 2: "assistant", 3: "tool"}
    for seq, matrix in zip(seqs, repair.matrices(seqs)):
        cost, rope, inserts = repair.best_end(matrix[0])
        rows = [(i, names[s % 4], "" if s == 8 else f"t{i}" + ("" if s >= 4 else ".")) for i, s in enumerate(seq.tolist())]
        want = brute_repair.solve(rows)
        assert (cost, repair.flat(rope).decode() + "I" * inserts) == want[1:3]
