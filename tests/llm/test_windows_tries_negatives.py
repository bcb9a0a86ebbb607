"""Substring dedup, the conversation trie and hard negatives against brute force; odd rows in every column."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendspark.llm import hardneg, prefixtrie, substrings

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# substrings ----------------------------------------------------------------------------------------------------------


def brute_removed(rows, length):
    """Words left and removed of each row, window by window."""
    low = {}
    for i, t in rows:
        w = WORD.findall(t or "")
        for p in range(len(w) - length + 1):
            if i is not None:
                low[tuple(w[p:p + length])] = min(i, low.get(tuple(w[p:p + length]), i))
    out = []
    for i, t in rows:
        w = WORD.findall(t or "")
        gone = set()
        for p in range(len(w) - length + 1):
            if i is not None and low[tuple(w[p:p + length])] < i:
                gone.update(range(p, p + length))
        out.append((i, t, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def some_texts(seed, n=60, step=3):
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcde") + rng.choice("xyz") for _ in range(rng.randint(3, 40))) for _ in range(6)]
    rows = []
    for k in range(n):
        parts = [rng.choice(passages) if rng.random() < 0.5 else " ".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(1, 6))]
        rows.append((k * step % n, rng.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(5, rows[5][1]), (5, rows[7][1]), (None, rows[0][1]), (n, rows[0][1]), (n + 1, rows[0][1] + " \n"), (n + 2, None), (n + 3, ""), (n + 4, " \n\t "),
             (n + 5, "é 日本 x y   z\u0085w " * 20), (n + 6, "x é 日本 x y   z\u0085w " * 20), (n + 7, "same " * 30000), (n + 8, "same " * 30001)]
    return rows


@pytest.mark.parametrize("length", [2, 5, 12])
def test_repeated_windows_are_removed(spark, length):
    rows = some_texts(length)
    columns = "doc_id long, text string, kept int, _th string, spans int, key long, th int, p int, marks string"
    df = spark.createDataFrame([(*r, *[None] * 7) for r in rows], columns).repartition(5)
    done = substrings.remove_repeats(df, length).collect()
    got = sorted(((r.doc_id, r.text, r.n_words, r.n_removed, r.kept) for r in done), key=str)
    assert got == sorted(brute_removed(rows, length), key=str)
    for r in done:
        assert sum(s.end - s.first for s in r.spans) == r.n_removed and all(a.end < b.first for a, b in zip(r.spans, r.spans[1:]))
    assert substrings.remove_repeats(df.where("false"), length).count() == 0


def test_levels_double_until_none_survives(spark):
    rows = [(i, t) for i, t in some_texts(4, step=7)[:60]]
    got = {(r.key, r.length): (r.starts, r.later) for r in substrings.repeat_levels(spark.createDataFrame(rows, "doc_id long, text string"), 3).collect()}
    first = {}
    for i, t in sorted(rows):
        first.setdefault(tuple(WORD.findall(t)), i)
    rows = [(i, t) for i, t in rows if first[tuple(WORD.findall(t))] == i or len(WORD.findall(t)) < 3]  # the others go as a whole
    expected, length = {}, 3
    while length < 400:
        at = defaultdict(list)
        for i, t in rows:
            w = WORD.findall(t)
            for p in range(len(w) - length + 1):
                at[tuple(w[p:p + length])].append((i, p))
        for places in at.values():
            low = min(i for i, _ in places)
            for i, p in places:
                if max(j for j, _ in places) > low:
                    known = expected.setdefault((i, length), ([], []))
                    known[0].append(p)
                    if i > low:
                        known[1].append(p)
        length *= 2
    assert got == {k: (sorted(a), sorted(b)) for k, (a, b) in expected.items()}
    assert max(n for _, n in got) >= 12


# trie ----------------------------------------------------------------------------------------------------------------


def brute_trie(turns, heads=6, group=100):
    """Nodes by prefix, from (conv, turn, role, text)."""
    own = defaultdict(list)
    for c, t, r, x in turns:
        if c is not None:
            r, x = r or "", x or ""
            digest = hashlib.md5(f"{len(r)}:{r}{x}".encode()).hexdigest()
            own[c].append(((t is not None, t or 0), digest, r, x))
    own = {c: [v[2:] for v in sorted(own[c])] for c in own}
    seq = {}
    for c, mine in own.items():
        h = zlib.crc32(str(c).encode()) % heads
        seq[c] = tuple(own.get(c - c % group, [])[:h] + mine[h:])
    members = defaultdict(list)
    for c, s in seq.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    out = []
    for p, m in members.items():
        below = [q for q in members if q[:len(p)] == p]
        ends = ",".join(str(c) for c in sorted(m) if seq[c] == p)
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), sum(not kids[q] for q in below),
                    sum((len(members[q]) - 1) * len(q[-1][1]) for q in below if q), hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed):
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 40), *range(100, 130), 205, 207, 209, 70_000, 70_001, 140_000]:
        for t in range(rng.randint(0 if c == 205 else 1, 9)):
            rows.append((c, None if rng.random() < 0.1 else t, rng.choice(["u", "a", None]), rng.choice(["", "x", "yé", "long text", None])))
    rows += [(c, 0, "u", "the same") for c in range(300, 340)] + [(500, t, "u", "x") for t in range(40)] + [(501, t, "u", "x") for t in range(60)]
    rows += [(600, t % 3, "r", f"{t}") for t in range(12)] + [(600, 1, "r", "1"), (None, 0, "u", "nobody"), (101, 3, "ab", "c"), (102, 3, "a", "bc")]
    rows += [(2000 + k, 0, f"{k}", f"first {k}") for k in range(400)] + [(2000 + k, 1, "u", "x") for k in range(0, 400, 7)]
    return rows


@pytest.mark.parametrize("part", [1, 7, 10_000])
def test_trie_equals_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(prefixtrie, "PART", part)
    monkeypatch.setattr(prefixtrie, "BUCKET", 1 if part == 7 else 16)
    rows = conversations(part)
    df = spark.createDataFrame([(*r, None, 5) for r in rows], "conv_id long, turn long, role string, text string, key int, turns int").repartition(3)
    got = prefixtrie.trie(prefixtrie.rebuilt(df))
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert got.columns == names
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_trie(rows)
    assert prefixtrie.trie(prefixtrie.rebuilt(df.where("false"))).count() == 0


def test_radix_tree_layouts():
    rng = random.Random(2)
    for width in (3, 10, 40, 200, 256):
        keys = {bytes(rng.randrange(width) for _ in range(rng.choice([1, 2, 2, 3]))) for _ in range(900)} | {b""}
        tree = prefixtrie.Tree()
        for k in rng.sample(sorted(keys), len(keys)):
            tree.insert(k, k)
        found, kinds, stack = set(), set(), [(tree.root, b"")]
        while stack:
            node, at = stack.pop()
            at += node.path
            kinds.add(node.kind)
            if node.end is not None:
                assert node.end == at
                found.add(at)
            kids = [(b, node.find(b)) for b in range(256) if node.find(b) is not None]
            assert len(kids) == len(node.children()) <= (node.kind or 0)
            assert node.end is not None or len(kids) > 1  # single-child paths are compressed
            stack += [(c, at + bytes([b])) for b, c in kids]
        assert found == keys and max(kinds) == {3: 4, 10: 16, 40: 48, 200: 256, 256: 256}[width]


# hard negatives ------------------------------------------------------------------------------------------------------


def brute_negatives(rows, anchors, positives=5, negatives=5):
    usable = {}
    for i, label, vec in rows:
        if i is None or label is None or vec is None or any(x is None or not np.isfinite(x) for x in vec):
            continue
        whole = [int(np.floor(256 * np.float64(x))) for x in vec]
        if i not in usable or (label, list(vec)) < usable[i][0]:
            usable[i] = ((label, list(vec)), label, whole)
    out = []
    for a in sorted(usable):
        if not anchors(a):
            continue
        _, label, x = usable[a]
        scored = sorted((-sum(p * q for p, q in zip(x, y)), i, other) for i, (_, other, y) in usable.items() if i != a and len(y) == len(x))
        for p, i, _ in [s for s in scored if s[2] == label][:positives]:
            near = [s for s in scored if s[2] != label and 80 * -p <= 100 * -s[0] <= 100 * -p][:negatives]
            out += [(a, i, rank + 1, j, -p, -s) for rank, (s, j, _) in enumerate(near)]
    return out


def vectors(seed, n=400, d=9):
    rng = np.random.default_rng(seed)
    rows = [(k, int(rng.integers(0, 4)), [float(v) for v in np.float32(rng.normal(size=d) * 0.3)]) for k in range(n)]
    rows += [(n + k, k % 4, rows[k % 7][2]) for k in range(60)]  # copies and ties
    rows += [(900, 1, None), (901, None, rows[1][2]), (902, 1, [None] * d), (903, 1, [float("nan")] * d), (904, 2, [float("inf")] + [0.0] * (d - 1)),
             (905, 1, [0.0] * d), (910, 1, [0.0] * d), (906, 1, [0.5, 0.25]), (920, 2, [0.5, 0.25]), (907, 1, [0.5, 0.5]), (908, 1, []), (909, 2, []), (930, 1, []),
             (None, 1, rows[0][2]), (3, 2, rows[9][2]), (5, *rows[5][1:]), (5, *rows[5][1:])]
    return rows


@pytest.mark.parametrize("wave", [32_000_000, 4_000])
def test_hard_negatives_equal_brute_force(spark, monkeypatch, wave):
    monkeypatch.setattr(hardneg, "WAVE_BYTES", wave)
    monkeypatch.setattr(hardneg, "TILE", 16)
    rows = vectors(3)
    df = spark.createDataFrame([(*r, 7, "x", None) for r in rows], "vec_id long, label int, embedding array<float>, id int, score string, place long").repartition(4)
    got = hardneg.hard_negatives(df, F.col("id") % 10 == 0)
    single = [(i, y, None if v is None else [None if x is None else float(np.float32(x)) for x in v]) for i, y, v in rows]
    assert sorted(map(tuple, got.collect())) == sorted(brute_negatives(single, lambda a: a % 10 == 0))
    assert hardneg.hard_negatives(df.where("false"), F.col("id") % 10 == 0).count() == 0
    assert hardneg.hard_negatives(df.where("label = 1"), F.col("id") % 10 == 0).count() == 0


def test_strassen_is_exact():
    rng = np.random.default_rng(0)
    for m, k, n in [(1, 1, 1), (33, 70, 100), (65, 67, 129), (128, 64, 300), (40, 33, 33)]:
        a, b = rng.integers(-10 ** 6, 10 ** 6, (m, k)), rng.integers(-10 ** 6, 10 ** 6, (k, n))
        assert (hardneg.strassen(a, b) == a @ b).all()
    big = np.array([[2.0 ** 40, 3.0], [1e300, 1.0]])
    assert hardneg.products(big, big).tolist() == [[(1 << 63) - 1] * 2] * 2
    assert hardneg.products(np.array([[2.0 ** 40]]), np.array([[-2.0 ** 22]])).tolist() == [[-(1 << 62)]]
    assert np.isfinite(hardneg.whole([1.7e308, -1.7e308])).all()
