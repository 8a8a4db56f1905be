"""Merkle manifest, repeated strings and hard negatives against brute-force versions, with edge cases."""

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from barloom.llm import hard_negatives, merkle, suffix_dedup


# Repeated strings ---------------------------------------------------------------------------------

def brute_repeats(docs, length):
    """(n_bytes, spans, kept) of each (id, mark, text)."""
    seen, out = set(), {}
    for i, mark, text in sorted(set(docs)):
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - length + 1):
            string = data[s:s + length]
            if string in seen:
                gone[s:s + length] = True
            seen.add(string)
        edges = np.flatnonzero(np.diff(np.append(False, gone).astype(int)))
        out[i, text] = (len(data), tuple(zip(edges[::2].tolist(), edges[1::2].tolist())),
                        bytes(c for c, g in zip(data, gone) if not g))
    return out


def check_repeats(spark, rows, length):
    df = spark.createDataFrame([(t, i, 1, "x") for i, t in rows],
                               "text string, doc_id long, id int, spans string")
    marks = {r["text"]: r["m"] for r in df.select("text", F.xxhash64("text").alias("m")).collect()}

    def known(i):
        return suffix_dedup.LAST_ID if i is None else i
    want = brute_repeats([(known(i), marks[t], t or "") for i, t in rows], length)
    got = Counter((r["doc_id"], r["n_bytes"], tuple(tuple(s) for s in r["spans"]), bytes(r["kept"]))
                  for r in suffix_dedup.remove_repeats(df, length).collect())
    assert got == Counter((i, *want[known(i), t or ""]) for i, t in rows)


def repeat_rows():
    rng = random.Random(1)

    def words(n):
        return " ".join(f"w{rng.randrange(400)}" for _ in range(n))
    passage = words(60)
    rows = [(k, words(rng.randrange(5, 120)) + (
        f" {passage[rng.randrange(80):rng.randrange(150, 300)]} " if k % 2 else "")
        + words(rng.randrange(60))) for k in range(150)]
    rows += [(200 + k, rows[k][1]) for k in range(0, 30, 3)]
    for k in range(40):
        held = rows[k][1].split()
        held[rng.randrange(len(held))] = "zzz"
        rows.append((300 + k, " ".join(held)))
    again = words(80)
    rows += [(None, "a" * 1000), (None, "b" * 5), (500, "é" * 400), (501, "ab" * 300), (502, "ab" * 300),
             (502, "ab" * 300), (502, again), (503, None), (504, ""), (505, "a" * 99), (506, "a" * 100),
             (507, "a" * 101), (508, "\0" * 150), (509, "x" + "\0" * 149), (-1, again)]
    rng.shuffle(rows)
    return rows


def test_repeats_against_brute_force(spark):
    check_repeats(spark, repeat_rows(), 100)
    check_repeats(spark, repeat_rows(), 40)
    check_repeats(spark, [], 100)


def test_repeats_of_a_trigger_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK_ENTRIES", 7)
    check_repeats(spark, repeat_rows(), 100)


def test_a_long_text_parses_alike_in_pieces(monkeypatch):
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(50)}" for _ in range(3000)) + "-" * 500
    whole = list(suffix_dedup._parse(pa.array([text]), 100))
    monkeypatch.setattr(suffix_dedup, "SLICE_BYTES", 1000)
    pieces = list(suffix_dedup._parse(pa.array([text]), 100))
    assert len(whole) == 1 and len(pieces) > 10

    def triggers(parts):
        return {s: (t, k) for _, *part in parts for lo, hi, t, k in zip(*part) for s in range(lo, hi + 1)}
    assert triggers(whole) == triggers(pieces)
    # Each start has the leftmost trigger with the smallest hash inside its string.
    assert set(triggers(whole)) == set(range(len(text) - 99))
    assert all(0 <= t - s <= 100 - 33 for s, (t, _) in triggers(whole).items())


# Manifest -----------------------------------------------------------------------------------------

def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def plain_tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 3])) for k in range(0, len(levels[-1]), 3)])
    return levels


def plain_path(levels, at):
    out = []
    for level in levels[:-1]:
        out.append((at % 3, level[at // 3 * 3:at // 3 * 3 + 3]))
        at //= 3
    return out


def plain_manifest(rows):
    groups = {}
    for g, k, leaf, new in rows:
        groups.setdefault(g, []).append((k is not None, k or 0, leaf, new or ""))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: plain_tree([r[2] for r in sorted(groups[g])]) for g in names}
    crown = plain_tree([trees[g][-1][0] for g in names])
    out = []
    for at_group, g in enumerate(names):
        for at, (known, key, leaf, new) in enumerate(sorted(groups[g])):
            path = plain_path(trees[g], at) + plain_path(crown, at_group)
            value = new or leaf
            for slot, run in path:
                value = sha("".join(value if k == slot else s for k, s in enumerate(run)))
            out.append((g, key if known else None, at, leaf, trees[g][-1][0], crown[-1][0],
                        tuple(s for slot, run in path for k, s in enumerate(run) if k != slot), value,
                        value == crown[-1][0]))
    return sorted(out, key=repr)


def check_manifest(spark, rows, height=merkle.HEIGHT):
    df = spark.createDataFrame([(*r, "x", 1) for r in rows],
                               "group string, key long, leaf string, new string, root string, chunk int")
    found = merkle.manifest(df, new_leaf_col="new", height=height)
    got = [(*r[:6], tuple(r["siblings"]), *r[7:]) for r in found.leaves.collect()]
    want = plain_manifest(rows) if rows else []
    assert sorted(got, key=repr) == want
    assert {tuple(r) for r in found.groups.collect()} == {
        (g, sum(r[0] == g for r in rows), sub, root) for g, _, _, _, sub, root, *_ in want}


def manifest_rows(sizes):
    rng = random.Random(2)
    rows = [(None, None, sha("alone"), None), ("é", 1, sha("twice"), None), ("é", 1, sha("twice"), None)]
    for g, n in sizes.items():
        for k in range(n):
            leaf = sha(f"{g}{k}")
            rows.append((g, rng.choice([k, k // 2]), leaf, sha("x" + leaf) if rng.random() < .3 else None))
    rng.shuffle(rows)
    return rows


def test_manifest_against_plain_trees(spark):
    check_manifest(spark, manifest_rows({"a": 1, "b": 3, "": 10, "z": 244, "hot": 2200}))
    check_manifest(spark, manifest_rows({f"s{k}": 1 + 7 * k % 40 for k in range(30)}), height=1)
    check_manifest(spark, manifest_rows({f"s{k}": 1 + k for k in range(12)} | {"hot": 100}), height=2)
    check_manifest(spark, [])
    check_manifest(spark, [("a", 1, sha("1"), sha("2"))])


def test_leaf_and_retained_states(spark):
    row = spark.createDataFrame([(1, None, "é\n")], "k long, s string, t string").select(
        merkle.leaf(F.col("k"), F.col("s"), F.col("t"))).first()
    assert row[0] == sha("1:1-3:é\n")
    run = [sha(str(k)) for k in range(3)]
    parent = merkle.Parent(run)
    assert parent.digest == sha("".join(run)) == parent.fold(1, run[1])
    assert parent.fold(0, "q") == sha("q" + run[1] + run[2]) and parent.fold(2, "q") == sha(run[0] + run[1] + "q")
    assert parent.siblings(1) == [run[0], run[2]]


# Hard negatives -----------------------------------------------------------------------------------

def plain_negatives(rows, every):
    known = {(i, str(label), tuple(math.floor(256 * x) for x in v)) for i, label, v in rows
             if i is not None and label is not None and v
             and all(x is not None and math.isfinite(x) and abs(256 * x) <= 1 << 26 for x in v)}
    out = []
    for a in known:
        if a[0] % every:
            continue

        def first(some, n):
            scored = [(-sum(x * y for x, y in zip(a[2], r[2])), r[0]) for r in some if len(r[2]) == len(a[2])]
            return sorted(scored)[:n] if n else sorted(scored)
        for score, positive in first([r for r in known if r != a and r[1] == a[1]], 5):
            fit = [(s, i) for s, i in first([r for r in known if r[1] != a[1]], None)
                   if 50 * -score <= 100 * -s <= 95 * -score]
            out += [(a[0], positive, k + 1, i, -score, -s) for k, (s, i) in enumerate(fit[:3])]
    return sorted(out)


def test_hard_negatives_against_brute_force(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, rng.randrange(3), [rng.gauss(0, 1) if rng.random() < .9 else 0.5 for _ in range(4)])
            for k in range(200)]
    rows += [(k + 200, 1, rows[k][2]) for k in range(30)]
    rows += [(None, 1, [1.0] * 4), (300, None, [1.0] * 4), (305, 1, None), (310, 1, []),
             (315, 1, [1.0, None, 1.0, 1.0]), (320, 1, [math.nan] * 4), (325, 1, [1.0] * 3),
             (330, 2, [.9] * 3), (331, 1, [.99] * 3), (335, 1, [math.inf] * 4), (340, 1, [-1000.0] * 4),
             (345, 1, [1e300] * 4), (350, 1, [0.0] * 4), rows[0], rows[5]]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows],
                               "vec_id long, label int, embedding array<double>, id int, parts string")
    want = plain_negatives(rows, 5)
    assert len(want) > 300
    for blocks in ((16_384, 2_048), (16, 8)):
        monkeypatch.setattr(hard_negatives, "ROW_BLOCK", blocks[0])
        monkeypatch.setattr(hard_negatives, "ANCHOR_BLOCK", blocks[1])
        got = hard_negatives.hard_negatives(df, F.col("vec_id") % 5 == 0)
        assert sorted(tuple(r) for r in got.collect()) == want
    assert hard_negatives.hard_negatives(df.filter("vec_id < 0"), F.col("vec_id") % 5 == 0).count() == 0


def test_packed_rows_give_exact_scores():
    rng = np.random.default_rng(5)
    for top in (1, 300, 1 << 26):
        rows, anchors = rng.integers(-top, top + 1, (50, 7)), rng.integers(-top, top + 1, (6, 7))
        packed = hard_negatives.PackedRows(rows, int(np.abs(anchors).sum(axis=1).max()))
        for anchor in anchors:
            assert packed.scores(anchor.tolist()).tolist() == (rows @ anchor).tolist()
