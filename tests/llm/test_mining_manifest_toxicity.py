"""Hard negatives, the Merkle manifest and toxicity: brute force on small tables and the stated edge cases."""

import math
import random
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from demandloom.llm import hard_negatives, merkle, toxicity

VECTORS = "id long, label long, vector array<float>, row string, angle string, part int"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, tree string, place string, node int"


# Hard negatives


def vector_rows():
    """Clusters, copies, ties, zero and empty vectors, nulls, infinite and huge components, repeated ids."""
    pick = random.Random(5)
    rows, at = [], 0
    for cluster in range(4):
        centre = [pick.gauss(0, 1) for _ in range(12)]
        for _ in range(90):
            rows.append((at, pick.randrange(3) if cluster else 0, [c + pick.gauss(0, 0.4) for c in centre]))
            at += 1
    rows += [(at + i, i % 3, rows[7][2]) for i in range(40)]
    at += 40
    rows += [(at, 1, [0.0] * 12), (at + 1, 2, []), (at + 2, 1, [1.0, 2.0]), (at + 3, None, [1.0] * 12), (at + 4, 1, None)]
    rows += [(at + 5, 1, [None] * 12), (at + 6, 1, [math.nan] * 12), (at + 7, 1, [math.inf] * 12), (None, 2, rows[3][2])]
    rows += [rows[50], (at + 8, 9, [0.5] * 12)]
    return [(*r, "x", None, i) for i, r in enumerate(rows)]


def brute_negatives(rows, every=10):
    alive = []
    for row_id, label, vector, *_ in rows:
        if label is None or vector is None or any(x is None or not math.isfinite(x) for x in vector):
            continue
        whole = [math.floor(256 * float(np.float32(x))) for x in vector]
        alive.append((row_id, label, whole + [0] * (12 - len(whole))))
    found = []
    first = lambda s: (-s[0], s[1] is None, s[1] or 0)
    for a, (anchor, label, vector) in enumerate(alive):
        if anchor is None or anchor % every:
            continue
        scored = [(sum(x * y for x, y in zip(vector, v)), i, k) for b, (i, k, v) in enumerate(alive) if b != a]
        positives = sorted((s for s in scored if s[2] == label), key=first)[:5]
        for score, positive, _ in positives:
            fit = [s for s in scored if s[2] != label and 50 * score <= 100 * s[0] <= 95 * score]
            for rank, (value, negative, _) in enumerate(sorted(fit, key=first)[:3], 1):
                found.append((anchor, positive, rank, negative, score, value))
    return Counter(found)


def mined(spark, rows, every=10):
    table = spark.createDataFrame(rows, VECTORS)
    return Counter(tuple(r) for r in hard_negatives.mine(table, F.col("id") % every == 0).collect())


@pytest.mark.parametrize("block", [256, 8])
def test_negatives_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block)
    monkeypatch.setattr(hard_negatives, "SLAB_ROWS", 16)
    rows = vector_rows()
    assert mined(spark, rows) == brute_negatives(rows)


def test_negatives_of_empty_and_single_tables(spark):
    assert not mined(spark, [])
    assert not mined(spark, [(0, 1, [1.0], None, None, 0)])
    assert not mined(spark, [(0, None, None, None, None, 0)])


def test_bounds_hold_and_products_are_exact():
    pick = np.random.default_rng(2)
    vectors = np.floor(256 * pick.normal(size=(300, 16)))
    vectors[:40] = vectors[40] + pick.integers(-2, 3, size=(40, 16))
    references = hard_negatives.choose_references(vectors[::3])
    seen, norms = hard_negatives.angles(vectors, references)
    exact = vectors.astype(int) @ vectors.astype(int).T
    for a in range(0, 300, 20):
        part = slice(a, a + 20)
        low, high = seen[part].min(axis=0), seen[part].max(axis=0)
        bottom, top = hard_negatives.score_bounds(seen, norms, low, high, (norms[part].min(), norms[part].max()))
        assert (exact[:, part] <= top[:, None]).all() and (exact[:, part] >= bottom[:, None]).all()
    near = hard_negatives.score_bounds(seen[:1], norms[:1], seen[100:101].min(axis=0), seen[100:101].max(axis=0), (norms[100],) * 2)
    assert near[1][0] < norms[0] * norms[100]
    for scale in (1, 1 << 20, 1 << 28):
        left, right = vectors[:9] * scale, vectors[9:20] * scale
        want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in right] for u in left]
        held = np.clip(np.array(want, object), -hard_negatives.LIMIT, hard_negatives.LIMIT).tolist()
        largest = float(np.linalg.norm(left, axis=1).max() * np.linalg.norm(right, axis=1).max())
        assert hard_negatives.exact_products(left, right, largest + 1).tolist() == held


# Merkle manifest


def digest(text):
    return sha256(text.encode()).hexdigest()


def brute_leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row[:5]
    n_chars = None if n_chars is None else n_chars + more
    fields = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return digest("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in fields))


def brute_tree(leaves):
    """Root, and for each leaf its siblings with their sides; None where a node rises alone."""
    paths, level, owners = [[] for _ in leaves], list(leaves), [[i] for i in range(len(leaves))]
    while len(level) > 1:
        above, under = [], []
        for i in range(0, len(level), 2):
            pair = level[i : i + 2]
            above.append(digest("".join(pair)))
            under.append(sum(owners[i : i + 2], []))
            for k, side in enumerate("RL"[: len(pair)]):
                for leaf in owners[i + k]:
                    paths[leaf].append((side, pair[1 - k]) if len(pair) == 2 else None)
        level, owners = above, under
    return level[0], paths


def brute_manifest(rows):
    trees = defaultdict(list)
    for row in rows:
        trees[row[2]].append(row)
    order = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    small = lambda r: (r[0] is not None, r[0] or 0, brute_leaf(r))
    found = {k: brute_tree([brute_leaf(r) for r in sorted(trees[k], key=small)]) for k in order}
    root, tops = brute_tree([found[k][0] for k in order])
    out = []
    for k, top in zip(order, tops):
        for row, path in zip(sorted(trees[k], key=small), found[k][1]):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            node = brute_leaf(row, 1 if bad else 0)
            for step in path + top:
                node = digest(node) if step is None else digest(node + step[1] if step[0] == "R" else step[1] + node)
            proof = digest("".join(s[1] for s in path + top if s))
            out.append((row[0], brute_leaf(row), found[k][0], root, proof, node, node == root))
    return sorted(out, key=str)


def manifest_rows(many=90):
    pick = random.Random(9)
    rows = [
        (i * 3 - 20, "ä" * pick.randrange(5) if i % 7 else None, pick.choice(["en", "en", "en", "de", "Ü", "", None]),
         pick.choice(["a", None]), pick.choice([None, i, 2**63 - 1]), "t", None, i)
        for i in range(many)
    ]
    return [*rows, (None, None, None, None, None, None, None, None), rows[4], (rows[5][0], "other", *rows[5][2:]), (7, "x " * 200_000, "en", "a", 4, "", "", 0)]


def tampered():
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0


@pytest.mark.parametrize("levels", [1, 2, 10])
def test_manifest_matches_brute_force(spark, levels):
    rows = manifest_rows()
    got = merkle.manifest(spark.createDataFrame(rows, DOCS), tampered(), levels)
    assert sorted(map(tuple, got.collect()), key=str) == brute_manifest(rows)


def test_manifest_of_few_rows(spark):
    for many in (0, 1):
        rows = manifest_rows()[:many]
        got = merkle.manifest(spark.createDataFrame(rows, DOCS), tampered())
        assert sorted(map(tuple, got.collect()), key=str) == (brute_manifest(rows) if rows else [])


def test_witnesses_grow_with_the_appends():
    leaves = [bytes([i]) * 32 for i in range(11)]
    appender = merkle.Appender(11, 4)
    for at, leaf in enumerate(leaves):
        appender.append(leaf)
        # Open subtrees are the powers of two in the number of leaves; witnesses reach their height.
        assert [1 << h for h, _, _ in appender.stack] == [1 << b for b in range(5, -1, -1) if (at + 1) >> b & 1]
        for height, root, first in appender.stack:
            for leaf_at in range(first, first + (1 << height)):
                assert merkle.folded(leaves[leaf_at], appender.steps[leaf_at, :height].tobytes()) == root
    root, steps = appender.close()
    assert root.hex() == brute_tree([x.hex() for x in leaves])[0]
    assert all(merkle.folded(x, w.tobytes()) == root for x, w in zip(leaves, steps))


# Toxicity

WORDS = "the of and rain stone river light under winter green house over small bread".split()
BAD = "grumbol zatchek".split()


def judged_rows(many=240, seed=3):
    pick = random.Random(seed)
    rows, labels = [], []
    for i in range(many):
        toxic = i % 4 == 0
        words = [pick.choice(WORDS) + pick.choice(["", "s", "ed"]) for _ in range(pick.randrange(4, 40))]
        if toxic:
            words[pick.randrange(len(words))] = pick.choice(BAD) + pick.choice(["o", "ing", "s"])
        rows.append((i, " ".join(words).capitalize() + ".", None, None, None, "x", None, i))
        labels.append((i, int(toxic)))
    return rows, labels


def brute_grams(text):
    raw = b" " + " ".join((text or "").split()).encode() + b" "
    raw = bytes(c + 32 if 65 <= c <= 90 else c for c in raw)
    return Counter(raw[i : i + 5] for i in range(len(raw) - 4))


def test_grams_are_runs_of_five_bytes():
    texts = ["Ab  cd\n\te ", "", None, "a", "Ünï çødé ß", "abc", "x" * 3000]
    owner, run = toxicity.grams(pa.array(texts))
    for at, text in enumerate(texts):
        got = Counter(int(x).to_bytes(5, "big") for x in run[owner == at])
        want = brute_grams(text) if (text or "").strip() else Counter()
        assert got == want, text


def test_nearest_examples_match_all_cosines(spark):
    rows, labels = judged_rows()
    rows += [(900, rows[0][1], *rows[0][2:]), (901, rows[0][1], *rows[0][2:])]
    docs = spark.createDataFrame(rows, DOCS)
    model = toxicity.fit(spark.createDataFrame([*labels, (900, 1), (901, 0)], "doc_id long, toxic int"), docs)
    terms = {int(t).to_bytes(5, "big"): i for i, t in enumerate(model.vocabulary.terms)}
    assert len(terms) and any(b"grumb" in t for t in terms)

    def dense(text):
        out = np.zeros(len(terms))
        for gram, n in brute_grams(text).items():
            if gram in terms:
                out[terms[gram]] = (1 + math.log(n)) * model.vocabulary.idf[terms[gram]]
        return out / (np.linalg.norm(out) or 1)

    by_id = {r[0]: r[1] for r in rows}
    examples = np.array([dense(by_id[i]) for i in model.doc_ids])
    texts = [r[1] for r in judged_rows(60, 8)[0]] + ["", None, "zatcheks grumbolo", rows[0][1]]
    found, cosine = model.index.nearest(model.vocabulary.vectors(pa.array(texts)), 7)
    all_ = np.array([dense(t) for t in texts]) @ examples.T
    for q in range(len(texts)):
        order = sorted((r for r in range(len(examples)) if all_[q, r] > 0), key=lambda r: (-round(all_[q, r], 9), r))[:7]
        there = found[q] >= 0
        assert np.allclose(cosine[q][there], all_[q, found[q][there]], atol=1e-9)
        assert np.allclose(cosine[q][there], all_[q, order], atol=1e-9)
    # Bounds hold, and they save work.
    queries = model.vocabulary.vectors(pa.array(texts))
    bounds, size = model.index.bounds(queries), model.index.size
    for block in range(model.index.blocks):
        assert (all_[:, block * size : (block + 1) * size].max(axis=1) <= bounds[:, block] + 1e-9).all()
    assert model.index.opened < len(texts) * model.index.blocks


def test_toxic_documents_are_found(spark):
    rows, labels = judged_rows()
    model = toxicity.fit(spark.createDataFrame(labels, "doc_id long, toxic int"), spark.createDataFrame(rows, DOCS))
    fresh, truth = judged_rows(120, 11)
    got = {r["doc_id"]: r for r in toxicity.score_documents(spark.createDataFrame(fresh, DOCS), model).collect()}
    wrong = sum(got[i]["predicted"] != toxic for i, toxic in truth)
    assert wrong <= 4
    bad = next(i for i, toxic in truth if toxic and got[i]["predicted"])
    named = dict(labels)
    assert got[bad]["evidence_ids"] and named[got[bad]["evidence_ids"][0]] == 1
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_toxicity_on_edges(spark):
    rows, labels = judged_rows()
    odd = [(1, None), (2, ""), (3, " \n"), (None, "grumbolo"), (5, "grumbolo"), (5, "grumbolo"), (6, "w " * 100_000), (7, "ab")]
    docs = spark.createDataFrame([(i, t, None, None, None, None, None, None) for i, t in odd], DOCS)
    labelled = spark.createDataFrame([*labels, (3, None), (4, 1), (4, 1), (None, 1), (10**9, 1)], "doc_id long, toxic int")
    model = toxicity.fit(labelled, spark.createDataFrame(rows, DOCS))
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(odd)
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[1] == scores[2] == scores[3] == scores[7] and scores[None] == scores[5]
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    assert {r["score"] for r in toxicity.score_documents(docs, None).collect()} == {0.0}
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(nothing, docs) is None and toxicity.fit(labelled, docs.limit(0)) is None
    one_label = toxicity.fit(spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, toxic int"), spark.createDataFrame(rows, DOCS))
    assert all(r["predicted"] == 0 for r in toxicity.score_documents(docs, one_label).collect())
