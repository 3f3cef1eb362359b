import random
import re

import numpy as np
import pyarrow as pa

from trolley.llm import jaccard
from trolley.llm.components import components


def plain_sets(texts, k):
    out = []
    for text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
        out.append({tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1))} if words else set())
    return out


def plain_components(ids, sets, percent):
    label = dict(zip(ids, ids, strict=True))
    links = [(a, b) for i, a in enumerate(ids) for j, b in enumerate(ids[:i]) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


def test_sets():
    texts = [None, "", " \n", "A b", "a B c d", "a b c d a b c d", "é\u00a0x y\x0bz  w v", "x" * 10_000]
    got = [*jaccard.shingle_sets(pa.array(texts, pa.string()), 4)]
    assert [len(s) for s in got] == [len(s) for s in plain_sets(texts, 4)]
    again = [*jaccard.shingle_sets(pa.array(["zz", *texts[::-1]], pa.string()), 4)][1:][::-1]
    assert all(np.array_equal(a, b) for a, b in zip(got, again, strict=True))


def crowd(seed):
    """Near copies of a few bases, with edits that put many pairs near the limit, and a shared passage."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    passage = [f"p{i}" for i in range(30)]
    texts = []
    for _ in range(6):
        base = rnd.choices(vocabulary, k=rnd.randint(40, 90))
        for _ in range(25):
            copy = list(base)
            for _ in range(rnd.randint(0, 6)):
                copy[rnd.randrange(len(copy))] = rnd.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += [" ".join([*rnd.choices(vocabulary, k=rnd.randint(5, 120)), *passage]) for _ in range(60)]
    texts += [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 5))) for _ in range(30)]
    return texts


def test_components_against_all_pairs(spark, monkeypatch):
    for seed, words, percent in ((1, 4, 85), (2, 5, 80), (3, 2, 60)):
        texts = crowd(seed)
        ids = random.Random(seed).sample(range(10_000), len(texts))
        monkeypatch.setattr(jaccard, "BROADCAST_IDS", 1_000_000 if seed == 1 else 0)
        docs = spark.createDataFrame([*zip(ids, texts, strict=True)], "doc_id long, text string").repartition(3)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.near_duplicates(docs, words, percent).collect()}
        sets = plain_sets(texts, words)
        label = plain_components(ids, sets, percent)
        assert got == {i: (len(s), label[i]) for i, s in zip(ids, sets, strict=True)}


def test_odd_documents(spark, odd_docs, no_docs):
    rows = jaccard.near_duplicates(odd_docs, 4, 85).collect()
    found = {(r.doc_id, r.n_shingles): r.component_id for r in rows}
    assert len(rows) == odd_docs.count()
    assert found[0, 0] == 0 and found[1, 0] == 1 and found[2, 0] == 2
    assert found[8, 2] == 6 and found[3, 1] == 3
    assert jaccard.near_duplicates(no_docs).count() == 0


def test_long_chains(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001)], "a long, b long")
    roots = {r.node: r.root for r in components(edges).collect()}
    assert {roots[i] for i in range(301)} == {0} and roots[1001] == 1000


def test_near_copies_without_doc_id_are_linked(spark):
    words = [f"w{i}" for i in range(200)]
    near, other = " ".join(words[:-1] + ["end"]), " ".join(f"q{i}" for i in range(50))
    docs = spark.createDataFrame([(5, " ".join(words)), (None, near), (None, other), (None, other + " more")], "doc_id long, text string")
    rows = sorted(((r.n_shingles, r.doc_id, r.component_id) for r in jaccard.near_duplicates(docs).collect()), key=str)
    assert rows == [(196, 5, 5), (196, None, 5), (46, None, None), (47, None, None)]
