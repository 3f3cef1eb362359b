import random
import re

import numpy as np

from trolley.llm import quality_rules as rules


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def plain_measures(text):
    words, lines = words_of(text), [x for x in text.split("\n") if words_of(x)]
    n = len(words)

    def common(i, j):
        k = 0
        while max(i, j) + k < n and words[i + k] == words[j + k]:
            k += 1
        return k

    runs = [max((common(i, j) for j in range(n) if j != i), default=0) for i in range(n)]
    cover = [len({p for i, r in enumerate(runs) if r >= least for p in range(i, i + r)}) for least in (rules.WINDOW, rules.LEAST)]
    symbols = sum(c in rules.SYMBOLS for c in text)
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), *cover, max(runs, default=0)


def test_measures_against_all_pairs_of_suffixes():
    rnd = random.Random(1)
    for _ in range(150):
        texts = []
        for _ in range(rnd.randint(1, 6)):
            own = rnd.choices(["a", "b", "c<", "é#", "B"][: rnd.randint(1, 5)], k=rnd.randint(0, 45))
            texts.append("".join(w + rnd.choice([" ", "\n", "\t ", "\x0b", "\r\n"]) for w in own))
        assert rules.measures(texts) == [plain_measures(t) for t in texts]


def test_suffix_array_is_sorted():
    rnd = random.Random(2)
    words = np.array(rnd.choices(range(3), k=200))
    ends = np.repeat([70, 150, 200], [70, 80, 50])
    places, lcp = rules.suffix_array(words, ends)
    suffixes = [(int(ends[i]), words[i : ends[i]].tolist()) for i in places]
    assert suffixes == sorted(suffixes)
    for r in range(1, 200):
        (e, a), (f, b) = suffixes[r - 1], suffixes[r]
        same = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert lcp[r] == (same if e == f else 0)


def test_verdicts(spark):
    rnd = random.Random(3)
    plain = rnd.sample([f"w{i}" for i in range(5000)], 400)
    texts = {
        "clean": plain,
        "short": plain[:49],
        "windows": plain[:20] * 3,
        "long repeat": plain + plain[:51],
        "repeat at the limit": plain + plain[:50],
        "covered": plain[:150] + sum([[str(i), *plain[k : k + 9]] for i, k in enumerate(range(0, 60, 12))], []),
    }
    docs = spark.createDataFrame([(k, " ".join(v)) for k, v in texts.items()], "doc_id string, text string")
    got = {r.doc_id: (r.base_failed, r.kept) for r in rules.judged(rules.measured(docs, ["doc_id"])).collect()}
    assert got == {
        "clean": (False, True),
        "short": (True, False),
        "windows": (True, False),
        "long repeat": (False, False),
        "repeat at the limit": (False, True),
        "covered": (False, False),
    }


def test_odd_documents(spark, odd_docs, no_docs):
    rows = rules.judged(rules.measured(odd_docs, ["doc_id", "lang", "path", "score"])).collect()
    assert len(rows) == odd_docs.count()
    assert [r.n_words for r in rows if r.doc_id in (0, 1, 2)] == [0, 0, 0]
    periodic = [r for r in rows if r.n_words == 40_000]
    assert len(periodic) == 2 and all(r.longest_repeat == 39_998 and r.n_covered_words == 40_000 and not r.kept for r in periodic)
    assert rules.judged(rules.measured(no_docs, ["doc_id"])).collect() == []
