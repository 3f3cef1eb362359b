"""Quality rules on the repetition inside a text, found with a suffix array of its words.

Many texts share one array: suffixes are ranked by (text, first word), then by twice as many words in
each round, and only suffixes whose prefix still occurs elsewhere in their text go into the next
round. Longest common prefixes (LCP) of neighbours in the array follow from the ranks of all rounds.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trolley.llm.common import BLANKS

#: The base rule: at least so many words, and at most this percentage of them in repeated windows.
MIN_WORDS, WINDOW, WINDOW_PERCENT = 50, 3, 50
#: The method's rule: repeats of at least ``LEAST`` words may cover at most ``COVERED_PERCENT`` of the
#: words, and no repeat may have more than ``LONGEST`` words.
LEAST, COVERED_PERCENT, LONGEST = 8, 40, 50
SYMBOLS = "#*$%&|<>"
#: Characters of text whose words share one array; a longer text has one of its own.
SLICE_CHARS = 1 << 19

MEASURES = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_covered_words bigint, longest_repeat bigint"
)
_NAMES = [c.split()[0] for c in MEASURES.split(", ")]


def suffix_array(words: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and LCP array of texts laid end to end.

    ``words`` are numbers of words, ``ends[i]`` is where the text of word i ends; a suffix ends with its
    text. ``lcp[r]`` is the common prefix of the suffixes at places r - 1 and r, in words, and 0 where
    these are of different texts.
    """
    n = len(words)
    if not n:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.lexsort((words, ends))
    fresh = np.append(True, (words[order][1:] != words[order][:-1]) | (ends[order][1:] != ends[order][:-1]))
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels: list[np.ndarray] = []
    step = 1
    while True:
        sizes = np.bincount(rank, minlength=n)
        active = np.flatnonzero(sizes[rank] > 1)
        if not len(active):
            break
        levels.append(rank.astype(np.int32))
        beyond = active + step
        inside = beyond < ends[active]
        second = np.where(inside, rank[np.where(inside, beyond, 0)] + 1, 0)
        key = rank[active] * (n + 1) + second
        by_key = np.argsort(key, kind="stable")
        key = key[by_key]
        first = np.maximum.accumulate(np.where(np.append(True, key[1:] != key[:-1]), np.arange(len(key)), 0))
        old = key // (n + 1)
        group = np.maximum.accumulate(np.where(np.append(True, old[1:] != old[:-1]), np.arange(len(key)), 0))
        rank = rank.copy()
        rank[active[by_key]] = old + first - group
        step *= 2
    places = np.empty(n, np.int64)
    places[rank] = np.arange(n)
    lcp = np.zeros(n, np.int64)
    if levels:
        at = np.flatnonzero(levels[0][places[1:]] == levels[0][places[:-1]]) + 1
        a, b = places[at - 1], places[at]
        end = ends[a]
        common = np.zeros(len(at), np.int64)
        for k in range(len(levels) - 1, -1, -1):
            i, j = a + common, b + common
            inside = (i < end) & (j < end)
            same = inside & (levels[k][np.where(inside, i, 0)] == levels[k][np.where(inside, j, 0)])
            common[same] += 1 << k
        lcp[at] = common
    return places, lcp


def longest_repeats(places: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """For each word, the length of the longest repeated run of words that begins there.

    The intervals of the LCP array that hold a suffix are nested, and the innermost has the larger of
    the two LCPs beside it. So these runs hold all maximal repeats, and are parts of some.
    """
    out = np.empty(len(places), np.int64)
    out[places] = np.maximum(lcp, np.append(lcp[1:], 0)) if len(lcp) else lcp
    return out


def covered(runs: np.ndarray, least: int) -> np.ndarray:
    """Whether each word lies in the union of the repeats of at least ``least`` words."""
    begins = np.flatnonzero(runs >= least)
    change = -np.bincount(begins + runs[begins], minlength=len(runs) + 1)
    change[begins] += 1
    return change[:-1].cumsum() > 0


def measures(texts: list[str]) -> list[tuple[int, ...]]:
    """The columns of ``MEASURES`` for each text, by one suffix array of all their words."""
    numbers: dict[bytes, int] = {}
    words = [t.encode().split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    bounds = np.append(0, counts.cumsum())
    ids = np.array([numbers.setdefault(w, len(numbers)) for own in words for w in own], np.int64)
    runs = longest_repeats(*suffix_array(ids, np.repeat(bounds[1:], counts)))
    out = []
    totals = [np.append(0, covered(runs, least).cumsum()) for least in (WINDOW, LEAST)]
    for i, text in enumerate(texts):
        a, b = bounds[i], bounds[i + 1]
        lines = [x for x in text.split("\n") if x.strip(BLANKS)]
        out.append(
            (
                int(b - a),
                len(text) - sum(map(text.count, BLANKS)),
                sum(map(text.count, SYMBOLS)),
                len(lines) - len(set(lines)),
                int(totals[0][b] - totals[0][a]),
                int(totals[1][b] - totals[1][a]),
                int(runs[a:b].max(initial=0)),
            )
        )
    return out


def _slices(texts: list[str]) -> Iterator[list[str]]:
    """The texts in order, in slices of about ``SLICE_CHARS``."""
    held: list[str] = []
    size = 0
    for text in texts:
        if held and size + len(text) > SLICE_CHARS:
            yield held
            held, size = [], 0
        held.append(text)
        size += len(text)
    if held:
        yield held


def measured(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The columns ``keep`` of every row and those of ``MEASURES``; nothing is shuffled.

    Words are runs of characters other than ASCII blanks. ``n_repeat_words`` counts words in runs of
    ``WINDOW`` words or more that the text repeats, ``n_covered_words`` those in runs of ``LEAST`` or
    more, ``longest_repeat`` is the longest run; copies of a run may overlap, and all of them count.
    NULL text is empty and all zeros. Rows stay rows, however many are equal; names in ``keep`` must
    differ from those of the measures.
    """
    kept = docs.select(*keep, F.coalesce(F.col(text), F.lit("")).alias("_text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema[:-1])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [r for part in _slices(batch.column(batch.num_columns - 1).to_pylist()) for r in measures(part)]
            made = [pa.array([r[i] for r in rows], pa.int64()) for i in range(len(_NAMES))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *_NAMES])

    return kept.mapInArrow(run, f"{kinds}, {MEASURES}")


def judged(rows: DataFrame) -> DataFrame:
    """``base_failed`` (too few words, or too many in repeated windows) and ``kept`` (neither that, nor
    too much of the text in repeats, nor too long a repeat) added to measured rows."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > WINDOW_PERCENT * F.col("n_words"))
    repetitive = (100 * F.col("n_covered_words") > COVERED_PERCENT * F.col("n_words")) | (F.col("longest_repeat") > LONGEST)
    return rows.withColumn("base_failed", failed).withColumn("kept", ~failed & ~repetitive)
