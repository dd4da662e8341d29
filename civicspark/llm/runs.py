"""Periodic runs of words: stretches that repeat one block again and again, and texts with these repeats taken out.

Maximal pairs of the suffixes of each text. A run with period q is a factor that occurs again q words later, where
neither the words before the two occurrences nor those after them agree; so it is a maximal pair, and once the pair's
distance meets the limits on length and exponent it is the run, from end to end.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import WORD, give_back, text_or_empty

#: Words of texts that are searched together at least; one text is never cut.
BATCH_WORDS = 200_000

#: An LCP interval on the way up: its suffixes in order of place, and by the word to their left.
Interval = tuple[list[int], dict[int, list[int]]]


def least_common(min_length: int, min_exponent: int) -> int:
    """Words that the two occurrences of a run's pair share at least: its length less its period."""
    return min(max(min_length - q, (min_exponent - 1) * q) for q in range(1, min_length + 1))


def numbered(docs: list[list[str]]) -> tuple[list[int], list[int]]:
    """One row of numbers for all texts, and where each text starts. A text's words have numbers that no other text
    uses, and a number of its own stands before each text and at the end, so no factor goes over an edge."""
    row, starts, top = [], [], 0
    for words in docs:
        row.append(top)
        starts.append(len(row))
        known: defaultdict[str, int] = defaultdict()
        known.default_factory = lambda known=known, first=top + 1: first + len(known)
        row.extend(map(known.__getitem__, words))
        top += 1 + len(known)
    row.append(top)
    return row, starts


def repeated_suffixes(row: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes whose first `least` words occur again, in the order of the suffixes, and a number for each
    group of them that shares these words. Prefix doubling: a suffix is left alone once no other equals it so far."""
    counts = np.bincount(row)
    rank = (np.cumsum(counts) - counts)[row]  # how many words of all texts are smaller
    live = np.flatnonzero(counts[row] > 1)
    held, group, length = live[:0], live[:0], 1
    while True:
        if length == least:
            held, group = live, rank[live]
        if not len(live):
            break
        shift = length if length >= least else min(length, least - length)
        first, second = rank[live], rank[live + shift]
        order = np.lexsort((second, first))
        live, first, second = live[order], first[order], second[order]
        new_group = np.concatenate([[True], first[1:] != first[:-1]])
        new_part = new_group | np.concatenate([[True], second[1:] != second[:-1]])
        at = np.arange(len(live))
        group_at, part_at = np.maximum.accumulate(np.where(new_group, at, 0)), np.maximum.accumulate(np.where(new_part, at, 0))
        rank[live] = first + part_at - group_at
        alone = new_part & np.concatenate([new_part[1:], [True]])
        live, length = np.sort(live[~alone]), length + shift
    order = np.argsort(rank[held], kind="stable")
    return held[order], group[order]


def common_prefixes(row: list[int], order: np.ndarray, group: np.ndarray, least: int) -> list[int]:
    """Words that each suffix shares with the one before it in order; 0 for the first of a group. In order of place,
    each is at most one shorter than the one before."""
    before = np.where(np.concatenate([[True], group[1:] != group[:-1]]), -1, np.concatenate([[-1], order[:-1]])).tolist()
    by_place = np.argsort(order, kind="stable").tolist()
    found, places, last, shared = [0] * len(before), order.tolist(), -2, 0
    for k in by_place:
        p, other = places[k], before[k]
        if other < 0:
            shared = 0
        else:
            shared = max(shared - 1, least) if p == last + 1 else least
            while row[p + shared] == row[other + shared]:
                shared += 1
            found[k] = shared
        last = p
    return found


def maximal_pairs(row: list[int], order: list[int], prefixes: list[int], min_length: int, min_exponent: int) -> list[tuple[int, int, int]]:
    """Start, length and period of every run: bottom-up over the LCP intervals of the suffixes.

    Where two children of an interval meet, suffixes of different classes by the word to their left make maximal pairs;
    their common prefix is the interval's. Only neighbours in place can have the period for their distance, since an
    occurrence between them would give a shorter one. The smaller child is looked up in the larger.
    """
    runs = []

    def take(p: int, later: int, shared: int) -> None:
        distance = later - p
        if distance * (min_exponent - 1) <= shared and distance + shared >= min_length:
            runs.append((p, distance + shared, distance))

    def join(one: Interval, other: Interval, shared: int) -> Interval:
        (starts, classes), (few, few_classes) = (one, other) if len(one[0]) >= len(other[0]) else (other, one)
        for left, members in few_classes.items():
            if len(classes) == 1 and left in classes:
                continue
            for p in members:
                k = bisect_left(starts, p)
                if k < len(starts) and row[starts[k] - 1] != left:
                    n = bisect_right(few, p)
                    if n == len(few) or few[n] > starts[k]:
                        take(p, starts[k], shared)
                if k and row[starts[k - 1] - 1] != left:
                    n = bisect_left(few, p)
                    if not n or few[n - 1] < starts[k - 1]:
                        take(starts[k - 1], p, shared)
        if len(few) <= 8:
            for p in few:
                insort(starts, p)
        else:
            starts += few
            starts.sort()
        for left, members in few_classes.items():
            if left in classes:
                classes[left] += members
            else:
                classes[left] = members
        return starts, classes

    open_intervals: list[tuple[int, Interval]] = []
    node: Interval | None = None
    for p, shared in zip([*order, None], [*prefixes, 0]):
        while open_intervals and open_intervals[-1][0] > shared:
            length, earlier = open_intervals.pop()
            node = join(earlier, node, length)
        if node is not None and shared:
            if open_intervals and open_intervals[-1][0] == shared:
                node = join(open_intervals.pop()[1], node, shared)
            open_intervals.append((shared, node))
        if p is not None:
            node = [p], {row[p - 1]: [p]}
    return runs


def find_runs(docs: list[list[str]], min_length: int = 6, min_exponent: int = 4) -> list[list[tuple[int, int, int]]]:
    """For each text its runs as (start, length, period), by start, then period. min_exponent is 2 or more."""
    if min_exponent < 2 or min_length < 2:
        raise ValueError("a run repeats its block at least once")
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    row, starts = numbered(docs)
    least = least_common(min_length, min_exponent)
    order, group = repeated_suffixes(np.array(row), least)
    if len(order):
        for start, length, period in sorted(maximal_pairs(row, order.tolist(), common_prefixes(row, order, group, least), min_length, min_exponent)):
            k = bisect_right(starts, start) - 1
            out[k].append((start - starts[k], length, period))
    return out


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that a run holds after its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, int)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    stays = np.cumsum(edges[:-1]) == 0
    return [w for w, s in zip(words, stays.tolist()) if s]


def periodic_runs(docs: DataFrame, min_length: int = 6, min_exponent: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_words, runs (start, length, period; by start, then period) and collapsed (the words that stay, joined by one
    space) for each row of docs.

    A run is a stretch of words with smallest period q, at least max(min_length, min_exponent * q) long, that neither
    neighbour extends. Null text counts as empty: no words, no runs, an empty text. Repeated rows and null ids pass
    through one to one; an empty table gives no rows; other columns are ignored. There is no shuffle; a task holds
    BATCH_WORDS words at a time, or one text if that is longer, and time grows by n log n with its words.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"
    spans = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    word = re.compile(WORD)

    def found(ids: list[pa.Array], texts: list[list[str]]) -> pa.RecordBatch:
        runs = find_runs(texts, min_length, min_exponent)
        told = pa.array([[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs], spans)
        kept = pa.array([" ".join(collapse(w, r)) for w, r in zip(texts, runs)], pa.string())
        sizes = pa.array([len(w) for w in texts], pa.int64())
        return pa.RecordBatch.from_arrays([pa.concat_arrays(ids), sizes, told, kept], ["id", "n_words", "runs", "collapsed"])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, held, since = [], 0, 0
            for k, text in enumerate(batch.column(1)):
                texts.append(word.findall(text.as_py()))
                held += len(texts[-1])
                if held >= BATCH_WORDS:
                    yield found([batch.column(0).slice(since, len(texts))], texts)
                    texts, held, since = [], 0, k + 1
            if texts:
                yield found([batch.column(0).slice(since, len(texts))], texts)
        give_back()

    return docs.select(id_col, text_or_empty(text_col)).mapInArrow(search, schema).withColumnRenamed("id", id_col)
