"""Suffix-array dedup with sparse suffix arrays.

Suffixes are kept only where they begin at a minimiser: of every 31 runs of 20 words in a row, the runs
with the least hash. Two texts that share 50 words share one such run at least. Suffixes that begin
with the same run are sorted by what follows, compared with their neighbours in that order, and each match
is extended to the left; the same the other way round, sorted by what stands before. The best matches of
both orders bound what any other suffix could add; where they leave room for more, the windows of 50 words
in question are looked up among those of all suffixes of the run.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise, text_or_empty

#: Words of a passage that counts, and of a run. A window of a passage's length holds REACH + 1 runs.
LEAST, RUN = 50, 20
REACH = LEAST - RUN
#: Bytes of text that are worked on at once; a longer text is one piece, hashed in blocks of as many.
CHUNK = 1 << 20
#: A table of runs is broadcast up to this many, 16 MB; beyond it the join shuffles.
BROADCAST_RUNS = 2_000_000
#: Suffixes of one run that a task compares; those of more frequent runs are dealt by id, and the windows
#: that a task can't settle are looked up across tasks.
TOGETHER = 20_000

_BASE = 0x9E3779B97F4A7C15
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]  # of _BASE, and of its inverse, modulo 2^64
_IS_SPACE = np.zeros(256, np.int8)
_IS_SPACE[[9, 10, 11, 12, 13, 32]] = 1
_SPACE = re.compile(rb"[\t-\r ]")


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            factors = np.full(2 * n, base, np.uint64)
            factors[0] = 1
            _POWERS[i] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[0][:n], _POWERS[1][:n]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _sliding(x: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """The best of every width neighbours in a row, by doubling."""
    span = 1
    while 2 * span <= width:
        x = best(x[:-span], x[span:])
        span *= 2
    rest = width - span
    return best(x[: len(x) - rest], x[rest:]) if rest else x


def _between(values: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """The hash of each stretch of values, wherever it stands: a difference of prefix sums."""
    up, down = _powers(len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[:-1], dtype=np.uint64)])
    return _mix((sums[stops] - sums[starts]) * down[starts])


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, split at ASCII white space, and where each text's begin and
    the last one's end."""
    data = b" ".join(texts) + b" "
    begins = np.cumsum([0] + [len(t) + 1 for t in texts])
    hashes, places, at = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], 0
    while at < len(data):
        stop = at + CHUNK
        if stop < len(data):
            stop = _SPACE.search(data, stop).end()
        block = np.frombuffer(data[at:stop], np.uint8)
        change = np.diff(_IS_SPACE[block], prepend=np.int8(1), append=np.int8(1))
        starts, stops = np.flatnonzero(change == -1), np.flatnonzero(change == 1)
        hashes.append(_between(block.astype(np.uint64) + np.uint64(1), starts, stops))
        places.append(starts + at)
        at = stop
    return np.concatenate(hashes), np.searchsorted(np.concatenate(places), begins)


def anchors(w: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each minimiser: the index of its text, its place in w, and the hash of its run.

    A run is a minimiser when it is the least of some window of its text, which is when the greatest of the
    least values of its windows is its own; equal runs all are."""
    if len(w) < LEAST:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    first = np.arange(len(w) - RUN + 1)
    runs = _between(w, first, first + RUN)
    least = _sliding(runs, REACH + 1, np.minimum)
    owner = np.repeat(np.arange(len(begins) - 1), np.diff(begins))
    # A window that goes on into the next text is none: it bounds nothing from below.
    least[owner[: len(least)] != owner[LEAST - 1 :]] = 0
    padded = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    most = _sliding(padded, REACH + 1, np.maximum)
    at = np.flatnonzero((most == runs) & (most > 0))
    return owner[at], at, runs[at].view(np.int64)


def _chunks(texts: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """The texts in stretches of about CHUNK bytes, each with the index of its first."""
    first, held, size = 0, [], 0
    for i, t in enumerate(texts):
        held.append(t.as_py())
        size += len(held[-1])
        if size >= CHUNK:
            yield first, held
            first, held, size = i + 1, [], 0
    if held:
        yield first, held


def _stretches(w: np.ndarray, starts: np.ndarray, stops: np.ndarray, step: int) -> pa.Array:
    """The words from starts on, in steps of 1 or -1 and before stops, REACH at most, as bytes."""
    places = starts[:, None] + step * np.arange(REACH)[None, :]
    inside = (places < stops[:, None]) if step > 0 else (places >= stops[:, None])
    found = w[np.clip(places, 0, len(w) - 1)].astype(">u4")[inside]
    ends = np.concatenate([[0], np.cumsum(inside.sum(axis=1) * 4)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(found)])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).cast("binary").alias("text")).filter("id is not null")


def suffixes(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """run, right, left, id, at, n of the suffixes whose run another document has too. right and left are
    the words after and, in reverse, before the run as 32-bit hashes; n is null unless the run has more than
    TOGETHER suffixes."""
    id_type = docs.schema[id_col].dataType.simpleString()
    rows = _rows(docs, id_col, text_col)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch.column(1)):
                w, begins = word_hashes(texts)
                text, at, run = anchors(w, begins)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(text + first)), pa.array((at - begins[text]).astype(np.int32)), pa.array(run)], ["id", "at", "run"])

    found = rows.mapInArrow(find, f"id {id_type}, at int, run long")
    repeated = found.groupBy("run").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("run", "n")
    repeated = materialise(repeated, "suffix-runs")
    if repeated.count() <= BROADCAST_RUNS:
        wanted = docs.sparkSession.sparkContext.broadcast(np.sort(repeated.select("run").toPandas()["run"].to_numpy(np.int64)))
        source = rows.withColumn("spots", F.lit(None).cast("array<int>"))
    else:
        wanted = None
        spots = found.join(repeated.select("run"), "run", "left_semi").groupBy("id").agg(F.collect_set("at").alias("spots"))
        source = rows.join(spots, "id")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, texts in _chunks(batch.column(1)):
                w, begins = word_hashes(texts)
                text, at, run = anchors(w, begins)
                if wanted is None:
                    listed = [np.asarray(batch.column(2)[first + i].as_py() or [], np.int64) + begins[i] for i in range(len(texts))]
                    mask = np.isin(at, np.concatenate(listed))
                elif len(wanted.value):
                    mask = wanted.value[np.minimum(np.searchsorted(wanted.value, run), len(wanted.value) - 1)] == run
                else:
                    mask = np.zeros(len(at), bool)
                text, at, run = text[mask], at[mask], run[mask]
                right, left = _stretches(w, at + RUN, begins[text + 1], 1), _stretches(w, at - 1, begins[text], -1)
                columns = [pa.array(run), right, left, batch.column(0).take(pa.array(text + first)), pa.array((at - begins[text]).astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, ["run", "right", "left", "id", "at"])

    kept = source.mapInArrow(emit, f"run long, right binary, left binary, id {id_type}, at int")
    frequent = repeated.filter(F.col("n") > TOGETHER)
    return kept.join(F.broadcast(frequent) if frequent.count() <= BROADCAST_RUNS else frequent, "run", "left")


def _unpacked(values: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, values), np.int64, len(values)) // 4
    return np.frombuffer(b"".join(v.ljust(4 * REACH, b"\0") for v in values), ">u4").reshape(-1, REACH), sizes


def _common(a: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Of each row but the first: how many leading words equal those of the row before."""
    same = np.logical_and.accumulate(a[1:] == a[:-1], axis=1).sum(axis=1)
    return np.minimum(same, np.minimum(n[1:], n[:-1]))


_BACK = np.arange(REACH + 1)


def _covers(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which windows, by the words they reach back from the run, lie within matches of these extents."""
    return (_BACK[None, :] <= left[:, None]) & (REACH - _BACK[None, :] <= right[:, None])


def _window_hashes(left: np.ndarray, ln: np.ndarray, right: np.ndarray, rn: np.ndarray, run: np.ndarray) -> np.ndarray:
    """The hash of each row's window that reaches back so many words, by the words before and after its run."""
    up, _ = _powers(2 * REACH + 3)
    sums = []
    for words, powers in ((left, up[1 : REACH + 1]), (right, up[REACH + 1 : 2 * REACH + 1])):
        mixed = _mix(words.astype(np.uint64) + np.uint64(1)) * powers
        sums.append(np.concatenate([np.zeros((len(words), 1), np.uint64), np.cumsum(mixed, axis=1, dtype=np.uint64)], axis=1))
    far = _mix(np.arange(1, REACH + 2, dtype=np.uint64) * up[2 * REACH + 1])
    return _mix(_mix(sums[0] + sums[1][:, ::-1] + far) ^ _mix(run.view(np.uint64) + up[2 * REACH + 2])[:, None])


def _by_hash(hashes: np.ndarray, who: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the rows by hash and who, and for each place in it whether another who has its hash."""
    order = np.lexsort((who, hashes))
    h = hashes[order]
    edge = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    stop = np.append(edge[1:], len(h)) - 1
    several = who[order][edge] != who[order][stop]
    return order, np.repeat(several, stop - edge + 1)


def compare(rows: pd.DataFrame) -> tuple[list[tuple[np.ndarray, np.ndarray, np.ndarray]], list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """(row, start, stop) arrays of the repeated spans; and (row, words back, hash) arrays of the windows that
    other tasks may settle. rows: whole groups of one run each, next to each other, sorted by right and left."""
    right, rn = _unpacked(rows["right"].tolist())
    left, ln = _unpacked(rows["left"].tolist())
    run, at = rows["run"].to_numpy(np.int64), rows["at"].to_numpy(np.int64)
    who = pd.factorize(rows["id"])[0]
    out, asked, count = [], [], len(rows)
    known = np.zeros((count, REACH + 1), bool)
    most_left, most_right = np.full(count, -1), np.full(count, -1)

    def neighbours(order: np.ndarray) -> None:
        same_run = run[order][1:] == run[order][:-1]
        r, l = np.where(same_run, _common(right[order], rn[order]), -1), np.where(same_run, _common(left[order], ln[order]), -1)
        other = same_run & (who[order][1:] != who[order][:-1])
        for mine in (order[1:], order[:-1]):
            np.maximum.at(most_right if order is natural else most_left, mine, r if order is natural else l)
            match = other & (l + r >= REACH)
            hit = mine[match]
            known[hit] |= _covers(l[match], r[match])
            out.append((hit, at[hit] - l[match], at[hit] + RUN + r[match]))

    natural = np.arange(count)
    neighbours(natural)
    keys = np.ascontiguousarray(np.concatenate([left, right], axis=1)).view(f"S{8 * REACH}").ravel()
    neighbours(np.lexsort((keys, run)))
    # A run's first order bounds what follows it in any match, the second what stands before it.
    open_ = _covers(most_left, most_right) & ~known
    frequent = rows["n"].notna().to_numpy()
    group = np.cumsum(np.concatenate([[0], run[1:] != run[:-1]]))
    asks = np.zeros((group[-1] + 1, REACH + 1), bool)
    for back in range(REACH + 1):
        asks[group[open_[:, back]], back] = True
    asks[group[frequent]] = True
    some = np.flatnonzero(asks.any(axis=1)[group])
    if not len(some):
        return out, asked
    hashes = _window_hashes(left[some], ln[some], right[some], rn[some], run[some])
    for back in range(REACH + 1):
        there = asks[group[some], back] & (ln[some] >= back) & (rn[some] >= REACH - back)
        mine, h = some[there], hashes[there, back]
        if not len(mine):
            continue
        order, several = _by_hash(h, who[mine])
        mine, h = mine[order], h[order]
        hit = mine[several]
        out.append((hit, at[hit] - back, at[hit] - back + LEAST))
        # Of a frequent run's windows, those of one document here; of the others the first and the last document.
        ends = np.ones(len(h), bool)
        ends[1:-1] = (h[1:-1] != h[:-2]) | (h[1:-1] != h[2:])
        ask = frequent[mine] & (~several | ends)
        asked.append((np.where(several[ask], -1 - mine[ask], mine[ask]), np.full(ask.sum(), back), h[ask].view(np.int64)))
    return out, asked


def _spans(ordered: DataFrame) -> DataFrame:
    """id, start, stop, hash: repeated spans of the suffixes (hash is null); and windows of suffixes whose run is
    too frequent for one task, with the hash of their words: those that are not settled yet, and, without
    start and stop, two documents that have a settled one."""
    id_type = ordered.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = None
        held: pd.DataFrame | None = None
        for batch in batches:
            kind = batch.column("id").type
            now = batch.to_pandas()
            now = now if held is None else pd.concat([held, now], ignore_index=True)
            if not len(now):
                continue
            # The last group may go on in the next batch. One of a frequent run is only cut into pieces.
            last = int(np.searchsorted((now["run"].to_numpy() != now["run"].iloc[-1])[::-1], True))
            cut = len(now) - last
            if last >= 2 * TOGETHER:
                cut = len(now)
            held = now.iloc[cut:].reset_index(drop=True)
            if cut:
                yield done(now.iloc[:cut].reset_index(drop=True), kind)
        if held is not None and len(held):
            yield done(held, kind)

    def done(rows: pd.DataFrame, kind: pa.DataType) -> pa.RecordBatch:
        found, asked = compare(rows)
        spans = pd.DataFrame({"i": np.concatenate([x[0] for x in found]), "start": np.concatenate([x[1] for x in found]), "stop": np.concatenate([x[2] for x in found])}).groupby(["i", "start"], as_index=False)["stop"].max()
        signed, back, hashes = (np.concatenate([x[k] for x in asked]) if asked else np.empty(0, np.int64) for k in range(3))
        witness = signed < 0
        index = np.where(witness, -1 - signed, signed).astype(np.int64)
        start = rows["at"].to_numpy(np.int64)[index] - back
        ids = pa.array(rows["id"], kind).take(pa.array(np.concatenate([spans["i"].to_numpy(np.int64), index])))
        none = np.concatenate([np.zeros(len(spans), bool), witness])
        starts = pa.array(np.concatenate([spans["start"], start]).astype(np.int32), mask=none)
        stops = pa.array(np.concatenate([spans["stop"], start + LEAST]).astype(np.int32), mask=none)
        h = pa.array(np.concatenate([np.zeros(len(spans), np.int64), hashes.astype(np.int64)]), mask=np.arange(len(none)) < len(spans))
        return pa.RecordBatch.from_arrays([ids, starts, stops, h], ["id", "start", "stop", "hash"])

    return ordered.mapInArrow(work, f"id {id_type}, start int, stop int, hash long")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, start, stop, n_words of every passage of 50 words or more that another document has too.

    Words are split at ASCII white space and compared as they are; positions count words from 0;
    passages that touch or overlap are one. What repeats within one document only isn't reported, nor
    are texts of fewer words, null or empty ones, or rows with a null id; rows with the same id are
    one document. Copies are all reported, each with its passages. An empty table gives no rows.
    """
    dealt = F.coalesce(F.pmod(F.xxhash64("id"), F.ceil(F.col("n") / TOGETHER)), F.lit(0))
    ordered = suffixes(docs, id_col, text_col).withColumn("part", dealt).repartition("run", "part").sortWithinPartitions("run", "part", "right", "left", "id").drop("part")
    found = materialise(_spans(ordered), "suffix-spans")
    windows = found.filter("hash IS NOT NULL")
    shared = windows.groupBy("hash").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b").select("hash")
    rest = windows.filter("start IS NOT NULL").join(shared, "hash", "left_semi").select("id", "start", "stop")

    spans = found.filter("hash IS NULL").select("id", "start", "stop").unionByName(rest).groupBy("id", "start").agg(F.max("stop").alias("stop"))
    earlier = Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    numbered = spans.withColumn("new", (F.col("start") > F.coalesce(F.max("stop").over(earlier), F.lit(-1))).cast("int"))
    numbered = numbered.withColumn("passage", F.sum("new").over(Window.partitionBy("id").orderBy("start").rowsBetween(Window.unboundedPreceding, 0)))
    merged = numbered.groupBy("id", "passage").agg(F.min("start").alias("start"), F.max("stop").alias("stop"))
    return merged.select(F.col("id").alias(id_col), F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop"), (F.col("stop") - F.col("start")).cast("long").alias("n_words"))
