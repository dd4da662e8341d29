"""MinHash near-dedup: circulant signatures, banding, exact Jaccard on full sets, components.

Rows with equal shingle sets are one node. Nodes that share a band key are a bucket; its hub is the node that
shares most buckets with others. Every node is compared with the hub it meets most often, which gives a forest
of confirmed links. A bucket whose nodes are then in one tree is done. In the others nodes of different trees
are candidates; where those pairs would be many, nodes are brought together by their rarest shingles instead:
sets as similar as asked share one of these for sure, so no link is lost, and texts that share a template
and little else never meet. All candidates are confirmed on full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType
from pyspark.sql.window import Window

from .common import give_back, materialise, text_or_empty

WORDS = 5
#: Two texts are near-duplicates from this similarity on, as a ratio of whole numbers.
OVER, UNDER = 3, 4
#: At similarity 0.75 all bands miss with probability (1 - 0.75^5)^48, about 2 in a million.
BANDS, ROWS = 48, 5
REMEMBER = 100_000
#: A table of ids is broadcast up to this many rows, 16 MB; beyond it the join shuffles.
BROADCAST_IDS = 200_000
#: Candidate pairs a row up to which the buckets' own pairs are compared, by sketches, at some 0.1 microseconds
#: a pair: about what spreading out a set costs. Beyond it rare shingles decide for
#: the buckets that have more.
DIRECT = 256
#: 64-bit numbers of the parity sketch of a set.
PARITY = 16

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_SHIFTS = np.arange(BANDS * ROWS, dtype=np.uint32)


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _permute(x: np.ndarray, spare: np.ndarray, first: int, second: int) -> np.ndarray:
    """A permutation of the 32-bit numbers, in place: each step can be undone."""
    for shift, factor in ((16, first), (15, second), (16, 0)):
        np.right_shift(x, np.uint32(shift), out=spare)
        np.bitwise_xor(x, spare, out=x)
        if factor:
            np.multiply(x, np.uint32(factor), out=x)
    return x


def shingle_set(text: bytes, words: dict) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words, A-Z lower-cased, split at ASCII white
    space; fewer words make one run, none an empty set."""
    parts = text.lower().split()
    if not parts:
        return np.empty(0, np.uint64)
    w = np.fromiter(map(words.__getitem__, parts), np.uint64, len(parts))
    n = len(w) - WORDS + 1
    if n <= 0:
        return _mix64((w * _MULTIPLIERS[: len(w)]).sum(dtype=np.uint64, keepdims=True) + np.uint64(len(w)))
    mixed = np.zeros(n, np.uint64)
    for j in range(WORDS):
        mixed += w[j : j + n] * _MULTIPLIERS[j]
    return np.unique(_mix64(mixed))


def signature(shingles: np.ndarray) -> np.ndarray:
    """Coordinate k is the least pi(sigma(x) + k) over the set: pi shifted circularly k times."""
    start = shingles.astype(np.uint32)
    start = _permute(start, np.empty_like(start), 0x7FEB352D, 0x846CA68B)
    least = np.full(len(_SHIFTS), 0xFFFFFFFF, np.uint32)
    room = np.empty((2, min(64, len(start)), len(_SHIFTS)), np.uint32)
    for i in range(0, len(start), 64):
        part = start[i : i + 64]
        x, spare = room[0, : len(part)], room[1, : len(part)]
        np.add(part[:, None], _SHIFTS[None, :], out=x)
        np.minimum(least, _permute(x, spare, 0x21F0AAAD, 0xD35A2D97).min(axis=0), out=least)
    return least


def band_keys(coordinates: np.ndarray) -> np.ndarray:
    bands = coordinates.reshape(BANDS, ROWS).astype(np.uint64)
    mixed = _mix64(bands + np.uint64(1))
    keys = np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for j in range(ROWS):
        keys = _mix64(keys ^ mixed[:, j])
    return keys.view(np.int64)


def signatures(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, node (128-bit hash of the shingle set), n (its size) and the band keys of each row."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, node binary, n long, bands array<long>"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            nodes, sizes, keys, ends = [], [], [], [0]
            for text in batch.column(1):
                found = shingle_set(text.as_py(), words)
                nodes.append(xxhash.xxh3_128_digest(found.tobytes()))
                sizes.append(len(found))
                if len(found):
                    keys.append(band_keys(signature(found)))
                ends.append(ends[-1] + (BANDS if len(found) else 0))
            flat = pa.array(np.concatenate(keys) if keys else np.empty(0, np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.binary()), pa.array(sizes, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat)], ["id", "node", "n", "bands"])
        words.clear()
        give_back()

    return docs.select(F.col(id_col), text_or_empty(text_col).cast("binary").alias("text")).mapInArrow(sign, schema)


def _sets(docs: DataFrame, id_col: str, text_col: str, wanted: DataFrame) -> DataFrame:
    """node, grams (the set as sorted 8-byte hashes) of the nodes in wanted (id, node): a row for each row of docs that
    has one of their ids, so rows that repeat an id repeat its node."""
    ids = _hinted(wanted.select(F.col("id").alias("wanted")))
    rows = docs.select(text_or_empty(text_col).cast("binary").alias("text"), F.col(id_col).alias("id"))
    texts = rows.join(ids, F.col("id").eqNullSafe(F.col("wanted")), "left_semi").select("text")

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            found = [shingle_set(t.as_py(), words) for t in batch.column(0)]
            grams = [f.tobytes() for f in found]
            sketches = np.concatenate([parity(f) for f in found]) if found else np.empty(0, np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(sketches) + 1, PARITY), pa.int32()), pa.array(sketches))
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(g) for g in grams], pa.binary()), pa.array(grams, pa.binary()), lists], ["node", "grams", "parity"])
        words.clear()
        give_back()

    return texts.mapInArrow(collect, "node binary, grams binary, parity array<long>")


def parity(shingles: np.ndarray) -> np.ndarray:
    """A bit for each of 1,024 cells: whether an odd number of the set's hashes lies in it. Where the bits
    of two sets differ, a hash is in one set only; so they differ in at least as many hashes."""
    cells = np.bincount((shingles % np.uint64(64 * PARITY)).astype(np.int64), minlength=64 * PARITY)
    return np.packbits((cells & 1).astype(np.uint8)).view(np.int64)


def _may_be_near(an: Column, ap: Column, bn: Column, bp: Column) -> Column:
    """False only where the sets are surely too far apart: similarity t needs a difference of at most
    (1 - t) / (1 + t) of the sizes' sum."""
    differ = sum((F.bit_count(ap[i].bitwiseXOR(bp[i])) for i in range(PARITY)), F.lit(0))
    return _near_in_size(an, bn) & (differ * (UNDER + OVER) <= (an + bn) * (UNDER - OVER))


def _near_in_size(a: Column, b: Column) -> Column:
    return F.least(a, b) * UNDER >= F.greatest(a, b) * OVER


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose full sets are near enough."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("ga")), "a").join(sets.select(F.col("node").alias("b"), F.col("grams").alias("gb")), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                merged = np.concatenate([x, y])
                merged.sort(kind="stable")
                shared = int((merged[1:] == merged[:-1]).sum())
                near.append(UNDER * shared >= OVER * (len(x) + len(y) - shared))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.select("a", "b", "ga", "gb").mapInArrow(check, "a binary, b binary")


def _hinted(df: DataFrame) -> DataFrame:
    """A written table of ids, broadcast if it has few rows."""
    return F.broadcast(df) if df.count() <= BROADCAST_IDS else df


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """node, root for every node of the edges (a, b); root is the least node of its component.

    Large-star and small-star rounds: neighbours are brought to the least of a neighbourhood by an
    aggregate and a join, so no neighbourhood is gathered in a task; each round is a written table.
    """
    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    def star(df: DataFrame, large: bool) -> DataFrame:
        around = df.unionByName(df.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else df
        least = around.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        joined = around.join(least, "a")
        if large:
            moved = joined.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        return moved.filter("a <> b").distinct()

    now = materialise(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), label)
    seen = state(now)
    while seen[0]:
        now = materialise(star(star(now, large=True), large=False), label)
        if (after := state(now)) == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def forest_roots(forest: DataFrame) -> DataFrame:
    """node, root for every node with a parent. forest: node, root, a parent each and no cycles. Each round
    takes the ways to the roots to a third."""
    now = materialise(forest.withColumn("moved", F.lit(True)), "near-roots")
    while not now.filter("moved").isEmpty():
        up = _hinted(now.select(F.col("node").alias("root"), F.col("root").alias("onward")))
        for _ in range(2):
            now = now.join(up, "root", "left").select("node", F.coalesce("onward", "root").alias("root"), F.col("onward").isNotNull().alias("moved"))
        now = materialise(now, "near-roots")
    return now.select("node", "root")


def _hub_links(placed: DataFrame) -> DataFrame:
    """a, b: each node and the hub that it meets in most buckets. placed: key, node, n, met. A hub has more met,
    or as much and a greater node, than the nodes that are given to it, so the links are a forest."""
    hubs = placed.groupBy("key").agg(F.max(F.struct("met", "node", "n")).alias("hub"))
    met = placed.join(hubs, "key").filter((F.col("node") != F.col("hub.node")) & _near_in_size(F.col("n"), F.col("hub.n")))
    often = met.groupBy("node", F.col("hub.node").alias("b"), F.col("hub.met").alias("m")).agg(F.count(F.lit(1)).alias("c"))
    return often.groupBy(F.col("node").alias("a")).agg(F.max(F.struct("c", "m", "b")).alias("best")).select("a", "best.b")


def _crossed(rooted: DataFrame) -> DataFrame:
    """key, major (the root of most of its rows), rows, cross (ordered pairs of different roots) of the keys with
    several roots. rooted: key, node, n, root."""
    shares = rooted.groupBy("key", "root").agg(F.count(F.lit(1)).alias("c"))
    every = shares.groupBy("key").agg(
        F.max_by("root", F.struct("c", "root")).alias("major"), F.count(F.lit(1)).alias("roots"), F.sum("c").alias("rows"), F.sum(F.col("c").cast("double") * F.col("c")).alias("squares")
    )
    return every.filter("roots > 1").select("key", "major", "rows", (F.col("rows").cast("double") * F.col("rows") - F.col("squares")).alias("cross"))


def _pairs(rooted: DataFrame, crossed: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: nodes of different roots at one key of crossed that no bound refuses: those outside the key's
    largest tree against all others."""
    open_ = rooted.join(crossed.select("key", "major"), "key").join(sets.select("node", "parity"), "node")
    minor = open_.filter(F.col("root") != F.col("major")).select("key", F.col("node").alias("a"), F.col("n").alias("an"), F.col("root").alias("ar"), F.col("parity").alias("ap"))
    others = open_.select("key", F.col("node").alias("b"), F.col("n").alias("bn"), F.col("root").alias("br"), F.col("parity").alias("bp"), "major")
    apart = (F.col("minor.key") == F.col("others.key")) & (F.col("ar") != F.col("br")) & ((F.col("br") == F.col("major")) | (F.col("a") < F.col("b")))
    met = minor.alias("minor").join(others.alias("others"), apart & _may_be_near(F.col("an"), F.col("ap"), F.col("bn"), F.col("bp")))
    return met.select("a", "b").distinct()


def rare_shingles(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """key, node, n, root: the rarest shingles of each node, by classes of how many of the nodes hold them, that
    another node holds too. nodes: node, n, root, written.

    A set that is near enough to one of n shingles lacks n / 4 of them at most. So n / 4 + 1 of a set's
    shingles, whole classes from the rarest on, hold one of the other's; and of two such choices the one that
    stops earlier lies within the other's classes. Shingles of one node alone are counted and left out."""
    whole = sets.join(_hinted(nodes.select("node")), "node", "left_semi").select("node", "grams")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                grams = np.frombuffer(batch.column(1)[i].as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(grams), batch.column(0).take(pa.array(np.full(len(grams), i)))], ["key", "node"])

    each = whole.mapInArrow(spread, "key long, node binary")
    held = materialise(each.groupBy("key").agg(F.count(F.lit(1)).alias("df")).filter("df > 1").select("key", F.ceil(F.log2("df")).cast("int").alias("class")), "near-held")
    classed = each.join(_hinted(held), "key")
    counts = classed.groupBy("node", "class").agg(F.count(F.lit(1)).alias("c"))
    of_node = Window.partitionBy("node")
    reached = counts.withColumn("all", F.sum("c").over(of_node)).withColumn("upto", F.sum("c").over(of_node.orderBy("class"))).join(_hinted(nodes), "node")
    needed = F.floor(F.col("n") * (UNDER - OVER) / UNDER) + 1
    last = reached.filter((F.col("n") - F.col("all") < needed) & (F.col("n") - F.col("all") + F.col("upto") >= needed)).groupBy("node").agg(F.min("class").alias("last"), F.first("n").alias("n"), F.first("root").alias("root"))
    last = materialise(last, "near-last")
    return classed.join(_hinted(last), "node").filter(F.col("class") <= F.col("last")).select("key", "node", "n", "root")


def _open_links(rooted: DataFrame, sets: DataFrame) -> DataFrame:
    """a, b: confirmed links between nodes of different roots. rooted: key, node, n, root of all buckets, written."""
    crossed = materialise(_crossed(rooted), "near-crossed")
    none = sets.select(F.col("node").alias("a"), F.col("node").alias("b")).filter("false")
    heavy = F.col("cross") > DIRECT * F.col("rows")
    few, many = crossed.filter(~heavy), crossed.filter(heavy)
    rows, cross, most = crossed.agg(F.sum("rows"), F.sum("cross"), F.sum(F.when(heavy, F.col("cross")))).first()
    if not rows:
        return none
    if cross > DIRECT * rows:
        nodes = materialise(rooted.join(_hinted(many.select("key")), "key", "left_semi").groupBy("node").agg(F.first("n").alias("n"), F.first("root").alias("root")), "near-open")
        rare = materialise(rare_shingles(nodes, sets), "near-rare")
        by_rare = materialise(_crossed(rare), "near-rare-crossed")
        if (by_rare.agg(F.sum("cross")).first()[0] or 0) < most:
            return _confirm(_pairs(rooted, few, sets).unionByName(_pairs(rare, by_rare, sets)).distinct(), sets)
    return _confirm(_pairs(rooted, crossed, sets), sets)


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_shingles, component_id and kept for each row of docs.

    component_id is the smallest id reachable over confirmed links. Rows without words (null, empty,
    white space) link with nothing: each is its own component. Equal sets are linked whatever their
    number. A null id takes part, and never is a component's id unless all its ids are null; kept
    compares null-safe. Repeated rows get equal results; an empty table gives no rows; other columns
    are ignored.
    """
    result = _judged(docs, id_col, text_col)
    return result.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def _judged(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, node, n, root and component_id of each row; without words root is null and component_id the row's id."""
    signed = materialise(signatures(docs, id_col, text_col), "near-signatures")
    nodes = signed.filter("n > 0").groupBy("node").agg(F.min("id").alias("id"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    nodes = materialise(nodes, "near-nodes")
    keyed = nodes.select(F.explode("bands").alias("key"), "node", "id", "n")
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    met = F.sum("members").over(Window.partitionBy("node"))  # a node has a row a band
    placed = materialise(keyed.join(shared, "key").select("key", "node", "id", "n", met.alias("met")), "near-placed")
    wanted = materialise(placed.groupBy("node").agg(F.first("id").alias("id")), "near-wanted")
    placed = placed.drop("id")
    sets = materialise(_sets(docs, id_col, text_col, wanted), "near-sets")
    if sets.count() > wanted.count():
        # Rows that repeat an id, or several texts of one: one set a node, or each link would be several.
        sets = materialise(sets.dropDuplicates(["node"]), "near-sets")

    roots = forest_roots(_confirm(_hub_links(placed), sets).select(F.col("a").alias("node"), F.col("b").alias("root")))
    rooted = materialise(placed.join(_hinted(roots), "node", "left").select("key", "node", "n", F.coalesce("root", "node").alias("root")), "near-rooted")
    more = materialise(_open_links(rooted, sets), "near-edges")
    of_node = wanted.select("node", "id").join(_hinted(roots), "node", "left").withColumn("root", F.coalesce("root", "node"))
    if not more.isEmpty():
        # Links between trees: their roots are the nodes now.
        merged = more
        for side in ("a", "b"):
            ends = roots.select(F.col("node").alias(side), "root")
            merged = merged.join(_hinted(ends), side, "left").withColumn(side, F.coalesce("root", side)).select("a", "b")
        onward = materialise(components(merged).select(F.col("node").alias("root"), F.col("root").alias("onward")), "near-onward")
        of_node = of_node.join(_hinted(onward), "root", "left").select("node", "id", F.coalesce("onward", "root").alias("root"))
    of_node = materialise(of_node, "near-members")
    least = of_node.groupBy("root").agg(F.min("id").alias("component_id"), F.count(F.lit(1)).alias("nodes")).filter("nodes > 1").drop("nodes")
    linked = of_node.select("node", "root").join(least, "root")
    every = nodes.select("node", "id").join(linked, "node", "left")
    every = every.select("node", F.coalesce("root", "node").alias("root"), F.coalesce("component_id", "id").alias("component_id"))
    result = signed.select("id", "node", "n").join(every, "node", "left")
    return result.withColumn("component_id", F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")))


def _with_nodes(rows: DataFrame, text: Column) -> DataFrame:
    """rows with the hash of each row's shingle set as _node. Column names have no dots."""
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordHashes()
        for batch in batches:
            nodes = [xxhash.xxh3_128_digest(shingle_set(t.as_py(), words).tobytes()) for t in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(nodes, pa.binary())], batch.schema.names)

    schema = StructType([*rows.schema.fields, StructField("_node", BinaryType())])
    return rows.withColumn("_node", text.cast("binary")).mapInArrow(add, schema)


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each component and all rows without words; columns stay as they are.

    The row that stays has the component's id, which is null only where all its ids are. Rows are told apart
    by id and shingle set: an id that occurs with different texts, or none, goes only where its text does. Of
    several rows with the id, that of the least set and then of the least content stays.
    """
    judged = _judged(docs, id_col, text_col)
    keys = materialise(judged.groupBy("id", "node").agg(F.count(F.lit(1)).alias("c"), F.first("n").alias("n"), F.first("root").alias("root"), F.first("component_id").alias("component_id")), "near-keys")
    first = keys.filter((F.col("n") > 0) & F.col("id").eqNullSafe(F.col("component_id"))).groupBy("root").agg(F.min(F.struct("node", "id", "c")).alias("k")).select("k.*")
    stay = materialise(first.unionByName(keys.filter("n = 0").select("node", "id", F.lit(1).cast("long").alias("c"))), "near-stay")
    counted = keys.select("id", F.lit(1).alias("k"), F.lit(0).alias("s"), F.lit(0).cast("long").alias("c")).unionByName(stay.select("id", F.lit(0).alias("k"), F.lit(1).alias("s"), "c"))
    by_id = counted.groupBy("id").agg(F.sum("k").alias("k"), F.sum("s").alias("s"), F.max("c").alias("c"))
    # Ids of which no row stays, and those of which some rows do.
    listed = materialise(by_id.filter("s < k OR c > 1").select(F.col("id").alias("_gone"), (F.col("s") > 0).alias("_partly")), "near-gone")
    # Columns are known by their places meanwhile, so that no name can clash.
    names = [f"c{i}" for i in range(len(docs.columns))]
    rows, row_id, text = docs.toDF(*names), F.col(names[docs.columns.index(id_col)]), names[docs.columns.index(text_col)]
    of_id = row_id.eqNullSafe(F.col("_gone"))
    clear = rows.join(_hinted(listed), of_id, "left_anti")
    partly = listed.filter("_partly")
    if partly.isEmpty():
        return clear.toDF(*docs.columns)
    told = _with_nodes(rows.join(_hinted(partly), of_id, "left_semi"), text_or_empty(text))
    wordless = F.col("_node") == F.lit(xxhash.xxh3_128_digest(b""))
    found = told.filter(~wordless).join(stay.select(F.col("id").alias("_gone"), F.col("node").alias("_stays")), of_id & (F.col("_node") == F.col("_stays")), "left_semi")
    whole = F.struct(*names)
    one = found.groupBy(row_id.alias("_id"), "_node").agg(F.min_by(whole, F.to_json(whole)).alias("_row")).select("_row.*")
    return clear.unionByName(told.filter(wordless).drop("_node")).unionByName(one).toDF(*docs.columns)
