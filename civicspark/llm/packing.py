"""Best-fit packing by hierarchical residual packing.

Parts of the corpus are packed best-fit on their own; nearly full bins are done; the rest become the
items of the next, smaller round, dealt anew, until one part holds them all or nothing more fits.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import give_back, materialise, text_or_empty

#: Items that one task packs at once.
GROUP_ITEMS = 100_000
#: A bin with at most this much room left is done before the last round.
SLACK = 8
#: Words that a Python worker remembers in each of two generations, some 200 bytes a word.
REMEMBER = 300_000


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _byte_letters() -> dict[int, str]:
    """The letters that stand for bytes in a byte-level vocabulary, where they differ from the bytes' own:
    bytes that don't print are numbered from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    return {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in prints)}


_BYTE_LETTERS = _byte_letters()
#: Latin letters and then marks: what the tokenizer's normalising and splitting leaves as two parts at most.
_SIMPLE = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]*)([!-&(-/:;=?-@\[-`{}~]*)")


class _WordIds(dict):
    """Ids of words, as little-endian 32-bit numbers: this vocabulary drops white space and never joins
    words across it. Texts are cut at ASCII white space only; any other is left to the tokenizer. What a
    Python worker has learned stays with it from task to task, up to a bound: a full generation becomes the
    old one, and words that are met again move on from there."""

    kept: dict[str, _WordIds] = {}

    def __init__(self, path: str):
        super().__init__()
        self.most = REMEMBER
        self.old: dict[bytes, bytes] = {}
        self.tokenizer = _tokenizer(path)
        self.model = self.tokenizer.model

    @classmethod
    def of(cls, path: str, most: int = REMEMBER) -> _WordIds:
        if path not in cls.kept:
            cls.kept[path] = cls(path)
        cls.kept[path].most = most
        return cls.kept[path]

    def __missing__(self, word: bytes) -> bytes:
        if len(self) >= self.most:
            self.old = self.copy()
            self.clear()
        if (found := self.old.get(word)) is not None:
            self[word] = found
            return found
        text = word.decode()
        if simple := _SIMPLE.fullmatch(text):
            # Letters in lower case go to the tokenizer's model at once, and so does a run of marks.
            letters, marks = simple[1].lower(), simple[2]
            if letters and not letters.isascii():
                letters = letters.encode().decode("latin-1").translate(_BYTE_LETTERS)
            ids = [t.id for part in (letters, marks) if part for t in self.model.tokenize(part)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        self[word] = found = array("I", ids).tobytes()
        return found

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, text.split()))


def pieces(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False, remember: int = REMEMBER) -> DataFrame:
    """id, piece, start, length, ids_crc32 (and ids, as little-endian 32-bit numbers) of every piece.

    A document is its ids and end_id; only one longer than size is cut, into pieces of size and a rest.
    Null counts as empty, which is one piece of end_id alone."""
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids binary" * with_ids
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _WordIds.of(tokenizer_path, remember)
        for batch in batches:
            row, number, begin, length, crc, kept = [], [], [], [], [], []
            for i, text in enumerate(batch.column(1)):
                ids = words.encode(text.as_py()) + end
                for p, at in enumerate(range(0, len(ids), 4 * size)):
                    part = ids[at : at + 4 * size]
                    row.append(i)
                    number.append(p)
                    begin.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
                    if with_ids:
                        kept.append(part)
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), pa.array(begin, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns + [pa.array(kept, pa.binary())] * with_ids, ["id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids)
        give_back()

    return docs.select(F.col(id_col), text_or_empty(text_col).cast("binary").alias("text")).mapInArrow(cut, schema)


def best_fit(lengths: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each item, and the fill of each bin.

    rooms is a bit mask of the rooms that some open bin has left; the lowest bit at or above an item's
    length is the tightest bin that takes it."""
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    fills: list[int] = []
    open_bins: list[list[int]] = [[] for _ in range(size + 1)]
    rooms = 0
    for i in order:
        n = int(lengths[i])
        above = rooms >> n
        if above:
            room = n + (above & -above).bit_length() - 1
            b = open_bins[room].pop()
            if not open_bins[room]:
                rooms &= ~(1 << room)
        else:
            b, room = len(fills), size
            fills.append(0)
        bins[i], offsets[i] = b, fills[b]
        fills[b] += n
        if left := room - n:
            open_bins[left].append(b)
            rooms |= 1 << left
    return bins, offsets, np.array(fills, np.int64)


def _pack_group(turn: int, size: int):
    def pack(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values([c for c in ("length", "id", "piece", "bin", "ids_crc32") if c in pdf], kind="stable", ignore_index=True)
        b, offset, fills = best_fit(pdf["length"].to_numpy(np.int64), size)
        return pdf.drop(columns="group").assign(new_bin=(np.int64(turn) << 58) + (np.int64(key[0]) << 28) + b, offset=offset, fill=fills[b])

    return pack


def pack(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text", group_items: int = GROUP_ITEMS, remember: int = REMEMBER) -> DataFrame:
    """id, piece, start, length, ids_crc32, sequence_id and offset of every piece.

    Each sequence holds at most size tokens, gapless from offset 0. remember: of words, by each Python worker. Rows of one id are packed one by
    one, a null id like any other; an empty table gives no rows; other columns are ignored.
    """
    cut = materialise(pieces(docs, tokenizer_path, size, end_id, id_col, text_col, remember=remember), "pack-pieces")
    groups = max(1, -(-cut.count() // group_items))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("id", "piece", "ids_crc32", "length"), F.lit(groups)))
    held = f"id {cut.schema['id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long, new_bin long, offset long, fill long"
    packed = dealt.repartition(groups, "group").groupBy("group").applyInPandas(_pack_group(0, size), held)
    packed = materialise(packed.withColumnRenamed("new_bin", "bin"), "pack-first")

    items = packed.filter((F.col("offset") == 0) & (F.col("fill") < size - SLACK)).select("bin", F.col("fill").alias("length"))
    moves, before, turn = None, None, 1
    while groups > 1:
        many = items.count()
        if not many or (before is not None and many > 0.98 * before):
            break
        groups = -(-many // group_items)
        again = items.withColumn("group", F.pmod(F.xxhash64("bin", F.lit(turn)), F.lit(groups))).repartition(groups, "group")
        merged = again.groupBy("group").applyInPandas(_pack_group(turn, size), "bin long, length long, new_bin long, offset long, fill long")
        merged = materialise(merged, "pack-round")
        step = merged.select("bin", "new_bin", F.col("offset").alias("base"))
        if moves is None:
            moves = step
        else:
            later = step.select(F.col("bin").alias("new_bin"), F.col("new_bin").alias("next"), F.col("base").alias("more"))
            moves = moves.join(later, "new_bin", "left").select("bin", F.coalesce("next", "new_bin").alias("new_bin"), (F.col("base") + F.coalesce("more", F.lit(0))).alias("base"))
        items = merged.filter((F.col("offset") == 0) & (F.col("fill") < size - SLACK)).select(F.col("new_bin").alias("bin"), F.col("fill").alias("length"))
        before, turn = many, turn + 1
    if moves is not None:
        moves = materialise(moves, "pack-moves")
        packed = packed.join(moves, "bin", "left").withColumn("bin", F.coalesce("new_bin", "bin")).withColumn("offset", F.col("offset") + F.coalesce("base", F.lit(0)))
    return packed.select(F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def sequences(packed: DataFrame, with_ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """sequence_id, ids of every packed sequence; with_ids is pieces(..., with_ids=True). A sequence has
    at most size pieces, so what is gathered is bounded. Needs ids that are unique and not null."""
    joined = packed.join(with_ids.select(F.col("id").alias(id_col), "piece", "ids"), [id_col, "piece"])
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return joined.groupBy("sequence_id").agg(F.aggregate(inside, F.lit(b""), lambda done, x: F.concat(done, x["ids"])).alias("ids"))
