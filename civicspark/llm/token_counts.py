"""Token counts by byte-pair merging with a heap over a linked list of symbols.

The count is the number of initial symbols less the merges; no identifiers are made.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: The mark that stands for a space in the vocabulary.
SPACE = "▁"
#: Word counts that a Python worker remembers, from task to task, before it starts anew.
REMEMBER = 600_000


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[str, float]:
    """Piece -> rank (lower merges first) of a sentencepiece BPE model; once in each Python worker."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    plain = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i)))
    return {model.id_to_piece(i): -model.get_score(i) for i in plain}


def count_merged(symbols: str, ranks: dict[str, float]) -> int:
    """Tokens of one run of symbols.

    Every adjacent pair whose joined text has a rank waits in a heap by (rank, position). The lowest
    is popped; if both its ends are still as they were, they are merged and the pairs on either side
    of the new symbol join the heap. A symbol outside the vocabulary counts as its UTF-8 bytes.
    """
    n = len(symbols)
    count = sum(1 if c in ranks else len(c.encode("utf-8", "surrogatepass")) for c in symbols)
    if n < 2:
        return count
    end = list(range(1, n + 1))  # of the live symbol that starts here; 0: merged into an earlier one
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(symbols[i : i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, left, stop = heapq.heappop(heap)
        right = end[left]
        if not right or right >= n or end[right] != stop:
            continue
        end[left], end[right] = stop, 0
        count -= 1
        if stop < n:
            before[stop] = left
            if (r := ranks.get(symbols[left : end[stop]])) is not None:
                heapq.heappush(heap, (r, left, end[stop]))
        if (p := before[left]) >= 0 and (r := ranks.get(symbols[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    return count


class WordCounts(dict):
    """Remembers the count of each run seen; forgets all of them rather than grow without bound."""

    kept: dict[str, WordCounts] = {}

    def __init__(self, ranks: dict[str, float]):
        super().__init__()
        self.ranks = ranks

    @classmethod
    def of(cls, model_path: str) -> WordCounts:
        if model_path not in cls.kept:
            cls.kept[model_path] = cls(load_ranks(model_path))
        return cls.kept[model_path]

    def __missing__(self, run: str) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        found = count_merged(run, self.ranks)
        if len(run) <= 64:
            self[run] = found
        return found


def count_text(text: str, words: WordCounts) -> int:
    """Tokens of a whole text. No piece has a space mark after another character, so no merge crosses
    from one word into the next: each word counts with the marks before it."""
    if not text:
        return 0
    if SPACE in text:
        text = text.replace(SPACE, " ")
    parts = text.split(" ")
    if "" not in parts:
        get = words.__getitem__
        return sum(get(SPACE + p) for p in parts)
    total, marks = 0, ""
    for p in parts:
        marks += SPACE
        if p:
            total += words[marks + p]
            marks = ""
    return total + (words[marks] if marks else 0)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) for each row of docs.

    Null counts as empty: 0 bytes, 0 tokens. Repeated rows and null ids pass through one to one; an
    empty table gives no rows; other columns are ignored. There is no shuffle and nothing is kept
    but a bounded memory of words.
    """
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_bytes long, n_tokens long, over_limit boolean"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordCounts.of(model_path)
        for batch in batches:
            texts = batch.column(1).fill_null("")
            n = pa.array([count_text(t.as_py(), words) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), pc.cast(pc.binary_length(texts), pa.int64()), n, pc.greater(n, limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(id_col, text_col).mapInArrow(count, schema).withColumnRenamed("id", id_col)
