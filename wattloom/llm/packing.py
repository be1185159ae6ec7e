"""Best-fit packing of documents into sequences by minimum bin slack.

A document is its token ids and an end id; only documents longer than a sequence are cut, into full
sequences and a rest. What is left to decide depends on the lengths alone, so the plan is made from
their histogram (as many counters as a sequence has tokens, whatever the number of documents): the
longest piece left opens a bin, a subset-sum over the lengths still there, kept as bits of one integer,
finds the fullest bin with it, and that combination is taken out as often as the counts allow. Then
each piece finds its place by its rank among the pieces of its length.

Null and empty texts are the end id alone. Repeated rows are packed as often as they come. Without
rows the result is empty.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import whole_text, written
from wattloom.llm.subwords import PlainWords

CAPACITY = 4096
END = 1
# Words and characters of a generation of remembered words; a dictionary doubles its table at 349,525.
MEMO = 340_000
MEMO_CHARACTERS = 4_000_000
PIECES = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, _task int, _nth bigint"


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class WordIds:
    """Token ids (as little-endian 32-bit bytes) of texts, word by word.

    The tokenizer drops white space and never looks across it, so the ids of a text are those of
    its words in turn. Words are parted at spaces and newlines only; other white space stays inside
    and is left to the library.

    Words are remembered in two generations: a full one becomes the elder, the elder before it goes,
    and what is met again moves to the younger. So frequent words stay, and what is held is bounded
    in words and in characters (but for the words of the text at hand).
    """

    def __init__(self, path: str, memo: int = MEMO, characters: int = MEMO_CHARACTERS):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.plain = PlainWords(self.tokenizer, space=False, lower=True)
        self.memo: dict[str, bytes] = {}
        self.elder: dict[str, bytes] = {}
        self.limit, self.most_characters, self.characters = memo, characters, 0

    def _learn(self, words: set[str]) -> None:
        others = []
        for word in words:
            known = self.elder.get(word)
            if known is None:
                ids = self.plain.ids(word)
                if ids is None:
                    others.append(word)
                    continue
                known = as_bytes(ids)
            self.memo[word] = known
        if others:
            found = self.tokenizer.encode_batch_fast(others, add_special_tokens=False)
            for word, encoding in zip(others, found, strict=True):
                self.memo[word] = as_bytes(encoding.ids)
        self.characters += sum(map(len, words))

    def ids(self, text: str) -> bytes:
        if len(self.memo) >= self.limit or self.characters >= self.most_characters:
            self.elder, self.memo, self.characters = self.memo, {}, 0
        words = text.replace("\n", " ").split(" ")
        missing = set(words).difference(self.memo)
        if missing:
            self._learn(missing)
        return b"".join(map(self.memo.__getitem__, words))


def pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """The pieces of each document, each numbered (_nth) among those of its length in its task."""
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # A task has one core: threads of the tokenizer's own would only take memory. What is remembered goes
        # with the task, as an executor's workers live on and would each hold it beside whatever comes next.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder, task = WordIds(tokenizer), TaskContext.get().partitionId()
        seen: dict[int, int] = {}
        for batch in batches:
            rows = []
            for doc, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = encoder.ids(content) + last
                for nth, at in enumerate(range(0, len(data), 4 * capacity)):
                    part = data[at : at + 4 * capacity]
                    length = len(part) // 4
                    rank = seen[length] = seen.get(length, -1) + 1
                    rows.append((doc, nth, at // 4, length, zlib.crc32(part), task, rank))
            columns = list(zip(*rows, strict=True)) or [()] * 7
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "_task", "_nth"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names
            )

    return docs.select(F.col(doc_id).alias("doc_id"), whole_text(text).alias("text")).mapInArrow(cut, PIECES)


def fullest(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """The multiset of available lengths whose sum comes closest to `room` from below.

    Bit s of `reach` says that some choice sums to s; the integers before each copy was added lead
    back to the choice. `lengths` is in falling order.
    """
    reach, mask, full = 1, (1 << (room + 1)) - 1, 1 << room
    steps: list[tuple[int, int]] = []
    for length in lengths:
        if length > room:
            continue
        for _ in range(min(counts[length], room // length)):
            grown = reach | reach << length & mask
            if grown == reach:
                break
            steps.append((length, reach))
            reach = grown
            if reach & full:
                break
        if reach & full:
            break
    target, chosen = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        if not before >> target & 1:
            chosen.append(length)
            target -= length
    return chosen


def plan_bins(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[list[int], int]]:
    """(lengths in a bin, number of such bins), in the order in which they are taken out."""
    counts = {n: c for n, c in histogram.items() if c}
    lengths = sorted(counts, reverse=True)
    plan = []
    while lengths:
        first = lengths[0]
        counts[first] -= 1
        rest = fullest(lengths, counts, capacity - first)
        counts[first] += 1
        bin_ = sorted([first, *rest], reverse=True)
        uses = {n: bin_.count(n) for n in set(bin_)}
        times = min(counts[n] // k for n, k in uses.items())
        plan.append((bin_, times))
        for n, k in uses.items():
            counts[n] -= k * times
        if any(counts[n] == 0 for n in uses):
            lengths = [n for n in lengths if counts[n]]
    return plan


def places(plan: list[tuple[list[int], int]]) -> dict[int, np.ndarray]:
    """By length, rows of (first rank, first bin, pieces of that length a bin, offset)."""
    rows: dict[int, list[tuple[int, int, int, int]]] = {}
    rank: dict[int, int] = {}
    bins = 0
    for bin_, times in plan:
        at = 0
        for length in dict.fromkeys(bin_):
            k = bin_.count(length)
            start = rank.get(length, 0)
            rows.setdefault(length, []).append((start, bins, k, at))
            rank[length] = start + k * times
            at += k * length
        bins += times
    return {n: np.array(r, np.int64) for n, r in rows.items()}


def place_column(found):
    """(length, rank) to (sequence_id, offset); `found` is a broadcast of `places`."""

    @F.arrow_udf("sequence_id bigint, offset bigint")
    def place(length: pa.Array, rank: pa.Array) -> pa.Array:
        lengths, ranks = length.to_numpy(zero_copy_only=False), rank.to_numpy(zero_copy_only=False)
        sequence, offset = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
        for n in np.unique(lengths):
            mine, rows = np.flatnonzero(lengths == n), found.value[int(n)]
            row = rows[np.searchsorted(rows[:, 0], ranks[mine], side="right") - 1]
            inside = ranks[mine] - row[:, 0]
            sequence[mine] = row[:, 1] + inside // row[:, 2]
            offset[mine] = row[:, 3] + inside % row[:, 2] * n
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    return place


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end: int = END,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    spark = docs.sparkSession
    # Written, as ranks belong to the tasks that gave them.
    cut = written(pieces(docs, tokenizer, capacity, end, doc_id, text), "pieces")
    by_task = cut.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    histogram = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    found = spark.sparkContext.broadcast(places(plan_bins(histogram, capacity)))
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("length", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    ranked = cut.join(bases, ["length", "_task"]).withColumn(
        "_place", place_column(found)(F.col("length"), F.col("_base") + F.col("_nth"))
    )
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "_place.*")
