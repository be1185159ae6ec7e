"""SimHash near-duplicates, found by the pigeonring principle.

A fingerprint is cut into eight segments that stand in a ring. Where two fingerprints differ in at
most four bits, there is a segment from which on every chain of l consecutive segments differs in
at most l / 2 bits in all. So the first segment is equal, and of the next two at least one: these are
the keys under which fingerprints meet (two for each of eight starts). A pair then has to pass the
chains' budgets one after the other, up to the whole ring, which is the Hamming check itself.

Words, shingles and bits are as `fingerprint` says. Null and empty texts have fingerprint zero and are
linked like any other. Equal fingerprints meet once, whatever the number of documents. Repeated rows
get the same component; a null id is never a component's smallest unless it has no other. Without
rows the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.common import unique_name, whole_text, written
from wattloom.llm.components import components
from wattloom.llm.groups import in_block_pairs, whole_groups

WORDS = 4
SEED = 42
SEGMENTS = 8
DISTANCE = 4
ROWS_A_BLOCK = 8192
AT_ONCE = 65_536
LINKS = "a bigint, b bigint"


def fingerprint(text: str, words: int = WORDS, seed: int = SEED) -> int:
    """64 bits: each set where it is in more than half of the hashes of the text's shingles."""
    # bytes.lower() and bytes.split() know ASCII letters and ASCII white space only.
    found = text.encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return 0
    joined = b" ".join(found)
    if len(found) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 0x20)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(joined)]])
    total = len(found) - words + 1
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, total, AT_ONCE):
        upto = min(at + AT_ONCE, total)
        bounds = zip(starts[at:upto].tolist(), ends[at + words - 1 : upto + words - 1].tolist(), strict=True)
        hashes = np.fromiter((digest(joined[s:e], seed) for s, e in bounds), np.uint64, upto - at)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > total).tolist())


@F.arrow_udf(T.LongType())
def fingerprint_column(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        found = np.array([fingerprint(t) for t in texts.to_pylist()], np.uint64)
        yield pa.array(found.view(np.int64))


def chain_keys(print_: str) -> F.Column:
    """The sixteen keys of a fingerprint: table number, first segment, and one of the next two."""
    segment = [F.shiftrightunsigned(print_, 8 * s).bitwiseAND(F.lit(0xFF)) for s in range(SEGMENTS)]
    return F.array(
        *[
            F.lit((2 * s + way) << 16).cast("bigint") + segment[s] * 256 + segment[(s + 1 + way) % SEGMENTS]
            for s in range(SEGMENTS)
            for way in (0, 1)
        ]
    )


def within_budgets(differing: np.ndarray, start: np.ndarray, distance: int = DISTANCE) -> np.ndarray:
    """Places of those bit differences whose chains from segment `start` on keep their budgets."""
    turn = (8 * start).astype(np.uint64)
    ring = np.where(turn == 0, differing, differing >> turn | differing << (np.uint64(64) - turn) % np.uint64(64))
    alive = np.arange(len(ring))
    for chain in range(1, SEGMENTS + 1):
        mask = np.uint64((1 << 8 * chain) - 1)
        alive = alive[np.bitwise_count(ring[alive] & mask) <= distance * chain // SEGMENTS]
    return alive


def link_groups(group: np.ndarray, prints: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links inside the groups (rows in order of their group)."""
    nodes, place = np.unique(prints, return_inverse=True)
    label = np.arange(len(nodes))
    left, right = [], []
    rows, step = np.arange(len(group)), 1
    while True:
        rows = rows[rows + step < len(group)]
        rows = rows[group[rows + step] == group[rows]]
        if not len(rows):
            break
        apart = rows[label[place[rows]] != label[place[rows + step]]]
        near = within_budgets(prints[apart] ^ prints[apart + step], start[apart])
        for x, y in zip(place[apart[near]].tolist(), place[apart[near] + step].tolist(), strict=True):
            if label[x] != label[y]:
                left.append(nodes[x])
                right.append(nodes[y])
                label[label == label[y]] = label[x]
        step += 1
    return np.array(left, np.uint64), np.array(right, np.uint64)


def _link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, group in whole_groups(batches, 3):
        start = table.column("key").to_numpy() >> 17
        prints = table.column("print").to_numpy().astype(np.int64).view(np.uint64)
        a, b = link_groups(group, prints, start)
        yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])


def links(prints: DataFrame, rows_a_block: int = ROWS_A_BLOCK) -> DataFrame:
    """Pairs (a, b) of near fingerprints that connect all that are near; `prints` has distinct
    fingerprints in the column `print`."""
    keyed = prints.select(F.explode(chain_keys("print")).alias("key"), "print")
    dealt = in_block_pairs(keyed, "key", "print", rows_a_block).select("key", "_i", "_j", "print")
    dealt = dealt.repartition("key", "_i", "_j").sortWithinPartitions("key", "_i", "_j")
    return dealt.mapInArrow(_link, LINKS)


def print_components(prints: DataFrame) -> DataFrame:
    """(print, root) for each distinct fingerprint of `prints`."""
    distinct = written(prints.select("print").distinct(), "prints")
    joined = components(links(distinct))
    return distinct.join(joined, distinct["print"] == joined["node"], "left").select(
        "print", F.coalesce("root", "print").alias("root")
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), fingerprint_column(whole_text(text)).alias("print")
    )
    rows = written(rows, "fingerprints")
    roots = print_components(rows)
    # Documents meet by fingerprint first, so that a group of copies is one row beyond here.
    least = rows.groupBy("print").agg(F.min("doc_id").alias("least")).join(roots, "print")
    smallest = least.groupBy("root").agg(F.min("least").alias("component_id"))
    named = least.join(smallest, "root").select("print", "component_id")
    return rows.join(named, "print").select(
        "doc_id", F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_per_component(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` less all but one of each component: the smallest id stays, and of
    several rows with it the one with the smallest text hash."""
    content = F.xxhash64(whole_text(text))
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), content.alias("content"), fingerprint_column(whole_text(text)).alias("print")
    )
    rows = written(rows, "fingerprints")
    first = F.min(F.struct(F.isnull("doc_id").alias("none"), "doc_id", "content")).alias("first")
    least = rows.groupBy("print").agg(first)
    best = least.join(print_components(rows), "print").groupBy("root").agg(F.min("first").alias("first"))
    hashed, own, nth = (unique_name(docs, n) for n in ("_content", "_own", "_nth"))
    best = best.select(F.col("first.doc_id").alias(own), F.col("first.content").alias(hashed))
    rows = docs.withColumn(hashed, content)
    kept = rows.join(best, (F.col(doc_id).eqNullSafe(F.col(own))) & (rows[hashed] == best[hashed])).drop(
        best[hashed]
    )
    # Rows that repeat both id and text.
    alike = Window.partitionBy(own, hashed).orderBy(*[c for c, kind in docs.dtypes if "map" not in kind])
    return kept.withColumn(nth, F.row_number().over(alike)).filter(F.col(nth) == 1).select(*docs.columns)
