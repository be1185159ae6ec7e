"""Alignment of two tokenizers' tokens by an associative monoid of fragments.

Both tokenizers see a space and the text. Byte offsets at which tokens of both end cut the tokens into groups;
tokens of the two whose bytes overlap are linked. A fragment is what is known of a range of tokens: those up to
the first common end (open prefix), the closed groups behind them, and those after the last common end (open
suffix). Two neighbours compose by joining the open ends that meet, which may close groups; any way of
bracketing gives the same.

Chunks behind a character that isn't white space and a single space (the space going with the chunk) are encoded
by both tokenizers as in the text, since no pre-token of the one and no piece of the other reaches over that
place. So a text's fragment is the product of its chunks', and these are remembered. A text of more than
RANGE_BYTES is cut into ranges that different tasks encode, each tokenizer's ranges ending where that
tokenizer certainly cuts, so not at the same bytes; their fragments are composed by a tree.

An id pair's count is the number of rows that hold it linked, over all rows. Pairs are counted by shuffle; the
table of counts is broadcast up to BROADCAST_PAIRS rows and joined by shuffle beyond.

Texts that are null, empty, or whose tokens' bytes aren't the space and the text (a text with U+2581, say) have no
tokens: zeros, and '' for the digest. Repeated rows are rows of their own and count each. Ties for the highest count
are all best. Without rows the result is empty. Other columns, whatever their names, are left aside. A very long
text without a space is one range, and one row of one task.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from array import array
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.common import whole_text, written
from wattloom.llm.subwords import byte_characters

RANGE_BYTES = 65_536
FAN = 8
SLICE_BYTES = 1 << 20
MEMO = 400_000
BROADCAST_PAIRS = 2_000_000
WORD_MARK = "▁"


class Vocabularies:
    """The two tokenizers, the bytes of their tokens, and one number for each pair of ids."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True  # their strings are plain text
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte_of = {c: i for i, c in enumerate(byte_characters())}
        vocabulary = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for piece, number in vocabulary.items():
            if all(c in byte_of for c in piece):
                self.a_bytes[number] = bytes(map(byte_of.__getitem__, piece))
        self.b_bytes = [self._piece(i) for i in range(self.b.vocab_size())]
        self.width = len(self.b_bytes)
        self.lone_space = [self.b.piece_to_id(WORD_MARK)]

    def _piece(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(number) else piece.replace(WORD_MARK, " ").encode()

    def encode_a(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]

    def encode_b(self, texts: list[str]) -> list[list[int]]:
        """Of a space and each text. Without a text the library leaves the space out, too; behind other text
        the space stays."""
        found = self.b.encode(texts, num_threads=1) if texts else []
        return [ids or self.lone_space for ids in found]


def tokens_of(ids: list[int], of: list[bytes], start: int) -> list[tuple[int, int]]:
    """(id, end in bytes) of each token."""
    out = []
    for i in ids:
        start += len(of[i])
        out.append((i, start))
    return out


Tokens = list[tuple[int, int]]
Group = tuple[Tokens, Tokens]


def cut_at_common_ends(a: Tokens, b: Tokens) -> tuple[list[Group], Group]:
    """The groups that end where tokens of both do, and what is left behind the last."""
    groups, i, j, from_i, from_j = [], 0, 0, 0, 0
    while i < len(a) and j < len(b):
        if a[i][1] < b[j][1]:
            i += 1
        elif a[i][1] > b[j][1]:
            j += 1
        else:
            i, j = i + 1, j + 1
            groups.append((a[from_i:i], b[from_j:j]))
            from_i, from_j = i, j
    return groups, (a[from_i:], b[from_j:])


def linked(a: Tokens, b: Tokens) -> Iterator[tuple[int, int]]:
    """The ids of tokens whose bytes overlap, once for each two such tokens; both begin and end together."""
    i = j = 0
    while i < len(a) and j < len(b):
        yield a[i][0], b[j][0]
        end_a, end_b = a[i][1], b[j][1]
        i += end_a <= end_b
        j += end_b <= end_a


@dataclass
class Fragment:
    """Of a range of tokens: `first` is all of it as long as it holds no common end (`whole`)."""

    first: Group = ((), ())
    last: Group = ((), ())
    whole: bool = True
    good: bool = True
    n_a: int = 0
    n_b: int = 0
    n_groups: int = 0
    n_links: int = 0
    pairs: dict[tuple[int, int], int] = field(default_factory=dict)
    text: list[str] = field(default_factory=list)

    def close(self, groups: list[Group]) -> None:
        for a, b in groups:
            self.n_groups += 1
            for pair in linked(a, b):
                self.n_links += 1
                self.pairs[pair] = self.pairs.get(pair, 0) + 1
            self.text.append(",".join(str(i) for i, _ in a) + "|" + ",".join(str(i) for i, _ in b))


def fragment(a: Tokens, b: Tokens, good: bool = True) -> Fragment:
    groups, rest = cut_at_common_ends(a, b)
    out = Fragment(good=good, n_a=len(a), n_b=len(b))
    if groups:
        out.first, out.last, out.whole = groups[0], rest, False
        out.close(groups[1:])
    else:
        out.first = rest
    return out


def composed(f: Fragment, g: Fragment) -> Fragment:
    """Of two neighbouring ranges; associative."""
    left = f.first if f.whole else f.last
    groups, rest = cut_at_common_ends([*left[0], *g.first[0]], [*left[1], *g.first[1]])
    out = Fragment(first=f.first, last=g.last, whole=f.whole and g.whole and not groups, good=f.good and g.good)
    out.n_a, out.n_b = f.n_a + g.n_a, f.n_b + g.n_b
    out.n_groups, out.n_links = f.n_groups + g.n_groups, f.n_links + g.n_links
    out.pairs, out.text = dict(f.pairs), list(f.text)
    if f.whole:
        out.first = groups[0] if groups else rest
        groups = groups[1:]
    out.close(groups)
    if g.whole and not out.whole:
        out.last = rest
    for pair, n in g.pairs.items():
        out.pairs[pair] = out.pairs.get(pair, 0) + n
    out.text += g.text
    return out


def start() -> Fragment:
    """What stands before a text: a common end, and nothing else."""
    return Fragment(whole=False)


# White space at the end of what stands between two spaces, or a second space.
SPACE_AT_END = re.compile(r"\s(?: |\Z)")


def chunks_of(text: str) -> list[str]:
    """The text's chunks; each stands behind a space that goes with it."""
    parts = text.split(" ")
    # No part is empty or ends in white space.
    if not text.startswith(" ") and not SPACE_AT_END.search(text):
        return parts
    out, held = [], []
    for part in parts:
        held.append(part)
        if part and not part[-1].isspace():
            out.append(" ".join(held))
            held = []
    if held:
        out.append(" ".join(held))
    return out


def flattened(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers in a row, and how many each row has."""
    return np.fromiter(chain.from_iterable(rows), np.int64), np.fromiter(map(len, rows), np.int64, len(rows))


class Chunks:
    """Chunks with what is known of their fragments, in columns.

    A chunk's fragment is closed at both ends, so the product of several is their sum: tokens, groups and
    links add up and groups' texts follow each other. Many chunks are laid side by side and cut at once.
    """

    def __init__(self, vocabularies: Vocabularies, limit: int = MEMO):
        self.vocabularies, self.limit, v = vocabularies, limit, vocabularies
        self.lengths = [np.fromiter(map(len, of), np.int64, len(of)) for of in (v.a_bytes, v.b_bytes)]
        # An id with what may stand behind it: a comma, or the end of its side of the group.
        self.decimals = [
            np.array([[f"{i}," for i in range(len(of))], [f"{i}{end}" for i in range(len(of))]], object)
            for of, end in ((v.a_bytes, "|"), (v.b_bytes, ";"))
        ]
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.numbers = array("q")  # good, n_a, n_b, n_groups, n_links of each
        self.text: list[str] = []
        self.pairs, self.upto = array("q"), array("q", [0])

    def learn(self, texts: list[list[str]]) -> None:
        # Long chunks count by their links.
        if max(len(self.place), len(self.pairs) // 4) > self.limit:
            self.forget()
        new = [c for c in dict.fromkeys(chain.from_iterable(texts)) if c not in self.place]
        for at in range(0, len(new), 5_000):
            self._learn(new[at : at + 5_000])

    def _all_good(self, content: bytes, size: np.ndarray, *sides: np.ndarray) -> bool:
        """Whether both sides' tokens give back every chunk: all bytes in a row, and each chunk's number of them."""
        ends = np.cumsum(size)
        for ids, n, of, lengths in zip(sides[::2], sides[1::2], (self.vocabularies.a_bytes, self.vocabularies.b_bytes), self.lengths, strict=True):
            upto = np.concatenate([[0], np.cumsum(lengths[ids])])
            if not np.array_equal(upto[np.cumsum(n)], ends) or b"".join(map(of.__getitem__, ids.tolist())) != content:
                return False
        return True

    def _learn(self, chunks: list[str]) -> None:
        v = self.vocabularies
        a, b = v.encode_a([" " + c for c in chunks]), v.encode_b(chunks)
        contents = [(" " + c).encode() for c in chunks]
        good = np.ones(len(chunks), np.int64)
        size = np.fromiter(map(len, contents), np.int64, len(contents))
        (ids_a, n_a), (ids_b, n_b) = flattened(a), flattened(b)
        if not self._all_good(b"".join(contents), size, ids_a, n_a, ids_b, n_b):
            for i, (x, y, content) in enumerate(zip(a, b, contents, strict=True)):
                if not b"".join(map(v.a_bytes.__getitem__, x)) == content == b"".join(map(v.b_bytes.__getitem__, y)):
                    good[i], a[i], b[i], contents[i] = 0, [], [], b""
            size = np.fromiter(map(len, contents), np.int64, len(contents))
            (ids_a, n_a), (ids_b, n_b) = flattened(a), flattened(b)
        limits = np.cumsum(size)
        ends_a, ends_b = (np.cumsum(of[ids]) for of, ids in zip(self.lengths, (ids_a, ids_b), strict=True))
        # Tokens overlap in just one stretch, which ends where one of them does.
        stretches, groups = np.union1d(ends_a, ends_b), np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(ends_a, stretches), np.searchsorted(ends_b, stretches)
        self.pairs.frombytes((ids_a[of_a] * v.width + ids_b[of_b]).tobytes())
        n_links, n_groups = (np.diff(np.searchsorted(x, limits, "right"), prepend=0) for x in (stretches, groups))
        start = len(self.text)
        self.place.update(zip(chunks, range(start, start + len(chunks)), strict=True))
        self.numbers.frombytes(np.stack([good, n_a, n_b, n_groups, n_links], axis=1).tobytes())
        self.upto.frombytes((self.upto[-1] + np.cumsum(n_links)).tobytes())
        # A group's ids of the one side stand before those of the other.
        side = np.concatenate([2 * np.searchsorted(groups, ends_a), 2 * np.searchsorted(groups, ends_b) + 1])
        order = np.argsort(side, kind="stable")
        last = (np.isin(ends, groups, assume_unique=True).astype(np.int64) for ends in (ends_a, ends_b))
        shown = np.concatenate([d[x, i] for d, x, i in zip(self.decimals, last, (ids_a, ids_b), strict=True)])[order].tolist()
        at = 0
        for upto in np.cumsum(n_a + n_b).tolist():
            self.text.append("".join(shown[at:upto]))
            at = upto


@lru_cache(maxsize=1)
def remembered(a_path: str, b_path: str) -> Chunks:
    # A task has one core: threads of the tokenizer's own would only wait for each other, at its expense.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Chunks(Vocabularies(a_path, b_path))


STATS = "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>"


def _columns(numbers: np.ndarray, digests: list[str], sizes: np.ndarray, pairs: np.ndarray, times: np.ndarray) -> list[pa.Array]:
    offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
    return [
        *(pa.array(np.ascontiguousarray(column)) for column in numbers.T),
        pa.array(digests, pa.string()),
        pa.ListArray.from_arrays(offsets, pa.array(pairs)),
        pa.ListArray.from_arrays(offsets, pa.array(times)),
    ]


def slices(batch: pa.RecordBatch, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, cut so that the texts of a slice have `size` bytes or are just one: chunks and
    pairs of a slice are held at once."""
    upto = np.cumsum(pc.binary_length(batch.column("text")).fill_null(0).to_numpy(zero_copy_only=False))
    at = before = 0
    while at < len(upto):
        end = max(int(np.searchsorted(upto, before + size, "right")), at + 1)
        yield batch.slice(at, end - at)
        at, before = end, upto[end - 1]


def _align(a_path: str, b_path: str):
    """Texts with the statistics of their fragments; all columns but `text` pass."""

    def batch_stats(memory: Chunks, texts: list[str]) -> list[pa.Array]:
        chunks = [chunks_of(t) if t else [] for t in texts]
        memory.learn(chunks)
        places = list(map(memory.place.__getitem__, chain.from_iterable(chunks)))
        own = np.array(places, np.int64)
        size = np.array([len(c) for c in chunks])
        text = np.repeat(np.arange(len(texts)), size)
        known = np.frombuffer(memory.numbers, np.int64).reshape(-1, 5)
        good = np.bincount(text, known[own, 0] == 0, minlength=len(texts)) == 0
        numbers = np.stack([np.bincount(text, known[own, k], minlength=len(texts)) for k in range(1, 5)], axis=1)
        numbers = numbers.astype(np.int64) * good[:, None]
        shown, upto = list(map(memory.text.__getitem__, places)), np.cumsum(size).tolist()
        digests = [
            hashlib.sha256("".join(shown[end - len(some) : end])[:-1].encode()).hexdigest() if ok and some else ""
            for some, end, ok in zip(chunks, upto, good.tolist(), strict=True)
        ]
        # Distinct chunks of each good text, then their pairs.
        alive = good[text]
        both, often = np.unique(text[alive] * len(memory.text) + own[alive], return_counts=True)
        text, own = np.divmod(both, len(memory.text)) if len(both) else (both, both)
        upto = np.frombuffer(memory.upto, np.int64)
        size = upto[own + 1] - upto[own]
        at = np.arange(size.sum()) + np.repeat(upto[own] - (np.cumsum(size) - size), size)
        span = len(memory.vocabularies.a_bytes) * memory.vocabularies.width
        keyed = np.repeat(text, size) * span + np.frombuffer(memory.pairs, np.int64)[at]
        times = np.repeat(often, size)
        pairs, group = np.unique(keyed, return_inverse=True)
        times = np.bincount(group, times, minlength=len(pairs)).astype(np.int64)
        text, pairs = np.divmod(pairs, span)
        return _columns(numbers, digests, np.bincount(text, minlength=len(texts)), pairs, times)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = remembered(a_path, b_path)
        for batch in batches:
            names = [*batch.schema.names[:-1], *(c.split()[0] for c in STATS.split(", "))]
            for part in slices(batch):
                others = [part.column(i) for i in range(part.num_columns - 1)]
                columns = batch_stats(memory, part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([*others, *columns], names)

    return align


def range_ends(text: str, size: int) -> list[tuple[int, int]]:
    """Where ranges of about `size` characters end, for the one tokenizer and for the other: behind a character
    that isn't white space, at white space or (only the first, behind a letter) at a sign, and at a space."""
    out, at, size = [], 0, max(size, 1)
    while at + size < len(text):
        a = at + size
        while a < len(text) and not (
            not text[a - 1].isspace() and text[a].isspace() or text[a - 1].isalpha() and text[a] in ",.;:!?"
        ):
            a += 1
        b = a
        while b < len(text) and not (not text[b - 1].isspace() and text[b] == " "):
            b += 1
        if b == len(text):
            break
        out.append((a, b))
        at = b
    return [*out, (len(text), len(text))]


RANGES = "digest string, nth int, a_start bigint, b_start bigint, a_text string, b_text string"


def _ranges(size: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                text = " " + text
                a = b = a_bytes = b_bytes = 0
                for nth, (to_a, to_b) in enumerate(range_ends(text, size)):
                    of_a, of_b = text[a:to_a], text[b:to_b]
                    row = ([digest], [nth], [a_bytes], [b_bytes], [of_a], [of_b])
                    kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string())
                    names = [c.split()[0] for c in RANGES.split(", ")]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row, kinds, strict=True)], names)
                    a, b = to_a, to_b
                    a_bytes, b_bytes = a_bytes + len(of_a.encode()), b_bytes + len(of_b.encode())

    return cut


# Fragments travel as JSON with the groups' text; ids and places are whole numbers.
FRAGMENTS = "digest string, nth int, fragment string"


def dumped(f: Fragment) -> str:
    pairs = [(*pair, n) for pair, n in f.pairs.items()]
    return json.dumps([f.first, f.last, f.whole, f.good, f.n_a, f.n_b, f.n_groups, f.n_links, pairs, ";".join(f.text)])


def loaded(text: str) -> Fragment:
    *values, pairs, groups = json.loads(text)
    return Fragment(*values, {(a, b): n for a, b, n in pairs}, [groups] if groups else [])


def _encode_ranges(a_path: str, b_path: str):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = remembered(a_path, b_path).vocabularies
        for batch in batches:
            rows, found = batch.to_pylist(), []
            for r in rows:
                a, b = v.encode_a([r["a_text"]])[0], v.encode_b([r["b_text"][1:]])[0] if r["b_text"] else []
                good = b"".join(map(v.a_bytes.__getitem__, a)) == r["a_text"].encode()
                good &= b"".join(map(v.b_bytes.__getitem__, b)) == r["b_text"].encode()
                made = fragment(tokens_of(a, v.a_bytes, r["a_start"]), tokens_of(b, v.b_bytes, r["b_start"]), good)
                found.append(dumped(made))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], ["digest", "nth", "fragment"])

    return encode


def _compose(rows: pa.Table) -> pa.Table:
    """The product of up to FAN neighbours."""
    rows = rows.sort_by("nth")
    whole, *rest = map(loaded, rows.column("fragment").to_pylist())
    for other in rest:
        whole = composed(whole, other)
    nth = rows.column("nth")[0].as_py() // FAN
    return pa.table([pa.array([rows.column("digest")[0].as_py()], pa.string()), pa.array([nth], pa.int32()), pa.array([dumped(whole)], pa.string())], ["digest", "nth", "fragment"])


def _finish(width: int):
    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for digest, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                f = composed(start(), loaded(text))
                if not f.good:
                    f = Fragment()
                pairs = sorted((a * width + b, n) for (a, b), n in f.pairs.items())
                numbers = np.array([[f.n_a, f.n_b, f.n_groups, f.n_links]], np.int64)
                sha = hashlib.sha256(";".join(f.text).encode()).hexdigest() if f.n_a else ""
                columns = _columns(
                    numbers, [sha], np.array([len(pairs)]),
                    np.array([p for p, _ in pairs], np.int64), np.array([n for _, n in pairs], np.int64),
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array([digest]), *columns], ["digest", *(c.split()[0] for c in STATS.split(", "))]
                )

    return finish


def long_alignments(texts: DataFrame, a_path: str, b_path: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """`digest` and statistics of each of `texts` (digest, text; one row a digest): ranges in tasks of their
    own, fragments composed FAN at a time."""
    ranges = texts.select("digest", "text").mapInArrow(_ranges(range_bytes), RANGES)
    spread = ranges.repartition("digest", "nth")
    found = written(spread.mapInArrow(_encode_ranges(a_path, b_path), FRAGMENTS), "fragments")
    left = found.agg(F.max("nth")).first()[0] or 0
    while left:
        found = found.groupBy("digest", F.expr(f"nth div {FAN}")).applyInArrow(_compose, FRAGMENTS)
        left //= FAN
    width = Vocabularies(a_path, b_path).width
    return found.mapInArrow(_finish(width), f"digest string, {STATS}")


def alignments(
    docs: DataFrame, a_path: str, b_path: str, doc_id: str = "doc_id", text: str = "text", range_bytes: int = RANGE_BYTES
) -> DataFrame:
    """doc_id, the statistics of each row's alignment, and its distinct id pairs (a * B's vocabulary + b) with
    how often they are linked."""
    content = whole_text(text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), content.alias("text"))
    fits = F.octet_length("text") <= range_bytes
    schema = f"doc_id {docs.schema[doc_id].dataType.simpleString()}, {STATS}"
    short = rows.filter(fits).mapInArrow(_align(a_path, b_path), schema)
    long = rows.filter(~fits).select("doc_id", F.sha2("text", 256).alias("digest"), "text")
    texts = long.groupBy("digest").agg(F.first("text").alias("text"))
    found = long.select("doc_id", "digest").join(long_alignments(texts, a_path, b_path, range_bytes), "digest")
    return short.unionByName(found.drop("digest"))


def pair_counts(aligned: DataFrame, width: int) -> DataFrame:
    """(pair, n, best): the rows that hold each pair, and whether that is its first id's highest."""
    counts = aligned.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts, "pairs")
    of = F.expr(f"pair div {width}L")
    highest = counts.groupBy(of.alias("of")).agg(F.max("n").alias("most"))
    return counts.withColumn("of", of).join(highest, "of").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def aligned_documents(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    doc_id: str = "doc_id",
    text: str = "text",
    range_bytes: int = RANGE_BYTES,
    broadcast_pairs: int = BROADCAST_PAIRS,
) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    found = alignments(docs, a_path, b_path, doc_id, text, range_bytes)
    # Written with a number for each row, so that it stays.
    found = written(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = written(pair_counts(found, Vocabularies(a_path, b_path).width), "counts")
    counts = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    links = found.select("row", F.inline(F.arrays_zip("pairs", "times"))).withColumnRenamed("pairs", "pair")
    scored = links.join(counts, "pair").groupBy("row").agg(
        F.sum("times").alias("all"),
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
        F.sum(F.col("times") * F.col("n")).alias("count_sum"),
    )
    none = F.lit(0).cast("bigint")
    return found.drop("pairs", "times").join(scored, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups_sha256",
    )
