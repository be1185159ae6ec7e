"""Fuzzy line deduplication: MinHash over character shingles, banding, exact Jaccard, union-find.

Lines end at a newline. They are compared by their normal form: lower case, runs of white space as one
space, none at the ends; lines without any other character are left alone. A line's shingles are its
five-character substrings (a shorter line is its own one shingle). Lines are near if the Jaccard
similarity of their shingle sets is 0.8 or more. Candidates agree in all six hashes of one of sixteen
bands, which a pair at the threshold misses with probability (1 - 0.8^6)^16 = 0.008. All lines that
meet in a band are verified on their real shingles as far as they aren't joined yet. One changed character inside
a line is caught from 49 characters on. Each component keeps
the line that comes first by document id and line number; the rest go.

Equal lines count as one, whatever their number. Rows that repeat id and text share their decisions, and
each keeps the line that is kept. A null id comes after all others. Null and empty texts have no lines to
drop. Without rows the result is empty. Lines are known by 64-bit hashes of their normal forms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wattloom.llm.collocations import frequent_filter, in_filter
from wattloom.llm.common import unique_name, whole_text, written
from wattloom.llm.components import components
from wattloom.llm.groups import whole_groups

SHINGLE = 5
ROWS = 6
BANDS = 16
SIMILARITY = 0.8
LINES_A_BLOCK = 1000
CHARACTERS_AT_ONCE = 131_072
SHINGLES_AT_ONCE = 500_000
KEYS_AT_ONCE = 1_000_000
# A bucket is a key's first twelve bits: 4096 buckets.
BUCKET_SHIFT = 52
LINES_IN_A_MATRIX = 100
_RANDOM = np.random.default_rng(20_240_131)
FACTORS = _RANDOM.integers(1, 1 << 32, ROWS * BANDS, dtype=np.uint32) | np.uint32(1)
MASKS = _RANDOM.integers(0, 1 << 32, ROWS * BANDS, dtype=np.uint32)
BASE = 0x9E3779B1


def normal_form(line: str) -> str:
    line = line.lower().strip()
    # A printable line has no white space but the space itself.
    return line if "  " not in line and line.isprintable() else " ".join(line.split())


def normal_forms(text: str) -> list[str]:
    """Of all lines of a text; where no line needs more than to be trimmed, the text is looked at as a whole."""
    lowered = text.lower()
    if "  " not in lowered and lowered.replace("\n", "").isprintable():
        return [line.strip() for line in lowered.split("\n")]
    return [normal_form(line) for line in text.split("\n")]


def line_hash(normal: str) -> int:
    """64 bits, signed, as Spark has them."""
    found = xxhash.xxh3_64_intdigest(normal.encode("utf-8", "surrogatepass"))
    return found - (1 << 64) if found >> 63 else found


def shingles(normal: str) -> set[str]:
    return {normal[i : i + SHINGLE] for i in range(max(1, len(normal) - SHINGLE + 1))}


def similar(a: set[str], b: set[str], least: float = SIMILARITY) -> bool:
    common = len(a & b)
    return common >= least * (len(a) + len(b) - common)


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """One hash for each shingle of all lines, and the bounds of each line's hashes in them as
    (first, end) in turn; what lies between an end and the next first belongs to no line."""
    padded = [line.ljust(SHINGLE, "\0") for line in lines]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), "<u4")
    hashes, width = points.astype(np.uint32), 1
    while width < SHINGLE:
        # Doubled, and at last laid over itself as far as needed.
        step = min(width, SHINGLE - width)
        factor = np.uint32(pow(BASE, width, 1 << 32))
        hashes = hashes[:-step] * factor + hashes[step:]
        width += step
    hashes ^= hashes >> np.uint32(16)
    hashes *= np.uint32(0x85EBCA6B)
    hashes ^= hashes >> np.uint32(13)
    hashes *= np.uint32(0xC2B2AE35)
    hashes ^= hashes >> np.uint32(16)
    lengths = np.array([len(line) for line in padded])
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    bounds = np.stack([first, first + lengths - SHINGLE + 1], axis=1).ravel()
    return np.append(hashes, np.uint32(0)), bounds


def band_keys(lines: list[str]) -> np.ndarray:
    """Row i: the band keys of line i."""
    hashes, bounds = shingle_hashes(lines)
    # Only what belongs to a line, so that a line's end is the next one's first.
    own = np.zeros(len(hashes) + 1, np.int8)
    own[bounds[::2]] += 1
    own[bounds[1::2]] -= 1
    hashes = hashes[np.cumsum(own[:-1], dtype=np.int8).astype(bool)]
    size = bounds[1::2] - bounds[::2]
    first, mixed = np.cumsum(size) - size, np.empty_like(hashes)
    keys = np.empty((len(lines), BANDS), np.uint64)
    for band in range(BANDS):
        key = np.full(len(lines), band + 1, np.uint64)
        for h in range(band * ROWS, (band + 1) * ROWS):
            np.bitwise_xor(hashes, MASKS[h], out=mixed)
            np.multiply(mixed, FACTORS[h], out=mixed)
            least = np.minimum.reduceat(mixed, first)
            key = (key ^ least) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, band] = key
    return keys.view(np.int64)


def distinct_lines(texts: list[str], seen: set[int]) -> tuple[list[int], list[str]]:
    """Hashes and normal forms of the lines whose hashes aren't in `seen` yet."""
    hashes, lines = [], []
    for text in texts:
        for normal in normal_forms(text):
            if normal and (hashed := line_hash(normal)) not in seen:
                seen.add(hashed)
                hashes.append(hashed)
                lines.append(normal)
    return hashes, lines


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keys and lines as blocks of 64-bit numbers, all keys of a block from one of 4096 ranges: rows of one
    key each would cost the shuffle more than the hashing."""
    held: list[np.ndarray] = []

    def blocks() -> Iterator[pa.RecordBatch]:
        if not held:
            return
        rows = np.concatenate(held)
        held.clear()
        # Numbers of 16 bits are sorted by radix.
        rows = rows[np.argsort((rows[:, 0] >> BUCKET_SHIFT).astype(np.int16), kind="stable")]
        bucket = rows[:, 0] >> BUCKET_SHIFT
        first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
        block = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(first), [None, pa.py_buffer(np.append(first, len(rows)) * 16), pa.py_buffer(rows)]
        )
        yield pa.RecordBatch.from_arrays([pa.array(bucket[first]), block.cast(pa.binary())], ["bucket", "block"])

    for batch in batches:
        hashes, lines = distinct_lines(batch.column(0).to_pylist(), set())
        for at, upto in in_parts([len(line) for line in lines], CHARACTERS_AT_ONCE):
            keys = band_keys(lines[at:upto])
            line = np.repeat(np.array(hashes[at:upto], np.int64), BANDS)
            held.append(np.stack([keys.ravel(), line], axis=1))
            if sum(map(len, held)) >= KEYS_AT_ONCE:
                yield from blocks()
    yield from blocks()


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From blocks sorted by bucket: each other line under a key with the key's least line."""
    held: list[bytes] = []
    last = None

    def pairs() -> Iterator[pa.RecordBatch]:
        rows = np.frombuffer(b"".join(held), np.int64).reshape(-1, 2)
        held.clear()
        if not len(rows):
            return
        rows = rows[np.argsort(rows[:, 0])]
        keys, lines = rows[:, 0], rows[:, 1]
        new = np.append(True, keys[1:] != keys[:-1])
        leaders = np.minimum.reduceat(lines, np.flatnonzero(new))[np.cumsum(new) - 1]
        other = lines != leaders
        found = pa.table([pa.array(leaders[other]), pa.array(lines[other])], ["leader", "line"])
        yield from found.group_by(["leader", "line"]).aggregate([]).to_batches()

    for batch in batches:
        for bucket, block in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != last:
                yield from pairs()
                last = bucket
            held.append(block.as_py())
    yield from pairs()


def _texts(shared):
    """The lines that are in the filter, and those that it lets through besides."""

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, lines = distinct_lines(batch.column(0).to_pylist(), set())
            hashes = np.array(hashes, np.int64)
            needed = np.flatnonzero(in_filter(shared.value, hashes.view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[needed]), pa.array([lines[i] for i in needed.tolist()], pa.string())], ["line", "normal"]
            )

    return texts


def shingle_codes(lines: list[str]) -> tuple[np.ndarray, np.ndarray, int]:
    """A number for each shingle of all lines, equal for equal shingles only; the line of each; and how many
    bits the numbers have."""
    size = np.array([len(line) for line in lines])
    points = np.frombuffer("".join([line.ljust(SHINGLE, "\0") for line in lines]).encode("utf-32-le", "surrogatepass"), "<u4")
    width = np.maximum(size, SHINGLE)
    first = np.cumsum(width) - width
    if (size < SHINGLE).any():
        # What fills up a short line is no character.
        points = points.copy()
        for i in np.flatnonzero(size < SHINGLE).tolist():
            points[first[i] + size[i] : first[i] + SHINGLE] = 0x110000
    known = np.zeros(int(points.max()) + 1, bool)
    known[points] = True
    points = (np.cumsum(known) - 1)[points]
    bits = int(known.sum() - 1).bit_length()
    n = len(points) - SHINGLE + 1

    def packed(at: int, upto: int) -> np.ndarray:
        found = points[at : at + n]
        for k in range(at + 1, upto):
            found = found << bits | points[k : k + n]
        return found

    if bits * SHINGLE <= 60:
        codes, bits = packed(0, SHINGLE), bits * SHINGLE
    else:
        parts = (np.unique(packed(at, upto), return_inverse=True)[1] for at, upto in ((0, 3), (3, SHINGLE)))
        head, tail = parts
        codes, bits = head << 30 | tail, 60
    # Windows over the end of a line belong to none.
    line = np.repeat(np.arange(len(lines)), width)[:n]
    own = np.arange(n) <= (first + width - SHINGLE)[line]
    return codes[own], line[own], bits


def shingle_lists(lines: list[str], group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each shingle of a group the lines that have it: line and number of the list, in the order of the
    groups (0 and up, rising with the lines), the lists and the lines."""
    codes, line, bits = shingle_codes(lines)
    of_line, of_group = len(lines).bit_length(), int(group[-1]).bit_length()
    if of_line + of_group + bits > 63:
        codes = np.unique(codes, return_inverse=True)[1]
        bits = len(codes).bit_length()
    key = (group[line] << bits | codes) << of_line | line
    key.sort()
    key = key[np.append(True, key[1:] != key[:-1])]
    line = key & ((1 << of_line) - 1)
    key >>= of_line
    return line, np.cumsum(np.append(0, key[1:] != key[:-1]))


def in_parts(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Ranges of what has these sizes, of at most that size together or of one."""
    at = 0
    while at < len(sizes):
        upto, size = at + 1, sizes[at]
        while upto < len(sizes) and size + sizes[upto] <= most:
            size += sizes[upto]
            upto += 1
        yield at, upto
        at = upto


def enough(common: np.ndarray, size: np.ndarray, other: np.ndarray) -> np.ndarray:
    return common >= SIMILARITY * (size + other - common)


@F.arrow_udf(T.BooleanType())
def near_column(own: pa.Array, other: pa.Array) -> pa.Array:
    """Rows with the same second text in a row are held against it together."""
    groups: list[list[str]] = []
    for a, b in zip(own.to_pylist(), other.to_pylist(), strict=True):
        if not groups or groups[-1][0] != b:
            groups.append([b])
        groups[-1].append(a)
    found = []
    for at, upto in in_parts([sum(map(len, g)) for g in groups], SHINGLES_AT_ONCE):
        part = groups[at:upto]
        group = np.repeat(np.arange(len(part)), [len(g) for g in part])
        leads = np.append(True, group[1:] != group[:-1])
        line, lists = shingle_lists([x for g in part for x in g], group)
        size = np.bincount(line, minlength=len(group))
        # A leader is the first line of all lists that it is in.
        led = leads[line[np.append(True, lists[1:] != lists[:-1])]]
        common = np.bincount(line[led[lists]], minlength=len(group))
        found.append(enough(common, size, size[leads][group])[~leads])
    return pa.array(np.concatenate(found) if found else np.empty(0, bool))


def common_shingles(line: np.ndarray, lists: np.ndarray, n: int, alone: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Each line of `alone` with the numbers of shingles it has in common with all `n` lines of a group."""
    lists = lists - lists[0] if len(lists) else lists
    if n <= LINES_IN_A_MATRIX:
        columns = int(lists[-1]) + 1 if len(lists) else 0
        having = np.zeros((n, columns), np.float32)
        having[line, lists] = 1
        yield from zip(alone.tolist(), (having[alone] @ having.T).astype(np.int64), strict=True)
        return
    length = np.bincount(lists)
    start = np.cumsum(length) - length
    by_line = np.argsort(line, kind="stable")
    bounds = np.searchsorted(line[by_line], np.arange(n + 1))
    for i in alone.tolist():
        own = lists[by_line[bounds[i] : bounds[i + 1]]]
        each = length[own]
        at = np.repeat(start[own] - (np.cumsum(each) - each), each) + np.arange(each.sum())
        yield i, np.bincount(line[at], minlength=n)


def verified(groups: list[dict[int, list]]) -> list[tuple[int, int]]:
    """A spanning forest of the near pairs of a line that stands apart and any other line of its group;
    a group holds text and standing by line."""
    names = [name for g in groups for name in g]
    rows = [row for g in groups for row in g.values()]
    sizes = [len(g) for g in groups]
    group = np.repeat(np.arange(len(groups)), sizes)
    apart = np.array([alone for _, alone in rows], bool)
    line, lists = shingle_lists([text for text, _ in rows], group)
    size = np.bincount(line, minlength=len(names))
    shared = (np.bincount(lists) > 1)[lists]
    line, lists = line[shared], lists[shared]
    lists = np.cumsum(np.append(0, lists[1:] != lists[:-1])) if len(lists) else lists
    bounds = np.searchsorted(group[line], np.arange(len(groups) + 1)).tolist()
    found, first = [], 0
    for g, n in enumerate(sizes):
        own = slice(bounds[g], bounds[g + 1])
        of = size[first : first + n]
        label = np.arange(n)
        for i, common in common_shingles(line[own] - first, lists[own], n, np.flatnonzero(apart[first : first + n])):
            near = enough(common, of[i], of) & (label != label[i])
            for j in np.flatnonzero(near).tolist():
                if label[j] != label[i]:
                    found.append((names[first + i], names[first + j]))
                    label[label == label[j]] = label[i]
        first += n
    return found


def _verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for table, group in whole_groups(batches, 3, 500):
        groups: list[dict[int, list]] = []
        rows = zip(group.tolist(), *(table.column(c).to_pylist() for c in ("line", "normal", "apart")), strict=True)
        last = None
        for g, line, normal, apart in rows:
            if g != last:
                groups.append({})
                last = g
            groups[-1].setdefault(line, [normal, False])[1] |= apart
        found = []
        for at, upto in in_parts([sum(len(text) for text, _ in g.values()) for g in groups], SHINGLES_AT_ONCE):
            found += verified(groups[at:upto])
        a, b = zip(*found, strict=True) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def cells(members: DataFrame, lines_a_block: int) -> DataFrame:
    """Rows (leader, i, j, line, apart) such that every line of a group that isn't near its leader
    meets every other line of the group in some cell (i, j) of at most two blocks."""
    sizes = members.groupBy("leader").agg(
        F.ceil(F.count(F.lit(1)) / lines_a_block).cast("int").alias("blocks"),
        F.ceil(F.count_if(~F.col("near")) / lines_a_block).cast("int").alias("sides"),
    )
    own = F.xxhash64("line")
    mine, side = F.pmod(own, F.col("blocks")).cast("int"), F.pmod(own, F.col("sides")).cast("int")

    def cell(i: F.Column, j: F.Column, apart: bool) -> F.Column:
        return F.struct(i.alias("i"), j.alias("j"), F.lit(apart).alias("apart"))

    everyone = F.transform(F.sequence(F.lit(0), F.col("sides") - 1), lambda i: cell(i, mine, False))
    alone = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda j: cell(side, j, True))
    places = F.when(F.col("near"), everyone).otherwise(F.concat(everyone, alone))
    return members.join(sizes, "leader").select("leader", "line", F.inline(places))


def line_components(docs: DataFrame, text: str = "text") -> DataFrame:
    """(node, root) for the lines, by hash, that are near to others but aren't their component's
    least.

    Lines that met under a key are first held against their leader. Those that are near it are
    joined by that; only the lines that aren't have to be held against the rest of their group. So a
    group of near copies costs as much as it has lines.
    """
    content = docs.select(whole_text(text).alias("text"))
    bands = content.mapInArrow(_sign, "bucket bigint, block binary")
    met = bands.repartition("bucket").sortWithinPartitions("bucket")
    met = written(met.mapInArrow(_meet, "leader bigint, line bigint").distinct(), "met")
    needed = met.select("line", F.lit(False).alias("leads")).union(met.select("leader", F.lit(True)))
    needed = written(needed.groupBy("line").agg(F.max("leads").alias("leads")), "needed")
    shared = docs.sparkSession.sparkContext.broadcast(
        frequent_filter(needed.select(F.col("line").alias("mark")), needed.count())
    )
    normal = content.mapInArrow(_texts(shared), "line bigint, normal string")
    normal = normal.groupBy("line").agg(F.first("normal").alias("normal")).join(needed, "line")
    normal = written(normal, "normal")
    leaders = normal.filter("leads").select(F.col("line").alias("leader"), F.col("normal").alias("other"))
    star = met.join(normal, "line").join(leaders, "leader")
    star = written(star.select("leader", "line", near_column("normal", "other").alias("near")), "star")
    mixed = star.filter(~F.col("near")).select("leader").distinct()
    # A leader is a member of its own group.
    members = star.join(mixed, "leader").union(mixed.select("leader", F.col("leader").alias("line"), F.lit(True).alias("near")))
    dealt = cells(members, LINES_A_BLOCK).join(normal.drop("leads"), "line").select("leader", "i", "j", "line", "normal", "apart")
    dealt = dealt.repartition("leader", "i", "j").sortWithinPartitions("leader", "i", "j")
    joined = star.filter("near").select("leader", "line")
    return components(joined.union(dealt.mapInArrow(_verify, "a bigint, b bigint")))


@F.arrow_udf(T.ArrayType(T.LongType()))
def hash_lines(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        found = [
            [line_hash(n) if n else None for n in normal_forms(text)] for text in texts.to_pylist()
        ]
        yield pa.array(found, pa.list_(pa.int64()))


def line_decisions(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per distinct (id, text hash) with lines to drop: doc_id, content (the hash), dropped (line
    numbers from 0, rising) and kept_by (for each, the document that keeps the component's line)."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole_text(text)).alias("content"),
        hash_lines(whole_text(text)).alias("lines"),
    )
    # Within a document the first of equal lines speaks for them.
    places = rows.select("doc_id", "content", F.posexplode("lines").alias("nth", "line"))
    places = written(places.filter(F.col("line").isNotNull()), "places")
    joined = line_components(docs, text)
    place = F.struct(F.isnull("doc_id").alias("none"), "doc_id", "content", "nth")
    of_line = places.groupBy("line").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"))
    # Only lines that come again or are near to others go on; the rest has nothing to drop.
    joined = joined.union(joined.select("root", "root").distinct())
    known = of_line.join(joined, of_line["line"] == joined["node"], "left").filter("n > 1 OR root IS NOT NULL")
    known = written(known.select("line", F.coalesce("root", "line").alias("root"), "first", "n"), "known")
    first = known.groupBy("root").agg(F.min("first").alias("first"), F.sum("n").alias("n")).filter("n > 1")
    first = known.select("line", "root").join(first.select("root", "first"), "root").drop("root")
    dropped = places.join(first, "line").filter(place != F.col("first"))
    return dropped.groupBy("doc_id", "content").agg(
        F.array_sort(F.collect_set(F.struct("nth", F.col("first.doc_id").alias("by")))).alias("found")
    ).select(
        "doc_id", "content", F.col("found.nth").alias("dropped"), F.col("found.by").alias("kept_by")
    )


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with the text of each row less the lines that go; a null text stays null."""
    own, hashed, gone, split = (unique_name(docs, n) for n in ("_own", "_content", "_gone", "_split"))
    decisions = line_decisions(docs, doc_id, text).select(
        F.col("doc_id").alias(own), F.col("content").alias(hashed), F.col("dropped").alias(gone)
    )
    # By difference of positions: one hash set a text, however many lines go.
    stay = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), F.col(gone))
    left = F.transform(stay, lambda nth: F.get(F.col(split), nth))
    changed = F.when(F.col(gone).isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    on = F.col(doc_id).eqNullSafe(F.col(own)) & (F.xxhash64(whole_text(text)) == F.col(hashed))
    found = docs.join(decisions, on, "left")
    # A column of its own, as the lambda would split the text for each line.
    found = found.withColumn(split, F.when(F.col(gone).isNotNull(), F.split(F.col(text), "\n", -1)))
    return found.withColumn(text, changed).select(*docs.columns)


def with_length(docs: DataFrame, name: str, text: str = "text") -> DataFrame:
    """`docs` with the text's characters counted anew in an existing column."""
    return docs.withColumn(name, F.length(text).cast(docs.schema[name].dataType))


def decisions_by_document(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row's doc_id, n_lines, n_dropped, dropped and kept_by."""
    decisions = line_decisions(docs, doc_id, text).withColumnRenamed("doc_id", "own")
    rows = docs.select(
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(whole_text(text)).alias("hashed"),
        (F.length(whole_text(text)) - F.length(F.replace(whole_text(text), F.lit("\n"), F.lit(""))) + 1)
        .cast("bigint").alias("n_lines"),
    )
    found = rows.join(
        decisions, rows["doc_id"].eqNullSafe(decisions["own"]) & (F.col("hashed") == F.col("content")), "left"
    )
    none = lambda kind: F.array().cast(kind)
    return found.select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("dropped"), F.lit(0)).cast("bigint").alias("n_dropped"),
        F.coalesce("dropped", none("array<int>")).alias("dropped"),
        F.coalesce("kept_by", none("array<bigint>")).alias("kept_by"),
    )
