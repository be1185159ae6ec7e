"""Phrase collocations by Rabin-Karp fingerprints.

Texts are lower-cased (A-Z), cut into pieces at `.,;:!?` and line ends, and pieces into words at spaces
and tabs. Everything is counted per language. A word's fingerprint is the polynomial of its bytes, a phrase's
the polynomial of its words' fingerprints, both modulo 2^64 and both for all ranges at once from prefix
sums in numpy. Four steps:

1. Words and pairs are counted by fingerprint. The frequent ones go into a Bloom filter, whose size follows
   their number up to a fixed most; past that it only lets more through.
2. Triples whose pairs both are in the filter are counted by fingerprint; the frequent ones go into a second
   filter, with the words and pairs.
3. Phrases of up to five words whose words, pairs and triples all are in the filter are counted by fingerprint,
   with a pointer to one occurrence (the text's hash, and where in it). A task gives one row a phrase, unless
   it has more phrases than it may hold. A second, independent fingerprint tells apart what collides under the
   first, so counts are those of different texts.
4. Frequent phrases only are read out of the text at their pointers, hashed again to make sure that they are
   what was counted, and from there on known by their words.

A phrase inside another of the same count is dropped. It is enough to look at phrases one word longer: all
between it and a longer one have that same count. Scores are exact; products are taken in decimals of 38 digits.

Null texts are empty and have no words, a null language is `und`. Very long texts are hashed in blocks of bytes
and windows of words. Repeated rows count as often as they come; a text with a third of all rows costs its words
and one row a task, since each task sums up before the shuffle. Ties go by the phrase's bytes. Other columns,
whatever their names, are left aside. Without rows, or without frequent phrases, the result is empty.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wattloom.llm.common import whole_text, written

LEAST = 100
LONGEST = 5
FIRST = 2000
BLOCK_BYTES = 1 << 20
WINDOW_WORDS = 1 << 19
COUNTED_AT_ONCE = 4_000_000
POINTED_AT_ONCE = 1_000_000
ROWS_A_BATCH = 200_000
# The filter: 16 bits a frequent fingerprint, 32 MB at most.
BITS_EACH, MOST_BITS, LEAST_BITS, PROBES = 16, 1 << 28, 1 << 12, 3
WORD, SPACE, BREAK = 0, 1, 2

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = SPACE
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = BREAK


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Polynomial:
    """Hashes of ranges of a sequence of 64-bit values, all from one array of prefix sums."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def hashes(self, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) < len(values):
            n = max(len(values), min(2 * len(self.up), BLOCK_BYTES))
            self.up, self.down = _powers(self.base, n), _powers(self.inverse, n)
        sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * self.up[: len(values)], out=sums[1:])
        found = sums[ends]
        found -= sums[starts]
        found *= self.down[starts]
        return found


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


class Fingerprint:
    """Fingerprints of words and of phrases; those of two seeds are independent."""

    def __init__(self, seed: int, bits: int = 64):
        random = np.random.default_rng(seed)
        letters = random.integers(1, (1 << 64) - 1, 256, dtype=np.uint64)
        for capital in range(ord("A"), ord("Z") + 1):
            letters[capital] = letters[capital + 32]
        self.letters = letters
        base = random.integers(1 << 62, (1 << 64) - 1, 2, dtype=np.uint64) | np.uint64(5)
        self.bytes_, self.words = (Polynomial(int(b)) for b in base)
        self.mask = np.uint64((1 << bits) - 1)

    def of_words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """In blocks of bytes that hold whole words."""
        out, at = np.empty(len(starts), np.uint64), 0
        while at < len(starts):
            origin = starts[at]
            upto = max(at + 1, int(np.searchsorted(ends, origin + BLOCK_BYTES, "right")))
            values = self.letters[data[origin : ends[upto - 1]]]
            out[at:upto] = mix(self.bytes_.hashes(values, starts[at:upto] - origin, ends[at:upto] - origin))
            at = upto
        return out

    def of_phrases(self, words: np.ndarray, seeds: np.ndarray, n: int) -> np.ndarray:
        """Of each n words in a row; `seeds` holds the language's number for each first word."""
        first = np.arange(len(words) - n + 1)
        found = self.words.hashes(words, first, first + n)
        return mix(found + (seeds[: len(found)] ^ np.uint64(n * 0x9E3779B97F4A7C15 % (1 << 64)))) & self.mask


class Words:
    """The words of a batch of texts: where they are, in which text, and in which piece."""

    def __init__(self, texts: pa.Array):
        wide = pa.types.is_large_string(texts.type)
        _, places, data = texts.buffers()
        kind = np.int64 if wide else np.int32
        offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        whole = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
        self.data, self.offsets = whole[offsets[0] : offsets[-1]], offsets - offsets[0]
        classes = _CLASS[self.data]
        begins = np.zeros(len(self.data) + 1, bool)
        begins[self.offsets] = True  # texts lie side by side
        inside = np.zeros(len(self.data) + 2, bool)
        inside[1:-1] = classes == WORD
        own = inside[1:-1]
        self.starts = np.flatnonzero(own & (~inside[:-2] | begins[:-1]))
        self.ends = np.flatnonzero(own & (~inside[2:] | begins[1:])) + 1
        cuts = classes == BREAK
        cuts |= begins[:-1]
        self.piece = np.cumsum(cuts, dtype=np.int32)[self.starts]
        self.text = np.searchsorted(self.offsets, self.starts, "right") - 1

    def windows(self) -> Iterator[tuple[int, int, int]]:
        """(first, end of own words, end of words that phrases may reach)."""
        for first in range(0, len(self.starts), WINDOW_WORDS):
            end = min(first + WINDOW_WORDS, len(self.starts))
            yield first, end, min(end + LONGEST - 1, len(self.starts))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


class Held:
    """Rows of 64-bit columns up to a fixed number, in arrays made once, so that a task holds its rows a single time."""

    def __init__(self, most: int, columns: int):
        self.columns, self.n, self.most = [np.empty(most, np.uint64) for _ in range(columns)], 0, most

    def add(self, *columns: np.ndarray) -> Iterator[None]:
        """Yields whenever it is full, and goes on with what is left once there is room again."""
        at = 0
        while at < len(columns[0]):
            upto = min(len(columns[0]), at + self.most - self.n)
            for own, column in zip(self.columns, columns, strict=True):
                own[self.n : self.n + upto - at] = column[at:upto].view(np.uint64)
            self.n, at = self.n + upto - at, upto
            if self.n == self.most:
                yield

    def counted(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The first column's values with their numbers, in slices; then there is room."""
        held, at = self.columns[0][: self.n], 0
        held.sort()
        while at < len(held):
            upto = int(np.searchsorted(held, held[min(at + ROWS_A_BATCH, len(held)) - 1], "right"))
            first = starts([held[at:upto]])
            yield held[at + first], np.diff(first, append=upto - at)
            at = upto
        self.n = 0

    def merge(self) -> None:
        """One row for those of the same first two columns, with the sum of their last column."""
        held = [c[: self.n] for c in self.columns]
        order = np.argsort(held[0])
        for c in held:
            c[:] = c[order]
        del order
        first = starts(held[:2])
        if len(first):
            held[-1][: len(first)] = np.add.reduceat(held[-1], first)
        for c in held[:-1]:
            c[: len(first)] = c[first]
        self.n = len(first)


def starts(columns: Iterable[np.ndarray]) -> np.ndarray:
    """Where runs of rows with the same values begin."""
    new = np.zeros(0, bool)
    for c in columns:
        if not len(new):
            new = np.arange(len(c)) == 0
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def _seeds(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("seed").to_numpy().view(np.uint64)


def fingerprints(bits: int = 64) -> tuple[Fingerprint, Fingerprint]:
    """The first and the second fingerprint; the same wherever they are made."""
    return Fingerprint(20_260_711, bits), Fingerprint(20_260_712)


def frequent_pairs(mark: Fingerprint, bitmap: np.ndarray, own: np.ndarray, seed: np.ndarray, piece: np.ndarray) -> np.ndarray:
    """Whether a word and the next are of one piece and a pair in the filter."""
    pairs = piece[1:] == piece[:-1]
    pairs[pairs] = in_filter(bitmap, mark.of_phrases(own, seed, 2)[pairs])
    return pairs


def _count(bits: int, shared=None):
    """Fingerprints with their number in a share of the task: of words and pairs (step 1) or, given the filter
    of those, of the triples whose pairs are in it (step 2)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, _ = fingerprints(bits)
        held = Held(COUNTED_AT_ONCE, 1)

        def marks(own: np.ndarray, seed: np.ndarray, piece: np.ndarray, n: int) -> Iterator[np.ndarray]:
            if shared is None:
                yield mark.of_phrases(own, seed, 1)[:n]
                if len(own) > 1:
                    yield mark.of_phrases(own, seed, 2)[:n][(piece[1:] == piece[:-1])[:n]]
            elif len(own) > 2:
                pairs = frequent_pairs(mark, shared.value, own, seed, piece)
                yield mark.of_phrases(own, seed, 3)[:n][(pairs[:-1] & pairs[1:])[:n]]

        def summed() -> Iterator[pa.RecordBatch]:
            for found, n in held.counted():
                yield pa.RecordBatch.from_arrays([_signed(found), pa.array(n)], ["mark", "n"])

        for batch in batches:
            words, seeds = Words(batch.column("text")), _seeds(batch)
            hashes = mark.of_words(words.data, words.starts, words.ends)
            for first, end, reach in words.windows():
                seed, piece = seeds[words.text[first:reach]], words.piece[first:reach]
                for found in marks(hashes[first:reach], seed, piece, end - first):
                    for _ in held.add(found):
                        yield from summed()
        yield from summed()

    return count


def probes(mark: Column, bits: int) -> list[Column]:
    """The filter's places for a fingerprint; `in_filter` takes the same."""
    low, step = mark.bitwiseAND(F.lit(bits - 1)), F.shiftrightunsigned(mark, 32).bitwiseOR(F.lit(1))
    return [(low + step * k).bitwiseAND(F.lit(bits - 1)) for k in range(PROBES)]


def in_filter(bitmap: np.ndarray, marks: np.ndarray) -> np.ndarray:
    last = np.uint64(len(bitmap) * 64 - 1)
    low, step = marks & last, (marks >> np.uint64(32)) | np.uint64(1)
    found = np.ones(len(marks), bool)
    for k in range(PROBES):
        place = (low + step * np.uint64(k)) & last
        found &= (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
    return found


def frequent_filter(marks: DataFrame, n: int) -> np.ndarray:
    """A Bloom filter of `n` fingerprints as 64-bit words: MOST_BITS at most reach the driver."""
    bits = LEAST_BITS
    while bits < min(n * BITS_EACH, MOST_BITS):
        bits *= 2
    place = F.explode(F.array(*probes(F.col("mark"), bits)))
    placed = marks.select(place.alias("place")).select(
        F.shiftright("place", 6).alias("word"),
        F.expr("shiftleft(1L, cast(place & 63 AS int))").alias("bit"),
    )
    words = placed.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bitmap = np.zeros(bits // 64, np.uint64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return bitmap


COUNTED = "mark bigint, n bigint"
POINTED = "mark bigint, check bigint, n bigint, place struct<text:bigint,start:bigint,length:bigint>"


def _point(bits: int, shared):
    """Step 3: fingerprints of phrases that may be frequent, with a pointer to one occurrence."""

    def point(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, check = fingerprints(bits)
        bitmap = shared.value
        # The last two columns: the place's start and length, and the number of occurrences.
        held = Held(POINTED_AT_ONCE, 5)

        def summed(last: bool = False) -> Iterator[pa.RecordBatch]:
            held.merge()
            if not last and 2 * held.n <= held.most:
                return
            for at in range(0, held.n, ROWS_A_BATCH):
                marks, checks, of_text, place, n = (c[at : min(at + ROWS_A_BATCH, held.n)].copy() for c in held.columns)
                pointer = pa.StructArray.from_arrays(
                    [_signed(of_text), _signed(place >> np.uint64(32)), _signed(place & np.uint64((1 << 32) - 1))],
                    names=["text", "start", "length"],
                )
                yield pa.RecordBatch.from_arrays(
                    [_signed(marks), _signed(checks), _signed(n), pointer], ["mark", "check", "n", "place"]
                )
            held.n = 0

        for batch in batches:
            words, seeds = Words(batch.column("text")), _seeds(batch)
            contents = batch.column("content").to_numpy()
            hashes = mark.of_words(words.data, words.starts, words.ends)
            seconds = check.of_words(words.data, words.starts, words.ends)
            for first, end, reach in words.windows():
                own, seed, piece = hashes[first:reach], seeds[words.text[first:reach]], words.piece[first:reach]
                pairs = triples = alive = np.ones(0, bool)
                for n in range(1, min(LONGEST, reach - first) + 1):
                    found = mark.of_phrases(own, seed, n)
                    if n == 1:
                        may = in_filter(bitmap, found)
                    elif n == 2:
                        may = pairs = frequent_pairs(mark, bitmap, own, seed, piece)
                    elif n == 3:
                        may = pairs[:-1] & pairs[1:]
                        may[may] = in_filter(bitmap, found[may])
                        triples = alive = may
                    else:
                        # All of its triples: the phrase one word shorter, and the last triple.
                        may = alive = alive[:-1] & triples[n - 3 :]
                    at = np.flatnonzero(may[: end - first])
                    of_text = words.text[first + at]
                    start = words.starts[first + at]
                    rows = held.add(
                        found[at],
                        check.of_phrases(seconds[first:reach], seed, n)[at],
                        contents[of_text],
                        (start - words.offsets[of_text]) << 32 | words.ends[first + at + n - 1] - start,
                        np.ones(len(at), np.uint64),
                    )
                    for _ in rows:
                        yield from summed()
        yield from summed(last=True)

    return point


PHRASES = "lang string, phrase string, words int, n bigint"


def _read(bits: int):
    """Step 4: the phrases at their pointers, as far as they are what was counted."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mark, check = fingerprints(bits)
        for batch in batches:
            found, seeds, langs, numbers = [], [], [], []
            rows = zip(*(batch.column(c).to_pylist() for c in ("text", "lang", "seed", "places")), strict=True)
            for text, lang, seed, places in rows:
                data = text.encode()
                for p in places:
                    piece = data[p["start"] : p["start"] + p["length"]].lower().replace(b"\t", b" ")
                    found.append(b" ".join(filter(None, piece.split(b" "))))
                    seeds.append(seed)
                    langs.append(lang)
                    numbers.append((p["mark"], p["check"], p["n"]))
            if not found:
                continue
            phrases = pa.array([p.decode() for p in found])
            words, seed = Words(phrases), np.array(seeds, np.int64).view(np.uint64)
            size = np.bincount(words.text, minlength=len(found))
            at = np.cumsum(size) - size
            same = size <= LONGEST
            expected = np.array(numbers, np.int64)
            for which, column in ((mark, 0), (check, 1)):
                hashes = which.of_words(words.data, words.starts, words.ends)
                for n in range(1, LONGEST + 1):
                    own = np.flatnonzero(size == n)
                    if len(own):
                        now = which.of_phrases(hashes, seed[words.text], n)[at[own]].view(np.int64)
                        same[own] &= now == expected[own, column]
            keep = pa.array(same)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()).filter(keep),
                    phrases.filter(keep),
                    pa.array(size.astype(np.int32)).filter(keep),
                    pa.array(expected[:, 2]).filter(keep),
                ],
                ["lang", "phrase", "words", "n"],
            )

    return read


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, lang: str = "lang", text: str = "text", bits: int = 64
) -> DataFrame:
    """(lang, phrase, words, n): phrases of up to five words that come `least` times or more in texts of
    a language. `bits` narrows the first fingerprint, for tests."""
    of_lang = F.coalesce(F.col(lang), F.lit("und"))
    content = docs.select(
        of_lang.alias("lang"),
        whole_text(text).alias("text"),
        F.xxhash64(of_lang).alias("seed"),
        F.xxhash64(of_lang, whole_text(text)).alias("content"),
    )
    hashed = content.select("text", "seed")

    def often(counted: DataFrame, name: str) -> DataFrame:
        # Tasks have summed up already: a second sum before the shuffle would only sort and spill.
        counted = counted.repartition("mark").groupBy("mark").agg(F.sum("n").alias("n"))
        return written(counted.filter(F.col("n") >= least).select("mark"), name)

    def filtered(marks: DataFrame):
        return docs.sparkSession.sparkContext.broadcast(frequent_filter(marks, marks.count()))

    short = often(hashed.mapInArrow(_count(bits), COUNTED), "often")
    triples = often(hashed.mapInArrow(_count(bits, filtered(short)), COUNTED), "triples")
    shared = filtered(short.union(triples))
    pointed = content.select("text", "seed", "content").mapInArrow(_point(bits, shared), POINTED)
    # One pointer a phrase, and where possible into the same texts.
    pointed = pointed.groupBy("mark", "check").agg(F.sum("n").alias("n"), F.min("place").alias("place"))
    pointed = written(pointed.filter(F.col("n") >= least), "pointed")
    places = pointed.groupBy(F.col("place.text").alias("content")).agg(
        F.collect_list(F.struct("mark", "check", "n", "place.start", "place.length")).alias("places")
    )
    # Copies of a text are one. A text's pointers are no more than its words times five.
    texts = content.join(places.select("content"), "content", "left_semi")
    texts = texts.groupBy("content", "lang", "seed").agg(F.first("text").alias("text"))
    return texts.join(places, "content").select("text", "lang", "seed", "places").mapInArrow(_read(bits), PHRASES)


def collocations(
    docs: DataFrame,
    least: int = LEAST,
    first: int = FIRST,
    lang: str = "lang",
    text: str = "text",
    bits: int = 64,
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of each language's first phrases."""
    known = written(frequent_phrases(docs, least, lang, text, bits), "phrases")
    words = F.regexp_count(whole_text(text), F.lit(r"[^\x20\x09.,;:!?\x0A-\x0D]+"))
    sizes = docs.groupBy(F.coalesce(F.col(lang), F.lit("und")).alias("lang")).agg(F.sum(words).cast("bigint").alias("n"))
    several = known.filter("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.split("phrase", " ").alias("w"))
    # Inside a phrase one word longer with the same count: it is its beginning or its end.
    inner = F.array(F.slice("w", 1, F.col("words") - 1), F.slice("w", 2, F.col("words") - 1))
    inner = several.filter("words > 2").select("lang", F.explode(inner).alias("w"), "a")
    inner = inner.select("lang", F.array_join("w", " ").alias("phrase"), "a")
    free = several.join(inner, ["lang", "phrase", "a"], "left_anti")
    cuts = free.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumns({
        "left": F.array_join(F.slice("w", F.lit(1), F.col("k")), " "),
        "right": F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " "),
    })
    part = known.select(F.col("lang").alias("of"), F.col("phrase").alias("part"), "n")
    for side, count in (("left", "l"), ("right", "r")):
        own = part.withColumnRenamed("n", count)
        cuts = cuts.join(own, (F.col("lang") == F.col("of")) & (F.col(side) == F.col("part"))).drop("of", "part")
    wide = {c: F.col(c).cast("decimal(20,0)") for c in ("a", "l", "r", "n")}
    cuts = cuts.join(sizes, "lang").withColumns({f"_{c}": e for c, e in wide.items()})
    score = F.expr("(cast(1000 as decimal(4,0)) * _a * _n) div (_l * _r)")
    lowest = F.min(F.struct(score.alias("score"), "k", "l", "r", "n"))
    scored = cuts.groupBy("lang", "phrase", "a").agg(lowest.alias("cut")).select("lang", "phrase", "a", "cut.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = scored.withColumn("rank", F.row_number().over(order).cast("bigint")).filter(F.col("rank") <= first)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
