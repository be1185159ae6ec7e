"""Line dedup, SimHash groups, components and group splitting against brute force."""

import random
import re
from collections import defaultdict
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from tests.conftest import SF_SMALL
from wattloom.llm import collocations, groups, lines, queries, simhash
from wattloom.llm.components import components, star_rounds

SCHEMA = "doc_id bigint, text string, key string, line int, root string, _own int, component_id string"


def sets_of(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "k", 1, "r", 2, "c") for i, t in texts], SCHEMA)


# --- components ---------------------------------------------------------------------------------


@pytest.mark.parametrize("edges_a_task", [1_000_000, 40])
def test_components(spark, edges_a_task):
    draw = random.Random(5)
    pairs = [(draw.randrange(300), draw.randrange(300)) for _ in range(160)]
    pairs += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2001 + i) for i in range(50)] + [(7, 7)]
    edges = spark.createDataFrame(pairs, "a bigint, b bigint")
    found = {r["node"]: r["root"] for r in components(edges, edges_a_task).collect()}
    want = sets_of(2100, pairs)
    assert found == {x: root for x, root in enumerate(want) if root != x}


def test_star_rounds_on_a_path(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(100)], "node bigint, root bigint")
    assert {(r["node"], r["root"]) for r in star_rounds(edges).collect()} == {(i, 0) for i in range(1, 101)}


def test_components_without_edges(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_large_groups_still_meet_in_pairs(spark):
    df = spark.range(50).selectExpr("id % 2 AS key", "id AS member")
    dealt = groups.in_block_pairs(df, "key", "member", 6).collect()
    together = defaultdict(set)
    for r in dealt:
        together[r["key"], r["_i"], r["_j"]].add(r["member"])
    met = {(a, b) for members in together.values() for a in members for b in members if a < b}
    assert met == {(a, b) for a in range(50) for b in range(a + 1, 50) if (a - b) % 2 == 0}


# --- SimHash ------------------------------------------------------------------------------------


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    parts = [" ".join(words[i : i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def check_groups(found, texts):
    prints = [plain_fingerprint(t) for _, t in texts]
    near = np.bitwise_count(np.array(prints, np.uint64)[:, None] ^ np.array(prints, np.uint64)[None, :]) <= 4
    roots = sets_of(len(texts), zip(*np.where(np.triu(near, 1)), strict=True))
    least = defaultdict(list)
    for root, (doc, _) in zip(roots, texts, strict=True):
        least[root].append(doc)
    want = sorted(
        (repr(doc), f"{p:016x}", min((d for d in least[root] if d is not None), default=None))
        for (doc, _), p, root in zip(texts, prints, roots, strict=True)
    )
    assert sorted((repr(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in found) == want


def test_near_duplicates(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    check_groups(queries.queries()["op3_simhash_near_dedup"](spark, SF_SMALL).collect(), texts)


def odd_texts():
    draw = random.Random(3)
    base = [f"w{draw.randrange(5000)}" for _ in range(900)]
    texts = [None, "", "   ", "One two", "one TWO", "ÀB àb", "a b c d", "a b c d", "x " * 70_000]
    for i in range(40):
        words = list(base)
        words[draw.randrange(900)] = f"new{i}"
        texts.append(" ".join(words))
    rows = [*enumerate(texts), (None, "no id"), (None, "a b c d"), (3, "One two"), (90, "alone of its id")]
    return rows


def test_near_duplicates_of_odd_texts(spark):
    rows = odd_texts()
    check_groups(simhash.near_duplicates(frame(spark, rows)).collect(), rows)
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_one_of_each_group_stays(spark):
    rows = odd_texts()
    docs = frame(spark, rows)
    groups_ = {r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    kept = simhash.one_per_component(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    # The document without an id, and with a text of its own, is a group that has no smallest id.
    assert sorted(i for i in ids if i is not None) == sorted(g for g in groups_ if g is not None)
    assert ids.count(None) == 1


def test_random_prints_lose_no_link(spark):
    draw = random.Random(11)
    prints = {0, (1 << 64) - 1}
    for _ in range(150):
        centre = draw.getrandbits(64)
        for _ in range(4):
            flipped = centre
            for bit in draw.sample(range(64), draw.randrange(7)):
                flipped ^= 1 << bit
            prints.add(flipped)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    want = sets_of(len(prints), [(i, j) for i in range(len(prints)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4])
    df = spark.createDataFrame([(p,) for p in signed], "print bigint")
    for rows_a_block in (8192, 3):
        edges = [(r["a"], r["b"]) for r in simhash.links(df, rows_a_block).collect()]
        place = {p: i for i, p in enumerate(signed)}
        assert all((prints[place[a]] ^ prints[place[b]]).bit_count() <= 4 for a, b in edges)
        assert sets_of(len(prints), [(place[a], place[b]) for a, b in edges]) == want


# --- lines --------------------------------------------------------------------------------------


def plain_decisions(texts):
    known = {}
    for _, text in texts:
        for line in (text or "").split("\n"):
            if lines.normal_form(line):
                known.setdefault(lines.normal_form(line), len(known))
    normals = list(known)
    parts, inverted, pairs = [lines.shingles(n) for n in normals], defaultdict(list), []
    for i, own in enumerate(parts):
        common = defaultdict(int)
        for s in own:
            for j in inverted[s]:
                common[j] += 1
            inverted[s].append(i)
        pairs += [(i, j) for j, k in common.items() if k >= 0.8 * (len(own) + len(parts[j]) - k)]
    root, first, out = sets_of(len(normals), pairs), {}, []
    order = sorted(texts, key=lambda r: (r[0] is None, r[0] or 0))
    for doc, text in order:
        gone = []
        for nth, line in enumerate((text or "").split("\n")):
            normal = lines.normal_form(line)
            if normal and first.setdefault(root[known[normal]], (doc, nth)) != (doc, nth):
                gone.append(nth)
        out.append((doc, gone))
    return out


def test_lines(spark):
    texts = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    found = queries.queries()["op1_line_dedup"](spark, SF_SMALL).collect()
    assert sorted((r["doc_id"], list(r["dropped"])) for r in found) == sorted(plain_decisions(texts))
    assert all(r["n_dropped"] == len(r["dropped"]) == len(r["kept_by"]) for r in found)
    assert all(by <= r["doc_id"] for r in found for by in r["kept_by"])


def odd_lines():
    draw = random.Random(9)
    line = " ".join("".join(draw.choices("abcdefgh", k=6)) for _ in range(40))
    near = [line[:p] + "Z" + line[p + 1 :] for p in range(5, 200, 10)]
    return [
        (0, None), (1, ""), (2, "\n \n\t\n"), (3, f"{line}\nshort\nshort"), (4, f"  {line.upper()}  \nSHORT"),
        *[(10 + i, f"own line number {i} of its text {i * i}\n{n}\n") for i, n in enumerate(near)],
        (50, "y" * 200_000), (51, "y" * 200_000 + "!"), (None, f"nobody's\n{line}"),
    ]


def test_odd_lines(spark):
    texts = odd_lines()
    docs = frame(spark, texts)
    found = lines.decisions_by_document(docs).collect()
    want = {repr(d): gone for d, gone in plain_decisions(texts)}
    assert {repr(r["doc_id"]): list(r["dropped"]) for r in found} == want
    left = {repr(r["doc_id"]): r["text"] for r in lines.deduplicated(docs).collect()}
    for doc, text in texts:
        gone = want[repr(doc)]
        plain = text if not gone else "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        assert left[repr(doc)] == plain
    assert lines.deduplicated(docs).columns == docs.columns
    assert lines.decisions_by_document(docs.limit(0)).count() == 0


def test_repeated_rows_share_their_decisions(spark):
    line = "a line that is long enough to have several shingles"
    docs = frame(spark, [(1, line), (1, line), (2, line)])
    found = sorted((r["doc_id"], list(r["dropped"])) for r in lines.decisions_by_document(docs).collect())
    assert found == [(1, []), (1, []), (2, [0])]


def test_groups_split_into_blocks_lose_no_line(spark, monkeypatch):
    monkeypatch.setattr(lines, "LINES_A_BLOCK", 3)
    texts = odd_lines()
    found = lines.decisions_by_document(frame(spark, texts)).collect()
    assert {repr(r["doc_id"]): list(r["dropped"]) for r in found} == {repr(d): g for d, g in plain_decisions(texts)}


@pytest.mark.parametrize("length, adjacent", [(30, 0), (48, 0), (49, 1), (60, 2), (100, 6)])
def test_smallest_edits_that_are_caught(spark, length, adjacent):
    """As many adjacent characters inside a line may change; at 0 not one may."""
    line = "".join(chr(0x4E00 + i) for i in range(length))
    middle = length // 2

    def changed(n):
        return line[:middle] + "".join(chr(0x6000 + i) for i in range(n)) + line[middle + n :]

    near = lambda n: lines.similar(lines.shingles(line), lines.shingles(changed(n)))
    assert (near(adjacent), near(adjacent + 1)) == (True, False)
    if adjacent:
        found = lines.deduplicated(frame(spark, enumerate([line, changed(adjacent)]))).collect()
        assert sorted(r["text"] for r in found) == ["", line]


@pytest.mark.parametrize("matrix", [0, 100])
def test_verified_on_their_real_shingles(monkeypatch, matrix):
    """Held against each other in arrays: as with sets of the shingles, whatever the characters."""
    monkeypatch.setattr(lines, "LINES_IN_A_MATRIX", matrix)
    monkeypatch.setattr(lines, "SHINGLES_AT_ONCE", 700)
    draw = random.Random(2)
    many = "".join(chr(0x4E00 + i) for i in range(6000))
    for letters, most in (("ab", 40), ("ab\0", 40), ("αβ\U0001f600\U0010ffffx", 40), (many, 8000)):
        own = ["".join(draw.choices(letters, k=draw.choice([1, 2, 3, 4, 5, 6, 30, most]))) for _ in range(60)]
        other = [x[:-1] + draw.choice(letters) if draw.random() < 0.7 else x + "\0" for x in own]
        other = [other[i // 3 * 3] for i in range(60)]
        near = lines.near_column.func(pa.array(own), pa.array(other)).to_pylist()
        assert near == [lines.similar(lines.shingles(a), lines.shingles(b)) for a, b in zip(own, other, strict=True)]
        texts = list(dict.fromkeys(own + other))
        groups_ = [{k + i: [t, draw.random() < 0.5] for i, t in enumerate(texts[k : k + 12])} for k in range(0, len(texts), 12)]
        of = [(a, b) for g in groups_ for a in g for b in g if a != b and g[a][1]]
        want = [(a, b) for a, b in of if lines.similar(lines.shingles(texts[a]), lines.shingles(texts[b]))]
        assert sets_of(len(texts), lines.verified(groups_)) == sets_of(len(texts), want)


def test_normal_forms_of_a_text_are_those_of_its_lines():
    texts = ["", "A b\n C d \n", "ΟΔΟΣ\nΣ\n ΑΣ' \nΣΑ", "a  b\nc", "a\tb\u2003c\n\u00a0x\u00a0", "İ\nI\n\x0b\x00 y", "a \n b"]
    for text in texts:
        assert lines.normal_forms(text) == [lines.normal_form(line) for line in text.split("\n")]


def test_only_lines_that_met_are_read_out():
    """Texts of other lines aren't sent through the shuffle."""
    texts = [f"line number {i}" for i in range(5000)]
    needed = [lines.line_hash(t) for t in texts[:50]]
    bitmap = np.zeros(64, np.uint64)
    for mark in np.array(needed, np.int64).view(np.uint64):
        for k in range(collocations.PROBES):
            place = ((mark & np.uint64(4095)) + (mark >> np.uint64(32) | np.uint64(1)) * np.uint64(k)) & np.uint64(4095)
            bitmap[place >> np.uint64(6)] |= np.uint64(1) << (place & np.uint64(63))
    batch = pa.RecordBatch.from_pydict({"text": ["\n".join(texts)]})
    found = [t for b in lines._texts(SimpleNamespace(value=bitmap))(iter([batch])) for t in b.column("normal").to_pylist()]
    assert set(texts[:50]) <= set(found) <= set(texts)
    assert len(found) < 100


def test_shingle_hashes_are_equal_for_equal_shingles_only():
    texts = ["abcdefabcde", "xabcdex", "edcba", "ab"]
    hashes, bounds = lines.shingle_hashes(texts)
    of = {}
    for text, first, end in zip(texts, bounds[::2], bounds[1::2], strict=True):
        width = lines.SHINGLE
        padded = text.ljust(width, "\0")
        for i, h in enumerate(hashes[first:end].tolist()):
            of.setdefault(padded[i : i + width], set()).add(h)
    assert all(len(h) == 1 for h in of.values()) and len(set().union(*of.values())) == len(of)
