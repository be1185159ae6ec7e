"""What spares time in the alignment changes no chunk and no fragment."""

import os
import random

import public_tokenizers

from wattloom.llm import alignment


def plain_chunks(text):
    out, held = [], []
    for part in text.split(" "):
        held.append(part)
        if part and not part[-1].isspace():
            out.append(" ".join(held))
            held = []
    return [*out, " ".join(held)] if held else out


def test_chunks_end_where_they_did():
    draw = random.Random(7)
    for _ in range(5_000):
        text = "".join(draw.choice(["a", "b.", " ", "\n", "\t", "\u00a0", "\u2003", "\x1c", "\u200b"]) for _ in range(draw.randint(1, 9)))
        assert alignment.chunks_of(text) == plain_chunks(text), repr(text)


def test_a_chunk_that_is_not_given_back_does_not_spoil_its_neighbours():
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    chunks = ["plain", "fullwidth\uff21", "words", "\u2581", "e\u0301", "x"]
    alone = []
    for c in chunks:
        one = alignment.Chunks(alignment.Vocabularies(*paths))
        one.learn([[c]])
        alone.append((list(one.numbers), one.text[0], list(one.pairs)))
    assert {n[0] for n, *_ in alone} == {0, 1}
    many = alignment.Chunks(alignment.Vocabularies(*paths))
    many.learn([chunks[:3], chunks])
    got = [
        (list(many.numbers[5 * i : 5 * i + 5]), many.text[i], list(many.pairs[many.upto[i] : many.upto[i + 1]]))
        for i in range(len(chunks))
    ]
    assert got == alone


def test_a_worker_encodes_in_its_own_thread():
    paths = [public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    before = os.environ.pop("TOKENIZERS_PARALLELISM", None)
    try:
        alignment.remembered.cache_clear()
        alignment.remembered(*paths)
        assert os.environ["TOKENIZERS_PARALLELISM"] == "false"
    finally:
        os.environ.pop("TOKENIZERS_PARALLELISM", None)
        if before is not None:
            os.environ["TOKENIZERS_PARALLELISM"] = before
