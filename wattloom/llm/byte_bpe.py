"""Byte-level BPE as a finite-state transducer, and a streaming decoder.

Encoding. A token sequence is the BPE encoding of its bytes exactly if each token and each pair of
neighbours encode to themselves. So a nondeterministic machine suffices whose threads are unfinished
tokens (places in the vocabulary's trie) behind the tokens chosen so far; for each prefix just one
thread ends a token. It is determinised while it runs: a set of threads, less the tokens they all
share, is a state, and a step (state, byte) to the next state with the shared tokens it emits is kept
once it has been computed. A thread waits no longer than the longest token, which bounds the lookahead.

Decoding. Bytes are joined token by token; a UTF-8 state machine holds back the bytes of an
unfinished character until the next piece of input.

Null and empty texts give no tokens. Repeated rows give the same, an empty table none. Very long texts are
read as a whole; what is held besides is in proportion to the text. Columns other than the two named are not
read, whatever their names.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wattloom.llm.common import whole_text

ROOT = 0
START = -1
NO_TOKEN = -1
WHAT = -1
STEPS = 500_000
MEMO = 1_200_000
DECODED_AT_ONCE = 65_536


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


class Transducer:
    """Encodes one pre-token after the other; `ranks` holds the merges by the bytes they make."""

    def __init__(self, ranks: dict[bytes, int], max_steps: int = STEPS):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.children: dict[int, int] = {}
        self.token_at: list[int] = [NO_TOKEN]
        for word, token in ranks.items():
            node = ROOT
            for byte in word:
                key = node << 8 | byte
                child = self.children.get(key)
                if child is None:
                    child = self.children[key] = len(self.token_at)
                    self.token_at.append(NO_TOKEN)
                node = child
            self.token_at[node] = token
        self.edges: tuple[dict, dict] = ({}, {})
        self.follows: dict[int, bool] = {}
        self.max_steps = max_steps
        self._forget()

    def _forget(self) -> None:
        # A state is (last emitted token or START, threads); a thread is (tokens since, trie node).
        self.states: dict[tuple, dict] = {}
        self.follows.clear()
        self.steps = 0
        self.first = self._state(START, (((), ROOT),))

    def _parts(self, data: bytes) -> tuple[bytes, bytes]:
        """The two tokens that the last merge of a token joins."""
        parts = [data[i : i + 1] for i in range(len(data))]
        get, none = self.ranks.get, len(self.ranks) << 1
        while len(parts) > 2:
            at = min(range(len(parts) - 1), key=lambda i: get(parts[i] + parts[i + 1], none))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts[0], parts[1]

    def _edge(self, token: int, right: bool) -> list[tuple[bytes, int]]:
        """The pieces at a token's right or left end while it grows, each with the rank of the
        merge that ends it; merges come in rising ranks."""
        known = self.edges[right].get(token)
        if known is None:
            word = self.bytes_of[token]
            known = []
            ended = 1 << 60
            while True:
                known.append((word, ended))
                if len(word) == 1:
                    break
                ended = self.ranks[word]
                word = self._parts(word)[right]
            known.reverse()
            self.edges[right][token] = known
        return known

    def _may_follow(self, left: int, right: int) -> bool:
        """Whether no merge would reach over the boundary of two tokens."""
        if left == START:
            return True
        get = self.ranks.get
        if get(self.bytes_of[left] + self.bytes_of[right]) is not None:
            return False
        ends, starts = self._edge(left, True), self._edge(right, False)
        i = j = 0
        (a, a_ends), (b, b_ends) = ends[0], starts[0]
        while True:
            across = get(a + b)
            # Of equal ranks the leftmost merge comes first.
            if across is not None and across < a_ends and across <= b_ends:
                return False
            if a_ends <= b_ends:
                if a_ends == 1 << 60:
                    return True
                i += 1
                a, a_ends = ends[i]
            else:
                j += 1
                b, b_ends = starts[j]

    def _state(self, last: int, threads: tuple) -> dict:
        """The one dict of a state: its steps by byte, and what it stands for under WHAT."""
        key = (last, threads)
        state = self.states.get(key)
        if state is None:
            state = self.states[key] = {WHAT: key}
        return state

    def _advance(self, state: dict, byte: int) -> tuple[dict, tuple[int, ...]]:
        last, threads = state[WHAT]
        find, token_at, follows = self.children.get, self.token_at, self.follows
        alive, ended, start = [], None, True
        for chosen, node in threads:
            child = find(node << 8 | byte)
            if child is None:
                continue
            alive.append((chosen, child))
            if not chosen:
                start = False
            if ended is None:
                token = token_at[child]
                if token != NO_TOKEN:
                    left = chosen[-1] if chosen else last
                    pair = left << 32 | token
                    may = follows.get(pair)
                    if may is None:
                        may = follows[pair] = self._may_follow(left, token)
                    if may:
                        ended = (*chosen, token)
        alive.append((ended, ROOT))
        emitted = ()
        if start:
            # What all threads have chosen is emitted.
            first = alive[0][0]
            shared = len(first)
            for chosen, _ in alive:
                most = min(shared, len(chosen))
                if chosen[:most] != first[:most]:
                    shared = 0
                    while chosen[shared] == first[shared]:
                        shared += 1
                else:
                    shared = most
            if shared:
                emitted = first[:shared]
                last = emitted[-1]
                alive = [(chosen[shared:], node) for chosen, node in alive]
                start = all([chosen for chosen, _ in alive])
            if start:
                last = START  # no thread looks back that far
        self.steps += 1
        step = state[byte] = (self._state(last, tuple(alive)), emitted)
        return step

    def encode(self, piece: bytes) -> list[int]:
        """The tokens of one pre-token."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if self.steps > self.max_steps:
            self._forget()
        out: list[int] = []
        state = self.first
        for byte in piece:
            step = state.get(byte)
            if step is None:
                step = self._advance(state, byte)
            state, emitted = step
            if emitted:
                out += emitted
        out += state[WHAT][1][-1][0]
        return out


class Encoder:
    """Whole texts: pre-tokens by `pattern`, each through the transducer.

    Chunks parted by single spaces are remembered with their tokens, as no pre-token reaches over
    such a space; a text with other spacing is cut by the pattern as a whole. Pre-tokens are remembered
    too. Of both there are two generations: what the younger lacks is taken over from the elder, which
    goes when the younger is full.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, memo: int = MEMO):
        import regex

        self.transducer = Transducer(ranks)
        # Tokens' bytes by their decimals.
        self.bytes_of = {str(i): b for i, b in self.transducer.bytes_of.items()}
        self.find = regex.compile(pattern).findall
        self.memo: dict[str, str] = {}
        self.elder: dict[str, str] = {}
        self.pieces: dict[str, str] = {}
        self.elder_pieces: dict[str, str] = {}
        self.limit = memo // 3

    def _piece(self, piece: str) -> str:
        known = self.elder_pieces.get(piece)
        if known is None:
            known = " ".join(map(str, self.transducer.encode(piece.encode())))
        if len(self.pieces) >= self.limit // 2:
            self.elder_pieces, self.pieces = self.pieces, {}
        self.pieces[piece] = known
        return known

    def _decimals(self, text: str) -> str:
        return " ".join([self.pieces.get(p) or self._piece(p) for p in self.find(text)])

    def decimals(self, text: str) -> str:
        """The ids as decimals joined by single spaces."""
        if len(self.memo) >= self.limit:
            self.elder, self.memo = self.memo, {}
        memo, elder = self.memo, self.elder
        head, *chunks = text.split(" ")
        missing = {c for c in chunks if c not in memo}
        for chunk in missing:
            if not chunk or chunk[0].isspace() or chunk[-1].isspace():
                return self._decimals(text)
        if not chunks or not head or head[-1].isspace():
            return self._decimals(text)
        for chunk in missing:
            memo[chunk] = elder.get(chunk) or self._decimals(" " + chunk)
        return " ".join([self._decimals(head), *map(memo.__getitem__, chunks)])

    def encode(self, text: str) -> list[int]:
        return list(map(int, self.decimals(text).split()))


# UTF-8 states: 0 between characters, else the continuation bytes still to come with their range.
_BETWEEN, _ONE, _TWO, _THREE, _E0, _ED, _F0, _F4, _BAD = range(9)


def _utf8_table() -> list[bytes]:
    table = [bytearray([_BAD] * 256) for _ in range(9)]

    def put(state: int, low: int, high: int, to: int) -> None:
        for byte in range(low, high + 1):
            table[state][byte] = to

    put(_BETWEEN, 0x00, 0x7F, _BETWEEN)
    put(_BETWEEN, 0xC2, 0xDF, _ONE)
    put(_BETWEEN, 0xE0, 0xE0, _E0)
    put(_BETWEEN, 0xE1, 0xEC, _TWO)
    put(_BETWEEN, 0xED, 0xED, _ED)
    put(_BETWEEN, 0xEE, 0xEF, _TWO)
    put(_BETWEEN, 0xF0, 0xF0, _F0)
    put(_BETWEEN, 0xF1, 0xF3, _THREE)
    put(_BETWEEN, 0xF4, 0xF4, _F4)
    put(_ONE, 0x80, 0xBF, _BETWEEN)
    put(_TWO, 0x80, 0xBF, _ONE)
    put(_THREE, 0x80, 0xBF, _TWO)
    put(_E0, 0xA0, 0xBF, _ONE)
    put(_ED, 0x80, 0x9F, _ONE)
    put(_F0, 0x90, 0xBF, _TWO)
    put(_F4, 0x80, 0x8F, _TWO)
    return [bytes(row) for row in table]


UTF8 = _utf8_table()


class StreamDecoder:
    """Tokens in, bytes of finished characters out.

    The state after any input follows from its last three bytes at most, since a character has
    four: the machine is run over that tail only. Bytes that no character can hold pass through.
    """

    def __init__(self, bytes_of: dict):
        self.bytes_of = bytes_of
        self.held = b""

    def feed(self, ids: Iterable) -> bytes:
        data = self.held + b"".join(map(self.bytes_of.__getitem__, ids))
        cut = len(data)
        for at in range(len(data) - 1, max(-1, len(data) - 4), -1):
            if data[at] & 0xC0 == 0x80:
                continue
            state = _BETWEEN
            for byte in data[at:]:
                state = UTF8[state][byte]
            if state not in (_BETWEEN, _BAD):
                cut = at
            break
        self.held = data[cut:]
        return data[:cut]

    def close(self) -> bytes:
        rest, self.held = self.held, b""
        return rest


def decoded(ids: list, bytes_of: dict, at_once: int = DECODED_AT_ONCE) -> Iterator[bytes]:
    """The decoded bytes in pieces that end between characters, but for the last. Ids are whatever
    `bytes_of` has as keys."""
    decoder = StreamDecoder(bytes_of)
    for start in range(0, len(ids), at_once):
        yield decoder.feed(ids[start : start + at_once])
    yield decoder.close()


@lru_cache(maxsize=1)
def encoder(path: str, pattern: str) -> Encoder:
    made = Encoder(load_ranks(path), pattern)
    # The vocabulary and the states stay; looking for garbage among them took a quarter of the time.
    gc.freeze()
    gc.set_threshold(100_000, 50, 50)
    return made


def encode_column(path: str, pattern: str):
    """A column function from text to its token ids."""

    @F.arrow_udf("array<int>")
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = encoder(path, pattern)
        for texts in batches:
            yield pa.array([machine.encode(t or "") for t in texts.to_pylist()], pa.list_(pa.int32()))

    return encode


def decode_column(path: str, pattern: str):
    """A column function from token ids to the decoded bytes."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bytes_of = encoder(path, pattern).transducer.bytes_of
        for rows in batches:
            yield pa.array([b"".join(decoded(ids or [], bytes_of)) for ids in rows.to_pylist()], pa.binary())

    return decode


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def digest_column(path: str, pattern: str):
    """A column function from text to the digests of its ids and of what they decode to."""

    @F.arrow_udf(DIGESTS)
    def digests(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        machine = encoder(path, pattern)
        for texts in batches:
            n, of_ids, of_bytes = [], [], []
            for text in texts.to_pylist():
                decimals = machine.decimals(text or "")
                ids = decimals.split()
                back = hashlib.sha256()
                for piece in decoded(ids, machine.bytes_of):
                    back.update(piece)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(decimals.encode()).hexdigest())
                of_bytes.append(back.hexdigest())
            yield pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                names=["n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return digests


def round_trips(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row."""
    found = docs.select(
        F.col(doc_id).alias("doc_id"), digest_column(path, pattern)(whole_text(text)).alias("found")
    )
    return found.select("doc_id", "found.*")
