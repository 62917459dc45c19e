"""Byte-level BPE as a lazily determinised finite-state transducer, and streaming decoding.

The last token of the encoding of a prefix depends only on the few tokens that can end there: a token ``t`` may
follow ``u`` exactly if the pair encodes to itself. So a left-to-right machine can keep the last tokens at those
positions from which a vocabulary entry may still grow, with the bytes since the first of them: that is its state, and
the token that ends at the next byte is its output, written to a register of last tokens. States and transitions are
worked out when first met and kept. Tokens on the way back from a position are sure once all positions of the state
lead back to it, so they are emitted after a lookahead bounded by the longest entry.

Decoding runs the ids through an incremental UTF-8 state machine whose transitions are kept by (state, id), so
characters that cross token boundaries come out right and nothing waits longer than one character.

Defined results: a null or empty text has no tokens and decodes to no bytes; invalid UTF-8 in ids decodes, one
U+FFFD for each maximal invalid part, as in the Unicode standard's advice; texts are encoded whole.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from lexmill.llm.common import slices, texts_of
from lexmill.llm.splitting import Splitter


class Transducer:
    """Encodes single pieces (matches of the splitting pattern)."""

    def __init__(self, ranks: dict[bytes, int], most_states: int = 120_000) -> None:
        self.ranks, self.most_states = ranks, most_states
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.grows = {b[:k] for b in ranks for k in range(1, len(b))}  # proper prefixes of entries
        self._reachable: dict[int, bool] = {}
        self._follows: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        start = (b"", (None,))
        self.states = [start]
        self.number = {start: 0}
        self.steps: list[dict[int, tuple[int, int]]] = [{}]

    def merged(self, data: bytes) -> list[int]:
        """Plain BPE of a short string: merge the adjacent pair of lowest rank until none is left."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranked = [(self.ranks[ab], i) for i, ab in enumerate(map(b"".join, zip(parts, parts[1:]))) if ab in self.ranks]
            if not ranked:
                break
            _, i = min(ranked)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[x] for x in parts]

    def reachable(self, token: int) -> bool:
        if token not in self._reachable:
            self._reachable[token] = self.merged(self.bytes_of[token]) == [token]
        return self._reachable[token]

    def follows(self, before: int | None, token: int) -> bool:
        """Whether ``token`` may stand after ``before``: together they encode to just these two."""
        if before is None:
            return True
        key = (before, token)
        if key not in self._follows:
            if len(self._follows) > 400_000:
                self._follows.clear()
            self._follows[key] = self.merged(self.bytes_of[before] + self.bytes_of[token]) == [before, token]
        return self._follows[key]

    def _make(self, at: int, byte: int) -> tuple[int, int]:
        """The transition from state ``at`` over ``byte``: the next state and the token that ends here.

        A state is (bytes since its first live position, for that position and each later one the token that ends
        there, ``None`` at the start of a piece or 0-length, or -1 where the position is no longer live).
        """
        text, ends = self.states[at]
        text += bytes((byte,))
        token = None
        for k, before in enumerate(ends):
            if before != -1 and (t := self.ranks.get(text[k:])) is not None and self.reachable(t) and self.follows(before, t):
                token = t
                break
        if token is None:
            raise ValueError(f"no entry ends after {text!r}: the vocabulary lacks single bytes")
        grows = self.grows
        live = [before if before != -1 and text[k:] in grows else -1 for k, before in enumerate(ends)]
        live.append(token)
        first = 0
        while live[first] == -1:
            first += 1
        state = (text[first:], tuple(live[first:]))
        to = self.number.get(state)
        if to is None:
            to = self.number[state] = len(self.states)
            self.states.append(state)
            self.steps.append({})
        step = self.steps[at][byte] = (to, token)
        return step

    def encode(self, piece: bytes) -> tuple[int, ...]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return (whole,)
        if len(self.states) > self.most_states:
            self._forget()
        at, steps, out = 0, self.steps, []
        register: list[int] = []  # the token that ends at each byte since the last sure boundary
        for byte in piece:
            at, token = steps[at].get(byte) or self._make(at, byte)
            register.append(token)
            if len(register) >= 512:
                self._emit(at, register, out)
        return (*out, *self._back(register, len(register)))

    def _back(self, register: list[int], k: int) -> list[int]:
        tokens = []
        while k:
            tokens.append(register[k - 1])
            k -= len(self.bytes_of[tokens[-1]])
        return tokens[::-1]

    def _emit(self, at: int, register: list[int], out: list[int]) -> None:
        """Moves the sure tokens of a long piece from the register to ``out``."""
        ends = self.states[at][1]
        n = len(register)
        paths = []
        for i, t in enumerate(ends):
            if t != -1:
                path = {k := n - len(ends) + 1 + i}
                while k:
                    k -= len(self.bytes_of[register[k - 1]])
                    path.add(k)
                paths.append(path)
        sure = max(set.intersection(*paths))
        out += self._back(register, sure)
        del register[:sure]


class Utf8Machine:
    """Incremental UTF-8: a state is the bytes of an unfinished character."""

    @staticmethod
    def _wants(seen: bytes) -> tuple[int, int] | None:
        """Range of the byte that may follow an unfinished character's bytes; None if nothing may."""
        lead, size = seen[0], len(seen)
        need = 2 if 0xC2 <= lead <= 0xDF else 3 if 0xE0 <= lead <= 0xEF else 4 if 0xF0 <= lead <= 0xF4 else 1
        if size >= need:
            return None
        if size == 1:
            return {0xE0: (0xA0, 0xBF), 0xED: (0x80, 0x9F), 0xF0: (0x90, 0xBF), 0xF4: (0x80, 0x8F)}.get(lead, (0x80, 0xBF))
        return 0x80, 0xBF

    @classmethod
    def feed(cls, state: bytes, data: bytes) -> tuple[str, bytes]:
        out = []
        for byte in data:
            if state:
                low, high = cls._wants(state)
                if low <= byte <= high:
                    state += bytes((byte,))
                    if cls._wants(state) is None:
                        out.append(state.decode())
                        state = b""
                    continue
                out.append("�")
                state = b""
            if byte < 0x80:
                out.append(chr(byte))
            elif 0xC2 <= byte <= 0xF4:
                state = bytes((byte,))
            else:
                out.append("�")
        return "".join(out), state


class Codec:
    """Encoder and decoder of whole texts for one rank file and splitting pattern."""

    def __init__(self, rank_file: bytes, pattern: str, most_pieces: int = 400_000) -> None:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines()) if a}
        self.machine = Transducer(ranks)
        self.split = Splitter(pattern)
        self.pieces = _Pieces(self.machine, most_pieces)
        size = max(ranks.values()) + 1
        self.tokens: list[bytes] = [self.machine.bytes_of.get(i, b"") for i in range(size)]
        done = [Utf8Machine.feed(b"", t) for t in self.tokens]
        self.whole = [text if not state else None for text, state in done]
        self.names = [str(i) for i in range(size)]
        self._steps: dict[tuple[bytes, int], tuple[str, bytes]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for ids in map(self.pieces.__getitem__, self.split(text)):
            out += ids
        return out

    def decode_stream(self, ids: Iterable[int]) -> Iterator[str]:
        """The text of ids as they come."""
        state, whole, steps = b"", self.whole, self._steps
        for i in ids:
            if not state and (text := whole[i]) is not None:
                yield text
                continue
            step = steps.get((state, i))
            if step is None:
                step = steps[(state, i)] = Utf8Machine.feed(state, self.tokens[i])
            text, state = step
            if text:
                yield text
        if state:
            yield "�"

    def decode(self, ids: list[int]) -> str:
        return "".join(self.decode_stream(ids))


class _Pieces(dict):
    """Piece -> ids; a memo of bounded size."""

    def __init__(self, machine: Transducer, most: int) -> None:
        super().__init__()
        self.machine, self.most = machine, most

    def __missing__(self, piece: str) -> tuple[int, ...]:
        if len(self) >= self.most:
            self.clear()
        ids = self.machine.encode(piece.encode("utf-8", "surrogatepass"))
        if len(piece) <= 64:
            self[piece] = ids
        return ids


@lru_cache(maxsize=2)
def codec(rank_file: bytes, pattern: str) -> Codec:
    """One codec for each Python worker."""
    return Codec(rank_file, pattern)


def read_ranks(path: str) -> bytes:
    """The vocabulary file, read where the job starts; tasks get its bytes (about 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def encode_documents(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id, ids`` (an array of int) of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(rank_file, pattern)
        for batch in slices(batches):
            ids = pa.array([c.encode(t) for t in batch.column("text").to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), ids], ["doc_id", "ids"])

    return texts_of(docs).mapInArrow(run, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """``doc_id, text`` of rows of ``doc_id, ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(rank_file, pattern)
        for batch in batches:
            texts = pa.array([c.decode(x or []) for x in batch.column("ids").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), texts], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, rank_file: bytes, pattern: str) -> DataFrame:
    """Encodes and decodes every document in one narrow pass and returns digests of both:
    ``doc_id, n_tokens, ids_sha256, decoded_sha256, lossless``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(rank_file, pattern)
        names, sha = c.names, hashlib.sha256
        for batch in slices(batches):
            n, a, b, same = [], [], [], []
            for text in batch.column("text").to_pylist():
                ids = c.encode(text)
                back = c.decode(ids)
                n.append(len(ids))
                a.append(sha(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
                b.append(sha(back.encode("utf-8", "surrogatepass")).hexdigest())
                same.append(back == text)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(a), pa.array(b), pa.array(same)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "lossless"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, lossless boolean")
