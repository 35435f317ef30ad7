"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges of a vocabulary say which tokens may stand next to each other: a sequence of tokens is
the encoding of its bytes exactly if every adjacent pair of them encodes to itself. Read from left
to right this is a nondeterministic transducer: its configurations are (node of the trie of
tokens, last token, tokens not yet given out). `Transducer` determinises it while it reads: a state
is a set of configurations, the tokens all of them agree on are given out, and a transition is
computed at its first use and kept. A token is given out as soon as no other reading of the
bytes is left, which needs no more bytes than the longest token has.

`Decoder` is the way back: an automaton over tokens, lifted from the byte-wise automaton of
well-formed UTF-8, so that text comes out as soon as its bytes are complete.
"""

from __future__ import annotations

import base64
import gc
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from playbill.llm.common import of_size

BATCH_ROWS, BATCH_BYTES = 512, 2 << 20  # texts whose ids are held at once
ROOT = 0
NONE = -1
NODES = (1 << 20) - 1


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Lines of a base64 token and its rank."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line)}


def merged(piece: bytes, ranks: dict[bytes, int], stop: int = 1) -> list[int]:
    """The defining rule, used on single tokens only, to find how they are made: merge the adjacent
    parts whose union has the lowest rank, the leftmost first, until `stop` parts are left or none
    can be merged."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > stop:
        rank, i = min((ranks.get(parts[i] + parts[i + 1], 1 << 60), i) for i in range(len(parts) - 1))
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[part] for part in parts]


class Transducer:
    """Encodes bytes to token ids. States and transitions are kept up to `max_states`; when they
    are full they are dropped and computed again as needed."""

    def __init__(self, ranks: dict[bytes, int], max_states: int = 250_000):
        self.ranks, self.max_states, self.max_pairs = ranks, max_states, max_states * 8 // 5
        self.tokens = {rank: token for token, rank in ranks.items()}
        # the trie as one dictionary: 256 * node + byte -> node; its ends: node -> token
        self.trie: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        nodes = 1
        for token, rank in ranks.items():
            node = ROOT
            for byte in token:
                key = node << 8 | byte
                node = self.trie.get(key, 0)
                if not node:
                    node = self.trie[key] = nodes
                    nodes += 1
            self.ends[node] = rank
        self.inner = {key >> 8 for key in self.trie}
        self.pairs: dict[int, bool] = {}
        self.made: dict[int, tuple[int, int] | None] = {}
        self.reset()

    def reset(self) -> None:
        # A configuration is one number, 1 << 20 times its tail plus its node; a tail is the last
        # token and the tokens not yet given out. Numbers keep a state small and quick to compare.
        self.tail_ids: dict[tuple[int, tuple[int, ...]], int] = {(NONE, ()): 0}
        self.tails: list[tuple[int, tuple[int, ...]]] = [(NONE, ())]
        self.ids = {(ROOT,): 0}
        self.states: list[tuple[int, ...]] = [(ROOT,)]
        self.next: list[dict[int, tuple[tuple[int, ...], int]]] = [{}]
        self.last: list[tuple[int, ...]] = [()]

    def tail(self, before: int, waiting: tuple[int, ...]) -> int:
        key = (before, waiting)
        known = self.tail_ids.get(key)
        if known is None:
            known = self.tail_ids[key] = len(self.tails)
            self.tails.append(key)
        return known

    def halves(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a byte, and for a token that its own
        bytes do not encode to (no text has it)."""
        if token not in self.made:
            parts = merged(self.tokens[token], self.ranks, stop=2)
            whole = len(parts) == 2 and self.ranks.get(self.tokens[parts[0]] + self.tokens[parts[1]]) == token
            self.made[token] = (parts[0], parts[1]) if whole else None
        return self.made[token]

    def alone(self, token: int) -> bool:
        return len(self.tokens[token]) == 1 or self.halves(token) is not None

    def follows(self, left: int, right: int) -> bool:
        """Whether `right` may come after `left`, or first (NONE); kept for up to 400,000 pairs."""
        if len(self.pairs) >= self.max_pairs:
            self.pairs.clear()
        known = self.pairs[left << 32 | right] = self.alone(right) and (left == NONE or self.stands(left, right))
        return known

    def stands(self, left: int, right: int) -> bool:
        """Whether `right` may follow `left`: no merge may cross the border between them.

        Goes back through the merges that made the two, the latest first. At each time a part of
        `left` and a part of `right` meet at the border, and each is used up by a merge of known
        rank; their own merge must not come earlier (at equal ranks the one further left comes first).
        """
        tokens, ranks, never = self.tokens, self.ranks, len(self.ranks)
        left_used = right_used = never
        while True:
            rank = ranks.get(tokens[left] + tokens[right], never)
            if rank < left_used and rank <= right_used and rank < never:
                return False
            left_made = left if len(tokens[left]) > 1 else NONE
            right_made = right if len(tokens[right]) > 1 else NONE
            if left_made == right_made == NONE:
                return True
            if left_made > right_made:
                left_used, left = left_made, self.halves(left)[1]
            else:
                right_used, right = right_made, self.halves(right)[0]

    def step(self, state: int, byte: int) -> tuple[tuple[int, ...], int]:
        """Compute one transition: the tokens it gives out and the state it leads to."""
        trie, ends, inner, tails, pairs = self.trie, self.ends, self.inner, self.tails, self.pairs
        found, ended = [], False
        for configuration in self.states[state]:  # the longest token first
            node = configuration & NODES
            to = trie.get(node << 8 | byte)
            if to is None:
                continue
            if to in inner:  # else no token goes on from here
                found.append(configuration - node + to)
            if not ended and to in ends:
                token = ends[to]
                before, waiting = tails[configuration >> 20]
                fits = pairs.get(before << 32 | token)
                if fits is None:
                    fits = self.follows(before, token)
                if fits:  # no other token can end here
                    ended, start = True, self.tail(token, (*waiting, token)) << 20
        found.append(start)
        out = tails[found[0] >> 20][1]
        if out:
            for configuration in found:
                waiting = tails[configuration >> 20][1]
                while out != waiting[: len(out)]:
                    out = out[:-1]
            if out:
                given = len(out)
                found = [self.tail(before, waiting[given:]) << 20 | node for (before, waiting), node in ((tails[c >> 20], c & NODES) for c in found)]
        reached = tuple(found)
        target = self.ids.get(reached)
        if target is None:
            if len(self.states) >= self.max_states:
                known = [self.tails[c >> 20] for c in reached]
                self.reset()
                state = NONE  # what it was is dropped
                reached = tuple(self.tail(*tail) << 20 | c & NODES for tail, c in zip(known, reached, strict=True))
            target = self.ids[reached] = len(self.states)
            self.states.append(reached)
            self.next.append({})
            self.last.append(self.tails[reached[-1] >> 20][1])
        if state != NONE:
            self.next[state][byte] = (out, target)
        return out, target

    def encode(self, piece: bytes) -> list[int]:
        out: list[int] = []
        state = 0
        for byte in piece:
            move = self.next[state].get(byte)
            if move is None:
                move = self.step(state, byte)
            if move[0]:
                out += move[0]
            state = move[1]
        out += self.last[state]
        return out


# Well-formed UTF-8 (Unicode, table 3-7): lead bytes, the range of the byte after them, and how many follow.
LEADS = (
    (0xC2, 0xDF, 0x80, 0xBF, 1),
    (0xE0, 0xE0, 0xA0, 0xBF, 2),
    (0xE1, 0xEC, 0x80, 0xBF, 2),
    (0xED, 0xED, 0x80, 0x9F, 2),
    (0xEE, 0xEF, 0x80, 0xBF, 2),
    (0xF0, 0xF0, 0x90, 0xBF, 3),
    (0xF1, 0xF3, 0x80, 0xBF, 3),
    (0xF4, 0xF4, 0x80, 0x8F, 3),
)
LEAD = {byte: (low, high, more) for first, last, low, high, more in LEADS for byte in range(first, last + 1)}


def utf8_step(state: bytes, byte: int) -> tuple[str, bytes]:
    """One byte in state `state` (the bytes of an unfinished character): the text that comes out,
    and the new state. A part that can not be continued becomes one U+FFFD."""
    if state:
        low, high, more = LEAD[state[0]]
        if len(state) > 1:
            low, high = 0x80, 0xBF
        if low <= byte <= high:
            state += bytes([byte])
            return ("", state) if len(state) <= more else (state.decode(), b"")
        text, state = utf8_step(b"", byte)
        return "�" + text, state
    if byte < 0x80:
        return chr(byte), b""
    return ("", bytes([byte])) if byte in LEAD else ("�", b"")


class Decoder:
    """Decodes token ids as they come. Transitions (state, token) are kept, up to `max_moves`."""

    def __init__(self, tokens: dict[int, bytes], max_moves: int = 200_000):
        self.tokens, self.max_moves = tokens, max_moves
        self.moves: dict[bytes, dict[int, tuple[str, bytes]]] = {b"": {}}
        # tokens that lead from the empty state back to it: the common case, in one look-up
        self.whole: dict[int, str] = {}

    def move(self, state: bytes, token: int) -> tuple[str, bytes]:
        if sum(map(len, self.moves.values())) >= self.max_moves:
            self.moves = {b"": {}}
        out, at = [], state
        for byte in self.tokens[token]:
            text, at = utf8_step(at, byte)
            out.append(text)
        result = self.moves.setdefault(state, {})[token] = ("".join(out), at)
        if not state and not at:
            self.whole[token] = result[0]
        return result

    def stream(self, ids: list[int], state: bytes = b"") -> tuple[str, bytes]:
        """Text of the ids and the state after them; feed the state to the next call."""
        if not state:
            try:
                return "".join(map(self.whole.__getitem__, ids)), b""
            except KeyError:  # a token that is new, or leaves a character unfinished
                pass
        out = []
        for token in ids:
            found = self.moves.get(state, {}).get(token) or self.move(state, token)
            out.append(found[0])
            state = found[1]
        return "".join(out), state

    def text(self, ids: list[int]) -> str:
        text, state = self.stream(ids)
        return text + "�" * bool(state)


class Codec:
    """Pattern, transducer and decoder of one vocabulary, with the pieces encoded last: at least
    `max_pieces` and at most twice as many."""

    def __init__(self, data: bytes, pattern: str, max_states: int = 250_000, max_pieces: int = 300_000):
        self.find = regex.compile(pattern).findall
        self.machine = Transducer(read_ranks(data), max_states)
        self.decoder = Decoder(self.machine.tokens)
        self.names = list(map(str, range(1 + max(self.machine.tokens, default=-1))))
        self.max_pieces = max_pieces
        self.pieces: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        known = self.pieces.get
        for piece in self.find(text):
            out += known(piece) or self.fresh(piece)
        return out

    def fresh(self, piece: str) -> list[int]:
        ids = self.older.get(piece) or self.machine.encode(piece.encode())
        if len(piece) <= 64:
            if len(self.pieces) >= self.max_pieces:
                self.older = self.pieces.copy()
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids


CODECS: dict[bytes, Codec] = {}


def codec(data: bytes, pattern: str, *limits: int) -> Codec:
    """One codec a worker process and vocabulary."""
    key = hashlib.sha256(data + f"{pattern} {limits}".encode()).digest()
    if key not in CODECS:
        CODECS.clear()
        CODECS[key] = Codec(data, pattern, *limits)
        gc.freeze()  # the tables stay: no later search for cycles looks at them
    return CODECS[key]


def encoded(docs: DataFrame, vocabulary: bytes, pattern: str, id_column: str = "doc_id", text_column: str = "text", ids: bool = True,
            max_states: int = 250_000, max_pieces: int = 300_000) -> DataFrame:
    """One row per row of docs: id, n_tokens, ids_sha256, decoded_sha256, round_trip, and with
    `ids` the token ids themselves.

    The text is encoded whole, every match of the pattern by itself; NULL counts as the empty text.
    The ids are decoded again: round_trip says whether that gave the text back. Rows with equal or
    NULL ids, empty tables and very long texts need no special care: each row is done alone, in
    memory proportional to its own text, beside what a worker keeps of the transducer and of pieces
    (about 475 MB in all on noise words with the limits given, under 200 MB with 45,000 and 80,000, in twice the time). Other columns of docs are left out. The vocabulary file
    (about 1 MB, its size does not depend on the data) is broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)
    kind = docs.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(sent.value, pattern, max_states, max_pieces)
        # what is kept has no cycles; searching it for some takes a tenth of the time
        gc.disable()
        try:
            name = own.names.__getitem__
            for batch in of_size(batches, 1, BATCH_ROWS, BATCH_BYTES):
                counts, hashes, back, same, lists = [], [], [], [], []
                for text in batch.column(1).to_pylist():
                    text = text or ""
                    found = own.encode(text)
                    decoded_text = own.decoder.text(found)
                    counts.append(len(found))
                    hashes.append(hashlib.sha256(" ".join(map(name, found)).encode()).hexdigest())
                    back.append(hashlib.sha256(decoded_text.encode()).hexdigest())
                    same.append(decoded_text == text)
                    if ids:
                        lists.append(np.array(found, np.int32))
                columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(back, pa.string()), pa.array(same, pa.bool_())]
                labels = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"]
                if ids:
                    offsets = np.cumsum([0, *map(len, lists)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*lists, np.empty(0, np.int32)]))))
                    labels.append("ids")
                yield pa.RecordBatch.from_arrays(columns, labels)
        finally:
            gc.enable()

    schema = f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean" + ", ids array<int>" * ids
    return docs.select(id_column, text_column).mapInArrow(rows, schema)


def decoded(tokens: DataFrame, vocabulary: bytes, id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, text) of token ids. NULL ids give a NULL text; an id outside the vocabulary is an error."""
    sent = tokens.sparkSession.sparkContext.broadcast(vocabulary)
    kind = tokens.schema[id_column].dataType.simpleString()

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Decoder({rank: token for token, rank in read_ranks(sent.value).items()})
        for batch in of_size(batches, 1, BATCH_ROWS, BATCH_BYTES):
            texts = [None if found is None else own.text(found) for found in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return tokens.select(id_column, ids_column).mapInArrow(rows, f"doc_id {kind}, text string")
