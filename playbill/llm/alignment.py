"""Alignment of the tokens of two tokenizers over the same bytes.

Two token sequences of one text are cut into groups wherever a token of both ends at the same byte.
What is known of a range of bytes is a `Fragment`: tokens before its first cut (the open prefix),
closed groups, and tokens after its last cut (the open suffix). Fragments of neighbouring ranges
compose, and composing is associative.

1. Single spaces before letters, digits and ASCII marks are places that no token of either tokenizer
   crosses (checked when the vocabularies are read). Between them lie units, mostly words. New units
   of a batch are tokenized, read as one stream of bytes, aligned range by range and composed.
   A unit's groups are closed, so documents are put together from what is kept of their units.
2. Documents over SEGMENT characters are cut into segments at such places; segments are dealt over
   all tasks, and their fragments meet eight at a time, in a tree.
3. Linked id pairs of all documents are counted, and the counts meet the documents' pairs again.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from playbill.llm.common import join_bounded, slices, stored
from playbill.session import cut_lineage

CHUNK = 1 << 14  # bytes of a range
SEGMENT = 1 << 16  # characters of a text that one task tokenizes, as far as it has places to cut
FAN = 8  # fragments that meet at once
BLOCK = 1 << 20  # linked pairs expanded at once
BATCH, BATCH_BYTES = 256, 2 << 20  # texts tokenized at once
UNITS, UNIT_CHARS, UNIT_PAIRS = 300_000, 16 << 20, 2_000_000  # units kept by a worker, with their characters and pairs
IDS = 20  # bits of a token id
# a place to cut: one space, not behind another, before a letter, a digit or an ASCII mark
AFTER = r"[^\W_]|[!-/:-@\[-`{-~]"
FIRST = re.compile(AFTER)
JOINED = 512  # new units tokenized as one text
CUT = re.compile(rf"(?<=[^ ]) (?={AFTER})")
NO_CUT = re.compile(rf"^ | (?!{AFTER})")
NONE = np.empty(0, np.int64)


@dataclass
class Fragment:
    """Token ids of a byte range, and its cuts: how many tokens of each side lie before one. Tokens
    before the first cut and after the last are open; between two cuts lies a closed group."""

    a: np.ndarray
    b: np.ndarray
    cuts_a: np.ndarray
    cuts_b: np.ndarray

    def __add__(self, other: Fragment) -> Fragment:
        """The fragment of both ranges: this one's open suffix and the other's open prefix are one."""
        return Fragment(
            np.concatenate([self.a, other.a]), np.concatenate([self.b, other.b]),
            np.concatenate([self.cuts_a, other.cuts_a + len(self.a)]), np.concatenate([self.cuts_b, other.cuts_b + len(self.b)]))

    @staticmethod
    def of_range(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray) -> Fragment:
        """From the tokens that end in a range, with the bytes at which they end."""
        _, at_a, at_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        return Fragment(a, b, at_a + 1, at_b + 1)

    @staticmethod
    def of(a: np.ndarray, ends_a: np.ndarray, b: np.ndarray, ends_b: np.ndarray, size: int = CHUNK) -> Fragment:
        """The ranges of a text, composed."""
        last = int(max(ends_a[-1], ends_b[-1])) if len(a) and len(b) else 0
        if last <= size:
            return Fragment.of_range(a, ends_a, b, ends_b)
        borders = np.arange(size, last + size, size)
        cut_a, cut_b = (np.concatenate([[0], np.searchsorted(ends, borders, side="right")]) for ends in (ends_a, ends_b))
        parts = [Fragment.of_range(a[i:j], ends_a[i:j], b[k:m], ends_b[k:m]) for i, j, k, m in zip(cut_a[:-1], cut_a[1:], cut_b[:-1], cut_b[1:], strict=True)]
        return composed(parts)


def composed(parts: list[Fragment]) -> Fragment:
    """Neighbours two by two, until one is left."""
    while len(parts) > 1:
        parts = [x + y for x, y in zip(parts[::2], [*parts[1::2], *[EMPTY] * (len(parts) % 2)], strict=True)]
    return parts[0] if parts else EMPTY


EMPTY = Fragment(NONE, NONE, NONE, NONE)


class Tokenizers:
    """The two tokenizers of files, with the bytes of their tokens."""

    def __init__(self, byte_level: bytes, pieces: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(byte_level.decode())
        self.a.encode_special_tokens = True
        self.b = SentencePieceProcessor(model_proto=pieces)
        # byte-level characters: printable ones of Latin-1 stand for themselves, the others for 256 on
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [byte for byte in range(256) if byte not in printable]
        byte_of = {chr(byte): byte for byte in printable} | {chr(256 + i): byte for i, byte in enumerate(hidden)}
        model = json.loads(byte_level)["model"]["vocab"]
        self.bytes_a = [b""] * (1 + max(model.values()))
        for token, i in model.items():
            self.bytes_a[i] = bytes(byte_of[c] for c in token)
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(n[3:5], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode() for i, n in enumerate(names)]
        if max(len(self.bytes_a), len(self.bytes_b)) >> IDS:
            raise ValueError(f"more than 2^{IDS} tokens")
        if any(" " in piece.lstrip(b" ").decode(errors="ignore") for piece in self.bytes_b if len(piece) > 1):
            raise ValueError("a piece has a space behind another character: texts can not be cut at spaces")
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in some], np.int64) for some in (self.bytes_a, self.bytes_b))

    def encoded(self, texts: list[str]) -> tuple[list[list[int]], list[list[int]], list[bool]]:
        """Both token sequences of space + text each, and whether both give its bytes."""
        tokens_a = [e.ids for e in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        tokens_b = self.b.encode(texts, num_threads=1)
        name_a, name_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        same = [b"".join(map(name_a, a)) == b" " + text.encode() == b"".join(map(name_b, b)) for text, a, b in zip(texts, tokens_a, tokens_b, strict=True)]
        return tokens_a, tokens_b, same

    def fragment(self, a: np.ndarray, b: np.ndarray) -> Fragment:
        """Of the tokens of the same bytes."""
        return Fragment.of(a, np.cumsum(self.sizes_a[a]), b, np.cumsum(self.sizes_b[b]))

    def of_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The tokens of units one after the other, and how many each unit has; none, if their bytes
        are others. Units that may stand side by side in a text are tokenized together."""
        parts, start = [], 0
        for i in range(1, len(units) + 1):
            if i == len(units) or i - start == JOINED or units[i - 1][-1:] in ("", " ") or not FIRST.match(units[i]):
                parts.append(units[start:i])
                start = i
        found = []
        for part, *tokens, same in zip(parts, *self.encoded([" ".join(part) for part in parts]), strict=True):
            if same or len(part) == 1:
                found.append((part, *tokens, same))
            else:
                found += zip(([u] for u in part), *self.encoded(part), strict=True)
        tokens, numbers = ([], []), ([], [])
        for part, *pair, same in found:
            ends = np.cumsum([len(u.encode()) + 1 for u in part])
            for ids, sizes, out, n in zip(pair, (self.sizes_a, self.sizes_b), tokens, numbers, strict=True):
                ids = np.array(ids if same else [], np.int64)
                out.append(ids)
                n.append(np.diff(np.searchsorted(np.cumsum(sizes[ids]), ends, side="right"), prepend=0))
        return *map(np.concatenate, tokens), *map(np.concatenate, numbers)

    def fragment_of(self, text: str) -> Fragment | None:
        """Of one text; None if the bytes of its tokens are others."""
        a, b, same = self.encoded([text])
        return self.fragment(np.array(a[0], np.int64), np.array(b[0], np.int64)) if text and same[0] else None


class Units:
    """What is kept of units: their groups as text, their figures and their linked pairs."""

    def __init__(self, own: Tokenizers):
        self.own = own
        self.clear()

    def clear(self) -> None:
        self.number: dict[str, int] = {}
        self.texts: list[str] = []
        self.figures = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, n_links, whether the bytes are others
        self.starts, self.pairs, self.times = np.zeros(1, np.int64), NONE, NONE
        self.chars = 0

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """The units of every text, in order."""
        if len(self.number) > UNITS or self.chars > UNIT_CHARS or len(self.pairs) > UNIT_PAIRS:
            self.clear()
        units = [(CUT.split if NO_CUT.search(text) or "  " in text else cut_simply)(text) for text in texts]
        known = self.number
        new = list(dict.fromkeys(u for some in units for u in some if u not in known))
        if new:
            self.learn(new)
        return [np.fromiter(map(known.__getitem__, some), np.int64, len(some)) for some in units]

    def learn(self, new: list[str]) -> None:
        a, b, n_a, n_b = self.own.of_units(new)
        f = self.own.fragment(a, b)
        sound = np.flatnonzero(n_a)
        figures = np.zeros((len(new), 5), np.int64)
        figures[:, 0], figures[:, 1], figures[:, 4] = n_a, n_b, n_a == 0
        through_a, through_b = np.cumsum(n_a[sound]), np.cumsum(n_b[sound])
        owner = sound[np.searchsorted(through_a, f.cuts_a)]  # the unit of each group
        np.add.at(figures[:, 2], owner, 1)
        np.add.at(figures[:, 3], owner, np.diff(f.cuts_a, prepend=0) * np.diff(f.cuts_b, prepend=0))
        marks = marks_of_groups(f)
        ends = through_a + through_b
        texts = [""] * len(new)
        for i, a, b in zip(sound.tolist(), [0, *ends.tolist()[:-1]], ends.tolist()):
            texts[i] = "".join(marks[a:b])
        found = [*linked_pairs(f, owner)]
        owners, a, b, times = map(np.concatenate, zip(*found, strict=True)) if found else (NONE,) * 4
        ends = self.starts[-1] + np.cumsum(np.bincount(owners, minlength=len(new)))

        self.number |= zip(new, range(len(self.texts), len(self.texts) + len(new)))
        self.texts += texts
        self.chars += sum(map(len, new)) + sum(map(len, texts))
        self.figures = np.concatenate([self.figures, figures])
        self.starts = np.concatenate([self.starts, ends])
        self.pairs, self.times = np.concatenate([self.pairs, a << IDS | b]), np.concatenate([self.times, times])

    def lines(self, row: int, doc_id, numbers: np.ndarray) -> Iterator[tuple]:
        """The rows of a document, from its units."""
        n_a, n_b, n_groups, n_links, others = self.figures[numbers].sum(axis=0).tolist()
        if others or not n_a:
            yield row, doc_id, 0, 0, 0, 0, "", [], []
            return
        digest = hashlib.sha256("".join(map(self.texts.__getitem__, numbers.tolist()))[:-1].encode()).hexdigest()
        units, often = np.unique(numbers, return_counts=True)
        each = self.starts[units + 1] - self.starts[units]
        where = np.arange(each.sum()) + np.repeat(self.starts[units] - (np.cumsum(each) - each), each)
        pairs, place = np.unique(self.pairs[where], return_inverse=True)
        times = np.bincount(place, weights=self.times[where] * np.repeat(often, each)).astype(np.int64)
        yield from in_lines(row, doc_id, (n_a, n_b, n_groups, n_links, digest), [(pairs, times)])


def cut_simply(text: str) -> list[str]:
    """For texts in which every space is a place to cut."""
    return text.split(" ")


TOKENIZERS: dict[bytes, Units] = {}


def tokenizers(byte_level: bytes, pieces: bytes) -> Units:
    """One pair a worker process."""
    key = hashlib.sha256(byte_level + pieces).digest()
    if key not in TOKENIZERS:
        TOKENIZERS.clear()
        TOKENIZERS[key] = Units(Tokenizers(byte_level, pieces))
    return TOKENIZERS[key]


def segments(text: str, size: int = SEGMENT) -> Iterator[str]:
    """Parts of a text that give it back when joined by a space: cut at the first place after `size`
    characters; where there is none, a part is longer."""
    start = 0
    while (found := CUT.search(text, start + size)) is not None:
        yield text[start : found.start()]
        start = found.end()
    yield text[start:]


def marks_of_groups(f: Fragment) -> list[str]:
    """The ids of a closed fragment as `a1,a2|b1;a3|b2,b3;`, a string for each token."""
    group_a, group_b = (np.searchsorted(cuts, np.arange(len(ids)), side="right") for ids, cuts in ((f.a, f.cuts_a), (f.b, f.cuts_b)))
    # a token stands behind all tokens of earlier groups, one of the right side behind its own left ones
    before_b = np.concatenate([[0], f.cuts_b])
    place = np.concatenate([np.arange(len(f.a)) + before_b[group_a], np.arange(len(f.b)) + f.cuts_a[group_b]])
    ids, ends = np.empty(len(place), np.int64), np.zeros(len(place), np.int64)
    ids[place] = np.concatenate([f.a, f.b])
    ends[place[f.cuts_a - 1]] = 1
    ends[place[len(f.a) + f.cuts_b - 1]] = 2
    marks = (",", "|", ";")
    return [f"{i}{marks[e]}" for i, e in zip(ids.tolist(), ends.tolist(), strict=True)]


def in_group(ids: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) of the different ids of every group, by group."""
    group = np.searchsorted(cuts, np.arange(len(ids)), side="right")
    keys, times = np.unique(group << IDS | ids, return_counts=True)
    return keys >> IDS, keys & ((1 << IDS) - 1), times


def linked_pairs(f: Fragment, owner: np.ndarray, block: int = BLOCK) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(owner, a, b, times) of the different linked id pairs of each owner of groups, by owner. In
    blocks of left ids, so that about `block` pairs are expanded at once even where a group is very
    large; a pair is in one block only."""
    if not len(f.cuts_a):
        return
    group_a, a, times_a = in_group(f.a, f.cuts_a)
    group_b, b, times_b = in_group(f.b, f.cuts_b)
    numbers = np.bincount(group_b, minlength=len(f.cuts_a))
    starts = np.concatenate([[0], np.cumsum(numbers)])
    left = owner[group_a] << IDS | a
    order = np.argsort(left, kind="stable")
    group_a, left, times_a = group_a[order], left[order], times_a[order]
    weight = np.cumsum(numbers[group_a])
    i = 0
    while i < len(left):
        j = int(np.searchsorted(weight, (weight[i - 1] if i else 0) + block, side="right"))
        j = int(np.searchsorted(left, left[max(j, i + 1) - 1], side="right"))  # to the end of an id
        each = numbers[group_a[i:j]]
        right = np.arange(each.sum()) + np.repeat(starts[group_a[i:j]] - (np.cumsum(each) - each), each)
        one, two = np.repeat(left[i:j], each), b[right]
        times = np.repeat(times_a[i:j], each) * times_b[right]
        order = np.lexsort((two, one))
        one, two, times = one[order], two[order], times[order]
        first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two[1:] != two[:-1])]))
        yield one[first] >> IDS, one[first] & ((1 << IDS) - 1), two[first], np.add.reduceat(times, first)
        i = j


FIGURES = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256"]


def in_lines(row: int, doc_id, figures: tuple, pairs) -> Iterator[tuple]:
    """The rows of a document: its figures and first pairs, then pairs that do not fit."""
    for some, times in pairs:
        for i in range(0, len(some), BLOCK):
            yield row, doc_id, *figures, some[i : i + BLOCK], times[i : i + BLOCK]
            figures = (None,) * 5


def lines_of(row: int, doc_id, f: Fragment | None) -> Iterator[tuple]:
    """The rows of a document, from its closed fragment."""
    if f is None or not len(f.a):
        yield row, doc_id, 0, 0, 0, 0, "", [], []
        return
    links = np.diff(f.cuts_a, prepend=0) * np.diff(f.cuts_b, prepend=0)
    digest = hashlib.sha256("".join(marks_of_groups(f))[:-1].encode()).hexdigest()
    pairs = ((a << IDS | b, times) for _, a, b, times in linked_pairs(f, np.zeros(len(f.cuts_a), np.int64)))
    yield from in_lines(row, doc_id, (len(f.a), len(f.b), len(f.cuts_a), int(links.sum()), digest), pairs)


def batches_of_lines(lines: Iterator[tuple], id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    names = ["row", "doc_id", *FIGURES, "pairs", "times"]
    kinds = [pa.int64(), id_type, *[pa.int64()] * 4, pa.string(), *[pa.list_(pa.int64())] * 2]
    waiting, size = [], 0

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*waiting, strict=True), kinds, strict=True)], names)

    for line in lines:
        waiting.append(line)
        size += len(line[-1])
        if size >= BLOCK // 4 or len(waiting) == 256:
            yield batch()
            waiting, size = [], 0
    if waiting:
        yield batch()


def aligned(docs: DataFrame, byte_level: bytes, pieces: bytes, id_column: str = "doc_id", text_column: str = "text", segment: int = SEGMENT) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256), a row for each row of docs.

    The left tokenizer (a `tokenizers` file) encodes space + text, the right one (a SentencePiece
    file) the text, to which it adds the space itself; neither makes special tokens. Tokens of
    both sides in one group are linked; the count of an id pair is the number of rows of docs that
    have it linked. n_best: links whose count is the highest of their left id. NULL and empty texts,
    and texts whose tokens do not give space + text back, have zeros and ''. Rows are independent, so
    ids may be NULL or repeated; equal rows all count; an empty table gives no rows. Other columns are
    left out. The two vocabularies (2 MB, whatever the data) are broadcast.
    """
    sent = docs.sparkSession.sparkContext.broadcast((byte_level, pieces))
    kind = docs.schema[id_column].dataType.simpleString()
    # rows get a number of their own, which holds as both ways write it down; even ones go one way, odd ones the other
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"), (F.monotonically_increasing_id() * 2).alias("row"))
    is_long = F.coalesce(F.length("text") > segment, F.lit(False))
    line = f"row long, doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<long>"
    part = f"row long, doc_id {kind}, no long, text string"
    fragment = f"row long, doc_id {kind}, no long, whole boolean, a array<int>, b array<int>, cuts_a array<int>, cuts_b array<int>"
    arrays = ["a", "b", "cuts_a", "cuts_b"]

    def short_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = tokenizers(*sent.value)
        for batch in batches:
            rows, ids, texts = (c.to_pylist() for c in batch.columns)
            texts = [t or "" for t in texts]
            for a, n in slices(list(map(len, texts)), BATCH, BATCH_BYTES):
                numbers = units.numbers(texts[a : a + n])
                found = (units.lines(*x) for x in zip(rows[a : a + n], ids[a : a + n], numbers, strict=True))
                yield from batches_of_lines(chain.from_iterable(found), batch.column(1).type)

    def cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, text in enumerate(batch.column(2).to_pylist()):
                for no, some in enumerate(segments(text, segment)):
                    yield pa.RecordBatch.from_arrays([batch.column(0)[i : i + 1], batch.column(1)[i : i + 1], pa.array([no], pa.int64()), pa.array([some])], ["row", "doc_id", "no", "text"])

    def written(batch: pa.RecordBatch, i: int, f: Fragment | None) -> pa.RecordBatch:
        """A fragment with the first three columns of row i."""
        own = f or EMPTY
        lists = [pa.array([getattr(own, c).astype(np.int32)], pa.list_(pa.int32())) for c in arrays]
        return pa.RecordBatch.from_arrays([*(batch.column(c)[i : i + 1] for c in range(3)), pa.array([f is not None]), *lists], ["row", "doc_id", "no", "whole", *arrays])

    def read(member: dict) -> Fragment | None:
        return Fragment(*(np.array(member[c], np.int64) for c in arrays)) if member["whole"] else None

    def segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizers(*sent.value).own
        for batch in batches:
            for i in range(len(batch)):
                yield written(batch, i, own.fragment_of(batch.column(3)[i].as_py()))

    def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                parts = list(map(read, batch.column(3)[i].as_py()))
                # one segment whose bytes are others spoils the document
                yield written(batch, i, None if any(p is None for p in parts) else composed(parts))

    def long_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                member = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                yield from batches_of_lines(lines_of(member["row"], member["doc_id"], read(member)), batch.column(1).type)

    short = source.where(~is_long).select("row", "doc_id", "text").mapInArrow(short_rows, line)
    parts = cut_lineage(source.where(is_long).select((F.col("row") + 1).alias("row"), "doc_id", "text").mapInArrow(cut_rows, part))
    fragments = cut_lineage(parts.repartition("row", "no").mapInArrow(segment_rows, fragment))
    last = parts.agg(F.coalesce(F.max("no"), F.lit(0))).first()[0]
    while last > 0:
        members = F.sort_array(F.collect_list(F.struct("no", "whole", *arrays))).alias("members")
        met = fragments.groupBy("row", "doc_id", F.floor(F.col("no") / FAN).alias("no")).agg(members)
        fragments, last = cut_lineage(met.mapInArrow(together, fragment)), last // FAN

    with stored(short.unionByName(fragments.mapInArrow(long_rows, line)).withColumn("part", F.lit(0)), "alignment", "part") as lines:
        links = lines.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF("row", "pair", "n")
        counts = cut_lineage(links.groupBy("pair").agg(F.count("*").alias("docs")))
        left = F.shiftright("pair", IDS)
        best = counts.groupBy(left.alias("left")).agg(F.max("docs").alias("most"))
        ranked = counts.join(best, left == F.col("left")).select("pair", "docs", (F.col("docs") == F.col("most")).alias("best"))
        sums = join_bounded(links, cut_lineage(ranked), ["pair"], "inner", 24).groupBy("row").agg(
            F.sum(F.when(F.col("best"), F.col("n")).otherwise(0)).alias("n_best"), F.sum(F.col("n") * F.col("docs")).alias("count_sum"))
        done = cut_lineage(lines.where("n_a IS NOT NULL").join(sums, "row", "left").select(
            "doc_id", *FIGURES[:4], F.coalesce("n_best", F.lit(0)).alias("n_best"), F.coalesce("count_sum", F.lit(0)).alias("count_sum"), "groups_sha256"))
    return done
