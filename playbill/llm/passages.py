"""Repeated passages inside documents: paragraph MinHash banding with exact verification.

Two kinds of paragraph are compared. Natural ones are the lines of a text from one shingle on, and
runs of neighbouring lines shorter than `min_words`: all between two blank or long lines, and their
sections at line borders that the words beside them choose. MinHash bands of their five-word
shingles find candidates, exact Jaccard verifies them, and components of verified pairs are
clusters. A passage that was copied into the middle of other lines has no line of its own, so
content-defined paragraphs are compared as well: windows of `min_words` words that begin where the
text itself says so (the least word-pair hash of any 16 in a row), so that two copies of a passage
have windows at the same words. These have to be equal; that is a band of one hash. The windows at
the ends of what is equal are seeds: the 15 words beyond them, which is as far as a shared run can
reach beyond its outermost windows, are sorted by window and words. Neighbours in that order share
most, so one pass each way finds how many words a document with a smaller id shares.

Of every cluster the document with the smallest id keeps its paragraphs, the others lose them.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playbill.llm.common import BASE, grams, join_bounded, join_lists, mix, slices, stored, tidy, word_hashes
from playbill.llm.setjoin import colliding, linked
from playbill.session import cut_lineage

SHINGLE = 5
GAP = 16  # any GAP word pairs in a row have an anchor
LINES = np.uint64(4)  # lines in a section of short lines, on average
SLICE, SLICE_BYTES = 128, 4 << 20  # texts handled at once
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
SECTION = "kind int, key long, check int, doc_id long, version long, start int, end int, short boolean, bands array<long>"
BEYOND = "key long, check int, side int, doc_id long, version long, start int, next binary, more int, kept long"
WORD_BYTES = 5  # of a word's hash, in `next`
SPAN = "array<struct<start:int,end:int,kept:long>>"


def tuned_bands(similarity: float, recall: float, rows: int = 3) -> int:
    """The fewest bands of `rows` hashes that find a pair of this similarity with this probability."""
    bands = 1
    while 1 - (1 - similarity**rows) ** bands < recall:
        bands += 1
    return bands


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the base and of its inverse."""
    if len(POWERS[0]) < n:
        for k, base in enumerate((BASE, INVERSE)):
            POWERS[k] = np.concatenate([np.ones(1, np.uint64), np.multiply.accumulate(np.full(max(n, 4096), base, np.uint64))])
    return POWERS[0][:n], POWERS[1][:n]


class Texts:
    """The words of some texts one after the other: their hashes, the borders of texts and lines in
    words, and hashes of sections."""

    def __init__(self, texts: list[bytes]):
        words: list[bytes] = []
        borders, lines, ends = [0], [], [0]
        for text in texts:
            before = len(borders)
            for line in text.lower().split(b"\n"):
                words += line.split()
                borders.append(len(words))
            lines.append(len(borders) - before)
            ends.append(len(words))
        self.borders, self.ends = np.array(borders, np.int64), np.array(ends, np.int64)
        self.text_of_line = np.repeat(np.arange(len(texts)), lines)
        self.text_of_word = np.repeat(np.arange(len(texts)), np.diff(self.ends))
        self.hashes = word_hashes(words)
        power, self.inverse = powers(len(words) + 1)
        self.ordered = np.concatenate([np.zeros(1, np.uint64), np.cumsum(self.hashes * power[:-1], dtype=np.uint64)])
        self.bag = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(self.hashes), dtype=np.uint64)])

    def sections(self, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A 64-bit hash and an independent 31-bit check of the words from start to end."""
        key = mix((self.ordered[end] - self.ordered[start]) * self.inverse[start] + (end - start).astype(np.uint64))
        check = mix(self.bag[end] - self.bag[start]) >> np.uint64(33)
        return key.view(np.int64), check.astype(np.int32)

    def anchors(self) -> np.ndarray:
        """Word places with the least word-pair hash of some GAP in a row of one text."""
        n = len(self.hashes) - GAP
        if n < 1:
            return np.empty(0, np.int64)
        least = np.lib.stride_tricks.sliding_window_view(grams(self.hashes, 2), GAP).argmin(axis=1) + np.arange(n)
        return np.unique(least[self.text_of_word[:n] == self.text_of_word[GAP:]])

    def windows(self, words: int) -> tuple[np.ndarray, np.ndarray]:
        """Start and text of the windows that begin at an anchor and end in the same text."""
        at = self.anchors()
        at = at[at + words <= self.ends[self.text_of_word[at] + 1]]
        return at, self.text_of_word[at]

    def paragraphs(self, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and text of the lines of a shingle or more and of runs of two or more lines
        shorter than min_words, and whether such lines make it up. Runs end at blank lines, longer
        lines and texts; their sections end at chosen line borders too."""
        starts, ends, owner = self.borders[:-1], self.borders[1:], self.text_of_line
        words = ends - starts
        short = (words > 0) & (words < min_words)
        joins = short[1:] & short[:-1] & (owner[1:] == owner[:-1])
        chosen = np.zeros(len(joins), bool)
        b = starts[1:][joins]
        chosen[joins] = mix(self.hashes[b - 1] * BASE + self.hashes[b]) % LINES == 0
        first, last = [np.arange(len(words))], [np.arange(len(words))]
        for together in (joins, joins & ~chosen):
            edges = np.diff(np.concatenate([[False], together, [False]]).astype(np.int8))
            first.append(np.flatnonzero(edges == 1))
            last.append(np.flatnonzero(edges == -1))
        lines = np.unique(np.stack([np.concatenate(first), np.concatenate(last)], axis=1), axis=0)
        lines = lines[ends[lines[:, 1]] - starts[lines[:, 0]] >= SHINGLE]
        return starts[lines[:, 0]], ends[lines[:, 1]], owner[lines[:, 0]], short[lines[:, 0]]

    def shingles(self) -> np.ndarray:
        return grams(self.hashes, SHINGLE) if len(self.hashes) >= SHINGLE else np.empty(0, np.uint64)


def repeated(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_words: int = 32,
             num: int = 80, den: int = 100, recall: float = 0.995) -> DataFrame:
    """(doc_id, version, spans) for each text with passages that a document with a smaller id has too.

    spans: merged, in order: words `start` to before `end` (counted from 0) and `kept`, the
    smallest id of those that keep them. version: a hash of the text, which tells texts with one id
    apart. Found are, in full length, all passages of min_words + 16 words or more that two
    documents share word for word (A-Z in lower case, any white space); and lines of five words or more, and paragraphs of shorter lines than
    min_words, whose five-word shingles have a Jaccard of num / den or more, with the recall that
    the bands are tuned for. Where a near copy of short lines is one only by an equal run of
    min_words or more that ends inside it, the words past the run's end stay. Passages that only
    one document repeats stay. NULL and empty texts and NULL ids have no spans; the rows of one id are one
    document; an empty table gives no rows.
    """
    bands, rows_of_band = tuned_bands(num / den, recall), 3
    seeds = mix(np.arange(1, 2 * bands * rows_of_band + 1, dtype=np.uint64))
    factors, shifts = seeds[0::2] | np.uint64(1), seeds[1::2]
    source = docs.where(F.col(id_column).isNotNull() & F.col(text_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("binary").alias("text"), F.xxhash64(text_column).alias("version"))

    def units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """kind 0: windows, 1: paragraphs, with their bands at one place in a slice."""
        for batch in batches:
            data = batch.column(1).to_pylist()
            for a, n in slices(list(map(len, data)), SLICE, SLICE_BYTES):
                part, texts = batch.slice(a, n), Texts(data[a : a + n])
                ids, versions = part.column(0).to_numpy(), part.column(2).to_numpy()
                at, text_of_window = texts.windows(min_words)
                starts, ends, text_of_line, short = texts.paragraphs(min_words)
                for kind, start, end, owner, loose in ((0, at, at + min_words, text_of_window, np.zeros(len(at), bool)), (1, starts, ends, text_of_line, short)):
                    if not len(start):
                        continue
                    key, check = texts.sections(start, end)
                    lists = pa.nulls(len(start), pa.list_(pa.int64())) if kind == 0 else bands_of(texts, key, start, end)
                    first = texts.ends[owner]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(start), kind, np.int32)), pa.array(key), pa.array(check), pa.array(ids[owner]), pa.array(versions[owner]),
                        pa.array((start - first).astype(np.int32)), pa.array((end - first).astype(np.int32)), pa.array(loose), lists], [c.split()[0] for c in SECTION.split(", ")])

    def bands_of(texts: Texts, key: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The bands of each different paragraph, where it stands first; NULL where it stands again."""
        # in the order of the text: what lies between two paragraphs is read too
        each = np.sort(np.unique(key, return_index=True)[1])
        five = np.append(texts.shingles(), np.uint64(0))
        cuts = np.stack([starts[each], ends[each] - SHINGLE + 1], axis=1).ravel()
        found = np.empty((len(each), bands), np.uint64)
        for b in range(bands):
            total = np.full(len(each), b, np.uint64)
            for k in range(b * rows_of_band, (b + 1) * rows_of_band):
                total = mix(total * BASE + np.minimum.reduceat(five * factors[k] + shifts[k], cuts)[::2])
            found[:, b] = total
        fresh = np.zeros(len(key), bool)
        fresh[each] = True
        offsets = np.concatenate([[0], np.cumsum(fresh * bands)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(found.ravel().view(np.int64)), mask=pa.array(~fresh))

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, n in slices(list(map(len, data := batch.column(0).to_pylist())), SLICE, SLICE_BYTES):
                texts, wanted = Texts(data[a : a + n]), list(map(set, batch.column(1).slice(a, n).to_pylist()))
                starts, ends, owner, _ = texts.paragraphs(min_words)
                five = texts.shingles().view(np.int64)
                ids, sets = [], []
                for name, s, e, text in zip(texts.sections(starts, ends)[0].tolist(), starts.tolist(), ends.tolist(), owner.tolist(), strict=True):
                    if name in wanted[text]:
                        wanted[text].discard(name)
                        ids.append(name)
                        sets.append(np.unique(five[s : e - SHINGLE + 1]))
                if ids:
                    offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))], ["id", "items"])

    made = source.select("doc_id", "text", "version").mapInArrow(tidy(units), SECTION)
    def beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The windows that begin at the places asked for, with the GAP - 1 words beyond them on a
        side, the nearest first."""
        for batch in batches:
            for a, n in slices(list(map(len, data := batch.column(1).to_pylist())), SLICE, SLICE_BYTES):
                part, texts = batch.slice(a, n), Texts(data[a : a + n])
                ids, versions = part.column(0).to_numpy(), part.column(2).to_numpy()
                words = np.append(texts.hashes, np.uint64(0)).astype(">u8").view(np.uint8).reshape(-1, 8)[:, :WORD_BYTES]
                for side in (0, 1):
                    places = part.column(3 + side).to_pylist()
                    owner = np.repeat(np.arange(n), [len(x or ()) for x in places])
                    if not len(owner):
                        continue
                    at = np.array([x for some in places for x in some or ()], np.int64) + texts.ends[owner]
                    steps = np.arange(GAP - 1)
                    where = at[:, None] - 1 - steps if side == 0 else at[:, None] + min_words + steps
                    inside = (where >= texts.ends[owner][:, None]) & (where < texts.ends[owner + 1][:, None])
                    data_of = np.ascontiguousarray(words[where[inside]])
                    offsets = np.concatenate([[0], np.cumsum(inside.sum(axis=1) * WORD_BYTES)]).astype(np.int32)
                    key, check = texts.sections(at, at + min_words)
                    size, zero = len(at), np.zeros(len(at), np.int64)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(key), pa.array(check), pa.array(np.full(size, side, np.int32)), pa.array(ids[owner]), pa.array(versions[owner]),
                        pa.array((at - texts.ends[owner]).astype(np.int32)), pa.BinaryArray.from_buffers(pa.binary(), size, [None, pa.py_buffer(offsets), pa.py_buffer(data_of)]),
                        pa.array(zero.astype(np.int32)), pa.array(ids[owner])], [c.split()[0] for c in BEYOND.split(", ")])

    with stored(made, "passages", "kind", "zstd") as made:
        return spans_of(source, made, to_sets, beyond, min_words, num, den)


SAME = ["key", "check", "kind"]  # the key first: rows are sorted by their first column, and only ties by the others


def in_several(sections: DataFrame) -> DataFrame:
    """The sections that two documents or more have, with the smallest id of these: kept. Sections of
    one document that are first or last in a batch may stay; they have its own id as kept."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, least = None, 0
        for batch in batches:
            if not len(batch):
                continue
            same, docs = [batch.column(c).to_numpy() for c in SAME], batch.column("doc_id").to_numpy()
            fresh = np.ones(len(docs), bool)
            fresh[1:] = np.any([x[1:] != x[:-1] for x in same], axis=0)
            starts = np.flatnonzero(fresh)
            ends = np.append(starts[1:], len(docs))
            kept = docs[starts]
            several = docs[ends - 1] != kept
            if last == [x[0] for x in same]:  # goes on from the batch before
                kept[0], several[0] = least, True
            several[-1] = True  # may go on in the next one
            last, least = [x[-1] for x in same], kept[-1]
            keep = np.repeat(several, ends - starts)
            yield pa.RecordBatch.from_arrays([*batch.filter(pa.array(keep)).columns, pa.array(np.repeat(kept, ends - starts)[keep])], [*batch.schema.names, "kept"])

    ordered = sections.repartition(*SAME).sortWithinPartitions(*SAME, "doc_id")
    return ordered.mapInArrow(tidy(rows), sections.withColumn("kept", F.col("doc_id")).schema)


def covered(windows: DataFrame) -> DataFrame:
    """(doc_id, version, start, end, kept, windows): the words of a document that equal windows
    cover without a gap, with those of its windows (key, check) that begin less than GAP words from
    where they begin (left) or end so from where they end (right)."""
    place = Window.partitionBy("doc_id", "version").orderBy("start")
    gap = F.col("start") - F.lag("end").over(place)
    windows = windows.withColumn("fresh", F.when(F.coalesce(gap > 0, F.lit(True)), F.col("start")))
    windows = windows.withColumn("began", F.last("fresh", True).over(place))
    windows = windows.groupBy("doc_id", "version", "began").agg(
        F.max("end").alias("ended"), F.min("kept").alias("kept"), F.collect_list(F.struct("key", "check", "start", "end")).alias("windows"))
    marked = F.transform("windows", lambda w: F.struct(
        w.key.alias("key"), w.check.alias("check"), (w.start - F.col("began") < GAP - 1).alias("left"), (F.col("ended") - w.end < GAP - 1).alias("right")))
    return windows.select("doc_id", "version", F.col("began").alias("start"), F.col("ended").alias("end"), "kept", F.filter(marked, lambda w: w.left | w.right).alias("windows"))


def words_shared(column: pa.Array, last: bytes) -> tuple[list[int], list[int], bytes]:
    """How many words each value has, how many of them at its start are those of the value before
    (`last` for the first; GAP - 1 if the two are equal), and the last value."""
    size = (GAP - 1) * WORD_BYTES
    counts = np.diff(np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1])
    padded = np.zeros((len(column) + 1, size), np.uint8)
    padded[0, : len(last)] = np.frombuffer(last, np.uint8)
    inside = np.arange(size) < counts[:, None]
    padded[1:][inside] = np.frombuffer(b"".join(column.to_pylist()), np.uint8)
    counts = np.append(len(last), counts)
    differ = padded[1:] != padded[:-1]
    same = np.minimum(np.where(differ.any(axis=1), differ.argmax(axis=1), size), np.minimum(counts[1:], counts[:-1])) // WORD_BYTES
    same[(counts[1:] == counts[:-1]) & (same * WORD_BYTES == counts[1:])] = GAP - 1
    return (counts[1:] // WORD_BYTES).tolist(), same.tolist(), column[-1].as_py() if len(column) else last


def shared_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """`more` and `kept` raised to what a row before in the order says: the most words beyond its
    window that it shares with one of a smaller id, and that id. For every number of words shared
    with the row at hand, only the smallest id so far is kept."""
    never = 1 << 62
    least = [never] * GAP
    last_window, last = None, b""
    for batch in batches:
        columns = [batch.column(c).to_numpy().tolist() for c in (0, 1, 2, 3, 7, 8)]
        found, keepers = [], []
        counts, shared, last = words_shared(batch.column(6), last)
        for key, check, side, doc, more, kept, own, same in zip(*columns, counts, shared, strict=True):
            if (key, check, side) != last_window:
                last_window, least = (key, check, side), [never] * GAP
            elif same < GAP - 1:
                least[same + 1 :] = [never] * (GAP - 1 - same)
            best = own
            while best > more and least[best] >= doc:
                best -= 1
            if best > 0 and least[best] < doc:
                kept = least[best] if best > more else min(kept, least[best])
                more = best
            found.append(more)
            keepers.append(kept)
            if doc < least[own]:
                for i in range(own, -1, -1):
                    if least[i] <= doc:
                        break
                    least[i] = doc
        yield pa.RecordBatch.from_arrays([*batch.columns[:7], pa.array(found, pa.int32()), pa.array(keepers, pa.int64())], batch.schema.names)


def spans_of(source: DataFrame, made: DataFrame, to_sets, beyond, min_words: int, num: int, den: int) -> DataFrame:
    """The spans of the documents, from the paragraphs found in them."""
    with stored(in_several(made.drop("short", "bands")), "shared", "kind", "zstd") as shared:
        equal = shared.where("doc_id <> kept")
        runs = cut_lineage(covered(equal.where("kind = 0")))
        equal = cut_lineage(equal.where("kind = 1").select("doc_id", "version", "start", "end", "kept"))
        # equal windows at the ends of what is equal, in every document that has them: the words beyond
        seeds = cut_lineage(runs.select(F.inline("windows")).groupBy("key", "check").agg(F.max("left").alias("left"), F.max("right").alias("right")))
        places = join_bounded(shared.where("kind = 0").select("key", "check", "doc_id", "version", "start"), seeds, ["key", "check"], "inner", 24)
        places = cut_lineage(places.groupBy("doc_id", "version").agg(
            F.collect_set(F.when(F.col("left"), F.col("start"))).alias("left"), F.collect_set(F.when(F.col("right"), F.col("start"))).alias("right")))
    texts = join_lists(source, places, ["doc_id", "version"], "inner", {"left": 4, "right": 4}).select("doc_id", "text", "version", "left", "right")
    # one shuffle, by window, side and first word: who shares a word or more is together
    rows = texts.mapInArrow(tidy(beyond), BEYOND).where("length(next) > 0")
    rows = rows.repartition("key", "side", F.substring("next", 1, WORD_BYTES))
    for order in (F.asc, F.desc):
        rows = rows.sortWithinPartitions("key", "check", "side", order("next"), "doc_id").mapInArrow(tidy(shared_words), BEYOND)
    left = F.when(F.col("side") == 0, F.col("more")).otherwise(0)
    more = cut_lineage(rows.where("more > 0").select(
        "doc_id", "version", (F.col("start") - left).alias("start"), (F.col("start") + min_words + F.col("more") - left).alias("end"), "kept"))
    equal = equal.union(runs.drop("windows")).union(more).withColumn("loose", F.lit(False))

    # near copies of paragraphs: each different paragraph is one node
    close = colliding(made.where("kind = 1").select(F.explode("bands").alias("band"), F.col("key").alias("id")).withColumnRenamed("band", "key"))
    nodes = cut_lineage(close.select(F.col("a").alias("key")).union(close.select("b")).distinct())
    lines = made.where("kind = 1").select("key", "doc_id", "version", "start", "end", "short")
    lines = cut_lineage(join_bounded(lines, nodes, ["key"], "inner", 16))
    homes = lines.groupBy("key").agg(F.min(F.struct("doc_id", "version")).alias("home")).select("key", "home.doc_id", "home.version")
    wanted = cut_lineage(homes.groupBy("doc_id", "version").agg(F.collect_list("key").alias("wanted")))
    sets = join_lists(source, wanted, ["doc_id", "version"], "inner", {"wanted": 8}).select("text", "wanted").mapInArrow(tidy(to_sets), "id long, items array<long>")
    clusters = linked(sets, close, num, den).withColumnRenamed("node", "key")
    near = lines.join(clusters, "key")
    keepers = near.groupBy("component").agg(F.min("doc_id").alias("kept"))
    near = near.join(keepers, "component").where("doc_id <> kept").select("doc_id", "version", "start", "end", "kept", F.col("short").alias("loose"))

    spans = equal.union(near).groupBy("doc_id", "version").agg(F.collect_set(F.struct("start", "end", "kept", "loose")).alias("spans"))
    return cut_lineage(spans.mapInArrow(tidy(to_merged), f"doc_id long, version long, spans {SPAN}"))


def merged(spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Spans (start, end, kept) that touch become one, with the smallest kept."""
    done: list[tuple[int, int, int]] = []
    for start, end, kept in sorted(spans):
        if done and done[-1][1] >= start:
            done[-1] = (done[-1][0], max(done[-1][1], end), min(done[-1][2], kept))
        else:
            done.append((start, end, kept))
    return done


def within_borders(equal: list[tuple[int, int, int]], loose: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The loose spans without those into which an equal run reaches over one border, if the word
    past their other border stays: there the run's end is the end of what is shared."""
    runs = merged(equal)
    starts, ends = [r[0] for r in runs], [r[1] for r in runs]
    covered = merged(equal + loose)
    first = {s for s, _, _ in covered}
    last = {e for _, e, _ in covered}
    found = []
    for start, end, kept in loose:
        over = bisect_right(starts, start) - 1  # the run that may hold the word at start
        under = bisect_left(ends, end)  # the run that may hold the last word
        from_left = over >= 0 and starts[over] < start < ends[over] < end and end in last
        from_right = under < len(runs) and start < starts[under] < end < ends[under] and start in first
        if not (from_left or from_right):
            found.append((start, end, kept))
    return found


def to_merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The spans of each document, loose ones within the borders of equal runs, merged."""
    for batch in batches:
        lists = batch.column(2)
        bounds, values = lists.offsets.to_numpy().tolist(), lists.values
        start, end, kept, loose = (values.field(i).to_numpy(zero_copy_only=False).tolist() for i in range(4))
        found, sizes = [], [0]
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            equal, near = [], []
            for i in range(a, b):
                (near if loose[i] else equal).append((start[i], end[i], kept[i]))
            found += merged(equal + within_borders(equal, near) if near else equal)
            sizes.append(len(found))
        columns = zip(*found, strict=True) if found else ([], [], [])
        spans = pa.StructArray.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int32(), pa.int32(), pa.int64()), strict=True)], ["start", "end", "kept"])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), spans)], ["doc_id", "version", "spans"])


def removals(docs: DataFrame, **settings) -> DataFrame:
    """One row for each removed passage: doc_id, start_word, end_word, n_words, kept_doc_id."""
    return repeated(docs, **settings).select("doc_id", F.inline("spans")).select(
        "doc_id", F.col("start").alias("start_word"), F.col("end").alias("end_word"), (F.col("end") - F.col("start")).alias("n_words"), F.col("kept").alias("kept_doc_id"))


def without_spans(text: str, spans: list[dict]) -> str:
    """The text without the words of the spans and the white space after them."""
    words = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)] + [len(text)]
    out, at = [], 0
    for span in spans:
        out.append(text[at : words[span["start"]]])
        at = words[span["end"]]
    return "".join([*out, text[at:]])


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length_column: str | None = None, **settings) -> DataFrame:
    """docs with its columns, all rows, the repeated passages cut out of the text; the column with
    the length of the text, if named, follows."""
    spans = repeated(docs, id_column, text_column, **settings)
    names = [F.col(c) for c in docs.columns]
    rows = docs.select(F.struct(*names).alias("row"), F.col(id_column).cast("long").alias("doc_id"), F.xxhash64(text_column).alias("version"))
    rows = join_lists(rows, spans, ["doc_id", "version"], "left", {"spans": 32})

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [text if spans is None else without_spans(text, spans) for text, spans in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["row", "text"])

    kinds = rows.select("row").schema
    cut_rows = rows.select("row", F.col("row")[text_column].alias("text"), "spans").mapInArrow(tidy(cut), kinds.add("text", "string"))
    new = {text_column: F.col("text"), length_column: F.length("text").cast("long")}
    return cut_rows.select(*(new.get(c, F.col("row")[c]).alias(c) for c in docs.columns))
