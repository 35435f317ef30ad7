"""Exact Jaccard join of sets: size-banded tiles, hashed bitmap signatures, exact intersection.

1. Rows with equal sets collapse into one class.
2. Candidates. Sets of a pair with Jaccard >= t differ in at most k = (1 - t) / (1 + t) * (|A| + |B|)
   elements. In each size band the elements are dealt by their hashes to k + 1 parts or more, so the
   two sets agree in at least one part whole: equal parts are found by equality of one hash. No link
   is lost, and a passage that many texts share makes no candidates, as its elements lie in many parts.
3. Sets that share a key with one hub, the smallest id of that key, meet in tiles of bounded content
   (`linked_by_hubs`). In a tile, the bits that two bitmaps have in common bound the overlap from above; pairs that pass are
   intersected exactly, unless links found before already connect them. Where keys may miss a link
   (MinHash bands), all that candidates connect meets (`linked`).
4. Verified links are connected to components.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playbill.llm.common import among, connected, join_bounded, lower_words, mix, of_size, shingles, tidy
from playbill.session import cut_lineage

BAND = 1.5  # ratio of the sizes of a band
DEALINGS = (1.0, 1.2, 1.3)  # parts of a dealing, times the least number
TILE_ITEMS = 1 << 18  # elements in a tile, about 2 MB
TILE_BITS = 1 << 28  # of the bitmaps of a tile, 32 MB
WIDE = 4  # tiles that meet as one when bitmaps are compared


def band_of(size: int) -> int:
    band = int(np.log(size) / np.log(BAND))
    while BAND ** (band + 1) <= size:
        band += 1
    while BAND**band > size:
        band -= 1
    return band


def bands_apart(num: int, den: int) -> int:
    """How far apart the bands of two sets that link may be."""
    apart = 1
    while BAND**apart * num < den:
        apart += 1
    return apart


def parts_of(band: int, num: int, den: int) -> int:
    """Number of parts in a band: one more than the most elements a pair of it may differ in. A pair
    belongs to the band of its smaller set, of x elements; the larger one has at most x * den / num,
    and of (x + x * den / num) elements at most (den - num) / (den + num) differ."""
    return int(BAND ** (band + 1) * (den - num) / num) + 1


def part_keys(items: np.ndarray, num: int, den: int) -> list[np.ndarray]:
    """One hash for each part of a sorted set, in the bands its partners may be in: its own, where it
    is the smaller one, and those below. Bands in which no two different sets can link give none.

    Keys of empty parts would bring together sets that have nothing in common. A set of s elements
    differs from a partner in at most s * (den - num) / num; if it has more parts than that with
    elements in them, one of these agrees, and empty ones are not needed. Else it is dealt again into
    more parts, up to the last dealing, where its empty parts count. Two sets that link are both
    dealt up to the first dealing that suffices for one of them, and share a key there.
    """
    size = len(items)
    found = []
    b = band_of(size)
    unsigned = items.view(np.uint64)
    values = mix(unsigned + np.uint64(0x5851F42D4C957F2D))
    while b >= 0 and size * num <= den * BAND ** (b + 1):
        least = parts_of(b, num, den)
        for deal, factor in enumerate(DEALINGS if least > 1 else ()):
            parts = int(least * factor)
            salt = np.uint64(b + 1 + 1000 * deal)
            where = (mix(unsigned ^ salt) % np.uint64(parts)).astype(np.int64)
            total = np.zeros(parts, np.uint64)
            np.add.at(total, where, values)
            filled = np.zeros(parts, bool)
            filled[where] = True
            enough = int(filled.sum()) * num > size * (den - num)
            with np.errstate(over="ignore"):
                keys = mix(total + mix(np.arange(parts, dtype=np.uint64) * np.uint64(1_000_003) + salt)).view(np.int64)
            found.append(keys if deal == len(DEALINGS) - 1 and not enough else keys[filled])
            if enough:
                break
        b -= 1
    return found


def set_digest(items: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set; (0, 0) if it is empty."""
    if not len(items):
        return 0, 0
    unsigned = items.view(np.uint64)
    return tuple(int(mix(np.add.reduce(mix(unsigned + np.uint64(salt)), keepdims=True)).view(np.int64)[0]) for salt in (1, 2))


def overlaps(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))


def links_of_tile(ids: np.ndarray, sides: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """Links with 100 * overlap >= ... that connect the sets of a tile: every pair that links is
    connected by the links returned. Sides: rows of side 1 are compared with those of the other
    sides, rows of side 2 with those of sides 0 and 2; in a tile of one side all are compared."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.argsort(sizes, kind="stable")
    ids, sides, sizes, sets = ids[order], sides[order], sizes[order], [sets[i] for i in order]
    n = len(ids)
    if n == 1:
        return []
    two = bool((sides != sides[0]).any())
    label = np.arange(n)
    if n > 2:
        # fewer bits bound the overlap less closely, but still from above
        bits = max(64, min(1 << int(2 * sizes.max() - 1).bit_length(), 1 << (max(TILE_BITS // n, 1).bit_length() - 1)))
        maps = np.zeros((n, bits // 8), np.uint8)
        for i, s in enumerate(sets):
            where = (mix(s.view(np.uint64)) % np.uint64(bits)).astype(np.int64)
            np.bitwise_or.at(maps[i], where >> 3, (1 << (where & 7)).astype(np.uint8))
        maps = maps.view(np.uint64)
        spare = sizes - np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    found = []
    for i in np.flatnonzero(sides > 0) if two else range(n - 1):
        first = int(np.searchsorted(sizes * den, sizes[i] * num, side="left")) if two else i + 1
        last = int(np.searchsorted(sizes * num, sizes[i] * den, side="right"))
        others = np.arange(first, max(first, last))
        others = others[label[others] != label[i]]
        if two:
            others = others[sides[others] != 1]
        if not len(others):
            continue
        if n > 2:
            most = np.bitwise_count(maps[i] & maps[others]).sum(axis=1, dtype=np.int64) + np.minimum(spare[i], spare[others])
            others = others[(num + den) * most >= num * (sizes[i] + sizes[others])]
        for j in others:
            if label[i] != label[j] and (num + den) * overlaps(sets[i], sets[j]) >= num * (sizes[i] + sizes[j]):
                label[label == label[j]] = label[i]
                found.append((int(ids[i]), int(ids[j])))
    return found


def tiles_to_links(tiles: DataFrame, num: int, den: int) -> DataFrame:
    """(a, b) from rows with `members`, an array of struct(id, side, items)."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = [], []
            members = batch.column(0)
            starts = members.offsets.to_numpy()
            inner = members.values
            ids, sides, items = (inner.field(i) for i in range(3))
            ids, sides = ids.to_numpy(zero_copy_only=False), sides.to_numpy(zero_copy_only=False)
            bounds, values = items.offsets.to_numpy(), items.values.to_numpy(zero_copy_only=False)
            for k in range(len(batch)):
                a, b = starts[k], starts[k + 1]
                sets = [values[bounds[i] : bounds[i + 1]] for i in range(a, b)]
                for x, y in links_of_tile(ids[a:b], sides[a:b], sets, num, den):
                    left.append(x)
                    right.append(y)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return tiles.select("members").mapInArrow(tidy(rows), "a long, b long").where("a <> b")


def linked(sets: DataFrame, candidates: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) of the sets that have a link: Jaccard * den >= num.

    `sets` has id and items (sorted distinct longs), one row for each different set of the
    candidates; `candidates` has pairs (a, b) of ids, of which the connections count: all links lie
    inside a connected group of candidates. A group that fits in one tile is done there. A larger
    one is cut into tiles by size band and hash; tiles are compared inside first, then what is not
    yet connected to the largest part of its group meets the tiles of neighbouring bands.
    """
    groups = cut_lineage(connected(candidates).selectExpr("node AS id", "component AS family"))
    sized = join_bounded(sets, groups, ["id"], "inner", 24).withColumn("n", F.size("items").cast("long"))
    sized = cut_lineage(sized.withColumn("band", F.floor(F.log("n") / F.log(F.lit(BAND)) + 1e-9).cast("int")))
    whole = sized.groupBy("family").agg(F.sum("n").alias("items_here"))
    banded = sized.groupBy("family", "band").agg(F.sum("n").alias("items_band"))
    plan = cut_lineage(banded.join(whole, "family").select(
        "family", "band",
        (F.col("items_here") > TILE_ITEMS).alias("large"),
        F.ceil(F.col("items_band") / TILE_ITEMS).cast("int").alias("slices")))
    tile = F.when(F.col("large"), F.struct("band", F.pmod(F.xxhash64("id"), F.col("slices")).cast("int").alias("slice"))).otherwise(F.struct(F.lit(-1).alias("band"), F.lit(0).alias("slice")))
    placed = join_bounded(sized, plan, ["family", "band"], "inner", 40).withColumn("tile", tile)
    members = placed.select("family", "tile", F.struct("id", F.lit(0).alias("side"), "items").alias("member"))
    first = cut_lineage(tiles_to_links(members.groupBy("family", "tile").agg(F.collect_list("member").alias("members")), num, den))

    # large families: sets outside the largest connected part meet the other tiles. Narrow rows first
    large = placed.where("large").select("id", "family", "n", "tile")
    large = cut_lineage(large.join(connected(first).selectExpr("node AS id", "component AS part"), "id", "left").withColumn("part", F.coalesce("part", "id")))
    mass = large.groupBy("family", "part").agg(F.sum("n").alias("mass"))
    largest = mass.groupBy("family").agg(F.max(F.struct("mass", "part")).alias("top"), F.count("*").alias("parts")).where("parts > 1").selectExpr("family", "top.part AS top")
    wide = F.struct(F.col("tile.band").alias("band"), F.floor(F.col("tile.slice") / WIDE).cast("int").alias("slice")).alias("tile")
    still = large.join(largest, "family").select("id", "family", "n", wide, "part", (F.col("part") != F.col("top")).alias("stray"))
    still = cut_lineage(still)
    strays = still.where("stray")
    slices = strays.groupBy("family", F.col("tile.band").alias("stray_band")).agg(F.ceil(F.sum("n") / (WIDE * TILE_ITEMS)).cast("int").alias("stray_slices"))
    near_bands = f"abs(tile.band - stray_band) <= {bands_apart(num, den)}"
    homes = still.select("id", "part", "family", "tile").join(slices, "family").where(near_bands)
    homes = homes.select("id", "part", F.lit(0).alias("side"), "family", "tile", "stray_band", F.explode(F.sequence(F.lit(0), F.col("stray_slices") - 1)).alias("stray_slice"))
    visitors = strays.select("id", "part", "family", F.col("tile.band").alias("stray_band")).join(slices, ["family", "stray_band"])
    visitors = visitors.withColumn("stray_slice", F.pmod(F.xxhash64("id", F.lit(1)), "stray_slices").cast("int"))
    visitors = visitors.join(still.select("family", "tile").distinct(), "family").where(near_bands)
    visitors = visitors.select("id", "part", F.lit(1).alias("side"), "family", "tile", "stray_band", "stray_slice")
    meeting = homes.union(visitors)
    # the bitmaps meet first: only sets whose bound leaves a link open are brought together
    place = ["family", "tile", "stray_band", "stray_slice"]
    wanted = cut_lineage(still.select("id").distinct())
    bitmaps = cut_lineage(to_bitmaps(join_bounded(sized.select("id", "items"), wanted, ["id"], "left_semi", 16)))
    meeting = bitmaps.join(meeting, "id").select(*place, F.struct("id", "part", "side", "n", "bitmap").alias("member"))
    needed = cut_lineage(open_pairs(meeting.groupBy(*place).agg(F.collect_list("member").alias("members")), place, num, den))
    meeting = join_bounded(sized.select("id", "items"), needed, ["id"], "inner", 80).select(*place, F.struct("id", "side", "items").alias("member"))
    second = tiles_to_links(meeting.groupBy(*place).agg(F.collect_list("member").alias("members")), num, den)
    return connected(first.union(second))


PLACE = ["hub", "band", "slice", "stray_band", "stray_slice"]


def linked_by_hubs(sets_of: Callable[[DataFrame], DataFrame], candidates: DataFrame, num: int, den: int) -> DataFrame:
    """(node, component) of the sets that have a link, from candidates (a, hub) as `colliding` gives
    them, where sets that link have a key in common: two of them have one hub, or one is the other's.

    So only members of a hub meet, not all that candidates connect: a passage in many texts connects
    very many that have little in common. Members meet their hub first; then those that are not yet
    connected to the largest part of the hub's members meet the others of them. Bitmaps say which
    sets may link; only their texts are read again, and no set is stored. `sets_of` gives (id, items) for ids, which may have several sets.
    """
    stars = candidates.selectExpr("a AS id", "b AS hub")
    nodes = cut_lineage(stars.select("id").union(stars.select("hub")).distinct())
    maps = cut_lineage(to_bitmaps(sets_of(nodes), 2).withColumn("in_band", F.floor(F.log("n") / F.log(F.lit(BAND)) + 1e-9).cast("int")))
    sizes = maps.select("id", "n", "in_band").distinct()
    apart = bands_apart(num, den)
    mass = F.greatest("n", F.lit(64))  # many small sets make a tile slow, however few their elements

    def links(meeting: DataFrame) -> DataFrame:
        """(a, b) from rows (id, n, part, side) with their place."""
        rows = maps.join(meeting, ["id", "n"]).select(*PLACE, F.struct("id", "part", "side", "n", "bitmap").alias("member"))
        needed = cut_lineage(open_pairs(rows.groupBy(*PLACE).agg(F.collect_list("member").alias("members")), PLACE, num, den))
        again = sets_of(cut_lineage(needed.select("id").distinct()))
        rows = again.join(needed.distinct(), "id").select(*PLACE, F.struct("id", "side", "items").alias("member"))
        return cut_lineage(tiles_to_links(rows.groupBy(*PLACE).agg(F.collect_list("member").alias("members")), num, den))

    # every member and its hub
    hubs = stars.select("hub").distinct().join(sizes.selectExpr("id AS hub", "n AS hub_n", "in_band AS hub_band"), "hub")
    members = cut_lineage(stars.join(sizes, "id").withColumn("mass", mass))
    near = members.join(hubs, "hub").where(f"abs(in_band - hub_band) <= {apart}").select(*members.columns).distinct()
    counted = near.groupBy("hub").agg(slices_of("mass").alias("slices"))
    place = [F.lit(-1).alias("band"), "slice", F.lit(-1).alias("stray_band"), F.lit(0).alias("stray_slice")]
    dealt = near.join(counted, "hub").withColumn("slice", F.pmod(F.xxhash64("id"), "slices").cast("int"))
    dealt = dealt.select("id", "n", F.col("id").alias("part"), F.lit(0).alias("side"), "hub", *place)
    calls = hubs.join(counted, "hub").withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1)))
    calls = calls.select(F.col("hub").alias("id"), F.col("hub_n").alias("n"), F.col("hub").alias("part"), F.lit(1).alias("side"), "hub", *place)
    first = links(dealt.union(calls))

    # members of a hub that are in several parts
    parts = members.join(connected(first).selectExpr("node AS id", "component AS part"), "id", "left").withColumn("part", F.coalesce("part", "id"))
    parts = cut_lineage(parts)
    largest = parts.groupBy("hub", "part").agg(F.sum("mass").alias("mass")).groupBy("hub").agg(F.max(F.struct("mass", "part")).alias("top"), F.count("*").alias("parts"), slices_of("mass").alias("slices"))
    still = parts.join(largest.where("parts > 1").selectExpr("hub", "top.part AS top", "slices AS of_hub"), "hub")
    still = cut_lineage(still.withColumn("stray", F.col("part") != F.col("top")))
    side = F.when(F.col("stray"), 2).otherwise(0)
    small = still.where("of_hub = 1").select("id", "n", "part", side.alias("side"), "hub", F.lit(-1).alias("band"), F.lit(0).alias("slice"), F.lit(-1).alias("stray_band"), F.lit(0).alias("stray_slice"))
    # those of a hub with very many meet in tiles by band
    large = still.where("of_hub > 1")
    strays = large.where("stray")
    homes = large.join(large.groupBy("hub", "in_band").agg(slices_of("mass").alias("slices")), ["hub", "in_band"])
    homes = homes.withColumn("band", F.col("in_band")).withColumn("slice", F.pmod(F.xxhash64("id"), "slices").cast("int"))
    bands = strays.groupBy("hub", F.col("in_band").alias("stray_band")).agg(slices_of("mass").alias("stray_slices"))
    close = f"abs(band - stray_band) <= {apart}"
    at_home = homes.join(bands, "hub").where(close).withColumn("stray_slice", F.explode(F.sequence(F.lit(0), F.col("stray_slices") - 1)))
    visitors = strays.withColumn("stray_band", F.col("in_band")).join(bands, ["hub", "stray_band"])
    visitors = visitors.withColumn("stray_slice", F.pmod(F.xxhash64("id", F.lit(1)), "stray_slices").cast("int"))
    visitors = visitors.join(homes.select("hub", "band", "slice").distinct(), "hub").where(close)
    meeting = small
    for rows, number in ((at_home, 0), (visitors, 1)):
        meeting = meeting.union(rows.select("id", "n", "part", F.lit(number).alias("side"), *PLACE))
    return connected(first.union(links(meeting)))


def slices_of(mass: str) -> Column:
    """How many tiles of bitmaps a group fills."""
    return F.ceil(F.sum(mass) / (WIDE * TILE_ITEMS)).cast("int")


def to_bitmaps(sets: DataFrame, bits_each: int = 8) -> DataFrame:
    """(id, n, bitmap): the elements hashed to bits, at least `bits_each` times as many bits as elements."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            maps = []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                bits = max(64, 1 << int(bits_each * (b - a) - 1).bit_length())
                where = (mix(values[a:b].view(np.uint64)) % np.uint64(bits)).astype(np.int64)
                bitmap = np.zeros(bits // 8, np.uint8)
                np.bitwise_or.at(bitmap, where >> 3, (1 << (where & 7)).astype(np.uint8))
                maps.append(bitmap.tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds).astype(np.int64)), pa.array(maps, pa.binary())], ["id", "n", "bitmap"])

    return sets.select("id", "items").mapInArrow(tidy(rows), "id long, n long, bitmap binary")


def folded(bitmaps: list[bytes], words: int, length: np.ndarray) -> np.ndarray:
    """Bitmaps of any power of two of bits, folded to `words` 64-bit words each; zeros for those that
    have fewer."""
    out = np.zeros((len(bitmaps), words), np.uint64)
    for i in np.flatnonzero(length >= words):
        out[i] = np.bitwise_or.reduce(np.frombuffer(bitmaps[i], np.uint64).reshape(-1, words), axis=0)
    return out


def open_pairs(tiles: DataFrame, place: list[str], num: int, den: int) -> DataFrame:
    """(place, id, side) of the members of a tile that may link with one of the other side and of
    another part (side 2 is on both): the bits two bitmaps share, and what collisions may hide, bound
    the overlap."""
    kinds = tiles.select(*place, F.lit(0).cast("long").alias("id"), F.lit(0).alias("side")).schema

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            members = batch.column(len(place))
            starts = members.offsets.to_numpy()
            ids, parts, sides, sizes = (members.values.field(i).to_numpy(zero_copy_only=False) for i in range(4))
            bitmaps = members.values.field(4)
            for k in range(len(batch)):
                a, b = starts[k], starts[k + 1]
                data = bitmaps[a:b].to_pylist()
                own, part, side, size = ids[a:b], parts[a:b], sides[a:b], sizes[a:b]
                length = np.array(list(map(len, data))) // 8
                maps = {words: folded(data, words, length) for words in np.unique(length).tolist()}
                spare = {words: size - np.bitwise_count(maps[words]).sum(axis=1, dtype=np.int64) for words in maps}
                home, needed = np.flatnonzero(side != 1), np.zeros(b - a, bool)
                for v in np.flatnonzero(side != 0):
                    near = home[(part[home] != part[v]) & (np.minimum(size[home], size[v]) * den >= np.maximum(size[home], size[v]) * num)]
                    shorter = np.minimum(length[near], length[v])
                    for words in np.unique(shorter).tolist():
                        others = near[shorter == words]
                        most = np.bitwise_count(maps[words][others] & maps[words][v]).sum(axis=1, dtype=np.int64) + np.minimum(spare[words][others], spare[words][v])
                        others = others[(num + den) * most >= num * (size[others] + size[v])]
                        needed[others] = True
                        needed[v] |= len(others) > 0
                found = np.flatnonzero(needed)
                if len(found):
                    same = batch.select(list(range(len(place)))).take(pa.array(np.full(len(found), k)))
                    yield pa.RecordBatch.from_arrays([*same.columns, pa.array(own[found]), pa.array(side[found].astype(np.int32))], [*place, "id", "side"])

    return tiles.select(*place, "members").mapInArrow(tidy(rows), kinds)


def near_copies(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", words: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs.

    Sets are the distinct shingles of `words` words (A-Z in lower case) of the whole text; two
    documents link if den * |A and B| >= num * |A or B|. component_id is the smallest id reachable by
    links. A text with fewer words is one shingle; NULL and empty texts have none and link with
    nothing. Rows with a NULL id keep a NULL component and link with nothing; rows with the same id
    are one node. Copies of a text collapse into one class before anything is compared. An empty
    table gives no rows.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    source = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("binary").alias("text"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in of_size(batches, 1, 256, 4 << 20):
            sizes, first, second = [], [], []
            for text in batch.column(1).to_pylist():
                items = shingles(lower_words(text), words)
                h, g = set_digest(items)
                sizes.append(len(items))
                first.append(h)
                second.append(g)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, pa.int64()) for x in (sizes, first, second))], ["doc_id", "n_shingles", "h", "g"])

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                keys, owners = [], []
                for owner, text in zip(batch.column(0)[a : a + 256].to_pylist(), batch.column(1)[a : a + 256].to_pylist(), strict=True):
                    items = shingles(lower_words(text), words)
                    for found in part_keys(items, num, den) if len(items) else ():
                        keys.append(found)
                        owners.append(np.full(len(found), owner, np.int64))
                if keys:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(owners))], ["key", "id"])

    def to_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, len(batch), 256):
                part = batch.slice(a, 256)
                sets = [shingles(lower_words(text), words) for text in part.column(1).to_pylist()]
                offsets = np.cumsum([0, *map(len, sets)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(sets)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], ["id", "items"])

    measured = cut_lineage(source.mapInArrow(tidy(measure), f"doc_id {kind}, n_shingles long, h long, g long"))
    classes = measured.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("h", "g", "n_shingles").agg(F.min("doc_id").alias("rep"))
    classes = cut_lineage(classes)
    def sets_of(ids: DataFrame) -> DataFrame:
        return join_bounded(source, ids.select(F.col("id").alias("doc_id")), ["doc_id"], "left_semi", 16).mapInArrow(tidy(to_sets), "id long, items array<long>").where("size(items) > 0")

    reps = cut_lineage(classes.select(F.col("rep").alias("doc_id")).distinct())
    others = cut_lineage(measured.where("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id").distinct().join(reps, "doc_id", "left_anti"))
    rep_texts = among(source.where("doc_id IS NOT NULL"), ["doc_id"], reps, others)
    links = colliding(rep_texts.mapInArrow(tidy(postings), "key long, id long"))
    found = linked_by_hubs(sets_of, links, num, den)
    labelled = classes.join(found, F.col("rep") == F.col("node"), "left").select("h", "g", "n_shingles", F.coalesce("component", "rep").alias("component"))
    return measured.join(labelled, ["h", "g", "n_shingles"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, id_column: str = "doc_id", **settings) -> DataFrame:
    """The rows of docs, all their columns, with one document of each group of near copies: the one
    with the smallest id. Of rows that repeat an id one stays, the least by text; rows with a NULL id stay."""
    found = near_copies(docs, id_column, **settings).where(F.col("doc_id").isNotNull())
    ids = cut_lineage(found.groupBy(F.col("doc_id").alias(id_column)).agg(F.count_if(F.col("doc_id") == F.col("component_id")).alias("_times")))
    named = docs.where(F.col(id_column).isNotNull())
    rows = among(named, [id_column], ids.where("_times > 0").select(id_column), ids.where("_times = 0").select(id_column), 24)
    often = ids.where("_times > 1").select(id_column)
    if often.isEmpty():
        return rows.select(*docs.columns).unionByName(docs.where(F.col(id_column).isNull()))
    single = join_bounded(rows, often, [id_column], "left_anti", 24).select(*docs.columns)
    # rows of a repeated id: pre-aggregated in every task, so an id with very many rows is one row a task
    several = join_bounded(named, often, [id_column], "left_semi", 24).groupBy(id_column).agg(F.min(F.struct(*docs.columns)).alias("row")).select(*(F.col("row")[c].alias(c) for c in docs.columns))
    return single.unionByName(several).unionByName(docs.where(F.col(id_column).isNull()))


def colliding(keyed: DataFrame) -> DataFrame:
    """Distinct (a, b): b the smallest id with the same key. The postings (key, id) are sorted by
    key in their partitions and read as a stream, so a key with very many ids takes no memory."""

    def edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last_key, last_hub = None, 0
        for batch in batches:
            keys, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(keys):
                continue
            fresh = np.ones(len(keys), bool)
            fresh[1:] = keys[1:] != keys[:-1]
            fresh[0] = last_key is None or keys[0] != last_key
            at = np.maximum.accumulate(np.where(fresh, np.arange(len(keys)), -1))
            hubs = np.where(at >= 0, ids[np.maximum(at, 0)], last_hub)
            last_key, last_hub = keys[-1], hubs[-1]
            keep = ids != hubs
            pairs = np.unique(np.stack([ids[keep], hubs[keep]], axis=1), axis=0) if keep.any() else np.empty((0, 2), np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(pairs[:, 0])), pa.array(np.ascontiguousarray(pairs[:, 1]))], ["a", "b"])

    sorted_ = keyed.repartition("key").sortWithinPartitions("key", "id")
    return cut_lineage(sorted_.mapInArrow(tidy(edges), "a long, b long").distinct())
