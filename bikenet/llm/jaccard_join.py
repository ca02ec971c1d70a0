"""Texts of similar shingle sets: count-vector R-trees, then exact verification.

**Points.** The shingles of a text are hashed into ``GROUPS`` groups; the group counts are the
text's point. Two sets share at most the sum of the coordinate minima of their points, and a node
of the R-tree (:mod:`rtree`) bounds every point below it in the same way.

**Tiles.** One tree over a whole corpus could live on one machine only, so the points are dealt out,
each share with a tree of its own. Sets of similarity t or more share one of the first
``n - ceil(t n) + 1`` shingles of each in any order common to all. A text is posted to the tile
of each of these, rarest first: shingles that a sample of the texts shows to be frequent come
last. The order decides the work, never the result. A tile with one member is done.

**Homes.** Texts of equal sets are one node from the start. The member of a tile that is posted to most shared
tiles leads it, and a node's home is the leader of most of its tiles: of a group of near copies the text that
they were made from, as a rule. Nodes of one home are searched together, first by their points alone, then
those with a possible partner again with their sets: pairs are verified where they are found, and only the
links that unite two parts go on, fewer than the home has members. Large homes are searched in pairs of bounded segments:
nothing is capped.

**Open tiles.** What is left are pairs of different homes. Tiles whose members are of several homes and
several components are searched by trees as well, one tile of those with the same members. Pairs that
survive their bound are verified on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bikenet.llm.components import components
from bikenet.llm.rtree import CountTree
from bikenet.llm.shingles import column_shingles, long_lists, set_digest
from bikenet.llm.store import Tables
from bikenet.llm.worker_memory import frugal

GROUPS = 256
#: Texts of so many shingles have a point of ``FINE`` groups; modulo ``GROUPS`` they make the others'.
#: The larger the sets, the more groups it takes to tell strangers apart.
FINE_FROM, FINE = 1000, 2048
NUMERATOR, DENOMINATOR = 80, 100

#: One text in so many is read to learn which shingles are frequent.
SAMPLE_ONE_IN = 32
#: A shingle is frequent if so many sampled texts hold it.
FREQUENT_FROM = 4
#: At most so many frequent shingles are sent to the tasks (8 bytes each).
FREQUENT_MOST = 1 << 16
#: Ids of texts to be read again are sent to all tasks up to so many (about 50 bytes each); beyond
#: that, texts and ids are shuffled.
BROADCAST_ROWS = 1 << 20
#: Rows, and shingles of all sets, that one task searches at once; larger tiles and homes are searched in pairs
#: of segments.
SEGMENT_ROWS = 2048
SEGMENT_SHINGLES = 1 << 21

_SLOTS = 1 << 22


def _slots(frequent: np.ndarray) -> np.ndarray:
    table = np.zeros(_SLOTS, dtype=bool)
    table[frequent & np.uint64(_SLOTS - 1)] = True
    return table


def frequent_shingles(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Hashes of shingles that many texts of a sample hold; at most ``FREQUENT_MOST``."""
    def sampled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: set[bytes] = set()
            for hashes in column_shingles(batch.column(0)):
                digest = set_digest(hashes)
                if digest not in seen:
                    seen.add(digest)
                    yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64))], ["shingle"])

    rows = (
        docs.select(F.col(text).alias("text"))
        .filter(F.pmod(F.xxhash64("text"), F.lit(SAMPLE_ONE_IN)) == 0)
        .mapInArrow(frugal(sampled), "shingle bigint")
        .groupBy("shingle").count().filter(F.col("count") >= FREQUENT_FROM)
        .orderBy(F.desc("count"), "shingle").limit(FREQUENT_MOST)
        .collect()
    )
    return np.array([r["shingle"] for r in rows], dtype=np.int64).view(np.uint64)


def _described(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(id, digest, n_shingles, counts, post): each text's point, and the tiles it is posted to."""
    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = _slots(frequent)
        for batch in batches:
            digests, sizes, points, posts, done = [], [], [], [], 0
            for hashes in column_shingles(batch.column(2)):
                n = len(hashes)
                first = n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1 if n else 0
                late = slots[hashes & np.uint64(_SLOTS - 1)]
                early = hashes[~late][:first]
                posts.append(np.concatenate((early, hashes[late][: first - len(early)])))
                sizes.append(n)
                points.append(np.bincount(
                    (hashes >> np.uint64(40)) % np.uint64(FINE if n >= FINE_FROM else GROUPS),
                    minlength=FINE if n >= FINE_FROM else GROUPS))
                digests.append(set_digest(hashes))
                if len(sizes) == 1000:
                    yield packed(batch.slice(done, 1000), digests, sizes, points, posts)
                    digests, sizes, points, posts, done = [], [], [], [], done + 1000
            yield packed(batch.slice(done), digests, sizes, points, posts)

    def packed(batch, digests, sizes, points, posts) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array([_packed(p) for p in points], pa.binary()), long_lists(posts)],
            ["id", "text_hash", "digest", "n_shingles", "counts", "post"],
        )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", F.xxhash64("text"), "text").mapInArrow(
        frugal(describe), f"id {kind}, text_hash bigint, digest binary, n_shingles bigint, counts binary, post array<bigint>")


def _packed(point: np.ndarray) -> bytes:
    """Counts as single bytes where they fit, else as two."""
    return point.astype(np.uint8 if point.max(initial=0) < 256 else "<u2").tobytes()


def shared_tiles(posts: DataFrame) -> DataFrame:
    """(tile, node) for tiles of two nodes or more. Rows stream; no tile is held whole."""
    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, node = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        opened: int | None = None  # tile whose rows went out already

        def out(tiles, nodes) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(tiles), pa.array(nodes)], ["tile", "node"])

        for batch in batches:
            tile = np.concatenate((tile, batch.column(0).to_numpy()))
            node = np.concatenate((node, batch.column(1).to_numpy()))
            if len(tile) < 2:
                continue
            fresh = np.concatenate(([True], tile[1:] != tile[:-1]))
            shared = ~fresh
            shared[:-1] |= ~fresh[1:]
            if opened is not None and opened == tile[0]:
                shared[tile == opened] = True
            # the last row waits for the next batch: only then it is known to be alone or not
            send = np.flatnonzero(shared[:-1])
            if len(send):
                yield out(tile[send], node[send])
            opened = int(tile[-1]) if shared[-1] else None
            tile, node = tile[-1:], node[-1:]
        if opened is not None and len(tile):
            yield out(tile, node)

    return posts.sortWithinPartitions("tile").mapInArrow(frugal(runs), "tile bigint, node bigint")


def homes(tiles: DataFrame) -> DataFrame:
    """(node, home): the leader of most of the node's tiles, of equally many the least."""
    reach = tiles.groupBy("node").agg(F.count("*").alias("reach"))
    leaders = tiles.join(reach, "node").groupBy("tile").agg(
        F.max_by("node", F.struct("reach", -F.col("node"))).alias("home"))
    shared = tiles.join(leaders, "tile").groupBy("node", "home").count()
    return shared.groupBy("node").agg(F.max_by("home", F.struct("count", -F.col("home"))).alias("home"))


def _sets(docs: DataFrame, points: DataFrame) -> DataFrame:
    """(node, shingles) of the nodes of ``points``, from one text of each."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, nodes = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for i, hashes in enumerate(column_shingles(batch.column(0))):
                if set_digest(hashes) == digests[i]:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([nodes[i]], pa.int64()), long_lists([hashes])], ["node", "shingles"])

    wanted = points.select(F.col("id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"), "digest", "node")
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    # rows without an id are told apart by their texts
    same = docs["id"].eqNullSafe(wanted["wanted_id"]) & (F.xxhash64(docs["text"]) == wanted["wanted_hash"])
    return (
        docs.join(wanted, same).select("text", "digest", "node")
        .mapInArrow(frugal(build), "node bigint, shingles array<bigint>").dropDuplicates(["node"])
    )


class _Points:
    """Points of many texts. All have ``GROUPS`` coordinates; large ones their fine form as well."""

    def __init__(self, column: pa.Array | pa.ChunkedArray):
        stated = column.to_pylist()
        length = np.array([len(p) for p in stated], dtype=np.int64)
        large = length >= FINE
        self.coarse = np.zeros((len(stated), GROUPS), dtype=np.int32)
        self.fine_row = np.where(large, np.cumsum(large) - 1, -1)
        self.fine = np.zeros((int(large.sum()), FINE), dtype=np.uint16)
        for groups, target in ((GROUPS, self.coarse), (FINE, self.fine)):
            for size, kind in ((groups, np.uint8), (2 * groups, "<u2")):
                rows = np.flatnonzero(length == size)
                if len(rows):
                    into = self.fine_row[rows] if groups == FINE else rows
                    target[into] = np.frombuffer(b"".join(stated[k] for k in rows), kind).reshape(-1, groups)
        self.coarse[large] = self.fine.reshape(-1, FINE // GROUPS, GROUPS).sum(axis=1)

    def overlaps(self, rows: np.ndarray, other: _Points, others: np.ndarray) -> np.ndarray:
        """Bounds of the overlaps of pairs; ``rows`` and ``others`` are as long as each other."""
        most = np.minimum(self.coarse[rows], other.coarse[others]).sum(axis=1, dtype=np.int64)
        both = np.flatnonzero((self.fine_row[rows] >= 0) & (other.fine_row[others] >= 0))
        if len(both):
            a, b = self.fine[self.fine_row[rows[both]]], other.fine[other.fine_row[others[both]]]
            most[both] = np.minimum(a, b).sum(axis=1, dtype=np.int64)
        return most


def _enough(most: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether overlaps so large leave room for the similarity; ``sizes`` are those of both sets."""
    return most * (NUMERATOR + DENOMINATOR) >= NUMERATOR * sizes


def verified(pairs: DataFrame, points: DataFrame, docs: DataFrame, tables: Tables) -> DataFrame:
    """The written pairs (a, b) whose whole sets reach the similarity."""
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    sets = tables.write("sets", _sets(docs, points.join(nodes, "node", "left_semi")))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_set"))

    common = F.size(F.array_intersect("a_set", "b_set"))
    union = F.size("a_set") + F.size("b_set") - common
    return (
        pairs.join(side("a"), "a").join(side("b"), "b")
        .filter(DENOMINATOR * common >= NUMERATOR * union).select("a", "b")
    )


def _segments(members: DataFrame, carried: list[str]) -> DataFrame:
    """Rows of ``(tile, members, weight, node, ...)`` dealt to pairs ``(tile, i, j)`` of segments."""
    parts = F.greatest(F.ceil(F.col("members") / SEGMENT_ROWS), F.ceil(F.col("weight") / SEGMENT_SHINGLES), F.lit(1))
    return (
        members.withColumn("parts", parts.cast("int"))
        .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, parts - 1)")))
        .select("tile", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "part", *carried)
        .repartition("tile", "i", "j").sortWithinPartitions("tile", "i", "j")
    )


def _whole_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables that hold whole blocks of one ``(tile, i, j)``, with the places where each begins, and the end."""
    kept: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = [batch.column(c).to_numpy() for c in ("tile", "i", "j")]
        fresh = np.concatenate(([False], np.any([k[1:] != k[:-1] for k in key], axis=0)))
        fresh[0] = last is not None and last != tuple(k[0] for k in key)
        begins = np.flatnonzero(fresh)
        if len(begins):
            yield _with_begins([*kept, batch.slice(0, int(begins[-1]))])
            kept = [batch.slice(int(begins[-1]))]
        else:
            kept.append(batch)
        last = tuple(k[-1] for k in key)
    if kept:
        yield _with_begins(kept)


def _with_begins(batches: list[pa.RecordBatch]) -> tuple[pa.Table, np.ndarray]:
    table = pa.Table.from_batches(batches).combine_chunks()
    key = [table.column(c).to_numpy() for c in ("tile", "i", "j")]
    fresh = np.any([k[1:] != k[:-1] for k in key], axis=0)
    return table, np.concatenate(([0], np.flatnonzero(fresh) + 1, [table.num_rows]))


class _Search:
    """The trees of a table of whole blocks."""

    def __init__(self, table: pa.Table):
        self.points = _Points(table.column("counts"))
        self.node, self.size, self.part, self.i, self.j = (
            table.column(c).to_numpy() for c in ("node", "n_shingles", "part", "i", "j"))

    def partners(self, low: int, high: int, first: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """For each row asked the rows that it may be similar to, and the bounds of the overlaps; each pair once."""
        across = self.i[low] != self.j[low]
        rows = np.arange(low, high)
        tree_rows, asked = rows[self.part[low:high] == self.j[low]], rows[self.part[low:high] == self.i[low]]
        if not len(tree_rows):
            return
        if first is not None:
            asked = asked[np.argsort(self.node[asked] != first, kind="stable")]
        tree = CountTree(self.points.coarse[tree_rows], self.size[tree_rows])
        place = np.full(high - low, -1)
        place[asked - low] = np.arange(len(asked))
        for row in asked:
            hits = tree_rows[tree.search(self.points.coarse[row], self.size[row], NUMERATOR, DENOMINATOR)]
            if not across:
                hits = hits[place[hits - low] > place[row - low]]
            most = self.points.overlaps(np.full(len(hits), row), self.points, hits)
            enough = _enough(most, self.size[hits] + self.size[row])
            if enough.any():
                yield row, hits[enough], most[enough]


def _possible(members: DataFrame) -> DataFrame:
    """The nodes with a possible partner in their home, by the points alone."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _whole_blocks(batches):
            trees, found = _Search(table), np.zeros(table.num_rows, dtype=bool)
            for low, high in zip(begins[:-1], begins[1:]):
                for row, hits, _ in trees.partners(low, high):
                    found[row] = found[hits] = True
            yield pa.RecordBatch.from_arrays([pa.array(trees.node[found])], ["node"])

    return _segments(members, ["node", "n_shingles", "counts"]).mapInArrow(frugal(search), "node bigint").distinct()


def _links(members: DataFrame) -> DataFrame:
    """Links (a, b) of similar nodes of one home, enough to join all that are joined within it."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _whole_blocks(batches):
            trees, left, right = _Search(table), [], []
            tile = table.column("tile").to_numpy()
            lists = table.column("shingles").combine_chunks()
            offsets, hashes = lists.offsets.to_numpy(), lists.values.to_numpy()
            for low, high in zip(begins[:-1], begins[1:]):
                first = offsets[low]
                known, local = np.unique(hashes[first : offsets[high]], return_inverse=True)
                held = np.zeros(len(known), dtype=bool)
                group = np.arange(low, high)  # part of the home that each row is joined to
                for row, hits, most in trees.partners(low, high, int(tile[low])):
                    hits = hits[group[hits - low] != group[row - low]]
                    if not len(hits):
                        continue
                    own = local[offsets[row] - first : offsets[row + 1] - first]
                    held[own] = True
                    lengths = offsets[hits + 1] - offsets[hits]
                    ends = np.cumsum(lengths)
                    place = np.repeat(offsets[hits] - first - ends + lengths, lengths) + np.arange(ends[-1])
                    common = np.add.reduceat(held[local[place]], ends - lengths, dtype=np.int64)
                    held[own] = False
                    similar = DENOMINATOR * common >= NUMERATOR * (len(own) + lengths - common)
                    for hit in hits[similar]:
                        if group[hit - low] != group[row - low]:
                            group[group == group[hit - low]] = group[row - low]
                            left.append(trees.node[row])
                            right.append(trees.node[hit])
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])

    return _segments(members, ["node", "n_shingles", "counts", "shingles"]).mapInArrow(frugal(search), "a bigint, b bigint")


def _across_homes(members: DataFrame) -> DataFrame:
    """Pairs (a, b) of different homes and components in one tile whose points leave room for the similarity."""
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, begins in _whole_blocks(batches):
            trees, pairs = _Search(table), []
            label, home = (table.column(c).to_numpy() for c in ("label", "home"))
            for low, high in zip(begins[:-1], begins[1:]):
                for row, hits, _ in trees.partners(low, high):
                    hits = hits[(label[hits] != label[row]) & (home[hits] != home[row])]
                    if len(hits):
                        other = np.full(len(hits), trees.node[row])
                        pairs.append(np.stack([np.minimum(trees.node[hits], other), np.maximum(trees.node[hits], other)]))
            if pairs:
                a, b = np.unique(np.concatenate(pairs, axis=1), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    carried = ["node", "label", "home", "n_shingles", "counts"]
    return _segments(members, carried).mapInArrow(frugal(search), "a bigint, b bigint").distinct()


def _by_home(points: DataFrame, columns: list[str]) -> DataFrame:
    """Homes of two members or more as tiles: their rows, members and shingles."""
    sizes = points.groupBy("home").agg(F.count("*").alias("members"), F.sum("n_shingles").alias("weight"))
    return points.join(sizes.filter("members > 1"), "home").select(
        F.col("home").alias("tile"), "members", "weight", *columns)


def similar_texts(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable by links; a text without words (null, empty or
    white space) is linked with nothing and keeps its own id. Rows of equal text are one node, so
    repeated rows change nothing. A null id stays null in its row and is no component's smallest
    while the component has another. An empty table gives an empty result.
    """
    docs = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    tables = Tables(docs.sparkSession, "jaccard")
    rows = tables.write(
        "texts", _described(docs, frequent_shingles(docs)).withColumn("row", F.monotonically_increasing_id()))
    classes = tables.write(
        "classes", rows.filter("n_shingles > 0").groupBy("digest")
        .agg(F.min("row").alias("node"), F.min("id").alias("least_id")))
    posts = (
        rows.join(classes.select(F.col("node").alias("row")), "row", "left_semi")
        .select(F.explode("post").alias("tile"), F.col("row").alias("node"))
        .repartition("tile")
    )
    tiles = tables.write("tiles", shared_tiles(posts))
    points = tables.write(
        "points", rows.withColumnRenamed("row", "node").join(homes(tiles), "node")
        .select("node", "home", "id", "text_hash", "digest", "n_shingles", "counts"))

    carried = ["node", "n_shingles", "counts"]
    possible = tables.write("possible", points.join(_possible(_by_home(points, carried)), "node", "left_semi"))
    sets = tables.write("home-sets", _sets(docs, possible))
    within = tables.write("links", _links(_by_home(possible.join(sets, "node"), [*carried, "shingles"])))
    tables.drop("possible", "home-sets")
    labels = components(within, tables)

    labelled = tables.write(
        "labelled", points.select("node", "home", "n_shingles", "counts").join(labels, "node", "left")
        .withColumn("label", F.coalesce("label", "node")))
    sides = tiles.join(labelled.select("node", "label", "home", "n_shingles"), "node")
    open_tiles = (
        sides.groupBy("tile").agg(
            F.min("label").alias("low"), F.max("label").alias("high"), F.count("*").alias("members"),
            F.min("home").alias("one"), F.max("home").alias("another"), F.sum("n_shingles").alias("weight"),
            F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y"))
        .filter("low < high AND one < another").groupBy("members", "weight", "x", "y").agg(F.min("tile").alias("tile"))
        .select("tile", "members", F.lit(0).alias("weight"))
    )
    members = tiles.join(open_tiles, "tile").join(labelled, "node")
    pairs = tables.write("pairs", _across_homes(members))
    links = tables.write("links-across", verified(pairs, points, docs, tables))
    tables.drop("tiles", "points", "labelled", "pairs", "sets")
    final = components(within.union(links), tables)
    grouped = classes.join(final, "node", "left").withColumn("label", F.coalesce("label", "node"))
    least = grouped.groupBy("label").agg(F.min("least_id").alias("component_id"))
    of_class = grouped.join(least, "label").select("digest", "component_id")
    return (
        rows.join(of_class, "digest", "left")
        .select("id", "n_shingles",
                F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))
        .withColumnRenamed("id", id_column)
    )
