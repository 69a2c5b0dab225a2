"""Near-duplicate documents: Jaccard similarity of their word shingles, exactly.

Documents with equal shingle sets are one node. Two nodes of sizes m <= n can
only be similar to degree t if m >= t * n and if they share one of the first
``n - ceil(t * n) + 1`` shingles of each in any common order. The order puts
shingles that many documents hold last, so that passages shared by many
documents link nobody.

1. One pass finds each document's node, size and bitmap, and frequent shingles.
2. One pass posts each node at its first shingles; postings met by a single node
   go away.
3. Each posting's nodes are compared with the first of them, exactly, by the
   intersection of sorted arrays. Links found so far make components.
4. Postings whose nodes still lie in several components are compared in tiles:
   one size band with itself and with the next, in blocks of bounded size. Every
   node has a bitmap, each bit the parity of the shingles that hash to it. The
   bits in which two bitmaps differ are a lower bound of the shingles in which
   the sets differ, hence an upper bound of the overlap, and rule out most pairs.
   First each node is compared, exactly as before, with the one node of another
   component that its tile's bound leaves nearest; this is repeated while it
   finds links, at most ``ROUNDS`` times. Then all pairs of different components
   that the bound does not rule out are compared.

A pair inside one component is never looked at, so a group of copies costs its
size, not its square. Shingles and sets stand as 64-bit hashes.

Defined cases: a null, empty or white text has the empty set and is linked with
nothing; a text with fewer words than a shingle is one shingle; a null key is
never a component's id unless all its keys are null; repeated rows appear each;
an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from salesops.llm.graphs import components, contracted, nearest_roots
from salesops.llm.textarrays import mix, pieces, shingle_hashes, word_hashes, words
from salesops.session import materialize, small_side

WORDS = 5
# Similarity of at least THRESHOLD percent.
THRESHOLD = 80
# Frequent shingles kept for the order; it decides how many pairs are compared, not which are found.
FREQUENT = 1 << 17
_FREQUENT_IN_TASK = 4
_COUNT_AT_ONCE = 1 << 21
# Nodes of a posting in one block of a tile, and compared with one copy of a group's first node.
BLOCK = 2_048
_BITS = (256, 1 << 16)
# Rounds in which nodes are compared with their nearest only; they spare pairs and change no result.
ROUNDS = 2


def sets_of(texts: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sorted distinct shingle hashes of each text, a piece at a time."""
    for piece in pieces(texts):
        found = words(piece)
        yield piece.first, [np.unique(x) for x in shingle_hashes(word_hashes(found), found.of_text, WORDS)]


def node_of(shingles: np.ndarray) -> np.int64:
    """64-bit name of a set."""
    return (mix(shingles).sum(dtype=np.uint64) ^ np.uint64(len(shingles))).view(np.int64)


def bitmap(shingles: np.ndarray) -> bytes:
    """Parities of the shingles per bit; some two bits a shingle."""
    bits = min(max(1 << (2 * len(shingles) - 1).bit_length(), _BITS[0]), _BITS[1])
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(held: bytes, size: int) -> np.ndarray:
    """A bitmap brought to fewer bytes: parities add up."""
    found = np.frombuffer(held, dtype=np.uint8)
    while len(found) > size:
        found = found[: len(found) // 2] ^ found[len(found) // 2 :]
    return found


def _first_shingles(size: int) -> int:
    return size - -(-size * THRESHOLD // 100) + 1


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return 100 * shared >= THRESHOLD * (len(one) + len(other) - shared)


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of kind 0: key, node, size, bitmap, hash of the text. Rows of kind 1: a shingle and in how many nodes it was met."""

    def rows(kind: int, keys: pa.Array, nodes, sizes, bitmaps, contents: pa.Array) -> pa.RecordBatch:
        columns = [pa.array([kind] * len(nodes), pa.int32()), keys, pa.array(nodes, pa.int64())]
        columns += [pa.array(sizes, pa.int64()), pa.array(bitmaps, pa.binary()), contents]
        return pa.RecordBatch.from_arrays(columns, names=["kind", "key", "node", "size", "bits", "content"])

    def frequent(held: list[np.ndarray], kind: pa.DataType) -> pa.RecordBatch:
        shingles, counts = np.unique(np.concatenate(held), return_counts=True)
        many = counts >= _FREQUENT_IN_TASK
        total = int(many.sum())
        return rows(
            1, pa.nulls(total, kind), shingles[many].view(np.int64), counts[many], pa.nulls(total, pa.binary()),
            pa.nulls(total, pa.int64()),
        )

    held: list[np.ndarray] = []
    met: set[int] = set()
    total, kind = 0, pa.int64()
    for batch in batches:
        kind = batch.schema.field(0).type
        for first, sets in sets_of(batch.column(1)):
            nodes = [node_of(x) for x in sets]
            keys, contents = (batch.column(k).slice(first, len(sets)) for k in (0, 2))
            yield rows(0, keys, nodes, [len(x) for x in sets], [bitmap(x) for x in sets], contents)
            for node, shingles in zip(nodes, sets, strict=True):
                if node not in met:
                    met.add(node)
                    held.append(shingles)
                    total += len(shingles)
        if total > _COUNT_AT_ONCE:
            yield frequent(held, kind)
            held, met, total = [], set(), 0
    if held:
        yield frequent(held, kind)


def _post(frequent: np.ndarray, counts: np.ndarray):
    """Postings (shingle, size, node) of each text's first shingles, once per node and batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            met: set[int] = set()
            for _, sets in sets_of(batch.column(0)):
                shingles, nodes, sizes = [], [], []
                for found in sets:
                    if not len(found) or (node := node_of(found)) in met:
                        continue
                    met.add(node)
                    first = _first_shingles(len(found))
                    if len(frequent):
                        place = np.minimum(np.searchsorted(frequent, found), len(frequent) - 1)
                        weight = np.where(frequent[place] == found, counts[place], 0)
                        found = found[np.argsort(weight, kind="stable")]
                    shingles.append(found[:first])
                    nodes.append(node)
                    sizes.append(len(found))
                if shingles:
                    each = [len(x) for x in shingles]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(shingles).view(np.int64)),
                            pa.array(np.repeat(np.array(sizes, dtype=np.int32), each)),
                            pa.array(np.repeat(np.array(nodes, dtype=np.int64), each)),
                        ],
                        names=["shingle", "size", "node"],
                    )

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of postings sorted by (shingle, size, node), those met by several nodes, with the first of these."""
    last: tuple[int, int, int, bool] | None = None  # the row before: shingle, size, node, whether it is out already
    lead = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        shingle, size, node = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
        if last is not None:
            shingle, size, node = (
                np.concatenate([np.array([v], dtype=a.dtype), a]) for v, a in zip(last[:3], (shingle, size, node), strict=True)
            )
        new = np.ones(len(shingle), dtype=bool)
        new[1:] = (shingle[1:] != shingle[:-1]) | (node[1:] != node[:-1])
        shingle, size, node = shingle[new], size[new], node[new]
        opens = np.ones(len(shingle), dtype=bool)
        opens[1:] = shingle[1:] != shingle[:-1]
        begin = np.flatnonzero(opens)
        run = np.cumsum(opens) - 1
        first = node[begin][run]
        out = np.zeros(len(shingle), dtype=bool)
        out[1:] = ~opens[1:]
        out[:-1] |= ~opens[1:]
        if last is not None:
            # The run may have begun in an earlier batch.
            first[run == 0] = lead
            if last[3]:
                out[0] = False
        lead = int(first[-1])
        done = bool(out[-1]) or (last is not None and len(shingle) == 1 and last[3])
        last = int(shingle[-1]), int(size[-1]), int(node[-1]), done
        if out.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[out]) for x in (shingle, size, node, first)], names=["shingle", "size", "node", "first"]
            )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a group's first node with its others. Rows: lead, part, role, node, text; sorted, the lead first."""
    lead: tuple | None = None
    held = np.zeros(0, dtype=np.uint64)
    for batch in batches:
        leads, parts, roles, nodes = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(4))
        low, high = [], []
        for first, sets in sets_of(batch.column(4)):
            for row, found in enumerate(sets, first):
                if node_of(found) != nodes[row]:
                    continue  # another text of the same key and hash
                group = (leads[row], parts[row])
                if roles[row] == 0:
                    lead, held = group, found
                elif lead == group and similar(held, found):
                    low.append(min(leads[row], nodes[row]))
                    high.append(max(leads[row], nodes[row]))
        if low:
            yield pa.RecordBatch.from_arrays([pa.array(high, pa.int64()), pa.array(low, pa.int64())], names=["high", "low"])


def _verified(texts: DataFrame, nodes: DataFrame, pairs: DataFrame, most_pairs: int) -> DataFrame:
    """Of pairs (``lead``, ``node``) those that are similar, stored as links (``high``, ``low``).

    ``most_pairs`` bounds the rows of which the pairs are the distinct ones.

    Whole texts travel: one per pair, and one per BLOCK pairs of a lead. They are
    found by key and hash, so a key that many texts share gives the one asked for.
    """
    spark = texts.sparkSession
    pairs = materialize(pairs, most_rows=most_pairs)
    rows = pairs.count()
    many = pairs.groupBy("lead").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("parts"))
    parts = pairs.join(many, "lead").select(
        "lead", F.pmod(F.xxhash64("node"), F.col("parts")).cast("long").alias("part"), F.lit(1).alias("role"), "node"
    )
    leads = many.select(
        "lead", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.lit(0).alias("role"),
        F.col("lead").alias("node"),
    )
    keys = nodes.groupBy("node").agg(F.min(F.struct("key", "content")).alias("of")).select("node", "of.key", "of.content")
    asked = small_side(
        parts.unionByName(leads).join(keys, "node").select("key", "content", "lead", "part", "role", "node"),
        most_rows=nodes.count() + 2 * rows,
    )
    own = texts.withColumnRenamed("key", "own")
    found = own.join(asked, (F.xxhash64("text") == F.col("content")) & F.col("own").eqNullSafe(F.col("key")))
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return materialize(
        found.select("lead", "part", "role", "node", "text")
        .repartition(ranges, "lead", "part")
        .sortWithinPartitions("lead", "part", "role")
        .mapInArrow(_compare, "high long, low long")
        .distinct(),
        most_rows=rows,
    )


def _band(size: Column) -> Column:
    """Similar sets lie in one band or in neighbouring ones."""
    return F.floor(F.log(size.cast("double")) / float(np.log(100 / THRESHOLD)) + 1e-9).cast("long")


def _tiled(open_postings: DataFrame) -> DataFrame:
    """Each posting in the tiles of its band: with itself (both sides), as the lower, as the upper band."""
    block = F.pmod(F.xxhash64("node"), F.col("blocks"))
    blocks = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    placed = open_postings.withColumn("band", _band(F.col("size"))).withColumn("block", block)
    tiles = F.flatten(
        F.array(
            F.transform(
                blocks,
                lambda b: F.struct(
                    F.col("band").alias("low_band"), F.lit(0).alias("kind"), F.least("block", b).alias("left"),
                    F.greatest("block", b).alias("right"), (F.col("block") <= b).alias("is_left"),
                    (F.col("block") >= b).alias("is_right"),
                ),
            ),
            F.transform(
                blocks,
                lambda b: F.struct(
                    F.col("band").alias("low_band"), F.lit(1).alias("kind"), F.col("block").alias("left"),
                    b.alias("right"), F.lit(True).alias("is_left"), F.lit(False).alias("is_right"),
                ),
            ),
            F.transform(
                blocks,
                lambda b: F.struct(
                    (F.col("band") - 1).alias("low_band"), F.lit(1).alias("kind"), b.alias("left"),
                    F.col("block").alias("right"), F.lit(False).alias("is_left"), F.lit(True).alias("is_right"),
                ),
            ),
        )
    )
    return placed.select("shingle", "size", "node", "component", F.explode(tiles).alias("t")).select(
        F.xxhash64("shingle", "t.low_band", "t.kind", "t.left", "t.right").alias("tile"),
        "t.is_left", "t.is_right", "size", "node", "component",
    )


def _open_tiles(tiles: DataFrame) -> DataFrame:
    """The tiles that have two sides and several components; of those with the same nodes one."""
    sides = tiles.groupBy("tile").agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.bool_or("is_left").alias("left"), F.bool_or("is_right").alias("right"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64("node", "is_left", "is_right").cast("decimal(38,0)")).alias("members"),
    )
    kept = sides.where("least <> most and left and right and rows > 1").groupBy("members", "rows").agg(F.min("tile").alias("tile"))
    return tiles.join(kept.select("tile"), "tile")


def _bounded(nearest: bool):
    """Pairs of a tile that their sizes, components and bitmaps do not rule out: all, or each node's nearest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        tile = None
        for batch in batches:  # sorted by tile
            columns = [batch.column(k).to_pylist() for k in range(7)]
            for row in zip(*columns, strict=True):
                if row[0] != tile:
                    yield from _tile_pairs(held, nearest)
                    held, tile = [], row[0]
                held.append(row)
        yield from _tile_pairs(held, nearest)

    return run


def _tile_pairs(rows: list[tuple], nearest: bool) -> Iterator[pa.RecordBatch]:
    left, right = [r for r in rows if r[1]], [r for r in rows if r[2]]
    if not left or not right or len({r[5] for r in rows}) < 2:
        return
    width = min(len(r[6]) for r in rows)
    bits = np.stack([folded(r[6], width) for r in right]).view(np.uint64)
    size, node, component = (np.array([r[k] for r in right], dtype=np.int64) for k in (3, 4, 5))
    pairs: set[tuple[int, int]] = set()
    for row in left:
        small, large = np.minimum(size, row[3]), np.maximum(size, row[3])
        near = np.flatnonzero((component != row[5]) & (100 * small >= THRESHOLD * large))
        if not len(near):
            continue
        apart = np.bitwise_count(bits[near] ^ folded(row[6], width).view(np.uint64)).sum(axis=1, dtype=np.int64)
        # overlap <= (sum - apart) / 2, and similar sets overlap in THRESHOLD * sum / (100 + THRESHOLD) at least.
        total = size[near] + row[3]
        possible = (100 + THRESHOLD) * (total - apart) >= 2 * THRESHOLD * total
        if nearest and possible.any():
            possible = np.arange(len(near)) == np.argmin(np.where(possible, apart / total, 2.0))
        pairs.update((min(n, row[4]), max(n, row[4])) for n in node[near[possible]].tolist())
    if pairs:
        lead, other = zip(*sorted(pairs), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(lead, pa.int64()), pa.array(other, pa.int64())], names=["lead", "node"])


def near_duplicates(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: the key, ``n_shingles``, ``component_id`` (smallest key linked to it, itself included),
    ``node``, the same for equal sets, and ``root``, the same for linked ones. The key must be an integer.
    """
    spark = rows.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = rows.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    described = materialize(
        texts.withColumn("content", F.xxhash64("text")).mapInArrow(
            _describe, "kind int, key long, node long, size long, bits binary, content long"
        )
    )
    nodes = described.where("kind = 0").select("key", "node", "size", "bits", "content")
    frequent = (
        described.where("kind = 1")
        .groupBy(F.col("node").alias("shingle"))
        .agg(F.sum("size").alias("met"))
        .orderBy(F.desc("met"), "shingle")
        .limit(FREQUENT)
        .toArrow()
    )
    shingles = frequent.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    counts = frequent.column("met").to_numpy()[order]
    postings = materialize(
        texts.select("text")
        .mapInArrow(_post(shingles[order], counts), "shingle long, size int, node long")
        .repartition(ranges, "shingle")
        .sortWithinPartitions("shingle", "size", "node")
        .mapInArrow(_shared, "shingle long, size int, node long, first long")
    )
    # Each node with the first node that it shares most postings with.
    firsts = (
        postings.where("node <> first")
        .groupBy("node", "first")
        .agg(F.count(F.lit(1)).alias("shared"))
        .groupBy("node")
        .agg(F.max(F.struct("shared", "first")).alias("best"))
        .select(F.col("best.first").alias("lead"), "node")
    )
    # While pairs are looked for, components may be known in part: then more pairs are compared, none is missed.
    links = contracted(_verified(texts, nodes, firsts, postings.count()), 2)
    for _ in range(ROUNDS):
        more = _verified(texts, nodes, *_open_pairs(postings, nodes, nearest_roots(links), nearest=True))
        if more.isEmpty():
            break
        links = contracted(links.unionByName(more), 2)
    more = _verified(texts, nodes, *_open_pairs(postings, nodes, nearest_roots(links), nearest=False))
    found = components(links.unionByName(more))
    return _labelled(nodes, found).withColumnRenamed("key", key)


def _open_pairs(postings: DataFrame, nodes: DataFrame, found: DataFrame, nearest: bool) -> tuple[DataFrame, int]:
    """Pairs of different components that share a posting and that nothing rules out, and about how many at most."""
    known = postings.join(found, F.col("node") == F.col("high"), "left").select(
        "shingle", "size", "node", F.coalesce("low", "node").alias("component")
    )
    groups = known.groupBy("shingle").agg(
        F.min("component").alias("least"), F.max("component").alias("most"), F.count(F.lit(1)).alias("rows"),
        F.sum(F.xxhash64("node").cast("decimal(38,0)")).alias("members"),
    )
    # Shingles with the same nodes are one group.
    open_groups = (
        groups.where("least <> most")
        .groupBy("members", "rows")
        .agg(F.min("shingle").alias("shingle"))
        .select("shingle", F.ceil(F.col("rows") / BLOCK).alias("blocks"))
    )
    bits = nodes.groupBy("node").agg(F.first("bits").alias("bits"))
    # The tiles are read twice, without the bitmaps first.
    stored = materialize(_tiled(known.join(open_groups, "shingle")), most_rows=2 * postings.count())
    tiles = _open_tiles(stored).join(bits, "node")
    ranges = int(postings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs = (
        tiles.select("tile", "is_left", "is_right", "size", "node", "component", "bits")
        .repartition(ranges, "tile")
        .sortWithinPartitions("tile")
        .mapInArrow(_bounded(nearest), "lead long, node long")
        .distinct()
    )
    return pairs, stored.count() * (1 if nearest else BLOCK)


def _labelled(nodes: DataFrame, found: DataFrame) -> DataFrame:
    least = nodes.groupBy("node").agg(F.min("key").alias("least_key"))
    roots = least.join(found, F.col("node") == F.col("high"), "left").select(
        "node", "least_key", F.coalesce("low", "node").alias("root")
    )
    ids = roots.groupBy("root").agg(F.min("least_key").alias("component_id"))
    named = roots.join(ids, "root").select("node", "component_id", "root")
    # The empty set is one node of many rows that are not linked.
    alone = nodes.where("size = 0").select(
        "key", F.col("size").alias("n_shingles"), F.col("key").alias("component_id"), "node", F.col("node").alias("root")
    )
    linked = (
        nodes.where("size > 0")
        .join(named, "node")
        .select("key", F.col("size").alias("n_shingles"), "component_id", "node", "root")
    )
    return linked.unionByName(alone)


def _name_sets(place: int, name: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [x for _, found in sets_of(batch.column(place)) for x in found]
            names = pa.array([node_of(x) if len(x) else None for x in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns, names], names=[*batch.schema.names, name])

    return run


def one_of_each(rows: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows, with all columns: of each component one, that of the smallest key.

    Rows without words are linked with nothing and all stay.
    """
    # Longer than any column of the rows, hence no clash.
    least, kept, named, copy = ("_" * (1 + max(map(len, rows.columns))) + n for n in ("key", "kept", "node", "copy"))
    winners = (
        near_duplicates(rows, key, text)
        .where("n_shingles > 0")
        .groupBy("root")
        .agg(F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), "node")).alias("first"))
        .select(F.col("first.key").alias(least), F.col("first.node").alias(kept))
    )
    schema = T.StructType([*rows.schema.fields, T.StructField(named, T.LongType())])
    sets = rows.mapInArrow(_name_sets(rows.columns.index(text), named), schema)
    same = F.col(f"`{key}`").cast("long").eqNullSafe(F.col(least)) & (F.col(named) == F.col(kept))
    # Rows that repeat key and text are one row; the join has brought them together.
    each = Window.partitionBy(least, kept).orderBy(least)
    first = sets.join(winners, same).withColumn(copy, F.row_number().over(each)).where(F.col(copy) == 1)
    columns = [F.col(f"`{c}`") for c in rows.columns]
    return first.select(*columns).unionByName(sets.where(F.col(named).isNull()).select(*columns))
