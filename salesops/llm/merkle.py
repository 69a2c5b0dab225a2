"""Merkle manifest of a table: a digest per row, a tree of digests per group, one tree over the groups.

A row's leaf is the SHA-256 of its columns, computed by Spark. The leaves of a
group stand in a given order; every ``FAN`` consecutive nodes (the last run may be
shorter, down to one) become the digest of their digests' hex texts, end to end,
until one node remains, the group's subroot. The subroots, in order of their
groups, become the root in the same way.

A parent hashes its children one after the other and keeps a copy of the hash
state from before each child's slot (``Parent``). Folding a replaced child resumes
that copy with the replacement and the siblings to its right only; what is to its
left is in the state.

Trees are built in blocks of ``FAN ** HEIGHT`` neighbouring nodes, a block in one
task, so that no task sees a whole group: blocks of leaves give the nodes of the
next stage, and so on. On the way back each stage's blocks get the path of their
top node to the root and hand their nodes their own paths. A path is its levels,
lowest first, each the siblings to the left and to the right.

Defined cases: a null column is the mark ``-`` and differs from an empty text; a
null group is a group of its own and comes first; null keys come before others;
repeated rows are leaves each, at neighbouring places (equal ones are
interchangeable); a null replacement means that the leaf stays; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from salesops.operators.ordering import number_within
from salesops.session import materialize, small_side

FAN = 8
# Levels that one task builds at once.
HEIGHT = 3
BLOCK = FAN**HEIGHT
# Rows that a task passes on at once.
_OUT_ROWS = 2048


def leaf(columns: Iterable[Column]) -> Column:
    """Hex digest of a row: each value as its UTF-8 byte count, a colon and its text, or ``-`` if it is null."""
    parts = []
    for column in columns:
        value = column.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def group_name(group: Column) -> Column:
    """A group as a text that is never null; null comes first, others in the order of their bytes."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


class Parent:
    """A node over a run of children, with the hash states from before each child's slot."""

    def __init__(self, children: list[str]) -> None:
        self.children = children
        self.states = []
        state = sha256()
        for child in children:
            self.states.append(state.copy())
            state.update(child.encode())
        self.digest = state.hexdigest()

    def siblings(self, slot: int) -> tuple[str, str]:
        """What stands to the left and to the right of a child."""
        return "".join(self.children[:slot]), "".join(self.children[slot + 1 :])


class Step:
    """A level of a path: the parent's state before the slot, and the siblings."""

    def __init__(self, state, left: str, right: str) -> None:
        self.state, self.left, self.right = state, left, right
        self.after = right.encode()

    def fold(self, replacement: str) -> str:
        """The parent's digest with another child in the slot."""
        state = self.state.copy()
        state.update(replacement.encode())
        state.update(self.after)
        return state.hexdigest()


def read_path(path: str) -> list[Step]:
    steps = []
    for level in path.split(";") if path else ():
        left, right = level.split(",")
        steps.append(Step(sha256(left.encode()), left, right))
    return steps


def levels(nodes: list[str], height: int | None) -> list[list[Parent]]:
    """The parents above the nodes, level by level: so many levels, or until one node remains."""
    found: list[list[Parent]] = []
    while len(found) < height if height is not None else len(nodes) > 1:
        found.append([Parent(nodes[k : k + FAN]) for k in range(0, len(nodes), FAN)])
        nodes = [p.digest for p in found[-1]]
    return found


def _height(size: int) -> int | None:
    """A block that is a whole tree grows to its top, another by a full ``HEIGHT``."""
    return None if size <= BLOCK else HEIGHT


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Runs of rows with the same first two columns, which are next to each other."""
    key, held = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != key:
                if held:
                    yield key, held
                key, held = row[:2], []
            held.append(row[2:])
    if held:
        yield key, held


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == _OUT_ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held, strict=True), schema.types, strict=True)], schema=schema)


def _lift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The top node of each block."""

    def tops() -> Iterator[tuple]:
        for (tree, block), rows in _blocks(batches):
            nodes = [digest for _, digest, _ in rows]
            above = levels(nodes, _height(rows[0][2]))
            yield tree, block, above[-1][0].digest if above else nodes[0], -(-rows[0][2] // BLOCK)

    yield from _batches(tops(), pa.schema([("tree", pa.string()), ("position", pa.int64()), ("digest", pa.string()), ("size", pa.int64())]))


def _together(nodes: DataFrame) -> DataFrame:
    """Rows with the columns ``tree``, ``position`` and others, each block in one task and in order."""
    in_block = nodes.select("tree", F.floor(F.col("position") / BLOCK).alias("block"), *nodes.columns[1:])
    return in_block.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def build(nodes: DataFrame) -> list[DataFrame]:
    """All stages of trees (tree, position, digest, size); the last has one node per tree."""
    stages = [nodes.select("tree", "position", "digest", "size")]
    while (stages[-1].agg(F.max("size")).first()[0] or 0) > 1:
        stages.append(materialize(_together(stages[-1]).mapInArrow(_lift, "tree string, position long, digest string, size long")))
    return stages


def _descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The path of each node, from those of the blocks' tops (rows at place -1 of a block)."""

    def paths() -> Iterator[tuple]:
        for (tree, _), rows in _blocks(batches):
            upper, rows = rows[0], rows[1:]
            above = levels([r[1] for r in rows], _height(rows[0][2]))
            for k, (position, *_rest) in enumerate(rows):
                steps, at = [], k
                for parents in above:
                    at, slot = divmod(at, FAN)
                    steps.append(",".join(parents[at].siblings(slot)))
                yield tree, position, ";".join([*steps, *([upper[3]] if upper[3] else [])]), upper[4]

    yield from _batches(paths(), pa.schema([("tree", pa.string()), ("position", pa.int64()), ("path", pa.string()), ("subroot", pa.string())]))


def _with_paths(nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes and, ahead of each block, the path of its top; columns a node lacks are null, and the other way round."""
    tops = paths.select(
        "tree", (F.col("position") * BLOCK).alias("position"), F.lit(-1).cast("long").alias("place"), "path", "subroot"
    )
    both = nodes.withColumn("place", F.col("position")).unionByName(tops, allowMissingColumns=True)
    in_block = both.withColumn("block", F.floor(F.col("position") / BLOCK))
    return in_block.repartition("tree", "block").sortWithinPartitions("tree", "block", "place")


def paths_down(stages: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Paths of the nodes of the second stage (or of the only one), from those of the trees' last nodes."""
    for nodes in reversed(stages[1:-1]):
        both = _with_paths(nodes, tops).select("tree", "block", "place", "digest", "size", "path", "subroot")
        tops = materialize(both.mapInArrow(_descend, "tree string, position long, path string, subroot string"))
    return tops


def _prove(kind: pa.DataType):
    schema = pa.schema(
        [("key", kind), *((c, pa.string()) for c in ("leaf", "subroot", "proof", "folded_root"))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def proofs() -> Iterator[tuple]:
            for _, rows in _blocks(batches):
                upper, rows = rows[0], rows[1:]
                above = levels([r[1] for r in rows], _height(rows[0][2]))
                steps = read_path(upper[3])
                # What each node needs from itself up: its siblings' digests, and the steps that fold it.
                proofs, folds = ["".join(s.left + s.right for s in steps)], [steps]
                for parents in reversed(above):
                    ways = [
                        (Step(p.states[slot], *p.siblings(slot)), proofs[k], folds[k])
                        for k, p in enumerate(parents)
                        for slot in range(len(p.children))
                    ]
                    proofs = [step.left + step.right + proof for step, proof, _ in ways]
                    folds = [[step, *way] for step, _, way in ways]
                for row, proof, way in zip(rows, proofs, folds, strict=True):
                    digest = row[6] if row[6] is not None else row[1]
                    for step in way:
                        digest = step.fold(digest)
                    yield row[5], row[1], upper[4], proof, digest

        yield from _batches(proofs(), schema)

    return run


def manifest(rows: DataFrame, key: str, group: Column, digest: Column, replacement: Column | None = None) -> DataFrame:
    """Per row: the key, ``leaf``, ``subroot``, ``root``, ``proof`` and ``folded_root``.

    Leaves (``digest``) of a ``group`` ascend by the key, equal keys by their leaf.
    ``proof`` is the digests of the siblings, level by level from the leaf to the
    root and left to right, end to end. ``folded_root`` is the root as it follows
    from the proof and the ``replacement`` of the leaf, or the leaf where that is null.
    The rows are read once; after that only digests are shuffled, whose number per
    task is bounded, however large a group is. Runs jobs at once.
    """
    changed = F.lit(None).cast("string") if replacement is None else replacement
    leaves = materialize(
        rows.select(
            F.col(f"`{key}`").alias("key"), group_name(group).alias("tree"), digest.alias("digest"),
            changed.alias("replacement"), F.monotonically_increasing_id().alias("row"),
        )
    )
    # The row's number only tells equal leaves apart, so that they spread over ranges.
    order = [F.col("key").asc_nulls_first(), F.col("digest"), F.col("row")]
    sizes = small_side(leaves.groupBy(F.col("tree").alias("_tree")).agg(F.count(F.lit(1)).alias("size")))
    nodes = (
        number_within(leaves, "tree", order)
        .join(sizes, F.col("tree") == F.col("_tree"))
        .select("tree", (F.col("position") - 1).alias("position"), "digest", "size", "key", "replacement")
    )
    stages = build(nodes)
    # The groups' own tree.
    subroots = materialize(stages[-1].select(F.col("tree").alias("name"), "digest", F.lit("").alias("tree")))
    groups = subroots.count()
    numbered = materialize(
        number_within(subroots, "tree", [F.col("name")]).select(
            "tree", (F.col("position") - 1).alias("position"), "digest", F.lit(groups).cast("long").alias("size"), "name"
        )
    )
    upper = build(numbered)
    root = upper[-1].first()
    if root is None:
        found = rows.select(F.col(f"`{key}`").alias("key"), *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof", "folded_root")])
        return found.limit(0).withColumnRenamed("key", key)
    of_root = numbered.sparkSession.range(1).select(
        F.lit("").alias("tree"), F.lit(0).cast("long").alias("position"), F.lit("").alias("path"), F.lit(None).cast("string").alias("subroot")
    )
    of_groups = of_root
    if len(upper) > 1:
        above = paths_down(upper, of_root)
        both = _with_paths(numbered, above).select("tree", "block", "place", "digest", "size", "path", "subroot")
        of_groups = both.mapInArrow(_descend, "tree string, position long, path string, subroot string")
    tops = materialize(
        of_groups.select("position", "path")
        .join(numbered.select("position", "name", "digest"), "position")
        .select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("position"), "path", F.col("digest").alias("subroot"))
    )
    both = _with_paths(nodes, paths_down(stages, tops)).select(
        "tree", "block", "place", "digest", "size", "path", "subroot", "key", "replacement"
    )
    kind = rows.schema[key].dataType
    proved = both.mapInArrow(
        _prove(to_arrow_type(kind)), f"key {kind.simpleString()}, leaf string, subroot string, proof string, folded_root string"
    )
    return proved.select(
        F.col("key").alias(key), "leaf", "subroot", F.lit(root["digest"]).alias("root"), "proof", "folded_root"
    )
