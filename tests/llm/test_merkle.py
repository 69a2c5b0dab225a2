import random
import zlib
from hashlib import sha256

from pyspark.sql import functions as F

from salesops.llm import merkle, queries
from tests.llm.conftest import SMALL


def digest(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(values):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def all_levels(nodes):
    """The runs of every level up to the root, and the root."""
    found = []
    while len(nodes) > 1:
        found.append([nodes[k : k + 8] for k in range(0, len(nodes), 8)])
        nodes = [digest("".join(r)) for r in found[-1]]
    return found, nodes[0]


def way(levels, at):
    """A node's siblings to the left and right, level by level."""
    for runs in levels:
        at, slot = divmod(at, 8)
        yield runs[at][:slot], runs[at][slot + 1 :]


def plain_manifest(rows):
    """Rows of (key, group, leaf, replacement): sorted leaves of each group, every tree built for every leaf."""
    groups = {}
    for key, group, leaf, replacement in rows:
        groups.setdefault("" if group is None else "=" + group, []).append((key is not None, key or 0, leaf, replacement))
    names = sorted(groups, key=str.encode)
    for g in groups.values():
        g.sort(key=lambda r: (r[0], r[1], r[2]))
    trees = [all_levels([r[2] for r in groups[n]]) for n in names]
    subroots = [subroot for _, subroot in trees]
    upper, root = all_levels(subroots)
    found = []
    for place, name in enumerate(names):
        for at, (known, key, leaf, replacement) in enumerate(groups[name]):
            steps = [*way(trees[place][0], at), *way(upper, place)]
            folded = replacement or leaf
            for left, right in steps:
                folded = digest("".join([*left, folded, *right]))
            proof = "".join("".join(left + right) for left, right in steps)
            found.append((key if known else None, leaf, subroots[place], root, proof, folded))
    return found


def compare(spark, rows):
    given = spark.createDataFrame(rows, "key long, grp string, leaf string, changed string, tree int, place int")
    found = merkle.manifest(given, "key", F.col("grp"), F.col("leaf"), F.col("changed"))
    order = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, found.collect()), key=order) == sorted(plain_manifest([r[:4] for r in rows]), key=order)


def test_groups_of_many_sizes(spark):
    """One leaf, whole runs, runs of one, several blocks, more groups than a run holds."""
    rnd = random.Random(3)
    rows = []
    for group, size in enumerate([1, 2, 7, 8, 9, 64, 65, 512, 513, 1100, 1, 1]):
        for k in range(size):
            changed = digest(f"new {k}") if rnd.random() < 0.3 else None
            rows.append((k, f"g{group}" if group else None, digest(f"{group} {k}"), changed, 1, 2))
    rnd.shuffle(rows)
    compare(spark, rows)


def test_hot_group_over_many_ranges(many_ranges):
    """All rows but one in one group, a third of them equal, keys null; trees of three stages."""
    rows = [(None if k % 5 == 0 else k % 4000, "hot", digest("same" if k % 3 == 0 else str(k)), None, 1, 2) for k in range(6000)]
    compare(many_ranges, [*rows, (1, "cold", digest("x"), digest("y"), 1, 2)])


def test_many_groups(spark):
    """The groups' own tree takes several blocks."""
    compare(spark, [(k, f"ü{k % 700}", digest(str(k)), None, 1, 2) for k in range(1500)])


def test_leaf_and_empty(spark, odd, none):
    rows = odd.select("doc_id", "text", merkle.leaf([F.col("doc_id"), F.col("text")]).alias("leaf")).collect()
    assert all(r.leaf == plain_leaf((r.doc_id, r.text)) for r in rows)
    assert merkle.leaf([F.lit(None)]) is not None
    assert merkle.manifest(none, "doc_id", F.col("text"), F.sha2("text", 256)).collect() == []


def test_query_by_brute_force(spark):
    documents = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    rows = []
    for r in documents:
        fields = [r.doc_id, r.source, r.lang, r.n_chars]
        lowered = r.text if r.text is None else "".join(c.lower() if c.isascii() else c for c in r.text)
        changed = plain_leaf([*fields, lowered]) if zlib.crc32(str(r.doc_id).encode()) % 3 == 0 else None
        rows.append((r.doc_id, r.lang, plain_leaf([*fields, r.text]), changed))
    want = [(k, leaf, sub, root, digest(proof), folded, folded == root) for k, leaf, sub, root, proof, folded in plain_manifest(rows)]
    found = queries.op12_merkle(spark, SMALL).collect()
    assert sorted(map(tuple, found)) == sorted(want)
    assert 0 < sum(not r.verified for r in found) < len(found)
