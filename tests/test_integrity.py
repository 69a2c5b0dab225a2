import random

import pytest

from salesops.operators import integrity as v
from salesops.operators.integrity import ForeignKey


def test_violations_per_key_and_null_passes(spark):
    tables = {
        "city": spark.createDataFrame([("c1",), ("c2",)], "id string"),
        "address": spark.createDataFrame([("a1", "c1", "r1"), ("a2", "c9", None), ("a3", None, "r9"), ("a4", "c9", "r9")], "id string, city string, road string"),
        "road": spark.createDataFrame([("r1",)], "id string"),
    }
    keys = [ForeignKey("address", "city", "city", "id"), ForeignKey("address", "road", "road", "id"), ForeignKey("road", "id", "road", "id")]
    found = v.check_foreign_keys(tables, keys)
    assert sorted(map(tuple, found.collect())) == [("address", "city", "city", 2), ("address", "road", "road", 2), ("road", "id", "road", 0)]
    assert sorted(map(tuple, v.violation_summary(found).collect())) == [("address", "city", 2), ("address", "road", 2)]
    with pytest.raises(v.IntegrityError, match="address -> city: 2"):
        v.require_no_violations(found)


def test_no_violation_passes(spark):
    tables = {"p": spark.createDataFrame([(1,)], "id int"), "c": spark.createDataFrame([(1,), (None,)], "p bigint")}
    v.require_no_violations(v.check_foreign_keys(tables, [ForeignKey("c", "p", "p", "id")]))


def test_duplicates_and_null_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), (None, 1), (None, 1)], "x string, y int")
    got = {r["key"]: tuple(r)[2:] for r in v.check_unique({"t": df}, [("t", "x"), ("t", ("x", "y"))]).collect()}
    assert got == {"x": (1, 2, 2), "x, y": (1, 1, 2)}


def test_ranges_are_inclusive_and_null_passes(spark):
    df = spark.createDataFrame([(0,), (1,), (20,), (21,), (None,)], "q int")
    assert v.check_range({"t": df}, {"t": {"q": (1, 20)}}).collect() == [("t", "range", "q", 2)]
    assert v.check_range({"t": df}, {"t": {"q": (1, None)}}).collect() == [("t", "range", "q", 1)]


def test_not_null(spark):
    df = spark.createDataFrame([("a", None), (None, None)], "x string, y string")
    assert sorted(map(tuple, v.check_not_null({"t": df}, {"t": ["x", "y"]}).collect())) == [("t", "not null", "x", 1), ("t", "not null", "y", 2)]


def test_defaults_fill_missing_columns_only(spark):
    df = spark.createDataFrame([(1, None)], "a int, b int")
    assert v.fill_defaults(df, {"b": 5, "c": True}).collect() == [(1, None, True)]


@pytest.mark.parametrize("broadcast", [True, False])
def test_cascade_follows_every_cascading_key(request, spark, broadcast):
    if not broadcast:
        request.getfixturevalue("no_broadcast")
    tables = {
        "account": spark.createDataFrame([("a1",), ("a2",)], "id string"),
        "customer": spark.createDataFrame([("c1", "a1"), ("c2", "a2"), ("c3", None)], "id string, account string"),
        "lead": spark.createDataFrame([("l1", "c1"), ("l2", "c2"), ("l3", "c3")], "id string, customer string"),
        "deal": spark.createDataFrame([("d1", "l2", "c1"), ("d2", "l1", "c2"), ("d3", "l3", "c3"), ("d4", None, None)], "id string, lead string, customer string"),
        "note": spark.createDataFrame([("n1", "c1")], "id string, customer string"),
    }
    keys = [
        ForeignKey("customer", "account", "account", "id", True),
        ForeignKey("lead", "customer", "customer", "id", True),
        ForeignKey("deal", "lead", "lead", "id", True),
        ForeignKey("deal", "customer", "customer", "id", True),
        ForeignKey("note", "customer", "customer", "id"),
    ]
    gone = tables["account"].where("id = 'a1'")
    left = v.cascade_delete(tables, "account", gone, keys, {name: "id" for name in tables})
    got = {name: sorted(r[0] for r in df.collect()) for name, df in left.items()}
    assert got == {"account": ["a2"], "customer": ["c2", "c3"], "lead": ["l2", "l3"], "deal": ["d3", "d4"], "note": ["n1"]}
    # The restricting key of the note now has no parent.
    assert v.check_foreign_keys(left, [keys[-1]]).first()["violations"] == 1


def test_fanout_of_orders_with_two_invoices_and_quotes_with_two_lines(spark):
    invoices = spark.createDataFrame([("q1", 100), ("q1", 50), ("q2", 7), ("q3", 1)], "q string, amount bigint")
    lines = spark.createDataFrame([("q1",), ("q1",), ("q2",)], "q string")
    got = v.fanout_audit(invoices, "q", "amount", lines, "q").first()
    assert (got["true_total"], got["joined_total"], got["excess"]) == (158.0, 307.0, 149.0)


def test_reconcile_and_lines_per_parent(spark):
    facts = spark.createDataFrame([(1, 10), (1, 5), (2, 7)], "k int, amount bigint")
    grouped = facts.groupBy("k").agg({"amount": "sum"}).toDF("k", "total")
    assert v.reconcile(grouped, "total", facts, "amount").first()["matches"] is True
    assert v.reconcile(grouped.where("k = 1"), "total", facts, "amount").first()["matches"] is False
    assert tuple(v.lines_per_parent(facts, "k").first()) == (2, 1)


def _brute_restricted(tables, root, asked, keys):
    """Roots are refused until none takes a row with it that a remaining row references."""
    rows = {(name, r["id"]): r for name, found in tables.items() for r in found}

    def closure(start):
        gone, todo = set(), [start]
        while todo:
            at = todo.pop()
            if at not in gone:
                gone.add(at)
                todo += [
                    (k.child, r["id"]) for k in keys if k.cascade and k.parent == at[0]
                    for r in tables[k.child] if r[k.column] == at[1] and r["id"] is not None
                ]
        return gone

    takes = {k: closure((root, k)) for k in asked if (root, k) in rows}
    while True:
        gone = set().union(*takes.values())
        needed = {
            (k.parent, r[k.column]) for k in keys if not k.cascade for r in tables[k.child] if (k.child, r["id"]) not in gone
        }
        refused = {k for k, closed in takes.items() if closed & needed}
        if not refused:
            return gone
        takes = {k: c for k, c in takes.items() if k not in refused}


@pytest.mark.parametrize("seed", range(3))
def test_delete_unless_referenced(spark, seed):
    """Two ways down to the same rows, restricting keys sideways, onto the root and from rows without a key."""
    rnd = random.Random(seed)
    pick = lambda name, n, share: f"{name}{rnd.randrange(n)}" if rnd.random() < share else None
    tables = {
        "a": [{"id": f"a{i}", "friend": pick("a", 40, 0.3)} for i in range(40)],
        "b": [{"id": f"b{i}", "a": pick("a", 40, 0.9)} for i in range(60)],
        "c": [{"id": f"c{i}", "a": pick("a", 40, 0.3), "b": pick("b", 60, 0.6), "d": pick("d", 30, 0.1)} for i in range(80)],
        "d": [{"id": f"d{i}", "b": pick("b", 60, 0.5)} for i in range(30)],
        "e": [{"id": None, "c": pick("c", 80, 0.5)} for _ in range(6)],
    }
    keys = [
        ForeignKey("a", "friend", "a", "id"), ForeignKey("b", "a", "a", "id", True), ForeignKey("c", "a", "a", "id", True),
        ForeignKey("c", "b", "b", "id", True), ForeignKey("d", "b", "b", "id", True), ForeignKey("c", "d", "d", "id"),
        ForeignKey("e", "c", "c", "id"),
    ]
    asked = [f"a{i}" for i in range(45) if rnd.random() < 0.7]
    frames = {n: spark.createDataFrame([tuple(r.values()) for r in found], ", ".join(f"{c} string" for c in found[0])) for n, found in tables.items()}
    left, refused = v.delete_unless_referenced(
        frames, "a", spark.createDataFrame([(k,) for k in asked], "key string"), keys, {n: "id" for n in frames if n != "e"}
    )
    gone = _brute_restricted(tables, "a", asked, keys)
    for name, found in tables.items():
        want = [r["id"] for r in found if (name, r["id"]) not in gone]
        assert sorted(str(r["id"]) for r in left[name].collect()) == sorted(map(str, want))
    assert {r["key"] for r in refused.collect()} == {k for k in asked if k in {r["id"] for r in tables["a"]}} - {k for n, k in gone if n == "a"}
    assert gone and {r["violations"] for r in v.check_foreign_keys(left, keys).collect()} == {0}
    # Nothing asked, nothing gone.
    left, refused = v.delete_unless_referenced(frames, "a", spark.createDataFrame([], "key string"), keys, {n: "id" for n in frames if n != "e"})
    assert left["b"].count() == 60 and refused.count() == 0
