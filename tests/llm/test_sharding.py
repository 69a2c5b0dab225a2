import hashlib
from collections import Counter

import pytest

from salesops.llm import sharding


def number(text, modulus):
    return int(hashlib.md5(text.encode()).hexdigest()[:15], 16) % modulus


def filled(names, size):
    """Turn by turn, as the definition says."""
    orders = [(number(n + "/offset", size), number(n + "/step", size - 1) + 1) for n in names]
    owners, tried, turn = [None] * size, [0] * len(names), 0
    while None in owners:
        offset, step = orders[turn]
        slot = (offset + tried[turn] * step) % size
        tried[turn] += 1
        if owners[slot] is None:
            owners[slot] = turn
            turn = (turn + 1) % len(names)
    return owners


@pytest.mark.parametrize(("count", "size"), [(1, 2), (3, 7), (7, 101), (10, 1009)])
def test_table_is_filled_by_turns(spark, count, size):
    names = sharding.shard_names(count)
    rows = {r.slot: r.shard for r in sharding.lookup_table(spark, names, size).collect()}
    assert [rows[s] for s in range(size)] == filled(names, size)


def test_shards_get_equal_slots_and_few_move(spark):
    size = sharding.table_size(10)
    before = filled(sharding.shard_names(10), size)
    assert max(Counter(before).values()) - min(Counter(before).values()) <= 1
    after = filled(sharding.shard_names(9), size)
    moved = sum(b != a for b, a in zip(before, after, strict=True) if b != 9)
    assert moved < 0.2 * size


def test_odd_rows(odd, none):
    names = sharding.shard_names(5)
    rows = sharding.place(odd, ["doc_id"], names, 101).collect()
    assert len(rows) == 13 and set(odd.columns) == set(rows[0].asDict()) - {"shard"}
    owners = filled(names, 101)
    for r in rows:
        assert r.slot == number("" if r.doc_id is None else str(r.doc_id), 101) and r.shard == owners[r.slot]
    assert sharding.place(none, ["doc_id", "slot"], names).count() == 0


def test_bad_tables(spark):
    for names, size in ([], 7), (["a", "a"], 7), (["a"] * 9, 7):
        with pytest.raises(ValueError):
            sharding.lookup_table(spark, names, size)
