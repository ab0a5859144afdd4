"""Keyed sums on random tables against a brute-force evaluation of the SQL.

Key domains are tiny, so keys collide heavily; keys and values are sometimes
null and rows repeat.  The brute force follows the statements literally:
every joined pair contributes, the IN lists filter independently.
"""

import random

import pytest

from rulegrid.operators import in_keys_group_sum, in_list_group_sum, join_group_sum, join_two_keys


def _maybe(rng, value, p_null=0.1):
    return None if rng.random() < p_null else value


def random_tables(seed):
    rng = random.Random(seed)
    a = [(_maybe(rng, rng.randint(1, 4)), _maybe(rng, rng.randint(1, 3)), _maybe(rng, rng.randint(1, 5)))
         for _ in range(rng.randint(0, 60))]
    b = [(_maybe(rng, rng.randint(1, 4)), _maybe(rng, rng.randint(1, 5)), _maybe(rng, float(rng.randint(-5, 20)), 0.2))
         for _ in range(rng.randint(0, 80))]
    keys = [(_maybe(rng, rng.randint(1, 6)), _maybe(rng, rng.randint(1, 5))) for _ in range(rng.randint(0, 6))]
    return a, b, keys


def _sum(values):
    present = [v for v in values if v is not None]
    return sum(present) if present else None


def brute_join_group_sum(a, b):
    groups = {}
    for s, o, i in a:
        for bo, bi, v in b:
            if s is not None and i is not None and bo == s and bi == i:
                groups.setdefault((s, o, i), []).append(v)
    return sorted(((*k, _sum(v)) for k, v in groups.items()), key=repr)


def brute_join(a, b):
    """The SQL join's rows as a bag: distinct row -> number of pairs producing it."""
    from collections import Counter

    pairs = Counter((s, o, i, v) for s, o, i in a for bo, bi, v in b
                    if s is not None and i is not None and bo == s and bi == i)
    return sorted(((*k, n) for k, n in pairs.items()), key=repr)


def brute_in_list(b, items, orgs):
    items = {x for x in items if x is not None}
    orgs = {x for x in orgs if x is not None}
    groups = {}
    for bo, bi, v in b:
        if bi in items and bo in orgs:
            groups.setdefault((bo, bi), []).append(v)
    return sorted(((bo, "oi001", bi, _sum(v)) for (bo, bi), v in groups.items()), key=repr)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_keyed_sums_match_brute_force(spark, seed):
    a_rows, b_rows, key_rows = random_tables(seed)
    a = spark.createDataFrame(a_rows, "sch_org_id bigint, org_id int, inv_item_id bigint")
    b = spark.createDataFrame(b_rows, "org_id bigint, item_id bigint, shuju double")
    keys = spark.createDataFrame(key_rows, "inv_item_id bigint, sch_org_id bigint")
    items, orgs = [k[0] for k in key_rows], [k[1] for k in key_rows]

    assert rows(join_group_sum(a, b)) == brute_join_group_sum(a_rows, b_rows)
    assert rows(join_two_keys(a, b)) == brute_join(a_rows, b_rows)
    expected = brute_in_list(b_rows, items, orgs)
    assert rows(in_list_group_sum(b, items, orgs)) == expected
    for broadcast_max in (0, 100):
        assert rows(in_keys_group_sum(b, keys, broadcast_max_keys=broadcast_max)) == expected
