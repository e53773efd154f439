import random

import pytest

from ledgerkit.operators import integrity as I

CASES = {
    "all matched": ([1, 2], [1, 1, 2], "PASS"),
    "childless parent": ([1, 2, 3], [1, 2], "WARNING"),
    "orphan": ([1], [1, 9], "FAIL"),
    "null child key": ([1], [1, None], "FAIL"),
    "null on both sides": ([1, None], [1, None], "FAIL"),
    "null parent key": ([1, None], [1], "WARNING"),
    "both empty": ([], [], "PASS"),
    "no children": ([1, 1], [], "WARNING"),
    "no parents": ([], [5], "FAIL"),
    "repeated parents": ([1, 1, 2], [1], "WARNING"),
}


def frame(spark, keys):
    return spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k bigint, n bigint")


def brute(parents, children):
    orphans = sum(1 for c in children if c is None or c not in parents)
    childless = sum(1 for p in parents if p is None or p not in children)
    return orphans, childless


@pytest.mark.parametrize("case", CASES)
def test_verdicts(spark, ansi, case):
    parents, children, verdict = CASES[case]
    balance = I.key_balance(frame(spark, parents), frame(spark, children), "k")
    row = I.with_count_parity(I.with_integrity_status(I.with_match_rates(balance))).first()
    orphans, childless = brute(parents, children)
    assert (row.orphans, row.childless, row.integrity_status) == (orphans, childless, verdict)
    assert (row.total_parents, row.total_children) == (len(parents), len(children))
    assert row.parent_keys == len({p for p in parents if p is not None})
    assert row.child_keys == len({c for c in children if c is not None})
    share = (len(children) - orphans) / len(children) * 100 if children else 0.0
    assert row.child_match_pct == pytest.approx(share)
    assert row.count_parity == ("PASS" if len(parents) == len(children) else "FAIL")


def test_anti_joins_agree_with_the_balance(spark):
    rng = random.Random(3)
    keys = [None, *range(30)]
    hot = [7] * 300
    parents = frame(spark, rng.choices(keys, k=60))
    children = frame(spark, rng.choices(keys, k=200) + hot)
    balance = I.key_balance(parents, children, "k").first()
    assert I.anti_orphans(children, parents, "k").count() == balance.orphans
    assert I.anti_parents(parents, children, "k").count() == balance.childless
    assert I.anti_orphans(children, parents, "k").columns == ["k", "n"]


def test_balance_shuffles_once_per_table_and_never_joins(spark):
    df = I.key_balance(frame(spark, [1]), frame(spark, [1]), "k")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_count_parity(spark):
    row = I.count_parity(spark.range(3), spark.range(4)).first()
    assert (row.total_parents, row.total_children, row.count_parity) == (3, 4, "FAIL")
    assert I.count_parity(spark.range(0), spark.range(0)).first().count_parity == "PASS"
