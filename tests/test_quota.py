"""Quotas of chunks: documents by windows or, where they are crowded, by ordinals; both as one by one."""

import random

from ticketloom.operators import windows


def _one_by_one(chunks, n, floor):
    total = sum(t for _, t in chunks)
    share = {c: max(1, round(n * t / total)) for c, t in chunks}
    left, order, i = max(n, floor * len(chunks)) - sum(share.values()), sorted(share), 0
    while left:
        c = order[i % len(order)]
        if left > 0:
            share[c], left = share[c] + 1, left - 1
        elif share[c] > floor:
            share[c], left = share[c] - 1, left + 1
        i += 1
    return share


def test_quota_is_that_of_going_one_by_one_and_takes_one_shuffle(spark):
    draw = random.Random(11)
    docs = {d: ([(c, draw.randrange(1, 60)) for c in draw.sample(range(99), draw.randrange(1, 9))], draw.choice([1, 3, 17, 40])) for d in range(60)}
    df = spark.createDataFrame([(d, c, t, n) for d, (chunks, n) in docs.items() for c, t in chunks], "doc long, chunk long, tokens long, n long")
    for floor in (0, 1):
        want = {(d, c): q for d, (chunks, n) in docs.items() for c, q in _one_by_one(chunks, n, floor).items()}
        for crowded in (1 << 16, 4, 0):
            out = windows.split_quota_over_chunks(df, floor=floor, crowded=crowded)
            assert {(r["doc"], r["chunk"]): r["quota"] for r in out.collect()} == want
    plan = windows.split_quota_over_chunks(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") <= 1
