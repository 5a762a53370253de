"""The distributed greedy packer equals the per-day fold (and a plain loop)."""

import pytest

from conftest import SF_SMALL
from quire.operators import chunking as K
from quire.operators.packing import chunk_assign_scan
from quire.params import DEFAULT
from quire.plans.q_select import newsletters


@pytest.mark.parametrize("budget,bucket,parts", [(8000, 1, 3), (3000, 4, 5), (2500, 1, 7), (75000, 2, 2)])
def test_scan_equals_fold(spark, budget, bucket, parts):
    nl = newsletters(spark, SF_SMALL, DEFAULT.with_(max_messages=None))
    p = DEFAULT.with_(max_input_tokens=budget, max_messages=10 ** 9)
    fold = {(r.digest_date, r.label, r.message_id): r.chunk_id for r in K.chunk_assign(nl, p).collect()}
    scan = {(r.digest_date, r.label, r.message_id): r.chunk_id
            for r in chunk_assign_scan(nl, p, bucket=bucket, partitions=parts).collect()}
    assert fold == scan


def test_scan_hot_day_many_buckets(spark):
    # one day holding every row, tiny buckets: many tree levels, one answer
    rows = [("2024-01-01", "L", i, i, "x" * ((i * 37) % 3000)) for i in range(600)]
    df = spark.createDataFrame(rows, "digest_date string, label string, message_id long, list_pos long, body string")
    p = DEFAULT.with_(max_input_tokens=4000, max_messages=None)
    got = {r.list_pos: r.chunk_id for r in chunk_assign_scan(df, p, bucket=1, partitions=6).collect()}
    cur, cid, want = 2000, 0, {}
    for i in range(600):
        tk = ((i * 37) % 3000) // 4 + 200
        if cid == 0 or cur + tk > 4000:
            cid, cur = cid + 1, 2000
        cur += tk
        want[i] = cid
    assert got == want
