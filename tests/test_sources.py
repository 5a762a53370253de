"""Connector: raw messages stored as JSON lines read back and decoded."""

import uuid

from pyspark.sql import functions as F

from conftest import SF_SMALL
from quire.session import scratch_path
from quire.sources import fixtures as FX
from quire.sources import mail as M


def test_jsonl_round_trip(spark):
    raw = FX.raw_messages(spark, SF_SMALL)
    # store like a mail export: the message object plus an internalDate (epoch ms)
    ms = F.unix_millis(F.to_timestamp(F.col("digest_date"))) + F.col("message_id") % 1000
    stored = raw.select(F.when(F.col("raw").startswith("{"),
                               F.concat(F.lit('{"internalDate": "'), ms.cast("string"), F.lit('", '),
                                        F.expr("substr(raw, 2)")))
                         .otherwise(F.col("raw")).alias("value"))
    path = scratch_path(spark, f"t-raw-{uuid.uuid4().hex[:8]}")
    stored.write.text(path)
    back = M.read_raw(spark, path, "jsonl")
    # one millisecond holds several messages; the id keeps their order total
    assert back.select("digest_date", "list_pos").filter("message_id is not null").distinct().count() == \
        back.filter("message_id is not null").count()
    good, q = M.decode_messages(back)
    want, wq = M.decode_messages(raw)
    got = {int(r.message_id): r.body for r in good.collect() if r.message_id is not None}
    exp = {r.message_id: r.body for r in want.collect()}
    assert got == exp
    assert q.filter("stage = 'parse'").count() == wq.filter("stage = 'parse'").count()
    days = {int(r.message_id): r.digest_date for r in back.collect() if r.message_id is not None}
    assert all(days[k] == v for k, v in {r.message_id: r.digest_date for r in raw.collect()}.items() if k in days)
