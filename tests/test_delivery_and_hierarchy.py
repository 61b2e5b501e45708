import random

import pytest
from chatmill.operators import redelivery
from chatmill.operators.hierarchy import descendants, intervals, resolve_hierarchy
from pyspark.sql import functions as F

SCHEMA = "chat_id long, msg_id long, reply_to_id long"


def tree(spark, rows, **kw):
    return {(r.chat_id, r.msg_id): r for r in resolve_hierarchy(spark.createDataFrame(rows, SCHEMA), **kw).collect()}


def brute(rows):
    parent = {}
    for c, m, p in rows:
        if c is not None and m is not None:
            old = parent.get((c, m))
            p = None if p in (None, 0) else p
            parent[c, m] = p if old is None else old if p is None else min(p, old)
    out = {}
    for c, m in parent:
        at, path = m, []
        while True:
            if at in path:
                out[c, m] = (None, -1, None)
                break
            path.append(at)
            up = parent[c, at]
            if up is None or (c, up) not in parent:
                out[c, m] = (at, len(path) - 1, path[::-1])
                break
            at = up
    return out


@pytest.mark.parametrize("seed", range(4))
def test_random_forests_with_loops(spark, seed):
    r = random.Random(seed)
    rows = [(r.randint(1, 2), r.randint(1, 40), r.choice([None, 0, *range(1, 45)])) for _ in range(120)]
    got = tree(spark, rows, with_path=True)
    want = brute(rows)
    assert {k: (v.root_id, v.depth, v.path) for k, v in got.items()} == want


def test_long_chain_star_and_loop(spark):
    chain = [(1, k, k - 1) for k in range(1, 300)]
    star = [(2, 1, None)] + [(2, k, 1) for k in range(2, 400)]
    loop = [(3, 1, 2), (3, 2, 3), (3, 3, 1), (3, 4, 3), (3, 5, 5)]
    got = tree(spark, chain + star + loop)
    assert got[1, 299].root_id == 1 and got[1, 299].depth == 298
    assert {v.depth for k, v in got.items() if k[0] == 2} == {0, 1}
    assert all(v.cyclic and v.depth == -1 and v.root_id is None for k, v in got.items() if k[0] == 3)


def test_empty_and_nulls(spark):
    assert tree(spark, []) == {}
    got = tree(spark, [(None, 1, 2), (1, None, 1), (1, 7, 99)])
    assert list(got) == [(1, 7)] and got[1, 7].root_id == 7 and got[1, 7].depth == 0


def test_clashing_names_and_descendants(spark):
    rows = spark.createDataFrame([(1, 1, None, "a"), (1, 2, 1, "b"), (1, 3, 2, "c")], "chat_id long, msg_id long, reply_to_id long, root_id string")
    found = {tuple(r) for r in descendants(resolve_hierarchy(rows, with_path=True)).collect()}
    assert found == {(1, 1, 2, 1), (1, 1, 3, 2), (1, 2, 3, 1)}


def test_intervals_hold_descendants(spark):
    r = random.Random(9)
    rows = [(r.randint(1, 2), m, r.choice([None, *range(1, 60)])) for m in range(1, 60)]
    tree_ = resolve_hierarchy(spark.createDataFrame(rows, SCHEMA), with_path=True)
    spans = {(x.chat_id, x.msg_id): (x.enter, x.leave) for x in intervals(tree_).collect()}
    below = {tuple(x)[:3] for x in descendants(tree_).collect()}
    found = {(c, a, d) for (c, a), (e, f) in spans.items() for (k, d), (g, _) in spans.items() if k == c and e < g <= f}
    assert found == below and sorted(e for e, _ in spans.values()) == list(range(len(spans)))


def _delivered(spark, rows, path, files=3):
    frame = spark.createDataFrame(rows, "chat_id long, msg_id long, batch_id long, ingested_at timestamp, text string")
    frame.repartition(files).write.parquet(path)
    return path


def test_one_copy_of_each(spark, tmp_path):
    rows = [(1, k % 50, k // 50, None, f"t{k}") for k in range(200)] + [(None, 5, 1, None, "x"), (None, 5, 1, None, "x")]
    path = _delivered(spark, rows, str(tmp_path / "t"))
    out = redelivery.deduplicate_deliveries(spark, path)
    got = out.collect()
    assert len(got) == 52
    assert {(r.msg_id, r.batch_id) for r in got if r.chat_id} == {(k, 0) for k in range(50)}
    assert all(r.redelivered for r in got if r.chat_id) and not any(r.redelivered for r in got if r.chat_id is None)


def test_vectors_on_shelves_give_the_same(spark, tmp_path, monkeypatch):
    rows = [(k % 3, k % 17, k, None, f"t{k}") for k in range(300)] + [(None, 1, 1, None, "n")]
    path = _delivered(spark, rows, str(tmp_path / "t"), files=6)
    whole = sorted(map(str, redelivery.deduplicate_deliveries(spark, path).collect()))
    for shelf in (redelivery.SHELF_BYTES, redelivery.VECTOR_BYTES):
        monkeypatch.setattr(redelivery, "SHELF_BYTES", shelf)
        parts = redelivery.deduplicate_deliveries(spark, path, broadcast_bytes=0)
        assert sorted(map(str, parts.collect())) == whole
    assert len(whole) == 52


def test_rows_past_the_first_bucket(spark, tmp_path):
    n = redelivery.BUCKET
    frame = spark.range(0, 2 * n + 10, 1, 1).select(F.lit(1).cast("long").alias("chat_id"), F.when(F.col("id") >= 2 * n, F.col("id") - n).otherwise(F.col("id")).alias("msg_id"), F.col("id").alias("batch_id"), F.lit(None).cast("timestamp").alias("ingested_at"))
    frame.write.parquet(str(tmp_path / "t"))
    for most in (64 << 20, 0):
        out = redelivery.deduplicate_deliveries(spark, str(tmp_path / "t"), broadcast_bytes=most)
        assert out.count() == 2 * n and out.where("redelivered").agg(F.min("batch_id"), F.max("batch_id"), F.count("*")).first() == (n, n + 9, 10)


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from types import SimpleNamespace

    from chatmill.plans.scratch import shared_folder

    with pytest.raises(ValueError):
        shared_folder(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://host:7077")))


def test_hot_key_ties_and_empty(spark, tmp_path):
    rows = [(1, 1, 0, None, str(k)) for k in range(100)] + [(1, 2, 0, None, "b")]
    path = _delivered(spark, rows, str(tmp_path / "t"))
    assert redelivery.deduplicate_deliveries(spark, path).groupBy("msg_id").agg(F.count("*")).count() == 2
    empty = _delivered(spark, [], str(tmp_path / "e"), files=1)
    assert redelivery.deduplicate_deliveries(spark, empty).count() == 0
