import json
import random

import pytest

from tidemill.operators import change_feed as cf
from tidemill.session import fresh_dir

SCHEMA = "topic string, part_no int, log_offset bigint, msg_key string, op string, lsn bigint, ts_ms bigint, before string, after string"
FIELDS = ["tenant_id", "body"]


def msg(off, op, lsn, ts, before=None, after=None, key=None, topic="cdc.public.article", part=0):
    j = lambda x: None if x is None else x if isinstance(x, str) else json.dumps(x)
    return (topic, part, off, j(key), op, lsn, ts, j(before), j(after))


def state(spark, rows, batches=1, seed=0):
    store = cf.BucketedState(spark, fresh_dir(spark, "t"), FIELDS, buckets=3)
    rows = list(rows)
    if batches > 1:
        random.Random(seed).shuffle(rows)
    for n in range(batches):
        store.apply(cf.parse_messages(spark.createDataFrame(rows[n::batches], SCHEMA), FIELDS))
    return sorted(tuple(r) for r in store.current().collect())


def img(i, body="x", tenant="t"):
    return {"id": i, "tenant_id": tenant, "body": body}


LIFE = [
    msg(1, "c", 10, 100, None, img(1, "a")),
    msg(2, "u", 12, 102, img(1, "a"), img(1, "c")),
    msg(3, "u", 11, 101, img(1, "a"), img(1, "b")),  # late
    msg(4, "c", 20, 200, None, img(2, "gone")),
    msg(5, "d", 21, 201, img(2, "gone"), None),
    msg(6, None, None, None, key={"id": 2}),  # tombstone
    msg(7, "d", 30, 300, None, None, key={"id": 3}),
    msg(8, "c", 31, 301, None, img(3, "again", "u"), key={"id": 3}),
    msg(9, "m", 32, 302),
    msg(10, "u", 40, 400, img(4, "long"), img(4, cf.UNAVAILABLE[0])),
    msg(11, "u", 41, 401, None, {"id": "4", "tenant_id": None, "body": cf.UNAVAILABLE[1]}),
    msg(12, "u", None, 50, img(5, "new"), img(5, "clock-early")),
    msg(13, "u", 5, 60, None, img(5, "clock-late", "v")),
    msg(14, "u", 99, 55, None, img(5, "clock-mid")),
    msg(15, "u", 50, 500, None, None, key={"id": 6}),
    msg(16, "u", 51, 501, "not json", "[1]", key="{"),
]
WANT = [
    ("article", 1, "t", "c", 102),
    ("article", 3, "u", "again", 301),
    ("article", 4, "t", "long", 401),
    ("article", 5, "v", "clock-late", 60),
    ("article", 6, None, None, 500),
]


def test_one_batch(spark):
    assert state(spark, LIFE) == WANT


@pytest.mark.parametrize("seed", [1, 2])
def test_any_batches_and_repeats(spark, seed):
    again = [(*m[:2], m[2] + 100, *m[3:]) for m in LIFE]
    assert state(spark, LIFE + LIFE + again, batches=4, seed=seed) == WANT


def test_equal_lsn_higher_offset(spark):
    assert state(spark, [msg(2, "u", 7, 1, None, img(1, "late")), msg(1, "u", 7, 9, None, img(1, "early"))]) == [("article", 1, "t", "late", 1)]


def test_value_of_an_earlier_life_is_not_kept(spark):
    rows = [msg(1, "c", 1, 1, None, img(1, "old")), msg(2, "d", 2, 2, img(1, "old")), msg(3, "c", 3, 3, None, {"id": 1, "tenant_id": "t", "body": cf.UNAVAILABLE[0]})]
    assert state(spark, rows) == [("article", 1, "t", None, 3)]


def test_empty_feed_commits_nothing(spark):
    store = cf.BucketedState(spark, fresh_dir(spark, "t"), FIELDS)
    assert store.apply(cf.parse_messages(spark.createDataFrame([], SCHEMA), FIELDS)) == 0
    assert store.current().collect() == [] and store.versions() == []


def test_only_touched_buckets_are_rewritten(spark):
    store = cf.BucketedState(spark, fresh_dir(spark, "t"), FIELDS, buckets=8)
    feed = lambda rows: cf.parse_messages(spark.createDataFrame(rows, SCHEMA), FIELDS)
    store.apply(feed([msg(i, "c", i, i, None, img(i)) for i in range(1, 60)]))
    first = store.manifest()["files"]
    store.apply(feed([msg(100, "u", 100, 100, None, img(5, "new"))]))
    second = store.manifest()["files"]
    assert sum(first[b] != second[b] for b in first) == 1 and len(first) > 4
    assert store.current(1).where("id = 5").first().body == "x" and store.current().where("id = 5").first().body == "new"
    assert store.apply(feed([msg(101, "d", 101, 101, img(5))]), batch=7) == 3
    assert store.apply(feed([msg(102, "c", 102, 102, None, img(5))]), batch=7) == 3  # done again
    assert store.expire(keep=1) == 2 and store.current().count() == 58


def test_other_writer_first(spark):
    a = cf.BucketedState(spark, fresh_dir(spark, "t"), FIELDS)
    feed = cf.parse_messages(spark.createDataFrame([msg(1, "c", 1, 1, None, img(1))], SCHEMA), FIELDS)
    old = a._old()
    a.apply(feed)
    a._old = lambda: old
    with pytest.raises(RuntimeError):
        a.apply(feed)
    with pytest.raises(ValueError):
        cf.BucketedState(spark, a.path, ["tenant_id"])


def test_hot_row(spark):
    rows = spark.range(20000).selectExpr("'cdc.public.comment' AS topic", "0 AS part_no", "id AS log_offset", "'{\"id\":1}' AS msg_key", "'u' AS op", "id AS lsn", "id AS ts_ms", "CAST(NULL AS string) AS before", "concat('{\"id\":1,\"tenant_id\":\"t\",\"body\":\"', id, '\"}') AS after")
    store = cf.BucketedState(spark, fresh_dir(spark, "t"), FIELDS)
    store.apply(cf.parse_messages(rows, FIELDS))
    assert [tuple(r) for r in store.current().collect()] == [("comment", 1, "t", "19999", 19999)]


def test_the_query_merges_into_touched_buckets(spark, monkeypatch):
    """The feed of p4 goes through the merge, with the result of one batch."""
    from tidemill.plans import problems

    merged, plain = [], cf.BucketedState._merged
    monkeypatch.setattr(cf.BucketedState, "_merged", lambda self, base, delta: merged.append(1) or plain(self, base, delta))
    sf = "/root/testdata/sf0.001"
    store = problems.feed_state(spark, sf)
    one = cf.BucketedState(spark, fresh_dir(spark, "t"), problems.FEED_FIELDS)
    one.apply(cf.parse_messages(problems.table(spark, sf, "cdc_to_iceberg"), problems.FEED_FIELDS))
    assert merged and sorted(map(str, store.current().collect())) == sorted(map(str, one.current().collect()))


def test_two_writers_race(spark):
    """Of writers that commit the same version at the same time one wins, the others' batches are refused."""
    from concurrent.futures import ThreadPoolExecutor

    from tidemill.sources import shared_fs

    path = fresh_dir(spark, "race")
    for n in range(5):
        with ThreadPoolExecutor(8) as pool:
            won = list(pool.map(lambda k: shared_fs.write_new(spark, f"{path}/{n}.json", f"writer {k}"), range(8)))
        assert sum(won) == 1 and shared_fs.read_text(spark, f"{path}/{n}.json") == f"writer {won.index(True)}"
    assert shared_fs.names(spark, path) == [f"{n}.json" for n in range(5)]


def test_two_stores_apply_at_once(spark):
    from concurrent.futures import ThreadPoolExecutor

    path = fresh_dir(spark, "t")
    feed = lambda k: cf.parse_messages(spark.createDataFrame([msg(k, "c", k, k, None, img(k))], SCHEMA), FIELDS)

    def write(k):
        store = cf.BucketedState(spark, path, FIELDS, buckets=2)
        while True:
            try:
                return store.apply(feed(k))
            except RuntimeError:  # another writer was first: again
                continue

    with ThreadPoolExecutor(3) as pool:
        versions = list(pool.map(write, (1, 2, 3)))
    assert sorted(versions) == [1, 2, 3] and cf.BucketedState(spark, path, FIELDS).current().count() == 3


def test_buckets_follow_the_size(spark, monkeypatch):
    store = cf.BucketedState(spark, fresh_dir(spark, "t"), FIELDS, buckets=16)
    feed = lambda a, b: cf.parse_messages(spark.createDataFrame([msg(i, "c", i, i, None, img(i)) for i in range(a, b)], SCHEMA), FIELDS)
    store.apply(feed(1, 200))
    assert len(store.manifest()["files"]) > 10
    store.compact()
    assert len(store.manifest()["files"]) == 1 and store.current().count() == 199
    monkeypatch.setattr(cf.BucketedState, "GROW", sum(store.manifest()["sizes"].values()) // 4)
    other = cf.BucketedState(spark, store.path, FIELDS)
    store.apply(feed(200, 210))  # the one bucket is divided first
    assert store.buckets > 2 and len(store.manifest()["files"]) > 2 and store.current().count() == 209
    monkeypatch.setattr(cf.BucketedState, "GROW", 1 << 30)
    other.apply(feed(210, 220))  # opened before that
    assert other.buckets == store.buckets and other.current().count() == 219 and other.current().select("id").distinct().count() == 219
    one = other.compact()
    assert other.buckets == 1 and other.compact() == one  # nothing left to do
