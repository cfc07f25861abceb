import pytest
from data import clashing, doc, docs, odd_rows, words
from pyspark.sql import functions as F

from candlewright.llm import sharding
from candlewright.llm.sharding import Conflict, ShardStore, shard_arrivals


def store(spark, tmp_path, df):
    return ShardStore(spark, f"file://{tmp_path}/shards", df.schema)


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_rows_come_back(spark, tmp_path):
    df = clashing(docs(spark, odd_rows()))
    s = shard_arrivals(df, f"file://{tmp_path}/a", arrivals=3)
    same(s.read(), df)
    empty = shard_arrivals(docs(spark, []), f"file://{tmp_path}/b")
    assert empty.read().count() == 0 and empty.read().columns == docs(spark, []).columns


def test_columns_of_any_name(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST", 1024)
    df = docs(spark, [doc(i, words(30, i)) for i in range(60)])
    for name in ("_file", "_run", "file", "run", "File_", "path", "bytes", "since", "shards", "tier", "folder", "_metadata", "a.b", "_n"):
        df = df.withColumn(name, F.col("doc_id") + 1)
    s = shard_arrivals(df, f"file://{tmp_path}/n")
    assert s.version() > 4
    same(s.read(), df)


def test_tiers_merge_until_nothing_is_left_to_merge(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST", 512)
    df = docs(spark, [doc(i, words(30, i)) for i in range(400)]).repartition(24)
    s = shard_arrivals(df, f"file://{tmp_path}/t", target=60_000)
    same(s.read(), df)
    assert s.plan(60_000).count() == 0 and s.manifest().count() < 24
    live = {r.path for r in s.manifest().collect()}
    files = {str(p.relative_to(tmp_path / "t")) for p in (tmp_path / "t/data").rglob("*.parquet")}
    assert live <= files and len(files - live) <= len({p.split("/")[1] for p in live})


def test_readers_open_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST", 1024)
    df = docs(spark, [doc(i, words(30, i)) for i in range(90)])
    s = store(spark, tmp_path, df)
    s.append(df.where("doc_id < 30").repartition(6))
    assert len(s.places()) == 1 and s.manifest().count() == 6
    big = docs(spark, [doc(i, words(6000 if i > 80 else 30, i)) for i in range(30, 90)])
    s.append(big.repartitionByRange(6, "doc_id"))
    assert len(s.places()) == 2
    s.compact(20_000)
    assert 1 < len(s.places()) <= s.manifest().count()
    same(s.read(), df.where("doc_id < 30").unionAll(big))
    s.vacuum()
    same(s.read(), df.where("doc_id < 30").unionAll(big))


@pytest.mark.parametrize("kind", ["string", "decimal(20,2)", "date", "double", "int"])
def test_keys_of_any_type(spark, tmp_path, kind):
    df = docs(spark, [doc(i, words(5, i)) for i in range(60)] + [doc(None, "none")])
    df = df.withColumn("doc_id", F.date_add(F.lit("2024-01-01"), F.col("doc_id").cast("int")) if kind == "date" else F.col("doc_id").cast(kind))
    s = shard_arrivals(df, f"file://{tmp_path}/k")
    same(s.read(), df)


def test_vacuum_leaves_what_may_still_be_committed(spark, tmp_path):
    df = docs(spark, [doc(1, "a")])
    s = store(spark, tmp_path, df)
    s.append(df)
    late = s._write(df)  # not committed yet
    s.append(df)
    assert s.vacuum() == 0 and len(list((tmp_path / "shards/data").iterdir())) == 3
    s._commit(2, s.manifest().unionByName(late.withColumn("since", F.lit(3).cast("long"))))
    assert s.read().count() == 3
    s._write(df)  # never committed
    assert s.vacuum(grace_ms=-1000) == 0 and len(list((tmp_path / "shards/data").iterdir())) == 3
    assert len(list((tmp_path / "shards/manifests").iterdir())) == 1 and s.read().count() == 3


def test_more_small_shards_than_a_compaction_reads(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "MAX_FILES", 5)
    df = docs(spark, [doc(i, words(30, i)) for i in range(120)]).repartition(8)
    s = shard_arrivals(df, f"file://{tmp_path}/m", arrivals=2)
    same(s.read(), df)
    assert s.manifest().count() <= 5 and s.version() > 3


def test_the_version_before_can_be_kept(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST", 1024)
    df = docs(spark, [doc(i, words(30, i)) for i in range(100)]).coalesce(2)
    s = shard_arrivals(df, f"file://{tmp_path}/v", keep=2)
    same(s.read(s.version() - 1), s.read())


def test_versions_and_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST", 1024)
    df = docs(spark, [doc(i, words(40, i)) for i in range(200)])
    s = store(spark, tmp_path, df)
    assert s.version() == 0 and s.read().count() == 0 and s.compact() is None
    for k in range(8):
        s.append(df.where(F.col("doc_id") % 8 == k).coalesce(1))
    assert s.version() == 8 and s.manifest().count() == 8
    total = s.manifest().agg(F.sum("bytes")).first()[0]
    target = int(total / 2.5)
    plan = s.plan(target).collect()
    assert len(plan) == 8 and len({r.run for r in plan}) == 3
    assert s.compact(target) == 9
    same(s.read(), df)
    same(s.read(8), df)
    m = s.manifest().collect()
    assert len(m) == 3 and sum(r.rows for r in m) == 200 and all(r.bytes <= 1.5 * target and r.since == 9 for r in m)
    assert s.read(3).count() == 75
    assert s.vacuum() == 8
    same(s.read(), df)


def test_a_tier_waits_for_enough_shards(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sharding, "LEAST", 1024)
    s = store(spark, tmp_path, docs(spark, []))
    big = docs(spark, [doc(i, words(2000, i)) for i in range(20)]).coalesce(1)
    s.append(big)
    for i in range(3):
        s.append(docs(spark, [doc(1000 + i, "small")]).coalesce(1))
    assert s.compact(fanout=4) is None
    s.append(docs(spark, [doc(2000, "small")]).coalesce(1))
    assert s.compact(fanout=4) is not None
    m = sorted(r.rows for r in s.manifest().collect())
    assert m == [4, 20]


def test_two_writers(spark, tmp_path):
    df = docs(spark, [doc(1, "a"), doc(2, "b")])
    a, b = store(spark, tmp_path, df), store(spark, tmp_path, df)
    a.append(df)
    with pytest.raises(Conflict):
        b._commit(0, b.manifest(0))
    b.append(df)
    assert a.version() == 2 and a.read().count() == 4


def test_unfinished_writes_are_not_seen(spark, tmp_path):
    df = docs(spark, [doc(1, "a")])
    s = store(spark, tmp_path, df)
    s.append(df)
    s._write(df)  # a writer that was lost before its commit
    assert s.read().count() == 1


def test_no_python_runs(spark, tmp_path):
    s = shard_arrivals(docs(spark, odd_rows()), f"file://{tmp_path}/p")
    for made in (s.read(), s.plan(), s.manifest()):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
