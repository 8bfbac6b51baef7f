import pytest

from docbridge import ReadConfig, WriteConfig, WriteError, make_foreach_batch, read_index
from docbridge.sources.store import DocumentStore
from docbridge.sources.transport import ScriptedTransport
from docbridge.streaming.sink import latest_per_key

AT = {"hosts": "http://x", "api_key": "k", "index": "docs"}


def refusing():
    return ScriptedTransport(lambda n, a: [400] * len(a))


def test_policies(spark, caplog):
    seen = []
    df = spark.range(2)
    for policy in ("log", "ignore"):
        make_foreach_batch(WriteConfig(**AT), lambda r, i: seen.append((r["errors"], i)), policy, transport=refusing)(df, 7)
    assert seen == [(2, 7), (2, 7)] and caplog.text.count("did not wholly succeed") == 1
    with pytest.raises(WriteError):
        make_foreach_batch(WriteConfig(**AT), lambda r, i: seen.append(i), transport=refusing)(df, 8)
    assert seen[-1] == 8
    with pytest.raises(ValueError):
        make_foreach_batch(WriteConfig(**AT), on_error="shrug")


def test_empty_batches_are_not_written(spark):
    def never():
        raise AssertionError

    seen = []
    make_foreach_batch(WriteConfig(**AT), lambda r, i: seen.append(r), transport=never)(spark.range(0), 1)
    assert seen[0]["empty"] and seen[0]["written"] == 0 and "error_samples" in seen[0]


def test_restarts_write_each_row_once(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "store"))
    store.create_index("docs")
    cfg = WriteConfig(hosts=f"store:{store.root}", api_key="k", index="docs", id_field="doc_id")
    schema = "doc_id string, n int"
    src = str(tmp_path / "in")

    def drain():
        stream = spark.readStream.schema(schema).parquet(src).writeStream.foreachBatch(make_foreach_batch(cfg))
        stream.option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination()
        read = ReadConfig(hosts=f"store:{store.root}", api_key="k", index="docs")
        return sorted(r.doc_id for r in read_index(spark, read, spark.createDataFrame([], schema).schema).collect())

    spark.createDataFrame([("s1", 1), ("s2", 2), ("s3", 3)], schema).write.mode("append").parquet(src)
    assert drain() == ["s1", "s2", "s3"]
    spark.createDataFrame([("s4", 4), ("s5", 5)], schema).write.mode("append").parquet(src)
    assert len(drain()) == 5 and len(drain()) == 5


def test_latest_change_of_each_key(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, 5), ("a", 3, 4), ("b", 1, None)], "k string, v int, ts int")
    got = latest_per_key(df, "k", "ts", "v")
    assert sorted((r.k, r.v) for r in got.collect()) == [("a", 2), ("b", 1)]
