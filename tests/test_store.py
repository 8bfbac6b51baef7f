import pytest
from pyspark.sql import functions as F

from docbridge import ReadConfig, WriteConfig, WriteError, bulk_write, read_index
from docbridge.sources import store as st
from docbridge.sources.dsl import compile_query


@pytest.fixture
def store(spark, tmp_path):
    return st.DocumentStore(spark, str(tmp_path / "store"))


def cfg(store, **more):
    return WriteConfig(**{"hosts": f"store:{store.root}", "api_key": "k", "index": "docs", "id_field": "doc_id", **more})


def ids(store):
    return sorted(r._id for r in store.state("docs").collect())


def test_idempotent_upserts(spark, store):
    store.create_index("docs")
    df = spark.createDataFrame([("d1", 1), ("d2", 2), ("d3", 3)], "doc_id string, n int")
    for _ in range(2):
        assert bulk_write(df, cfg(store), raise_on_error=True)["written"] == 3
    assert ids(store) == ["d1", "d2", "d3"]
    dup = spark.createDataFrame([("u", 1), ("d1", 5), ("d1", 6)], "doc_id string, n int").coalesce(1)
    assert bulk_write(dup, cfg(store))["written"] == 3
    assert {r._id: r._source for r in store.state("docs").collect()}["d1"] == '{"doc_id":"d1","n":6}' and len(ids(store)) == 4


def test_rejected_document(spark, store):
    store.create_index("docs", {"n": "integer"})
    df = spark.createDataFrame([("ok1", "10"), ("bad1", "not-an-int")], "doc_id string, n string")
    r = bulk_write(df, cfg(store))
    assert (r["written"], r["errors"], ids(store)) == (1, 1, ["ok1"]) and r["error_samples"][0]["_id"] == "bad1"
    with pytest.raises(WriteError):
        bulk_write(df, cfg(store), raise_on_error=True)


def test_delete_routing(spark, store):
    store.create_index("docs")
    schema = "doc_id string, n int, _is_delete boolean"
    c = cfg(store, has_deletes=True, delete_flag_column="_is_delete")
    bulk_write(spark.createDataFrame([(f"k{i}", i, False) for i in range(1, 5)], schema), c)
    mixed = spark.createDataFrame([("k1", 1, True), ("k2", 2, True), ("k5", 5, False), ("k_absent", 0, True)], schema)
    r = bulk_write(mixed, c)
    assert (r["deleted"], r["written"], r["ignored"], r["errors"], ids(store)) == (2, 1, 1, 0, ["k3", "k4", "k5"])
    again = bulk_write(spark.createDataFrame([("k1", 1, True)], schema), c)
    assert (again["ignored"], again["deleted"]) == (1, 0)
    assert "_is_delete" not in store.state("docs").first()._source


def test_create_appends_only(spark, store):
    store.create_index("docs")
    c = cfg(store, op_type="create")
    first = spark.createDataFrame([(str(i), "orig") for i in range(5)], "doc_id string, v string")
    assert bulk_write(first, c)["written"] == 5
    changed = first.withColumn("v", F.lit("CHANGED"))
    assert bulk_write(changed, c)["ignored"] == 5
    more = changed.unionAll(spark.createDataFrame([("9", "new"), ("9", "new2")], "doc_id string, v string"))
    r = bulk_write(more, c)
    assert (r["written"], r["ignored"]) == (1, 6)
    assert sum("CHANGED" in x._source for x in store.state("docs").collect()) == 0


@pytest.mark.parametrize(
    "ops,want",
    [(["bad", "delete"], [400, 404]), (["index", "delete", "delete"], [201, 200, 404]), (["delete", "index", "index"], [404, 201, 200]), (["create", "create", "delete", "create"], [201, 409, 200, 201]), (["index", "bad", "delete"], [201, 400, 200])],
)
def test_actions_take_effect_in_order(spark, ops, want):
    rows = [(i, "index" if o == "bad" else o, "x", '{"n":"no"}' if o == "bad" else '{"n":1}') for i, o in enumerate(ops)]
    actions = spark.createDataFrame(rows, "_seq long, _op string, _id string, _source string")
    empty = spark.createDataFrame([], st.STATE)
    state, outcomes = st.apply_actions(empty, actions, {"n": "integer"})
    assert [r.status for r in outcomes.orderBy("_seq").collect()] == want
    good = [o for o, s in zip(ops, want) if s < 300]
    assert state.count() == (good[-1:] not in ([], ["delete"]))
    full = spark.createDataFrame([("x", "{}")], st.STATE)
    _, outcomes = st.apply_actions(full, spark.createDataFrame([(0, "delete", "x", None)], "_seq long, _op string, _id string, _source string"))
    assert outcomes.first().status == 200


def test_snapshots_do_not_move(spark, store):
    store.create_index("docs", shards=2)
    bulk_write(spark.createDataFrame([("a", 1)], "doc_id string, n int"), cfg(store))
    read = read_index(spark, ReadConfig(hosts=f"store:{store.root}", api_key="k", index="docs", id_field="doc_id"), spark.createDataFrame([], "doc_id string, n bigint").schema)
    bulk_write(spark.createDataFrame([("b", 2)], "doc_id string, n int"), cfg(store))
    assert [tuple(r) for r in read.collect()] == [("a", 1)] and len(ids(store)) == 2


def test_null_ids_write_nothing(spark, store):
    store.create_index("docs")
    with pytest.raises(ValueError):
        bulk_write(spark.createDataFrame([("a", 1), (None, 2)], "doc_id string, n int"), cfg(store))
    assert ids(store) == [] and not store.exists("other")
    with pytest.raises(ValueError):
        bulk_write(spark.range(1).selectExpr("'a' doc_id"), cfg(store, index="other"))


def test_two_writers_of_one_version(spark, store):
    store.create_index("docs")
    with pytest.raises(RuntimeError):
        store._commit("docs", 0, store.state("docs"), {"mapping": {}, "shards": 1})


def test_the_indexed_plane(spark, store):
    store.create_index("docs", {"score": "long", "tag": "keyword"})
    df = spark.createDataFrame([("a", 10.0, "t"), ("b", 10.7, "x" * 300), ("c", -1.5, "u")], "doc_id string, score double, tag string")
    bulk_write(df, cfg(store))
    assert store.state("docs").agg(F.sum(st.indexed_value("score", "long"))).first()[0] == 19
    assert store.query("docs", {"term": {"score": 10}}).count() == 2
    assert store.query("docs", {"term": {"tag": "x" * 300}}).count() == 0


def test_query_forms(spark):
    df = spark.createDataFrame([(1, "alpha beta", 5.0), (2, "Beta gamma", None), (3, None, 7.5)], "id int, t string, v double")
    run = lambda q: sorted(r.id for r in df.where(compile_query(q, F.col, F.col("id").cast("string"))).collect())
    assert run(None) == run({"match_all": {}}) == [1, 2, 3] and run({"match_none": {}}) == []
    assert run({"term": {"id": {"value": 2}}}) == [2] and run({"terms": {"id": [1, 3]}}) == [1, 3] and run({"terms": {"id": []}}) == []
    assert run({"range": {"v": {"gt": 5, "lte": 7.5}}}) == [3] and run({"exists": {"field": "t"}}) == [1, 2]
    assert run({"match": {"t": "beta delta"}}) == [1, 2] and run({"match": {"t": {"query": "beta gamma", "operator": "and"}}}) == [2]
    assert run({"prefix": {"t": "al"}}) == [1] and run({"wildcard": {"t": "B?ta*"}}) == [2] and run({"ids": {"values": ["3"]}}) == [3]
    assert run({"bool": {"must_not": [{"exists": {"field": "v"}}]}}) == [2]
    assert run({"bool": {"should": [{"term": {"id": 1}}, {"term": {"id": 3}}]}}) == [1, 3]
    assert run({"bool": {"filter": {"match_all": {}}, "should": [{"term": {"id": 1}}]}}) == [1, 2, 3]
    for bad in ({"fuzzy": {}}, {"term": {}, "terms": {}}, {"range": {"v": {"near": 1}}}, {"bool": {"mast": []}}):
        with pytest.raises(ValueError):
            run(bad)


def test_numbers_against_fields_without_a_type(spark, store):
    store.create_index("docs")
    bulk_write(spark.createDataFrame([("a", "5"), ("b", "word"), ("c", "7.5"), ("d", None), ("e", "9007199254740993")], "doc_id string, v string"), cfg(store))
    run = lambda q: sorted(r._id for r in store.query("docs", q).collect())
    assert run({"term": {"v": 5}}) == ["a"] and run({"range": {"v": {"gt": 5, "lt": 10}}}) == ["c"]
    assert run({"terms": {"v": [5, "word"]}}) == ["a", "b"] and run({"term": {"v": 9007199254740993}}) == ["e"]
    assert run({"terms": {"v": [5, 9007199254740992]}}) == ["a"] and run({"term": {"v": True}}) == []


def test_late_versions_are_ignored(spark, store):
    store.create_index("docs", {"n": "integer"})
    c = cfg(store, version_field="v")
    schema = "doc_id string, v long, n string"
    one = spark.createDataFrame([("a", 5, "1"), ("a", 4, "2"), ("b", 1, "3"), ("bad", 9, "x")], schema).coalesce(1)
    r = bulk_write(one, c)
    assert (r["written"], r["ignored"], r["errors"]) == (2, 1, 1)
    two = spark.createDataFrame([("a", 4, "4"), ("b", 1, "5"), ("c", 0, "6"), ("bad", 1, "7")], schema).coalesce(1)
    r = bulk_write(two, c)
    assert (r["written"], r["ignored"], r["errors"]) == (3, 1, 0)
    held = {x._id: x._source for x in store.state("docs").collect()}
    assert sorted(held) == ["a", "b", "bad", "c"] and '"n":"1"' in held["a"] and '"n":"5"' in held["b"]
    bulk_write(spark.createDataFrame([("d", "8")], "doc_id string, n string"), cfg(store))
    assert bulk_write(two, c)["ignored"] == 1  # versions outlast writes without one
    with pytest.raises(ValueError):
        bulk_write(spark.createDataFrame([("a", None, "1")], schema), c)
    with pytest.raises(ValueError):
        cfg(store, version_field="v", op_type="create")
