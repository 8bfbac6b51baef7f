import json

import pytest
from pyspark.sql import functions as F

from docbridge import WriteError, reconcile_or_raise
from docbridge.operators import outcome as o
from docbridge.operators.ship import percentile

CASES = [(op, st) for op in ("index", "create", "delete") for st in (200, 201, 299, 300, 400, 404, 409, 429, 500, 503)]


def test_classification_is_the_same_twice(spark):
    df = spark.createDataFrame(CASES, "op string, st int").select("op", "st", o.classify_column(F.col("op"), F.col("st")).alias("o"), o.bucket_column(F.col("st")).alias("b"))
    for r in df.collect():
        assert (r.o, r.b) == (o.classify(r.op, r.st), o.bucket(r.st))
    assert [o.classify(*x) for x in (("delete", 200), ("delete", 404), ("create", 409), ("index", 409), ("index", 404), ("create", 201))] == ["deleted", "ignored", "ignored", "error", "error", "written"]
    assert [o.bucket(s) for s in (429, 409, 400, 404, 500, 302)] == ["rejected_429", "rejected_409", "rejected_4xx_other", "rejected_4xx_other", "rejected_5xx", "rejected_5xx"]


def test_odd_response_items():
    got = list(o.read_items([{"index": {"status": 201}}, {"index": {}}, {"delete": {"status": 0}}, {}, None, {"create": None}]))
    assert [(a, b, d) for a, b, _, d in got] == [("index", 201, "written"), ("index", 500, "error"), ("delete", 500, "error"), ("", 500, "error"), ("", 500, "error"), ("create", 500, "error")]


def test_error_samples():
    assert o.error_sample("index", 400, {"_id": "1", "error": {"type": "t", "reason": "r" * 500}}) == {"_id": "1", "op_type": "index", "status": 400, "reason": "r" * 300}
    assert o.error_sample("index", 400, {"error": {"type": "t"}})["reason"] == "t" and o.error_sample("index", 400, {"error": "text"})["reason"] == "text"


PARTS = [
    {"written": 95, "deleted": 0, "errors": 0, "ignored": 0, "total_input": 100, "error_samples": json.dumps([{"_id": i} for i in range(15)])},
    {"written": 105, "deleted": 0, "errors": 0, "ignored": 0, "total_input": 100, "error_samples": json.dumps([{"_id": i} for i in range(15)])},
    {"written": 1, "deleted": 2, "errors": 3, "ignored": 4, "total_input": 10, "error_samples": None},
]


def test_loss_and_excess_are_never_netted(spark):
    r = o.merge(PARTS)
    assert (r["unaccounted"], r["overcounted"], r["total_input"], len(r["error_samples"])) == (5, 5, 210, 20)
    assert "bulk_stats" not in r
    row = o.totals(spark.createDataFrame([{k: v for k, v in p.items() if k != "error_samples"} for p in PARTS])).first()
    assert (row.unaccounted, row.overcounted, row.written, row.errors) == (5, 5, 201, 3)
    assert o.merge([])["total_input"] == 0


def test_reconcile(caplog):
    clean = o.merge([{"written": 3, "total_input": 3}])
    assert reconcile_or_raise(clean) is clean
    for bad in ({"errors": 1}, {"unaccounted": 2}, {"errors": 1, "overcounted": 1, "unaccounted": 1}):
        with pytest.raises(WriteError) as e:
            reconcile_or_raise(clean | bad, index="i")
        assert e.value.result["total_input"] == 3 and "'i'" in str(e.value)
    assert reconcile_or_raise(clean | {"overcounted": 4}) and "4 more outcomes" in caplog.text
    assert reconcile_or_raise(clean | {"unaccounted": -2})
    assert "2 more outcomes" in caplog.text


def test_percentile_interpolates(spark):
    assert percentile([10, 1, 2], 95) == pytest.approx(9.2) and percentile([], 50) is None and percentile([4], 99) == 4
    assert spark.createDataFrame([(1.0,), (2.0,), (10.0,)], "v double").agg(F.percentile("v", 0.95)).first()[0] == pytest.approx(9.2)
