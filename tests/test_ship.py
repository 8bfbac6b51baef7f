import json
import threading

import pyarrow as pa
import pytest

from docbridge import WriteConfig, bulk_write
from docbridge.operators import ship, sink
from docbridge.sources.transport import ScriptedTransport, TransportError, TransportTimeout

AT = {"hosts": "http://h:1", "api_key": "k", "index": "docs"}


@pytest.fixture(autouse=True)
def no_pauses(monkeypatch):
    slept = []
    monkeypatch.setattr(ship.time, "sleep", lambda s: slept.append(s))
    return slept


def line(i, op="index"):
    head = json.dumps({op: {"_index": "docs", "_id": str(i)}})
    return head if op == "delete" else head + "\n" + json.dumps({"n": i})


def run(t, lines, **cfg):
    a = ship.ship_chunk(t, WriteConfig(**AT, **cfg), lines)
    return a, a.counts


def test_a_clean_chunk_takes_one_brief_request():
    t = ScriptedTransport()
    _, c = run(t, [line(i) for i in range(3)])
    assert c["written"] == 3 and t.requests == [(3, "errors")]


def test_any_doubt_sends_the_chunk_again_in_full():
    for said in ({"errors": True}, {}, {"errors": None}):
        t = ScriptedTransport(lambda n, a, said=said: said if n == 0 else None)
        _, c = run(t, [line(1), line(2)])
        assert c["written"] == 2 and t.requests == [(2, "errors"), (2, None)]


def test_auto_ids_are_written_twice_by_the_second_request():
    t = ScriptedTransport(lambda n, a: [None, None, 400])
    lines = [json.dumps({"index": {"_index": "docs"}}) + "\n{}"] * 3
    _, c = run(t, lines)
    assert (c["written"], c["errors"], len(t.documents)) == (2, 1, 4)
    t = ScriptedTransport(lambda n, a: [None, None, 400])
    _, c = run(t, lines, bypass_fast_path=True)
    assert (c["written"], c["errors"], len(t.documents)) == (2, 1, 2)


def test_creates_are_counted_exactly():
    t = ScriptedTransport()
    t.documents["1"] = {"n": "old"}
    a, c = run(t, [line(1, "create"), line(2, "create")], op_type="create", id_field="n")
    assert (c["written"], c["ignored"], a.diagnostics["docs_deduped"]) == (1, 1, 1) and t.documents["1"] == {"n": "old"}


def test_deletes_go_in_full():
    t = ScriptedTransport()
    t.documents["1"] = {}
    _, c = run(t, [line(1, "delete"), line(2, "delete"), line(3)], has_deletes=True, delete_flag_column="d", id_field="n")
    assert (c["deleted"], c["ignored"], c["written"]) == (1, 1, 1) and t.requests == [(3, None)]


def test_refused_documents_are_retried_alone(no_pauses):
    t = ScriptedTransport(lambda n, a: [429 if x[1] == "2" and n < 3 else 400 if x[1] == "3" else None for x in a])
    a, c = run(t, [line(1), line(2), line(3)])
    assert (c["written"], c["errors"]) == (2, 1) and [r[0] for r in t.requests] == [3, 3, 1, 1]
    assert a.diagnostics["docs_retried"] == 2 and a.diagnostics["rejected_429"] == 2 and a.diagnostics["rejected_4xx_other"] == 1
    assert no_pauses == [2, 4] and a.samples[0]["_id"] == "3"


def test_retries_end(no_pauses):
    t = ScriptedTransport(lambda n, a: [429] * len(a))
    a, c = run(t, [line(1)], max_retries_per_doc=7)
    assert c["errors"] == 1 and no_pauses == [2, 4, 8, 16, 30, 30, 30]


def test_timeouts_are_retried_only_if_asked(no_pauses):
    def script(n, a):
        if n == 0:
            raise TransportTimeout("slow")

    _, c = run(ScriptedTransport(script), [line(1)])
    assert c["errors"] == 1
    a, c = run(ScriptedTransport(script), [line(1)], retry_transport_timeout=True, bulk_stats=True)
    assert c["written"] == 1 and [s.outcome for s in a.sends] == ["timeout", "ok"]
    stats = ship.stats_of(a.sends)
    assert (stats["timeout_sends"], stats["n_sends"], stats["error_sends"]) == (1, 1, 0)


def test_a_failed_request_makes_errors_of_all_its_lines():
    def script(n, a):
        raise TransportError("gone " + "x" * 400)

    for extra in ({}, {"bypass_fast_path": True}):
        a, c = run(ScriptedTransport(script), [line(i) for i in range(5)], **extra)
        assert c["errors"] == 5 and len(a.samples) == 1 and len(a.samples[0]["reason"]) == 300


def test_lines_without_a_response_item_stay_unaccounted(spark):
    cfg = WriteConfig(**AT, bypass_fast_path=True)
    writer = ship.partition_writer(cfg, lambda: ScriptedTransport(lambda n, a: {"errors": False, "items": [{"index": {"status": 201}}]}))
    row = next(writer(iter([pa.RecordBatch.from_arrays([pa.array([line(1), line(2), line(3)])], ["_ndjson"])]))).to_pylist()[0]
    assert sink.outcome.merge([row])["unaccounted"] == 2


def test_chunks_by_count_and_bytes():
    assert [len(c) for c in ship.chunks(iter(["ab"] * 7), 3, 10**6)] == [3, 3, 1]
    assert [len(c) for c in ship.chunks(iter(["ab"] * 7), 100, 7)] == [2, 2, 2, 1]
    assert [len(c) for c in ship.chunks(iter(["a" * 50, "b", "c"]), 100, 7)] == [1, 2]


def test_no_more_in_flight_than_asked():
    gate, state = threading.Event(), {"now": 0, "most": 0}
    lock = threading.Lock()

    class Gated(ScriptedTransport):
        def bulk(self, lines, filter_path=None):
            with lock:
                state["now"] += 1
                state["most"] = max(state["most"], state["now"])
                if state["now"] == 3:
                    gate.set()
            assert gate.wait(10)
            try:
                return super().bulk(lines, filter_path)
            finally:
                with lock:
                    state["now"] -= 1

    t = Gated()
    p = ship.Pipeline(t, WriteConfig(**AT, write_concurrency=3))
    for i in range(10):
        p.feed([line(i)])
    assert p.close().counts["written"] == 10 and state["most"] == 3
    p.stop()


def test_a_null_line_stops_the_write():
    writer = ship.partition_writer(WriteConfig(**AT, id_field="n"), ScriptedTransport)
    with pytest.raises(ValueError, match="'n'"):
        next(writer(iter([pa.RecordBatch.from_arrays([pa.array([line(1), None])], ["_ndjson"])])))


def make():
    return ScriptedTransport()


def test_bulk_write_end_to_end(spark):
    df = spark.range(1000).selectExpr("id", "id * 2 v").repartition(3)
    r = bulk_write(df, WriteConfig(**AT, id_field="id", write_concurrency=2, chunk_size=50, bulk_stats=True), raise_on_error=True, transport=make)
    assert (r["written"], r["total_input"], r["unaccounted"]) == (1000, 1000, 0)
    assert len(r["bulk_stats"]) == 3 and set(r["bulk_stats"][0]) == set(ship.STAT_NAMES) and sum(s["docs_sent"] for s in r["bulk_stats"]) == 1000
    assert {"collect_ms", "merge_ms"} <= set(r)
    assert set(bulk_write(df, WriteConfig(**AT, id_field="id"), transport=make)) == {"written", "deleted", "errors", "ignored", "coerced_nonfinite", "total_input", "unaccounted", "overcounted", "error_samples"}


@pytest.mark.parametrize("bad", [{"id_field": "nope"}, {"drop_fields": ("nope",)}, {"id_field": "id", "has_deletes": True, "delete_flag_column": "nope"}, {"index": "missing"}])
def test_mistakes_are_refused_before_writing(spark, bad):
    with pytest.raises(ValueError):
        bulk_write(spark.range(3), WriteConfig(**{**AT, **bad}), transport=make)


def test_the_flag_must_be_boolean(spark):
    with pytest.raises(TypeError):
        bulk_write(spark.range(3).selectExpr("id", "'true' d"), WriteConfig(**AT, id_field="id", has_deletes=True, delete_flag_column="d"), transport=make)


def test_loose_drops_and_missing_index_can_be_allowed(spark):
    cfg = WriteConfig(**{**AT, "index": "missing"}, drop_fields=("nope",), strict_drop_fields=False, require_existing_index=False)
    assert bulk_write(spark.range(3), cfg, transport=make)["written"] == 3


def test_every_column_setting_is_checked():
    names = {f for f in WriteConfig.__dataclass_fields__ if f.endswith(("_field", "_fields", "_column"))} - {"strict_drop_fields"}
    assert names == set(sink.COLUMN_SETTINGS)


def test_stat_names_and_schema_agree():
    schema = ship.summary_schema(WriteConfig(**AT, bulk_stats=True))
    assert [x.split()[0] for x in schema.split(", ")] == [n for n, _ in ship.SUMMARY] + list(ship.STAT_NAMES) and len(ship.STAT_NAMES) == 33


def test_an_older_version_is_ignored(spark):
    made = []

    def make():
        made.append(ScriptedTransport())
        return made[-1]

    cfg = WriteConfig(**AT, id_field="id", version_field="v")
    lines = [r.line for r in ship_lines(spark, [("a", 5), ("a", 4), ("a", 5), ("b", 0)], cfg)]
    assert json.loads(lines[0].partition("\n")[0]) == {"index": {"_index": "docs", "_id": "a", "version": 5, "version_type": "external_gte"}}
    account = ship.ship_chunk(make(), cfg, lines)
    assert (account.counts["written"], account.counts["ignored"], account.counts["errors"]) == (3, 1, 0)
    assert made[0].documents["a"]["v"] == 5 and account.diagnostics["rejected_409"] == 1


def ship_lines(spark, rows, cfg):
    from docbridge.functions.encode import action_lines

    return action_lines(spark.createDataFrame(rows, "id string, v long").coalesce(1), cfg, "line").collect()
