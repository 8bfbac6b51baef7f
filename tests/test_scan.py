import gzip
import json
import threading
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import _parse_datatype_string as schema_of

from docbridge import ReadConfig, ReadSchemaMismatch, WriteConfig, bulk_write, read_index
from docbridge.plans.catalogue import read_config_json
from docbridge.sources import scan
from docbridge.sources.transport import HttpTransport, ScriptedTransport, TransportError


def loaded(n=50):
    t = ScriptedTransport()
    t.documents = {f"m{i:03}": {"doc_id": f"m{i:03}", "n": i} for i in range(n)}
    return t


def test_paging_follows_the_snapshot():
    t, seen = loaded(), []
    search = t.search
    t.search = lambda body: seen.append(body) or search(body) | {"pit_id": f"pit{len(seen)}"}
    pages = list(scan.page_through(t, "pit", {"match_all": {}}, 5, "1m", None))
    assert len(pages) == 10 and sum(map(len, pages)) == 50
    assert [b["pit"]["id"] for b in seen[:3]] == ["pit", "pit1", "pit2"] and all(b["pit"]["keep_alive"] == "1m" for b in seen)
    assert "slice" not in seen[0] and "search_after" not in seen[0] and seen[1]["search_after"] == pages[0][-1]["sort"]


def test_slices_cover_everything(spark):
    cfg = ReadConfig(hosts="http://x", api_key="k", index="docs", num_slices=3, batch_size=7)
    df = read_index(spark, cfg, schema_of("doc_id string, n int"), transport=loaded)
    assert df.rdd.getNumPartitions() == 3 and sorted(r.n for r in df.collect()) == list(range(50))
    assert scan.slices(1) == [None]


def test_an_unknown_number_of_shards(spark, caplog):
    class NoShards(ScriptedTransport):
        def shard_count(self, index):
            raise TransportError("no")

    loose = ReadConfig(hosts="http://x", api_key="k", index="docs", strict_slices=False)
    assert scan.open_snapshot(loose, NoShards)[1] == 1 and "one slice" in caplog.text
    with pytest.raises(TransportError):
        scan.open_snapshot(ReadConfig(hosts="http://x", api_key="k", index="docs"), NoShards)


def test_mistakes_are_refused_before_reading(spark):
    def never():
        raise AssertionError("connected")

    cfg = ReadConfig(hosts="http://x", api_key="k", index="docs")
    with pytest.raises(ReadSchemaMismatch):
        read_index(spark, cfg, schema_of("m map<int,string>"), transport=never)
    with pytest.raises(ValueError):
        read_index(spark, ReadConfig(hosts="http://x", api_key="k"), schema_of("m int"), transport=never)


class Stub(BaseHTTPRequestHandler):
    """A tiny index server: bulk, settings, snapshots and searches of one index."""

    store = loaded()
    bodies: list = []

    def log_message(self, *a):
        pass

    def _answer(self, value, status=200):
        data = gzip.compress(json.dumps(value).encode())
        self.send_response(status)
        self.send_header("Content-Encoding", "gzip")
        self.send_header("Content-Length", str(0 if self.command == "HEAD" else len(data)))
        self.end_headers()
        if self.command != "HEAD":
            self.wfile.write(data)

    def do_HEAD(self):
        self._answer({}, 200 if self.path == "/docs" else 404)

    def do_GET(self):
        self._answer({"docs": {"settings": {"index": {"number_of_shards": "3"}}}})

    def do_POST(self):
        raw = self.rfile.read(int(self.headers.get("Content-Length") or 0))
        if raw and self.headers.get("Content-Encoding") == "gzip":
            raw = gzip.decompress(raw)
        if self.headers["Authorization"] != "ApiKey k":
            return self._answer({"error": "who"}, 401)
        if "/_pit" in self.path:
            return self._answer({"id": "pit"})
        if self.path == "/_search":
            body = json.loads(raw)
            Stub.bodies.append(body)
            return self._answer(self.store.search(body))
        parts, out = raw.decode().splitlines(), []
        while parts:
            head = parts.pop(0)
            out.append(head if '"delete"' in head[:10] else head + "\n" + parts.pop(0))
        path = self.path.partition("filter_path=")[2] or None
        return self._answer(self.store.bulk(out, path))


@pytest.fixture(scope="module")
def server():
    s = ThreadingHTTPServer(("127.0.0.1", 0), Stub)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def test_over_http(spark, server):
    cfg = WriteConfig(hosts=server, api_key="k", index="docs", id_field="doc_id")
    df = spark.range(20).selectExpr("concat('w', id) doc_id", "cast(100 + id as int) n")
    assert bulk_write(df, cfg, raise_on_error=True)["written"] == 20
    read = ReadConfig(hosts=server, api_key="k", index="docs", id_field="doc_id", batch_size=9)
    back = read_index(spark, read, schema_of("doc_id string, n int"))
    assert back.rdd.getNumPartitions() == 3 and back.count() == 70
    with pytest.raises(ValueError):
        bulk_write(df, WriteConfig(hosts=server, api_key="k", index="other"))
    with pytest.raises(TransportError, match="401"):
        HttpTransport(ReadConfig(hosts=server, api_key="wrong")).open_pit("docs", "1m")
    with pytest.raises(TransportError):
        HttpTransport(ReadConfig(hosts="http://127.0.0.1:1", api_key="k", transport_max_retries=0)).bulk(["{}"])


def test_the_data_source(spark, server):
    scan.register(spark)
    cfg = ReadConfig(hosts=server, api_key="k", index="docs", batch_size=11)
    df = spark.read.format("docindex").option("config", read_config_json(cfg)).load()
    assert df.columns == ["_id", "_source"] and df.where(F.col("_id").startswith("m")).count() == 50
    Stub.bodies.clear()
    assert df.where("_id is not null").count() >= 50
    assert Stub.bodies[0]["query"] == {"match_all": {}}  # metadata is not indexed as a field
    Stub.bodies.clear()
    declared = spark.read.format("docindex").schema("doc_id string, n int").option("config", read_config_json(cfg)).load()
    assert declared.where("n > 40").count() == sum(r.n > 40 for r in declared.collect()) > 8
    assert {"range": {"n": {"gt": 40}}} in next(b["query"]["bool"]["filter"] for b in Stub.bodies if "bool" in b.get("query", {}))
    with pytest.raises(Exception, match="read_index"):
        spark.read.format("docindex").option("config", read_config_json(ReadConfig(hosts="store:x", api_key="k", index="docs"))).load().count()


def test_filters_that_an_index_answers_exactly():
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNotNull

    assert scan.filter_to_query(EqualTo(("n",), 5)) == {"term": {"n": 5}}
    assert scan.filter_to_query(GreaterThan(("n",), 5)) == {"range": {"n": {"gt": 5}}}
    assert scan.filter_to_query(In(("n",), (1, 2))) == {"terms": {"n": [1, 2]}}
    assert scan.filter_to_query(IsNotNull(("n",))) == {"exists": {"field": "n"}}
    assert scan.filter_to_query(IsNotNull(("_source",))) is None and scan.filter_to_query(EqualTo(("_id",), 5)) is None
    assert scan.filter_to_query(EqualTo(("s",), "text")) is None and scan.filter_to_query(EqualTo(("a", "b"), 1)) is None


def test_requests_wait_for_a_connection():
    assert HttpTransport(WriteConfig(hosts="http://h:1", api_key="k", index="docs", write_concurrency=3)).slots._value == 3
    assert HttpTransport(ReadConfig(hosts="http://h:1", api_key="k", index="docs")).slots._value == 10
