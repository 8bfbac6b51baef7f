import dataclasses
import inspect
import pickle

import pytest

from docbridge import Config, Connection, ReadConfig, WriteConfig

AT = {"hosts": "http://localhost:9200", "api_key": "k"}


def test_connection_is_checked():
    assert Connection(**AT).hosts == ("http://localhost:9200",)
    for bad in ({"hosts": ()}, {"api_key": None}, {"basic_auth": ("u", "p")}, {"ca_certs": "x", "verify_certs": False}, {"transport_max_retries": -1}):
        with pytest.raises(ValueError):
            Connection(**{**AT, **bad})
    assert Connection(hosts="h", basic_auth=("u", "p")).client_kwargs()["basic_auth"] == ("u", "p")


@pytest.mark.parametrize(
    "bad",
    [{"index": ""}, {"chunk_size": 0}, {"chunk_bytes": 0}, {"write_concurrency": 0}, {"max_retries_per_doc": -1}, {"retry_on_doc_status": ()}, {"has_deletes": True}, {"delete_flag_column": "d"},
     {"has_deletes": True, "delete_flag_column": "d"}, {"op_type": "update"}, {"op_type": "create"}, {"op_type": "create", "id_field": "i", "has_deletes": True, "delete_flag_column": "d"}],
)
def test_write_settings_are_checked(bad):
    with pytest.raises(ValueError):
        WriteConfig(**{**AT, "index": "i", **bad})


def test_defaults_and_aliases():
    c = WriteConfig(**AT, index="i")
    assert (c.chunk_size, c.write_concurrency, c.max_retries_per_doc, c.retry_on_doc_status, c.op_type) == (500, 1, 3, (429,), "index")
    assert Config is WriteConfig and pickle.loads(pickle.dumps(c)) == c
    with pytest.raises(dataclasses.FrozenInstanceError):
        c.index = "j"
    r = ReadConfig(**AT, index="i")
    assert (r.batch_size, r.pit_keep_alive, r.include_id, r.strict_slices, r.num_slices) == (1000, "5m", True, True, None)
    for bad in ({"num_slices": 0}, {"batch_size": 0}):
        with pytest.raises(ValueError):
            ReadConfig(**AT, index="i", **bad)


def test_one_number_for_all_retries():
    c = WriteConfig(**AT, index="i", max_retries=7)
    assert (c.transport_max_retries, c.max_retries_per_doc, c.max_retries) == (7, 7, 7)
    assert WriteConfig(**AT, index="i", transport_max_retries=1).max_retries is None
    assert Connection(**AT, max_retries=2).transport_max_retries == 2
    with pytest.raises(ValueError):
        WriteConfig(**AT, index="i", max_retries=1, max_retries_per_doc=1)
    assert "max_retries" in inspect.signature(WriteConfig).parameters
    assert "max_retries" not in WriteConfig.__dataclass_fields__


def test_a_useless_combination_warns():
    with pytest.warns(UserWarning):
        WriteConfig(**AT, index="i", max_retries_per_doc=0, transport_max_retries=9)


def test_client_arguments():
    k = WriteConfig(**AT, index="i", write_concurrency=4, retry_transport_timeout=True).client_kwargs()
    assert k["connections_per_node"] == 4 and k["retry_on_timeout"] is False
    assert "connections_per_node" not in WriteConfig(**AT, index="i").client_kwargs()
