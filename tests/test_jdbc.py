"""No database is started here: a stand-in session records what would be asked of one."""

from __future__ import annotations

import pytest

from tarnwork.sources.jdbc import (
    bounds_query,
    list_jdbc_tables,
    read_jdbc,
    read_jdbc_partitioned,
    tables_query,
    write_jdbc,
)

URL = "jdbc:postgresql://db/shop"


class Recorder:
    """Stands for a session and its reader; ``first`` answers the bounds query."""

    def __init__(self, bounds=None):
        self.bounds = bounds
        self.requests = []
        self.current = {}

    @property
    def read(self):
        self.current = {}
        return self

    write = read

    def format(self, name):
        self.current["format"] = name
        return self

    def options(self, **options):
        self.current.update(options)
        return self

    def option(self, key, value):
        self.current[key] = value
        return self

    def mode(self, mode):
        self.current["mode"] = mode
        return self

    def load(self):
        self.requests.append(self.current)
        return self

    save = load

    def first(self):
        return self.bounds


def test_table_and_query():
    session = Recorder()
    read_jdbc(session, URL, "orders", user="u", password="p")
    read_jdbc(session, URL, "select * from orders where day = 1;")
    read_jdbc(session, URL, "(select 1) t")
    assert session.requests[0] == {
        "format": "jdbc",
        "url": URL,
        "dbtable": "orders",
        "user": "u",
        "password": "p",
    }
    assert session.requests[1]["dbtable"] == "(select * from orders where day = 1) q"
    assert session.requests[2]["dbtable"] == "(select 1) t"


def test_partitioned_read_takes_bounds_from_the_same_source():
    session = Recorder(bounds=(10, 90))
    read_jdbc_partitioned(session, URL, "select id from t where d = 1", "id", 4, user="u")
    bounds, read = session.requests
    assert bounds["dbtable"] == (
        "(select min(id) as lo, max(id) as hi from (select id from t where d = 1) q) q"
    )
    assert {k: read[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "id",
        "lowerBound": "10",
        "upperBound": "90",
        "numPartitions": "4",
    }
    assert read["user"] == "u"


def test_partitioned_read_of_an_empty_table():
    session = Recorder(bounds=(None, None))
    read_jdbc_partitioned(session, URL, "t", "id", 4)
    assert "partitionColumn" not in session.requests[-1]


def test_queries():
    assert bounds_query("t", "order_id") == "select min(order_id) as lo, max(order_id) as hi from t"
    assert bounds_query("t", '"Id"').startswith('select min("Id")')
    assert tables_query() == "select tablename from pg_tables where schemaname = 'public'"
    session = Recorder()
    list_jdbc_tables(session, URL, schema="sales")
    assert "schemaname = 'sales'" in session.requests[0]["dbtable"]
    for bad in ("a; drop table t", "x'y", ""):
        with pytest.raises(ValueError):
            bounds_query("t", bad)
        with pytest.raises(ValueError):
            tables_query(bad)
    with pytest.raises(ValueError):
        read_jdbc_partitioned(Recorder(bounds=(1, 2)), URL, "t", "id", 0)


def test_write():
    session = Recorder()
    write_jdbc(session, URL, "result", driver="d")
    assert session.requests[0] == {
        "format": "jdbc",
        "url": URL,
        "dbtable": "result",
        "numPartitions": "16",
        "mode": "append",
        "driver": "d",
    }
