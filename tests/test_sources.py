"""Parsers on small invented files of the FIXTURES.md shapes."""

import os

from kindling.sources.delimited import (
    read_customer_orders, read_items, read_people, read_points, read_ratings, read_weather,
)
from kindling.sources.sinks import describe_schema
from kindling.sources.text import read_adjacency, read_lines, read_quoted_names, read_stopwords
from tests.conftest import rows


def _write(tmp_path, name, data: bytes):
    p = os.path.join(tmp_path, name)
    with open(p, "wb") as f:
        f.write(data)
    return p


def test_people_crlf(spark, tmp_path):
    p = _write(tmp_path, "people.csv", b"0,Oda,51,17\r\n1,Per-Ivar,19,240\r\n")
    assert rows(read_people(spark, p)) == [(0, "Oda", 51, 17), (1, "Per-Ivar", 19, 240)]


def test_ratings_tab_and_double_colon(spark, tmp_path):
    p = _write(tmp_path, "r.tsv", b"8\t30\t4\t900000001\n9\t30\t3\t900000002\n")
    assert rows(read_ratings(spark, p), "user", "item", "rating") == [(8, 30, 4.0), (9, 30, 3.0)]
    q = _write(tmp_path, "r.dat", b"8::30::4::900000003\n")
    assert rows(read_ratings(spark, q, sep="::"), "user", "item", "rating") == [(8, 30, 4.0)]


def test_items_drop_short_rows_and_replace_bad_bytes(spark, tmp_path):
    p = _write(tmp_path, "items", b"1|Lamp (blue)|x\n2\n3|Caf\xe9|y\n")
    got = dict(rows(read_items(spark, p)))
    assert set(got) == {1, 3}
    assert got[3].startswith("Caf") and "�" in got[3]


def test_weather_and_orders_projection(spark, tmp_path):
    w = _write(tmp_path, "w.csv", b"XX000000001,19990605,TMAX,212,,,Q,\nXX000000001,19990605,TMIN,-31,,,Q,\n")
    assert rows(read_weather(spark, w)) == [("XX000000001", "TMAX", 212.0), ("XX000000001", "TMIN", -31.0)]
    o = _write(tmp_path, "o.csv", b"12,700,9.25\n3,701,40.5\n")
    assert rows(read_customer_orders(spark, o)) == [(3, 40.5), (12, 9.25)]


def test_points(spark, tmp_path):
    p = _write(tmp_path, "pts", b"-0.25,0.75\r\n2.5,-3.5\r\n")
    assert rows(read_points(spark, p)) == [(-0.25, 0.75), (2.5, -3.5)]


def test_adjacency_id_spans_lines(spark, tmp_path):
    p = _write(tmp_path, "g.txt", b"31 12 14  18 \n31 40\n7 7\n9\n")
    assert rows(read_adjacency(spark, p)) == [(7, 7), (31, 12), (31, 14), (31, 18), (31, 40)]


def test_quoted_names(spark, tmp_path):
    p = _write(tmp_path, "n.txt", b'1 "ALDA/OF THE HILL"\n2 "9-LIVES BEN"\nbroken line\n7000 "X"\n')
    assert rows(read_quoted_names(spark, p, max_id=6487)) == [(1, "ALDA/OF THE HILL"), (2, "9-LIVES BEN")]


def test_stopwords_and_lines(spark, tmp_path):
    p = _write(tmp_path, "stop.csv", b"zig\nzag\nnor\nzig")
    assert rows(read_stopwords(spark, p)) == [("nor",), ("zag",), ("zig",)]
    assert read_lines(spark, p).columns == ["line"]


def test_describe_schema(spark):
    df = spark.createDataFrame([(1, "x")], "id BIGINT, name STRING")
    assert rows(describe_schema(df), "position", "column_name", "data_type") == [(0, "id", "bigint"), (1, "name", "string")]
