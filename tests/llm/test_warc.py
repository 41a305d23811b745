import hashlib
import io

import pytest

from tarn.llm.warc import export_archive, parse_file, parsed_header, read_records, round_trip, write_records


def brute(rows):
    payload = [(p, (h or "").encode()) for p, _, h in rows]
    keep = {}
    for p, b in payload:
        if len(b) >= 1000 and p is not None:
            keep[b] = max(keep.get(b, p), p)
    out = []
    for p, b in payload:
        other = b in keep and keep[b] != p
        out.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if other else "response", keep[b] if other else None))
    return sorted(out, key=str)


def fixture_rows():
    big = "é<p>x\r\n\r\nWARC/1.1\r\n" * 400
    return [(1, "http://a/\r\nX: y", big), (2, None, big), (3, "u", big), (3, "u", big), (4, "u", "small"), (5, "u", "small"), (6, "u", None), (7, "u", ""), (None, "u", big), (None, None, "z" * 1000), (8, "u", "y" * 1000), (9, "v", "y" * 1000), (10, "v", "y" * 999), (11, "v", "y" * 999), (12, "w", "é" * 2_500_000)]


def test_round_trip_equals_brute_force(spark):
    rows = fixture_rows()
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, record string").repartition(4)
    assert sorted((tuple(r) for r in round_trip(df).collect()), key=str) == brute(rows)
    assert round_trip(df.limit(0)).count() == 0


def test_sample(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    assert sorted((tuple(r) for r in round_trip(df).collect()), key=str) == brute([(r.page_id, r.url, r.html) for r in df.collect()])


def test_files_and_chunks(spark):
    rows = fixture_rows()
    table = write_records(spark.createDataFrame(rows, "page_id long, url string, html string"), chunk=100, archives=2).cache()
    assert table.agg({"data": "max"}).count() == 1 and max(len(r.data) for r in table.filter("chunk > 1").collect()) <= 104
    got = []
    for k in range(2):
        out = io.BytesIO()
        assert export_archive(table, k, out) == len(out.getvalue())
        out.seek(0)
        got += list(parse_file(out, chunk=37))
    assert sorted(got, key=str) == brute(rows)
    heads = [parsed_header(bytes(r.data).split(b"\r\n\r\n")[0]) for r in table.filter("chunk = 0").collect()]
    responses = {h["warc-record-id"] for h in heads if h["warc-type"] == "response"}
    asked = [h["warc-refers-to"] for h in heads if h["warc-type"] == "revisit"]
    assert asked and set(asked) <= responses and not responses & {h["warc-record-id"] for h in heads if h["warc-type"] == "revisit"}
    with pytest.raises(Exception, match="damaged|differs|cut"):
        read_records(table.filter("chunk <> 3")).collect()
