import gzip
import hashlib

from salesmart.llm.warc import assemble, page_captures, parse_archive, read_records, write_archives
from salesmart.session import new_run_dir

TRICKY = "before\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 3


def _pages():
    big = "<p>" + "é" * 120 + "</p>"
    return [(1, "http://a.org/x?q=1#f", big), (2, "http://b.org/", big), (3, None, big), (4, "http://c.org", None), (5, "x y\r\nz", ""),
            (6, "http://d.org/", TRICKY), (7, "http://d.org/", "short"), (8, "http://d.org/", "short"), (None, "http://e.org/", big),
            (9, "http://f.org/", "z" * 300_000), (10, "http://g.org/", "same"), (10, "http://g.org/", "same"),
            *[(100 + k, f"http://h.org/{k}", "hot page " * 30) for k in range(60)]]


def test_round_trip_and_revisits(spark):
    pages = _pages()
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], "page_id long, url string, html string, digest string, key string")
    path = new_run_dir(spark, "warc-test")
    write_archives(frame.repartition(5), path)
    records = read_records(spark, path)
    assert records.count() == 3 * len(pages)
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in page_captures(assemble(records)).collect()), key=str)
    want = []
    for page_id, _, html in pages:
        body = (html or "").encode()
        same = [p for p, _, h in pages if (h or "").encode() == body and p is not None]
        revisit = len(body) >= 100 and page_id != min(same)
        want.append((page_id, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response",
                     min(same) if revisit else None))
    assert got == sorted(want, key=str)
    payloads = {bytes(r.payload).decode() for r in records.where("type = 'response'").collect()}
    assert payloads == {h or "" for _, _, h in pages}
    narrow = page_captures(assemble(read_records(spark, path, payloads=False)))
    assert sorted((tuple(r)[:5] for r in narrow.collect()), key=str) == got


def test_shuffled_join_of_repeated_digests_is_the_same(spark, monkeypatch):
    import salesmart.llm.warc as module
    frame = spark.createDataFrame(_pages(), "page_id long, url string, html string")
    results = []
    for bound in (100_000, 0):
        monkeypatch.setattr(module, "BROADCAST_DIGESTS", bound)
        path = new_run_dir(spark, "warc-test")
        write_archives(frame, path)
        results.append(sorted((tuple(r) for r in page_captures(assemble(read_records(spark, path))).collect()), key=str))
    assert results[0] == results[1]


def test_assembly_in_every_direction(spark):
    rows = [("<a>", "response", "u", [], None), ("<a-req>", "request", "u", ["<a>"], None),
            ("<a-meta>", "metadata", "u", ["<a-req>"], None),              # over the request
            ("<b-req>", "request", "v", [], None), ("<b>", "response", "v", ["<b-req>"], None),  # named by the response
            ("<lone>", "request", "w", ["<gone>"], None),
            ("<m1>", "metadata", "x", [], None), ("<q1>", "request", "x", ["<m1>", "<r1>"], None),  # the response comes second
            ("<r1>", "response", "x", [], None),
            ("<c4>", "metadata", "y", ["<c3>"], None), ("<c3>", "metadata", "y", ["<c2>"], None),    # over three records
            ("<c2>", "request", "y", ["<c1>"], None), ("<c1>", "metadata", "y", ["<c0>"], None), ("<c0>", "revisit", "y", [], None),
            ("<n1>", "metadata", "z", ["<n0>", "<n1>"], None), ("<n0>", "request", "z", None, None),  # no response at all
            ("<o1>", "metadata", "z", ["<o2>"], None), ("<o2>", "request", "z", ["<o1>"], None),     # a circle
            (None, "metadata", "x", ["<r1>"], None)]
    schema = ("record_id string, type string, target_uri string, concurrent_to array<string>, refers_to string")
    frame = spark.createDataFrame(rows, schema).selectExpr(
        "*", "'d' AS payload_digest", "3L AS payload_bytes", "CAST(NULL AS binary) AS payload",
        "CAST(array() AS array<struct<name: string, value: string>>) AS fields")
    got = {r.capture_id: r for r in assemble(frame).collect()}
    assert [x.record_id for x in got["<a>"].requests] == ["<a-req>"] and [x.record_id for x in got["<a>"].metadata] == ["<a-meta>"]
    assert [x.record_id for x in got["<b>"].requests] == ["<b-req>"] and got["<b>"].response.record_id == "<b>"
    assert got["<gone>"].response is None and [x.record_id for x in got["<gone>"].requests] == ["<lone>"]
    assert [x.record_id for x in got["<r1>"].requests] == ["<q1>"] and [x.record_id for x in got["<r1>"].metadata] == [None, "<m1>"]
    assert [x.record_id for x in got["<c0>"].requests] == ["<c2>"] and got["<c0>"].response.type == "revisit"
    assert [x.record_id for x in got["<c0>"].metadata] == ["<c1>", "<c3>", "<c4>"]
    assert got["<n0>"].response is None and got["<n0>"].requests and [x.record_id for x in got["<n0>"].metadata] == ["<n1>"]
    assert {"<o1>", "<o2>"} <= set(got) and len(got) == 8


def test_parser_reads_plain_and_member_gzip_and_rejects_cut_files():
    one = b"WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <r>\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
    plain = list(parse_archive(one + one))
    assert plain == list(parse_archive(gzip.compress(one) + gzip.compress(one))) and len(plain) == 2
    assert plain[0][7] == b"\r\n\r\n"
    for bad in (one[:-6], b"garbage\r\n"):
        try:
            list(parse_archive(bad))
        except ValueError:
            continue
        raise AssertionError("a broken archive was read")


def test_empty_table(spark):
    path = new_run_dir(spark, "warc-test")
    write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert page_captures(assemble(read_records(spark, path))).isEmpty()
