import base64
import glob
import gzip
import hashlib
import os
import re

import pytest

from inkspan.llm import warc

PAGES = "page_id long, url string, html string"


def pages(spark, rows, extra=""):
    return spark.createDataFrame(rows, PAGES + extra)


def written_rows(folder):
    out = []
    for path in sorted(glob.glob(f"{folder}/**/*.warc.gz", recursive=True)):
        raw = gzip.decompress(open(path, "rb").read())
        at = 0
        while at < len(raw):
            head, rest = raw[at:].split(b"\r\n\r\n", 1)
            fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
            n = int(fields["Content-Length"])
            out.append((fields, rest[:n]))
            assert rest[n : n + 4] == b"\r\n\r\n"
            at += len(head) + 4 + n + 4
    return out


def test_archives_hold_each_payload_once_and_round_trip(spark, rng, tmp_path):
    rows = [(i, f"https://h/{i}", f"<p>{rng.randrange(30)} é</p>" * 20) for i in range(200)]
    folder = f"file://{tmp_path}/a"
    manifest = warc.write_archives(warc.records(pages(spark, rows).repartition(3)), folder).collect()
    found = written_rows(f"{tmp_path}/a")
    assert len(found) == len(manifest) == 200
    first = {}
    for i, _, h in rows:
        first.setdefault(hashlib.sha256(h.encode()).hexdigest(), i)
    by_id = {f["WARC-Record-ID"]: (f, b) for f, b in found}
    for f, block in found:
        i, digest = int(f["WARC-Source-Page"]), f["WARC-Payload-Digest"].split(":")[1]
        assert (f["WARC-Type"] == "response") == (first[digest] == i)
        if f["WARC-Type"] == "response":
            assert block.split(b"\r\n\r\n", 1)[1].decode() == rows[i][2]
        else:
            of, payload = by_id[f["WARC-Refers-To"]]
            assert of["WARC-Type"] == "response" and int(of["WARC-Source-Page"]) == first[digest] and f["WARC-Refers-To-Target-URI"] == of["WARC-Target-URI"]
    for m in manifest:
        with open(f"{tmp_path}/a/{m.archive}", "rb") as fh:
            fh.seek(m.offset)
            assert m.record_id in gzip.decompress(fh.read(m.size)).decode()
    back = warc.read_archives(spark, folder)
    again = warc.write_archives(back, f"file://{tmp_path}/b")
    key = lambda r: (r.page_id, r.warc_type, r.target_uri, r.payload_digest, r.record_id, r.refers_to, r.content_length)
    assert sorted(map(key, again.collect()), key=str) == sorted(map(key, manifest), key=str)


def sha1(body):
    return "sha1:" + base64.b32encode(hashlib.sha1(body).digest()).decode()


def record(kind, i, block, uri="https://h/x", **fields):
    lines = {"WARC-Type": kind, "WARC-Record-ID": f"<urn:uuid:{i:032x}>", "WARC-Date": f"2020-02-03T04:05:{i:02d}Z", "WARC-Target-URI": uri, "Content-Type": "application/http; msgtype=response"} | {k.replace("_", "-"): v for k, v in fields.items()} | {"Content-Length": str(len(block))}
    return ("WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in lines.items() if v is not None) + "\r\n").encode() + block + b"\r\n\r\n"


def test_foreign_archives_lose_nothing(spark, tmp_path):
    gone = b"HTTP/1.1 404 Not Found\r\nContent-Type: application/pdf\r\nX-A: 1\r\n\r\n"
    found = b"HTTP/1.0 200 OK\r\nServer: s\r\n\r\n"
    bodies = [b"one", b"two", b"three", b"four"]
    plain = b"".join(record("response", i, gone + b, WARC_IP_Address="1.2.3.4") for i, b in enumerate(bodies))
    plain += record("warcinfo", 10, b"software: x\r\n", Content_Type="application/warc-fields") + record("request", 11, b"GET / HTTP/1.1\r\n\r\n") + record("response", 12, b"20200101 1.1.1.1", uri="dns:h", Content_Type="text/dns")
    plain += record("response", 13, found + b"part", WARC_Segment_Number="1")
    zipped = gzip.compress(record("revisit", 20, gone, uri="https://h/again", WARC_Payload_Digest=sha1(b"two"), WARC_Profile="p:x")) + b"\0\0" + gzip.compress(record("revisit", 21, b"", WARC_Payload_Digest="md5:00", WARC_Refers_To="<urn:x>", WARC_Profile="p:y"))
    zipped += gzip.compress(record("response", 22, found + b"three") + record("response", 22, found + b"three"))
    os.makedirs(f"{tmp_path}/in/deep")
    open(f"{tmp_path}/in/a.warc", "wb").write(plain)
    open(f"{tmp_path}/in/deep/b.warc.gz", "wb").write(zipped)
    folder = f"file://{tmp_path}/in"
    # into the folder that is read
    warc.write_archives(warc.read_archives(spark, folder), folder)
    assert open(f"{tmp_path}/in/a.warc", "rb").read() == plain and open(f"{tmp_path}/in/deep/b.warc.gz", "rb").read() == zipped
    got = {f["WARC-Record-ID"][-3:-1]: (f, b) for f, b in written_rows(f"{tmp_path}/in/run-" + next(x for x in os.listdir(f"{tmp_path}/in") if x.startswith("run-"))[4:])}
    assert len(got) == 11
    for i, b in enumerate(bodies):
        f, block = got[f"0{i}"]
        assert f["WARC-Type"] == "response" and block == gone + b and f["WARC-Date"].endswith(f"0{i}Z") and f["WARC-IP-Address"] == "1.2.3.4" and f["WARC-Payload-Digest"] == "sha256:" + hashlib.sha256(b).hexdigest()
    assert got["0a"][0]["WARC-Type"] == "warcinfo" and got["0a"][1] == b"software: x\r\n" and got["0b"][1].startswith(b"GET /") and got["0c"][0]["Content-Type"] == "text/dns" and got["0c"][1] == b"20200101 1.1.1.1"
    assert got["0d"][0]["WARC-Segment-Number"] == "1" and got["0d"][1] == found + b"part"
    f, block = got["14"]
    assert f["WARC-Refers-To"] == got["01"][0]["WARC-Record-ID"] and f["WARC-Refers-To-Date"] == got["01"][0]["WARC-Date"] and f["WARC-Payload-Digest"] == got["01"][0]["WARC-Payload-Digest"] and block == gone
    assert got["15"][0]["WARC-Refers-To"] == "<urn:x>" and got["15"][0]["WARC-Payload-Digest"] == "md5:00" and got["15"][0]["WARC-Profile"] == "p:y"
    f, block = got["16"]
    assert f["WARC-Type"] == "revisit" and f["WARC-Refers-To"] == got["02"][0]["WARC-Record-ID"] and block == found


def test_broken_archives(spark, tmp_path):
    cut = record("response", 1, b"HTTP/1.1 200 OK\r\n\r\nwhole") + record("response", 2, b"HTTP/1.1 200 OK\r\n\r\nno more")[:-12]
    odd = record("response", 3, b"HTTP/1.1 200 OK\r\n\r\nabc").replace(b"Content-Length: 22", b"X-L: \xe9") + record("response", 4, b"HTTP/1.1 200 OK\r\n\r\nd")
    for name, raw in (("cut", cut), ("odd", odd), ("zip", gzip.compress(cut)[:-20]), ("none", b"")):
        os.makedirs(f"{tmp_path}/{name}")
        open(f"{tmp_path}/{name}/x.warc", "wb").write(raw)
    with pytest.raises(Exception, match="x.warc: the last record is cut short"):
        warc.read_archives(spark, f"file://{tmp_path}/cut").collect()
    with pytest.raises(Exception, match="cut short"):
        warc.read_archives(spark, f"file://{tmp_path}/zip").collect()
    assert [bytes(r.payload) for r in warc.read_archives(spark, f"file://{tmp_path}/cut", strict=False).collect()] == [b"whole"]
    assert {bytes(r.payload): r.extra for r in warc.read_archives(spark, f"file://{tmp_path}/odd").collect()} == {b"abc": "Content-Type: application/http; msgtype=response\r\nX-L: é\r\n", b"d": "Content-Type: application/http; msgtype=response\r\n"}
    assert warc.read_archives(spark, f"file://{tmp_path}/none").count() == 0


def test_odd_cases(spark, tmp_path):
    rows = [(1, None, None, "x"), (2, "", "", "x"), (None, "u\r\nX: y", "a", "x"), (None, "u\r\nX: y", "a", "x"), (4, "v", "a", "x"), (4, "v", "a", "x"), (5, "w", "long " * 400_000, "x")]
    df = pages(spark, rows, ", digest string")
    manifest = warc.write_archives(warc.records(df), f"file://{tmp_path}/c").collect()
    got = {(r.page_id, r.target_uri): r.warc_type for r in manifest}
    assert len(manifest) == 5
    assert got == {(1, ""): "response", (2, ""): "revisit", (4, "v"): "response", (None, "u%0D%0AX: y"): "revisit", (5, "w"): "response"}
    assert all(re.fullmatch(r"<urn:uuid:[0-9a-f-]{36}>", f["WARC-Record-ID"]) for f, _ in written_rows(f"{tmp_path}/c"))


def test_earlier_archives_stay(spark, tmp_path):
    folder = f"file://{tmp_path}/d"
    assert warc.write_archives(warc.records(pages(spark, [])), folder).count() == 0
    first = warc.write_archives(warc.records(pages(spark, [(1, "u", "a")])), folder).first().archive
    second = warc.write_archives(warc.records(pages(spark, [(2, "v", "b")])), folder).first().archive
    assert first != second and all(os.path.exists(f"{tmp_path}/d/{x}") for x in (first, second))
    assert {r.page_id for r in warc.read_archives(spark, folder).collect()} == {1, 2}
