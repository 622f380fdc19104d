import base64
import gzip
import hashlib
import io
import os
import random

import pytest

from strataframe.llm.common import new_dir
from strataframe.llm.warc import parse_records, read_archives, read_manifest, write_archives

SCHEMA = "page_id long, url string, html string, shard int, digest string, note boolean"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 7, "x", None) for r in rows], SCHEMA)


def local(uri):
    return uri.removeprefix("file://")


def expected(rows, least=0):
    out, groups = [], {}
    for i, (p, u, h) in enumerate(rows):
        groups.setdefault((h or "").encode(), []).append(((p is None, p or 0, u is None, u or ""), i))
    for payload, members in groups.items():
        members.sort()
        for k, (_, i) in enumerate(members):
            revisit = k > 0 and len(payload) >= least
            digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
            out.append((rows[i][0], len(payload), digest, "revisit" if revisit else "response", rows[members[0][1]][0] if revisit else None))
    return sorted(out, key=repr)


def pages():
    rng = random.Random(5)
    body = lambda: "".join(rng.choice("aé<> \n😀") for _ in range(rng.choice((1, 50, 3000))))
    rows = [(rng.randrange(10**6), f"http://h/{i}", body()) for i in range(200)]
    rows += [(rng.randrange(10**6), "http://h/same", "hot page") for _ in range(150)]
    rows += [(None, None, "hot page"), (None, "http://h/null", None), (5, None, ""), (6, "http://h/\r\nX: y", "z"), (6, "http://h/b", "z"), (8, "http://h/long", "long " * 300_000)]
    rows += [(9, "http://h/r", "repeated")] * 3 + [(10, "http://h/q", "only thrice")] * 3 + [(-4, "http://h/n", "repeated")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("least", "roll", "shard"), [(0, 1 << 30, 1 << 30), (0, 4000, 20_000), (9, 1 << 20, 5000)])
def test_round_trip(spark, least, roll, shard):
    rows, out = pages(), new_dir(spark, "warc")
    manifest = write_archives(frame(spark, rows), out, dedup_min_bytes=least, roll_bytes=roll, shard_bytes=shard)
    back = read_archives(spark, out).collect()
    assert sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in back), key=repr) == expected(rows, least)
    assert {bytes(r.payload) for r in back if r.payload is not None} == {(h or "").encode() for _, _, h in rows}
    files = manifest.collect()
    assert sorted(f.name for f in files) == sorted(f for f in os.listdir(local(out)) if f.endswith(".gz"))
    assert sum(f.records for f in files) == len(rows) and (len(files) > 3 or shard == 1 << 30)
    for f in files:
        assert hashlib.sha256(open(f"{local(out)}/{f.name}", "rb").read()).hexdigest() == f.sha256
    ids = [r.page_id for f in sorted(files, key=lambda f: f.name) for r in back if r.archive == f.name and r.page_id is not None]
    assert ids == sorted(ids)


def test_same_rows_same_bytes(spark):
    rows, seen = pages(), []
    for parts in (1, 7):
        out = new_dir(spark, "warc")
        write_archives(frame(spark, rows).repartition(parts), out, roll_bytes=4000, shard_bytes=20_000)
        seen.append(sorted((f.name, f.sha256) for f in read_manifest(spark, out).collect()))
    assert seen[0] == seen[1]


def test_record_form(spark):
    out = new_dir(spark, "warc")
    (f,) = write_archives(frame(spark, [(1, "http://h/\r\nX: y", "é"), (2, None, "é")]), out).collect()
    records = list(parse_records(io.BytesIO(gzip.open(f"{local(out)}/{f.name}").read())))
    assert [h["warc-type"] for h, _ in records] == ["warcinfo", "response", "revisit"]
    assert records[1][0]["warc-target-uri"] == "http://h/%0D%0AX:%20y" and records[1][1].endswith(b"\r\n\r\n\xc3\xa9")
    assert records[2][0]["warc-refers-to"] == records[1][0]["warc-record-id"] and records[2][1].endswith(b"Content-Length: 2\r\n\r\n")


def test_empty_and_damaged(spark):
    out = new_dir(spark, "warc")
    assert write_archives(frame(spark, []), out).count() == 0 and read_archives(spark, out).count() == 0
    out = new_dir(spark, "warc")
    (f,) = write_archives(frame(spark, [(1, "u", "abc")]), out).collect()
    path = f"{local(out)}/{f.name}"
    plain = gzip.open(path).read().replace(b"abc", b"abd")
    with gzip.open(path, "wb") as g:
        g.write(plain)
    with pytest.raises(Exception, match="digest"):
        read_archives(spark, out).collect()


def test_shards_and_their_number_grow(spark):
    from strataframe.llm import warc

    assert [warc.shard_size(n) >> 20 for n in (0, 10**9, 3 * 10**10)] == [32, 32, 32]
    sizes = [warc.shard_size(n) for n in (10**12, 10**13, 10**14)]
    assert sizes == sorted(sizes) and sizes[-1] <= 10**9 and 10**14 // sizes[-1] <= 100_001
