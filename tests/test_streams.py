import itertools
import random
import struct

import pytest
from pyspark.sql import functions as F

from strataframe.operators import attempts
from strataframe.plans import services
from strataframe.sources import records
from strataframe.streaming.status import status_stream


def test_status_stream_equals_batch(spark, tmp_path):
    rng = random.Random(6)
    events = []
    for key in range(40):
        for n in range(1, rng.randrange(1, 8)):
            record = rng.random() < 0.7
            events.append((key, "attempt", n, record, record and rng.random() < 0.5, None))
            if record and rng.random() < 0.5:
                events.append((key, "review", n, None, None, rng.random() < 0.4))
    schema = "key long, kind string, n int, record boolean, promoted boolean, accepted boolean"
    for part in range(3):
        rows = [e for e in events if min(2, e[2] // 3) == part]
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / str(part)))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(str(tmp_path / "in"))
    query = status_stream(stream).writeStream.format("memory").queryName("states").outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    query.awaitTermination(180)
    last = spark.table("states").groupBy("key").agg(F.max_by("status", F.struct("latest", "records", "status")).alias("status"))
    log = spark.createDataFrame(events, schema)
    a = log.where("kind = 'attempt'").select("key", "n", "record", "promoted")
    r = log.where("kind = 'review'").groupBy("key").agg(F.max_by(F.struct("n", "accepted"), "n").alias("r")).select("key", F.col("r.n").alias("attempt"), F.col("r.accepted").alias("accepted"), F.array().cast("array<string>").alias("issues"), F.lit("review").alias("source"))
    batch = attempts.item_status(a.select("key", F.lit(False).alias("output_missing")).distinct(), a, r)
    final = {}
    for row in spark.table("states").collect():
        final.setdefault(row.key, []).append(row)
    want = {x.key: (x.status, x.latest, x.records) for x in batch.collect()}
    assert last.count() == len(want)
    for key, (status, latest, recs) in want.items():
        assert any((x.status, x.latest, x.records) == (status, latest, recs) for x in final[key])
    assert len({s for s, _, _ in want.values()}) >= 4


def test_record_streams(spark):
    pal = bytes(range(256)) * 3
    frames = b"FRMK" + struct.pack("<HH", 2, 1) + pal + b"\x01\x02"
    bitmaps = b"LA1B" + struct.pack("<HHB", 1, 2, 1) + pal + b"ab" + b"LA1E" + (880).to_bytes(4, "little") + b"unsupported" + b"LA1E" + bytes(4)
    cels = b"AKOS" + struct.pack("<IHHHB", 0x45, 1, 2, 2, 255) + b"wxyz" + b"AKOSE" + struct.pack("<IHH", 3, 4, 9)
    assert [r["index"] for r in records.parse("frames", frames * 2)] == [b"\x01\x02"] * 2
    assert [(r["type"], r.get("offset"), r.get("reason")) for r in records.parse("bitmaps", bitmaps)] == [("bitmap", None, None), ("error", 880, "unsupported"), ("error", 0, "")]
    assert [(r["type"], r["costume"], r["cel"], r.get("codec")) for r in records.parse("cels", cels)] == [("cel", 69, 1, None), ("error", 3, 4, 9)]
    assert [records.first_difference(*x) for x in ((b"ab", b"ab"), (b"ab", b"ac"), (b"ab", b"abc"))] == [None, 1, 2]
    for kind, data in (("frames", frames[:-1]), ("glyphs", b"NUTX"), ("cels", cels[:10])):
        with pytest.raises(ValueError, match="no whole record"):
            list(records.parse(kind, data))
    df = spark.createDataFrame([("a", bitmaps), ("b", b""), ("c", b"junk")], "source string, content binary")
    got = [(r.source, r.ord, r.type, bool(r.error)) for r in records.scan(df, "bitmaps").orderBy("source", "ord").collect()]
    assert got == [("a", 0, "bitmap", False), ("a", 1, "error", False), ("a", 2, "error", False), ("c", 0, None, True)]


def test_services():
    ticks = itertools.count()
    answers = iter([None, None, {"status": {"status_str": "success"}, "outputs": 1}])
    stopped = []
    clocks = {"clock": lambda: next(ticks), "sleep": lambda s: None}
    assert services.run_job(lambda: "j", lambda j: next(answers), stopped.append, 50, **clocks)["outputs"] == 1 and not stopped
    with pytest.raises(TimeoutError):
        services.run_job(lambda: "j", lambda j: None, stopped.append, 5, **clocks)
    assert stopped == ["j"]
    with pytest.raises(RuntimeError, match="failed"):
        services.run_job(lambda: "j", lambda j: {"status": {"status_str": "error"}}, stopped.append, 5, **clocks)
    graph = {"1": {"class_type": "Load", "inputs": {"image": "a"}}}
    assert services.filled_graph(graph, {("1", "image"): "b", ("1", "seed"): 42})["1"]["inputs"] == {"image": "b", "seed": 42} and graph["1"]["inputs"] == {"image": "a"}
    with pytest.raises(ValueError):
        services.filled_graph(graph, {("2", "x"): 1})
    assert services.missing("abc", lambda n: {"a": True, "b": False}[n] if n != "c" else (_ for _ in ()).throw(OSError())) == ["b", "c"]
    assert services.answer_text({"choices": [{"message": {"content": " x "}}]}) == "x" and services.memory_available_gb() > 0
    for bad in ({"finish_reason": "length", "message": {"content": "x"}}, {"message": {"content": " "}}):
        with pytest.raises(ValueError):
            services.answer_text({"choices": [bad]})
