import json

import pytest
from pyspark.sql import functions as F

from spoolwright.sources import readers, writers


def put(folder, name, text):
    (folder / name).write_text(text, encoding="utf-8")
    return f"file://{folder / name}"


def test_three_ways_with_bad_lines(spark, tmp_path):
    path = put(tmp_path, "a.jsonl", '{"a": 1}\n\n{"a": \n{"a": 2}\n')
    with pytest.raises(Exception, match='MALFORMED|language_mode|enabled'):
        readers.read_jsonl(spark, path, "a int").collect()
    assert sorted(r.a for r in readers.read_jsonl(spark, path, "a int", "drop").collect()) == [1, 2]
    kept = readers.read_jsonl(spark, path, "a int", "keep").collect()
    assert [r[readers.BAD] for r in kept if r.a is None] == ['{"a": '] and len(kept) == 3
    assert [(r.line_no, r.text) for r in readers.first_lines(spark, path, 2).collect()] == [(1, '{"a": 1}'), (2, "")]


def test_csv_columns(spark, tmp_path):
    path = put(tmp_path, "a.csv", "file,score\na,1\nb,x\n")
    with pytest.raises(ValueError):
        readers.read_csv(spark, path, ["file", "decision"])
    got = readers.typed(readers.read_csv(spark, path, ["file"]), {"score": "double"}).collect()
    assert [(r.file, r.score) for r in got] == [("a", 1.0), ("b", None)]


def test_csv_lines_that_do_not_fit_the_quoting(spark, tmp_path):
    path = put(tmp_path, "q.csv", 'file,score,note\n"a,x",1,ok\n"b,2,open\nc,3,"open\nd,4\ne,5,x,y\nf,6,z\n')
    got = readers.read_csv(spark, path, ["file"])
    assert sorted((r.file, r.score, r.note) for r in got.collect() if r.file != "d") == [('"b', "2", "open"), ("a,x", "1", "ok"), ("c", "3", "open"), ("f", "6", "z")]
    assert [tuple(r) for r in got.where("file = 'd'").collect()] == [("d", "4", None)]
    assert got.count() == 5 and sorted(r.score for r in got.select("score").collect()) == ["1", "2", "3", "4", "6"]
    typed = readers.read_csv(spark, path, ["file"], "file string, score int, note string").collect()
    assert sorted(r.score for r in typed) == [1, 2, 3, 4, 6]
    wrong = put(tmp_path, "w.csv", "file,score\na,1\nb,x\n")
    assert [r.file for r in readers.read_csv(spark, wrong, ["file"], "file string, score int").collect()] == ["a"]


def test_processed_files(spark, tmp_path):
    files = lambda p: sorted(r.file for r in readers.processed_files(spark, p).collect())
    assert files(put(tmp_path, "h.csv", 'score,file\n1, a \n2,"b,""x"""\n3,a\n4,\n')) == ["a", 'b,"x"']
    assert files(put(tmp_path, "n.csv", "a,1\nFile,2\nb,3\n")) == ["a", "b"]
    assert files(put(tmp_path, "o.csv", "filename,1\na,2\n")) == [] == files(f"file://{tmp_path}/none.csv") == files(put(tmp_path, "e.csv", ""))


def test_predictions_of_any_shape(spark, tmp_path):
    for name, doc in {
        "a.json": [{"__meta__": {"run_args": {"n": 1}}}, {"mix_key": "x", "v": 1}, {"key": "y"}, {"mix_key": "x", "v": 2}, {"v": 3}, 7],
        "b.json": {"run_args": {"n": 2}, "items": [{"key": "z", "run_args": {"n": 3}}, {"mix_key": "m", "run_args": {}}]},
        "c.json": {"samples": [{"key": "s"}]},
        "e.json": {},
    }.items():
        put(tmp_path, name, json.dumps(doc))
    put(tmp_path, "d.json", "[{")
    items, runs = readers.read_predictions(spark, f"file://{tmp_path}")
    assert sorted((r.file, r.key, json.loads(r.item).get("v")) for r in items.collect()) == [("a.json", "x", 2), ("a.json", "y", None), ("b.json", "m", None), ("c.json", "s", None)]
    assert sorted((r.file, json.loads(r.run_args)) for r in runs.collect()) == [("a.json", {"n": 1}), ("b.json", {"n": 3})]


def test_rows_of_each_spec(spark):
    df = spark.range(100).select("id", (F.col("id") % 2).alias("spec"), F.when(F.col("id") < 50, "w").otherwise(" ").alias("text"), F.when(F.col("id") != 3, F.lit("f")).alias("audio"))
    assert readers.taken(df, "spec", "id", "text", "audio", 50).count() == 49
    few = readers.taken(df, "spec", "id", "text", "audio", 10)
    assert 0 < few.count() < 20 and few.where("trim(text) = '' or audio is null").count() == 0 and few.groupBy("spec").count().where("count > 10").count() == 0


def test_model_registry(spark, tmp_path):
    good = put(tmp_path, "m.csv", "model_name,backend,model_ref,language_mode,enabled\na,b,c,en,Yes\n")
    assert readers.read_models(spark, good).first().enabled is True
    bad = put(tmp_path, "n.csv", "model_name,backend,model_ref,language_mode,enabled\na,b,c,xx,maybe\n")
    with pytest.raises(Exception, match='MALFORMED|language_mode|enabled'):
        readers.read_models(spark, bad).collect()


def test_transcripts_of_any_shape(spark, tmp_path):
    seg = [{"start": 0.25, "end": 2.75, "text": "hi", "no_speech_prob": 0.0, "avg_logprob": 0.0, "compression_ratio": 1.0}]
    put(tmp_path, "a.json", json.dumps({"groq_response": {"segments": []}, "segments": seg}))
    put(tmp_path, "b.json", json.dumps({"result": {"segments": seg}}, indent=1))
    put(tmp_path, "c.json", json.dumps({"x": 1}))
    got = {r.file: r.segments for r in readers.read_transcripts(spark, f"file://{tmp_path}").collect()}
    assert [len(got[f]) if got[f] else 0 for f in ("a.json", "b.json", "c.json")] == [1, 1, 0]
    assert readers.segment_rows(readers.read_transcripts(spark, f"file://{tmp_path}")).count() == 3


def test_salvage(spark, tmp_path):
    path = put(tmp_path, "p.json", '[{"a": 1}, {"a": 2}, {"a": ')
    assert [json.loads(r.item)["a"] for r in readers.salvaged_json(spark, path).orderBy("pos").collect()] == [1, 2]


def test_section_handles(spark, tmp_path):
    path = put(tmp_path, "r.md", "# T\n## Canonical\n- Me/Set-One and me/set-two\n- ME/set-one\n### sub\n- me/three\n## Old\n- me/other\n")
    got = readers.section_handles(readers.numbered_lines(spark, path), "canonical").orderBy("line_no", "handle").collect()
    assert [r.handle for r in got] == ["me/set-one", "me/set-two", "me/three"]


def test_inventory_and_probe_cache(spark, tmp_path):
    (tmp_path / "x").mkdir()
    put(tmp_path, "a.WAV", "1234")
    put(tmp_path / "x", "b.wav", "1")
    put(tmp_path, "c.txt", "1")
    inv = readers.inventory(spark, f"file://{tmp_path}", (".wav",), (f"file:{tmp_path}/x",))
    assert [r.bytes for r in inv.collect()] == [4]
    hit, miss = readers.fresh_probes(inv, inv.withColumn("duration", F.lit(1.5)))
    assert hit.count() == 1 and miss.count() == 0


def test_header_grows(spark, tmp_path):
    a = spark.createDataFrame([("x", 1)], "f string, a int")
    path = f"file://{tmp_path}/grown"
    assert writers.append_csv(spark, a, path) == ["f", "a"]
    assert writers.append_csv(spark, a.withColumnRenamed("a", "b"), path) == ["f", "a", "b"]
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "grown").rglob("*.csv")}
    assert writers.append_csv(spark, a, path) == ["f", "a", "b"]
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())
    assert sorted(map(tuple, writers.read_grown_csv(spark, path).collect()), key=str) == [("x", "1", None), ("x", "1", None), ("x", None, "1")]


def test_lines_of_a_file_in_blocks(spark, tmp_path):
    (tmp_path / "a.txt").write_bytes(b"".join(b"%d\r\n" % i if i % 3 else b"\n" for i in range(2000)))
    (tmp_path / "b.txt").write_text("x\n\ny")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = {(r.file, r.line_no): r.text for r in readers.numbered_lines(spark, f"file://{tmp_path}").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == {("a.txt", i + 1): str(i) if i % 3 else "" for i in range(2000)} | {("b.txt", 1): "x", ("b.txt", 2): "", ("b.txt", 3): "y"}


def test_subtitles(spark):
    s = spark.createDataFrame([("d", 2.0, 3.0, "second"), ("d", 0.0, 1.5, " first "), ("d", 4.0, 5.0, "..."), ("d", 6.0, 6.0, "none")], "k string, start double, end double, text string")
    got = writers.web_vtt(s, "k").first().subtitles
    assert got == "WEBVTT\n\n00:00:00.000 --> 00:00:01.500\nfirst\n\n00:00:02.000 --> 00:00:03.000\nsecond\n"
