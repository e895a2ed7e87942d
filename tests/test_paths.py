from pyspark.sql import functions as F

from spoolwright.functions import paths


def test_spellings_of_one_file(spark):
    roots = paths.root_pairs(spark.createDataFrame([("D:\\lab", "lab"), ("/mnt/Lab/voice", "lab"), ("/mnt/lab", "old"), (None, "x")], "root_path string, canonical_root string"))
    same = ["D:\\lab\\recordings\\a\\New 1.wav", " d:/LAB//recordings/./a/new 1.WAV ", "/mnt/lab/voice/recordings/a/New 1.wav", "lab/recordings/a/new 1.wav", "D:\\lab/recordings\\.\\.\\a\\\\New 1.wav"]
    other = ["D:\\lab2\\recordings\\a\\New 1.wav", "/mnt/lab/recordings/a/new 1.wav", "recordings/a/new 1.wav"]
    df = spark.createDataFrame([(p,) for p in [*same, *other, None, ""]], "p string").select(paths.file_key(F.col("p"), roots).alias("k"))
    got = [r.k for r in df.collect()]
    assert set(got[:5]) == {"lab/recordings/a/new 1.wav"}
    assert got[5:8] == ["d:/lab2/recordings/a/new 1.wav", "old/recordings/a/new 1.wav", "recordings/a/new 1.wav"]
    assert got[8] is None and got[9] == ""


def test_extension_and_names(spark):
    df = spark.createDataFrame([("x/2025-06-19 14.05 memo 5.ogg",), ("x/2025-06-19 14.05 memo 5",), ("x/y.m4a",)], "p string")
    assert [r[0] for r in df.select(paths.without_extension(F.col("p"))).collect()] == ["x/2025-06-19 14.05 memo 5", "x/2025-06-19 14.05 memo 5", "x/y"]
    one = spark.range(1)
    assert one.select(paths.uid_from_name(F.lit("0123456789ab_0123456789cd__noise.wav"))).first()[0] == "0123456789ab"
    assert one.select(paths.strip_suffixes(F.lit("a_noise_gain.wav"), "_noise|_gain")).first()[0] == "a.wav"
    assert one.select(paths.tail_from_marker(F.lit("x/chunks/a/b"), ("/nope/", "/chunks/"))).first()[0] == "/chunks/a/b"
