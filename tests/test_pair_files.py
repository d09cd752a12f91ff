"""Pair files are compressed."""
import glob
import gzip
import json

from parley.sources import files as IO

PAIRS = "src string, tgt string, direction string"


def test_pair_files_are_compressed_and_hold_the_same_lines(spark, tmp_out):
    rows = [("你好\n\"x\"", "hi " * 50, "zh2en"), ("hi " * 50, "你好\n\"x\"", "en2zh"), ("", None, None)] * 100
    df = spark.createDataFrame(rows, PAIRS)
    IO.write_pairs(df, f"{tmp_out}/zip")
    IO.write_pairs(df, f"{tmp_out}/plain", compression="none")
    zipped, plain = glob.glob(f"{tmp_out}/zip/part-*"), glob.glob(f"{tmp_out}/plain/part-*")
    assert all(f.endswith(".json.gz") for f in zipped) and all(f.endswith(".json") for f in plain)
    lines = [x for f in zipped for x in gzip.open(f, "rt", encoding="utf-8")]
    assert sorted(lines) == sorted(x for f in plain for x in open(f, encoding="utf-8"))
    assert "你好" in lines[0] and json.loads(lines[0])["direction"] == "zh2en"
    assert sorted(map(tuple, IO.read_pairs(spark, f"{tmp_out}/zip").collect()), key=repr) == sorted(rows, key=repr)
