import os
import tempfile

from visitlab.streaming import adclick

LINES = [
    "1704067207179 8 8 8 0",          # valid
    "1704067207179 8 8 8",            # 4 parts
    "1704067207179 8 8 8 0 1",        # 6 parts
    "1704067207179 x 8 8 0",          # not a number
    "",                               # empty
    "1704067432824 6 6 16 3",         # valid
]


def test_parse_keeps_only_valid_lines(spark):
    lines = spark.createDataFrame([(v,) for v in LINES], "value string")
    got = sorted(tuple(r) for r in adclick.parse_ad_clicks(lines).collect())
    assert got == [(1704067207179, "2024-01-01 00:00:07", 8, 8, 8, 0),
                   (1704067432824, "2024-01-01 00:03:52", 6, 6, 16, 3)]
    assert adclick.rejected_lines(lines).count() == 4


def test_format_is_inverse_of_parse(spark):
    lines = spark.createDataFrame([(v,) for v in LINES], "value string")
    parsed = adclick.parse_ad_clicks(lines)
    back = sorted(r["value"] for r in adclick.format_ad_clicks(parsed).collect())
    assert back == sorted([LINES[0], LINES[5]])


def test_stream_equals_batch(spark):
    src = tempfile.mkdtemp(prefix="adclick-src-")
    sink = tempfile.mkdtemp(prefix="adclick-out-")
    with open(os.path.join(src, "part-0.txt"), "w") as f:
        f.write("\n".join(LINES[:3]) + "\n")
    with open(os.path.join(src, "part-1.txt"), "w") as f:
        f.write("\n".join(LINES[3:]) + "\n")
    q = adclick.start_parse_stream(spark, src, sink,
                                   checkpoint=tempfile.mkdtemp(prefix="adclick-ckpt-"))
    q.awaitTermination(120)
    streamed = sorted(tuple(r) for r in spark.read.parquet(sink).collect())
    lines = spark.createDataFrame([(v,) for v in LINES], "value string")
    batch = sorted(tuple(r) for r in adclick.parse_ad_clicks(lines).collect())
    assert streamed == batch


def test_stream_counts_rejects_per_batch(spark):
    src = tempfile.mkdtemp(prefix="adclick-src-")
    sink = tempfile.mkdtemp(prefix="adclick-out-")
    rejects = tempfile.mkdtemp(prefix="adclick-rej-")
    with open(os.path.join(src, "part-0.txt"), "w") as f:
        f.write("\n".join(LINES) + "\n")
    q = adclick.start_parse_stream(spark, src, sink, rejects_dir=rejects,
                                   checkpoint=tempfile.mkdtemp(prefix="adclick-ckpt-"))
    q.awaitTermination(120)
    good = spark.read.parquet(sink)
    assert good.count() == 2 and "batch_id" in good.columns
    assert sorted(r["value"] for r in spark.read.parquet(rejects).collect()) == sorted(
        v for v in LINES if v not in (LINES[0], LINES[5]))


def test_tagged_stream_reads_each_line_once_and_repeats_batches(spark, tmp_path):
    src, out = tmp_path / "src", str(tmp_path / "out")
    src.mkdir()
    (src / "part-0.txt").write_text("\n".join(LINES) + "\n")
    q = adclick.start_tagged_stream(spark, str(src), out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    # a batch that is evaluated twice counts its rows twice
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(LINES)
    batch = spark.createDataFrame([(v,) for v in LINES], "value string")

    def table():
        valid, rejected = adclick.read_tagged(spark, out)
        return sorted(tuple(r) for r in valid.drop("batch_id").collect()), sorted(r["value"] for r in rejected.collect())

    want = (sorted(tuple(r) for r in adclick.parse_ad_clicks(batch).collect()),
            sorted(r["value"] for r in adclick.rejected_lines(batch).collect()))
    assert table() == want
    adclick.write_tagged_batch(batch, 0, out)      # the same batch again, as after a failure
    assert table() == want
    adclick.write_tagged_batch(batch.limit(0), 0, out)
    assert table() == ([], [])
    (src / "part-1.txt").write_text(LINES[0] + "\n")
    q = adclick.start_tagged_stream(spark, str(src), out, checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(120)
    assert [r["batch_id"] for r in adclick.read_tagged(spark, out)[0].collect()] == [1]


def test_stream_with_two_places_parses_each_batch_once(spark, tmp_path):
    src = tmp_path / "src"
    src.mkdir()
    (src / "part-0.txt").write_text("\n".join(LINES) + "\n")
    q = adclick.start_parse_stream(spark, str(src), str(tmp_path / "good"), checkpoint=str(tmp_path / "ckpt"),
                                   rejects_dir=str(tmp_path / "bad"))
    q.awaitTermination(120)
    assert sum(p["numInputRows"] for p in q.recentProgress) == len(LINES)
