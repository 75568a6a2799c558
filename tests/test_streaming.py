"""The streaming link cleaner equals the batch cleaner and resumes."""

import os

from rankgrad.functions import clean
from rankgrad.sources import text
from rankgrad.streaming import links


def test_stream_matches_batch_and_resumes(spark, tmp_dir):
    src = os.path.join(tmp_dir, "in")
    os.makedirs(src)
    batches = ["A\tB\nA\tTalk:C\nX\tY\tZ\n", "Talk:D\tE\n# c\nB\tA\n"]
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    for i, body in enumerate(batches):
        with open(os.path.join(src, f"link-{i}"), "w") as fh:
            fh.write(body)
        with open(os.path.join(src, f"other-{i}"), "w") as fh:
            fh.write("P\tQ\n")
        q = links.append_edges(links.clean_link_stream(spark, src), out, ck)
        q.awaitTermination(120)
    got = sorted(map(tuple, spark.read.parquet(out).collect()))
    want = sorted(map(tuple, clean.clean_links(text.read_link_files(spark, src)).collect()))
    assert got == want == [("a", "b"), ("b", "a"), ("talk:d", "e")]
