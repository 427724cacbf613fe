"""Stream queries read a table that is a folder of part files like one that is a single file."""

import pytest

from transcript_quality import queries as Q

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name, source, order", [("stream_acoustic_features", "embeddings", "vec_id"), ("stream_wer_histogram", "events", "value"),
                                                 ("history_rows", "lineitem", "l_extendedprice")])
def test_folder_of_part_files(spark, tmp, name, source, order):
    want = sorted(map(str, Q.QUERIES[name](spark, SF).collect()))
    rows = spark.read.parquet(f"{SF}/{source}.parquet")
    rows.repartitionByRange(3, order).write.parquet(f"{tmp}/{source}.parquet")  # each file has rows of the whole time
    got = sorted(map(str, Q.QUERIES[name](spark, tmp).collect()))
    assert got == want and len(got) > 20
