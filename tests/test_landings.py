"""The sliding stream reads each landing's files by many tasks, with the same rows."""

import glob

from transcript_quality import queries as Q

SF = "/root/testdata/sf0.001"


def test_landing_keeps_its_partitions(spark, monkeypatch, tmp):
    want = sorted(map(tuple, Q.stream_snr_histogram(spark, SF).collect()))
    plain = Q.table
    monkeypatch.setattr(Q, "table", lambda *a: plain(*a).repartition(4))
    monkeypatch.setattr(Q, "_run_dir", lambda *a: tmp)
    got = sorted(map(tuple, Q.stream_snr_histogram(spark, SF).collect()))
    assert got == want and len(got) > 20
    assert len(glob.glob(f"{tmp}/landing/*.parquet")) == 8
