"""Containment search against brute force."""

import re

import duckdb

from transcript_quality.llm import decontaminate as D
from transcript_quality.llm import queries

SF = "/root/testdata/sf0.001"


def brute(docs, items):
    def words(t):
        return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]
    out = []
    for i, t in set(items):
        w = words(t)
        k = min(5, len(w))
        if i is None or not k:
            continue
        s = {tuple(w[p:p + k]) for p in range(len(w) - k + 1)}
        for d, x in docs:
            v = words(x)
            n = len(s & {tuple(v[p:p + k]) for p in range(len(v) - k + 1)})
            if n >= 0.8 * len(s) - 1e-9:
                out.append((d, i, len(s), n))
    return sorted(out, key=str)


def test_query_against_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = sorted(con.execute(queries.ORACLE["op4_decontaminate"]).fetchall())
    got = sorted(tuple(r) for r in queries.op4_decontaminate(spark, SF).collect())
    assert got == want and got


def test_planted(spark):
    item = " ".join(f"w{i}" for i in range(36))
    part = item.replace("w5 ", "x ")            # 27 of 32 shingles
    less = item.replace("w9 ", "x ").replace("w20 ", "y ")  # 22 of 32
    long = " ".join(f"v{i % 977}" for i in range(20000))
    docs = [(1, f"{long} {item.upper()}. {long}"), (2, part), (3, less), (4, None), (5, ""), (6, "Short, item here"), (6, "Short, item here"), (None, f"a {part}!"), (8, long)]
    items = [(1, item), (1, item), (2, "short ITEM"), (3, None), (4, " ,"), (None, "v1 v2"), (5, "w1 w2 w3 w4 w5 w6")]
    d = spark.createDataFrame([(a, b, 1, 2) for a, b in docs], "doc_id long, text string, item_id int, k int")
    b = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r)[:4] for r in D.search(d, b).collect()), key=str)
    assert got == brute(docs, items)
    assert {(g[0], g[1]) for g in got} >= {(1, 1), (2, 1), (None, 1), (6, 2)} and (3, 1) not in {(g[0], g[1]) for g in got}
    kept = D.clean(d, b)
    assert kept.columns == d.columns and sorted(r.doc_id for r in kept.collect()) == [4, 5, 8]  # 3 holds the short item 5
    assert D.search(d.limit(0), b).collect() == [] and D.search(d, b.limit(0)).collect() == []
    assert D.clean(d, b.limit(0)).count() == len(docs)
