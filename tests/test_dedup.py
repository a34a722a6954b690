from __future__ import annotations

from framewright.operators import dedup


def test_one_per_key(spark, monkeypatch):
    rows = [(k % 7 if k < 10 else k, "x" * k) for k in range(30)] + [(None, "n")]
    df = spark.createDataFrame(rows, "k int, t string")
    want = {k for k, _ in rows if k is not None}
    for most in (100_000, 1):
        monkeypatch.setattr(dedup, "MOST_REPEATED", most)
        got = dedup.one_per_key(df, ["k"]).collect()
        assert {r.k for r in got} == want and len(got) == len(want) and all((r.k, r.t) in rows for r in got)
    assert dedup.one_per_key(df.filter("k > 20"), ["k"]).count() == 9 and dedup.one_per_key(df.limit(0), ["k"]).count() == 0
