from __future__ import annotations

import random
from collections import Counter

from pyspark.sql import functions as F

from crewspark.operators import profile as P

SCHEMA = "id long, name string, x double, flag boolean, empty string"


def rows_of(n, seed, lo=0):
    rnd = random.Random(seed)
    return [(lo + i, f"n{int(rnd.paretovariate(0.7)) % 3000}", None if rnd.random() < 0.1 else rnd.gauss(lo, 5), rnd.random() < 0.3, None) for i in range(n)]


def test_merged_equals_whole_and_errors_are_bounded(spark, tmp_path):
    a, b = rows_of(9000, 1), rows_of(6000, 2, 7000)
    one, two, whole = (P.sketch_profile(spark.createDataFrame(r, SCHEMA).repartition(5)) for r in (a, b, a + b))
    for name, df in (("one", one), ("two", two)):
        df.write.parquet(str(tmp_path / name))  # kept beside its version
    one, two = (spark.read.parquet(str(tmp_path / n)) for n in ("one", "two"))
    merged = {r["column_name"]: r for r in P.merged_profiles(one, two).collect()}
    whole = {r["column_name"]: r for r in whole.collect()}
    report = {r["column_name"]: r for r in P.profile_report(P.merged_profiles(one, two)).collect()}
    for i, c in enumerate(["id", "name", "x", "flag", "empty"]):
        values = [r[i] for r in a + b if r[i] is not None]
        text = Counter({True: "true", False: "false"}.get(v, str(v)) if isinstance(v, bool) else str(v) for v in values)
        for key in ("rows", "nulls", "low", "high"):
            assert merged[c][key] == whole[c][key]
        assert merged[c]["rows"] == 15000 and merged[c]["nulls"] == 15000 - len(values)
        assert abs(report[c]["distinct_values"] - len(text)) <= 0.06 * len(text)
        if c != "x":
            for v, n in text.items():
                kept = merged[c]["heavy"].get(v, 0)
                assert kept <= n <= kept + merged[c]["heavy_bound"], (c, v)
        if c in ("id", "x"):
            values.sort()
            for share, q in zip((0.25, 0.5, 0.75), report[c]["quantiles"]):
                rank = sum(v <= q for v in values) / len(values)
                assert abs(rank - share) < 0.03
        else:
            assert report[c]["quantiles"] is None
    assert report["name"]["heaviest"] == Counter(r[1] for r in a + b).most_common(1)[0][0] and report["empty"]["heaviest"] is None


def test_empty_table_and_single_profile(spark):
    none = P.sketch_profile(spark.createDataFrame([], SCHEMA))
    got = {r["column_name"]: r for r in P.profile_report(P.merged_profiles(none)).collect()}
    assert len(got) == 5 and all(r["rows"] == r["nulls"] == r["distinct_values"] == 0 and r["quantiles"] is None for r in got.values())
    some = P.sketch_profile(spark.createDataFrame(rows_of(10, 3), SCHEMA))
    both = {r["column_name"]: r for r in P.merged_profiles(none, some).collect()}
    assert both["id"]["rows"] == 10 and both["id"]["high"] == 9.0
