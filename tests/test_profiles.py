"""Profiles of windows are counted inside the tasks."""

from spliceloom.operators import polya as PA


def test_profiles_count_in_tasks(spark):
    """Windows of all lengths, other letters, missing texts and sides: as counted letter by letter, without a row for each letter."""
    texts = [("up", "AATAAATAAA"), ("up", "aataaaNäA"), ("down", "ATTAAAGG"), ("down", ""), ("down", "ACG"), (None, "AAAAAAA"), ("up", None), ("up", "CAATAAAAT")] * 5
    w = spark.createDataFrame(texts, "side string, t string").repartition(3)
    for k, fn, name, label in ((1, PA.letter_profile, "base", lambda x: x if x in "ACGT" else None),
                               (6, PA.signal_profile, "signal", lambda x: x if x in PA.MAIN_SIGNALS else "Other" if x in PA.SIGNALS else None)):
        n, total = {}, {}
        for side, t in texts:
            for i in range(len(t or "") - k + 1):
                c = label(t.upper()[i:i + k])
                total[side, i] = total.get((side, i), 0) + 1
                n[side, i, c] = n.get((side, i, c), 0) + 1
        out = fn(w, "t")
        got = {(r["side"], r["offset"], r[name]): (r["n"], round(r["share"], 9)) for r in out.collect()}
        assert got == {(s, i, c): (v, round(v / total[s, i], 9)) for (s, i, c), v in n.items() if c and s}
        assert "explode" not in out._jdf.queryExecution().optimizedPlan().toString()
