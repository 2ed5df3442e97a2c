"""Randomised checks of the operators against brute force in plain Python."""

import statistics
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orebridge.functions import exact_mean, round_half_up
from orebridge.operators import flag_duplicates, group_median, keep_first

SETTINGS = settings(max_examples=12, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

cents = st.integers(min_value=-50_000, max_value=50_000)
groups = st.sampled_from(["a", "b", "c", None])


@SETTINGS
@given(st.lists(st.tuples(groups, st.one_of(st.none(), cents)), min_size=1, max_size=60),
       st.sampled_from([0, 1_000]))
def test_group_median_matches_statistics(spark, rows, limit):
    data = [(g, None if c is None else Decimal(c).scaleb(-2)) for g, c in rows]
    df = spark.createDataFrame(data, "g string, v decimal(8,2)")
    got = {r.g: r.median for r in group_median(df, ["g"], "v", max_local_rows=limit).collect()}
    want = {}
    for g in {g for g, v in data if g is not None}:
        vals = [v for gg, v in data if gg == g and v is not None]
        if vals:
            want[g] = statistics.median(vals)
    assert got.keys() == want.keys()
    for g in want:
        assert Decimal(got[g]) == Decimal(want[g])


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 6)), st.integers(0, 3)),
                min_size=1, max_size=50),
       st.randoms(use_true_random=False))
def test_duplicate_flags_match_pandas(spark, rows, rnd):
    seqs = list(range(len(rows)))
    rnd.shuffle(seqs)
    data = [(k, s, p) for (k, p), s in zip(rows, seqs)]
    df = spark.createDataFrame(data, "k long, seq long, payload long")
    pdf = pd.DataFrame(data, columns=["k", "seq", "payload"]).sort_values("seq")
    pdf["dup"] = pdf.duplicated(subset=["k"], keep="first")
    want = dict(zip(pdf["seq"], pdf["dup"]))
    got = {r.seq: r.is_duplicate for r in flag_duplicates(df, ["k"], ["seq"]).collect()}
    assert got == want
    kept = {r.seq for r in keep_first(df, ["k"], ["seq"]).collect()}
    assert kept == {s for s, d in want.items() if not d}


@SETTINGS
@given(st.lists(st.integers(-10**9, 10**9), min_size=1, max_size=40))
def test_exact_mean_rounds_half_up(spark, units):
    vals = [Decimal(u).scaleb(-4) for u in units]
    df = spark.createDataFrame([(v,) for v in vals], "x decimal(14,4)")
    got = df.agg(round_half_up(exact_mean("x"), 2).alias("m")).first().m
    want = (sum(vals) / Decimal(len(vals))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)
    assert got == want


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(1, 5)), min_size=1, max_size=40),
       st.sampled_from([0, 1_000]))
def test_running_total_matches_prefix_sums(spark, rows, limit):
    from orebridge.operators import running_total
    data = [(g, i, w) for i, (g, w) in enumerate(rows)]          # (group, distinct order, weight)
    df = spark.createDataFrame(data, "g string, v long, w long").repartition(3)
    got = {(r.g, r.v): (r.before, r.total) for r in
           running_total(df, ["v"], ["g"], weight="w", before="before", total="total",
                         max_local_rows=limit).collect()}
    for g, v, _ in data:
        prior = sum(w for gg, vv, w in data if gg == g and vv < v)
        total = sum(w for gg, _, w in data if gg == g)
        assert got[(g, v)] == (prior, total)


@SETTINGS
@given(st.lists(st.tuples(st.sampled_from(["hot", "x", "y", None]), st.integers(0, 9)),
                min_size=1, max_size=60))
def test_salted_join_equals_plain_left_join(spark, rows):
    from orebridge.operators import salted_join
    big = spark.createDataFrame(rows, "k string, v long")
    small = spark.createDataFrame([("hot", 1.5), ("y", 2.5)], "k string, m double")
    plain = big.join(small, ["k"], "left")
    salted = salted_join(big, small, ["k"], "left", buckets=4).select(*plain.columns)
    assert sorted(map(tuple, salted.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 3))),
                min_size=1, max_size=40))
def test_flags_and_keep_first_agree_with_nulls_in_order(spark, rows):
    # order = (a, b) with b unique per row, a possibly NULL: first rows must agree
    data = [(k, a, i) for i, (k, a) in enumerate(rows)]
    df = spark.createDataFrame(data, "k long, a long, b long")
    flagged = {r.b for r in flag_duplicates(df, ["k"], ["a", "b"]).where("NOT is_duplicate").collect()}
    kept = {r.b for r in keep_first(df, ["k"], ["a", "b"]).collect()}
    assert flagged == kept
    pdf = pd.DataFrame(data, columns=["k", "a", "b"]).sort_values(["a", "b"], na_position="last")
    assert kept == set(pdf.drop_duplicates("k", keep="first")["b"])
