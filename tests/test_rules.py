"""Tier thresholds, rounding, text rules and the small expressions."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortlens.functions import exprs as E
from cohortlens.functions import text as X
from cohortlens.functions import tiers
from cohortlens.operators import reshape
from cohortlens.plans import marts, reports, sessions


def values(spark, data, schema, column):
    return [r[0] for r in spark.createDataFrame(data, schema).coalesce(1).select(column).collect()]


def test_probability_bins_are_right_closed(spark):
    got = values(
        spark, [(0.33,), (0.3301,), (0.66,), (0.6601,), (None,), (float("nan"),)], "p double",
        tiers.probability_bins(F.col("p")),
    )
    assert got == ["low", "medium", "medium", "high", "low", "low"]


def test_grade_and_lateness(spark):
    rows = [(4.99, 0.0), (5.0, 0.0), (7.0, 0.0), (7.01, 0.2), (7.01, 0.21), (None, 0.0)]
    tier = tiers.grade_and_lateness(F.col("g"), F.col("l"))
    assert values(spark, rows, "g double, l double", tier) == [
        "high", "medium", "medium", "low", "medium", "low"
    ]


def test_other_tiers(spark):
    ratios = [(0.149,), (0.15,), (0.3,)]
    assert values(spark, ratios, "r double", tiers.course_ratio(F.col("r"))) == ["low", "medium", "high"]
    shown = [(0.39,), (0.4,), (0.7,)]
    assert values(spark, shown, "r double", tiers.probability_display(F.col("r"))) == ["low", "medium", "high"]
    graded = [(None,), (4.99,), (5.0,)]
    assert values(spark, graded, "g double", tiers.grade_two_level(F.col("g"))) == ["low", "high", "low"]
    assert values(spark, graded, "g double", tiers.at_risk_label(F.col("g"))) == [1, 1, 0]


def test_histogram_buckets(spark):
    bucket = E.grade_bucket(F.col("g"))
    rows = [(-0.1,), (0.0,), (0.99,), (5.0,), (9.99,), (10.0,)]
    assert values(spark, rows, "g double", bucket) == [0, 1, 1, 6, 10, 11]
    assert values(spark, rows, "g double", E.grade_bucket_label(bucket))[-2:] == ["9-10", "10"]


def test_rounding_is_half_away_from_zero(spark):
    rows = [(10_000, 2), (-10_000, 2), (2_500_000, 3), (50_000, 0), (9_999, 2)]
    assert values(spark, rows, "s bigint, n bigint", E.rounded_avg(F.col("s"), F.col("n"))) == [
        0.01, -0.01, 0.83, None, 0.0
    ]


def test_grades_are_summed_with_all_their_places(spark):
    rows = [("4.996",), ("83.335",), ("-0.0000005",), ("999999999999.999999",), (None,)]
    frame = spark.createDataFrame(rows, "g string").select(F.col("g").cast("decimal(18,6)").alias("g"))
    whole = [None if r[0] is None else int(r[0]) for r in frame.select(E.micros("g")).collect()]
    assert whole == [4_996_000, 83_335_000, -1, 999_999_999_999_999_999, None]
    total = frame.where("g > 90").select("g", F.explode(F.sequence(F.lit(1), F.lit(1000))))
    assert int(total.agg(F.sum(E.micros("g"))).first()[0]) == 999_999_999_999_999_999_000
    average = spark.createDataFrame([("4.996",)] * 3, "g string").agg(
        E.avg_of_micros(F.sum(E.micros(F.col("g").cast("decimal(18,6)"))), F.count("g")).alias("a")
    )
    assert average.select(tiers.at_risk_label(F.col("a")), "a").first() == (1, 4.996)
    assert values(spark, [(1, 8)], "a bigint, b bigint", E.rounded_ratio(F.col("a"), F.col("b"), 2)) == [0.13]
    assert values(spark, [(6.285,)], "x double", E.rounded(F.col("x"), 2)) == [6.29]


def test_spread_of_grades(spark):
    args = [F.col(c) for c in ("n", "s", "q")]
    rows = [(1, 5_000_000, 25 * 10**12), (2, 3_000_000, 5 * 10**12), (0, None, None)]
    schema = "n bigint, s bigint, q bigint"
    assert values(spark, rows, schema, E.stddev_samp_of_micros(*args)) == [None, pytest.approx(0.7071068), None]
    assert values(spark, rows, schema, E.stddev_pop_of_micros(*args)) == [0.0, 0.5, None]


def test_slope_of_huge_groups(spark):
    """Half the rows score 4 and half score 6, 2e9 milliseconds later."""
    schema = ", ".join(f"{c} decimal(38,0)" for c in ("n", "sx", "sy", "sxx", "sxy"))
    slope = E.slope_of_micros(*[F.col(c) for c in ("n", "sx", "sy", "sxx", "sxy")])
    rows = [
        tuple(map(Decimal, (n, 0, n * 5_000_000, n * 10**18, n * 10**15))) for n in (10, 10**9, 10**12)
    ]
    assert values(spark, rows, schema, slope) == [pytest.approx(1e-6)] * 3


def test_finite_or_zero(spark):
    rows = [(None,), (float("nan"),), (float("inf"),), (float("-inf"),), (1.5,)]
    assert values(spark, rows, "x double", E.finite_or_zero(F.col("x"))) == [0, 0, 0, 0, 1.5]


def test_first_truthy_skips_zero(spark):
    rows = [(0.0, 3.0), (None, None), (2.0, 3.0)]
    assert values(spark, rows, "a double, b double", E.first_truthy(F.col("a"), F.col("b"))) == [3, 0, 2]


def test_activity_trend(spark):
    trend = E.activity_trend(F.col("d"), F.col("w"))
    assert values(spark, [(2, 7), (0, 0)], "d bigint, w bigint", trend) == [100.0, None]


@pytest.mark.parametrize(
    "text, expected",
    [
        ("What is my GPA", "student_average"),
        ("average score please", "student_average"),
        ("lowest course?", "lowest_course"),
        ("bad subject", "lowest_course"),
        ("Môn nào thấp nhất", "lowest_course"),
        ("how to improve", "study_tips"),
        ("give me a tip", "study_tips"),
        ("hello", None),
        ("", None),
        ("điểm trung bình", None),
    ],
)
def test_intents(spark, text, expected):
    messages = spark.createDataFrame([(text,)], "text string")
    assert sessions.tag_intents(messages).first().intent == expected


def test_folding_d_finds_the_average_question(spark):
    messages = spark.createDataFrame([("Điểm trung bình",)], "text string")
    assert sessions.tag_intents(messages, fold_d=True).first().intent == "student_average"


def test_normalized_text(spark):
    rows = [("  Ế-áb!!100% \n",), ("ẵẫ ÀÉ",)]
    assert values(spark, rows, "t string", X.normalize(F.col("t"))) == ["e ab 100%", "aa ae"]


def test_validation(spark):
    rows = [(None,), ("  \n",), ("x" * 2000,), (" " + "x" * 2000 + " ",), ("x" * 2001,), ("😀" * 1001,)]
    assert values(spark, rows, "t string", X.reject_reason(F.col("t"))) == [
        "missing", "empty", None, None, "too_long", "too_long"
    ]


def test_study_tips(spark):
    schema = "late double, avg double, p double, focus string, focus_late double"
    tips = tiers.study_tips(*[F.col(c) for c in ("late", "avg", "p", "focus", "focus_late")])
    rows = [(0.3, 6.0, 0.7, "Math", 0.2), (0.1, 8.0, 0.1, None, None)]
    assert values(spark, rows, schema, tips) == [
        ["reduce_late", "small_goals", "meet_advisor", "focus:Math"], ["keep_on_time"]
    ]
    padded = tiers.tips_for_intent(F.lit("study_tips"), tips, F.col("focus"))
    assert values(spark, rows, schema, padded)[1] == ["keep_on_time", "track_board"]


def test_course_search_ranges(spark):
    rows = [(1, "Math", 7.0, 10, 0.15), (2, "Music", 8.0, 5, 0.3), (3, "Art", 6.0, 1, 1.0)]
    report = spark.createDataFrame(
        rows, "course_id bigint, course_name string, avg_grade double, student_count bigint, at_risk_ratio double"
    )
    assert [r.course_id for r in reports.course_search(report, tier="medium").collect()] == [1]
    assert [r.course_id for r in reports.course_search(report, tier="high").collect()] == [2]
    assert [r.course_id for r in reports.course_search(report, " M ", sort="avg_grade").collect()] == [2, 1]
    assert [r.course_id for r in reports.course_search(report, sort="student_count").collect()] == [1, 2, 3]


def test_constant_histogram_spans_one_around_the_value(spark):
    df = spark.createDataFrame([(5.0,), (5.0,), (None,)], "v double")
    rows = reshape.equal_width_histogram(df, "v").collect()
    counts = [r["count"] for r in rows]
    assert (rows[0].bin_from, rows[-1].bin_to) == (4.5, 5.5)
    assert counts[10] == 2 and sum(counts) == 2 and len(counts) == 20


def test_unknown_bucket_and_share(spark):
    df = spark.createDataFrame([("low", 0), (None, 1)], "risk_bucket string, predicted_at_risk int")
    assert [tuple(r) for r in marts.bucket_counts(df).collect()] == [("Unknown", 1), ("low", 1)]
    assert marts.risk_share(df).first()[0] == 0.5


def test_default_course_name(spark):
    got = values(spark, [(None, 7)], "n string, i bigint", E.course_name_or_default(F.col("n"), F.col("i")))
    assert got == ["Course 7"]
