"""Published tables derived from scored (student, course) rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens import schemas
from cohortlens.functions import exprs as E
from cohortlens.functions import tiers


def student_course_scores(scored: DataFrame) -> DataFrame:
    """Training rows plus ``risk_probability`` and ``predicted_at_risk`` as the score table."""
    return scored.withColumns(
        {
            "avg_grade": F.col("course_final_avg"),
            "submission_count": F.coalesce("course_submission_count", F.lit(0)),
            "late_submission_ratio": F.greatest(
                F.coalesce("course_late_ratio", F.lit(0.0)), F.lit(0.0)
            ),
            "risk_bucket": tiers.probability_bins(F.col("risk_probability")),
        }
    ).select(*schemas.SCORE_COLUMNS)


def student_features(scored: DataFrame) -> DataFrame:
    """Roll-up to one row per student; rows without a student id are dropped."""
    keys = ["student_id", "student_name", "student_email"]
    rolled = (
        scored.dropna(subset=keys)
        .groupBy(*keys)
        .agg(
            E.stable_mean(F.col("course_final_avg")).alias("avg_grade"),
            F.sum("course_submission_count").alias("submission_count"),
            E.stable_mean(F.col("course_late_ratio")).alias("late_submission_ratio"),
            F.max("course_load").alias("course_load"),
            F.count("course_id").alias("courses_total"),
            F.sum("predicted_at_risk").alias("courses_at_risk"),
            F.max("risk_probability").alias("risk_probability"),
            F.max("predicted_at_risk").alias("predicted_at_risk"),
        )
    )
    bucket = tiers.probability_bins(F.col("risk_probability"))
    return rolled.withColumn("risk_bucket", bucket).select(*schemas.STUDENT_COLUMNS)


def at_risk_rows(scores: DataFrame) -> DataFrame:
    """(student, course) rows predicted at risk. Readers sort; the table itself has no order."""
    return scores.filter(F.col("predicted_at_risk") == 1)


def risk_by_course(scored: DataFrame) -> DataFrame:
    """Flagged and total students per course. The pair grain makes a distinct count needless."""
    at_risk, total = F.col("at_risk_students"), F.col("total_students")
    return (
        scored.dropna(subset=["course_id", "course_name"])
        .groupBy("course_id", "course_name")
        .agg(
            F.sum("predicted_at_risk").alias("at_risk_students"),
            F.count("student_id").alias("total_students"),
        )
        .withColumn("at_risk_ratio", F.coalesce(E.ratio(at_risk, total), F.lit(0.0)))
    )


def bucket_counts(rows: DataFrame) -> DataFrame:
    """Rows per risk bucket, a missing bucket as Unknown, in label order."""
    label = F.coalesce("risk_bucket", F.lit("Unknown")).alias("risk_bucket")
    return rows.groupBy(label).agg(F.count("*").alias("count")).orderBy("risk_bucket")


def risk_share(rows: DataFrame) -> DataFrame:
    """Mean of the predicted flag."""
    flagged, n = F.sum("predicted_at_risk"), F.count("predicted_at_risk")
    return rows.agg(E.ratio(flagged, n).alias("at_risk_share"))


def course_features_from_flagged(flagged: DataFrame) -> DataFrame:
    """Older feature-table definition: flagged rows only, early columns falling back to totals."""
    fallback = {
        "early_avg_grade": "avg_grade",
        "early_submission_count": "submission_count",
        "early_late_ratio": "late_submission_ratio",
    }
    zero = ["avg_delay_hours", "submissions_last_14d", "submissions_last_30d",
            "assignment_completion_ratio"]
    return flagged.select(
        "student_id",
        "student_name",
        "student_email",
        "course_id",
        "course_name",
        F.col("avg_grade").alias("course_final_avg"),
        F.col("submission_count").alias("course_submission_count"),
        F.col("late_submission_ratio").alias("course_late_ratio"),
        F.lit(1).alias("course_load"),
        *[F.coalesce(early, total).alias(early) for early, total in fallback.items()],
        F.lit(1).alias("active_weeks_early"),
        *[F.coalesce(c, F.lit(0)).alias(c) for c in zero],
        "risk_probability",
        "risk_bucket",
        "predicted_at_risk",
    )
