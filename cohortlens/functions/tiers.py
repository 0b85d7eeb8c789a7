"""Risk tiers. Each rule is separate because the published reports disagree on thresholds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Tier codes and their Vietnamese display labels.
TIERS = ["high", "medium", "low"]
TIER_LABELS = {"low": "Thấp", "medium": "Trung bình", "high": "Cao"}


def _chain(*cases: tuple, otherwise: str) -> Column:
    expr = F
    for condition, tier in cases:
        expr = expr.when(condition, F.lit(tier))
    return expr.otherwise(F.lit(otherwise))


def grade_two_level(avg_grade: Column, pass_mark: float = 5) -> Column:
    """Below the pass mark is high; an ungraded student counts as low."""
    return _chain((avg_grade < pass_mark, "high"), otherwise="low")


def probability_bins(p: Column) -> Column:
    """Right-closed bins at .33 and .66; null and NaN fall to low."""
    return _chain(
        (p.isNull() | F.isnan(p) | (p <= 0.33), "low"),
        (p <= 0.66, "medium"),
        otherwise="high",
    )


def grade_and_lateness(avg_grade: Column, late_ratio: Column) -> Column:
    """Below 5 high; 5 to 7 inclusive, or late more than 20 percent, medium; else low."""
    return _chain(
        (avg_grade < 5, "high"),
        (avg_grade.between(5, 7) | (late_ratio > 0.2), "medium"),
        otherwise="low",
    )


def course_ratio(ratio: Column) -> Column:
    return _chain((ratio >= 0.3, "high"), (ratio >= 0.15, "medium"), otherwise="low")


def probability_display(p: Column) -> Column:
    return _chain((p >= 0.7, "high"), (p >= 0.4, "medium"), otherwise="low")


def at_risk_label(course_avg: Column, pass_mark: float = 5) -> Column:
    """1 below the pass mark; a pair without any grade counts as at risk."""
    return (F.coalesce(course_avg, F.lit(0.0)) < pass_mark).cast("int")


def progress_band(rate: Column) -> Column:
    """Bands of the uncapped progress rate."""
    return _chain(
        (rate >= 80, "on_track"), (rate >= 60, "steady"), (rate >= 40, "behind"),
        otherwise="critical",
    )


def tier_label(tier: Column) -> Column:
    pairs = [F.lit(v) for item in TIER_LABELS.items() for v in item]
    return F.create_map(*pairs)[tier]


def _codes(*entries: Column) -> Column:
    return F.array_compact(F.array(*entries))


def _either(condition: Column, yes: str, no: str) -> Column:
    return F.when(condition, F.lit(yes)).otherwise(F.lit(no))


def risk_reasons(completion: Column, late: Column, trend: Column, last_14d: Column) -> Column:
    """One code per rule, always four, in rule order; nulls count as 0."""
    zero = F.lit(0)
    return F.array(
        _either(F.coalesce(completion, zero) < 0.8, "low_completion", "good_completion"),
        _either(F.coalesce(late, zero) > 0.3, "often_late", "rarely_late"),
        _either(F.coalesce(trend, zero) < 0, "declining", "stable_or_improving"),
        _either(F.coalesce(last_14d, zero) == 0, "inactive_14d", "active_14d"),
    )


def study_tips(
    late: Column, avg_grade: Column, probability: Column,
    focus_course: Column, focus_late: Column, limit: int = 4,
) -> Column:
    """Tip codes from a student profile and the course to focus on: distinct, first ``limit``."""
    has_focus = F.coalesce(focus_course, F.lit("")) != ""
    tips = _codes(
        _either(F.coalesce(late, F.lit(0)) > 0.2, "reduce_late", "keep_on_time"),
        F.when(avg_grade < 6.5, F.lit("small_goals")),
        F.when(probability > 0.6, F.lit("meet_advisor")),
        F.when(has_focus, F.concat(F.lit("focus:"), focus_course)),
        F.when(has_focus & (focus_late > 0.15), F.concat(F.lit("draft_early:"), focus_course)),
    )
    return F.slice(F.array_distinct(tips), 1, limit)


def tips_for_intent(intent: Column, tips: Column, focus_course: Column, limit: int = 4) -> Column:
    """Adjust the general tips to what the student asked for."""
    targeted = F.array(
        F.concat(F.lit("review_rubric:"), focus_course),
        F.concat(F.lit("ask_after_each:"), focus_course),
    )
    merged = F.array_distinct(F.concat(targeted, tips))
    padded = F.when(F.size(tips) < 3, F.concat(tips, F.array(F.lit("track_board")))).otherwise(tips)
    chosen = (
        F.when((intent == "lowest_course") & focus_course.isNotNull(), merged)
        .when(intent == "study_tips", padded)
        .otherwise(tips)
    )
    return F.slice(chosen, 1, limit)
