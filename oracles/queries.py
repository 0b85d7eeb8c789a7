"""One SQL text per catalogue query that SQL can express."""

from __future__ import annotations

from oracles.base import (
    ACTIVITY,
    COURSE,
    COURSEWORK,
    PAIRS_BY_DUE,
    PAIRS_BY_SUBMIT,
    SLOPE,
    STDDEV,
    TRAINING,
    TRAINING_COLUMNS,
    avg,
    query,
    ratio,
    round_avg,
    round_ratio,
    rounded,
    stable_mean,
)

WEEK = "CAST(CAST(date_trunc('week', submitted_at) AS DATE) AS VARCHAR)"
MICROS = "CAST(sum(micros) AS BIGINT)"


def _bins(p: str) -> str:
    return f"CASE WHEN {p} IS NULL OR {p} <= 0.33 THEN 'low' WHEN {p} <= 0.66 THEN 'medium' ELSE 'high' END"


def _grade_late(grade: str, late: str) -> str:
    return (
        f"CASE WHEN {grade} < 5 THEN 'high' WHEN {grade} BETWEEN 5 AND 7 OR {late} > 0.2 "
        "THEN 'medium' ELSE 'low' END"
    )


SCORES = f"""
scores AS (
  SELECT {TRAINING_COLUMNS}, risk_probability, course_final_avg AS avg_grade,
         course_submission_count AS submission_count,
         greatest(coalesce(course_late_ratio, 0), 0) AS late_submission_ratio,
         CASE WHEN risk_probability >= 0.5 THEN 1 ELSE 0 END AS predicted_at_risk,
         {_bins('risk_probability')} AS risk_bucket
  FROM training)"""

STUDENTS = f"""
rolled AS (
  SELECT student_id, student_name, student_email, {stable_mean('course_final_avg')} AS avg_grade,
         CAST(sum(course_submission_count) AS BIGINT) AS submission_count,
         {stable_mean('course_late_ratio')} AS late_submission_ratio, max(course_load) AS course_load,
         count(DISTINCT course_id) AS courses_total,
         CAST(sum(predicted_at_risk) AS BIGINT) AS courses_at_risk,
         max(risk_probability) AS risk_probability, max(predicted_at_risk) AS predicted_at_risk
  FROM scores GROUP BY student_id, student_name, student_email),
student_features AS (SELECT *, {_bins('risk_probability')} AS risk_bucket FROM rolled)"""

RISK_BY_COURSE = f"""
risk_by_course AS (
  SELECT course_id, course_name, CAST(sum(predicted_at_risk) AS BIGINT) AS at_risk_students,
         count(DISTINCT student_id) AS total_students,
         {ratio('sum(predicted_at_risk)', 'count(DISTINCT student_id)')} AS at_risk_ratio
  FROM scores GROUP BY course_id, course_name)"""

_MART = [COURSEWORK, PAIRS_BY_DUE, TRAINING, SCORES, STUDENTS]

# The same pair clauses under other names, so both early windows fit in one statement.
_BY_SUBMIT = PAIRS_BY_SUBMIT
for _name in ("latest", "subs", "ranked", "flagged", "pair", "course_totals"):
    _BY_SUBMIT = _BY_SUBMIT.replace(f"\n{_name} AS", f"\n{_name}2 AS")
for _name in ("latest", "subs", "ranked", "flagged"):
    _BY_SUBMIT = _BY_SUBMIT.replace(f"FROM {_name}", f"FROM {_name}2")

STUDENT_COURSES = f"""
student_courses AS (
  SELECT p.student_id, d.student_name, d.student_email, p.course_id, course_name,
         coalesce({avg('micros', 'graded_n')}, 0) AS course_final_avg, n AS course_submission_count,
         {ratio('late_n', 'n')} AS course_late_ratio,
         coalesce({avg('early_micros', 'early_graded_n')}, 0) AS early_avg_grade,
         early_n AS early_submission_count, {ratio('early_late_n', 'early_n')} AS early_late_ratio,
         early_weeks AS active_weeks_early,
         coalesce({ratio('overdue', 'overdue_n')} / 3600000.0, 0) AS avg_delay_hours,
         last_14d AS submissions_last_14d, last_30d AS submissions_last_30d,
         coalesce({ratio('done', 'coalesce(total_assignments, 0)')}, 0) AS assignment_completion_ratio,
         1 AS course_load, coalesce(f.risk_probability, 0) AS risk_probability,
         coalesce(f.risk_bucket, 'low') AS risk_bucket,
         coalesce(f.predicted_at_risk, 0) AS predicted_at_risk
  FROM pair2 p JOIN dim_students d USING (student_id) JOIN dim_courses USING (course_id)
  LEFT JOIN course_totals2 USING (course_id)
  LEFT JOIN student_features f ON f.student_id = p.student_id)"""
_SC = [*_MART, _BY_SUBMIT, STUDENT_COURSES]

COURSE_SUMS = f"""
sums AS (
  SELECT course_id, count(*) AS n, count(*) FILTER (late) AS late_n, count(micros) AS graded_n,
         {MICROS} AS micros, count(DISTINCT student_id) AS student_count FROM fact GROUP BY course_id)"""

COURSE_REPORT = f"""
report AS (
  SELECT d.course_id, d.course_name, coalesce({round_avg('micros', 'graded_n')}, 0) AS avg_grade,
         coalesce({round_ratio('late_n', 'n')}, 0) AS late_ratio,
         coalesce(student_count, 0) AS student_count, coalesce(n, 0) AS total_submissions,
         coalesce(at_risk_students, 0) AS at_risk_students,
         coalesce(total_students, 0) AS total_students,
         coalesce({round_ratio('at_risk_students', 'total_students')}, 0) AS at_risk_ratio
  FROM dim_courses d LEFT JOIN sums USING (course_id)
  LEFT JOIN (SELECT course_id, at_risk_students, total_students FROM risk_by_course) r USING (course_id))"""

OVERVIEW = """
overview AS (
  SELECT (SELECT count(*) FROM student_features) AS total_students,
         (SELECT count(*) FILTER (predicted_at_risk = 1) FROM student_features) AS total_at_risk,
         (SELECT count(*) FROM dim_courses) AS total_courses,
         (SELECT count(*) FROM fact) AS total_submissions,
         (SELECT count(*) FROM fact WHERE submitted_at >=
            (SELECT max(submitted_at) FROM fact) - INTERVAL 7 DAY) AS submissions_last_7d)"""

VS_CLASS = f"""
class_avg AS (
  SELECT course_id, count(micros) AS class_n, {MICROS} AS class_micros FROM fact GROUP BY course_id),
compared AS (
  SELECT student_id, s.course_id, course_name, {rounded('course_final_avg', 2)} AS student_avg,
         {round_avg('class_micros', 'class_n')} AS class_avg,
         {rounded('course_late_ratio', 4)} AS student_late_ratio,
         course_submission_count AS student_submissions, risk_probability, risk_bucket,
         predicted_at_risk
  FROM student_courses s LEFT JOIN class_avg USING (course_id)),
vs_class AS (SELECT *, floor((student_avg - class_avg) * 100 + 0.5) / 100 AS diff_to_class FROM compared)"""

BEST_WORST = """
best_worst AS (
  SELECT student_id,
         first(course_name ORDER BY student_avg DESC, course_id) AS best_course,
         max(student_avg) AS best_avg,
         first(course_name ORDER BY student_avg, course_id) AS worst_course,
         min(student_avg) AS worst_avg,
         first(student_late_ratio ORDER BY student_avg, course_id) AS worst_late_ratio
  FROM vs_class WHERE student_avg IS NOT NULL GROUP BY student_id)"""

COMPARISON = f"""
comparison AS (
  SELECT d.course_id, d.course_name, coalesce({round_avg('micros', 'n')}, 0) AS avg_grade,
         coalesce({rounded("CASE WHEN n > 1 THEN sqrt(CAST(CAST(CAST(n AS HUGEINT) * sq - CAST(micros AS HUGEINT) * micros AS VARCHAR) AS DOUBLE) / (CAST(n AS DOUBLE) * CAST(n - 1 AS DOUBLE))) / 1000000 END", 2)}, 0) AS grade_stddev,
         coalesce(n, 0) AS total_submissions, coalesce(enrolled, 0) AS enrolled_students,
         coalesce({round_ratio('late_n', 'n')}, 0) AS late_ratio,
         strftime(last_activity, '%Y-%m-%d %H:%M:%S.%f') AS last_activity
  FROM dim_courses d
  LEFT JOIN (SELECT course_id, count(*) AS n, {MICROS} AS micros, sum(CAST(micros AS HUGEINT) * micros) AS sq,
                    count(*) FILTER (late) AS late_n, max(submitted_at) AS last_activity
             FROM fact WHERE micros IS NOT NULL GROUP BY course_id) USING (course_id)
  LEFT JOIN (SELECT course_id, count(DISTINCT student_id) AS enrolled FROM fact GROUP BY course_id)
       USING (course_id))"""

LATE_MATRIX = f"""
late_matrix AS (
  SELECT course_name, risk_bucket, {stable_mean('pair_late')} AS late_ratio
  FROM (SELECT student_id, course_id, {ratio('count(*) FILTER (late)', 'count(*)')} AS pair_late
        FROM fact GROUP BY student_id, course_id)
  JOIN (SELECT student_id, course_id, risk_bucket FROM scores) USING (student_id, course_id)
  JOIN dim_courses USING (course_id)
  GROUP BY course_name, risk_bucket)"""

COURSES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]

SUMMARY = f"""
    SELECT student_id, student_name, student_email, coalesce(a, 0) AS avg_grade, n AS submission_count,
           late_n AS late_count, {ratio('late_n', 'n')} AS late_ratio,
           CASE WHEN a < 5 THEN 'high' ELSE 'low' END AS risk_bucket
    FROM (SELECT student_id, count(*) AS n, count(*) FILTER (late) AS late_n,
                 {avg('sum(micros)', 'count(micros)')} AS a FROM fact GROUP BY student_id)
    JOIN dim_students USING (student_id)"""

# Grades with six places, of which nothing is rounded before they are summed.
_GRADE = "CAST(floor(l_quantity * 20) AS BIGINT) * 10000"
FINE = COURSEWORK.replace(_GRADE, f"CASE WHEN o_custkey % 2 = 0 THEN 4996000 ELSE {_GRADE} + 3333 END")

# -- sessions -------------------------------------------------------------------------------
HISTORY = """
    SELECT user_id AS session_id, event_id AS turn, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts,
           event_type AS role, props AS text
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
    WHERE r <= 20"""

RATE_LIMIT = """
    WITH RECURSIVE req AS (
      SELECT user_id % 5 AS session_id, event_id AS turn,
             1704067200000 + (epoch_us(ts) - 1704067200000000) // 1000000 AS t FROM events),
    opens AS (
      SELECT session_id, min(t) AS o FROM req GROUP BY session_id
      UNION ALL
      SELECT opens.session_id, min(t) FROM opens JOIN req
        ON req.session_id = opens.session_id AND req.t > o + 60000 GROUP BY opens.session_id),
    placed AS (
      SELECT req.session_id, turn, t, max(o) AS window_start, min(first_o) AS first_o
      FROM req JOIN opens ON opens.session_id = req.session_id AND o <= t
      JOIN (SELECT session_id, min(t) AS first_o FROM req GROUP BY session_id) f ON f.session_id = req.session_id
      GROUP BY req.session_id, turn, t)
    SELECT session_id, turn, window_start,
           row_number() OVER (PARTITION BY session_id, window_start ORDER BY t, turn)
             <= CASE WHEN window_start = first_o THEN 31 ELSE 30 END AS admitted FROM placed"""

# -- learning -------------------------------------------------------------------------------
FEATURES = [
    "early_avg_grade", "early_submission_count", "early_late_ratio", "active_weeks_early",
    "avg_delay_hours", "early_grade_stddev", "early_grade_trend",
]


def _bits(salt: str) -> str:
    key = f"concat_ws('-', CAST(student_id AS VARCHAR), CAST(course_id AS VARCHAR), '{salt}')"
    return f"CAST('0x' || substr(md5({key}), 1, 15) AS BIGINT), student_id, course_id"


# Exactly 15 % of all labels are flipped and 20 % of each noisy label's rows are test rows.
_FLIPS = f"row_number() OVER (ORDER BY {_bits('noise42')}) <= floor(count(*) OVER () * 0.15::DOUBLE) AS flipped"
_NOISY_LABEL = "CASE WHEN flipped THEN 1 - label ELSE label END"
_TESTS = f"""row_number() OVER (PARTITION BY {_NOISY_LABEL} ORDER BY {_bits('split42')})
    <= floor(count(*) OVER (PARTITION BY {_NOISY_LABEL}) * 0.2::DOUBLE + 0.5) AS is_test"""
MATRIX = f"""
clean AS (
  SELECT student_id, course_id, {", ".join(f"CAST({f} AS DOUBLE) AS {f}" for f in FEATURES)},
         CASE WHEN course_final_avg < 5 THEN 1 ELSE 0 END AS label
  FROM training WHERE course_submission_count > 0),
noised AS (SELECT *, {_FLIPS} FROM clean),
matrix AS (SELECT *, {_TESTS} FROM noised)"""
NOISY = "CASE WHEN flipped THEN 1 - label ELSE label END"
_ML = [COURSEWORK, PAIRS_BY_DUE, TRAINING, MATRIX]

STANDARDIZED = (
    "\nstats AS (SELECT "
    + ", ".join(f"avg({f}) AS m_{f}, stddev_pop({f}) AS d_{f}" for f in FEATURES)
    + " FROM matrix WHERE NOT is_test),\nz AS (SELECT student_id, course_id, is_test, "
    + f"{NOISY} AS noisy_label, "
    + ", ".join(
        f"round(({f} - m_{f}) / CASE WHEN d_{f} = 0 THEN 1.0 ELSE d_{f} END, 6) AS {f}" for f in FEATURES
    )
    + " FROM matrix, stats)"
)

RULES = {
    "early_avg_5": "early_avg_grade < 5",
    "early_avg_45": "early_avg_grade < 4.5",
    "early_avg_55": "early_avg_grade < 5.5",
    "late_40": "early_late_ratio > 0.4",
    "falling": "early_grade_trend < 0",
}
PREDICTIONS = "\npredictions AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, label, CASE WHEN {rule} THEN 1 ELSE 0 END AS prediction FROM matrix"
    for name, rule in RULES.items()
) + ")"
CONFUSION = """
confusion AS (
  SELECT model, count(*) FILTER (label = 1 AND prediction = 1) AS tp,
         count(*) FILTER (label = 0 AND prediction = 1) AS fp,
         count(*) FILTER (label = 1 AND prediction = 0) AS fn,
         count(*) FILTER (label = 0 AND prediction = 0) AS tn
  FROM predictions GROUP BY model)"""


def _share(a: str, b: str) -> str:
    return f"coalesce({ratio(a, b)}, 0)"


METRICS = f"""
metrics AS (
  SELECT *, {_share('(tp + tn)', 'tp + fp + fn + tn')} AS accuracy, {_share('tp', 'tp + fp')} AS "precision",
         {_share('tp', 'tp + fn')} AS recall, {_share('(2 * tp)', '2 * tp + fp + fn')} AS f1
  FROM confusion)"""
CLASS_ROWS = f"""
class_counts AS (
  SELECT '0' AS class, tn AS hit, fn AS wrong, fp AS missed FROM confusion WHERE model = 'early_avg_5'
  UNION ALL SELECT '1', tp, fp, fn FROM confusion WHERE model = 'early_avg_5'),
class_rows AS (
  SELECT class, {_share('hit', 'hit + wrong')} AS "precision", {_share('hit', 'hit + missed')} AS recall,
         {_share('(2 * hit)', '2 * hit + wrong + missed')} AS f1, hit + missed AS support FROM class_counts)"""

# -- dirty records --------------------------------------------------------------------------
RAW_SUBMISSIONS = """
raw AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
         CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_id % 97 = 0 THEN concat('x', user_id)
              ELSE CAST(user_id AS VARCHAR) END AS user_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS k, event_id, ts,
         CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS submitted,
         CASE WHEN event_id % 17 = 0 OR event_id % 11 = 0 THEN NULL ELSE event_id % 101 END AS grade
  FROM events)"""
_LATE = "CASE WHEN event_id % 7 = 0 THEN false ELSE k % 3 = 0 END"
CLEAN_SUBMISSIONS = f"""
SELECT event_id AS submission_id, CAST(user_id AS BIGINT) AS student_id, k AS assignment_id,
       strftime(submitted, '%Y-%m-%d %H:%M:%S.%f') AS submitted_at, CAST(grade AS DOUBLE) AS grade,
       {_LATE} AS late, CAST(1 AS BIGINT) AS course_id
FROM raw WHERE user_id IS NOT NULL AND submitted IS NOT NULL AND regexp_full_match(user_id, '[0-9]+')"""

_ASSIGNMENT_ID = "CASE WHEN p_partkey % 31 = 0 OR p_partkey % 37 = 0 THEN NULL ELSE p_partkey END"

NORMALIZED = """trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9% ]+', ' ', 'g'), ' ')"""
MESSAGES = """
messages AS (
  SELECT concat_ws('-', 'turn', CAST(conv_id AS VARCHAR), CAST(turn AS VARCHAR)) AS message_id, text
  FROM conversations
  UNION ALL SELECT concat_ws('-', 'doc', CAST(doc_id AS VARCHAR)), text FROM documents)"""
_SPACE = " || ".join(
    f"chr({c})"
    for c in [9, 10, 11, 12, 13, 32, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
              0x205F, 0x3000, 0xFEFF]
)


def _any(words: list[str]) -> str:
    return "(" + " OR ".join(f"contains(t, '{w}')" for w in words) + ")"


INTENT = (
    f"CASE WHEN {_any(['diem trung binh', 'avg grade', 'gpa', 'average score'])} THEN 'student_average'"
    f" WHEN {_any(['mon', 'subject', 'course'])} AND {_any(['thap', 'lowest', 'kem', 'bad', 'yeu'])}"
    " THEN 'lowest_course'"
    f" WHEN {_any(['bi quyet', 'cai thien', 'tip', 'goi y', 'improve', 'chien luoc'])} THEN 'study_tips' END"
)

WEEKLY = f"""
weekly AS (
  SELECT {WEEK} AS week, count(*) AS n, count(*) FILTER (late) AS late_n, count(micros) AS graded_n,
         {MICROS} AS micros FROM fact GROUP BY 1)"""
WEEKLY_SELECT = f"""
SELECT week, coalesce({avg('micros', 'graded_n')}, 0) AS avg_grade, {ratio('late_n', 'n')} AS late_ratio,
       n AS submissions FROM weekly"""
RECENT = """
recent AS (
  SELECT count(*) FILTER (submitted_at >= m - INTERVAL 24 HOUR) AS submissions_24h,
         count(*) FILTER (submitted_at >= m - INTERVAL 7 DAY) AS submissions_7d,
         count(DISTINCT student_id) FILTER (submitted_at >= m - INTERVAL 24 HOUR) AS active_students_24h,
         count(DISTINCT student_id) FILTER (submitted_at >= m - INTERVAL 7 DAY) AS active_students_7d
  FROM fact, (SELECT max(submitted_at) AS m FROM fact))"""

TIPS = """
tips AS (
  SELECT s.student_id, worst_course AS focus,
         [x FOR x IN [
           CASE WHEN coalesce(late_submission_ratio, 0) > 0.2 THEN 'reduce_late' ELSE 'keep_on_time' END,
           CASE WHEN avg_grade < 6.5 THEN 'small_goals' END,
           CASE WHEN risk_probability > 0.6 THEN 'meet_advisor' END,
           CASE WHEN coalesce(worst_course, '') <> '' THEN concat('focus:', worst_course) END,
           CASE WHEN coalesce(worst_course, '') <> '' AND worst_late_ratio > 0.15
                THEN concat('draft_early:', worst_course) END] IF x IS NOT NULL][1:4] AS tips
  FROM student_features s LEFT JOIN best_worst USING (student_id))"""

TIERS_ORDER = "risk_probability DESC NULLS FIRST, student_id"


def _digits() -> str:
    digits = {
        "course_final_avg": 2, "course_late_ratio": 4, "early_avg_grade": 2, "early_late_ratio": 4,
        "avg_delay_hours": 2, "assignment_completion_ratio": 4,
    }
    return ", ".join(f"{rounded(c, d)} AS {c}" for c, d in digits.items())


_STUDENT = "student_id avg_grade submission_count late_submission_ratio risk_probability predicted_at_risk"
_PERSON = "student_name student_email"
# Of each report of the bundle: the query that gives it, its numbers and its texts.
BUNDLE = {
    "overview": ("p13_overview", "total_students total_at_risk total_courses total_submissions submissions_last_7d at_risk_ratio", ""),
    "courses": ("p14_course_report", "course_id avg_grade late_ratio student_count total_submissions at_risk_students "
                "total_students at_risk_ratio", "course_name"),
    "students": ("p15_top_risk", _STUDENT, f"{_PERSON} risk_bucket"),
    "course_students": ("p16_course_students", "student_id course_id course_final_avg course_submission_count "
                        "course_late_ratio early_avg_grade early_submission_count early_late_ratio active_weeks_early "
                        "avg_delay_hours submissions_last_14d submissions_last_30d assignment_completion_ratio course_load "
                        "risk_probability predicted_at_risk", f"{_PERSON} course_name risk_bucket"),
    "top_students": ("p15_top_risk", _STUDENT, f"{_PERSON} risk_bucket"),
    "distribution": ("p17_student_distribution", "count avg_grade", "risk_bucket"),
    "trends": ("p18_weekly_trends_rounded", "avg_grade late_ratio submissions", ""),
    "heatmap": ("p19_late_heatmap", "day_of_week hour late_ratio", ""),
    "histogram": ("p20_grade_histogram", "bucket count", "label"),
    "assignments": ("p21_assignment_completion", "course_id total_assignments total_submissions total_students "
                    "completion_rate", "course_name"),
    "course_comparison": ("p23_course_comparison", "course_id avg_grade grade_stddev total_submissions enrolled_students "
                          "late_ratio", "course_name"),
    "top_performers": ("p24_top_performers", _STUDENT, _PERSON),
    "recent_activity": ("p25_recent_activity", "submissions_24h submissions_7d active_students_24h active_students_7d", ""),
}


def _bundle(known: dict[str, str]) -> str:
    """Rows of each report, the sum of its numbers in ten-thousandths and a digest of its texts."""
    parts = []
    for report, (name, numbers, texts) in BUNDLE.items():
        # The bundle is over the coursework and lists all students and pairs.
        sql = known[name].replace(ACTIVITY, COURSEWORK).replace("WHERE course_id = 1", "")
        if report in ("students", "course_students"):
            sql = sql.replace("LIMIT 20", "").replace("LIMIT 50", "")
        total = " + ".join(f"coalesce(CAST(floor(CAST({c} AS DOUBLE) * 10000 + 0.5) AS HUGEINT), 0)" for c in numbers.split())
        digest = "0"
        if texts:
            digest = f"coalesce(sum(CAST('0x' || substr(md5(concat_ws('|', {', '.join(texts.split())})), 1, 8) AS BIGINT)), 0)"
        parts.append(
            f"SELECT '{report}' AS report, count(*) AS \"rows\", CAST(coalesce(sum({total}), 0) AS DOUBLE) AS numbers, "
            f"CAST({digest} AS BIGINT) AS texts FROM ({sql})"
        )
    return " UNION ALL ".join(parts)


def oracle_sql() -> dict[str, str]:
    q = query
    cw, due = COURSEWORK, PAIRS_BY_DUE
    rank = "student_id, course_id, submission_id, rn, total_count"
    pair = "SELECT student_id, course_id, {} FROM pair".format
    histogram_bucket = "CASE WHEN avg_grade >= 10 THEN 11 WHEN avg_grade < 0 THEN 0 ELSE CAST(floor(avg_grade) AS BIGINT) + 1 END"
    full_tier = _grade_late("course_final_avg", "course_late_ratio")
    stack = []
    for i, name in enumerate(COURSES):
        cells = ["0.0"] + [f"coalesce(max(avg_grade) FILTER (course_name = '{c}'), 0)" for c in COURSES[: i + 1]]
        stack += [f"{' + '.join(cells[:-1])} AS \"{name}_from\"", f"{' + '.join(cells)} AS \"{name}_to\""]
    knn_distance = " + ".join(f"(q.{f} - t.{f}) * (q.{f} - t.{f})" for f in FEATURES)
    feature_means = [
        "early_avg_grade", "early_submission_count", "early_late_ratio", "avg_delay_hours",
        "assignment_completion_ratio", "submissions_last_14d", "submissions_last_30d", "course_load",
    ]
    sc_columns = "student_id, student_name, student_email, course_id, course_name"
    report = [*_MART, RISK_BY_COURSE, COURSE_SUMS, COURSE_REPORT]
    known = {
        "p1_training_dataset": q(cw, due, TRAINING, select=f"SELECT {TRAINING_COLUMNS} FROM training"),
        "p2_student_course_features": q(*_SC, select="SELECT * FROM student_courses"),
        "w1_early_rank": q(cw, due, select=f"SELECT {rank} FROM ranked"),
        "w2_early_rank_by_submit": q(cw, PAIRS_BY_SUBMIT, select=f"SELECT {rank} FROM ranked"),
        "w5_early_window": q(cw, due, select=f"SELECT {rank} FROM flagged WHERE early"),
        "j9_semi_early": q(cw, PAIRS_BY_SUBMIT, select="""
            SELECT student_id, course_id, count(*) AS early_submission_count,
                   max(submission_id) AS last_submission
            FROM fact WHERE submission_id IN (SELECT submission_id FROM flagged WHERE early)
            GROUP BY student_id, course_id"""),
        "a8_delay_early": q(cw, due, select=pair(
            f"{ratio('early_delay', 'early_due_n')} / 3600000.0 AS avg_delay_hours")),
        "a8_delay_strict": q(cw, due, select=pair(
            f"{ratio('overdue', 'overdue_n')} / 3600000.0 AS avg_delay_hours")),
        "a9_stddev_pop": q(cw, due, select=pair(f"{STDDEV} AS early_grade_stddev")),
        "a11_grade_trend": q(cw, due, select=pair(f"{SLOPE} AS early_grade_trend")),
        "f6_recency_14_30": q(cw, due, select=pair("last_14d, last_30d")),
        "a27_completion_ratio": q(cw, due, select=f"""
            SELECT student_id, course_id, done AS assignments_done,
                   coalesce({ratio('done', 'coalesce(total_assignments, 0)')}, 0) AS assignment_completion_ratio
            FROM pair LEFT JOIN course_totals USING (course_id)"""),
        "d1_courses_enrolled": q(cw, select="""
            SELECT student_id, count(DISTINCT course_id) AS courses_enrolled FROM fact GROUP BY student_id"""),
        "j12_named_submissions": q(cw, select="""
            SELECT submission_id, student_id, course_id, assignment_id, late,
                   strftime(submitted_at, '%Y-%m-%d %H:%M:%S.%f') AS submitted_at, micros, student_name
            FROM fact LEFT JOIN dim_students USING (student_id)"""),
        "f4_delay_hours": q(cw, select=f"""
            SELECT submission_id, (epoch_us(submitted_at) - epoch_us(due_at)) / 3.6e9 AS hours_after_deadline,
                   epoch_us(submitted_at) / 1e6 AS epoch_seconds, {WEEK} AS week,
                   dayofweek(submitted_at) AS day_of_week, hour(submitted_at) AS hour
            FROM fact LEFT JOIN dim_assignments USING (assignment_id)"""),
        "p8_full_precision": q(FINE, select=SUMMARY),
        "a9_full_precision": q(FINE, due, select=pair(
            f"coalesce({STDDEV}, 0) AS early_grade_stddev, coalesce({SLOPE}, 0) AS early_grade_trend")),
        "p8_student_summary": q(cw, select=SUMMARY),
        "p9_overview_counts": q(cw, select="""
            SELECT (SELECT count(*) FROM dim_students) AS total_students,
                   (SELECT count(*) FROM dim_courses) AS total_courses,
                   (SELECT count(*) FROM fact) AS total_submissions"""),
        "p10_course_summary": q(cw, COURSE_SUMS, select=f"""
            SELECT course_id, course_name, coalesce({avg('micros', 'graded_n')}, 0) AS avg_grade,
                   {ratio('late_n', 'n')} AS late_ratio, student_count, n AS submission_count
            FROM sums JOIN dim_courses USING (course_id)"""),
        "p11_weekly_trends": q(cw, WEEKLY, select=WEEKLY_SELECT),
        "p11_weekly_trends_activity": q(ACTIVITY, WEEKLY, select=WEEKLY_SELECT),
        "t6_weekly_stream": q(ACTIVITY, WEEKLY, select=WEEKLY_SELECT),
        "p12_course_risk_late_matrix": q(*_MART, LATE_MATRIX, select="SELECT * FROM late_matrix"),
        "p17_student_distribution": q(*_MART, select=f"""
            SELECT {_grade_late('avg_grade', 'late_submission_ratio')} AS risk_bucket, count(*) AS count,
                   {rounded(stable_mean('s.avg_grade'), 2)} AS avg_grade
            FROM student_features s GROUP BY 1"""),
        "p20_grade_histogram": q(*_MART, select=f"""
            SELECT bucket, CASE WHEN bucket = 11 THEN '10' ELSE concat(bucket - 1, '-', bucket) END AS label, count
            FROM (SELECT {histogram_bucket} AS bucket, count(*) AS count FROM student_features GROUP BY 1)"""),
        "p21_assignment_completion": q(cw, select=f"""
            SELECT course_name, course_id, coalesce(a, 0) AS total_assignments, coalesce(n, 0) AS total_submissions,
                   coalesce(s, 0) AS total_students, coalesce({round_ratio('g', 'n')}, 0) AS completion_rate
            FROM dim_courses LEFT JOIN (
              SELECT course_id, count(DISTINCT assignment_id) AS a, count(*) AS n, count(micros) AS g,
                     count(DISTINCT student_id) AS s FROM fact GROUP BY course_id) USING (course_id)"""),
        "p23_course_comparison": q(cw, COMPARISON, select="SELECT * FROM comparison"),
        "a23_course_feature_means": q(*_SC, select=f"""
            SELECT course_id, count(*) AS students,
                   {", ".join(f"{stable_mean(f'coalesce(CAST({c} AS DOUBLE), 0)')} AS {c}" for c in feature_means)},
                   {stable_mean('course_final_avg')} AS avg_grade,
                   {ratio('count(*) FILTER (predicted_at_risk = 1)', 'count(*)')} AS at_risk_ratio
            FROM student_courses GROUP BY course_id"""),
        "a24_platform_means": q(*report, OVERVIEW, select=f"""
            SELECT (SELECT {stable_mean('avg_grade')} FROM report) AS avg_of_course_avgs,
                   {ratio('total_submissions', 'total_students')} AS submissions_per_student,
                   (1 - {ratio('total_at_risk', 'total_students')}) * 100 AS safe_percent FROM overview"""),
        "a3_sketched_students": q(cw, select="""
            SELECT course_id, count(*) AS submissions, count(DISTINCT student_id) AS student_count,
                   strftime(max(submitted_at), '%Y-%m-%d %H:%M:%S.%f') AS last_activity, true AS within_error
            FROM fact GROUP BY course_id"""),
        "a4_sketched_activity": q(ACTIVITY, RECENT, select="""
            SELECT submissions_24h, submissions_7d, true AS students_24h_within_error, true AS students_7d_within_error
            FROM recent"""),
        "a4_stayed_and_left": q(ACTIVITY, select="""
            SELECT course_id, count(*) FILTER (a AND b) AS in_both, count(*) FILTER (a AND NOT b) AS in_first,
                   count(*) FILTER (b AND NOT a) AS in_second, true AS within_error
            FROM (SELECT course_id, student_id,
                         bool_or(submitted_at >= TIMESTAMP '2024-01-01' AND submitted_at < TIMESTAMP '2024-01-16') AS a,
                         bool_or(submitted_at >= TIMESTAMP '2024-01-16' AND submitted_at < TIMESTAMP '2024-02-01') AS b
                  FROM fact GROUP BY course_id, student_id)
            GROUP BY course_id"""),
        "a25_tier_counts": q(*_SC, select=f"""
            SELECT course_id, count(*) FILTER (tier = 'high') AS high, count(*) FILTER (tier = 'medium') AS medium,
                   count(*) FILTER (tier = 'low') AS low
            FROM (SELECT course_id, {full_tier} AS tier FROM student_courses) GROUP BY course_id"""),
        "a26_equal_width_histogram": q(*_MART, select="""
            SELECT bin, lo + (hi - lo) / 20 * bin AS bin_from, lo + (hi - lo) / 20 * (bin + 1) AS bin_to,
                   coalesce(count, 0) AS count
            FROM (SELECT min(avg_grade) AS lo, max(avg_grade) AS hi FROM student_features),
                 (SELECT unnest(range(20)) AS bin)
            LEFT JOIN (SELECT least(CAST(floor((avg_grade - a) / ((b - a) / 20)) AS BIGINT), 19) AS bin, count(*) AS count
                       FROM student_features,
                            (SELECT min(avg_grade) AS a, max(avg_grade) AS b FROM student_features)
                       GROUP BY 1) USING (bin)"""),
        "p18_weekly_trends_rounded": q(ACTIVITY, WEEKLY, select=f"""
            SELECT week, {round_avg('micros', 'graded_n')} AS avg_grade, {round_ratio('late_n', 'n')} AS late_ratio,
                   n AS submissions FROM weekly"""),
        "p19_late_heatmap": q(ACTIVITY, select=f"""
            SELECT day_of_week, hour, {round_ratio('late_n', 'n')} AS late_ratio
            FROM (SELECT dayofweek(submitted_at) AS day_of_week, hour(submitted_at) AS hour, count(*) AS n,
                         count(*) FILTER (late) AS late_n FROM fact GROUP BY 1, 2)"""),
        "p25_recent_activity": q(ACTIVITY, RECENT, select="SELECT * FROM recent"),
        "f12_activity_trend": q(ACTIVITY, RECENT, select="""
            SELECT *, (submissions_24h - nullif(submissions_7d, 0) / 7.0::DOUBLE)
                      / (nullif(submissions_7d, 0) / 7.0::DOUBLE) * 100 AS trend_percent FROM recent"""),
        "p16_course_students": q(*_SC, select=f"""
            SELECT * REPLACE ({_digits()}) FROM student_courses WHERE course_id = 1
            ORDER BY {TIERS_ORDER}, course_id LIMIT 50"""),
        "p22_student_trend": q(cw, select=f"""
            SELECT student_id, week, {round_avg('c', 'n')} AS avg_grade, n AS submissions, late_n AS late_count
            FROM (SELECT student_id, {WEEK} AS week, count(*) AS n, {MICROS} AS c, count(*) FILTER (late) AS late_n
                  FROM fact WHERE micros IS NOT NULL GROUP BY 1, 2)"""),
        "p24_top_performers": q(*_MART, select=f"""
            SELECT student_id, student_name, student_email, {rounded('avg_grade', 2)} AS avg_grade, submission_count,
                   {rounded('late_submission_ratio', 4)} AS late_submission_ratio, risk_probability, predicted_at_risk
            FROM student_features s WHERE s.avg_grade IS NOT NULL
            ORDER BY s.avg_grade DESC, s.submission_count DESC, student_id LIMIT 10"""),
        "p27_student_course_vs_class": q(*_SC, VS_CLASS, select="SELECT * FROM vs_class"),
        "p28_student_profile": q(*_MART, select="""
            SELECT student_id, student_name, avg_grade, late_submission_ratio, submission_count, risk_probability,
                   risk_bucket, predicted_at_risk FROM student_features WHERE student_id = 7 LIMIT 1"""),
        "o7_top_by_grade": q(*_MART, select="""
            SELECT student_id, student_name, avg_grade, risk_bucket FROM student_features
            ORDER BY avg_grade DESC NULLS LAST, student_id LIMIT 20"""),
        "o7_top_pairs_by_risk": q(*_MART, select="""
            SELECT concat(student_name, ' (', course_name, ')') AS label, risk_probability FROM scores
            ORDER BY risk_probability DESC NULLS LAST, student_id, course_id LIMIT 10"""),
        "o8_top3_courses": q(*report, select="""
            SELECT course_id, course_name, avg_grade FROM report ORDER BY avg_grade DESC, course_id LIMIT 3"""),
        "o10_best_worst_course": q(*_SC, VS_CLASS, BEST_WORST, select="SELECT * FROM best_worst"),
        "o10_course_chart": q(*_SC, VS_CLASS, select="""
            SELECT student_id, course_id, course_name, student_avg, class_avg FROM (
              SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY student_avg DESC, course_id) AS r
              FROM vs_class WHERE student_avg IS NOT NULL) WHERE r <= 2"""),
        "c11_student_search": q(*_SC, select=f"""
            SELECT student_id, course_id, student_name, course_final_avg, course_late_ratio FROM student_courses
            WHERE contains(lower(student_name), 'customer#00000000') AND {full_tier} = 'medium'"""),
        "c12_course_search": q(*report, select="""
            SELECT * FROM report WHERE contains(lower(course_name), 'm')
            AND at_risk_ratio >= 0.3 AND at_risk_ratio < 1"""),
        "o9_course_sorts": q(*report, select=" UNION ALL ".join(
            f"SELECT '{sort}' AS sort, course_id, row_number() OVER (ORDER BY {by}, course_id) AS place FROM report"
            for sort, by in {
                "name": "course_name", "avg_grade": "coalesce(avg_grade, 0) DESC",
                "student_count": "coalesce(student_count, 0) DESC", "risk": "coalesce(at_risk_ratio, 0) DESC",
            }.items())),
        "c13_high_risk": q(*_MART, select="""
            SELECT student_id, risk_probability FROM student_features WHERE risk_probability >= 0.7"""),
        "f13_progress_rate": q(cw, COMPARISON, select="""
            SELECT course_id, course_name, least(rate, 100.0) AS progress_rate,
                   CASE WHEN rate >= 80 THEN 'on_track' WHEN rate >= 60 THEN 'steady'
                        WHEN rate >= 40 THEN 'behind' ELSE 'critical' END AS band,
                   least(avg_grade * 10, 100.0) AS grade_bar
            FROM (SELECT *, CAST(total_submissions AS DOUBLE) / coalesce(nullif(enrolled_students, 0), 1)
                            / 20 * 100 AS rate FROM comparison)"""),
        "p3_student_course_scores_fixed": q(*_MART, select="SELECT * FROM scores"),
        "p4_student_features": q(*_MART, select="SELECT * FROM student_features"),
        "p5_at_risk_rows": q(*_MART, select="SELECT * FROM scores WHERE predicted_at_risk = 1"),
        "p6_risk_by_course": q(*_MART, RISK_BY_COURSE, select="SELECT * FROM risk_by_course"),
        "p13_overview": q(*_MART, OVERVIEW, select=f"""
            SELECT *, {ratio('total_at_risk', 'total_students')} AS at_risk_ratio FROM overview"""),
        "p14_course_report": q(*report, select="SELECT * FROM report"),
        "p15_top_risk": q(*_MART, select=f"""
            SELECT student_id, student_name, student_email, {rounded('avg_grade', 2)} AS avg_grade, submission_count,
                   {rounded('late_submission_ratio', 4)} AS late_submission_ratio, risk_probability, risk_bucket,
                   predicted_at_risk FROM student_features ORDER BY {TIERS_ORDER} LIMIT 20"""),
        "o5_scores_by_risk": q(*_MART, select="SELECT student_id, course_id, risk_probability FROM scores"),
        "o6_worst_25": q(*_MART, select=f"""
            SELECT {sc_columns}, avg_grade, course_final_avg, submission_count, late_submission_ratio,
                   risk_probability, risk_bucket FROM scores ORDER BY {TIERS_ORDER}, course_id LIMIT 25"""),
        "p29_teacher_course_stats": q(*_MART, select="""
            SELECT course_id % 3 AS teacher_id, course_name, count(*) AS total_students,
                   count(*) FILTER (predicted_at_risk = 1) AS at_risk_students FROM scores GROUP BY 1, 2"""),
        "p30_platform_counts": q(*_MART, OVERVIEW, select="""
            SELECT total_students, total_at_risk AS at_risk_students, total_courses, total_submissions FROM overview"""),
        "p34_features_from_flagged": q(*_MART, select=f"""
            SELECT {sc_columns}, course_final_avg, course_submission_count,
                   late_submission_ratio AS course_late_ratio, 1 AS course_load,
                   coalesce(early_avg_grade, avg_grade) AS early_avg_grade,
                   coalesce(early_submission_count, submission_count) AS early_submission_count,
                   coalesce(early_late_ratio, late_submission_ratio) AS early_late_ratio, 1 AS active_weeks_early,
                   avg_delay_hours, submissions_last_14d, submissions_last_30d, assignment_completion_ratio,
                   risk_probability, risk_bucket, predicted_at_risk FROM scores WHERE predicted_at_risk = 1"""),
        "a21_bucket_counts": q(*_MART, select="""
            SELECT coalesce(risk_bucket, 'Unknown') AS risk_bucket, count(*) AS count FROM student_features GROUP BY 1"""),
        "a22_risk_share": q(*_MART, select=f"""
            SELECT {ratio('sum(predicted_at_risk)', 'count(*)')} AS at_risk_share FROM student_features"""),
        "p31_course_pivot": q(cw, COURSE_SUMS, select="SELECT course_name, " + ", ".join(
            f"max(CASE WHEN course_id = {i} THEN coalesce({avg('micros', 'graded_n')}, 0) END) AS course_{i}"
            for i in range(1, 7)) + " FROM sums JOIN dim_courses USING (course_id) GROUP BY course_name"),
        "p32_risk_course_pivot": q(*_MART, LATE_MATRIX, select="SELECT risk_bucket, " + ", ".join(
            f"coalesce(max(late_ratio) FILTER (course_name = '{c}'), 0) AS \"{c}\"" for c in COURSES)
            + " FROM late_matrix GROUP BY risk_bucket"),
        "p33_week_course_stack": q(cw, select=f"""
            SELECT week, {", ".join(stack)} FROM (
              SELECT {WEEK} AS week, course_name, coalesce({avg('sum(micros)', 'count(micros)')}, 0) AS avg_grade
              FROM fact JOIN dim_courses USING (course_id) GROUP BY 1, 2) GROUP BY week"""),
        "b_all_tiers": q(*_MART, select=f"""
            SELECT student_id, course_id, CASE WHEN course_final_avg < 5 THEN 'high' ELSE 'low' END AS b1_grade,
                   risk_bucket AS b2_bins, {full_tier} AS b3_grade_late,
                   CASE WHEN course_late_ratio >= 0.3 THEN 'high' WHEN course_late_ratio >= 0.15 THEN 'medium'
                        ELSE 'low' END AS b4_ratio,
                   CASE WHEN risk_probability >= 0.7 THEN 'high' WHEN risk_probability >= 0.4 THEN 'medium'
                        ELSE 'low' END AS b5_display,
                   CASE WHEN course_final_avg < 5 THEN 1 ELSE 0 END AS b6_label,
                   CASE risk_bucket WHEN 'low' THEN 'Thấp' WHEN 'medium' THEN 'Trung bình' ELSE 'Cao' END
                     AS b2_display_label FROM scores"""),
        "b7_risk_reasons": q(*_MART, select="""
            SELECT student_id, course_id, concat_ws(',',
              CASE WHEN assignment_completion_ratio < 0.8 THEN 'low_completion' ELSE 'good_completion' END,
              CASE WHEN course_late_ratio > 0.3 THEN 'often_late' ELSE 'rarely_late' END,
              CASE WHEN early_grade_trend < 0 THEN 'declining' ELSE 'stable_or_improving' END,
              CASE WHEN submissions_last_14d = 0 THEN 'inactive_14d' ELSE 'active_14d' END) AS reasons FROM scores"""),
        "b8_study_tips": q(*_SC, VS_CLASS, BEST_WORST, TIPS, select="""
            SELECT student_id, array_to_string(tips, ',') AS tips,
                   array_to_string(CASE WHEN focus IS NULL THEN tips ELSE list_concat(
                     [concat('review_rubric:', focus), concat('ask_after_each:', focus)], tips)[1:4] END, ',')
                     AS lowest_course_tips,
                   array_to_string(CASE WHEN len(tips) < 3 THEN list_append(tips, 'track_board') ELSE tips END, ',')
                     AS study_tips FROM tips"""),
        "c9_finite_features": q(cw, due, select=pair(
            f"CASE WHEN {STDDEV} > 0 THEN coalesce(({SLOPE}) / ({STDDEV}), 0) ELSE 0 END AS relative_trend")),
        "c14_first_truthy": q(*_MART, select="""
            SELECT student_id, course_id,
                   coalesce(nullif(early_avg_grade, 0), nullif(course_final_avg, 0), 0) AS shown_grade,
                   coalesce(nullif(early_late_ratio, 0), nullif(course_late_ratio, 0), 0) AS shown_late_ratio
            FROM scores"""),
        "c1_clean_students": """
            SELECT c_custkey AS student_id, c_name AS student_name,
                   CASE WHEN c_custkey % 5 <> 0 THEN lower(c_name) ELSE '' END AS student_email
            FROM customer WHERE c_custkey % 41 <> 0""",
        "c2_clean_assignments": f"""
            SELECT {_ASSIGNMENT_ID} AS assignment_id,
                   CASE WHEN p_partkey % 29 <> 0 THEN {COURSE} END AS course_id, p_name AS assignment_name,
                   CASE WHEN p_partkey % 19 <> 0 THEN strftime(
                     CAST(DATE '2024-01-01' + CAST(p_size AS INTEGER) AS TIMESTAMP), '%Y-%m-%d %H:%M:%S.%f') END AS due_at,
                   CASE WHEN p_partkey % 23 <> 0 THEN CAST(p_partkey % 20 AS DOUBLE) END AS points_possible,
                   '2023-12-01 00:00:00.000000' AS created_at
            FROM part WHERE {_ASSIGNMENT_ID} IS NOT NULL""",
        "c3_clean_submissions": q(RAW_SUBMISSIONS, select=CLEAN_SUBMISSIONS),
        "s6_csv_round_trip": q(RAW_SUBMISSIONS, select=CLEAN_SUBMISSIONS),
        "c4_drop_reasons": q(RAW_SUBMISSIONS, select="""
            SELECT CASE WHEN user_id IS NULL THEN 'missing_student' WHEN submitted IS NULL THEN 'never_submitted'
                        WHEN NOT regexp_full_match(user_id, '[0-9]+') THEN 'bad_student_id' ELSE 'kept' END AS reason,
                   count(*) AS count FROM raw GROUP BY 1"""),
        "c4_quarantine": q(RAW_SUBMISSIONS, select="""
            SELECT CAST(id AS BIGINT) AS submission_id,
                   CASE WHEN user_id IS NULL THEN 'missing_student' WHEN submitted IS NULL THEN 'never_submitted'
                        WHEN NOT regexp_full_match(user_id, '[0-9]+') THEN 'bad_student_id' ELSE 'kept' END AS reason
            FROM raw"""),
        "s1_read_courses": """
            SELECT s_suppkey AS course_id, s_name AS course_name, concat('C', s_suppkey) AS course_code,
                   CAST(NULL AS BIGINT) AS teacher_id
            FROM supplier WHERE s_suppkey % 9 <> 0 AND s_suppkey % 4 <> 0""",
        "s2_read_students": """
            SELECT CAST(c_custkey AS VARCHAR) AS id, c_name AS name,
                   CASE WHEN c_custkey % 3 = 2 THEN lower(c_name)
                        WHEN c_custkey % 5 <> 0 THEN concat(lower(c_name), '@example.com') END AS login_id
            FROM customer""",
        "s3_read_assignments": f"""
            SELECT CASE WHEN p_partkey % 31 = 0 THEN NULL WHEN p_partkey % 37 = 0 THEN 'none'
                        ELSE CAST(p_partkey AS VARCHAR) END AS assignment_id,
                   CASE WHEN p_partkey % 29 = 0 THEN '?' ELSE CAST({COURSE} AS VARCHAR) END AS course_id, p_name AS assignment_name,
                   CASE WHEN p_partkey % 19 = 0 THEN 'soon' ELSE
                     CAST(DATE '2024-01-01' + CAST(p_size AS INTEGER) AS VARCHAR) END AS due_at,
                   CASE WHEN p_partkey % 23 = 0 THEN 'ten' ELSE CAST(p_partkey % 20 AS VARCHAR) END AS points_possible,
                   '2023-12-01' AS created_at FROM part""",
        "s4_read_submissions": q(RAW_SUBMISSIONS, select="""
            SELECT '1' AS course_id, CAST(k AS VARCHAR) AS assignment_id, count(*) AS records,
                   count(*) FILTER (user_id IS NULL) AS missing_user FROM raw GROUP BY k"""),
        "s4_flat_submissions": q(RAW_SUBMISSIONS, select="""
            SELECT id, user_id, CAST(k AS VARCHAR) AS assignment_id,
                   CASE WHEN event_id % 13 = 0 THEN NULL WHEN event_id % 101 = 0 THEN 'not-a-date'
                        ELSE regexp_replace(regexp_replace(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), '0+$', ''), '\\.$', '')
                   END AS submitted_at,
                   CASE WHEN event_id % 17 = 0 THEN 'A+' WHEN event_id % 11 = 0 THEN NULL
                        ELSE CAST(event_id % 101 AS VARCHAR) END AS grade,
                   CASE WHEN event_id % 7 = 0 THEN NULL WHEN k % 3 = 0 THEN 'True' ELSE 'False' END AS late,
                   '1' AS course_id FROM raw"""),
        "s8_refreshed_table": q(RAW_SUBMISSIONS, select=CLEAN_SUBMISSIONS),
        "s9_replaced_table": """
            SELECT c_custkey AS student_id, c_name AS student_name,
                   CASE WHEN c_custkey % 5 <> 0 THEN lower(c_name) ELSE '' END AS student_email, length(c_name) AS name_length
            FROM customer WHERE c_custkey % 41 <> 0""",
        "s10_exported_csv": f"""
            SELECT {_ASSIGNMENT_ID} AS assignment_id, CASE WHEN p_partkey % 29 <> 0 THEN {COURSE} END AS course_id
            FROM part WHERE {_ASSIGNMENT_ID} IS NOT NULL""",
        "s11_absent_table": """
            SELECT c_custkey AS student_id, c_name AS student_name,
                   CASE WHEN c_custkey % 5 <> 0 THEN lower(c_name) ELSE '' END AS student_email
            FROM customer WHERE c_custkey % 41 <> 0""",
        "s5_page_guard": """
            WITH pages AS (SELECT conv_id AS entity, turn + 1 AS page_no, length(text) // 200 AS payload FROM conversations),
            flagged AS (SELECT *, payload = lag(payload) OVER (PARTITION BY entity ORDER BY page_no) AS repeated
                        FROM pages)
            SELECT entity, page_no FROM flagged f
            WHERE page_no < coalesce((SELECT min(page_no) FROM flagged g WHERE g.entity = f.entity AND g.repeated), 1000)""",
        "m1_matrix": q(*_ML, select=f"SELECT student_id, course_id, {', '.join(FEATURES)}, label FROM matrix"),
        "m2_label_noise": q(*_ML, select=f"""
            SELECT student_id, course_id, label, flipped, {NOISY} AS noisy_label FROM matrix"""),
        "m3_split": q(*_ML, select=f"SELECT student_id, course_id, {NOISY} AS noisy_label, is_test FROM matrix"),
        "m4_standardized": q(*_ML, STANDARDIZED, select=f"""
            SELECT student_id, course_id, {', '.join(FEATURES)}, noisy_label, is_test FROM z"""),
        **{
            name: q(*_ML, select=f"""
            SELECT count(*) AS test_rows, CAST(sum({NOISY}) AS BIGINT) AS positives, true AS beats_larger_class,
                   true AS ranks_by_label, true AS train_loss_below_constant
                   {", true AS stationary" if name.startswith("m5") else ""}
            FROM matrix WHERE is_test""")
            for name in ("m5_logistic_regression", "m6_random_forest", "m7_gradient_boosting", "m8_kernel_svm")
        },
        "m13_score_all_pairs": q(*_ML, select="""
            SELECT student_id, course_id, course_submission_count, true AS scored
            FROM matrix JOIN training USING (student_id, course_id)"""),
        "m14_saved_model": q(*_ML, select="""
            SELECT count(*) AS test_rows, true AS same_after_reload FROM matrix WHERE is_test"""),
        "m15_single_model": q(*_ML, select="SELECT DISTINCT student_id, true AS scored FROM matrix"),
        "p7_model_evaluation": q(*_ML, select=f"""
            SELECT unnest(['Accuracy', 'Precision', 'Recall', 'F1-Score']) AS metric, test_rows, positives, true AS scored
            FROM (SELECT count(*) AS test_rows, CAST(sum({NOISY}) AS BIGINT) AS positives FROM matrix WHERE is_test)"""),
        "m9_knn": q(*_ML, STANDARDIZED, select=f"""
            , near AS (
              SELECT q.student_id, q.course_id, t.noisy_label, row_number() OVER (
                PARTITION BY q.student_id, q.course_id
                ORDER BY {knn_distance}, t.student_id, t.course_id) AS r
              FROM (SELECT * FROM z WHERE is_test) q, (SELECT * FROM z WHERE NOT is_test) t)
            SELECT student_id, course_id, sum(noisy_label) / 5.0::DOUBLE AS risk_probability,
                   CASE WHEN sum(noisy_label) >= 3 THEN 1 ELSE 0 END AS prediction
            FROM near WHERE r <= 5 GROUP BY student_id, course_id"""),
        "m10_metrics": q(*_ML, PREDICTIONS, CONFUSION, METRICS, select="""
            SELECT * EXCLUDE (model) FROM metrics WHERE model = 'early_avg_5'"""),
        "m11_class_report": q(*_ML, PREDICTIONS, CONFUSION, CLASS_ROWS, select=f"""
            SELECT * FROM class_rows
            UNION ALL SELECT 'macro avg', avg("precision"), avg(recall), avg(f1), sum(support) FROM class_rows
            UNION ALL SELECT 'weighted avg', {_share('sum("precision" * support)', 'sum(support)')},
                   {_share('sum(recall * support)', 'sum(support)')}, {_share('sum(f1 * support)', 'sum(support)')},
                   sum(support) FROM class_rows"""),
        "m12_comparison": q(*_ML, PREDICTIONS, CONFUSION, METRICS, select="""
            SELECT model, 'Accuracy' AS metric, accuracy AS score FROM metrics
            UNION ALL SELECT model, 'Precision', "precision" FROM metrics
            UNION ALL SELECT model, 'Recall', recall FROM metrics UNION ALL SELECT model, 'F1', f1 FROM metrics"""),
        "m12_best_model": q(*_ML, PREDICTIONS, CONFUSION, METRICS, select="""
            SELECT * FROM metrics ORDER BY f1 DESC, list_position(
              ['falling', 'late_40', 'early_avg_45', 'early_avg_5', 'early_avg_55'], model) LIMIT 1"""),
        "f11_normalized_text": q(MESSAGES, select=f"SELECT message_id, md5({NORMALIZED}) AS normalized_md5 FROM messages"),
        "t1_intents": q(MESSAGES, select=f"""
            SELECT message_id, {INTENT} AS intent FROM (SELECT message_id, {NORMALIZED} AS t FROM messages)"""),
        "t2_history": HISTORY,
        "t2_history_stream": HISTORY,
        "t3_rate_limit": RATE_LIMIT,
        "t3_rate_limit_stream": RATE_LIMIT,
        "t4_validation": q(MESSAGES, select=f"""
            SELECT message_id, reason AS reject_reason, reason IS NULL AS accepted FROM (
              SELECT message_id, CASE WHEN text IS NULL THEN 'missing' WHEN b = '' THEN 'empty'
                WHEN length(b) + length(regexp_replace(b, '[^\\x{{10000}}-\\x{{10FFFF}}]', '', 'g')) > 2000
                THEN 'too_long' END AS reason
              FROM (SELECT message_id, text, trim(text, {_SPACE}) AS b FROM messages))"""),
        "t5_activity_stream": """
            WITH hit AS (
              SELECT date_trunc('hour', ts) - to_hours(CAST(h AS INTEGER)) AS w
              FROM events, (SELECT unnest(range(24)) AS h))
            SELECT strftime(w, '%Y-%m-%d %H:%M:%S.%f') AS window_start,
                   strftime(w + INTERVAL 24 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS window_end, count(*) AS submissions,
                   true AS students_within_error
            FROM hit GROUP BY w""",
    }
    return known | {"p26_dashboard_bundle": _bundle(known)}
