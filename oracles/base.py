"""DuckDB views of the test data, as WITH clauses shared by the check queries."""

COURSE = """CAST(CASE p_type WHEN 'ECONOMY' THEN 1 WHEN 'LARGE' THEN 2 WHEN 'MEDIUM' THEN 3
    WHEN 'PROMO' THEN 4 WHEN 'SMALL' THEN 5 ELSE 6 END AS BIGINT)"""

COURSEWORK = f"""
fact AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
                   CAST(CAST(l_shipdate AS DATE) AS VARCHAR)) AS submission_id,
         o_custkey AS student_id, {COURSE} AS course_id, l_partkey AS assignment_id,
         CASE WHEN l_discount = 0.1 THEN NULL ELSE CAST(floor(l_quantity * 20) AS BIGINT) * 10000 END AS micros,
         l_returnflag = 'R' AS late, l_shipdate AS submitted_at
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
dim_students AS (
  SELECT c_custkey AS student_id, c_name AS student_name,
         concat(lower(replace(c_name, '#', '.')), '@example.com') AS student_email FROM customer),
dim_courses AS (SELECT DISTINCT {COURSE} AS course_id, p_type AS course_name FROM part),
dim_assignments AS (
  SELECT p_partkey AS assignment_id, {COURSE} AS course_id, p_name AS assignment_name,
         TIMESTAMP '1995-01-01' + to_days(CAST(p_size * 50 AS INTEGER)) AS due_at FROM part)"""

ACTIVITY = """
fact AS (
  SELECT event_id AS submission_id, user_id AS student_id,
         CAST(CASE event_type WHEN 'click' THEN 1 WHEN 'error' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 ELSE 5 END AS BIGINT) AS course_id,
         CAST(json_extract(props, '$.k') AS BIGINT) AS assignment_id,
         CASE WHEN event_id % 11 = 0 THEN NULL ELSE (event_id % 101) * 100000 END AS micros,
         CAST(json_extract(props, '$.k') AS BIGINT) % 3 = 0 AS late, ts AS submitted_at
  FROM events)"""

# Pair statistics with the early window ordered by {order}; the deadline is looked up first.
_PAIRS = """
latest AS (SELECT max(submitted_at) AS t FROM fact),
subs AS (
  SELECT f.*, a.due_at, epoch_ms(f.submitted_at) AS x,
         epoch_ms(f.submitted_at) - epoch_ms(a.due_at) AS delay_ms
  FROM fact f LEFT JOIN dim_assignments a USING (assignment_id)),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY student_id, course_id ORDER BY {order}) AS rn,
         count(*) OVER (PARTITION BY student_id, course_id) AS total_count FROM subs),
flagged AS (
  SELECT *, rn <= greatest(1, (total_count * 6 + 9) // 10) AS early FROM ranked),
pair AS (
  SELECT student_id, course_id, count(*) AS n, count(*) FILTER (late) AS late_n,
         count(micros) AS graded_n, CAST(sum(micros) AS BIGINT) AS micros,
         count(*) FILTER (early) AS early_n,
         count(*) FILTER (early AND late) AS early_late_n,
         count(micros) FILTER (early) AS early_graded_n,
         CAST(sum(micros) FILTER (early) AS BIGINT) AS early_micros,
         CAST(sum(CAST(micros AS HUGEINT) * micros) FILTER (early) AS HUGEINT) AS early_sq,
         CAST(sum(x) FILTER (early AND micros IS NOT NULL) AS HUGEINT) AS sx,
         sum(CAST(x AS HUGEINT) * x) FILTER (early AND micros IS NOT NULL) AS sxx,
         sum(CAST(x AS HUGEINT) * micros) FILTER (early AND micros IS NOT NULL) AS sxy,
         count(DISTINCT date_trunc('week', submitted_at)) FILTER (early) AS early_weeks,
         count(DISTINCT assignment_id) AS done,
         count(delay_ms) FILTER (early) AS early_due_n,
         sum(greatest(delay_ms, 0)) FILTER (early AND delay_ms IS NOT NULL) AS early_delay,
         count(*) FILTER (delay_ms > 0) AS overdue_n,
         sum(delay_ms) FILTER (delay_ms > 0) AS overdue,
         count(*) FILTER (submitted_at >= (SELECT t FROM latest) - INTERVAL 14 DAY) AS last_14d,
         count(*) FILTER (submitted_at >= (SELECT t FROM latest) - INTERVAL 30 DAY) AS last_30d
  FROM flagged GROUP BY student_id, course_id),
course_totals AS (
  SELECT course_id, count(*) AS total_assignments FROM dim_assignments GROUP BY course_id)"""

PAIRS_BY_DUE = _PAIRS.format(order="coalesce(due_at, submitted_at), submitted_at, submission_id")
PAIRS_BY_SUBMIT = _PAIRS.format(order="submitted_at, submission_id")

# A correctly rounded HUGEINT to DOUBLE conversion goes through text.
WIDE = "CAST(CAST({} AS VARCHAR) AS DOUBLE)".format
SLOPE = (
    WIDE("(CAST(early_graded_n AS HUGEINT) * sxy - sx * early_micros)")
    + " / nullif(" + WIDE("(CAST(early_graded_n AS HUGEINT) * sxx - sx * sx)") + ", 0) / 1000.0"
)
STDDEV = (
    "sqrt(" + WIDE("(early_graded_n * early_sq - CAST(early_micros AS HUGEINT) * early_micros)")
    + ") / nullif(early_graded_n, 0) / 1000000"
)


def avg(total: str, n: str) -> str:
    return f"CAST({total} AS DOUBLE) / nullif({n}, 0) / 1000000"


def ratio(num: str, den: str) -> str:
    return f"CAST({num} AS DOUBLE) / nullif({den}, 0)"


def round_avg(total: str, n: str) -> str:
    return f"CAST((2 * {total} + 10000 * {n}) // nullif(20000 * {n}, 0) AS DOUBLE) / 100"


def round_ratio(num: str, den: str, digits: int = 4) -> str:
    unit = 10**digits
    return f"CAST(({num} * {2 * unit} + {den}) // nullif(2 * {den}, 0) AS DOUBLE) / {unit}"


def rounded(value: str, digits: int) -> str:
    return f"CAST(round(CAST({value} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def stable_mean(value: str) -> str:
    total = f"sum(CAST(floor({value} * 1e10 + 0.5) AS BIGINT))"
    return f"CAST({total} AS DOUBLE) / nullif(count({value}), 0) / 1e10"


TRAINING = f"""
training AS (
  SELECT p.student_id, student_name, student_email, p.course_id, course_name,
         CAST(sum(p.n) OVER (PARTITION BY p.student_id) AS BIGINT) AS course_load,
         n AS course_submission_count, {ratio('late_n', 'n')} AS course_late_ratio,
         coalesce({avg('early_micros', 'early_graded_n')}, 0) AS early_avg_grade,
         early_n AS early_submission_count, {ratio('early_late_n', 'early_n')} AS early_late_ratio,
         early_weeks AS active_weeks_early, coalesce({STDDEV}, 0) AS early_grade_stddev,
         coalesce({SLOPE}, 0) AS early_grade_trend,
         coalesce({ratio('early_delay', 'early_due_n')} / 3600000.0, 0) AS avg_delay_hours,
         last_14d AS submissions_last_14d, last_30d AS submissions_last_30d,
         coalesce({ratio('done', 'coalesce(total_assignments, 0)')}, 0) AS assignment_completion_ratio,
         coalesce({avg('micros', 'graded_n')}, 0) AS course_final_avg,
         CASE WHEN coalesce({avg('micros', 'graded_n')}, 0) < 5 THEN 1 ELSE 0 END AS is_at_risk,
         CAST(10000000 * graded_n - coalesce(micros, 0) AS DOUBLE) / nullif(10000000 * graded_n, 0) AS risk_probability
  FROM pair p JOIN dim_students USING (student_id) JOIN dim_courses USING (course_id)
  LEFT JOIN course_totals USING (course_id))"""

TRAINING_COLUMNS = """student_id, student_name, student_email, course_id, course_name, course_load,
  course_submission_count, course_late_ratio, early_avg_grade, early_submission_count,
  early_late_ratio, active_weeks_early, early_grade_stddev, early_grade_trend, avg_delay_hours,
  submissions_last_14d, submissions_last_30d, assignment_completion_ratio, course_final_avg, is_at_risk"""


def query(*clauses: str, select: str) -> str:
    return "WITH " + ",".join(clauses) + "\n" + select
