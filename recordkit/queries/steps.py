"""One query per operator over the given tables, each with SQL written apart from the Spark code."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from recordkit.functions.rules import any_flag, band_level, derived_yes_no, flag, growth, masked_id, percent
from recordkit.functions.text import date_text, full_name, join_text, month_year_to_date, pad_zeros, school_year_code, without, word_capitals
from recordkit.functions.weeks import week_over_week_text, with_duration_text
from recordkit.operators.changes import ColumnPair, compare_columns, last_change_dates, merge_change_dates, packed_code, stored_change_dates, where_changed
from recordkit.operators.grades import credit_totals, enrolled_at_period_end, first_rule, gpa, quality_points, scale_points
from recordkit.operators.joins import left_fan, left_join_where, renamed
from recordkit.operators.keys import active_or_latest, first_row_flags, latest_per_key
from recordkit.operators.lookup import decode_options, one_option_per_id
from recordkit.operators.measures import ScoreKind, attendance_rate, distinct_events, latest_scores, rate_columns, with_presence
from recordkit.operators.ranking import rank_in_group
from recordkit.operators.reshape import unpivot_scores
from recordkit.operators.tickets import Week, calendar, channel_counts, count_where
from recordkit.operators.updates import keyed_update, keyed_update_files
from recordkit.operators.uploads import upload_rejects
from recordkit.operators.windows import AssessmentWindow, course_member, school_member
from recordkit.queries.registry import query
from recordkit.queries.sis import model, model_sql
from recordkit.queries.tables import MONEY, Tables
from recordkit.sources.params import optional_equals, value_or_all
from recordkit.sources.tables import Upload, new_folder, read_upload, read_upload_rows, repeated_keys, stage
from recordkit.sources.versions import create_version, version

SPANS = """
WITH spans AS (
    SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority, o_totalprice::DECIMAL(18,2) AS total, o_orderdate::DATE AS start_date,
        CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::DATE END AS end_date
    FROM orders)
"""

# ---------------------------------------------------------------- keys


@query(
    "latest_per_key",
    SPANS
    + """SELECT c_custkey, c_name, n_name, arg_min(o_orderkey, (end_date IS NOT NULL, -epoch(end_date), o_orderkey)) AS o_orderkey,
        CASE WHEN count(end_date) = count(*) THEN max(end_date)::VARCHAR END AS end_date
    FROM spans JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL""",
)
def _latest_per_key(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    newest = latest_per_key(t.order_spans(), ["o_custkey"], "end_date", ["o_orderkey"])
    return (
        newest.join(t.customer, F.col("c_custkey") == F.col("o_custkey"))
        .join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
        .select("c_custkey", "c_name", "n_name", "o_orderkey", "end_date")
    )


@query(
    "active_or_latest",
    SPANS
    + """SELECT o_custkey, o_orderkey, start_date::VARCHAR AS start_date, end_date::VARCHAR AS end_date,
        CASE WHEN end_date IS NULL THEN 'N' ELSE 'Y' END AS withdrawn
    FROM spans
    QUALIFY end_date IS NULL OR row_number() OVER (PARTITION BY o_custkey ORDER BY end_date DESC NULLS FIRST, o_orderkey) = 1""",
)
def _active_or_latest(spark: SparkSession, folder: str) -> DataFrame:
    spans = Tables(spark, folder).order_spans().select("o_custkey", "o_orderkey", "start_date", "end_date")
    return active_or_latest(spans, ["o_custkey"], "end_date", ["o_orderkey"])


@query(
    "first_row_flags",
    """WITH spans AS (SELECT o_custkey, o_orderpriority, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::DATE END AS end_date, o_orderdate::DATE AS start_date
        FROM orders)
    SELECT o_custkey, o_orderpriority, end_date::VARCHAR AS end_date, start_date::VARCHAR AS start_date,
        (row_number() OVER (PARTITION BY o_custkey ORDER BY end_date DESC NULLS FIRST, o_orderpriority, start_date) = 1)::INTEGER AS newest_by_end,
        (row_number() OVER (PARTITION BY o_custkey ORDER BY start_date DESC NULLS FIRST, o_orderpriority, end_date NULLS FIRST) = 1)::INTEGER AS newest_by_start
    FROM spans""",
)
def _first_row_flags(spark: SparkSession, folder: str) -> DataFrame:
    spans = Tables(spark, folder).order_spans().select("o_custkey", "o_orderpriority", "end_date", "start_date")
    marked = first_row_flags(spans, ["o_custkey"], {"newest_by_end": "end_date", "newest_by_start": "start_date"})
    return marked.withColumns({c: F.col(c).cast("int") for c in ("newest_by_end", "newest_by_start")})


# ---------------------------------------------------------------- measures


@query(
    "rate_flag",
    """WITH days AS (SELECT l_orderkey, sum((l_returnflag = 'N')::INTEGER)::BIGINT AS p, count(*) AS n FROM lineitem GROUP BY 1),
    rates AS (SELECT *, ((p * 20000 + n) // (2 * n))::DOUBLE / 100 AS rate FROM days)
    SELECT o_orderkey, p::DOUBLE AS present, n AS total, rate, (rate < 90)::INTEGER AS below_threshold FROM orders LEFT JOIN rates ON l_orderkey = o_orderkey""",
)
def _rate_flag(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    days = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), (F.col("l_returnflag") == "N").cast("int").alias("value"))
    counted = t.orders.select("o_orderkey").join(attendance_rate(days, ["o_orderkey"], "value"), "o_orderkey", "left")
    rate = rate_columns(F.col("present"), F.col("total"), 90)
    return counted.withColumns(rate)


@query(
    "distinct_per_key",
    """SELECT c_custkey, nullif(count(DISTINCT l_suppkey), 0) AS events, (count(l_suppkey) > 0)::INTEGER AS has_events
    FROM customer LEFT JOIN orders ON o_custkey = c_custkey LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1""",
)
def _distinct_per_key(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    bought = t.lineitem.select("l_orderkey", "l_suppkey").join(
        t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey")), F.col("l_orderkey") == F.col("o_orderkey")
    )
    per_customer = distinct_events(bought, ["c_custkey"], "l_suppkey")
    return with_presence(t.customer.select("c_custkey").join(per_customer, "c_custkey", "left"), "events", "has_events")


_SCORE_TABLES = ("test_history_tests", "test_history_parts", "test_history_score_types", "test_history_administrations", "test_history_scores")


@query(
    "latest_score_star",
    f"""WITH {model_sql(*_SCORE_TABLES)},
    taken AS (SELECT a.student_id, a.administration_date AS d, a.id AS a, t.title, p.id AS p, s.score, s.test_code
        FROM test_history_scores s, test_history_administrations a, test_history_tests t, test_history_parts p, test_history_score_types y
        WHERE a.id = s.administration_id AND t.id = s.test_id AND a.test_id = t.id AND p.id = s.part_id AND p.test_id = t.id AND y.id = s.score_type_id
            AND y.short_name = 'AL' AND (t.title LIKE '%FSA ELA%' OR t.title ILIKE '%fsa math%')),
    newest AS (SELECT student_id, arg_min((d, title, score), (-epoch(d), a, title, p, score, coalesce(test_code, ''))) AS best FROM taken GROUP BY 1)
    SELECT student_id, best[1]::VARCHAR AS administration_date, best[2] AS test, best[3] AS score FROM newest""",
)
def _latest_score_star(spark: SparkSession, folder: str) -> DataFrame:
    sis = model(spark, folder)
    kind = ScoreKind(F.col("test").like("%FSA ELA%") | F.col("test").ilike("%FSA MATH%"), "AL")
    tests, parts, types, administrations, scores = (sis[n] for n in _SCORE_TABLES)
    newest = latest_scores(administrations, tests, parts, scores, types, {"newest": kind})
    return newest.filter("newest IS NOT NULL").select("student_id", "newest.administration_date", "newest.test", "newest.score")


# ---------------------------------------------------------------- rules


@query(
    "proficiency_band",
    """SELECT o_orderkey, o_orderpriority, nullif(list_position(['1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW'], o_orderpriority), 0)::INTEGER AS level FROM orders""",
)
def _proficiency_band(spark: SparkSession, folder: str) -> DataFrame:
    bands = ("1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW")
    return Tables(spark, folder).orders.select("o_orderkey", "o_orderpriority", band_level(F.col("o_orderpriority"), bands).alias("level"))


@query(
    "growth",
    SPANS
    + """, ends AS (SELECT o_custkey, arg_max(total, (start_date, o_orderkey)) AS later, arg_min(total, (start_date, o_orderkey)) AS earlier FROM spans GROUP BY 1),
    texts AS (SELECT o_custkey, CASE WHEN o_custkey % 10 = 0 THEN 'absent' ELSE floor(later)::BIGINT::VARCHAR END AS later, floor(earlier)::BIGINT::VARCHAR AS earlier FROM ends)
    SELECT o_custkey, try_cast(later AS BIGINT) - try_cast(earlier AS BIGINT) AS growth, (growth > 0)::INTEGER AS made_growth FROM texts""",
)
def _growth(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder).order_spans()
    place = F.struct("start_date", "o_orderkey")
    ends = t.groupBy("o_custkey").agg(F.max_by("total", place).alias("later"), F.min_by("total", place).alias("earlier"))

    def text(name: str) -> Column:
        return F.floor(name).cast("bigint").cast("string")

    later = F.when(F.col("o_custkey") % 10 == 0, "absent").otherwise(text("later"))
    gained = ends.select("o_custkey", growth(later, text("earlier")).alias("growth"))
    return gained.withColumn("made_growth", flag(F.col("growth") > 0, F.col("growth")))


_COURSES = """
WITH courses AS (
    SELECT l_orderkey, l_linenumber, l_quantity::DECIMAL(18,4) AS credits, CASE WHEN l_linenumber = 7 THEN 'X' ELSE translate(l_returnflag, 'ANR', 'ABF') END AS letter,
        CASE WHEN l_linenumber = 6 THEN '79' ELSE '12' END || l_linenumber AS course_num, CASE l_linestatus WHEN 'F' THEN 'five' ELSE 'other' END AS title FROM lineitem),
remapped AS (SELECT *, CASE WHEN course_num LIKE '79%' THEN 'four' WHEN title = 'five' THEN 'seven' ELSE title END AS scale FROM courses),
pointed AS (SELECT *, CASE WHEN letter IN ('A', 'B') AND scale IN ('seven', 'four') THEN CASE scale WHEN 'seven' THEN 7 ELSE 4 END - (letter = 'B')::INTEGER
    WHEN letter = 'F' THEN 0 ELSE 99 END AS points FROM remapped)
"""
_STEP_SCALES = {"seven": 7, "four": 4}


def _courses(t: Tables) -> DataFrame:
    """Line items as courses with a letter, a scale and points; scale ``other`` is unmapped."""
    line = F.col("l_linenumber")
    courses = t.lineitem.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").cast("decimal(18,4)").alias("credits"),
        F.when(line == 7, "X").otherwise(F.translate("l_returnflag", "ANR", "ABF")).alias("letter"),
        join_text(F.when(line == 6, "79").otherwise("12"), line.cast("string")).alias("course_num"),
        F.when(F.col("l_linestatus") == "F", "five").otherwise("other").alias("title"),
    )
    rules = [(F.col("course_num").like("79%"), F.lit("four")), (F.col("title") == "five", F.lit("seven"))]
    courses = courses.withColumn("scale", first_rule(rules, F.col("title")))
    return scale_points(courses, "scale", "letter", "points", _STEP_SCALES, ("F", "P", "T", "W"))


@query("scale_points", _COURSES + "SELECT title, scale, letter, points, count(*) AS courses, sum(credits)::DOUBLE AS credits FROM pointed GROUP BY ALL")
def _scale_points(spark: SparkSession, folder: str) -> DataFrame:
    courses = _courses(Tables(spark, folder))
    return courses.groupBy("title", "scale", "letter", "points").agg(F.count(F.lit(1)).alias("courses"), F.sum("credits").alias("credits"))


_GPAS = (
    _COURSES
    + """, sums AS (
    SELECT c_custkey, n_name, c_mktsegment, sum(credits) AS credits, sum(round(credits * points, 3)) AS quality
    FROM pointed JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY ALL),
gpas AS (SELECT *, ((quality * 10000)::BIGINT::HUGEINT * 20000 + (credits * 10000)::BIGINT) // (2 * (credits * 10000)::BIGINT) AS g FROM sums)
"""
)


def _gpas(t: Tables) -> DataFrame:
    """GPA per customer; courses are summed per order before they meet the customers."""
    courses = _courses(t).withColumn("quality", quality_points(F.col("credits"), F.col("points")))
    per_order = credit_totals(courses, ["l_orderkey"], ["credits", "quality"])
    owners = t.orders.select("o_orderkey", F.col("o_custkey").alias("c_custkey"))
    per_customer = credit_totals(per_order.join(owners, F.col("l_orderkey") == F.col("o_orderkey")), ["c_custkey"], ["credits", "quality"])
    people = t.customer.join(t.nation, F.col("n_nationkey") == F.col("c_nationkey")).select("c_custkey", "n_name", "c_mktsegment")
    return per_customer.join(people, "c_custkey").withColumn("gpa", gpa(F.col("quality"), F.col("credits")).cast("decimal(18,4)"))


@query("quality_gpa", _GPAS + "SELECT c_custkey, n_name, c_mktsegment, credits::DOUBLE AS credits, quality::DOUBLE AS quality, g::DOUBLE / 10000 AS gpa FROM gpas")
def _quality_gpa(spark: SparkSession, folder: str) -> DataFrame:
    return _gpas(Tables(spark, folder))


@query(
    "class_rank_percentile",
    _GPAS
    + """, ranked AS (SELECT *, rank() OVER (PARTITION BY n_name, c_mktsegment ORDER BY g DESC) AS gpa_rank,
        rank() OVER (PARTITION BY n_name, c_mktsegment ORDER BY credits DESC) AS credit_rank, count(*) OVER (PARTITION BY n_name, c_mktsegment) AS students FROM gpas)
    SELECT c_custkey, n_name, c_mktsegment, gpa_rank, credit_rank, abs(credit_rank - gpa_rank) AS rank_change, students,
        ((gpa_rank * 20000 + students) // (2 * students))::DOUBLE / 100 AS percentile FROM ranked""",
)
def _class_rank_percentile(spark: SparkSession, folder: str) -> DataFrame:
    group = ["n_name", "c_mktsegment"]
    gpas = _gpas(Tables(spark, folder))
    ranked = rank_in_group(gpas, group, {"gpa": "gpa_rank", "credits": "credit_rank"}, size="students", bucket_width=10)
    return ranked.select(
        "c_custkey",
        *group,
        "gpa_rank",
        "credit_rank",
        F.abs(F.col("credit_rank") - F.col("gpa_rank")).alias("rank_change"),
        "students",
        percent(F.col("gpa_rank"), F.col("students")).alias("percentile"),
    )


# ---------------------------------------------------------------- periods and windows


@query(
    "period_end_window",
    SPANS
    + """, ends AS (SELECT *, last_day(start_date) AS period_end FROM spans)
    SELECT o_orderkey, coalesce(end_date, period_end)::VARCHAR AS counted_until FROM ends
    WHERE coalesce(end_date, period_end) BETWEEN period_end - 10 AND period_end""",
)
def _period_end_window(spark: SparkSession, folder: str) -> DataFrame:
    spans = Tables(spark, folder).order_spans().withColumn("period_end", F.last_day("start_date"))
    kept = enrolled_at_period_end(spans, "end_date", "period_end", 10)
    return kept.select("o_orderkey", F.coalesce("end_date", "period_end").alias("counted_until"))


@query(
    "window_membership",
    """WITH spans AS (SELECT o_custkey, o_orderkey, o_orderdate::DATE AS s, CASE WHEN o_orderstatus <> 'O' THEN o_orderdate::DATE + 30 END AS e FROM orders),
    marked AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY e DESC NULLS FIRST, o_orderkey) = 1 AS last_end,
        row_number() OVER (PARTITION BY o_custkey ORDER BY s DESC, o_orderkey) = 1 AS last_start FROM spans),
    judged AS (SELECT *, s <= DATE '1998-07-01' AS started,
        (e IS NULL AND started) OR (e BETWEEN DATE '1998-07-01' AND DATE '1998-12-31' AND started) OR (s BETWEEN DATE '1996-01-01' AND DATE '1998-07-01' AND e IS NOT NULL AND last_end) AS course,
        (e IS NULL AND started) OR (e BETWEEN DATE '1998-07-01' AND DATE '1998-12-31' AND started AND last_start) OR (s >= DATE '1996-01-01' AND e IS NOT NULL AND last_end) AS school FROM marked)
    SELECT o_custkey, o_orderkey, CASE WHEN course THEN 'Yes' ELSE 'No' END AS coe, CASE WHEN school THEN 'Yes' ELSE 'No' END AS soe,
        CASE WHEN course AND school THEN 'Yes' ELSE 'No' END AS counted FROM judged""",
)
def _window_membership(spark: SparkSession, folder: str) -> DataFrame:
    start = F.col("start_date")
    spans = Tables(spark, folder).order_spans().select("o_custkey", "o_orderkey", "start_date", F.date_add("end_date", 30).alias("end_date"))
    marked = first_row_flags(spans, ["o_custkey"], {"_by_end": "end_date", "_by_start": "start_date"})
    w = AssessmentWindow(dt.date(1996, 1, 1), dt.date(1998, 7, 1), dt.date(1998, 12, 31))
    course = course_member(w, start, F.col("end_date"), F.col("_by_end"))
    school = school_member(w, start, F.col("end_date"), F.col("_by_start"), F.col("_by_end"))

    def shown(condition: Column) -> Column:
        return F.when(condition, "Yes").otherwise("No")

    return marked.select("o_custkey", "o_orderkey", shown(course).alias("coe"), shown(school).alias("soe"), shown(course & school).alias("counted"))


# ---------------------------------------------------------------- reshape

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query(
    "unpivot_scores",
    """WITH sheet AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber = 1 THEN NULL ELSE l_quantity::DECIMAL(18,2)::VARCHAR END AS a,
        l_extendedprice::DECIMAL(18,2)::VARCHAR AS b, l_discount::DECIMAL(18,2)::VARCHAR AS c, l_tax::DECIMAL(18,2)::VARCHAR AS d FROM lineitem),
    tall AS (SELECT l_orderkey, l_linenumber, unnest(['Overall Score', '01', '02', '03']) AS question, unnest([a, b, c, d]) AS v FROM sheet),
    keyed AS (SELECT '0' || (r_regionkey + 2) AS k, r_name AS standard FROM region UNION ALL SELECT '03', 'second')
    SELECT l_orderkey, l_linenumber, question, CASE WHEN question = 'Overall Score' THEN v END AS score,
        CASE WHEN question <> 'Overall Score' THEN v END AS answer, standard
    FROM tall LEFT JOIN keyed ON k = question WHERE question = 'Overall Score' OR k IS NOT NULL""",
)
def _unpivot_scores(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    sheet = t.lineitem.select("l_orderkey", "l_linenumber", *[F.col(c).cast(MONEY).cast("string").alias(c) for c in _MEASURES])
    sheet = sheet.withColumn("l_quantity", F.when(F.col("l_linenumber") != 1, F.col("l_quantity")))
    key = t.region.select((F.col("r_regionkey") + 2).alias("question"), F.col("r_name").alias("standard"))
    second = spark.createDataFrame([(3, "second")], "question int, standard string")
    return unpivot_scores(sheet, ["l_orderkey", "l_linenumber"], "l_quantity", _MEASURES[1:], key.unionByName(second), ["standard"])


# ---------------------------------------------------------------- changes


@query(
    "packed_code",
    """WITH coded AS (SELECT c_custkey, CASE WHEN o_orderstatus = 'F' THEN o_orderpriority[3:3] END AS prim,
        CASE WHEN o_orderstatus = 'P' THEN o_orderpriority[3:4] END AS oth FROM customer LEFT JOIN orders ON o_custkey = c_custkey)
    SELECT c_custkey, rpad(coalesce(string_agg(prim, '' ORDER BY prim), 'Z'), 1, 'Z') || rpad(coalesce(string_agg(oth, '' ORDER BY oth), 'Z'), 9, 'Z') AS code
    FROM coded GROUP BY 1""",
)
def _packed_code(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    status = F.col("o_orderstatus")
    code = F.substring("o_orderpriority", 3, F.when(status == "F", 1).otherwise(2)).alias("code")
    counted = t.orders.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus", code).agg(F.count(F.lit(1)).alias("copies"))
    codes = t.customer.select("c_custkey").join(counted, "c_custkey", "left")
    return packed_code(codes, ["c_custkey"], "code", status == "F", status == "P", copies="copies")


# An event log as an audit log: views and signups are no updates.
_CHANGES = """, log AS (SELECT user_id, event_type, ts, props FROM events WHERE event_type IN ('click', 'purchase', 'error') AND ts >= DATE '2024-01-10'
    AND user_id % 100 IN (SELECT s_suppkey FROM supplier)),
dates AS (SELECT user_id, max(ts) FILTER (WHERE props LIKE '%k_: 1%')::DATE AS low, max(ts) FILTER (WHERE props LIKE '%7}')::DATE AS seven FROM log
    WHERE props LIKE '%k_: 1%' OR props LIKE '%7}' GROUP BY 1)
"""


_CHANGE_PATTERNS = {"low": "%k_: 1%", "seven": "%7}"}


def _change_log(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Events as an audit log (views and signups are no updates), and its editors."""
    log = t.events.select(
        F.col("user_id").alias("c_custkey"),
        (F.col("user_id") % 100).alias("user_id"),
        F.when(F.col("event_type").isin("click", "purchase", "error"), "UPDATE").otherwise("INSERT").alias("action"),
        F.col("props").alias("after"),
        F.col("ts").alias("log_time"),
    )
    return log, t.supplier.select(F.col("s_suppkey").alias("user_id"))


def _changes(t: Tables) -> DataFrame:
    log, editors = _change_log(t)
    return last_change_dates(log, "c_custkey", _CHANGE_PATTERNS, dt.date(2024, 1, 10), editors, t.customer)


@query(
    "last_change_date",
    "WITH none AS (SELECT 1)"
    + _CHANGES
    + "SELECT user_id AS c_custkey, strftime(low, '%Y%m%d') AS low, strftime(seven, '%Y%m%d') AS seven FROM dates WHERE user_id IN (SELECT c_custkey FROM customer)",
)
def _last_change_date(spark: SparkSession, folder: str) -> DataFrame:
    return _changes(Tables(spark, folder)).select("c_custkey", date_text("low").alias("low"), date_text("seven").alias("seven"))


@query(
    "last_change_date_merged",
    "WITH none AS (SELECT 1)"
    + _CHANGES
    + "SELECT user_id AS c_custkey, strftime(low, '%Y%m%d') AS low, strftime(seven, '%Y%m%d') AS seven FROM dates WHERE user_id IN (SELECT c_custkey FROM customer)",
)
def _last_change_date_merged(spark: SparkSession, folder: str) -> DataFrame:
    """The state after three runs, each of which reads its part of the log, is that of one pass over all of it."""
    t = Tables(spark, folder)
    (log, editors), root = _change_log(t), new_folder(spark, "change-dates")
    for until in (dt.datetime(2024, 1, 14), dt.datetime(2024, 1, 22, 12), dt.datetime(2100, 1, 1)):
        state = merge_change_dates(root, log, "c_custkey", _CHANGE_PATTERNS, until, editors, late=dt.timedelta(hours=1))
    dates = stored_change_dates(state, "c_custkey", dt.date(2024, 1, 10), t.customer)
    return dates.select("c_custkey", date_text("low").alias("low"), date_text("seven").alias("seven"))


_COMPARED = """
WITH altered AS (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL WHEN c_custkey % 3 = 0 THEN 'OTHER' ELSE c_mktsegment END AS segment,
    (c_nationkey + (c_custkey % 4 = 0)::INTEGER)::VARCHAR AS nation, CASE WHEN c_custkey % 7 = 0 THEN '0' ELSE 'Z' END AS code FROM customer),
compared AS (SELECT c.c_custkey, segment AS file_segment, c_mktsegment AS system_segment, CASE WHEN segment <> c_mktsegment THEN 'Y' END AS segment_change,
    lpad(nation, 2, '0') AS file_nation, lpad(c_nationkey::VARCHAR, 2, '0') AS system_nation, CASE WHEN file_nation <> system_nation THEN 'Y' END AS nation_change,
    nullif(code, '0') AS file_code, c_name[1:1] AS system_code, CASE WHEN replace(code, '0', 'Z') <> CASE WHEN c_custkey % 2 = 0 THEN 'Z' ELSE 'C' END THEN 'Y' END AS code_change
    FROM customer c JOIN altered USING (c_custkey))
"""


def _compared(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    file = t.customer.select(
        key.alias("file_key"),
        F.when(key % 5 == 0, None).when(key % 3 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("segment"),
        (F.col("c_nationkey") + (key % 4 == 0).cast("int")).cast("string").alias("nation"),
        F.when(key % 7 == 0, "0").otherwise("Z").alias("code"),
    )
    rows = file.join(t.customer, key == F.col("file_key"), "left")
    pairs = [
        ColumnPair("file_segment", F.col("segment"), "system_segment", F.col("c_mktsegment"), "segment_change"),
        ColumnPair("file_nation", pad_zeros("nation", 2), "system_nation", F.lpad(F.col("c_nationkey").cast("string"), 2, "0"), "nation_change"),
        ColumnPair(
            "file_code",
            F.nullif(F.col("code"), F.lit("0")),
            "system_code",
            F.substring("c_name", 1, 1),
            "code_change",
            F.when(F.col("code") == "0", "Z").otherwise(F.col("code")),
            F.when(key % 2 == 0, "Z").otherwise("C"),
        ),
    ]
    return rows.select("c_custkey", *compare_columns(pairs))


@query("compare_columns", _COMPARED + "SELECT * FROM compared")
def _compare_columns(spark: SparkSession, folder: str) -> DataFrame:
    return _compared(Tables(spark, folder))


@query(
    "any_change",
    _COMPARED + "SELECT DISTINCT system_segment, system_nation, nullif(greatest(segment_change, nation_change, code_change), '') AS has_change FROM compared",
)
def _any_change(spark: SparkSession, folder: str) -> DataFrame:
    flags = any_flag([F.col(c) for c in ("segment_change", "nation_change", "code_change")])
    return _compared(Tables(spark, folder)).select("system_segment", "system_nation", flags.alias("has_change")).distinct()


@query(
    "change_date_if_changed",
    _COMPARED
    + _CHANGES
    + """SELECT c_custkey, segment_change, CASE WHEN segment_change = 'Y' THEN strftime(low, '%Y%m%d') END AS segment_change_date,
        nation_change, CASE WHEN nation_change = 'Y' THEN strftime(seven, '%Y%m%d') END AS nation_change_date
    FROM compared LEFT JOIN dates ON user_id = c_custkey""",
)
def _change_date_if_changed(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    dates = renamed(_changes(t), "d_")
    any_changed = (F.col("segment_change") == "Y") | (F.col("nation_change") == "Y")
    joined = left_join_where(_compared(t), dates, (F.col("d_c_custkey") == F.col("c_custkey")) & any_changed, ["d_c_custkey"])
    return joined.select(
        "c_custkey",
        "segment_change",
        where_changed("segment_change", date_text("d_low")).alias("segment_change_date"),
        "nation_change",
        where_changed("nation_change", date_text("d_seven")).alias("nation_change_date"),
    )


# ---------------------------------------------------------------- joins and lookups


@query(
    "left_join_fan",
    """SELECT c_custkey, (SELECT nullif(count(*), 0) FROM orders WHERE o_custkey = c_custkey) AS orders,
        (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F') AS largest_closed,
        (SELECT nullif(count(*), 0) FROM events WHERE user_id = c_custkey) AS events,
        (SELECT nullif(count(DISTINCT event_type), 0) FROM events WHERE user_id = c_custkey AND value > 10) AS event_types
    FROM customer""",
)
def _left_join_fan(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    orders = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    events = t.events.withColumnRenamed("user_id", "c_custkey")
    sides = [
        orders.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("orders"), F.max(F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice"))).alias("largest_closed")),
        events.groupBy("c_custkey").agg(F.count(F.lit(1)).alias("events")),
        distinct_events(events.filter("value > 10"), ["c_custkey"], "event_type").withColumnRenamed("events", "event_types"),
    ]
    return left_fan(t.customer.select("c_custkey"), sides, ["c_custkey"])


@query(
    "pseudonymise",
    """SELECT c_custkey - 7 - 1000 AS shown_id, CASE WHEN shown_id % 2 = 0 OR abs(shown_id) % 10 IN (7, 9) THEN 'Yes' ELSE 'No' END AS derived_flag, c_mktsegment FROM customer""",
)
def _pseudonymise(spark: SparkSession, folder: str) -> DataFrame:
    shown = masked_id(F.col("c_custkey"), 7, 1000)
    return Tables(spark, folder).customer.select(shown.alias("shown_id"), derived_yes_no(shown).alias("derived_flag"), "c_mktsegment")


_SEGMENTS = "option AS (SELECT id, code, label FROM (VALUES (1, 'A', 'A - AUTO'), (2, 'B', 'B - BUILD, Ltd'), (3, 'F', 'F - FURN'), (4, 'H', 'H - HOUSE')) v(id, code, label))"


@query(
    "option_decode",
    f"""WITH {_SEGMENTS}, given AS (SELECT *, c_custkey % 6 AS option_id FROM customer)
    SELECT c_custkey, code AS option_code, replace(replace(label, 'A - ', ''), ', Ltd', '') AS option_label,
        CASE WHEN code IN ('A', 'B') THEN 'Yes' ELSE 'No' END AS chosen FROM given LEFT JOIN option ON id = option_id""",
)
def _option_decode(spark: SparkSession, folder: str) -> DataFrame:
    rows = [(1, "A", "A - AUTO"), (2, "B", "B - BUILD, Ltd"), (3, "F", "F - FURN"), (4, "H", "H - HOUSE")]
    options = one_option_per_id(spark.createDataFrame(rows, "id long, code string, label string"))
    given = Tables(spark, folder).customer.select("c_custkey", (F.col("c_custkey") % 6).alias("option_id"))
    decoded = decode_options(given, options, {"option_code": ("option_id", "code"), "_label": ("option_id", "label")})
    chosen = F.when(F.col("option_code").isin("A", "B"), "Yes").otherwise("No")
    return decoded.select("c_custkey", "option_code", without(F.col("_label"), "A - ", ", Ltd").alias("option_label"), chosen.alias("chosen"))


def _capitals(text: str) -> str:
    return f"array_to_string([upper(w[1]) || lower(w[2:]) for w in regexp_extract_all({text}, '[A-Za-z0-9]+|[^A-Za-z0-9]+')], '')"


@query(
    "text_clean",
    f"""SELECT p_partkey, {_capitals("p_brand || '-' || p_name || '/' || p_type")} AS capitals,
        {_capitals("concat(p_type, ', ', CASE WHEN p_size % 5 = 0 THEN NULL ELSE p_name END)")} AS full_name,
        concat(p_brand, NULL, p_size) AS joined, replace(replace(p_name, 'red ', ''), 'hot ', '') AS cleaned,
        concat(substr(lpad(p_size::VARCHAR, 2, '0') || '2021', 3), substr(lpad(p_size::VARCHAR, 2, '0') || '2021', 1, 2), '01') AS month_date,
        concat(substr('20' || p_partkey || '2020', 3, 2), substr('20' || p_partkey || '2020', 7, 2)) AS year_code FROM part""",
)
def _text_clean(spark: SparkSession, folder: str) -> DataFrame:
    size, name = F.col("p_size"), F.col("p_name")
    month_year = join_text(F.lpad(size.cast("string"), 2, "0"), F.lit("2021"))
    label = join_text(F.lit("20"), F.col("p_partkey").cast("string"), F.lit("2020"))
    return Tables(spark, folder).part.select(
        "p_partkey",
        word_capitals(join_text("p_brand", F.lit("-"), name, F.lit("/"), "p_type")).alias("capitals"),
        full_name("p_type", F.when(size % 5 != 0, name)).alias("full_name"),
        join_text("p_brand", F.lit(None).cast("string"), size.cast("string")).alias("joined"),
        without(name, "red ", "hot ").alias("cleaned"),
        month_year_to_date(month_year).alias("month_date"),
        school_year_code(label).alias("year_code"),
    )


# ---------------------------------------------------------------- updates


@query(
    "keyed_update_dim",
    """WITH offered AS (SELECT c_nationkey + 1 AS k, 'New ' || c_mktsegment AS v, count(*) AS n FROM customer GROUP BY ALL),
    best AS (SELECT k, first(v ORDER BY n DESC, v) AS v FROM offered GROUP BY k)
    SELECT n_nationkey, coalesce(v, n_name) AS n_name, n_regionkey FROM nation LEFT JOIN best ON k = n_nationkey""",
)
def _keyed_update_dim(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    # Shifted by one, so that the first nation is offered nothing and the last key meets none.
    source = t.customer.select((F.col("c_nationkey") + 1).alias("k"), F.concat(F.lit("New "), "c_mktsegment").alias("new_name"))
    return keyed_update(t.nation, source, {"n_nationkey": "k"}, "n_name", "new_name").table


@query(
    "keyed_update_conflicts",
    """SELECT c_nationkey, count(*) AS choices, first(v ORDER BY n DESC, v) AS new_name
    FROM (SELECT c_nationkey, 'New ' || c_mktsegment AS v, count(*) AS n FROM customer GROUP BY ALL) GROUP BY 1 HAVING count(*) > 1""",
)
def _keyed_update_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    t = Tables(spark, folder)
    source = t.customer.select("c_nationkey", F.concat(F.lit("New "), "c_mktsegment").alias("new_name"))
    return keyed_update(t.nation, source, {"n_nationkey": "c_nationkey"}, "n_name", "new_name").conflicts


@query(
    "keyed_update_fact",
    """WITH offered AS (SELECT l_orderkey AS k, l_linenumber AS n, floor(l_quantity)::INTEGER::VARCHAR AS v, count(*) AS c FROM lineitem WHERE l_returnflag = 'R' GROUP BY ALL),
    best AS (SELECT k, n, first(v ORDER BY c DESC, v) AS v FROM offered GROUP BY k, n)
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(v::DOUBLE, l_tax) AS l_tax FROM lineitem LEFT JOIN best ON k = l_orderkey AND n = l_linenumber""",
)
def _keyed_update_fact(spark: SparkSession, folder: str) -> DataFrame:
    lines = Tables(spark, folder).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_quantity", "l_returnflag")
    source = lines.filter("l_returnflag = 'R'").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.floor("l_quantity").cast("string").alias("new_tax")
    )
    target = lines.drop("l_quantity", "l_returnflag")
    return keyed_update(target, source, {"l_orderkey": "k", "l_linenumber": "n"}, "l_tax", "new_tax", lambda c: c.cast("decimal(18,4)")).table


@query(
    "keyed_update_files",
    """WITH offered AS (SELECT l_orderkey AS k, l_linenumber AS n, floor(l_quantity)::INTEGER::VARCHAR AS v, count(*) AS c FROM lineitem
        WHERE l_returnflag = 'R' AND l_orderkey <= (SELECT max(l_orderkey) // 4 FROM lineitem) GROUP BY ALL),
    best AS (SELECT k, n, first(v ORDER BY c DESC, v) AS v FROM offered GROUP BY k, n)
    SELECT l_orderkey, l_linenumber, l_partkey, coalesce(v::DOUBLE, l_tax) AS l_tax FROM lineitem LEFT JOIN best ON k = l_orderkey AND n = l_linenumber""",
)
def _keyed_update_files(spark: SparkSession, folder: str) -> DataFrame:
    lines = Tables(spark, folder).lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_tax", "l_quantity", "l_returnflag")
    edge = lines.agg(F.max("l_orderkey")).first()[0] // 4
    source = lines.filter((F.col("l_returnflag") == "R") & (F.col("l_orderkey") <= edge)).select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), F.floor("l_quantity").cast("string").alias("new_tax")
    )
    old = create_version(lines.drop("l_quantity", "l_returnflag"), new_folder(spark, "lines"), by=["l_orderkey"])
    update = keyed_update_files(old, source, {"l_orderkey": "k", "l_linenumber": "n"}, "l_tax", "new_tax", lambda c: c.cast("decimal(18,4)"))
    return version(spark, update.version.root).read(spark)


# ---------------------------------------------------------------- weeks and tickets

STEP_WEEK = Week(dt.date(2024, 1, 29))


@query(
    "week_offset",
    """SELECT DISTINCT ts::DATE::VARCHAR AS date, ((date_trunc('week', ts)::DATE - DATE '2024-01-29') // 7)::INTEGER AS week_offset,
        ((date_trunc('week', ts::DATE + 1)::DATE - DATE '2024-01-29') // 7)::INTEGER AS sunday_offset FROM events""",
)
def _week_offset(spark: SparkSession, folder: str) -> DataFrame:
    days = calendar(Tables(spark, folder).events, "ts", STEP_WEEK)
    return days.withColumn("sunday_offset", Week(dt.date(2024, 1, 29), "sunday").offset(F.col("date")))


@query(
    "week_over_week_rules",
    """WITH given AS (SELECT event_id, value::DECIMAL(18,2)::DOUBLE AS p, CASE event_id % 5 WHEN 0 THEN value WHEN 1 THEN 0 WHEN 2 THEN NULL ELSE 20 END::DOUBLE AS q FROM events),
    worded AS (SELECT *, 'Your time to resolution last week ' || CASE WHEN p > q THEN 'declined' ELSE 'improved' END || ' <b><span style=''color:#333333''>' ||
        regexp_replace(printf('%.2f', round(abs(p - q) / nullif(q, 0) * 100, 2)), '\\.?0+$', '') || '%</span></b> compared to the prior week.' AS text FROM given)
    SELECT event_id, CASE WHEN coalesce(p, 0) = 0 OR coalesce(q, 0) = 0 THEN 'No comparison can be done due to one of the past two weeks having no data.'
            WHEN p = q THEN '[DATA UNABLE TO BE PULLED]' ELSE text END AS message,
        CASE WHEN coalesce(p, 0) = 0 AND coalesce(q, 0) = 0 THEN 'There have been no resolution times recorded in the past two weeks.'
            WHEN coalesce(p, 0) = 0 OR coalesce(q, 0) = 0 THEN 'No comparison can be done due to one of the past two weeks having no data.'
            WHEN p = q THEN '[DATA UNABLE TO BE PULLED]' ELSE text END AS strict_message FROM worded""",
)
def _week_over_week_rules(spark: SparkSession, folder: str) -> DataFrame:
    value, kind = F.col("value"), F.col("event_id") % 5
    p = value
    q = F.when(kind == 0, value).when(kind == 1, 0.0).when(kind > 2, 20.0)
    return Tables(spark, folder).events.select(
        "event_id",
        week_over_week_text(p, q).alias("message"),
        week_over_week_text(p, q, strict_blank=True).alias("strict_message"),
    )


@query(
    "humanise_duration",
    """WITH given AS (SELECT event_id, CASE event_id % 9 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE value::DECIMAL(18,2) * pow(10, event_id % 9 - 3)::DECIMAL(18,2) END::DOUBLE AS m,
        (event_id % 10)::BIGINT AS tickets FROM events),
    parts AS (SELECT *, m / 3600 AS h, trunc(h) AS hh, (h - hh) * 60 AS mi, trunc(mi) AS mm, round((mi - mm) * 60)::BIGINT AS ss, trunc(hh / 24) AS dd,
        round((hh / 24 - dd) * 24)::BIGINT AS hd, round(m::DECIMAL(30,9))::BIGINT AS t FROM given)
    SELECT event_id, CASE WHEN tickets = 0 THEN 'N/A' WHEN coalesce(m, 0) = 0 THEN 'Immediate'
        ELSE CASE WHEN hh >= 24 THEN dd::BIGINT || 'd ' || hd || 'h ' WHEN hh >= 1 THEN hh::BIGINT || 'h ' ELSE '' END
            || CASE WHEN hh >= 1 OR mm >= 1 THEN mm::BIGINT || 'm ' ELSE '' END || ss || 's' END AS shown,
        CASE WHEN tickets = 0 THEN 'N/A' WHEN coalesce(m, 0) = 0 THEN 'Immediate'
        ELSE CASE WHEN t >= 86400 THEN (t // 86400) || 'd ' || (t // 3600 % 24) || 'h ' WHEN t >= 3600 THEN (t // 3600) || 'h ' ELSE '' END
            || CASE WHEN t >= 60 THEN (t // 60 % 60) || 'm ' ELSE '' END || (t % 60) || 's' END AS exact FROM parts""",
)
def _humanise_duration(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_id") % 9
    scale = F.pow(F.lit(10), kind - 3).cast(MONEY)
    seconds = F.when(kind == 1, 0.0).when(kind > 1, (F.col("value").cast(MONEY) * scale).cast("double"))
    given = Tables(spark, folder).events.select("event_id", seconds.alias("seconds"), (F.col("event_id") % 10).alias("tickets"))
    shown = with_duration_text(given, "seconds", "tickets", "shown")
    return with_duration_text(shown, "seconds", "tickets", "exact", exact=True).select("event_id", "shown", "exact")


@query(
    "channel_counts",
    """WITH given AS (SELECT user_id::VARCHAR AS a, (user_id % 3)::VARCHAR AS b, event_type AS k, event_id % 4 AS c, value,
            ts::DATE BETWEEN DATE '2024-01-22' AND DATE '2024-01-28' AS w FROM events),
    counted AS (SELECT a, b, sum((w AND k = 'click')::INTEGER)::BIGINT AS "App", sum((w AND k = 'error')::INTEGER)::BIGINT AS "Text Message",
        sum((w AND k = 'view')::INTEGER)::BIGINT AS "Email", sum((w AND k = 'signup' AND c < 3)::INTEGER)::BIGINT AS "Incoming Calls",
        sum((w AND k = 'signup' AND c = 3)::INTEGER)::BIGINT AS "Outgoing Calls" FROM given GROUP BY ALL)
    SELECT *, "App" + "Text Message" + "Email" + "Incoming Calls" + "Outgoing Calls" AS "All", b || b AS "Connector" FROM counted""",
)
def _channel_counts(spark: SparkSession, folder: str) -> DataFrame:
    names = {"click": "Online", "error": "Text", "view": "Electronic Mail", "signup": "Voice"}
    kind = F.col("event_type")
    channel = first_rule([(kind == k, F.lit(v)) for k, v in names.items()], F.lit("Fax"))
    calls = F.element_at(F.array(*[F.lit(c) for c in ("Answered", "Missed", "Voicemail Response", "Outbound")]), (F.col("event_id") % 4 + 1).cast("int"))
    fact = Tables(spark, folder).events.select(
        F.col("user_id").cast("string").alias("a"),
        (F.col("user_id") % 3).cast("string").alias("b"),
        "ts",
        "value",
        channel.alias("channel"),
        calls.alias("call"),
    )
    return channel_counts(fact, "a", "b", "ts", STEP_WEEK, "value", "value", "channel", "call")


@query(
    "conditional_counts",
    """SELECT event_type, count(*) FILTER (WHERE value > 20) AS large, coalesce(count(*) FILTER (WHERE value < 0), 0) AS negative FROM events GROUP BY 1""",
)
def _conditional_counts(spark: SparkSession, folder: str) -> DataFrame:
    value = F.col("value")
    return Tables(spark, folder).events.groupBy("event_type").agg(count_where(value, value > 20).alias("large"), count_where(value, value < 0).alias("negative"))


# ---------------------------------------------------------------- parameters and checks


@query(
    "param_report",
    """SELECT 'one nation, two segments' AS report, c_custkey, c_mktsegment FROM customer WHERE c_nationkey = 7 AND c_mktsegment IN ('BUILDING', 'MACHINERY')
    UNION ALL SELECT 'every nation, all', c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')""",
)
def _param_report(spark: SparkSession, folder: str) -> DataFrame:
    customers = Tables(spark, folder).customer
    offered = ("BUILDING", "MACHINERY", "HOUSEHOLD")

    def report(name: str, nation: int | None, choice: str | tuple[str, ...]) -> DataFrame:
        kept = customers.filter(optional_equals(F.col("c_nationkey"), nation) & value_or_all(F.col("c_mktsegment"), choice, offered))
        return kept.select(F.lit(name).alias("report"), "c_custkey", "c_mktsegment")

    return report("one nation, two segments", 7, offered[:2]).unionByName(report("every nation, all", None, "ALL"))


@query(
    "upload_as_text",
    """SELECT lpad(c_custkey::VARCHAR, 6, '0') AS student_id, nullif(c_mktsegment, 'BUILDING') AS _1, c_nationkey::VARCHAR AS _2 FROM customer""",
)
def _upload_as_text(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "upload")
    segment, nation = F.col("c_mktsegment"), F.col("c_nationkey")
    sheet = Tables(spark, folder).customer.select(
        F.lpad(F.col("c_custkey").cast("string"), 6, "0").alias("student_id"), F.when(segment != "BUILDING", segment).alias("_1"), nation.alias("_2")
    )
    sheet.write.option("header", True).csv(path)
    return read_upload(spark, path, ["student_id", "_1", "_2"])


_LINES = """WITH lines AS (
    SELECT c_custkey::VARCHAR || CASE WHEN c_custkey % 7 = 0 THEN '' ELSE ',"' || c_mktsegment || ', ' || c_nationkey || '"' END
        || CASE WHEN c_custkey % 13 = 0 THEN ',absent' ELSE ',' || c_nationkey END || CASE WHEN c_custkey % 11 = 0 THEN ',more' ELSE '' END AS line,
        c_custkey, c_mktsegment, c_nationkey, (c_custkey % 7 = 0) <> (c_custkey % 11 = 0) AS malformed, c_custkey % 77 = 0 AS shifted, c_custkey % 13 = 0 AS absent FROM customer)
"""


def _uploaded_customers(spark: SparkSession, folder: str) -> Upload:
    """Customers as lines of an upload: some lack a field, some have one more; both faults together make up a row of the right length."""
    key, nation = F.col("c_custkey").cast("string"), F.col("c_nationkey").cast("string")
    named = F.concat(F.lit(',"'), "c_mktsegment", F.lit(", "), nation, F.lit('"'))
    line = F.concat(
        key, F.when(F.col("c_custkey") % 7 == 0, "").otherwise(named), F.when(F.col("c_custkey") % 13 == 0, ",absent").otherwise(F.concat(F.lit(","), nation)),
        F.when(F.col("c_custkey") % 11 == 0, ",more").otherwise(""),
    )
    path = new_folder(spark, "upload")
    lines = Tables(spark, folder).customer.select(line.alias("line"))
    header = F.lit("student_id,_1,_2").alias("line")
    # A header for each file: lines are written by the task that has them, and each file begins with it.
    sized = lines.withColumn("part", F.spark_partition_id())
    heads = sized.select("part").distinct().select(header, "part", F.lit(0).alias("place"))
    every = sized.select("line", "part", F.lit(1).alias("place")).unionByName(heads)
    every.repartition("part").sortWithinPartitions("part", "place").select("line", "part").write.partitionBy("part").text(path)
    return read_upload_rows(spark, f"{path}/part=*", ["student_id", "_1", "_2"])


@query(
    "upload_well_formed",
    _LINES
    + """SELECT c_custkey::VARCHAR AS student_id, CASE WHEN shifted THEN CASE WHEN absent THEN 'absent' ELSE c_nationkey::VARCHAR END ELSE c_mktsegment || ', ' || c_nationkey END AS _1,
        CASE WHEN shifted THEN 'more' WHEN absent THEN 'absent' ELSE c_nationkey::VARCHAR END AS _2 FROM lines WHERE NOT malformed""",
)
def _upload_well_formed(spark: SparkSession, folder: str) -> DataFrame:
    return _uploaded_customers(spark, folder).rows


@query(
    "upload_row_rejects",
    _LINES
    + """SELECT 'customers' AS upload, NULL::VARCHAR AS "column", line AS value, count(*) AS rows FROM lines WHERE malformed GROUP BY ALL
    UNION ALL SELECT 'customers', '_2', CASE WHEN shifted THEN 'more' ELSE 'absent' END AS value, count(*) FROM lines WHERE NOT malformed AND (shifted OR absent) GROUP BY ALL""",
)
def _upload_row_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return upload_rejects({"customers": (_uploaded_customers(spark, folder), ["student_id"], ["_2"])})


@query("repeated_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _repeated_keys(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_keys(Tables(spark, folder).lineitem, "l_orderkey", "l_linenumber")
