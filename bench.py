"""Time the registered queries; with ``BENCH_FORMS=1`` also two rewritten forms against literal ones.

Prints one JSON line. ``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local threads.
"""

from __future__ import annotations

import json
import os
import re
import time
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from recordkit.plans.answer_sheet import KEY_COLUMNS, SheetRun, answer_rows, assessed_students
from recordkit.plans.reconciliation import LOG_PATTERNS, ReconciliationRun, change_dates
from recordkit.queries import steps, reports  # noqa: F401, I001  (register their queries, short ones first)
from recordkit.queries.registry import QUERIES
from recordkit.queries.sis import model
from recordkit.session import local_session
from recordkit.sources.tables import stage

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
FORMS = os.environ.get("BENCH_FORMS", "0") == "1"

def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def literal_unpivot(sis, sheet: SheetRun) -> DataFrame:
    """One join per question and a union of all of them."""
    general = assessed_students(sis, sheet)
    key = sis["pm_civics_standards_temp"].withColumn("number", F.lpad("question", 2, "0"))
    upload = sis["pm_civics_flip_temp"].withColumn("student_id", F.col("student_id").cast("bigint"))
    branches = []
    for i, column in enumerate([sheet.overall, *sheet.questions]):
        number = f"{i:02d}"
        answers = key.filter(F.col("number") == number).select(*KEY_COLUMNS)
        rows = general.join(upload.select("student_id", F.col(column).alias("value")), "student_id")
        branches.append(rows.join(answers, F.lit(True), "left" if i == 0 else "inner").withColumn("question", F.lit(number)))
    return reduce(DataFrame.unionByName, branches).orderBy("student_id")


def literal_change_dates(sis, since) -> list[DataFrame]:
    """One scan and one window per audited item."""
    people = sis["students"].select("student_id", F.col("custom_200000224").alias("fleid"))
    in_file = sis["student_data_updates_temp"].select("fleid")
    editors = sis["users"].select(F.col("staff_id").alias("user_id"))
    newest = Window.partitionBy("student_id").orderBy(F.desc("log_time"))
    out = []
    for pattern in LOG_PATTERNS.values():
        rows = sis["database_object_log"].filter((F.col("action") == "UPDATE") & F.col("after").like(pattern) & (F.col("log_time") >= F.lit(since)))
        rows = rows.join(editors, "user_id").join(people, "student_id").join(in_file, "fleid")
        out.append(rows.withColumn("rn", F.row_number().over(newest)).filter("rn = 1").select("fleid", F.col("log_time").cast("date")))
    return out


def compare_forms(spark) -> dict[str, dict[str, float]]:
    sis = {n: stage(t, n) for n, t in model(spark, FOLDER).items() if n != "tickets"}
    sheet, checked = SheetRun(), ReconciliationRun()
    forms = {
        "unpivot": (lambda: run(literal_unpivot(sis, sheet)), lambda: run(answer_rows(sis, sheet))),
        "audit_log": (
            lambda: [run(d) for d in literal_change_dates(sis, checked.survey_end)],
            lambda: run(change_dates(sis, checked)),
        ),
    }
    out = {}
    for name, (literal, rewritten) in forms.items():
        a, b = seconds(literal), seconds(rewritten)
        out[name] = {"literal_sec": a, "rewritten_sec": b, "ratio": round(a / b, 2)}
    return out


def main() -> None:
    spark = local_session(CPUS, "bench")
    run(QUERIES["active_or_latest"](spark, FOLDER))  # start the executors before timing
    times = {name: seconds(lambda: run(query(spark, FOLDER))) for name, query in QUERIES.items()}
    scale = re.search(r"sf([0-9.]+)", FOLDER)
    result = {
        "metric": "registered queries, total time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(scale.group(1)) if scale else FOLDER,
    }
    if FORMS:
        result["literal_versus_rewritten"] = compare_forms(spark)
    print(json.dumps(result))


if __name__ == "__main__":
    main()
