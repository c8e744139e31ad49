"""Wide answer sheets to one row per question."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from recordkit.operators.joins import is_small

OVERALL = "Overall Score"


def unpivot_scores(
    wide: DataFrame, ids: list[str], overall: str, questions: list[str], key: DataFrame, key_columns: list[str], order: list[str] | None = None
) -> DataFrame:
    """One row per question and matching key row.

    The overall column becomes question ``Overall Score`` with its value in ``score`` and is kept
    without a key row; the n-th question column becomes ``01``, ``02``, ... with its value in
    ``answer`` and needs a key row (``key.question``, a number with or without zeros before it). Numbers are as wide
    as the last question's, two digits at least; a key row for a question that the sheet lacks matches nothing. One pass
    over the sheet replaces one join per question, and NULL answers stay. The key is broadcast if it is small:
    a join by question would send all rows to as many tasks as there are questions.

    With ``order`` (some of ``ids``) the rows are in that order. The sheet is sorted before it is unpivoted, and neither that nor a
    broadcast key changes the order, so one row per sheet row goes through the sort's shuffle; with a large key the long rows are
    sorted, by question last.
    """
    width = max(2, len(str(len(questions))))
    number = F.regexp_replace(F.col("question").cast("string"), "^0+(?=.)", "")
    padded = F.when(F.length(number) <= width, F.lpad(number, width, "0"))
    numbered = {overall: "0" * width, **{c: f"{i:0{width}d}" for i, c in enumerate(questions, 1)}}
    sheet = wide.select(*ids, *[F.col(c).cast("string").alias(n) for c, n in numbered.items()])
    answers = key.select(padded.alias("_key_question"), *key_columns)
    small = is_small(answers)
    if order and small:
        sheet = sheet.orderBy(*order)
    rows = sheet.unpivot(ids, list(numbered.values()), "_question", "_value")
    answers = F.broadcast(answers) if small else answers
    is_overall = F.col("_question") == "0" * width
    joined = rows.join(answers, F.col("_question") == F.col("_key_question"), "left").filter(
        is_overall | F.col("_key_question").isNotNull()
    )
    tall = joined.select(
        *ids,
        F.when(is_overall, OVERALL).otherwise(F.col("_question")).alias("question"),
        F.when(is_overall, F.col("_value")).alias("score"),
        F.when(~is_overall, F.col("_value")).alias("answer"),
        *key_columns,
    )
    return tall.orderBy(*order, "question") if order and not small else tall
