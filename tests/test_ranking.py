import random
from decimal import Decimal

import pytest
from helpers import by_key
from pyspark.sql import functions as F

from recordkit.operators import ranking
from recordkit.operators.ranking import rank_in_group
from recordkit.sources.tables import stage

SCHEMA = "id int, school string, level string, a decimal(18,4), b decimal(18,4)"


def brute(values, column):
    def ahead(x, y):
        return x is not None and (y is None or y > x)

    return {r[0]: 1 + sum(ahead(r[column], o[column]) for o in values if o[1:3] == r[1:3]) for r in values}


@pytest.mark.parametrize("n", [1, 8])
@pytest.mark.parametrize("width", [0.1, 3])
def test_ranks_match_brute_force(spark, partitions, n, width):
    partitions(n)
    pick = random.Random(5)
    values = []
    for i in range(300):
        school = "S0" if pick.random() < 0.34 else pick.choice(["S1", "S2", None])
        a = None if pick.random() < 0.05 else Decimal(4) if pick.random() < 0.3 else Decimal(pick.randint(0, 70000)) / 10000
        b = Decimal(pick.randint(-20, 99))
        values.append((i, school, pick.choice(["09", "10"]), a, b))
    values.append((999, "alone", "09", None, Decimal(1)))
    frame = spark.createDataFrame(values, SCHEMA).repartition(5)
    out = by_key(rank_in_group(frame, ["school", "level"], {"a": "ra", "b": "rb"}, size="n", bucket_width=width), "id")
    assert {k: v["ra"] for k, v in out.items()} == brute(values, 3)
    assert {k: v["rb"] for k, v in out.items()} == brute(values, 4)
    assert all(v["n"] == sum(r[1:3] == (v["school"], v["level"]) for r in values) for v in out.values())
    assert out[999]["ra"] == out[999]["n"] == 1


def test_ranks_need_decimals(spark):
    with pytest.raises(TypeError):
        rank_in_group(spark.createDataFrame([(1, 2.0)], "g int, x double"), ["g"], {"x": "r"})


@pytest.mark.parametrize("kinds", [1, 4])
def test_all_ranks_come_from_one_count(spark, monkeypatch, kinds):
    written = []
    monkeypatch.setattr(ranking, "stage", lambda df, label: written.append((label, df)) or stage(df, label))
    frame = spark.createDataFrame([(i, "S", Decimal(i % 5)) for i in range(50)], "id int, school string, a decimal(18,4)")
    frame = frame.select("*", *[F.col("a").alias(f"a{k}") for k in range(kinds)])
    out = rank_in_group(frame, ["school"], {f"a{k}": f"r{k}" for k in range(kinds)}, size="n")
    assert out.select("id", "r0").distinct().count() == 50 and out.columns == [*frame.columns, *[f"r{k}" for k in range(kinds)], "n"]
    assert [label for label, _ in written] == ["rows-to-rank", "value-counts"]
    counting = written[1][1]._jdf.queryExecution().executedPlan().toString()
    assert counting.count("Exchange hashpartitioning") == 1 and counting.count("FileScan") == 1
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == 3 and plan.count("Join ") == 3  # however many ranks


def test_ranks_of_no_rows(spark):
    frame = spark.createDataFrame([], SCHEMA)
    assert rank_in_group(frame, ["school", "level"], {"a": "ra"}).count() == 0
