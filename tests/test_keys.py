import random

import pytest
from helpers import bag, day, rows

from recordkit.operators.keys import active_or_latest, first_row_flags, first_rows_of_join, latest_per_key

SCHEMA = "k int, id int, start date, end date"


def sample(spark, seed, n=400, keys=20, hot=False):
    pick = random.Random(seed)
    values = []
    for i in range(n):
        k = 0 if hot and pick.random() < 0.34 else pick.randrange(keys)
        end = None if pick.random() < 0.2 else day(f"2022-0{pick.randint(1, 3)}-1{pick.randint(0, 3)}")
        values.append((k, i, day(f"2021-08-1{pick.randint(0, 9)}"), end))
    return values


def order(row):
    return (row[3] is not None, -row[3].toordinal() if row[3] else 0, row[1])


def newest(values):
    best = {}
    for row in values:
        if row[0] not in best or order(row) < order(best[row[0]]):
            best[row[0]] = row
    return best


@pytest.mark.parametrize("n", [1, 8])
@pytest.mark.parametrize("hot", [False, True])
def test_latest_per_key(spark, partitions, n, hot):
    partitions(n)
    values = sample(spark, 1, hot=hot)
    out = latest_per_key(spark.createDataFrame(values, SCHEMA).repartition(5), ["k"], "end", ["id"])
    assert sorted(rows(out)) == sorted(newest(values).values())


@pytest.mark.parametrize("n", [1, 8])
def test_active_or_latest(spark, partitions, n):
    partitions(n)
    values = sample(spark, 2, hot=True)
    values += [v for v in values if v[3] is None][:3]  # equal open rows count once
    best = newest(values)
    expected = {(*r, "N" if r[3] is None else "Y") for r in values if r[3] is None or best[r[0]] == r}
    out = rows(active_or_latest(spark.createDataFrame(values, SCHEMA).repartition(5), ["k"], "end", ["id"]))
    assert len(out) == len(expected) and set(out) == expected


def test_a_closed_newest_row_is_left_out_when_another_is_open(spark):
    values = [(1, 1, day("2021-08-10"), day("2022-06-01")), (1, 2, day("2021-08-11"), None), (2, 3, day("2021-08-10"), day("2022-01-01"))]
    out = rows(active_or_latest(spark.createDataFrame(values, SCHEMA), ["k"], "end", ["id"]))
    assert sorted((r[1], r[4]) for r in out) == [(2, "N"), (3, "Y")]


@pytest.mark.parametrize("n", [1, 8])
def test_first_row_flags_mark_one_copy(spark, partitions, n):
    partitions(n)
    values = [v[:1] + (v[1] % 7,) + v[2:] for v in sample(spark, 3, hot=True)]  # many equal rows
    out = first_row_flags(spark.createDataFrame(values, SCHEMA).repartition(5), ["k"], {"by_end": "end", "by_start": "start"})
    assert bag(out.select("k", "id", "start", "end")) == bag(spark.createDataFrame(values, SCHEMA))

    def first(place):
        return {k: min((r for r in values if r[0] == k), key=place) for k in {r[0] for r in values}}

    def by_end(r):
        return (r[3] is not None, -r[3].toordinal() if r[3] else 0, r[1], r[2])

    def by_start(r):
        return (-r[2].toordinal(), r[1], r[3] is not None, r[3] or day("0001-01-01"))

    marked = out.collect()
    assert {r["k"]: (r["k"], r["id"], r["start"], r["end"]) for r in marked if r["by_end"]} == first(by_end)
    assert {r["k"]: (r["k"], r["id"], r["start"], r["end"]) for r in marked if r["by_start"]} == first(by_start)
    assert sum(r["by_end"] for r in marked) == sum(r["by_start"] for r in marked) == len({r[0] for r in values})


def test_the_newest_row_is_chosen_before_and_after_the_shuffle(spark):
    frame = spark.createDataFrame(sample(spark, 4), SCHEMA)
    for out in (latest_per_key(frame, ["k"], "end", ["id"]), active_or_latest(frame, ["k"], "end", ["id"])):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("seed", range(4))
def test_first_rows_of_a_join_without_the_join(spark, partitions, seed):
    partitions(5)
    pick = random.Random(seed)

    def date():
        return None if pick.random() < 0.2 else day(f"2022-01-0{pick.randint(1, 4)}")

    left = [(pick.randrange(12), pick.choice([None, 1, 2, 3]), pick.choice([None, "a", "b"]), date()) for _ in range(150)]
    right = [(pick.randrange(12), pick.choice([None, 1, 2, 3]), pick.choice("xy"), date(), date()) for _ in range(150)]
    a = spark.createDataFrame(left, "k int, s int, c string, l_end date").repartition(3)
    b = spark.createDataFrame(right, "k int, s int, d string, r_start date, r_end date").repartition(3)
    columns, orders = ["d", "c", "r_start", "r_end", "l_end"], {"f1": "l_end", "f2": "r_start", "f3": "r_end"}
    out = first_rows_of_join(a, b, ["k", "s"], ["k"], orders, columns)
    product = [(x[0], x[1], y[2], x[2], y[3], y[4], x[3]) for x in left for y in right if x[:2] == y[:2] and x[1] is not None]
    want = {}
    for flag, at in (("f1", 6), ("f2", 4), ("f3", 5)):
        for k in {r[0] for r in product}:
            def place(r, at=at):
                newest = (r[at] is not None, -r[at].toordinal() if r[at] else 0)
                rest = [(r[i] is not None, r[i]) if r[i] is not None else (False,) for i in (2, 3, 4, 5, 6, 1) if i != at]
                return (newest, rest)

            want.setdefault(min((r for r in product if r[0] == k), key=place), set()).add(flag)
    got = {(r["k"], r["s"], *[r[c] for c in columns]): {f for f in orders if r[f]} for r in out.collect()}
    assert got == want
    assert rows(first_rows_of_join(a.limit(0), b, ["k", "s"], ["k"], orders, columns)) == []
