import pytest
from helpers import bag, rows
from pyspark.sql import functions as F

from recordkit.sources.params import optional_equals, value_or_all
from recordkit.operators.uploads import upload_rejects
from recordkit.sources.tables import new_folder, publish, read_table, read_upload, read_upload_rows, repeated_keys, replace_table, shared_folder, stage, write_version


def test_uploads_are_text(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text("student_id,_1\n0043,1\n44,\n")
    frame = read_upload(spark, str(path), ["student_id", "_1"])
    assert frame.dtypes == [("student_id", "string"), ("_1", "string")]
    assert rows(frame) == [("0043", "1"), ("44", None)]


def test_an_upload_with_other_columns_is_refused(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text("other,_1\n0043,1\n")
    with pytest.raises(Exception, match="header|schema"):
        read_upload(spark, str(path), ["student_id", "_1"]).collect()


class Unset:
    """A session in which ``spark.checkpoint.dir`` is not set."""

    def __init__(self, master):
        self.sparkContext = type("Context", (), {"master": master, "getCheckpointDir": lambda self: None})()
        self.conf = type("Conf", (), {"get": staticmethod(lambda key, default: default)})()


def test_only_a_local_session_gets_its_own_folder():
    assert shared_folder(Unset("local[4]")) == shared_folder(Unset("local[4]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Unset("spark://host:7077"))


def test_stage_writes_below_the_shared_folder(spark):
    frame = spark.createDataFrame([(1, "a"), (2, None)], "k int, v string")
    out = stage(frame, "test-stage")
    assert bag(out) == bag(frame)
    assert shared_folder(spark).split(":")[-1] in out.inputFiles()[0]
    assert out.schema.simpleString() == frame.schema.simpleString()


def test_versions_keep_the_old_table(spark):
    folder = new_folder(spark, "test-version")
    old = stage(spark.range(5), "old", folder)
    new = write_version(old.withColumn("id", F.col("id") + 1), old, folder, "new")
    assert sorted(rows(new)) == [(i,) for i in range(1, 6)] and sorted(rows(old)) == [(i,) for i in range(5)]
    with pytest.raises(ValueError, match="5 rows became 4"):
        write_version(old.filter("id > 0"), old, folder, "lost")
    assert read_table(spark, f"{folder}/new").count() == 5


def test_replace_table(spark):
    for n in (3, 2):
        assert replace_table(spark.range(n), "recordkit_replaced").count() == n
    assert read_table(spark, "recordkit_replaced").count() == 2
    spark.sql("DROP TABLE recordkit_replaced")


def test_replace_table_from_itself_and_after_a_failure(spark):
    name = "recordkit_itself"
    replace_table(spark.range(4).withColumn("part", F.col("id") % 2), name, ["part"])
    replace_table(spark.table(name).filter("id > 1"), name)
    assert sorted(rows(spark.table(name))) == [(2, 0), (3, 1)]
    assert [c.name for c in spark.catalog.listColumns(name) if c.isPartition] == ["part"]
    with pytest.raises(Exception, match="no such value"):
        replace_table(spark.table(name).withColumn("id", F.raise_error(F.lit("no such value")).cast("long")), name)
    assert spark.table(name).count() == 2
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(f"{name}_")] == []
    spark.sql(f"DROP TABLE {name}")


def test_publish(spark):
    first, second = "recordkit_first", "recordkit_second"
    for name in (first, second):
        replace_table(spark.range(3), name)
    with pytest.raises(ValueError, match="recordkit_second: 3 rows became 2"):
        publish({first: spark.range(3, 6), second: spark.range(2)})
    assert sorted(rows(spark.table(first))) == [(0,), (1,), (2,)]
    publish({first: spark.table(first).withColumn("id", F.col("id") * 2)})
    assert sorted(rows(spark.table(first))) == [(0,), (2,), (4,)]
    for name in (first, second):
        spark.sql(f"DROP TABLE {name}")


def test_repeated_keys(spark):
    frame = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    assert rows(repeated_keys(frame, "k")) == [(1, 2)]


def test_parameters(spark):
    frame = spark.createDataFrame([("09", 1), ("10", 2), ("KG", 2)], "grade string, school int")

    def kept(condition):
        return sorted(r["grade"] for r in frame.filter(condition).collect())

    grade, offered = F.col("grade"), ("09", "10", "11", "12")
    assert kept(value_or_all(grade, "ALL", offered)) == ["09", "10"]
    assert kept(value_or_all(grade, "KG", offered)) == ["KG"]
    assert kept(value_or_all(grade, ("10", "KG"), offered)) == ["10", "KG"]
    assert kept(optional_equals(F.col("school"), 2)) == ["10", "KG"]
    assert kept(optional_equals(F.col("school"), None)) == ["09", "10", "KG"]


def test_rows_of_other_lengths_are_set_apart(spark, tmp_path):
    lines = ["student_id,_1,_2", "1,a,b", "2,a", "3", "4,a,b,c", '5,"x, y",z', "", "6,,", '7,"open,b', "2,a", "8,a,b,c,d,e"]
    path = tmp_path / "upload.csv"
    path.write_text("\n".join(lines) + "\n")
    upload = read_upload_rows(spark, str(path), ["student_id", "_1", "_2"])
    assert sorted(upload.rows.collect()) == [("1", "a", "b"), ("5", "x, y", "z"), ("6", None, None)]
    assert sorted(r[0] for r in upload.malformed.collect()) == ["2,a", "2,a", "3", "4,a,b,c", '7,"open,b', "8,a,b,c,d,e"]
    got = {tuple(r) for r in upload_rejects({"u": (upload, ["student_id"], ["_2"])}).collect()}
    assert ("u", None, "2,a", 2) in got and ("u", "_2", "b", 1) in got and ("u", "_2", "z", 1) in got
    assert upload.rows.select("student_id").count() == 3  # also when columns are pruned


def test_an_upload_of_no_rows(spark, tmp_path):
    path = tmp_path / "upload.csv"
    path.write_text("student_id,_1\n")
    upload = read_upload_rows(spark, str(path), ["student_id", "_1"])
    assert upload.rows.count() == upload.malformed.count() == 0
