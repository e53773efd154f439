import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerkit.sources import split_scan
from ledgerkit.sources.delimited import read_delimited
from ledgerkit.sources.tables import overwrite_table
from ledgerkit.spec import Dialect

SPLIT = Dialect(split=True)


@pytest.fixture
def tiny_splits(spark):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "64")
    yield
    spark.conf.set(key, before)


def rows(df):
    return sorted(tuple(repr(v) for v in r) for r in df.collect())


def field(value):
    return '"' + value.replace('"', '""') + '"' if any(c in value for c in ';"\n\r') else value


def as_csv(records, newline="\n"):
    return newline.join(["A;B;C", *(";".join(field(v) for v in r) for r in records)]) + newline


def test_equals_the_single_task_reader(spark, tiny_splits, write_file):
    rng = random.Random(7)
    pieces = ["x", "long word", "\n", ";", '"', "é", "", "\n\n", '""', "a;b\nc"]
    records = [["".join(rng.choices(pieces, k=rng.randint(0, 9))) for _ in range(3)] for _ in range(400)]
    path = write_file(as_csv(records))
    assert rows(read_delimited(spark, path, SPLIT)) == rows(read_delimited(spark, path))


def test_one_record_over_many_splits(spark, tiny_splits, write_file):
    giant = "\n".join(f"line {i}" for i in range(200))
    path = write_file(as_csv([["1", giant, "x"], ["2", "y", giant], ["3", "", "z"]]))
    got = rows(read_delimited(spark, path, SPLIT))
    assert len(got) == 3 and got == rows(read_delimited(spark, path))


def test_several_files_with_crlf_and_rejects(spark, tiny_splits, write_file):
    first = write_file('\ufeffA;B;C\r\n1;"a\r\nb";c\r\n\r\n2;3\r\n', "1.csv")
    second = write_file('A;B;C\r\n4;5;6;7\r\n8;"";"x;\r\n"\r\n', "2.csv")
    native = read_delimited(spark, [first, second])
    assert rows(read_delimited(spark, [first, second], SPLIT)) == rows(native)
    flagged = read_delimited(spark, [first, second], SPLIT, reject_column="bad").collect()
    assert {r.A: r.bad is not None for r in flagged} == {"1": False, "2": True, "4": True, "8": False}


def test_large_split_tables_are_joined_by_a_shuffle(spark, tiny_splits, write_file):
    records = [[str(i), "a\nb" * (i % 5), 'q"'] for i in range(100)]
    path = write_file(as_csv(records))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(split_scan.read_split(spark, path, SPLIT, ["A", "B", "C"]))
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        by_shuffle = split_scan.read_split(spark, path, SPLIT, ["A", "B", "C"])
        assert "BroadcastHashJoin" not in plan(by_shuffle)
        assert rows(by_shuffle) == rows(read_delimited(spark, path))
    finally:
        spark.conf.set(setting, before)


@pytest.mark.parametrize("order", [(0, 1), (1, 0)])
def test_each_file_has_its_own_line_ending(spark, tiny_splits, write_file, order):
    paths = [write_file('A;B\n1;"p\r\nq"\n2;x\n', "1.csv"), write_file('A;B\r\n3;"z"\r\n4;"p\r\nq"\r\n', "2.csv")]
    paths = [paths[i] for i in order]
    assert rows(read_delimited(spark, paths, SPLIT)) == rows(read_delimited(spark, paths))


def test_lines_of_white_space_are_no_records(spark, tiny_splits, write_file):
    path = write_file("\t\n \nA;B\n1;x\n\t\n  \t\n2;y\n\n \n")
    assert rows(read_delimited(spark, path, SPLIT)) == rows(read_delimited(spark, path)) != []


def test_stray_quotes_fail_before_any_grouping(spark, tiny_splits, write_file):
    body = [f"{i};text" for i in range(2000)]
    one = write_file("\n".join(["A;B", '1;5" pipe', *body]) + "\n", "one.csv")
    with pytest.raises(ValueError, match='one.csv.*5" pipe'):
        read_delimited(spark, one, SPLIT)
    two = write_file("\n".join(["A;B", '1;5" pipe', *body, '2;6" pipe']) + "\n", "two.csv")
    with pytest.raises(Exception, match='two.csv: 1;5" pipe'):
        read_delimited(spark, two, SPLIT).collect()


def test_the_callers_settings_reach_the_scan(spark, tiny_splits, write_file):
    setting = "spark.sql.files.ignoreMissingFiles"
    spark.conf.set(setting, "true")
    try:
        assert split_scan._pinned_session(spark, None).conf.get(setting) == "true"
    finally:
        spark.conf.unset(setting)


@pytest.mark.parametrize(
    "body", ['1;5" pipe;x\n2;6" pipe;"y"\n', '1;"open;x\n2;y;z\n', '1;"a"b;x\n2;"c\nd"e";f\n']
)
def test_irregular_quoting_fails_loudly(spark, write_file, body):
    path = write_file("A;B;C\n" + body)
    with pytest.raises(Exception, match="split=False"):
        read_delimited(spark, path, SPLIT).collect()


def test_stray_quotes_inside_one_line_are_fine(spark, write_file):
    path = write_file('A;B;C\n1;5" by 6";x\n2;"a\nb";y\n')
    assert rows(read_delimited(spark, path, SPLIT)) == rows(read_delimited(spark, path))


def test_unsupported_dialects_are_refused(spark, write_file):
    path = write_file("A;B\n1;2\n")
    with pytest.raises(ValueError, match="UTF-8"):
        read_delimited(spark, path, Dialect(split=True, encoding="UTF-16"), columns=["A", "B"])
    with pytest.raises(ValueError, match="one line"):
        read_delimited(spark, write_file('"A\nA";B\n1;2\n'), SPLIT)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(
        st.lists(st.text(alphabet='ab;"\n é\t', max_size=30), min_size=3, max_size=3), min_size=1, max_size=40
    )
)
def test_any_regular_file(spark, tiny_splits, write_file, records):
    path = write_file(as_csv(records))
    assert rows(read_delimited(spark, path, SPLIT)) == rows(read_delimited(spark, path))


def test_files_must_carry_the_same_header(spark, write_file):
    first, second = write_file("A;B\n1;2\n", "1.csv"), write_file("B;A\n3;4\n", "2.csv")
    with pytest.raises(Exception, match="another header"):
        read_delimited(spark, [first, second], SPLIT).collect()


def test_result_belongs_to_the_callers_session(spark, write_file):
    df = read_delimited(spark, write_file("A;B\n1;2\n"), SPLIT)
    assert df._jdf.sparkSession().equals(spark._jsparkSession)


def test_later_settings_do_not_move_the_splits(spark, tiny_splits, write_file):
    path = write_file(as_csv([[str(i), "a\nb", "c"] for i in range(200)]))
    df = read_delimited(spark, path, SPLIT)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    assert rows(df) == rows(read_delimited(spark, path))


def test_overwritten_table_is_read_afresh(spark, tmp_path, write_file):
    name, path = "lk_test_split_table", str(tmp_path / "table")
    for body in ("1;2", "3;4"):
        df = read_delimited(spark, write_file(f"A;B\n{body}\n"), SPLIT)
        assert [";".join(r) for r in overwrite_table(df, name, path=path).collect()] == [body]
        assert [";".join(r) for r in spark.table(name).collect()] == [body]
    spark.sql(f"drop table {name}")


def test_small_splits_share_tasks(spark, write_file):
    """What the tasks report to the driver follows the bytes, however small the splits."""
    records = [[str(i), "a\nb;c" * (i % 5), '"'] for i in range(2000)]
    path = write_file(as_csv(records))
    lines = split_scan.physical_lines(spark, path, 256)
    tasks = split_scan.TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    assert lines.select("file", "start").distinct().count() > 2 * tasks >= 2 * lines.rdd.getNumPartitions()
    assert rows(read_delimited(spark, path, Dialect(split=True, split_bytes=256))) == rows(read_delimited(spark, path))
