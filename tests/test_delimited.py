import pytest

from ledgerkit.sources.delimited import header_names, read_delimited, repair_header
from ledgerkit.spec import Dialect


def rows(df):
    return [tuple(r) for r in df.collect()]


def test_every_column_is_text_and_multiline_survives(spark, write_file):
    path = write_file('Id;Note;N\n1;"two\nlines; ""quoted""";  007 \n')
    df = read_delimited(spark, path)
    assert df.dtypes == [("Id", "string"), ("Note", "string"), ("N", "string")]
    assert rows(df) == [("1", 'two\nlines; "quoted"', "007")]


def test_short_long_blank_and_empty(spark, write_file):
    path = write_file('A;B;C\n1;2\n\n3;4;5;6\n7;"";\n')
    df = read_delimited(spark, path)
    assert rows(df) == [("1", "2", None), ("3", "4", "5"), ("7", None, None)]
    flagged = read_delimited(spark, path, reject_column="bad")
    assert [(r.A, r.bad is not None) for r in flagged.collect()] == [("1", True), ("3", True), ("7", False)]


def test_encodings(spark, write_file):
    body = "Id;City\n1;Liège\n"
    for encoding, name in [("utf-8", "UTF-8"), ("utf-8-sig", "UTF-8"), ("utf-16", "UTF-16"), ("latin-1", "ISO-8859-1")]:
        path = write_file(body, f"{encoding}.csv", encoding)
        df = repair_header(read_delimited(spark, path, Dialect(encoding=name)), "Id")
        assert (df.columns, rows(df)) == (["Id", "City"], [("1", "Liège")]), encoding


def test_misread_utf16_is_reported(spark, write_file):
    path = write_file("Id;City\n1;Gent\n", encoding="utf-16-le")
    df = read_delimited(spark, path, Dialect(multiline=False))
    with pytest.raises(ValueError, match="encoding"):
        repair_header(df, "Id")


def test_repeated_names_raise(spark, write_file):
    with pytest.raises(ValueError, match="repeated column names"):
        header_names(spark, write_file("Id;X;Id\n1;2;3\n"), Dialect())


def test_numbered_names_are_not_taken_for_repetitions(spark, write_file):
    path = write_file("a0;a1;a2\n1;2;3\n")
    assert read_delimited(spark, path).columns == ["a0", "a1", "a2"]


def test_nameless_and_header_only(spark, write_file):
    df = read_delimited(spark, write_file("Id;;X\n"))
    assert df.columns == ["Id", "_c1", "X"] and rows(df) == []
    with pytest.raises(ValueError, match="no header"):
        read_delimited(spark, write_file("", "empty.csv"))


def test_files_of_one_load_must_agree(spark, write_file):
    first, second = write_file("A;B\n1;2\n", "1.csv"), write_file("B;A\n3;4\n", "2.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_delimited(spark, [first, second]).collect()


def test_no_header_needs_names(spark, write_file):
    df = read_delimited(spark, write_file("1;2\n"), Dialect(header=False), columns=["A", "B"])
    assert rows(df) == [("1", "2")]


def test_columns_are_pruned(spark, write_file):
    df = read_delimited(spark, write_file("A;B;C\n1;2;3\n")).select("C")
    assert rows(df) == [("3",)]
    assert "ReadSchema: struct<C:string>" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("asked", [True, False])
def test_rebalance_only_when_asked_for(spark, write_file, asked):
    plan = read_delimited(spark, write_file("A\n1\n"), rebalance=asked)._jdf.queryExecution().analyzed().toString()
    assert ("RebalancePartitions" in plan or "Hint (strategy=rebalance)" in plan) == asked


def test_files_that_keep_all_cores_busy_are_not_spread(spark, write_file):
    """Whole files of even size give every core its share: their rows stay in the tasks that read them."""
    files = [write_file(f"A;B\n{i + 10};x\n", f"{i}.csv") for i in range(2 * spark.sparkContext.defaultParallelism)]
    even = read_delimited(spark, files, rebalance=True)
    assert "Exchange" not in even._jdf.queryExecution().executedPlan().toString()
    assert sorted(rows(even)) == [(str(i + 10), "x") for i in range(len(files))]
    large = write_file("A;B\n" + "1;y\n" * 10_000, "large.csv")
    uneven = read_delimited(spark, [*files, large], rebalance=True)
    assert "Exchange" in uneven._jdf.queryExecution().executedPlan().toString()
    assert uneven.count() == 10_000 + len(files)


def test_rows_of_a_whole_file_are_spread_unsorted(spark, write_file):
    """Round robin sorts all rows of a task before it deals them, and a large file's rows then spill."""
    values = [(str(i), "x;\ny", "") for i in range(5_000)]
    path = write_file("A;__run;`c.d`\n" + "".join(f'{a};"{b}";\n' for a, b, _ in values))
    spread = read_delimited(spark, path, rebalance=True)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" in plan and "RoundRobin" not in plan
    assert spread.columns == ["A", "__run", "`c.d`"]
    assert sorted(rows(spread)) == sorted((a, b, None) for a, b, _ in values)


@pytest.mark.parametrize(
    ("columns", "mode", "expected"),
    [
        (["Id", "B"], "strict", ["Id", "B"]),
        (["\ufeffId", "B"], "strict", ["Id", "B"]),
        ([" Id ", "B"], "strict", ["Id", "B"]),
        (["\ufffd\ufffdId", "B"], "strict", ["Id", "B"]),
        (["\ufeffId", "Id"], "strict", ["Id"]),
        (["LineId", "Id"], "strict", ["LineId", "Id"]),
        (["Number", "B"], "strict", ["Number", "B"]),
        (["LineId", "Id"], "legacy", ["Id"]),
        (["Number", "B"], "legacy", ["Id", "B"]),
        ([" Id ", "B"], "legacy", [" Id ", "B"]),
        (["Id", "B"], "legacy", ["Id", "B"]),
    ],
)
def test_repair_header(spark, columns, mode, expected):
    df = spark.createDataFrame([tuple("x" for _ in columns)], ", ".join(f"`{c}` string" for c in columns))
    assert repair_header(df, "Id", mode).columns == expected


def test_repair_mode_is_checked(spark):
    with pytest.raises(ValueError, match="repair mode"):
        repair_header(spark.range(1), "id", "loose")
