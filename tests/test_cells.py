import pytest
from pyspark.sql import types as T

from starflow.sources.cells import BAD_CELLS, bad_cell_counts, scan_cells
from starflow.sources.contract import SchemaContract

CONTRACT = SchemaContract(
    T.StructType([
        T.StructField("ID", T.IntegerType()),
        T.StructField("Name", T.StringType()),
        T.StructField("Day", T.DateType()),
    ])
)


def scan(spark, tmp_path, text, header=True):
    (tmp_path / "in.csv").write_text(text)
    return scan_cells(spark, str(tmp_path / "in.csv"), CONTRACT, header=header)


def bad(df):
    return {r["Name"]: [tuple(e) for e in r[BAD_CELLS]] for r in df.collect()}


def test_every_bad_cell_has_a_reason(spark, tmp_path, ansi):
    df = scan(
        spark, tmp_path,
        'Day, Name ,ID\n2024-01-02,ok,1\n2024-13-02,day,2\n,both,x\n2024-01-02,"a,b \\"q\\", c"\n'
        "2024-01-02,long,3,4\n2024-01-02,long empty,3,\n2024-01-02,,99999999999\n",
    )
    found = bad(df)
    assert found["ok"] == []
    assert found["day"] == [("Day", "2024-13-02", "not date")]
    assert found["both"] == [("ID", "x", "not int")]
    assert found[None] == [("ID", "99999999999", "not int")]
    assert [e[2] for e in found["long"]] == [e[2] for e in found["long empty"]] == ["more cells than columns"]
    short = next(v for k, v in found.items() if k and k.startswith("a,b"))
    assert short == [("ID", None, "missing cell")]
    assert {(r["column"], r["reason"]): r["cells"] for r in bad_cell_counts(df).collect()} == {
        ("Day", "not date"): 1, ("ID", "not int"): 2, ("ID", "missing cell"): 1,
        (None, "more cells than columns"): 2,
    }
    assert df.schema["ID"].dataType == T.IntegerType() and df.columns == ["ID", "Name", "Day", BAD_CELLS]


def test_without_header_and_empty(spark, tmp_path):
    assert bad(scan(spark, tmp_path, "1,a,2024-01-01\n2\n", header=False)) == {
        "a": [], None: [("Name", None, "missing cell"), ("Day", None, "missing cell")],
    }
    assert scan(spark, tmp_path, "ID,Name,Day\n").count() == 0


def test_pruned_scan_still_finds_short_rows(spark, tmp_path):
    df = scan(spark, tmp_path, "ID,Name,Day\n1,a,2024-01-01\n2,b\n")
    assert [len(r[0]) for r in df.select(BAD_CELLS).collect()] == [0, 1]


def test_unfit_header(spark, tmp_path):
    with pytest.raises(ValueError, match="header"):
        scan(spark, tmp_path, "ID,Name\n1,a\n")
