import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starflow.sources import workspace as ws
from starflow.sources.contract import (
    SALES_COLUMNS,
    SchemaContract,
    missing_required,
    normalize_columns,
    sales_contract,
)
from starflow.sources.files import (
    EmptySourceError,
    read_contract,
    read_parquet,
    scan_csv,
    write_csv,
)
from starflow.sources.tables import UnwritableTextError, read_table, write_table, write_tables

CONTRACT = SchemaContract(
    T.StructType([
        T.StructField("ID", T.IntegerType()),
        T.StructField("Value Sales", T.StringType()),
        T.StructField("N", T.LongType()),
    ]),
    ("ID", "Value Sales"),
)


def put(tmp_path, text, name="in.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_scan_applies_names_and_types(spark, tmp_path):
    path = put(tmp_path, 'ID,Value Sales,N\n1,"8,17,935",5\n2," ",\n3,,7\n')
    df = scan_csv(spark, path, CONTRACT)
    assert df.dtypes == [("ID", "int"), ("Value Sales", "string"), ("N", "bigint")]
    assert tuples(df) == [(1, "8,17,935", 5), (2, " ", None), (3, None, 7)]


def test_header_may_be_messy_and_in_any_order(spark, tmp_path):
    path = put(tmp_path, " N ,ID, Value   Sales \n5,1,x\n")
    assert tuples(scan_csv(spark, path, CONTRACT)) == [(1, "x", 5)]


@pytest.mark.parametrize("header", ["ID,Value,N", "ID,Value Sales", "ID,Value Sales,N,M"])
def test_wrong_header_is_an_error(spark, tmp_path, header):
    path = put(tmp_path, f"{header}\n1,x,5,6\n")
    with pytest.raises(ValueError, match="header"):
        scan_csv(spark, path, CONTRACT)


def test_a_later_file_with_another_header_is_an_error(spark, tmp_path):
    put(tmp_path, "ID,Value Sales,N\n1,x,5\n", "a.csv")
    put(tmp_path, "N,Value Sales,ID\n1,x,5\n", "b.csv")
    with pytest.raises(Exception, match="(?i)header"):
        scan_csv(spark, str(tmp_path), CONTRACT).collect()


def test_header_only_is_empty(spark, tmp_path, workspace):
    path = put(tmp_path, "ID,Value Sales,N\n")
    for mode in ("quarantine", "keep"):
        with pytest.raises(EmptySourceError, match="no rows"):
            read_contract(spark, path, CONTRACT, on_malformed=mode, workspace=workspace)
    assert issubclass(EmptySourceError, ValueError)


def test_missing_path(spark, tmp_path):
    with pytest.raises(AnalysisException):
        scan_csv(spark, str(tmp_path / "absent.csv"), CONTRACT)


DIRTY = "ID,Value Sales,N\n1,good,1\n2,short\n3,long,3,extra\nx,notint,4\n5,notlong,y\n6,good,\n"


def test_quarantine(spark, tmp_path, workspace):
    good, bad = read_contract(
        spark, put(tmp_path, DIRTY), CONTRACT, on_malformed="quarantine", workspace=workspace
    )
    assert tuples(good) == [(1, "good", 1), (6, "good", None)]
    assert good.columns == CONTRACT.names
    assert sorted(r["_corrupt_record"] for r in bad.select("_corrupt_record").collect()) == [
        "2,short", "3,long,3,extra", "5,notlong,y", "x,notint,4",
    ]
    assert bad.count() == 4 and good.count() == 2


def test_keep_leaves_null_cells(spark, tmp_path):
    good, bad = read_contract(spark, put(tmp_path, DIRTY), CONTRACT)
    assert bad is None
    assert tuples(good) == sorted(
        [(1, "good", 1), (2, "short", None), (3, "long", 3), (None, "notint", 4),
         (5, "notlong", None), (6, "good", None)], key=str)


def test_required_columns_with_nulls(spark):
    df = spark.createDataFrame([(1, None, None), (None, None, 3)], CONTRACT.schema)
    assert tuples(missing_required(df, CONTRACT)) == [("ID", 1), ("Value Sales", 2)]


def test_normalize_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], [" Value Sales ", "Value\t  Units", "ok"])
    assert normalize_columns(df).columns == ["Value Sales", "Value Units", "ok"]
    with pytest.raises(ValueError, match="a b"):
        normalize_columns(df.toDF("a b", " a  b", "c"))


def test_sales_contract():
    contract = sales_contract()
    assert len(contract.names) == 29 and len(contract.required) == 28
    assert "WAREHOUSE_ID" not in contract.required
    assert {f.dataType.simpleString() for f in contract.schema} == {"int", "bigint", "string"}
    assert sales_contract(short_names=True).names == [role for role, _, _ in SALES_COLUMNS]


def test_parquet_source(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.createDataFrame([(5, 1, "x")], "` N` int, ID bigint, `Value  Sales` string").write.parquet(path)
    df = read_parquet(spark, path, CONTRACT)
    assert df.dtypes == [("ID", "int"), ("Value Sales", "string"), ("N", "bigint")]
    assert tuples(df) == [(1, "x", 5)]


def test_csv_round_trip_keeps_blanks(spark, tmp_path):
    path = str(tmp_path / "c")
    df = spark.createDataFrame([(1, " a ", 2), (2, 'q"u,o', None)], CONTRACT.schema)
    write_csv(df, path)
    assert tuples(scan_csv(spark, path, CONTRACT)) == tuples(df)


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_write_tables(spark, tmp_path, fmt):
    tables = {
        "full": spark.range(100).select(F.col("id"), (F.col("id") % 3).alias("g")),
        "empty": spark.createDataFrame([], "a int"),
        "tiny": spark.createDataFrame([(1, None), (2, 5)], "k bigint, v int"),
    }
    for _ in range(2):
        manifest = write_tables(tables, str(tmp_path), fmt).collect()
    assert [(r["table"], r["rows"]) for r in manifest] == [("full", 100), ("empty", 0), ("tiny", 2)]
    for r in manifest:
        schema = tables[r["table"]].schema
        back = read_table(spark, r["path"], schema, fmt)
        assert tuples(back) == tuples(tables[r["table"]])
        size = sum(f.stat().st_size for f in (tmp_path / r["table"]).glob("part-*"))
        assert r["bytes"] == size


AWKWARD = [
    "a\nb", "\n", "", " ", " a ", '"', '""', 'say "x"', "\\", 'a\\"b', "\\n", "a,b", "#c", "null", "NULL",
    None, "\t", "é\u2028ü", "'", "\\\n\"",
]


def test_csv_tables_keep_every_text(spark, tmp_path):
    df = spark.createDataFrame([(t, i, t) for i, t in enumerate(AWKWARD)], "a string, i int, b string")
    (entry,) = write_tables({"t": df}, str(tmp_path), "csv").collect()
    back = read_table(spark, entry["path"], df.schema, "csv")
    assert entry["rows"] == len(AWKWARD)
    assert [tuple(r) for r in back.orderBy("i").collect()] == [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("text", ["\\N", "a\rb"])
def test_csv_refuses_what_it_cannot_keep(spark, tmp_path, text):
    df = spark.createDataFrame([(text,)], "a string")
    with pytest.raises(UnwritableTextError):
        write_tables({"t": df}, str(tmp_path), "csv")
    assert write_tables({"t": df}, str(tmp_path)).first()["rows"] == 1


def test_write_partitioned(spark, tmp_path):
    tables = {"t": spark.range(10).select("id", (F.col("id") % 2).alias("g"))}
    manifest = write_tables(tables, str(tmp_path), partition_by={"t": ["g"]}).first()
    assert manifest["rows"] == 10 and manifest["bytes"] > 0
    assert {p.name for p in (tmp_path / "t").glob("g=*")} == {"g=0", "g=1"}


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="fmt"):
        write_tables({"t": spark.range(1)}, str(tmp_path), "xml")


class FakeSession:
    def __init__(self, given=None, **conf):
        self.conf = conf
        self.sparkContext = self
        self.given = given

    def getCheckpointDir(self):
        return self.given


def test_workspace_uses_the_folder_of_the_context():
    session = FakeSession("hdfs://x/y/some-uuid", **{"spark.master": "spark://m"})
    assert ws.shared_root(session) == "hdfs://x/y"


def test_workspace_can_be_removed(spark, tmp_path):
    place = ws.Workspace(spark, str(tmp_path))
    place.store(spark.range(3), "t")
    assert list(tmp_path.iterdir())
    place.remove()
    assert not list(tmp_path.iterdir())


def test_workspace_uses_the_shared_folder():
    assert ws.shared_root(FakeSession(**{"spark.checkpoint.dir": "hdfs://x/y/"})) == "hdfs://x/y"


def test_a_cluster_needs_the_shared_folder():
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ws.shared_root(FakeSession(**{"spark.master": "yarn"}))


def test_row_ids_are_fixed_by_the_write(spark, workspace):
    stored = workspace.store(spark.range(1000).repartition(4), "t", row_id="r")
    once = sorted(map(tuple, stored.collect()))
    assert once == sorted(map(tuple, stored.repartition(2).orderBy(F.rand()).collect()))
    assert len({r for _, r in once}) == 1000


def test_compressed_csv_reads_back_and_is_smaller(spark, tmp_path):
    df = spark.range(2000).selectExpr("id", "concat(' text ', id % 7, ',') AS t", "IF(id % 3 = 0, NULL, 'x') AS n").coalesce(1)
    sizes = {}
    for codec in ("none", "gzip"):
        path = tmp_path / codec
        write_csv(df, str(path), codec)
        sizes[codec] = sum(f.stat().st_size for f in path.glob("part-*"))
        back = spark.read.schema(df.schema).option("header", True).csv(str(path))
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert sizes["gzip"] * 3 < sizes["none"]


def test_compressed_csv_table_keeps_every_text(spark, tmp_path):
    rows = [(i, t) for i in range(300) for t in ("one\ntwo", 'say "so"', "back\\slash", "", " b ", None, "x,y")]
    df = spark.createDataFrame(rows, "i int, t string").coalesce(1)
    sizes = {}
    for fmt in ("csv", "csv.gz"):
        write_table(df, str(tmp_path / fmt), fmt)
        sizes[fmt] = sum(f.stat().st_size for f in (tmp_path / fmt).glob("part-*"))
        back = read_table(spark, str(tmp_path / fmt), df.schema, fmt)
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert sizes["csv.gz"] * 3 < sizes["csv"]
