import glob
import os

from pyspark.sql import functions as F

from clientlens import operators as ops
from clientlens.functions import parse_int
from clientlens.schema import client_schema
from clientlens.sources import (
    clean_rows, ingest_table, load_clients, metric_rows, read_raw_rows, register_csv_table,
    write_chunks, write_tsv,
)

HEADER = ("age,job,marital,education,default,balance,housing,loan,contact,day,month,"
          "duration,campaign,pdays,previous,poutcome,y")
LINES = [
    "35,admin.,married,secondary,no,1200,yes,no,cellular,5,may,120,1,-1,0,unknown,no",
    "41, services ,single,tertiary,no,abc,no,no,cellular,6,jun,200,2,90,1,success,yes",
    "29,admin.,single,primary,no,300,yes,yes,unknown,7,jun,60,1,-1,0,unknown,no",
    "50,services,married,primary,yes,800,no",  # short row: dropped
    "12.5,admin.,married,secondary,no,100,yes,no,cellular,5,may,120,1,-1,0,unknown,no",
]


def _write_csv(tmp_dir, lines=LINES):
    path = os.path.join(tmp_dir, "bank")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.csv"), "w") as f:
        f.write("\n".join([HEADER] + lines) + "\n")
    return path


def test_typed_load_is_explicit(spark, tmp_dir):
    df = load_clients(spark, _write_csv(tmp_dir))
    assert df.schema == client_schema()
    assert df.count() == 5


def test_clean_rows_drop_short_trim_and_per_metric_parse(spark, tmp_dir):
    clean = clean_rows(read_raw_rows(spark, _write_csv(tmp_dir)))
    assert clean.count() == 4  # the short row is gone
    jobs = sorted(r["job"] for r in clean.collect())
    assert jobs == ["admin.", "admin.", "admin.", "services"]  # " services " trimmed
    # MR-1: the bad balance leaves only the balance metric
    bal = metric_rows(clean, ["balance"], keep=["job"])
    got = {r["job"]: (r["avg_balance"], r["count"])
           for r in ops.avg_by_group(bal, "job", "balance", "avg_balance").collect()}
    assert got == {"admin.": (533.33, 3)}  # services had only a bad balance: absent
    # ... but the row still counts in MR-2
    assert ops.count_by(clean, ["education", "housing"]).where(
        F.col("education") == "tertiary").collect()[0]["count"] == 1
    # MR-5: age must parse as an int ("12.5" is rejected like Python int())
    ages = metric_rows(clean, ["age", "balance"], cast={"age": parse_int("age")})
    assert ages.count() == 2


def test_write_chunks_keeps_remainder(spark, tmp_dir):
    df = spark.range(120).withColumnRenamed("id", "n").coalesce(1)
    out = os.path.join(tmp_dir, "chunks")
    write_chunks(df, out, 50)
    sizes = []
    for f in sorted(glob.glob(os.path.join(out, "*.csv"))):
        with open(f) as fh:
            sizes.append(len(fh.read().splitlines()) - 1)  # minus header
    assert sorted(sizes) == [20, 50, 50]
    back = spark.read.option("header", True).csv(out)
    assert back.where(F.col("event_time").isNull()).count() == 0


def test_write_tsv(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1.5)], "k string, v double")
    out = os.path.join(tmp_dir, "tsv")
    write_tsv(df, out)
    lines = []
    for f in glob.glob(os.path.join(out, "part-*")):
        with open(f) as fh:
            lines += fh.read().splitlines()
    assert lines == ["a\t1.5"]


def test_ingest_table_appends(spark, tmp_dir):
    df = spark.createDataFrame([(1,), (2,)], "x int")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bankdb LOCATION '{tmp_dir}/bankdb'")
    ingest_table(df, "clients_t", "bankdb")
    t = ingest_table(df, "clients_t", "bankdb")
    assert t.count() == 4


def test_register_csv_table_skips_header(spark, tmp_dir):
    t = register_csv_table(spark, "bank_csv", _write_csv(tmp_dir))
    assert t.count() == 5 and t.schema == client_schema()
    assert spark.sql("SELECT count(*) FROM bank_csv WHERE job = 'admin.'").collect()[0][0] == 3


def test_ingest_table_use_database(spark, tmp_dir):
    df = spark.createDataFrame([(1,)], "x int")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS usedb LOCATION '{tmp_dir}/usedb'")
    ingest_table(df, "t1", "usedb", use=True)
    try:
        assert spark.catalog.currentDatabase() == "usedb"
        assert spark.table("t1").count() == 1
    finally:
        spark.catalog.setCurrentDatabase("default")


def test_load_clients_rename(spark, tmp_dir):
    df = load_clients(spark, _write_csv(tmp_dir), renames={"default": "default_credit"})
    assert "default_credit" in df.columns and "default" not in df.columns


def test_raw_rows_skip_any_header_per_file(spark, tmp_dir):
    folder = os.path.join(tmp_dir, "two")
    os.makedirs(folder)
    other_header = HEADER.replace("default", "default_")
    for i, head in enumerate([HEADER, other_header]):
        with open(os.path.join(folder, f"part-{i}.csv"), "w") as f:
            f.write("\n".join([head] + LINES[:2]) + "\n")
    clean = clean_rows(read_raw_rows(spark, folder))
    assert clean.count() == 4 and clean.where(F.col("job") == "job").count() == 0
    quoted = os.path.join(tmp_dir, "quoted")
    os.makedirs(quoted)
    with open(os.path.join(quoted, "q.csv"), "w") as f:
        f.write(HEADER + "\n" + '35,"admin., senior",married,secondary,no,1200,yes,no,cellular,'
                '5,may,120,1,-1,0,unknown,no\n')
    rows = clean_rows(read_raw_rows(spark, quoted)).collect()
    assert len(rows) == 1 and rows[0]["job"] == "admin., senior"


def test_checkpoint_folder_is_required_off_local(spark, monkeypatch):
    """No folder of the driver's own disk on a cluster."""
    import pytest

    from clientlens import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    monkeypatch.setattr(session, "_context", lambda s: Context())
    monkeypatch.setattr(session, "_conf", lambda s, k: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(spark)


def test_register_csv_table_keeps_an_existing_table(spark, tmp_dir):
    spark.sql("CREATE TABLE IF NOT EXISTS clients_kept (x INT) USING parquet")
    spark.sql("INSERT INTO clients_kept VALUES (7)")
    register_csv_table(spark, "clients_kept", tmp_dir)
    assert [r.x for r in spark.table("clients_kept").collect()] == [7]
    spark.sql("DROP TABLE clients_kept")


def test_stage_does_not_overwrite(spark, tmp_dir):
    import pytest
    from pyspark.errors import AnalysisException

    from clientlens.reports.common import stage
    stage(spark.range(3), f"{tmp_dir}/s")
    with pytest.raises(AnalysisException):
        stage(spark.range(5), f"{tmp_dir}/s")


def test_plans_leave_one_copy(spark):
    """Plans that write replace their own folder instead of adding one."""
    import os

    from clientlens.plans import io
    from clientlens.session import app_id, ensure_checkpoint_dir
    for _ in range(2):
        io.load_clients_plan(spark, "/root/testdata/sf0.001").collect()
    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    assert len(os.listdir(f"{root}/clientlens/plans/{app_id(spark)}/csv")) == 1


def test_overflowing_sums(spark):
    from clientlens import functions as fn
    df = spark.createDataFrame([(5e16,)] * 4, "v double")
    assert df.agg(fn.fixed_point_mean("v", 2, 2)).first()[0] == 5e16
