import os
import tempfile

import pytest
from pyspark.sql import functions as F

from cohortforge.sources import io


def test_text_folder_catalog_and_types(spark):
    d = tempfile.mkdtemp(prefix="cf-io-")
    with open(os.path.join(d, "ADMISSIONS.csv"), "w", encoding="latin-1") as f:
        f.write("HADM_ID,ADMITTIME,VALUENUM,NOTE\n1,2020-01-01 10:00:00,3.5,caf\xe9\n2,bad time,n/a,x\n")
    with open(os.path.join(d, "copy icloud.csv"), "w") as f:
        f.write("A\n1\n")
    tables = io.read_table_folder(spark, d)
    assert list(tables) == ["admissions"]
    df = tables["admissions"]
    assert df.columns == ["hadm_id", "admittime", "valuenum", "note"]
    assert dict(df.dtypes)["hadm_id"] == "string"       # everything arrives as text
    typed = io.apply_types(df, io.TableSpec("admissions", {"hadm_id": "long", "admittime": "timestamp",
                                                           "valuenum": "double"}))
    rows = sorted(typed.collect(), key=lambda r: r["hadm_id"])
    assert rows[0]["valuenum"] == 3.5 and rows[0]["note"] == "caf\xe9"
    assert rows[1]["admittime"] is None and rows[1]["valuenum"] is None
    strict = io.apply_types(df, io.TableSpec("admissions", {"admittime": "timestamp_strict"}))
    with pytest.raises(Exception):
        strict.collect()


def test_hash_bins_roundtrip_and_pruning(spark):
    base = tempfile.mkdtemp(prefix="cf-bins-")
    df = spark.range(0, 2000).select(F.col("id").alias("hadm_id"), (F.col("id") % 7).alias("v"))
    io.write_hash_bins(df, base, "hadm_id")
    back = io.read_bins(spark, base)
    assert back.count() == 2000 and dict(back.dtypes)["bin_id"] == "string"
    some = io.read_bins(spark, base, ["00", "0a"])
    exp = df.withColumn("b", F.substring(F.md5(F.col("hadm_id").cast("string")), 1, 2)).where("b in ('00','0a')").count()
    assert some.count() == exp
    # appending a second chunk keeps both
    io.write_hash_bins(df, base, "hadm_id")
    assert io.read_bins(spark, base).count() == 4000


def test_streaming_bin_split_csv(spark):
    from pyspark.sql.types import StringType, StructField, StructType
    from cohortforge.streaming import start_bin_split
    src = tempfile.mkdtemp(prefix="cf-src-")
    for i in range(3):  # three "chunks", each with its header
        with open(os.path.join(src, f"part{i}.csv"), "w") as f:
            f.write("HADM_ID,VALUE\n" + "".join(f"{i * 100 + k},{k}\n" for k in range(100)))
    out, ck = tempfile.mkdtemp(prefix="cf-out-"), tempfile.mkdtemp(prefix="cf-ck-")
    schema = StructType([StructField("HADM_ID", StringType()), StructField("VALUE", StringType())])
    q = start_bin_split(spark, src, schema, out, "HADM_ID", fmt="csv", checkpoint=ck)
    q.awaitTermination()
    back = io.read_bins(spark, out)
    assert back.count() == 300 and set(back.columns) == {"hadm_id", "value", "bin_id"}
    # a restart over the same input adds nothing (exactly once)
    q = start_bin_split(spark, src, schema, out, "HADM_ID", fmt="csv", checkpoint=ck)
    q.awaitTermination()
    assert io.read_bins(spark, out).count() == 300
