"""Ordered exports: files in key order, a manifest that lists complete files only."""

import glob
import json
import os

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tallyrow.functions.ordering import with_ordinal
from tallyrow.sources import export

SCHEMA = "k bigint, text string"


@pytest.fixture
def rows(spark):
    return spark.range(500).select(F.expr("(id * 37) % 500").alias("k"), F.expr("if(id % 9 = 0, null, concat('é\\n', id))").alias("text")).repartition(5)


@pytest.mark.parametrize("files", [1, 7])
def test_manifest_order_is_key_order(spark, tmp_path, rows, files):
    path = f"{tmp_path}/out"
    assert export.export_ordered(rows, "k", path, files=files) == 500
    listed = sorted(export.read_manifest(spark, path).collect(), key=lambda r: r["part"])
    assert len(listed) == files and [r["first"] for r in listed] == [sum(x["rows"] for x in listed[:i]) for i in range(files)]
    read = [json.loads(line) for r in listed for line in open(f"{path}/data/{r['name']}", encoding="utf-8")]
    assert [r["k"] for r in read] == list(range(500)) and set(read[0]) == {"k", "text"}
    export.check_export(spark, path)
    again = with_ordinal(export.read_ordered(spark, path, SCHEMA, split_bytes=300), export.ORDER)
    assert sorted((r.ordinal, r.k, r.text) for r in again.collect()) == sorted((r.k, r.k, r.text) for r in rows.collect())


def test_fields_need_not_hold_the_key(spark, tmp_path, rows):
    path = f"{tmp_path}/out"
    export.export_ordered(rows, "k", path, ["text"], files=3)
    got = with_ordinal(export.read_ordered(spark, path, "text string"), export.ORDER).orderBy("ordinal").collect()
    assert [r.text for r in got] == [r.text for r in rows.orderBy("k").collect()]


def test_a_failed_task_leaves_no_listed_file(spark, tmp_path, rows):
    path = f"{tmp_path}/out"
    broken = rows.withColumn("text", F.when(F.col("k") == 499, F.raise_error(F.lit("no"))).otherwise(F.col("text")))
    with pytest.raises((PySparkException, Py4JJavaError)):
        export.export_ordered(broken, "k", path, files=4)
    assert not os.path.exists(f"{path}/_manifest")
    with pytest.raises(PySparkException):
        export.read_ordered(spark, path, SCHEMA).collect()


def test_unlisted_files_are_left_out_and_missing_ones_found(spark, tmp_path, rows):
    path = f"{tmp_path}/out"
    export.export_ordered(rows, "k", path, files=4)
    with open(f"{path}/data/part-00099-left-behind.json", "w") as out:
        out.write('{"k": -1, "text": "x"}\n')
    assert export.read_ordered(spark, path, SCHEMA).count() == 500
    export.check_export(spark, path)
    name = os.path.basename(sorted(glob.glob(f"{path}/data/part-00002*"))[0])
    with open(f"{path}/data/{name}", "a") as out:
        out.write('{"k": -2, "text": "y"}\n')
    hidden = glob.glob(f"{path}/data/.{name}.crc")
    for file in hidden:
        os.remove(file)
    with pytest.raises(ValueError, match=name):
        export.check_export(spark, path)


def test_keys_and_folders_are_checked(spark, tmp_path, rows):
    path = f"{tmp_path}/out"
    with pytest.raises(ValueError, match="repeat"):
        export.export_ordered(rows.union(rows.limit(1)), "k", path)
    export.export_ordered(rows, "k", path, files=2)
    with pytest.raises(PySparkException):
        export.export_ordered(rows, "k", path, files=2)
    with pytest.raises(ValueError, match="part"):
        export.read_ordered(spark, path, "part int")
    assert export.export_ordered(rows.where("false"), "k", f"{tmp_path}/none") == 0
    assert export.read_ordered(spark, f"{tmp_path}/none", SCHEMA).collect() == []
