"""Pages at any offset from the ranges they fall in; exports that are whole or not there."""

import csv
import json

import pytest
from pyspark.sql import functions as F

from millrace.operators.pages import Ordered
from millrace.sources.export import export


def test_a_deep_page_opens_one_or_two_ranges(spark, tmp_path):
    rows = spark.range(20_000).selectExpr("id as k", "id % 7 as v")
    order = [F.col("v").desc(), F.col("k")]
    t = Ordered(spark, str(tmp_path / "t"), rows.schema)
    assert t.count() == 0 and t.page(order).count() == 0
    t.write(rows, order, 20)
    want = [tuple(r) for r in rows.orderBy(*order).collect()]
    for offset, limit in ((0, 5), (10_000, 100), (19_990, 50), (20_000, 5), (7, 0), (3_000, 2_500)):
        page = t.page(order, limit, offset)
        assert [tuple(r) for r in page.collect()] == want[offset : offset + limit]
        if limit == 100:
            assert len({f.split("__range=")[1].split("/")[0] for f in page.inputFiles()}) <= 2
    t.write(rows.where("k < 10"), order, 3)
    assert t.count() == 10 and len([x for x in (tmp_path / "t").iterdir() if x.name.startswith("data-")]) == 1


def table(spark, n=50):
    return spark.range(n).selectExpr("id", "if(id % 5 = 0, null, concat('a,\"', id)) as s", "array(id, 1) as xs").repartition(4)


def test_export_replaces_the_copy_before_as_a_whole(spark, tmp_path):
    at = tmp_path / "out"
    export(table(spark), str(at))
    export(table(spark, 20), str(at))
    rows = [r for f in sorted(at.glob("part-*.csv")) for r in csv.DictReader(f.open())]
    assert sorted(int(r["id"]) for r in rows) == list(range(20)) and {r["s"] for r in rows if int(r["id"]) == 7} == {'a,"7'} and json.loads(rows[0]["xs"])[1] == 1
    assert json.loads((at / "_SUCCESS").read_text()) == {"rows": 20} and [x.name for x in tmp_path.iterdir()] == ["out"]
    export(table(spark), str(at), "jsonl")
    assert sum(len(f.read_text().splitlines()) for f in at.glob("part-*.jsonl")) == 50 and not list(at.glob("*.csv"))


def test_a_failed_task_leaves_no_file_and_the_copy_before(spark, tmp_path):
    at = tmp_path / "out"
    export(table(spark, 10), str(at))
    broken = table(spark).withColumn("bad", F.when(F.col("id") == 33, F.raise_error(F.lit("broken row"))))
    with pytest.raises(Exception, match="broken row"):
        export(broken, str(at))
    assert [x.name for x in tmp_path.iterdir()] == ["out"] and json.loads((at / "_SUCCESS").read_text()) == {"rows": 10}
    with pytest.raises(Exception, match="kind is one of"):
        export(table(spark), str(at), "xls")
