"""Files that do not agree on columns and types, and change files told apart by their headers."""

from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlake import __main__ as command
from ledgerlake.plans import buckets, warehouse
from ledgerlake.plans.layout import WarehousePaths
from ledgerlake.schemas import CHANGES, CHANGES_V1
from ledgerlake.sources import drift, landing

TARGET = T.StructType().add("id", T.LongType()).add("v", T.DoubleType()).add("w", T.StringType())


def land(spark, root, day, ddl, rows):
    spark.createDataFrame(rows, ddl).coalesce(1).write.mode("append").parquet(f"{root}/day={day}")


def test_types_change_from_day_to_day_and_within_a_day(spark, tmp_path):
    root = str(tmp_path / "l")
    land(spark, root, "2024-01-01", "id int, v string", [(1, "1.5"), (2, "x"), (3, " "), (4, None)])
    land(spark, root, "2024-01-02", "id long, v double, w string", [(5, 2.5, "w")])
    land(spark, root, "2024-01-03", "id string, v decimal(20,2)", [("6", Decimal("3.25")), ("s", Decimal("1.00"))])
    land(spark, root, "2024-01-04", "id long, v int, more string", [(7, 4, "m")])
    land(spark, root, "2024-01-04", "id long, v double", [(8, 5.0)])
    land(spark, root, "2024-01-05", "id long, v double", [])
    paths = [f"{root}/day=2024-01-0{n}" for n in range(1, 6)]
    groups = drift.physical_groups(spark, paths)
    assert sum(len(own) for _, own in groups) == 6  # four folders, and both files of one
    assert len(groups) == 4
    good, rejected = drift.read_drifted(spark, root, TARGET, "day")
    assert good.schema.simpleString() == "struct<id:bigint,v:double,w:string,day:string>"
    assert Counter(map(tuple, good.collect())) == Counter([
        (1, 1.5, None, "2024-01-01"), (3, None, None, "2024-01-01"), (4, None, None, "2024-01-01"), (5, 2.5, "w", "2024-01-02"),
        (6, 3.25, None, "2024-01-03"), (7, 4.0, None, "2024-01-04"), (8, 5.0, None, "2024-01-04"),
    ])
    assert Counter(map(tuple, rejected.collect())) == Counter([
        ("2", "x", None, "2024-01-01", "unparsed_v"), ("s", "1.00", None, "2024-01-03", "unparsed_id"),
    ])
    some = drift.read_drifted(spark, root, TARGET, "day", "2024-01-02", "2024-01-04")
    assert [r.id for r in some[0].orderBy("id").collect()] == [5, 6] and some[1].count() == 1


def test_files_that_agree_are_one_scan(spark, tmp_path):
    root = str(tmp_path / "l")
    for n in range(1, 7):
        land(spark, root, f"2024-01-0{n}", "id long, v double" if n < 4 else "id int, v double", [(n, 1.0)])
    good, _ = drift.read_drifted(spark, root, TARGET, "day")
    plan = good._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert good.count() == 6


@pytest.mark.parametrize(
    "source, target, kept, lost",
    [
        ("double", "int", 3.0, 3.5), ("double", "decimal(18,4)", 0.1, 0.00001), ("long", "int", 5, 1 << 40),
        ("decimal(18,6)", "decimal(18,4)", Decimal("0.100000"), Decimal("0.100001")), ("long", "double", 1 << 53, (1 << 53) + 1),
        ("string", "date", "2024-02-29", "2023-02-29"), ("timestamp_ntz", "date", datetime(2024, 1, 1), datetime(2024, 1, 1, 5)),
        ("string", "int", " 7 ", "7.5"),
    ],
)
def test_cells_are_exact_or_rejected(spark, source, target, kept, lost):
    rows = spark.createDataFrame([(kept,), (lost,), (None,)], f"v {source}")
    good, rejected = drift.split_drifted(rows, T.StructType.fromDDL(f"v {target}"))
    assert good.count() == 2 and [r.reject_reason for r in rejected.collect()] == ["unparsed_v"]


def test_a_layer_without_folders(spark, tmp_path):
    good, rejected = drift.read_drifted(spark, str(tmp_path / "none"), TARGET, "day")
    assert good.count() == rejected.count() == 0 and "day" in good.columns


def test_headers_tell_the_version(spark, tmp_path):
    old, new = ",".join(CHANGES_V1.names), ",".join(CHANGES.names)
    (tmp_path / "a 1+2.csv").write_text(old + "\n1,1,2024-01-01 10:00:00,I,a,1.0\nx,1,2024-01-01 10:00:00,I,a,1.0\n")
    (tmp_path / "b.csv").write_text(new + "\n2,2,2024-01-01 10:00:00,I,a,1.0,e,p\n")
    (tmp_path / "c.csv").write_text("other,columns\n3,3\n")
    good, rejected = landing.split_change_files(spark, str(tmp_path), [CHANGES_V1, CHANGES], CHANGES)
    assert Counter((r.seq, r.email) for r in good.collect()) == Counter([(1, None), (2, "e")])
    lines = {r[landing.CORRUPT] for r in rejected.collect()}
    assert lines == {"x,1,2024-01-01 10:00:00,I,a,1.0", "other,columns", "3,3"}


def test_commands_take_files_of_both_versions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(command, "build_session", lambda name: spark)
    root, csv = str(tmp_path / "w"), tmp_path / "csv"
    csv.mkdir()
    lines = "\n".join(f"{n},{n},2024-01-01 10:00:00,I,a,1.0" for n in range(5))
    (csv / "old.csv").write_text(",".join(CHANGES_V1.names) + "\n" + lines + "\n")
    (csv / "new.csv").write_text(",".join(CHANGES.names) + "\n9,1,2024-01-02 10:00:00,U,b,1.0,e,p\n")
    delivery = ["--warehouse", root, "--delivery", "2024-01-02"]
    command.main(["change-feed", *delivery, "--changes", str(csv)])
    paths, feed = WarehousePaths.under(root), warehouse.Feed(CHANGES, ("segment",))
    assert spark.read.parquet(f"{paths.change_reject}_lines").count() == 0
    command.main(["bucketed-batch", *delivery, "--buckets", "4"])
    rows = buckets.read_bucketed_dimension(spark, feed, paths).where("id = 1").orderBy("start_date").collect()
    assert [(r.segment, r.start_date) for r in rows] == [("a", date(2024, 1, 1)), ("b", date(2024, 1, 2))]
    assert buckets.read_bucketed_state(spark, feed, paths).where(F.col("email") == "e").count() == 1
    command.main(["cleanup", *delivery, "--keep", "1"])
