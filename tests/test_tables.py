from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curbside.plans.experiments import plan_text
from curbside.session import shared_folder
from curbside.sources.tables import VersionedTable, read_if_exists, schema_versions
from tests.conftest import rows


def test_versions_stay_readable(spark, root):
    table = VersionedTable(spark, root, "t")
    assert not table.exists()
    with pytest.raises(RuntimeError):
        table.read()
    table.overwrite(spark.range(3))
    table.append(spark.range(3, 5))
    first = rows(table.read(0))
    table.overwrite(spark.range(9, 10))
    assert rows(table.read(0)) == first == [(0,), (1,), (2,)]
    assert table.read(1).count() == 5 and rows(table.read()) == [(9,)]
    table.restore(1)
    assert table.read().count() == 5 and table.latest_version() == 3
    table.append(spark.range(100, 101))
    assert table.read().count() == 6 and table.read(3).count() == 5
    history = table.history().orderBy("version").collect()
    assert [h.op for h in history] == ["overwrite", "append", "overwrite", "restore", "append"]
    assert [h.n_rows for h in history] == [3, 5, 1, 5, 6]
    assert len({b for h in history for b in h.batches}) == 4  # a restore writes no data


def test_schema_grows_and_types_are_kept(spark, root):
    table = VersionedTable(spark, root, "t")
    table.overwrite(spark.range(2))
    table.append(spark.range(2, 3).withColumn("extra", F.lit("x")))
    commit = table.append(spark.range(3, 4).select(F.lit(1.5).alias("more"), "id"))
    assert rows(table.read()) == sorted([(0, None, None), (1, None, None), (2, "x", None), (3, None, 1.5)])
    assert rows(table.added_rows(commit)) == [(3, None, 1.5)]
    with pytest.raises(ValueError):
        table.append(spark.range(1).select(F.col("id").cast("string").alias("id")))
    versions = schema_versions(table.history(), 2).orderBy("version").collect()
    assert [(v.columns_added, v.schema_version) for v in versions] == [
        ([], "2.0"), (["extra"], "2.1"), (["extra", "more"], "2.2")
    ]


def test_two_tables_share_a_root(spark, root):
    a, b = VersionedTable(spark, root, "a"), VersionedTable(spark, root, "b")
    a.overwrite(spark.range(1))
    b.overwrite(spark.range(2))
    assert a.latest_version() == b.latest_version() == 0
    assert a.read().count() == 1 and b.read().count() == 2


def test_partitions_prune_across_batches(spark, root):
    table = VersionedTable(spark, root, "t", partition_by=["day"])
    table.overwrite(spark.range(4).withColumn("day", F.concat(F.lit("2024-01-0"), F.col("id") + 1)))
    table.append(spark.range(4, 6).withColumn("day", F.lit("2024-01-02")))
    assert dict(table.read().dtypes)["day"] == "string"
    chosen = table.read().where("day = '2024-01-02'")
    assert rows(chosen.select("id")) == [(1,), (4,), (5,)]
    assert any("PartitionFilters" in line and "day" in line for line in plan_text(chosen).splitlines())


def test_empty_batch(spark, root):
    table = VersionedTable(spark, root, "t")
    table.overwrite(spark.range(2))
    commit = table.append(spark.range(0))
    assert commit.added_rows == 0 and table.read().count() == 2


def test_a_writer_that_died_before_its_commit_blocks_nothing(spark, root):
    table = VersionedTable(spark, root, "t")
    table.overwrite(spark.range(3))
    spark.range(90, 95).write.parquet(f"{table.path}/_batch=1")  # no commit names it
    assert table.read().count() == 3
    table.append(spark.range(3, 5))
    assert rows(table.read()) == [(i,) for i in range(5)]


def test_only_a_missing_path_reads_as_no_table(spark, tmp_path):
    assert read_if_exists(spark, str(tmp_path / "none"), "a int").isEmpty()
    with pytest.raises(Exception, match="(?i)parse|syntax"):
        read_if_exists(spark, str(tmp_path), "a no_such_type(")


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

            @staticmethod
            def getCheckpointDir():
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)
