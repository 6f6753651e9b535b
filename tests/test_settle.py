import re
import time
from pathlib import Path

import pytest

from dimloom.sources import settle


class _Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master


class _Frame:
    """Stands in for a frame of a session without the setting."""

    def __init__(self, master):
        self.sparkSession = self
        self.conf = {}
        self.sparkContext = _Context(master)


def test_rows_survive_and_the_named_folder_is_used(spark):
    rows = settle.settle(spark.range(5).withColumnRenamed("id", "n"), "test")
    assert sorted(r.n for r in rows.collect()) == [0, 1, 2, 3, 4]
    assert spark.conf.get("spark.checkpoint.dir") in rows.inputFiles()[0]


def test_a_cluster_must_name_the_folder():
    assert settle.shared_folder(_Frame("local[2]")) == settle.shared_folder(_Frame("local[2]"))
    with pytest.raises(RuntimeError):
        settle.shared_folder(_Frame("spark://host:7077"))
    with pytest.raises(RuntimeError):
        settle.shared_folder(_Frame("local-cluster[2,1,1024]"))


def _shuffle_files(spark):
    files = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllFiles().mkString(",")
    return set(re.findall(r"shuffle_\d+", files))


def test_a_step_gives_its_disk_back(spark, tmp_path):
    folder, before = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")), spark.conf.get(settle.CLEANUP, "false")
    known, shuffled = set(folder.iterdir()), _shuffle_files(spark)
    with settle.scratch(spark):
        with settle.scratch(spark):
            settle.settle(spark.range(5), "inner")
        outer = settle.settle(spark.range(100).repartition(3, "id"), "outer")
        outer.write.parquet(str(tmp_path / "out"))
        assert [p.name[:13] for p in set(folder.iterdir()) - known] == ["dimloom-outer"]
    assert set(folder.iterdir()) == known and spark.conf.get(settle.CLEANUP) == before
    for _ in range(50):  # Spark deletes them in the background
        if _shuffle_files(spark) <= shuffled:
            break
        time.sleep(0.2)
    assert _shuffle_files(spark) <= shuffled
    assert spark.read.parquet(str(tmp_path / "out")).count() == 100


def test_a_failed_step_gives_its_disk_back(spark):
    folder = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    known = set(folder.iterdir())
    with pytest.raises(ValueError):
        with settle.scratch(spark):
            settle.settle(spark.range(5), "failed")
            raise ValueError
    assert set(folder.iterdir()) == known
