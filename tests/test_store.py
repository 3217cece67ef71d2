"""Shared folders: what is stored once is found again, and never where others cannot see it."""

import os
import shutil

import pytest
from pyspark.sql import functions as F

from badgeflow import session
from badgeflow.functions.times import time_text
from badgeflow.plans import warehouse as stored
from badgeflow.plans.registry import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_a_second_application_reuses_the_layers(spark, monkeypatch):
    first = stored.warehouse(spark, SMALL)
    monkeypatch.setattr(stored, "build", lambda *a: pytest.fail("built again"))
    assert stored.warehouse(spark.newSession(), SMALL).root == first.root


def test_changed_input_is_noticed(spark, tmp_path):
    copy = tmp_path / "data"
    copy.mkdir()
    for name in stored.BUILT_FROM:
        shutil.copyfile(f"{SMALL}/{name}.parquet", copy / f"{name}.parquet")
    before = stored.warehouse(spark, str(copy))
    assert stored.warehouse(spark, str(copy)).root == before.root
    rows = before.raw.count()
    half = spark.read.parquet(str(copy / "events.parquet")).limit(100)
    half.coalesce(1).write.parquet(str(tmp_path / "half"))
    (part,) = (tmp_path / "half").glob("part-*.parquet")
    shutil.copyfile(part, copy / "events.parquet")
    after = stored.warehouse(spark, str(copy))
    assert after.root != before.root and 0 < after.raw.count() < rows


def copy_of_input(folder):
    folder.mkdir()
    for name in stored.BUILT_FROM:
        shutil.copyfile(f"{SMALL}/{name}.parquet", folder / f"{name}.parquet")
    return str(folder)


def test_a_report_stores_what_it_reads_and_no_more(spark, tmp_path):
    """A load needs no fact, an alert of the fact no logs; what one stored the other finds."""
    data = copy_of_input(tmp_path / "data")
    QUERIES["fact_idempotent_load"](spark, data)
    wh = stored.warehouse(spark, data)
    have = lambda: {name for name in stored.PARTS if wh._complete(name)}
    loaded = {"raw", "stg", "dim_zones", "dim_users", "marks/arrival"}
    assert have() == loaded
    first = {name: wh.stored(name) for name in loaded}
    QUERIES["after_hours_alerts"](spark, data).collect()
    QUERIES["dq_run"](spark, data).collect()
    assert have() == loaded | {"fct", "marks/event"}
    assert first == {name: wh.stored(name) for name in loaded}


def test_a_half_written_part_is_not_read(spark, tmp_path):
    wh = stored.warehouse(spark, copy_of_input(tmp_path / "data"))
    half = f"{wh.root}/dim_zones/00"
    wh.spark.range(3).write.parquet(half)
    os.unlink(f"{half}/_SUCCESS")
    assert wh.zones.count() == 25 and "zone_key" in wh.zones.columns


class Cluster:
    """A session on a cluster that names no shared folder."""

    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://head:7077"


@pytest.mark.parametrize("master", ["spark://head:7077", "yarn", "local-cluster[2,1,1024]"])
def test_a_cluster_must_name_its_folder(master):
    Cluster.sparkContext.master = master
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.work_dir(Cluster, "x")


def test_times_of_long_years_are_whole(spark):
    row = spark.range(1).select(
        time_text(F.expr("timestamp_ntz'2024-01-01 00:00:00.1234'")), time_text(F.expr("timestamp_ntz'+12024-01-01 00:00:00.123456'"))
    ).first()
    assert tuple(row) == ("2024-01-01 00:00:00.123400", "+12024-01-01 00:00:00.123456")


def test_scratch_goes_with_its_application(tmp_path):
    """A job of its own leaves the layers it shares, and no scratch."""
    import os
    import subprocess
    import sys

    code = (
        "from badgeflow.session import local_session, work_dir\n"
        f"spark = local_session(1, **{{'spark.checkpoint.dir': {str(tmp_path)!r}}})\n"
        "path = work_dir(spark, 'x')\n"
        "spark.range(3).write.parquet(path)\n"
        "print('ROWS', spark.read.parquet(path).count())\n"
        "spark.stop()\n"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert "ROWS 3" in done.stdout
    assert not [f for _, _, files in os.walk(tmp_path) for f in files if f.startswith("part-")]


def test_executors_get_the_package(tmp_path):
    """Workers whose working folder is elsewhere import it once it is shipped."""
    import os
    import subprocess
    import sys

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    code = (
        "import sys\n"
        f"sys.path.insert(0, {root!r})\n"
        "from pyspark.sql import SparkSession\n"
        "from badgeflow.session import ship_package\n"
        "spark = SparkSession.builder.master('local-cluster[1,1,1024]').config('spark.ui.enabled', 'false').getOrCreate()\n"
        "def found(rows):\n"
        "    import badgeflow.schemas as s\n"
        "    yield from rows\n"
        "    print(s)\n"
        "ship_package(spark)\n"
        "ship_package(spark)\n"
        "print('ROWS', spark.range(3).mapInArrow(found, 'id long').count())\n"
        "spark.stop()\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "ROWS 3" in done.stdout, done.stderr[-2000:]
