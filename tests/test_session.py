import subprocess
import sys

from helpers import ROOT

from logsync.session import run_folder, shared_folder, sized_settings


def test_sizes():
    small = sized_settings(1 << 20, cores=8)
    assert small["spark.sql.shuffle.partitions"] == "24"
    large = sized_settings(100 << 40, cores=4000)
    assert int(large["spark.sql.shuffle.partitions"]) == (100 << 40) // (128 << 20)


def test_run_folders_are_new_and_below_the_shared_one(spark):
    one, two = run_folder(spark, "x"), run_folder(spark, "x")
    assert one != two and one.startswith(shared_folder(spark))


def test_python_filters_do_not_need_the_package_on_workers(tmp_path):
    """Workers unpickle user filters; the driver's folder may differ."""
    code = f"""
import sys
sys.path.insert(0, {str(ROOT)!r})
from logsync.session import local_session
from logsync.operators import filter_messages, opaque_filter
spark = local_session(2)
log = spark.createDataFrame([(b"a",), (b"b",)], "value binary")
print("kept", filter_messages(log, {{"f": opaque_filter(lambda v: v == b"a")}}).count())
"""
    result = subprocess.run(
        [sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, timeout=180
    )
    assert "kept 1" in result.stdout, result.stderr[-2000:]
