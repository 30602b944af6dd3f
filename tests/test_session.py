import os
import subprocess
import sys
import textwrap


def test_scratch_paths_live_under_the_configured_checkpoint_dir(tmp_path):
    """With spark.checkpoint.dir set (as a cluster would), every scratch path and
    checkpoint goes there; no private temporary folder is created."""
    shared = tmp_path / "shared"
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {os.path.dirname(os.path.dirname(os.path.abspath(__file__)))!r})
        from pyspark.sql import SparkSession
        from tidewater.session import scratch_path
        from tidewater.functions.indexing import with_row_index
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.checkpoint.dir", {str(shared)!r}).getOrCreate())
        p = scratch_path(spark, "x")
        with_row_index(spark.range(10), "ix", ["id"]).count()
        print("PATH", p)
        print("CKPT", spark.sparkContext.getCheckpointDir())
    """)
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=600)
    lines = dict(line.split(" ", 1) for line in out.stdout.splitlines() if line[:4] in ("PATH", "CKPT"))
    assert lines["PATH"].startswith(str(shared)), out.stderr[-1500:]
    assert str(shared) in lines["CKPT"]
    assert any(os.scandir(shared))
