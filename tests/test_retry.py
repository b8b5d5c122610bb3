import subprocess
import sys
from pathlib import Path


def test_export_survives_task_retry(tmp_path):
    """A failed-and-retried map task must not duplicate or lose rows."""
    job = Path(__file__).with_name("retry_job.py")
    proc = subprocess.run(
        [sys.executable, str(job), str(tmp_path / "out")], capture_output=True, text=True, timeout=600
    )
    line = [x for x in proc.stdout.splitlines() if x.startswith("RESULT")]
    assert line, proc.stderr[-3000:]
    fields = dict(kv.split("=") for kv in line[0].split()[1:])
    assert int(fields["rows"]) == 20000
    assert int(fields["hot"]) == 6667
    # every tuple is above 1,000 rows here, so all 8 are split
    assert int(fields["hot_tuples"]) == 8
    assert int(fields["files"]) > 8
    assert fields["failed_once"] == "True"
