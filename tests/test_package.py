"""The package on executors that cannot see the repository."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
JOB = '''
import sys
sys.path.insert(0, {repo!r})
import os
from searchshift.session import build_session
from searchshift.sinks.copy import copy_files
from searchshift.sources import schema
spark = build_session("elsewhere", "local[2]", **{{"spark.sql.shuffle.partitions": "2", "spark.ui.showConsoleProgress": "false"}})
spark.sparkContext.setLogLevel("ERROR")
documents = spark.createDataFrame([("b", "<schema><field name='a' type='t'/></schema>")], "backup_id string, content string")
assert schema.schema_fields(schema.schema_declarations(documents)).count() == 1
with open("source", "w") as f:
    f.write("text")
files = spark.createDataFrame([(os.path.abspath("source"), os.path.abspath("target"), 4)], "path string, target string, length bigint")
assert copy_files(files).first()["ok"]
print("DONE")
'''


def test_runs_outside_the_repository(tmp_path):
    """Started in an empty folder without a search path: only what was shipped can be imported."""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", JOB.format(repo=REPO)], cwd=tmp_path, env=env, timeout=300,
                         capture_output=True, text=True)
    assert "DONE" in run.stdout, run.stderr[-3000:]
