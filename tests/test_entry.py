import subprocess
import sys
from pathlib import Path

import __spark_entry__ as entry

ROOT = Path(entry.__file__).parent


def test_core_imports_without_optional_part():
    assert subprocess.run([sys.executable, "-c", "import atlasmill.plans.general, atlasmill.plans.places, sys; assert not any(m.startswith('atlasmill.llm') for m in sys.modules)"], cwd=ROOT).returncode == 0


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "stable_id" in df.columns
