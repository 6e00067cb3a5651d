import shutil
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).parents[1]


def test_entry_stands_without_the_subpackage(tmp_path):
    shutil.copytree(ROOT / "entwine", tmp_path / "entwine", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'candidates_topk' in q and not any(k.startswith('op') for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, timeout=120)
