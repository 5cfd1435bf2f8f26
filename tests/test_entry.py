"""The entry module where the training-data operators cannot be imported."""

import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parents[1]


def test_other_queries_survive_a_missing_module():
    """Without the tokenizers' module the operators that need it are left out, and nothing else."""
    code = (
        "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; from workload.queries import REGISTRY; "
        "from workload.oracles import ORACLES; assert set(e.queries()) >= set(REGISTRY) and 'pipeline' not in e.queries(); "
        "assert e.oracle_sql() == ORACLES"
    )
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True, timeout=120)
