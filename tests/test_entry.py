"""The rest imports, registers its queries and runs where the corpus operators are gone."""

import shutil
import subprocess
import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parents[1]
SAY = "import __spark_entry__ as e; q = e.queries(); e.oracle_sql(); print(len(q), any(k.startswith('op') for k in q), 'pipeline' in q)"


@pytest.mark.parametrize("with_pipeline", [True, False])
def test_without_the_corpus_operators(tmp_path, with_pipeline):
    shutil.copytree(HERE / "vaultflow", tmp_path / "vaultflow", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(HERE / "__spark_entry__.py", tmp_path)
    if with_pipeline and (HERE / "corpus_pipeline.py").exists():
        shutil.copy(HERE / "corpus_pipeline.py", tmp_path)
    out = subprocess.run([sys.executable, "-c", SAY], cwd=tmp_path, env={"PATH": "/usr/bin:/bin"}, capture_output=True, text=True, timeout=120)
    n, *rest = out.stdout.split() or [0]
    assert int(n) > 150 and rest == ["False", "False"], out.stderr
