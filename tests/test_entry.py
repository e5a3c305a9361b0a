import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).parents[1]


def test_registry():
    sys.path.insert(0, str(ROOT))
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())
    assert {"cosine_topk", "chunk_pack", "kg_edges"} <= set(e.queries())


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no tables")
def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["query_id", "rank", "doc_id", "score"] and e.entry(spark).count() > 0


def test_without_the_subpackage(tmp_path):
    """The entry module imports where the subpackage and the pipeline are gone, and nothing else needs them."""
    package = tmp_path / "siltstone"
    for f in (ROOT / "siltstone").rglob("*.py"):
        if "llm" not in f.parts:
            to = package / f.relative_to(ROOT / "siltstone")
            to.parent.mkdir(parents=True, exist_ok=True)
            to.write_text(f.read_text())
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not any(n.startswith('op') and n[2:3].isdigit() or n == 'pipeline' for n in q); e.oracle_sql()"
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)


def test_broken_subpackage_is_not_hidden(tmp_path):
    """The guard is for a subpackage that is gone, not for one that fails."""
    for f in (ROOT / "siltstone").rglob("*.py"):
        to = tmp_path / "siltstone" / f.relative_to(ROOT / "siltstone")
        to.parent.mkdir(parents=True, exist_ok=True)
        to.write_text(f.read_text())
    (tmp_path / "siltstone/llm").mkdir(exist_ok=True)
    (tmp_path / "siltstone/llm/__init__.py").write_text("")
    (tmp_path / "siltstone/llm/queries.py").write_text("import no_such_module")
    (tmp_path / "__spark_entry__.py").write_text((ROOT / "__spark_entry__.py").read_text())
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", "import __spark_entry__"], cwd=tmp_path, env=env, capture_output=True, text=True)
    assert done.returncode and "no_such_module" in done.stderr


def test_nothing_else_imports_the_subpackage():
    for f in (ROOT / "siltstone").rglob("*.py"):
        if "llm" not in f.parts:
            assert "siltstone.llm" not in f.read_text(), f
