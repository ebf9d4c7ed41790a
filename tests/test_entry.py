import os
import subprocess
import sys

HERE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_entry_imports_without_a_session():
    code = "import __spark_entry__ as e; q, o = e.queries(), e.oracle_sql(); assert set(o) <= set(q) and len(q) > 80; print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], cwd=HERE, capture_output=True, text=True)
    assert out.returncode == 0, out.stderr


def test_nothing_outside_imports_the_subpackage():
    for root, _, files in os.walk(os.path.join(HERE, "scriptorium")):
        if os.path.basename(root) == "llm":
            continue
        for f in files:
            if f.endswith(".py"):
                assert ".llm" not in open(os.path.join(root, f), encoding="utf8").read()


def test_flagship(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
