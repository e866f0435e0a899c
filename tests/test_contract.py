import subprocess
import sys
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_registry_imports_without_session():
    code = ("import __spark_entry__ as e; q = e.queries(); s = e.oracle_sql(); "
            "assert set(s) <= set(q); assert len(q) >= 70; print(len(q))")
    out = subprocess.run([sys.executable, "-c", code], cwd=ROOT, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]


def test_entry_smoke(spark):
    import __spark_entry__ as e
    df = e.entry(spark)
    assert df.count() > 0
    assert {"dataset", "year", "month", "trip_count", "total_amount_sum"} <= set(df.columns)
