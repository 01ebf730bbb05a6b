"""Plan checks: pushdown and pruning reach the scan, native operators stay
JVM-side, no Cartesian products."""
import __spark_entry__ as entry

from conftest import SMOKE


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_pruned_scan_and_pushed_filter(spark):
    df = entry.queries()["xml_topics"](spark, SMOKE)
    from quarry.sources.tables import table
    from pyspark.sql import functions as F
    en = table(spark, SMOKE, "documents", "doc_id", "text", "lang").where(F.col("lang") == "en")
    p = _plan(en.select("doc_id", "text"))
    assert "PushedFilters: [IsNotNull(lang), EqualTo(lang,en)]" in p
    assert "ReadSchema: struct<doc_id:bigint,text:string,lang:string>" in p
    assert df is not None


def test_native_queries_have_no_python_and_no_cartesian(spark):
    qs = entry.queries()
    for name in ["cooccurrence_chisq", "match_weights", "zone_lookup", "idle_within_shift",
                 "bday_fill", "user_auc", "tfidf", "triangles"]:
        p = _plan(qs[name](spark, SMOKE))
        assert "CartesianProduct" not in p, name
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_entry_module_imports_without_a_session():
    """The driver may import the contract before creating a session."""
    import subprocess
    import sys
    code = ("import __spark_entry__ as e; from pyspark import SparkContext; "
            "assert SparkContext._active_spark_context is None; "
            "print(len(e.queries()), len(e.oracle_sql()))")
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120,
                         cwd=__import__("os").path.dirname(__import__("os").path.dirname(__file__)))
    assert out.returncode == 0, out.stderr[-500:]
    n_q, n_o = map(int, out.stdout.split())
    assert n_q >= n_o > 0
