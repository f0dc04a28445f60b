"""Driver contract: entry, queries and oracle keys."""

import __spark_entry__ as E


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 75
    assert df.columns == ["n_name", "c_custkey", "c_name", "total_spend", "order_count", "rank"]


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 200


def test_query_names_are_inventory_ids():
    import re
    from lakeforge.plans import load_all
    for name in load_all():
        assert re.match(r"^(src|snk|prj|flt|cnd|jn|ag|wn|st|so|sf|dt|ar|sr|nl|up|pt|sm|dq|ud|ex)_\d\d_[a-z0-9_]+$", name), name


def test_contract_importable_without_spark():
    """The driver may read oracle_sql() before any session exists."""
    import subprocess
    import sys
    code = ("import sys; sys.path.insert(0, '.'); import __spark_entry__ as E; "
            "assert len(E.oracle_sql()) > 200 and len(E.queries()) > 200")
    root = __import__("os").path.dirname(__import__("os").path.dirname(__import__("os").path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True)


def test_no_decimal_outputs(spark):
    """Money is emitted as DOUBLE by every registered query (the oracle
    casts the same columns)."""
    from pyspark.sql import types as T
    from lakeforge.plans.registry import MONEY_COLUMNS
    from lakeforge.plans import load_all
    cheap = [n for n in load_all() if not n.startswith(("src_08", "src_09", "src_10", "sm_", "snk_08", "dq_0",
                                                          "ex_27", "ex_28", "ex_13_cdc_scd1_s", "ex_13_cdc_scd2_s", "ex_09", "ex_05", "ex_18"))]
    for name in cheap:
        df = E.queries()[name](spark, "/root/testdata/sf0.001")
        dec = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DecimalType)]
        assert not dec, (name, dec)
    assert set(MONEY_COLUMNS) <= set(E.queries())
