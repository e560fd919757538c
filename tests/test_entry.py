import importlib.util
import os

import duckdb
import pytest

from tablework.tables import TABLES
from tools.oracle_check import Frame, compare

from .conftest import SF_SMALL

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_contract(spark):
    m = _entry()
    df = m.entry(spark)
    assert df.count() > 0 and df.columns == ["word", "n"]
    q, o = m.queries(), m.oracle_sql()
    assert set(o) <= set(q) and len(q) > 150


FAST = ["word_count", "join_left", "join_full", "set_subtract", "group_lists", "kfold_slices", "leave_n_out",
        "category_index", "crosstab", "describe_col", "cogroup_lists", "stream_watermark_count",
        "graph_cc", "graph_pagerank", "ft_tf_idf", "eval_auc", "csc_layout", "scalar_time"]
if os.environ.get("TW_FULL_ORACLE"):
    FAST = None


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", FAST or sorted(_entry().oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    m = _entry()
    sq = m.queries()[name](spark, SF_SMALL)
    s = Frame(sq.columns, [r.asDict(recursive=True) for r in sq.collect()])
    cur = duck.execute(m.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    d = Frame(cols, [dict(zip(cols, t)) for t in cur.fetchall()])
    assert compare(name, s, d) is None
