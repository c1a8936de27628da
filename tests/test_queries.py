"""Every query with an oracle returns what DuckDB returns, on the small tables."""

import os
import subprocess
import sys

import duckdb
import pytest

from textkiln.plans import catalogue

DATA = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations events".split()


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) else str(v)


def rows_of(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.ORACLES))
def test_query(spark, name):
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    cursor = db.execute(catalogue.ORACLES[name])
    names = [d[0] for d in cursor.description]
    df = catalogue.QUERIES[name](spark, DATA)
    assert sorted(df.columns) == sorted(names)
    assert rows_of(df.columns, df.collect()) == rows_of(names, cursor.fetchall())


def test_entry_offers_every_query():
    import __spark_entry__

    assert set(catalogue.QUERIES) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


WITHOUT = """
import importlib.abc, sys, warnings
class Missing(importlib.abc.MetaPathFinder):
    def find_spec(self, name, path, target=None):
        if name in sys.argv[1].split(","):
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Missing())
with warnings.catch_warnings(record=True) as said:
    warnings.simplefilter("always")
    import __spark_entry__ as entry
print(len([q for q in entry.queries() if q.startswith("op") or q == "pipeline"]), len(entry.queries()), sum("left out" in str(w.message) for w in said))
"""


@pytest.mark.parametrize("name", ["zstandard", "tokenizers,tiktoken,xxhash", "textkiln.llm.frames"])
def test_entry_without_a_package(name):
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if not os.path.exists(os.path.join(root, "textkiln", "llm")):
        pytest.skip("the corpus operators are not here")
    done = subprocess.run([sys.executable, "-c", WITHOUT, name], cwd=root, capture_output=True, text=True)
    if name.startswith("textkiln"):  # an error of ours is shown
        assert done.returncode and "ModuleNotFoundError" in done.stderr
    elif done.stdout.split()[0] == "0":
        assert done.stdout.split() == ["0", str(len(catalogue.QUERIES)), "1"]
    else:  # imported where it is used
        assert name != "zstandard"
