import os

import duckdb
import pytest

from lotgraph.plans import catalog

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, list | tuple):
        return [plain(v) for v in value]
    if isinstance(value, float) or type(value).__name__ == "Decimal":
        return round(float(value), 6)
    return value


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_sql(spark, name):
    with duckdb.connect() as db:
        for t in TABLES:
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
        made = db.sql(catalog.oracle_sql()[name])
        order = sorted(made.columns)
        want = sorted(repr([plain(r[made.columns.index(c)]) for c in order]) for r in made.fetchall())
    df = catalog.queries()[name](spark, FOLDER)
    assert sorted(df.columns) == order
    assert sorted(repr([plain(r[c]) for c in order]) for r in df.collect()) == want
