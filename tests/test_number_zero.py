"""An event numbered 0 gives an order without a number: it is in no ledger and no level, as in the SQL."""

import duckdb
import pytest
from pyspark.sql import functions as F
from test_queries import plain

from bookweave import queries as q


@pytest.fixture(scope="module")
def zero(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("zero"))
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    first = F.col("event_id") == 0
    events.withColumns({"event_type": F.when(first, "view").otherwise(F.col("event_type")), "user_id": F.when(first, 20).otherwise(F.col("user_id"))}).coalesce(1).write.parquet(f"{root}/events.parquet")
    return root


@pytest.mark.parametrize("name", ["reference_faults", "lenient_faults", "level_totals", "first_faults", "first_fault_of_run", "never_crossing"])
def test_same_rows_as_sql(spark, zero, name):
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM '{zero}/events.parquet/*.parquet'")
    cur = duck.execute(q.oracle_sql()[name])
    have = [d[0] for d in cur.description]
    want = sorted((tuple(plain(v) for v in r) for r in cur.fetchall()), key=repr)
    assert want and sorted((tuple(plain(r[c]) for c in have) for r in q.queries()[name](spark, zero).collect()), key=repr) == want
