"""Run by test_cluster: queries on executors in processes of their own, against their
SQL. Arguments: a new folder, names of queries."""

import os
import sys
from datetime import datetime, timedelta

import pyarrow as pa
import pyarrow.parquet as pq

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from frameweir.plans.inputs import BATCH, PERIOD, STRIDE  # noqa: E402
from frameweir.session import build_session  # noqa: E402
from tools.check import compare  # noqa: E402


def events(batches):
    """The rows whose records arrive in the first `batches` batches."""
    ids = [i for i in range(1, 1500) if i * STRIDE % PERIOD < batches * BATCH]
    return pa.table(
        {
            "event_id": ids,
            "ts": pa.array([datetime(2024, 1, 1) + timedelta(minutes=7 * i) for i in ids], pa.timestamp("us")),
            "user_id": [i % 7 for i in ids],
            "event_type": ["view"] * len(ids),
            "value": [0.5] * len(ids),
            "props": ['{"a": 1}'] * len(ids),
        }
    )


if __name__ == "__main__":
    folder, *names = sys.argv[1:]
    for batches in (2, 10):
        os.makedirs(f"{folder}/tables{batches}")
        pq.write_table(events(batches), f"{folder}/tables{batches}/events.parquet")
    conf = {
        "spark__ui__enabled": "false",
        "spark__driver__host": "127.0.0.1",
        "spark__sql__shuffle__partitions": "4",
        "spark__executor__memory": "1g",
        "spark__sql__warehouse__dir": f"{folder}/warehouse",
        "spark__checkpoint__dir": f"{folder}/shared",
    }
    spark = build_session("cluster", "local-cluster[2,2,1024]", **conf)
    spark.sparkContext.setLogLevel("OFF")
    spark.sparkContext.master = "spark://cluster:7077"  # as frameweir sees it, no longer a local one
    for name in names:
        try:
            # The reads of `offset_reads` end at a micro-batch that two batches don't reach.
            outcome = compare(spark, f"{folder}/tables{10 if name == 'offset_reads' else 2}", name)
        except Exception as failure:  # shown, so that the other queries still run
            outcome = f"BAD {type(failure).__name__} {str(failure)[:500]}"
        print(name, outcome, flush=True)
