import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from loomweave.session import DEFAULT_CONF, checkpoint_dir, configure

    builder = SparkSession.builder.master("local[4]").appName("loomweave-tests")
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    builder = builder.config("spark.sql.shuffle.partitions", "8")
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    configure(session)
    checkpoint_dir(session)   # reads spark.checkpoint.dir; a private folder only when unset
    yield session
    session.stop()


def rows(df, *cols):
    return [tuple(r[c] for c in cols) if cols else tuple(r) for r in df.collect()]
