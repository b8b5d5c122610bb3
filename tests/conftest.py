import datetime as dt
import sys
from decimal import Decimal
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import types as T  # noqa: E402

from partwright.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = build_session(
        "local[4]",
        app_name="partwright-tests",
        shuffle_partitions=8,
        conf={"spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse"))},
    )
    s.sparkContext.setLogLevel("ERROR")
    # Tests set their own shared folder only when the session has none.
    if not s.sparkContext.getCheckpointDir():
        s.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("ckpt")))
    yield s


SMALL_SCHEMA = T.StructType(
    [
        T.StructField("terr_cd", T.StringType(), True),
        T.StructField("store_id", T.StringType(), True),
        T.StructField("extract_date", T.DateType(), True),
        T.StructField("order_id", T.StringType(), True),
        T.StructField("total_amt", T.DecimalType(18, 2), True),
    ]
)

D1 = dt.date(2026, 3, 1)
D2 = dt.date(2026, 3, 2)


def rows_for(keys, date, n_per_key=3, start=0):
    out = []
    i = start
    for terr, store in keys:
        for _ in range(n_per_key):
            out.append((terr, store, date, f"o{i}", Decimal(i) / Decimal(100) + Decimal("1.00")))
            i += 1
    return out


@pytest.fixture
def small_frame(spark):
    def make(rows, num_partitions=None):
        df = spark.createDataFrame(rows, SMALL_SCHEMA)
        return df.repartition(num_partitions) if num_partitions else df
    return make


def parquet_files(path):
    root = Path(str(path).replace("file:", ""))
    return sorted(p for p in root.rglob("*.parquet"))


def sorted_rows(df, cols=None):
    cols = cols or df.columns
    return sorted(tuple(r) for r in df.select(*cols).collect())
