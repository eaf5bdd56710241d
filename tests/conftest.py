import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from lodestream.session import local_session

    return local_session(4, "4g", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def hard_tables(spark, tmp_path_factory):
    """(void, empty, hard): folders of all tables without rows, of the domain tables without
    rows, and with hard ones: all columns null, repeated rows, and extra columns whose names
    operators use themselves."""
    from pyspark.sql import functions as F

    void, empty, hard = (tmp_path_factory.mktemp(x) for x in ("void", "empty", "hard"))
    extra = ["value", "field", "n", "key", "part", "grp", "class_id", "items", "u", "c", "seen", "feed", "utc_ms", "source_", "at_ms", "text_", "ids", "year_min", "kind", "token", "tokens", "body", "sender", "parent", "batch", "__zone"]
    for path in sorted(Path(SF).glob("*.parquet")):
        df = spark.read.parquet(str(path))
        small = path.stem in ("reference_entries", "budget_units", "placeholder_values", "token_limits")
        df.limit(0).write.parquet(f"{void}/{path.name}")
        (df if small else df.limit(0)).write.parquet(f"{empty}/{path.name}")
        nulls = spark.createDataFrame([tuple(None for _ in df.columns)] * 2, df.schema)
        rows = df if small else df.limit(40)
        rows = rows.unionByName(df.limit(5)).unionByName(nulls) if not small else rows
        rows = rows.withColumns({x: F.lit("clash") for x in extra if x not in df.columns})
        rows.write.parquet(f"{hard}/{path.name}")
    return str(void), str(empty), str(hard)
