import sys
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import types as T

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lendscope.plans.scoring import risk_scores  # noqa: E402
from lendscope.session import local_session  # noqa: E402
from lendscope.sources.schemas import SCHEMAS  # noqa: E402
from lendscope.sources.tables import Book  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="6g")
    yield session
    session.stop()


def make_table(spark, name, rows):
    """Rows given as dicts, in the declared schema of a domain table; a missing column is NULL."""
    schema = T.StructType([T.StructField(field.name, field.dataType) for field in SCHEMAS[name].fields])

    def value(field, row):
        found = row.get(field.name)
        if found is not None and isinstance(field.dataType, T.DecimalType):
            return Decimal(str(found))
        return found

    return spark.createDataFrame([tuple(value(field, row) for field in schema.fields) for row in rows], schema)


@pytest.fixture
def make_book(spark):
    """A book from ``name=[row, ...]``; tables that are not given are empty."""

    def make(**tables):
        loaders = {name: (lambda _, name=name: make_table(spark, name, tables.get(name, []))) for name in SCHEMAS}
        return Book(spark, loaders | {"risk_scores": risk_scores})

    return make


@pytest.fixture
def rows():
    def collect(df, key=None):
        found = [row.asDict(recursive=True) for row in df.collect()]
        return sorted(found, key=lambda row: row[key]) if key else found

    return collect
