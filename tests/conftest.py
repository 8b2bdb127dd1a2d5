import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from curbline.schema import TRIP_SCHEMA  # noqa: E402
from curbline.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__maxMetadataStringLength="1000",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


# one ordinary trip; tests change the fields they are about
ORDINARY = {
    "VendorID": 1,
    "tpep_pickup_datetime": datetime(2015, 1, 5, 10, 0, 0),
    "tpep_dropoff_datetime": datetime(2015, 1, 5, 10, 15, 0),
    "passenger_count": 1,
    "trip_distance": 2.5,
    "pickup_longitude": -73.98,
    "pickup_latitude": 40.75,
    "RateCodeID": 1,
    "store_and_fwd_flag": "N",
    "dropoff_longitude": -73.97,
    "dropoff_latitude": 40.76,
    "payment_type": 1,
    "fare_amount": 12.0,
    "extra": 0.5,
    "mta_tax": 0.5,
    "tip_amount": 2.0,
    "tolls_amount": 0.0,
    "improvement_surcharge": 0.3,
    "total_amount": 15.3,
}


def trip(**changes) -> dict:
    return {**ORDINARY, **changes}


@pytest.fixture(scope="session")
def raw(spark):
    """Builds a raw trip frame from dicts of fields."""

    def build(rows):
        return spark.createDataFrame([tuple(r[f] for f in TRIP_SCHEMA.names) for r in rows], TRIP_SCHEMA)

    return build


@pytest.fixture(scope="session")
def small_trips(spark):
    """Cleaned trips of the smallest test tables, computed once."""
    from curbline.session import settled
    from driver_tables.trips_view import trips

    return settled(trips(spark, SF_SMALL))


def rows(df):
    return [tuple(r) for r in df.collect()]
