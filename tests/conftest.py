from __future__ import annotations

import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parents[1]))

from tidewarden.schemas import TELEMETRY_EVENT  # noqa: E402
from tidewarden.session import local_session  # noqa: E402

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_events(spark):
    """Telemetry events from short dicts; times count seconds from T0."""

    def make(*rows: dict):
        full = []
        for i, row in enumerate(rows):
            full.append(
                (
                    row.get("id", f"e{i}"),
                    row.get("source", "engine-1"),
                    row.get("type", "metric"),
                    row.get("subtype", "rpm"),
                    row.get("payload"),
                    T0 + dt.timedelta(seconds=row.get("at", i % 60)),
                    row.get("correlation_id"),
                    row.get("tags"),
                )
            )
        return spark.createDataFrame(full, TELEMETRY_EVENT)

    return make


@pytest.fixture
def metric_events(make_events):
    """Metric events of one source and metric in one minute."""

    def make(values, source="engine-1", metric="rpm", correlation_id=None):
        return make_events(
            *[
                {
                    "payload": v if isinstance(v, str) or v is None
                    else f'{{"metric": "{metric}", "value": {v}}}',
                    "source": source,
                    "correlation_id": correlation_id,
                    "subtype": metric,
                }
                for v in values
            ]
        )

    return make
