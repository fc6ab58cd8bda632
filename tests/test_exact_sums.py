"""Sums and scores that are the same for every partitioning."""

from __future__ import annotations

import collections
import math
import random

import pytest

from tidewarden.functions.exact_sums import exact_sums
from tidewarden.operators.detect import detect_enriched, detect_raw


def kinds():
    rng = random.Random(1)
    yield [rng.gauss(0, 1) for _ in range(400)]
    yield [rng.uniform(-1, 1) * 10 ** rng.randint(-5, 5) for _ in range(400)]
    yield [rng.choice([1e16, 1.0, -1e16]) for _ in range(300)]
    yield [rng.uniform(-1, 1) * 10.0 ** rng.randint(-300, 300) for _ in range(300)]
    yield [5e-324 * rng.randint(-9, 9) for _ in range(100)]
    yield [0.1] * 500
    yield [2.0**40, 2.0**-40, -(2.0**39) * 1.9999999999999998, -0.0]
    yield [1.7976931348623157e308, -1.7976931348623157e308, 1e-300]
    yield [math.nextafter(2.0 ** (40 * k), 0) for k in range(-20, 20)] + [2.0 ** (40 * k) for k in range(-20, 20)]


@pytest.mark.parametrize("partitions", [1, 5, 40])
def test_sums_are_exact(spark, partitions):
    rows = [(g, v) for g, values in enumerate(kinds()) for v in values]
    odd = [(100, math.nan), (100, 1.5), (101, math.inf), (101, 2.5), (102, None), (103, 0.0)]
    frame = spark.createDataFrame(rows + odd, "g int, v double").repartition(partitions)
    found = {r.g: r.s for r in exact_sums(frame, ["g"], "v", "s").collect()}
    assert found == {g: math.fsum(values) for g, values in enumerate(kinds())} | {100: 1.5, 101: 2.5, 103: 0.0}


def two_pass(values, threshold=3.0):
    """Scores above the threshold, in plain arithmetic with exact sums."""
    mean = math.fsum(values) / len(values)
    deviation = math.sqrt(math.fsum((v - mean) * (v - mean) for v in values) / len(values))
    if len(values) < 5 or deviation < 0.001:
        return []
    return [abs((v - mean) / deviation) for v in values if abs((v - mean) / deviation) > threshold]


def boundary_groups():
    """One outlier among n - 1 equal values scores sqrt(n - 1): 3 at ten events, 5 at twenty-six."""
    for n in (5, 9, 10, 11, 25, 26, 27):
        for low, high in ((0.1, 0.3), (1.0, 2.0), (1e9 + 0.1, 1e9 + 7.3), (-0.7, 1e-3), (1 / 3, 2 / 3)):
            yield [low] * (n - 1) + [high]


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(9)
    made = list(boundary_groups())
    made += [[rng.gauss(50, 5) for _ in range(60)] + [rng.choice([50, 75, 90])] for _ in range(12)]
    made += [[1.0] * 20 + [1.0 + d] for d in (0.004, 0.0048, 0.0049, 0.006)]  # deviations around 0.001
    return made


@pytest.fixture
def events(make_events, groups):
    return make_events(*[
        {"id": f"{g}/{i}", "subtype": f"m{g}", "payload": f'{{"metric": "m{g}", "value": {v!r}}}', "at": i % 60, "correlation_id": f"c{i % 3}"}
        for g, values in enumerate(groups) for i, v in enumerate(values)
    ])


def scores(frame):
    found = collections.defaultdict(list)
    for r in frame.collect():
        found[r.metric].append((r.event_id, r.score, r.severity, r.details))
    return {k: sorted(v) for k, v in found.items()}


def test_scores_are_bit_equal_for_every_partitioning(spark, events, groups):
    found = [scores(detect_raw(events.repartition(p), strategy="exact")) for p in (1, 7, 200)]
    assert found[0] == found[1] == found[2]
    wanted = {f"m{g}": sorted(two_pass(values)) for g, values in enumerate(groups)}
    assert {k: sorted(s for _, s, _, _ in v) for k, v in found[0].items()} == {k: v for k, v in wanted.items() if v}
    for hits in found[0].values():
        assert all(severity == ("CRITICAL" if score > 5.0 else "WARNING") for _, score, severity, _ in hits)


def test_enriched_scores_too(events):
    plain, exact = (scores(detect_enriched(events, context=False, strategy=s)) for s in ("salted", "exact"))
    clear = [f"m{g}" for g in range(len(list(boundary_groups())), len(exact))]
    assert {k: [h[0] for h in plain.get(k, [])] for k in clear} == {k: [h[0] for h in exact.get(k, [])] for k in clear}


def test_no_samples_have_no_hits(make_events):
    assert detect_raw(make_events({"type": "log"}), strategy="exact").count() == 0
    infinite = [{"payload": '{"metric": "m", "value": %s}' % v} for v in ["1e999"] + [1] * 30]
    assert detect_raw(make_events(*infinite), strategy="exact").count() == 0
