"""Probes at few places: what they look up is reduced to the last values before each place, and the result stays the same."""

import random

from pyspark.sql import functions as F

from packetloom.operators import lookups

STATES = "k string, arrival_seq long, a string, b long"


def tables(spark, places):
    draw = random.Random(3)
    states = [(f"k{n % 7}", n, f"a{n}" if draw.random() < 0.5 else None, n if draw.random() < 0.3 else None) for n in range(1, 400)]
    states += [("k1", None, "first", -1), ("k9", None, "alone", None)]
    probes = [(f"k{n % 10}", draw.choice(places), n, f"p{n}") for n in range(200)]
    return spark.createDataFrame(probes, "k string, arrival_seq long, rec_idx int, name string"), spark.createDataFrame(states, STATES)


def looked_up(probes, states, limit, writers=None):
    found = lookups._asof(probes, states, ["k"], ["a", "b"], limit, writers)
    return sorted(map(repr, found.select("k", "arrival_seq", "rec_idx", "name", "a", "b").collect()))


def test_the_last_values_before_each_place_are_enough(spark, monkeypatch):
    rows = []
    search = lookups.find_hot_keys

    def counted(places, keys, order, limit, total=None):
        rows.append(total)
        return search(places, keys, order, limit, total)

    monkeypatch.setattr(lookups, "find_hot_keys", counted)
    for places in ([2**62], [0], [10, 11, 200, 2**62]):
        probes, states = tables(spark, places)
        want = looked_up(probes, states, None)
        rows.clear()
        assert looked_up(probes, states, 2, states.select("k", "arrival_seq")) == want
        assert rows[0] <= probes.count() + 9 * len(places)  # and not all states
    monkeypatch.setattr(lookups, "PLACES", 3)
    probes, states = tables(spark, [10, 11, 200, 2**62])
    assert lookups._few_places(probes) is None
    assert looked_up(probes, states, 2) == looked_up(probes, states, None)
    assert looked_up(probes.limit(0), states, 2) == []
    assert lookups._few_places(probes.withColumn("arrival_seq", F.lit(None).cast("long"))) is None
