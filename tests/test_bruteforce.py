"""Operators against a plain-Python statement of the same rules, on seeded
random inputs with a hot phone, a hot tower, unknown towers, towers with
several cities, colliding glued keys and quoted cities."""

import itertools
import contextlib
import random

import pytest

from conftest import no_broadcast, rows
from tracelake.operators import daily_itineraries, itineraries, lookup_batch

CITIES = ["Alpha", '"Beta"', "Gamma", '"Delta', "x", "", '""', "Zeta"]


def make_inputs(seed=7, n_logs=3000):
    rnd = random.Random(seed)
    towers = [(str(a), str(b)) for a in range(1, 13) for b in range(1, 13)]
    cells = []
    for lac, cell in towers:
        if rnd.random() < 0.15:
            continue  # unknown tower
        for _ in range(1 + (rnd.random() < 0.2)):  # some towers get two cities
            cells.append((lac, cell, rnd.choice(CITIES)))
    cells += cells[:5]  # duplicate directory rows
    logs = []
    for i in range(n_logs):
        phone = "13800000000" if i % 3 == 0 else f"1390000{rnd.randrange(200):04d}"
        lac, cell = ("1", "1") if i % 4 == 0 else rnd.choice(towers)
        day = f"2024-01-{rnd.randrange(1, 29):02d}"
        logs.append((lac, cell, phone, f"{day} {rnd.randrange(24):02d}:00:00"))
    return logs, cells


def clean(c, strip):
    if strip == "none":
        return c
    if strip == "ends":
        return c[1:-1] if len(c) > 2 else ""
    return c[1:-1] if len(c) >= 2 and c[0] == '"' and c[-1] == '"' else c


def reference(logs, cells, group, key, unmatched, cells_mode, strip, dedupe):
    def tkey(lac, cell):
        return lac + cell if key == "concat" else (lac, cell)

    by_tower = {}
    if cells_mode == "one":
        best = {}
        for lac, cell, city in cells:
            k = (lac, cell)
            best[k] = max(best.get(k, city), city)
        items = [(k[0], k[1], v) for k, v in best.items()]
    else:
        items = cells
    for lac, cell, city in items:
        by_tower.setdefault(tkey(lac, cell), set()).add(city)
    out = {}
    for lac, cell, phone, ts in logs:
        g = (phone, ts[:10]) if group == "daily" else phone
        found = by_tower.get(tkey(lac, cell))
        if not found:
            if unmatched == "drop":
                continue
            out.setdefault(g, set()).add(None)
            continue
        for city in found:
            out.setdefault(g, set()).add(city)
    result = {}
    for g, raw in out.items():
        if dedupe == "cleaned":
            vals = sorted({"null" if c is None else clean(c, strip) for c in raw})
        else:
            vals = sorted("null" if c is None else clean(c, strip) for c in raw)
        result[g] = ",".join(vals)
    return result


@pytest.fixture(scope="module")
def inputs(spark):
    logs, cells = make_inputs()
    ldf = spark.createDataFrame(logs, "lac string, cell string, phone string, ts string")
    cdf = spark.createDataFrame(cells, "lac string, cell string, city string")
    return logs, cells, ldf, cdf


COMBOS = list(itertools.product(["columns", "concat"], ["drop", "null_text"], ["all", "one"],
                                ["quotes", "ends", "none"], ["cleaned", "raw"]))
# Every combination for the overall itinerary would be 48 Spark runs; a
# fixed sample of 12 covers each option value several times.
SAMPLE = random.Random(3).sample(COMBOS, 12)


@pytest.mark.parametrize("key,unmatched,cells_mode,strip,dedupe", SAMPLE)
def test_itineraries_brute_force(inputs, key, unmatched, cells_mode, strip, dedupe):
    logs, cells, ldf, cdf = inputs
    got = {r.phone: r.itinerary for r in itineraries(
        ldf, cdf, key=key, unmatched=unmatched, cells_mode=cells_mode, strip=strip,
        dedupe=dedupe).collect()}
    assert got == reference(logs, cells, "overall", key, unmatched, cells_mode, strip, dedupe)


@pytest.mark.parametrize("broadcast", [True, False])
def test_daily_brute_force(spark, inputs, broadcast):
    logs, cells, ldf, cdf = inputs
    with contextlib.nullcontext() if broadcast else no_broadcast(spark):
        got = {(r.phone, r.day): r.itinerary for r in daily_itineraries(ldf, cdf).collect()}
    assert got == reference(logs, cells, "daily", "columns", "null_text", "one", "quotes", "cleaned")


def test_lookup_brute_force(spark, inputs):
    logs, cells, ldf, cdf = inputs
    daily = reference(logs, cells, "daily", "columns", "null_text", "one", "quotes", "cleaned")
    rnd = random.Random(11)
    phones = sorted({p for p, _ in daily})
    reqs = []
    for i in range(300):
        phone = "13800000000" if i % 3 == 0 else rnd.choice(phones + ["13999999999"])
        a, b = sorted(rnd.sample(range(1, 29), 2))
        if i % 10 == 0:
            a, b = b, a  # start after end
        reqs.append((i, phone, f"2024-01-{a:02d}", f"2024-01-{b:02d}"))
    rdf = spark.createDataFrame(reqs, "request_id long, phone string, start string, end string")
    ddf = spark.createDataFrame([(p, d, it) for (p, d), it in daily.items()],
                                "phone string, day string, itinerary string")
    for broadcast in (True, False):
        with contextlib.nullcontext() if broadcast else no_broadcast(spark):
            got = {r.request_id: (r.visited, r.found) for r in lookup_batch(ddf, rdf).collect()}
        for rid, phone, start, end in reqs:
            cities = set()
            for (p, d), it in daily.items():
                if p == phone and start <= d <= end:
                    cities.update(it.split(","))
            assert got[rid] == (",".join(sorted(cities)), bool(cities)), rid
