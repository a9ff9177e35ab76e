"""One listing, place and price holding a third of the rows, against plain Python."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from listing_data import FIRST, first, rates
from rentgrid.config import ListingRules
from rentgrid.operators import metrics
from rentgrid.plans.marts import build_fact, build_place_dim, ratio_thresholds, usable_listings
from rentgrid.plans.staging import stage_single_price
from rentgrid.sources.rates import typed_rates
from rentgrid.sources.workspace import Workspace


def interpolated(values, p):
    values = sorted(values)
    pos = p * (len(values) - 1)
    lo, hi = values[math.floor(pos)], values[math.ceil(pos)]
    return lo + (hi - lo) * (pos - math.floor(pos))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(7)
    out = [{"id": "hot", "precio": "500000", "comuna": "centro"}] * 400  # one listing, 400 copies
    out += [
        {
            "id": f"A-{i}", "precio": str(rng.randrange(300_000, 900_000)),
            "superficie_m2": str(rng.choice([20, 33.5, 61, 80, 999, 5])),
            "comuna": "centro" if i % 2 else f"lugar {i % 17}",  # half of them in one place
            "contact_type": rng.choice(["agency", "owner_direct", None]),
        }
        for i in range(800)
    ]
    # and a price that a third of them share
    return [{**r, "precio": "444444"} if i % 3 == 0 and r["id"] != "hot" else r for i, r in enumerate(out)]


@pytest.mark.parametrize("broadcast_limit", ["10MB", "-1"])
def test_hot_groups(spark, rows, broadcast_limit):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast_limit)
    try:
        workspace = Workspace(spark)
        day_rates = workspace.keep(typed_rates(rates(spark)), "r")
        staged = workspace.keep(
            stage_single_price(first(spark, *rows), day_rates, FIRST, ListingRules()), "s"
        )
        assert staged.count() == 801
        places = workspace.keep(build_place_dim(staged), "p")
        limits = workspace.keep(ratio_thresholds(usable_listings(staged)), "u")
        fact = workspace.keep(build_fact(staged, limits, places, day_rates), "f")

        ratios = {
            r["id"]: int(r["precio"]) / float(r.get("superficie_m2", "50"))
            for r in rows if r.get("superficie_m2", "50") not in ("999", "5")
        }
        limit = interpolated(ratios.values(), 0.99)
        want = {i for i, ratio in ratios.items() if ratio <= limit}
        assert {r.id for r in fact.select("id").collect()} == want
        assert fact.count() == len(want)

        place_of = {r["id"]: r["comuna"].title() for r in rows}
        owners = Counter(
            place_of[r["id"]] for r in rows
            if r["id"] in want and r.get("contact_type") == "owner_direct"
        )
        top = metrics.top_listings_to_contact(fact, workspace.keep(metrics.place_figures(fact), "figures"), places, k=3).groupBy("comuna").count()
        assert dict(map(tuple, top.collect())) == {c: min(3, n) for c, n in owners.items()}

        middle = metrics.price_per_m2_by_month(fact).first().precio_m2_mediano
        assert middle == pytest.approx(interpolated([ratios[i] for i in want], 0.5), abs=1e-4)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_place_with_every_name_in_one_prefix(spark):
    names = [f"Santa {i:03d}" for i in range(120)]
    staged = spark.createDataFrame([(n, "RM") for n in names * 3], "comuna string, region string")
    got = build_place_dim(staged).agg(
        F.count("*"), F.min("comuna_id"), F.max("comuna_id"), F.count_distinct("comuna_id")
    )
    assert tuple(got.first()) == (120, 1, 120, 120)


def test_ranks_share_places_and_spread_over_tasks(spark):
    from rentgrid.operators.keys import ranked

    rows = [("a", 5.0), ("b", 7.0), ("c", 5.0), ("d", None), ("e", 1.0)]
    got = ranked(spark.createDataFrame(rows, "k string, v double"), "puesto", "v").collect()
    assert {r.k: r.puesto for r in got} == {"b": 1, "a": 2, "c": 2, "e": 4, "d": 5}
