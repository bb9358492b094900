"""Hot keys and random inputs against brute force in plain Python."""

from __future__ import annotations

import statistics
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gondola.operators import facts, marts
from gondola.operators.silver import project
from gondola.plans.sinks import upsert_frames

DAY = date(2026, 1, 1)
STORES = {("1", str(s)): f"AR-{'ABC'[s % 3]}" for s in range(30)} | {("2", str(s)): "AR-A" for s in range(30)}


@pytest.fixture(scope="module")
def rows():
    """A third of all rows are copies of one key, another third one product on one day."""
    out, start = [], datetime(2026, 1, 1)
    for i in range(900):
        if i % 3 == 0:
            key = ("1", "0", "hot")
        elif i % 3 == 1:
            key = ("1" if i % 2 else "2", str(i % 30), "hot")
        else:
            key = ("1" if i % 4 else "2", str(i % 29), f"p{i % 40}")
        out.append((*key, round(10 + (i * 7919 % 5000) / 100, 2), start + timedelta(minutes=i % 450)))
    return out


@pytest.fixture(scope="module")
def precios(spark, rows):
    df = spark.createDataFrame(
        rows, "id_comercio string, id_sucursal string, id_producto string, precio_lista double, scraped_at timestamp_ntz"
    )
    df = df.withColumns({"fecha_vigencia": F.lit(DAY), "id_bandera": F.lit("1"), "descripcion": F.lit("LECHE")})
    return project(df, "precios").repartition(7)


@pytest.fixture(scope="module")
def newest(rows):
    best = {}
    for c, s, p, price, when in rows:
        rank = (when, -price)
        if (c, s, p) not in best or rank > best[(c, s, p)][0]:
            best[(c, s, p)] = (rank, price)
    return {key: price for key, (_, price) in best.items()}


def test_quotes(precios, newest):
    found = {(r.id_comercio, r.id_sucursal, r.id_producto): r.precio_lista for r in facts.price_quotes(precios).collect()}
    assert found == newest


def test_series(spark, precios, newest):
    stores = spark.createDataFrame(
        [(c, s, prov) for (c, s), prov in STORES.items()], "id_comercio string, id_sucursal string, provincia string"
    )
    groups, sold_in = defaultdict(list), defaultdict(set)
    for (c, s, p), price in newest.items():
        groups[(p, STORES[(c, s)])].append(price)
        sold_in[(p, STORES[(c, s)])].add(s)
    found = {
        (r.id_producto, r.provincia): r for r in marts.price_timeseries(facts.price_quotes(precios), stores).collect()
    }
    assert set(found) == set(groups)
    for key, prices in groups.items():
        r = found[key]
        assert (r.num_observaciones, r.precio_min, r.precio_max) == (len(prices), min(prices), max(prices))
        assert r.precio_mediana == pytest.approx(statistics.median(prices))
        assert r.precio_promedio == pytest.approx(statistics.fmean(prices))
        assert r.num_sucursales == len(sold_in[key])


def test_pairs(spark, precios, rows):
    merchants = spark.createDataFrame(
        [("1", "1", "Uno"), ("2", "1", "Dos")], "id_comercio string, id_bandera string, bandera_nombre string"
    )
    products = spark.createDataFrame([], "id_producto string, descripcion string, marca string")
    per_chain = defaultdict(list)
    for c, _, p, price, _ in rows:
        per_chain[(p, c)].append(price)
    both = {p for p, c in per_chain if all(len(per_chain.get((p, x), ())) >= 3 for x in "12")}
    found = marts.cross_price_pairs(precios, products, merchants).collect()
    assert {r.id_producto for r in found} == both and len(found) == len(both)
    for r in found:
        a, b = (statistics.fmean(per_chain[(r.id_producto, c)]) for c in "21")
        assert r.diferencia_pct == pytest.approx((b - a) / a * 100)


ROW = st.tuples(st.integers(1, 3), st.sampled_from(["A", "B", None]), st.integers(0, 9))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(target=st.lists(ROW, max_size=8), batch=st.lists(ROW, max_size=8))
def test_upsert_is_delete_and_insert(spark, target, batch):
    def frame(data):
        return spark.createDataFrame(data, "d int, provincia string, n int")

    found = upsert_frames(frame(target), frame(batch), ["d", "provincia"]).collect()
    replaced = {r[:2] for r in batch}
    expected = [r for r in target if r[:2] not in replaced] + batch
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, expected))
