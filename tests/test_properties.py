"""Properties on random frames, against plain Python and numpy."""

import datetime as dt
import random
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyward.functions.numbers import money_mean, money_sum
from tallyward.operators import duplicates, profile
from tallyward.operators.histogram import histogram
from tallyward.operators.quantiles import quantiles
from tallyward.operators.ranking import first_ranked_with_copies
from tallyward.plans import questions
from tallyward.plans.cleansing import normalize, table_errors
from tallyward.plans.specs import spec_of

SEEDS = (1, 2)


def numbers(seed, n=400):
    """Values with a hot one that makes up a third, an outlier, and nulls."""
    r = random.Random(seed)
    out = [r.choice([7.0, round(r.gauss(0, 100), r.choice([0, 3])), r.random()]) for _ in range(n)]
    return out + [1e12, None]


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("bits, small", [(1, 3), (3, 20), (11, 100_000)])
def test_quantiles_equal_numpy(frame, seed, bits, small):
    values = numbers(seed)
    probabilities = [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    df = frame([(v, None if v is None else -v) for v in values], "v double, w double")
    rows = sorted(quantiles(df, ["v", "w"], probabilities, bits, small).collect())
    present = np.array([v for v in values if v is not None])
    for row, own in zip(rows, (present, -present), strict=True):
        assert row.quantiles == pytest.approx(np.quantile(own, probabilities), rel=1e-12, abs=1e-12)


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5])
def test_quantiles_of_few_values(frame, n):
    values = [float(i * i) for i in range(n)]
    found = quantiles(frame([(v,) for v in values], "v double"), ["v"], [0.25, 0.5, 0.75]).first().quantiles
    assert found == pytest.approx(np.quantile(values, [0.25, 0.5, 0.75]))


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("bins", [1, 7, 20])
def test_histogram_equals_numpy(frame, seed, bins):
    r = random.Random(seed)
    values = [r.choice([float(r.randint(0, 20)), r.random() * 20, 0.1 * r.randint(0, 200)]) for _ in range(300)]
    rows = sorted(histogram(frame([(v,) for v in values], "v double"), "v", bins).collect())
    counts, edges = np.histogram(values, bins)
    assert [r.n for r in rows] == list(counts)
    assert [r.low for r in rows] == pytest.approx(edges[:-1])


@pytest.mark.parametrize("seed", SEEDS)
def test_summary_equals_pandas(spark, frame, seed):
    values = numbers(seed)[:-2] + [None]
    df = frame([(v,) for v in values], "v double")
    row = profile.numeric_summary(df, ["v"]).first()
    expected = df.toPandas().v.describe()
    assert tuple(row)[1:] == pytest.approx(tuple(expected))


@pytest.mark.parametrize("seed", SEEDS)
def test_repeats_are_rows_less_distinct_rows(frame, seed):
    r = random.Random(seed)
    rows = [(r.choice([1, 1, 1, None, r.randint(2, 50)]), r.choice(["a", None, "b"])) for _ in range(500)]
    df = frame(rows, "a int, b string")
    expected = Counter({k: n - 1 for k, n in Counter(rows).items() if n > 1})
    assert Counter(tuple(x) for x in duplicates.duplicate_rows(df).collect()) == expected
    assert duplicates.duplicate_count(df).first().n_duplicates == df.count() - df.distinct().count()


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("descending", [True, False])
def test_first_rank_equals_brute_force(frame, seed, descending):
    r = random.Random(seed)
    rows = [(r.choice("abc"), r.choice([1.0, 2.0, 3.0, float(r.randint(0, 9))]), r.randint(0, 2)) for _ in range(300)]
    groups = defaultdict(list)
    for row in rows:
        groups[row[0]].append(row)
    best = max if descending else min
    expected = Counter(x for g in groups.values() for x in g if x[1] == best(y[1] for y in g))
    found = first_ranked_with_copies(frame(rows, "g string, v double, d int"), "g", "v", descending)
    assert Counter(tuple(x) for x in found.drop("_copy").collect()) == expected


CUSTOMER = "CustomerKey int, BirthDate string, DateFirstPurchase string, Phone string"


@pytest.mark.parametrize("seed", SEEDS)
def test_flagged_and_clean_rows_make_up_all_rows_and_normalizing_twice_changes_nothing(frame, seed):
    r = random.Random(seed)

    def text():
        y, m, d = r.randint(1930, 1999), r.randint(1, 12), r.randint(1, 28)
        return r.choice([f"{y}-{m:02d}-{d:02d}", f"{m:02d}/{d:02d}/{y % 100:02d}", None, "?"])

    rows = [(i, text(), text(), f"1 (11) 500 555-{i:04d}") for i in range(200)]
    df = frame(rows, CUSTOMER)
    spec = spec_of("dimcustomer")
    flagged = table_errors(df, spec).where("error_type = 'date_inconcistency'").count()
    clean = sum(1 for row in rows if all(t and len(t) > 8 for t in row[1:3]))
    assert flagged + clean == len(rows)
    once = normalize(df, spec)
    assert once.columns == df.columns
    assert normalize(once, spec).collect() == once.collect()
    expected = [(t and ("19" + t[6:] + "-" + t[:2] + "-" + t[3:5] if len(t) == 8 else t if len(t) == 10 else None)) for _, t, _, _ in rows]
    assert [x.b for x in once.orderBy("CustomerKey").select(F.date_format("BirthDate", "yyyy-MM-dd").alias("b")).collect()] == expected


@pytest.mark.parametrize("seed", SEEDS)
def test_money_is_summed_exactly(frame, seed):
    r = random.Random(seed)
    amounts = [Decimal(r.randint(-(10**r.randint(1, 15)), 10**15)) / 10000 for _ in range(300)]
    rows = [(float(a),) for a in amounts] + [(None,), (float("nan"),)]
    df = frame(rows, "v double")
    row = df.agg(money_sum(df, "v").alias("s"), money_mean(df, "v").alias("m")).first()
    assert row.s == float(sum(amounts))
    assert row.m == float(sum(amounts)) / len(amounts)
    none = frame([(None,)], "v double")
    empty = none.agg(money_sum(none, "v").alias("s"), money_mean(none, "v").alias("m")).first()
    assert tuple(empty) == (None, None)


@pytest.mark.parametrize("seed", SEEDS)
@pytest.mark.parametrize("largest_broadcast", ["-1", "10m"])
def test_questions_with_a_hot_product_equal_brute_force(spark, frame, request, seed, largest_broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", largest_broadcast)
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.autoBroadcastJoinThreshold"))
    r = random.Random(seed)
    rows = []
    for _ in range(600):
        order = dt.datetime(2011, 12, 1) + dt.timedelta(days=r.randint(0, 430))
        key = 1 if r.random() < 0.4 else r.choice([None, *range(2, 9)])
        rows.append((key, r.randint(1, 4), order, order + dt.timedelta(days=7), r.choice([0.0, -2.5, 100.25, round(r.random() * 9, 4)])))
    schema = "ProductKey int, SalesTerritoryKey int, OrderDate timestamp_ntz, ShipDate timestamp_ntz, SalesAmount double"
    sales = frame(rows, schema)
    products = [(k, "Hot" if k < 3 else f"p{k}") for k in range(1, 8)]
    territories = [(1, "UK"), (2, "UK"), (3, "FR")]
    product = frame(products, "ProductKey int, ProductName string")
    territory = frame(territories, "SalesTerritoryKey int, SalesTerritoryCountry string")
    name, country = dict(products), dict(territories)

    month_sums, revenue, best = defaultdict(float), defaultdict(float), defaultdict(list)
    for key, terr, order, ship, amount in rows:
        if key in name and order.year == 2012:
            if amount > 0:
                month_sums[key, order.month] += amount
            if name[key] == "Hot":
                best[order.month].append((amount, order))
        if key in name and terr in country and ship.year == 2012:
            revenue[ship.month, country[terr], name[key]] += amount

    found = questions.product_month_sales(sales, product, 2012).collect()
    assert {(x.ProductKey, int(x.OrderMonth)): x.SalesAmount for x in found} == pytest.approx(month_sums)
    top = questions.top_transaction_per_month(sales, questions.products_named(product, "HOT"), 2012).collect()
    expected = Counter((f"{m:02d}", a, d) for m, x in best.items() for a, d in x if a == max(y[0] for y in x))
    assert Counter(tuple(x) for x in top) == expected
    low = questions.lowest_revenue_per_month(sales, product, territory, 2012).collect()
    least = {m: min(round(v, 6) for k, v in revenue.items() if k[0] == m) for m in {k[0] for k in revenue}}
    assert {(x.month, x.sales_territory_country, x.product_name) for x in low} == {
        (f"{m:02d}", c, p) for (m, c, p), v in revenue.items() if round(v, 6) == least[m]
    }
