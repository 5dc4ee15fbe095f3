"""Special cases and properties of models that plain SQL can restate."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from checks.fixture import USABLE, prepared, sql, table, usable
from checks.learning import FEW, _fit, scaled, tips
from checks.output import plain
from checks.pieces import union
from meterline.learn import clusters, models, prep, reduction
from meterline.sources import raw, tables
from meterline.sources.staging import scratch_path

ENTRIES: dict = {}
TWO = ["fare_amount", "tip_amount"]

# two standardised columns have the components (1, s) and (1, -s) over the root of 2, s the sign of r
_PAIR = (
    *USABLE,
    "c AS (SELECT corr(fare_amount, tip_amount) AS r, avg(fare_amount) AS mf, stddev_pop(fare_amount) AS sf,"
    " avg(tip_amount) AS mt, stddev_pop(tip_amount) AS st FROM usable)",
)


def two_metrics(spark, sf_dir):
    df, _, columns = scaled(spark, sf_dir, TWO)
    ratios = reduction.pca(df, columns, 2).model.explainedVariance.toArray()
    return plain(reduction.reduction_metrics(spark, ratios))


def two_loadings(spark, sf_dir):
    df, _, columns = scaled(spark, sf_dir, TWO)
    table_ = reduction.loadings(spark, reduction.pca(df, columns, 2))
    return plain(table_.withColumn("loading", F.abs("loading")))


def two_projected(spark, sf_dir):
    """Distance from the middle along each component."""
    df, _, columns = scaled(spark, sf_dir, TWO)
    placed = reduction.project(reduction.pca(df, columns, 2), df, ["trip_id"])
    return plain(placed.select("trip_id", F.abs("PC1").alias("PC1"), F.abs("PC2").alias("PC2")), 5)


ENTRIES["D1_two_columns"] = (
    two_metrics,
    sql(
        "SELECT unnest(['n_components', 'total_variance_explained', 'first_component_variance', 'second_component_variance']) AS metric,"
        " round(unnest([2.0, 1.0, (1 + abs(r)) / 2, (1 - abs(r)) / 2]), 6) + 0.0 AS value FROM c",
        *_PAIR,
    ),
)
ENTRIES["D2_two_columns"] = (
    two_loadings,
    sql(
        "SELECT CAST(k AS INT) AS component, unnest(['fare_amount', 'tip_amount']) AS feature, round(sqrt(0.5), 6) + 0.0 AS loading FROM range(1, 3) t(k), c WHERE r IS NOT NULL",
        *_PAIR,
    ),
)
ENTRIES["D4_two_columns"] = (
    two_projected,
    sql(
        "SELECT trip_id, round(abs(zf + sign(r) * zt) * sqrt(0.5), 5) + 0.0 AS PC1, round(abs(zf - sign(r) * zt) * sqrt(0.5), 5) + 0.0 AS PC2"
        " FROM (SELECT trip_id, r, (fare_amount - mf) / sf AS zf, (tip_amount - mt) / st AS zt FROM usable, c)",
        *_PAIR,
    ),
)


def one_discriminant(spark, sf_dir):
    """High and low tips told apart by the total alone."""
    df = usable(spark, sf_dir).select(
        (F.col("payment_type") == 1).cast("double").alias("label"), "total_amount"
    )
    df = prep.assemble(df, ["total_amount"])
    placed = reduction.discriminate(reduction.linear_discriminant(df, 1), df)
    return placed.groupBy("label", "prediction").agg(F.count("*").alias("row_count"))


ENTRIES["D3_one_feature"] = (
    one_discriminant,
    sql(
        "SELECT label, prediction, count(*) AS row_count FROM (SELECT label, trip, arg_max(k, x * m / v - m * m / (2 * v) + ln(n / total)) AS prediction FROM"
        " (SELECT a.trip, a.x, a.label, g.k, g.m, g.n, s.v, s.total FROM a, g, s) GROUP BY label, trip) GROUP BY 1, 2",
        *USABLE,
        "a AS (SELECT row_number() OVER () AS trip, total_amount AS x, CASE WHEN payment_type = 1 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label FROM usable)",
        "g AS (SELECT label AS k, count(*)::DOUBLE AS n, avg(x) AS m, var_pop(x) * count(*) AS w FROM a GROUP BY 1)",
        "s AS (SELECT sum(w) / (sum(n) - 2) AS v, sum(n) AS total FROM g)",
    ),
)

# --- one cluster -----------------------------------------------------------------------------------


def mixture_likelihood(spark, sf_dir):
    """The criteria of a mixture against the densities of all rows, written out as columns."""
    df, _, columns = scaled(spark, sf_dir, TWO)
    with prep.held(df) as rows:
        model = clusters.gaussian_mixture(rows, 2)
        n = rows.count()
        found = clusters.mixture_criteria(model, n)
        density = F.lit(0.0)
        for weight, normal in zip(model.weights, model.gaussians, strict=True):
            (a, b), (_, d) = normal.cov.toArray()
            x, y = (F.col(c) - float(m) for c, m in zip(columns, normal.mean.toArray(), strict=True))
            size = a * d - b * b
            square = (x * x * float(d) - 2 * x * y * float(b) + y * y * float(a)) / float(size)
            density = density + F.exp(-square / 2) * float(weight / (2 * math.pi * math.sqrt(size)))
        fit = rows.agg(F.sum(F.log(density))).first()[0]
    want = {"bic": 11 * math.log(n) - 2 * fit, "aic": 22 - 2 * fit}
    rows = [(k, abs(found[k] - v) < 1e-6 * abs(v)) for k, v in want.items()]
    return spark.createDataFrame(rows, "metric string, equal boolean")


ENTRIES["U2_likelihood"] = (
    mixture_likelihood,
    "SELECT unnest(['bic', 'aic']) AS metric, true AS equal FROM (SELECT 1) WHERE EXISTS (FROM lineitem)",
)


def one_cluster_cost(spark, sf_dir):
    df, _, _ = scaled(spark, sf_dir, FEW)
    return plain(clusters.elbow(df, ks=[1], restarts=1), 3)


ENTRIES["U4_one_cluster"] = (
    one_cluster_cost,
    sql(f"SELECT 1 AS k, round(count(*) * {len(FEW)}.0::DOUBLE, 3) + 0.0 AS cost FROM usable", *USABLE),
)


def one_centre(spark, sf_dir):
    df, scales, columns = scaled(spark, sf_dir, FEW)
    return plain(clusters.centers(df, clusters.kmeans(df, 1, restarts=1), columns, scales), 4)


ENTRIES["U7_one_cluster"] = (
    one_centre,
    sql(
        union(
            [
                f"SELECT 0 AS cluster, '{c}' AS column_name, round(avg({c}), 4) + 0.0 AS value FROM usable"
                for c in FEW
            ]
        ),
        *USABLE,
    ),
)


def probability_totals(spark, sf_dir):
    """Components and total probability of every trip."""
    df, _, _ = scaled(spark, sf_dir, TWO)
    with prep.held(df) as rows:
        model = clusters.gaussian_mixture(rows, 3)
    parts = clusters.soft_assign(model, df, ["trip_id"])
    in_range = F.bool_and(F.col("probability").between(0, 1)).alias("in_range")
    totals = parts.groupBy("trip_id").agg(
        F.countDistinct("component").alias("components"),
        (F.sum("probability") / (F.count("*") / 3)).alias("total"),
        in_range,
    )
    return plain(totals)


ENTRIES["U8_totals"] = (
    probability_totals,
    sql(
        "SELECT trip_id, 3::BIGINT AS components, 1.0::DOUBLE AS total, true AS in_range FROM usable GROUP BY 1",
        *USABLE,
    ),
)


def silhouettes_match(spark, sf_dir):
    """The scan's silhouette of two clusters against one computed from sums per cluster."""
    df, _, columns = scaled(spark, sf_dir, TWO)
    with prep.held(df) as rows:
        found = clusters.silhouette_scan(rows, ks=[2], restarts=2).first()["silhouette_sq"]
        model = clusters.kmeans(rows, 2, restarts=2)
        placed = clusters.assign(model, rows)
        sums = placed.groupBy("cluster").agg(
            F.count("*").alias("n"),
            *[F.sum(c).alias(f"s{i}") for i, c in enumerate(columns)],
            F.sum(sum(F.col(c) * F.col(c) for c in columns)).alias("q"),
        )
        sizes = {r["cluster"]: r for r in sums.collect()}
        distance = {
            k: (
                sum(F.col(c) * F.col(c) for c in columns) * r["n"]
                - 2 * sum(F.col(c) * r[f"s{i}"] for i, c in enumerate(columns))
                + r["q"]
            )
            for k, r in sizes.items()
        }
        own = F.when(F.col("cluster") == 0, distance[0] / (sizes[0]["n"] - 1)).otherwise(
            distance[1] / (sizes[1]["n"] - 1)
        )
        other = F.when(F.col("cluster") == 0, distance[1] / sizes[1]["n"]).otherwise(
            distance[0] / sizes[0]["n"]
        )
        want = placed.agg(F.avg((other - own) / F.greatest(own, other))).first()[0]
    return spark.createDataFrame([(2, abs(found - want) < 1e-6)], "k int, equal boolean")


ENTRIES["U5_two_clusters"] = (
    silhouettes_match,
    "SELECT 2 AS k, true AS equal FROM (SELECT 1) WHERE EXISTS (FROM lineitem)",
)

# --- logistic regression at its optimum ------------------------------------------------------------


def logistic_optimum(spark, sf_dir):
    """Slope of the mean log loss plus penalty, per feature in units of its deviation."""
    df, columns = tips(spark, sf_dir)
    model = _fit(df, models.CLASSIFIERS["LogisticRegression"], C=1.0, max_iter=1000)
    train = models.vector_to_array("features")
    scored = model.transform(df.filter("split = 'train'"))
    left = models.vector_to_array("probability")[1] - F.col("label")
    cells = scored.select(left.alias("e"), train.alias("x"))
    row = cells.agg(
        F.count("*").alias("n"),
        *[F.avg(F.col("x")[i] * F.col("e")).alias(f"g{i}") for i in range(len(columns))],
        *[F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(len(columns))],
        *[F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(len(columns))],
    ).first()
    found = []
    for i, c in enumerate(columns):
        slope = row[f"g{i}"] + float(model.coefficients[i]) / row["n"]
        size = (row[f"s{i}"] ** 2 + row[f"m{i}"] ** 2) ** 0.5
        found.append((c, abs(slope) / size < 1e-3))
    return spark.createDataFrame(found, "feature string, at_optimum boolean")


_TIP_FEATURES = (
    "vendor_id passenger_count trip_distance rate_code pickup_location_id dropoff_location_id payment_type"
    " extra pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude trip_duration"
    " trip_duration_minutes speed_mph hour_of_day day_of_week month"
).split()
ENTRIES["K1_logistic_optimality"] = (
    logistic_optimum,
    f"SELECT unnest({_TIP_FEATURES}) AS feature, true AS at_optimum FROM (SELECT 1) WHERE EXISTS (FROM lineitem)",
)

# --- fingerprints and table information ------------------------------------------------------------


def by_vendor(df):
    """The rows by vendor, of whom there are few: Spark cuts them into tasks of its advised size."""
    return df.hint("rebalance", "vendor_id")


def fingerprints(spark, sf_dir):
    """Equal for the same rows in another order and layout, different after one changed cell or a lost row."""
    df = prepared(spark, sf_dir)
    last = df.agg(F.max("trip_id")).first()[0]
    changed = df.withColumn(
        "fare_amount",
        F.when(F.col("trip_id") == last, F.col("fare_amount") + 0.01).otherwise(F.col("fare_amount")),
    )
    own, moved, other, lost = (
        raw.fingerprint(d).first()
        for d in (df, by_vendor(df), changed, df.where(F.col("trip_id") != last))
    )
    rows = [("reordered", own == moved), ("changed", own == other), ("lost", own == lost)]
    return spark.createDataFrame(rows, "what string, equal boolean")


ENTRIES["S13_fingerprint_property"] = (
    fingerprints,
    "SELECT unnest(['reordered', 'changed', 'lost']) AS what, unnest([true, false, false]) AS equal FROM (SELECT 1) WHERE EXISTS (FROM lineitem)",
)


def columns_of(spark, sf_dir):
    """Name, type and place of the columns of a table written from the orders; none for an absent one."""
    name = f"orders_{scratch_path(spark, 'info').rsplit('-', 1)[1]}"
    path = scratch_path(spark, "orders")
    tables.write_table(table(spark, sf_dir, "orders"), name, "fail", path=path)
    info = tables.table_info(spark, name)
    return info.unionByName(tables.table_info(spark, name + "_absent"))


_KINDS = "CASE column_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'VARCHAR' THEN 'string' WHEN 'DOUBLE' THEN 'double' WHEN 'DATE' THEN 'date' ELSE 'timestamp_ntz' END"
ENTRIES["S10_table_columns"] = (
    lambda spark, sf_dir: columns_of(spark, sf_dir).select("column_name", "data_type"),
    f"SELECT column_name, {_KINDS} AS data_type FROM (DESCRIBE orders)",
)
