"""Model families on the trips and on the embeddings."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from checks.fixture import USABLE, sql, table, usable
from checks.output import plain, sql_round
from meterline.learn import clusters, evaluation, models, moments, net, prep, reduction
from meterline.schemas import numeric_columns
from meterline.sources.staging import stage

ENTRIES: dict = {}

_NOT_FEATURES = ("label", "split_key")


def _labelled(df, target):
    """(label, features, split) with medians filled from the training rows."""
    columns = [c for c in prep.select_numeric(df, target) if c not in _NOT_FEATURES]
    parted = prep.assign_split(df, ["split_key"])
    gaps = prep.incomplete(parted, columns)
    medians = prep.fit_medians(parted.filter("split = 'train'"), gaps)
    filled = prep.fill_medians(parted, medians).withColumn("label", F.col(target).cast("double"))
    return prep.assemble(filled, columns).select("label", "features", "split"), columns


def _keyed(spark, sf_dir):
    # a text key is not a feature
    return usable(spark, sf_dir).withColumn("split_key", F.col("trip_id").cast("string"))


def fares(spark, sf_dir):
    return _labelled(prep.regression_set(_keyed(spark, sf_dir)), "fare_amount")


def tips(spark, sf_dir):
    return _labelled(prep.tip_label(_keyed(spark, sf_dir)), "high_tip")


def _fit(df, train, **params):
    with prep.dealt(df.filter("split <> 'test'")) as rows:
        if params.get("validation"):
            return train(rows.withColumn("validation", F.col("split") == "val"), **params)
        return train(rows.filter("split = 'train'"), **params)


def fare_columns(spark, sf_dir):
    """The fares' training table and its feature columns."""
    df = prep.regression_set(_keyed(spark, sf_dir))
    return df, [c for c in prep.select_numeric(df, "fare_amount") if c not in _NOT_FEATURES]


def linear_fit(spark, sf_dir, name, **params):
    """A fit on the training rows, from moments, and the rows of all splits."""
    df, columns = fare_columns(spark, sf_dir)
    parts, filled = moments.complete_moments(
        prep.assign_split(df, ["split_key"]), columns, "fare_amount"
    )
    return moments.SOLVERS[name](parts["train"], columns, **params), filled


def linear(name, **params):
    def query(spark, sf_dir):
        fit, rows = linear_fit(spark, sf_dir, name, **params)
        tested = rows.filter("split = 'test'").withColumn("label", F.col("fare_amount").cast("double"))
        return plain(evaluation.compare_regressors(models.predict(fit.scorer(), tested, name)))

    return query


def optimality(name, **params):
    """Per feature, how far the fit is from its optimum, in units of the feature and the target.

    The slope of the squared error must equal the penalty's where a weight is not 0, and may not exceed
    it elsewhere.
    """

    def query(spark, sf_dir):
        fit, rows = linear_fit(spark, sf_dir, name, **params)
        scored = fit.scorer().transform(rows.filter("split = 'train'"))
        left = F.col("fare_amount") - F.col("prediction")
        row = scored.agg(
            F.count("*").alias("n"),
            F.stddev_pop("fare_amount").alias("sy"),
            *[F.covar_pop(c, left).alias(f"g{i}") for i, c in enumerate(fit.columns)],
            *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(fit.columns)],
        ).first()
        found, alpha = [], params.get("alpha", 0.0)
        for i, c in enumerate(fit.columns):
            g, w = row[f"g{i}"], float(fit.weights[i])
            if name == "Ridge":
                gap = abs(g - alpha * w / row["n"])
            elif w:
                gap = abs(abs(g) - alpha) if name == "Lasso" else abs(g)
            else:
                gap = max(abs(g) - alpha, 0.0)
            found.append((c, gap / (row[f"s{i}"] * row["sy"])))
        return plain(spark.createDataFrame(found, "feature string, violation double"))

    return query


def regression(name, **params):
    def query(spark, sf_dir):
        df, _ = fares(spark, sf_dir)
        model = _fit(df, models.REGRESSORS[name], **params)
        tested = models.predict(model, df.filter("split = 'test'"), name)
        return plain(evaluation.compare_regressors(tested))

    return query


def classification(name, **params):
    def query(spark, sf_dir):
        df, _ = tips(spark, sf_dir)
        model = _fit(df, models.CLASSIFIERS[name], **params)
        # the metrics take several passes over what is predicted once
        tested = stage(models.predict(model, df.filter("split = 'test'"), name), "tested")
        return plain(evaluation.compare_classifiers(tested))

    return query


ENTRIES["R1_linear"] = (linear("LinearRegression"), None)
ENTRIES["R2_ridge"] = (linear("Ridge", alpha=1.0), None)
ENTRIES["R3_lasso"] = (linear("Lasso", alpha=1.0), None)
_FARE_FEATURES = (
    "vendor_id passenger_count trip_distance rate_code pickup_location_id dropoff_location_id payment_type"
    " extra pickup_latitude pickup_longitude dropoff_latitude dropoff_longitude trip_duration"
    " trip_duration_minutes speed_mph hour_of_day day_of_week month"
).split()
_AT_OPTIMUM = (
    f"SELECT unnest({_FARE_FEATURES}) AS feature, 0.0::DOUBLE AS violation FROM (SELECT 1) WHERE EXISTS (FROM lineitem)"
)
ENTRIES["R1_linear_optimality"] = (optimality("LinearRegression"), _AT_OPTIMUM)
ENTRIES["R2_ridge_optimality"] = (optimality("Ridge", alpha=1.0), _AT_OPTIMUM)
ENTRIES["R3_lasso_optimality"] = (optimality("Lasso", alpha=0.01), _AT_OPTIMUM)
ENTRIES["R4_rf_regressor"] = (regression("RandomForestRegressor", n_estimators=100, max_depth=10), None)
ENTRIES["R5_gbt_regressor"] = (
    regression("GBTRegressor", n_estimators=100, max_depth=6, validation="validation"),
    None,
)
ENTRIES["K1_logistic"] = (classification("LogisticRegression", C=1.0, max_iter=1000), None)
ENTRIES["K2_rf_classifier"] = (
    classification("RandomForestClassifier", n_estimators=100, max_depth=10),
    None,
)
ENTRIES["K3_gbt_classifier"] = (
    classification("GBTClassifier", n_estimators=100, max_depth=6, validation="validation"),
    None,
)
ENTRIES["K4_mlp"] = (
    classification("MLPClassifier", hidden_layer_sizes=(100, 50), max_iter=500),
    None,
)


def net_curve(spark, sf_dir):
    """Loss and held-out scores per epoch of the same net on the tips."""
    df, _ = tips(spark, sf_dir)
    with prep.dealt(df.filter("split = 'train'")) as rows:
        return plain(net.fit_net(rows).curve_table(spark))


ENTRIES["K4_loss_curve"] = (net_curve, None)


def separable(spark, sf_dir):
    """A net told whether a trip is long: nearly all of the held-out test rows are right."""
    df = usable(spark, sf_dir).withColumn("split_key", F.col("trip_id").cast("string"))
    far = ((F.col("trip_distance") > 6) & (F.col("hour_of_day") < 12)).cast("double")
    df = prep.assemble(
        prep.assign_split(df.withColumn("label", far), ["split_key"]),
        ["trip_distance", "hour_of_day", "fare_amount"],
    )
    model = _fit(df, models.CLASSIFIERS["MLPClassifier"])
    tested = models.predict(model, df.filter("split = 'test'"), "net")
    good = evaluation.compare_classifiers(tested)
    return good.select((F.col("accuracy") > 0.97).alias("accurate"), (F.col("roc_auc") > 0.98).alias("ranked"))


ENTRIES["K4_separable"] = (
    separable,
    "SELECT true AS accurate, true AS ranked FROM (SELECT 1) WHERE EXISTS (FROM lineitem)",
)


def importances(spark, sf_dir):
    df, columns = fares(spark, sf_dir)
    table_ = None
    # the five regressors as R1 to R5 register them
    for name, params in (
        ("LinearRegression", {}),
        ("Ridge", {"alpha": 1.0}),
        ("Lasso", {"alpha": 1.0}),
        ("RandomForestRegressor", {"n_estimators": 100, "max_depth": 10}),
        ("GBTRegressor", {"n_estimators": 100, "max_depth": 6, "validation": "validation"}),
    ):
        if name in moments.SOLVERS:
            model = linear_fit(spark, sf_dir, name, **params)[0].scorer()
        else:
            model = _fit(df, models.REGRESSORS[name], **params)
        part = models.importance(spark, model, columns, name)
        table_ = part if table_ is None else table_.unionByName(part)
    return plain(evaluation.rank_importance(table_, 10))


ENTRIES["E9_importance"] = (importances, None)

# --- clustering -----------------------------------------------------------------------------


def scaled(spark, sf_dir, columns=None):
    """Standardised trips: (trip_id, the columns, features) and the scales."""
    df = usable(spark, sf_dir)
    columns = columns or numeric_columns(prep.cluster_set(df))
    df = df.select("trip_id", *[F.col(c).cast("double").alias(c) for c in columns]).dropna()
    scales = prep.fit_scales(df, columns)
    return prep.assemble(prep.standardise(df, scales), columns), scales, columns


FEW = "trip_distance fare_amount tip_amount speed_mph hour_of_day day_of_week".split()


def _measured(labelled, columns):
    quality = clusters.separation(labelled, columns)
    score = clusters.silhouette_sq(labelled)
    return quality.withColumn("silhouette_sq", F.lit(score).cast("double"))


def kmeans(spark, sf_dir):
    df, _, columns = scaled(spark, sf_dir)
    with prep.held(df):
        model = clusters.kmeans(df, k=5, restarts=10)
        return plain(_measured(clusters.assign(model, df), columns))


def mixture(spark, sf_dir):
    df, _, columns = scaled(spark, sf_dir)
    with prep.held(df):
        model = clusters.gaussian_mixture(df, k=5)
        criteria = clusters.mixture_criteria(model, df.count())
        measured = _measured(clusters.assign(model, df), columns)
    return plain(measured.withColumns({n: F.lit(v) for n, v in criteria.items()}))


def fixed_point(spark, sf_dir):
    """Whether each centre is the mean of the rows that are nearest to it."""
    df, _, columns = scaled(spark, sf_dir)
    with prep.held(df):
        model = clusters.kmeans(df, k=5)
        rows = [(i, [float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
        means = (
            clusters.assign(model, df)
            .groupBy("cluster")
            .agg(F.array(*[F.avg(c) for c in columns]).alias("mean"))
            .collect()
        )
    points = spark.createDataFrame(rows, "cluster int, centre array<double>")
    found = spark.createDataFrame(means, "cluster int, mean array<double>")
    gap = F.expr("array_max(transform(arrays_zip(centre, mean), p -> abs(p.centre - p.mean)))")
    return points.join(found, "cluster").select("cluster", (gap < 0.01).alias("settled"))


ENTRIES["U1_kmeans"] = (kmeans, None)
ENTRIES["U1_fixed_point"] = (
    fixed_point,
    "SELECT CAST(i AS INT) AS cluster, true AS settled FROM range(5) t(i) WHERE EXISTS (FROM lineitem)",
)
ENTRIES["U2_gmm"] = (mixture, None)

# given labels: the closest of three fixed points, in the columns' own units
_POINTS = ((2.0, 20.0), (6.0, 45.0), (10.0, 75.0))
_POINT_COLUMNS = ("trip_distance", "fare_amount")


def labelled(spark, sf_dir):
    return clusters.nearest_center(usable(spark, sf_dir), _POINT_COLUMNS, _POINTS)


_D = [f"pow(trip_distance - {a}, 2) + pow(fare_amount - {b}, 2)" for a, b in _POINTS]
LABELLED = (
    *USABLE,
    "grouped AS (SELECT *, CASE WHEN "
    + f"{_D[0]} <= {_D[1]} AND {_D[0]} <= {_D[2]} THEN 0 WHEN {_D[1]} <= {_D[2]} THEN 1 ELSE 2 END AS cluster FROM usable)",
    "mids AS (SELECT cluster, count(*) AS n, avg(trip_distance) AS x, avg(fare_amount) AS y FROM grouped GROUP BY 1)",
    "spreads AS (SELECT cluster, any_value(n) AS n, any_value(x) AS x, any_value(y) AS y,"
    " avg(sqrt(pow(trip_distance - x, 2) + pow(fare_amount - y, 2))) AS s, sum(pow(trip_distance - x, 2) + pow(fare_amount - y, 2)) AS w"
    " FROM grouped JOIN mids USING (cluster) GROUP BY 1)",
)
ENTRIES["U3_cluster_metrics"] = (
    lambda spark, sf_dir: plain(clusters.separation(labelled(spark, sf_dir), _POINT_COLUMNS)),
    sql(
        """SELECT 3 AS clusters, (SELECT round(avg(r), 6) + 0.0 FROM (SELECT a.cluster, max((a.s + b.s) / sqrt(pow(a.x - b.x, 2) + pow(a.y - b.y, 2))) AS r
 FROM spreads a JOIN spreads b ON a.cluster <> b.cluster GROUP BY 1)) AS davies_bouldin_score,
 (SELECT round(sum(n * (pow(x - mx, 2) + pow(y - my, 2))) / 2 / (sum(w) / (sum(n) - 3)), 6) + 0.0 FROM spreads,
 (SELECT avg(trip_distance) AS mx, avg(fare_amount) AS my FROM grouped)) AS calinski_harabasz_score""",
        *LABELLED,
    ),
)


def elbow(mixture_model):
    def query(spark, sf_dir):
        df, _, _ = scaled(spark, sf_dir)
        with prep.held(df):
            return plain(clusters.elbow(df, mixture=mixture_model))

    return query


ENTRIES["U4_elbow"] = (elbow(False), None)


def silhouettes(spark, sf_dir):
    df, _, _ = scaled(spark, sf_dir)
    with prep.held(df):
        return plain(clusters.silhouette_scan(df))


ENTRIES["U4_elbow_bic"] = (elbow(True), None)
ENTRIES["U5_silhouette_scan"] = (silhouettes, None)
_PROFILED = ["trip_distance", "fare_amount", "speed_mph"]
ENTRIES["U6_cluster_profile"] = (
    lambda spark, sf_dir: plain(clusters.cluster_profile(labelled(spark, sf_dir), _PROFILED)),
    sql(
        "SELECT cluster, "
        + sql_round(*[f"avg({c}) AS {c}" for c in _PROFILED])
        + ", count(*) AS cluster_size, "
        + sql_round("count(*) / (SELECT count(*) FROM grouped) AS share")
        + " FROM grouped GROUP BY 1",
        *LABELLED,
    ),
)


def centers(spark, sf_dir):
    df, scales, columns = scaled(spark, sf_dir)
    with prep.held(df):
        model = clusters.kmeans(df, 5)
    return plain(clusters.centers(df, model, columns, scales))


def soft(spark, sf_dir):
    df, _, _ = scaled(spark, sf_dir)
    with prep.held(df):
        model = clusters.gaussian_mixture(df, 5)
    return plain(clusters.soft_assign(model, df, ["trip_id"]))


ENTRIES["U7_centers"] = (centers, None)
ENTRIES["U8_soft_assign"] = (soft, None)

# --- dimensionality reduction ---------------------------------------------------------------


def principal(spark, sf_dir):
    df, _, columns = scaled(spark, sf_dir)
    return df, reduction.pca(df, columns)


def pca_metrics(spark, sf_dir):
    _, found = principal(spark, sf_dir)
    ratios = found.model.explainedVariance.toArray()[: found.count]
    return plain(reduction.reduction_metrics(spark, ratios))


ENTRIES["D1_pca"] = (pca_metrics, None)
ENTRIES["D2_loadings"] = (
    lambda spark, sf_dir: plain(reduction.loadings(spark, principal(spark, sf_dir)[1])),
    None,
)
ENTRIES["D2_top_features"] = (
    lambda spark, sf_dir: plain(
        reduction.top_features(reduction.loadings(spark, principal(spark, sf_dir)[1]))
    ),
    None,
)


def embedded(spark, sf_dir):
    df = table(spark, sf_dir, "embeddings")
    return df.select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.col("embedding").cast("array<double>")).alias("features"),
    )


def discriminant(spark, sf_dir):
    """Ten classes of vectors: how well the discriminants separate them."""
    df = embedded(spark, sf_dir)
    found = reduction.linear_discriminant(df, 64)
    ratios = reduction.reduction_metrics(spark, found.ratios)
    right = reduction.accuracy(reduction.discriminate(found, df))
    return plain(
        ratios.unionByName(
            right.select(
                F.lit("classification_accuracy").alias("metric"),
                F.col("classification_accuracy").alias("value"),
            )
        )
    )


def tip_discriminant(spark, sf_dir):
    """One discriminant for high and low tips, projected per class."""
    df, columns = tips(spark, sf_dir)
    found = reduction.linear_discriminant(df, len(columns), 1)
    placed = reduction.discriminate(found, df)
    return plain(
        placed.groupBy("label", "prediction").agg(
            F.count("*").alias("row_count"), F.avg(F.abs("LD1")).alias("mean_abs_ld1")
        )
    )


ENTRIES["D3_lda"] = (discriminant, None)
ENTRIES["D3_lda_tips"] = (tip_discriminant, None)


def projected(spark, sf_dir):
    df, found = principal(spark, sf_dir)
    return plain(reduction.project(found, df, ["trip_id"], 3))


ENTRIES["D4_project"] = (projected, None)
ENTRIES["D5_explained_variance"] = (
    lambda spark, sf_dir: plain(reduction.explained_variance(spark, principal(spark, sf_dir)[1])),
    None,
)

# --- fits with one or two features, which plain SQL can restate --------------------------------

_MOMENTS = (
    *USABLE,
    "fit AS (SELECT count(*) AS n, avg(fare_amount) AS mx, avg(total_amount) AS my,"
    " var_pop(fare_amount) AS vx, covar_pop(fare_amount, total_amount) AS cxy FROM usable)",
)


def single(name, **params):
    """Total amount explained by the fare alone: slope and intercept."""

    def query(spark, sf_dir):
        df = prep.assemble(usable(spark, sf_dir), ["fare_amount"])
        df = df.withColumn("label", F.col("total_amount"))
        model = models.REGRESSORS[name](df, **params)
        return plain(models.coefficients(spark, model, ["fare_amount"], name).drop("model"), 3)

    return query


def _single_sql(slope: str) -> str:
    return sql(
        f"SELECT 'fare_amount' AS term, round({slope}, 3) + 0.0 AS value FROM fit"
        f" UNION ALL SELECT '(intercept)', round(my - mx * ({slope}), 3) + 0.0 FROM fit",
        *_MOMENTS,
    )


_TWO = (
    *USABLE,
    "train AS (SELECT trip_distance AS a, trip_duration_minutes AS b, fare_amount AS y FROM usable WHERE fare_amount > 0 AND store_and_fwd_flag IS NOT NULL"
    " AND CAST(('0x' || substr(md5(trip_id::VARCHAR || '-42'), 1, 8)) AS BIGINT) % 1000 >= 300)",
    "m AS (SELECT count(*) AS n, avg(a) AS ma, avg(b) AS mb, avg(y) AS my, count(*) * var_pop(a) AS saa, count(*) * var_pop(b) AS sbb,"
    " count(*) * covar_pop(a, b) AS sab, count(*) * covar_pop(a, y) AS say, count(*) * covar_pop(b, y) AS sby FROM train)",
)


def pair(name, **params):
    """Fares explained by distance and minutes, fitted on the training rows."""

    def query(spark, sf_dir):
        df = prep.assign_split(prep.regression_set(_keyed(spark, sf_dir)), ["split_key"])
        columns = ["trip_distance", "trip_duration_minutes"]
        parts, _ = moments.complete_moments(df, columns, "fare_amount")
        fit = moments.SOLVERS[name](parts["train"], columns, **params)
        return plain(moments.coefficient_table(spark, fit, name).drop("model"))

    return query


def _pair_sql(alpha: float) -> str:
    a, b = f"(saa + {alpha}::DOUBLE)", f"(sbb + {alpha}::DOUBLE)"
    down = f"({a} * {b} - sab * sab)"
    wa, wb = f"(({b} * say - sab * sby) / {down})", f"(({a} * sby - sab * say) / {down})"
    return sql(
        f"SELECT 'trip_distance' AS term, round({wa}, 6) + 0.0 AS value FROM m"
        f" UNION ALL SELECT 'trip_duration_minutes', round({wb}, 6) + 0.0 FROM m"
        f" UNION ALL SELECT '(intercept)', round(my - ma * {wa} - mb * {wb}, 6) + 0.0 FROM m",
        *_TWO,
    )


ENTRIES["R1_linear_two_features"] = (pair("LinearRegression"), _pair_sql(0.0))
ENTRIES["R2_ridge_two_features"] = (pair("Ridge", alpha=1e5), _pair_sql(1e5))
ENTRIES["R1_linear_one_feature"] = (single("LinearRegression"), _single_sql("cxy / vx"))
ENTRIES["R2_ridge_one_feature"] = (
    single("Ridge", alpha=1e6),
    _single_sql("cxy * n / (vx * n + 1000000.0::DOUBLE)"),
)
ENTRIES["R3_lasso_one_feature"] = (
    single("Lasso", alpha=50.0),
    _single_sql("sign(cxy) * greatest(abs(cxy) - 50, 0) / vx"),
)


def two_components(spark, sf_dir):
    """Principal components of two standardised columns share 1 + |r| and 1 - |r|."""
    df, _, columns = scaled(spark, sf_dir, ["fare_amount", "tip_amount"])
    return plain(reduction.explained_variance(spark, reduction.pca(df, columns)))


ENTRIES["D5_two_columns"] = (
    two_components,
    sql(
        "SELECT 1 AS component, round((1 + r) / 2, 6) + 0.0 AS ratio, round((1 + r) / 2, 6) + 0.0 AS cumulative, true AS kept FROM c"
        " UNION ALL SELECT 2, round((1 - r) / 2, 6) + 0.0, 1.0, (1 + r) / 2 <= 0.95 FROM c",
        *USABLE,
        "c AS (SELECT abs(corr(fare_amount, tip_amount)) AS r FROM usable)",
    ),
)
