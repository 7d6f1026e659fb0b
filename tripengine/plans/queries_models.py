"""Queries on encodings, models, tuning, importance, tests and scoring.

Where a fitted model has a closed form (a line through one feature, a mean
per group), the oracle states that form; the other models are checked by
their rows and by the tests.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.ml import Pipeline
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import functions as F

from tripengine import schemas
from tripengine.functions.predicates import hash_bucket
from tripengine.operators import categories, encode, gram, importance, models, treetables
from tripengine.operators.clean import hash_split
from tripengine.plans import tripview as tv
from tripengine.plans.cleaned import model_table
from tripengine.plans.queries_columns import stored_features
from tripengine.plans.queries_joins import KEYS
from tripengine.plans.registry import query
from tripengine.plans.tripview import with_tables
from tripengine.session import materialise, scratch
from tripengine.streaming.scoring import error_windows, score_arriving

LABEL = schemas.LABEL


def stored_trips(spark, sf, *columns):
    """The joined trip columns, written once as each stage of a fit reads them."""
    return materialise(tv.trips(spark, sf, *columns), "trips")


# encodings ----------------------------------------------------------------

RANK_SQL = """
codes AS (
  SELECT payment_type AS k, row_number() OVER (ORDER BY count(*) DESC, payment_type) - 1 AS code
  FROM trips WHERE payment_type IS NOT NULL GROUP BY 1)"""


@query("enc_01_ordinal", with_tables(f"""
WITH {RANK_SQL}
SELECT order_key, line_number,
       CAST(coalesce(code, (SELECT count(*) FROM codes)) AS DOUBLE) AS payment_type_index
FROM trips LEFT JOIN codes ON k = payment_type""", "trips"))
def enc_01(spark, sf):
    df = stored_trips(spark, sf, *KEYS, "payment_type")
    return encode.indexer(["payment_type"]).fit(df).transform(df).drop("payment_type")


def _one_hot(spark, sf, drop_last):
    df = stored_trips(spark, sf, *KEYS, "payment_type")
    stages = [encode.indexer(["payment_type"], "error"), encode.one_hot(["payment_type"], drop_last)]
    stages[1] = stages[1].setHandleInvalid("error")
    coded = Pipeline(stages=stages).fit(df).transform(df)
    slots = vector_to_array("payment_type_encoded")
    return coded.select(*KEYS, *[
        F.get(slots, F.lit(i)).alias(f"slot_{i}") for i in range(4 if drop_last else 5)
    ], F.size(slots).alias("slots"))


def _one_hot_sql(slots):
    columns = ", ".join(
        f"CASE WHEN code = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS slot_{i}"
        for i in range(slots)
    )
    return with_tables(f"""
WITH {RANK_SQL}
SELECT order_key, line_number, {columns}, {slots} AS slots
FROM trips JOIN codes ON k = payment_type""", "trips")


@query("enc_02_one_hot_drop_last", _one_hot_sql(4))
def enc_02(spark, sf):
    return _one_hot(spark, sf, True)


@query("enc_02_one_hot_keep_all", _one_hot_sql(5))
def enc_02_all(spark, sf):
    return _one_hot(spark, sf, False)


MEASURED = ["fare_amount", "passenger_count", "improvement_surcharge"]


def _unpacked(df, column, names, digits=6):
    values = vector_to_array(column)
    return df.select(*KEYS, *[
        F.round(F.get(values, F.lit(i)), digits).alias(n) for i, n in enumerate(names)
    ])


def _assembled(spark, sf):
    df = tv.trips(spark, sf, *KEYS, *MEASURED)
    return encode.assemble(MEASURED, label=LABEL).transform(df)


@query("enc_03_assembled_vector", """
SELECT l_orderkey AS order_key, l_linenumber AS line_number, l_extendedprice AS fare_amount,
       l_quantity AS passenger_count, l_tax AS improvement_surcharge FROM lineitem""")
def enc_03(spark, sf):
    return _unpacked(_assembled(spark, sf), "features", MEASURED)


@query("enc_04_target_mean_stage", with_tables("""
SELECT order_key, line_number, round(avg(total_amount) OVER (PARTITION BY payment_type), 4)
  AS payment_type_target
FROM trips""", "trips"))
def enc_04(spark, sf):
    df = stored_trips(spark, sf, *KEYS, "payment_type", LABEL)
    stages = [encode.indexer(["payment_type"]), encode.target_mean(["payment_type"], LABEL)]
    return Pipeline(stages=stages).fit(df).transform(df).select(
        *KEYS, F.round("payment_type_target", 4).alias("payment_type_target")
    )


@query("enc_01_codes_of_many", """
WITH codes AS (
  SELECT l_partkey AS k, row_number() OVER (ORDER BY count(*) DESC, CAST(l_partkey AS VARCHAR)) - 1 AS code
  FROM lineitem WHERE l_partkey IS NOT NULL GROUP BY 1)
SELECT l_orderkey, l_linenumber, CAST(coalesce(code, (SELECT count(*) FROM codes)) AS DOUBLE) AS part_index
FROM lineitem LEFT JOIN codes ON k = l_partkey""")
def enc_01_many(spark, sf):
    """Codes by frequency of a column with very many values, joined as a table."""
    df = tv.read(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"))
    return categories.with_codes(df, categories.frequency_codes(df, "part"), "part").drop("part")


_LINE_FOLDS = """
dealt AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice AS y,
         CAST('0x' || substr(md5('fold|' || l_orderkey || '|' || l_linenumber), 1, 8) AS BIGINT) % 5 AS fold
  FROM lineitem)"""


@query("enc_04_out_of_fold_means", f"""
WITH {_LINE_FOLDS},
own AS (SELECT l_partkey AS k, fold AS f, sum(y) AS s, count(y) AS n FROM dealt GROUP BY ALL),
every AS (SELECT k, sum(s) AS s, sum(n) AS n FROM own GROUP BY 1),
prior AS (SELECT f, ((SELECT sum(s) FROM own) - sum(s)) / ((SELECT sum(n) FROM own) - sum(n)) AS m FROM own GROUP BY 1)
SELECT l_orderkey, l_linenumber,
       round((every.s - own.s + 2 * m) / (every.n - own.n + 2), 3) AS part_target
FROM dealt JOIN own ON own.k IS NOT DISTINCT FROM l_partkey AND own.f = fold
JOIN every ON every.k IS NOT DISTINCT FROM l_partkey JOIN prior ON prior.f = fold""")
def enc_04_folds(spark, sf):
    """Each line's mean price of its part over the lines of the other folds."""
    keys = ["l_orderkey", "l_linenumber"]
    df = tv.read(spark, sf, "lineitem").select(
        *keys, F.col("l_partkey").alias("part"), "l_extendedprice",
        hash_bucket(*keys, buckets=5, salt="fold").alias("fold"))
    found = categories.out_of_fold_means(df, "part", "l_extendedprice", "fold", smoothing=2)
    return found.select(*keys, F.round("part_target", 3).alias("part_target"))


_COLUMNS_SQL = {"fare_amount": "l_extendedprice", "passenger_count": "l_quantity",
                "improvement_surcharge": "l_tax"}


@query("enc_05_min_max", "SELECT l_orderkey AS order_key, l_linenumber AS line_number, "
       + ", ".join(f"round(({c} - min({c}) OVER ()) / (max({c}) OVER () - min({c}) OVER ()), 6) "
                   f"AS {n}" for n, c in _COLUMNS_SQL.items()) + " FROM lineitem")
def enc_05(spark, sf):
    df = _assembled(spark, sf)
    return _unpacked(
        encode.min_max().fit(df).transform(df), "scaled_features", MEASURED
    )


@query("enc_06_standardise", "SELECT l_orderkey AS order_key, l_linenumber AS line_number, "
       + ", ".join(f"round({c} / stddev_samp({c}) OVER (), 6) AS {n}"
                   for n, c in _COLUMNS_SQL.items()) + " FROM lineitem")
def enc_06(spark, sf):
    df = _assembled(spark, sf)
    return _unpacked(encode.standardise().fit(df).transform(df), "scaledFeatures", MEASURED)


@query("enc_07_principal_components")
def enc_07(spark, sf):
    df = tv.read(spark, sf, "embeddings").select(
        "vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features")
    )
    stages = [encode.standardise(), encode.principal(10)]
    done = Pipeline(stages=stages).fit(df).transform(df)
    parts = vector_to_array("pcaFeatures")
    return done.select("vec_id", *[
        F.round(F.get(parts, F.lit(i)), 6).alias(f"component_{i}") for i in range(10)
    ])


@query("enc_07_components_of_two_features", """
SELECT l_orderkey AS order_key, l_linenumber AS line_number,
       round(abs(x + y) / sqrt(2), 4) AS along, round(abs(x - y) / sqrt(2), 4) AS across
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / stddev_samp(l_extendedprice) OVER () AS x,
             l_extendedprice * l_discount / stddev_samp(l_extendedprice * l_discount) OVER () AS y
      FROM lineitem)""")
def enc_07_two(spark, sf):
    """Two standardised correlated features turn by 45 degrees, up to the sign."""
    df = encode.assemble(["fare_amount", "tolls_amount"], label=LABEL).transform(
        tv.trips(spark, sf, *KEYS, "fare_amount", "tolls_amount")
    )
    done = Pipeline(stages=[encode.standardise(), encode.principal(2)]).fit(df).transform(df)
    parts = vector_to_array("pcaFeatures")
    return done.select(*KEYS, *[
        F.round(F.abs(F.get(parts, F.lit(i))), 4).alias(n) for i, n in enumerate(["along", "across"])
    ])


# models with a closed form ------------------------------------------------


@query("mdl_01_linear_regression", with_tables("""
SELECT order_key, line_number, round(slope * fare_amount + icept) AS prediction
FROM trips, (SELECT regr_slope(total_amount, fare_amount) AS slope,
                    regr_intercept(total_amount, fare_amount) AS icept FROM trips)""", "trips"))
def mdl_01(spark, sf):
    df = encode.assemble(["fare_amount"], label=LABEL).transform(
        tv.trips(spark, sf, *KEYS, "fare_amount", LABEL)
    )
    fitted = models.regressor("linear_reg", "features", LABEL).fit(df)
    # whole units: the solver's last digits depend on the order of its sums
    return fitted.transform(df).select(*KEYS, F.round("prediction").alias("prediction"))


_GROUP_MEAN = with_tables("""
SELECT order_key, line_number, round(avg(total_amount) OVER (PARTITION BY payment_type), 1)
  AS prediction FROM trips""", "trips")


def _fitted_on_code(spark, sf, name, **params):
    """A tree model on the payment code alone: it predicts the mean per code."""
    df = stored_trips(spark, sf, *KEYS, "payment_type", LABEL).withColumn(
        "code", F.col("payment_type").cast("double")
    )
    df = encode.assemble(["code"], label=LABEL).transform(df)
    fitted = models.fit_rows(models.regressor(name, "features", LABEL, **params), df)
    return fitted.transform(df).select(*KEYS, F.round("prediction", 1).alias("prediction"))


@query("mdl_02_decision_tree", _GROUP_MEAN)
def mdl_02(spark, sf):
    return _fitted_on_code(spark, sf, "decision_tree")


@query("mdl_03_random_forest", _GROUP_MEAN)
def mdl_03(spark, sf):
    return _fitted_on_code(spark, sf, "random_forest", bootstrap=False)


@query("mdl_04_gradient_boosting", _GROUP_MEAN)
def mdl_04(spark, sf):
    return _fitted_on_code(spark, sf, "gradient_boosting")


@query("mdl_05_kmeans_on_coordinates")
def mdl_05(spark, sf):
    places = materialise(tv.centroids(spark, sf), "centroids").withColumnRenamed(
        "LocationID", "PULocationID")
    df = tv.trips(spark, sf, *KEYS, "PULocationID").join(places, "PULocationID", "left")
    return models.cluster_points(materialise(df, "places"), ["latitude", "longitude"])


@query("mdl_05_kmeans_of_two_places", with_tables("""
SELECT order_key, line_number, round(latitude, 6) AS latitude, round(longitude, 6) AS longitude
FROM trips JOIN centroids ON LocationID = PULocationID
WHERE LocationID IN (SELECT min(LocationID) FROM centroids UNION SELECT max(LocationID) FROM centroids)""",
    "trips", "centroids"))
def mdl_05_exact(spark, sf):
    """With a cluster for each of two places, every point is its cluster's centre."""
    every = materialise(tv.centroids(spark, sf), "centroids")
    ends = every.agg(F.min("LocationID").alias("a"), F.max("LocationID").alias("b")).first()
    places = every.filter(F.col("LocationID").isin(list(ends))).withColumnRenamed(
        "LocationID", "PULocationID")
    df = materialise(tv.trips(spark, sf, *KEYS, "PULocationID").join(places, "PULocationID"), "places")
    columns = ["latitude", "longitude"]
    found = models.cluster_points(df, columns, k=places.count())
    centres = found.groupBy("prediction").agg(*[F.avg(c).alias(c) for c in columns])
    return found.drop(*columns).join(centres, "prediction").select(
        *KEYS, *[F.round(c, 6).alias(c) for c in columns])


def target_mean_line() -> Pipeline:
    """Target-mean code and a line through it: the mean of each category."""
    return Pipeline(stages=[
        encode.indexer(["payment_type"]),
        encode.target_mean(["payment_type"], LABEL),
        encode.assemble(["payment_type_target"], label=LABEL),
        models.regressor("linear_reg", "features", LABEL),
    ])


@query("pip_01_fit_and_transform", _GROUP_MEAN)
def pip_01(spark, sf):
    df = stored_trips(spark, sf, *KEYS, "payment_type", LABEL)
    return target_mean_line().fit(df).transform(df).select(
        *KEYS, F.round("prediction", 1).alias("prediction")
    )


@query("snk_03_saved_model", _GROUP_MEAN)
def snk_03(spark, sf):
    df = stored_trips(spark, sf, *KEYS, "payment_type", LABEL)
    path = scratch(spark, "model")
    models.save_model(target_mean_line().fit(df), path)
    return models.score(models.load_model(path), df).select(
        *KEYS, F.round("prediction", 1).alias("prediction")
    )


@query("prd_01_batch_scoring", with_tables("""
SELECT o_orderkey, round(m, 1) AS prediction FROM orders
JOIN (SELECT payment_type AS k, avg(total_amount) AS m FROM trips GROUP BY 1)
  ON k IS NOT DISTINCT FROM left(o_orderpriority, 1)""", "trips"))
def prd_01(spark, sf):
    model = target_mean_line().fit(stored_trips(spark, sf, "payment_type", LABEL))
    fresh = tv.read(spark, sf, "orders").select(
        "o_orderkey", F.substring("o_orderpriority", 1, 1).alias("payment_type")
    )
    return models.score(model, fresh).select(
        "o_orderkey", F.round("prediction", 1).alias("prediction")
    )


@query("str_01_score_arriving_files", _GROUP_MEAN)
def str_01(spark, sf):
    model = target_mean_line().fit(stored_trips(spark, sf, "payment_type", LABEL))
    lines = tv.read(spark, sf, "lineitem")
    sink = scratch(spark, "scored")
    arriving = score_arriving(
        spark, model, f"{sf}/lineitem.parquet*", lines.schema, sink,
        scratch(spark, "progress"),
        prepare=lambda df: tv.trips(spark, sf, *KEYS, "payment_type", lines=df),
        output=[*KEYS, "prediction"],
    )
    arriving.awaitTermination()
    return spark.read.parquet(sink).withColumn("prediction", F.round("prediction", 1))


@query("str_01_errors_by_window", with_tables("""
WITH scored AS (
  SELECT DISTINCT order_key, line_number, pickup_datetime AS t, total_amount,
         total_amount - avg(total_amount) OVER (PARTITION BY payment_type) AS e FROM trips)
SELECT CAST(TIMESTAMP '1970-01-01' + to_days(CAST(7 * floor(epoch(t) / 604800) AS INTEGER)) AS TIMESTAMP) AS window_start,
       count(*) AS trips, round(avg(abs(e)), 1) AS mae, round(sqrt(avg(e * e)), 1) AS rmse
FROM scored WHERE t IS NOT NULL
GROUP BY floor(epoch(t) / 604800)
HAVING TIMESTAMP '1970-01-01' + to_days(CAST(7 * floor(epoch(min(t)) / 604800) + 7 AS INTEGER))
       <= (SELECT max(t) FROM scored) - INTERVAL 30 DAY""", "trips"))
def str_01_errors(spark, sf):
    """Errors by week of trips in two arrivals, the second with trips of the first sent again.

    Keys repeat in the test tables, so that a trip is told by its amount, too. Weeks that
    end within 30 days of the latest trip are still open.
    """
    trips = stored_trips(spark, sf, *KEYS, "pickup_datetime", "payment_type", LABEL)
    model = target_mean_line().fit(trips)
    source, sink, progress = (scratch(spark, n) for n in ("arriving", "errors", "progress"))
    day = F.col("pickup_datetime").cast("date")
    first, again = day < "1998-06-01", day.between("1998-04-01", "1998-05-31")
    late = trips.filter(~first | day.isNull()).unionByName(trips.filter(again))
    for turn, arrived in enumerate((trips.filter(first), late)):
        arrived.write.parquet(f"{source}/arrival={turn}")
        error_windows(spark, model, f"{source}/*", trips.schema, sink, progress, [*KEYS, LABEL], LABEL,
                      width="7 days", delay="30 days").awaitTermination()
    found = spark.read.parquet(sink)
    return found.select(
        F.col("window_start"), "trips", F.round(F.col("absolute_sum") / F.col("trips"), 1).alias("mae"),
        F.round(F.sqrt(F.col("square_sum") / F.col("trips")), 1).alias("rmse"))


@query("evl_01_metrics", with_tables("""
SELECT payment_type,
       round(1 - sum((total_amount - fare_amount) ** 2)
               / sum((total_amount - mu) ** 2), 6) AS r2,
       round(avg(abs(total_amount - fare_amount)), 4) AS mae,
       round(sqrt(avg((total_amount - fare_amount) ** 2)), 4) AS rmse
FROM (SELECT *, avg(total_amount) OVER (PARTITION BY payment_type) AS mu FROM trips)
GROUP BY 1""", "trips"))
def evl_01(spark, sf):
    df = tv.trips(spark, sf, "payment_type", "fare_amount", LABEL)
    found = models.metrics(df, LABEL, "fare_amount", by=["payment_type"])
    return found.withColumns({
        "r2": F.round("r2", 6), "mae": F.round("mae", 4), "rmse": F.round("rmse", 4),
    })


# leaderboards and tuning --------------------------------------------------


def model_rows(spark, sf):
    """The project's model table: cleaned, capped and binned trips."""
    return materialise(model_table(stored_features(spark, sf)), "model-rows")


def model_parts(spark, sf):
    return hash_split(model_rows(spark, sf), 80, *schemas.MODEL_COLUMNS)


def _board(df):
    return df.withColumns({
        c: F.round(c, 3) for c in ("validation_r2", "r2", "mae", "rmse")
    }).withColumn("hyperparameters", F.to_json("hyperparameters"))


@query("evl_02_leaderboard")
def evl_02(spark, sf):
    train, test = model_parts(spark, sf)
    return _board(models.leaderboard(
        spark, train, test, schemas.CATEGORICAL, schemas.NUMERIC, LABEL,
        encode.ENCODINGS, list(models.MODELS),
    ))


_ONE_CODE = """
tagged AS (
  SELECT payment_type, total_amount, CAST('0x' || substr(md5(payment_type || '|' || order_key || '|'
           || line_number), 1, 8) AS BIGINT) AS h, order_key, line_number
  FROM trips WHERE payment_type IS NOT NULL)"""


def _one_code(spark, sf):
    """One categorical input, split by a hash of the row's keys."""
    df = stored_trips(spark, sf, "payment_type", *KEYS, LABEL).dropna(subset=["payment_type"])
    parts = hash_split(df, 80, "payment_type", *KEYS)
    return [p.select("payment_type", LABEL) for p in parts]


def _group_mean_sql(*pairs):
    """Metrics on the held-out part of models that predict the mean per code."""
    listed = ", ".join(f"('{e}', '{m}')" for e, m in pairs)
    return with_tables(f"""
WITH {_ONE_CODE},
means AS (SELECT payment_type AS k, avg(total_amount) AS m FROM tagged WHERE h % 100 < 80 GROUP BY 1),
held AS (SELECT total_amount AS y, m AS p FROM tagged JOIN means ON k = payment_type WHERE h % 100 >= 80)
SELECT encoding, model_name, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 4) AS r2,
       round(avg(abs(y - p)), 2) AS mae, round(sqrt(avg((y - p) ** 2)), 2) AS rmse
FROM held, (VALUES {listed}) e(encoding, model_name)
GROUP BY 1, 2""", "trips")


def _held_out(board):
    return board.select("encoding", "model_name", F.round("r2", 4).alias("r2"),
                        F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"))


@query("evl_02_leaderboard_of_group_means", _group_mean_sql(
    *((e, m) for e in ("one_hot", "target_mean") for m in ("linear_reg", "decision_tree"))))
def evl_02_means(spark, sf):
    """With one category as the only input these models predict its mean."""
    train, test = _one_code(spark, sf)
    return _held_out(models.leaderboard(
        spark, train, test, ["payment_type"], [], LABEL, ["one_hot", "target_mean"],
        ["linear_reg", "decision_tree"],
    ))


@query("tun_01_cross_validation_of_group_means", _group_mean_sql(
    ("one_hot", "decision_tree"), ("one_hot", "linear_reg")))
def tun_01_means(spark, sf):
    train, test = _one_code(spark, sf)
    return _held_out(models.leaderboard(
        spark, train, test, ["payment_type"], [], LABEL, ["one_hot"],
        ["linear_reg", "decision_tree"], folds=3,
    ))


def _tuned_means(spark, sf, grids, label=None):
    train, test = _one_code(spark, sf)
    if label is not None:
        train, test = (df.withColumn(LABEL, label) for df in (train, test))
    return models.tune(
        spark, train, test, ["payment_type"], [], LABEL, list(grids), "one_hot", grids)[0]


@query("tun_02_grid_of_group_means", _group_mean_sql(("one_hot", "decision_tree")))
def tun_02_means(spark, sf):
    """Every tree of the grid is deep enough to part five codes."""
    return _held_out(_tuned_means(spark, sf, {"decision_tree": {"maxDepth": [5, 10]}}))


@query("tun_03_split_of_group_means", _group_mean_sql(("one_hot", "gradient_boosting")))
def tun_03_means(spark, sf):
    """The first tree finds the means, and no residual is left to the others."""
    return _held_out(_tuned_means(spark, sf, {"gradient_boosting": {"maxIter": [1, 2]}}))


@query("tun_04_best_of_two_penalties", with_tables("""
SELECT 'linear_reg' AS model_name, 'regParam' AS parameter,
       CASE WHEN count(DISTINCT payment_type) > 1 THEN '0.0' END AS value
FROM trips""", "trips"))
def tun_04_means(spark, sf):
    """Where the code nearly decides the label, a penalty that leaves no coefficient loses."""
    label = F.col("payment_type").cast("double") * 1e7 + F.col(LABEL)
    board = _tuned_means(spark, sf, {"linear_reg": {"regParam": [1e9, 0.0]}}, label)
    return board.select("model_name", F.explode("hyperparameters").alias("parameter", "value"))


_FOLD_SQL = """
dealt AS (
  SELECT *, CAST('0x' || substr(md5('fold|' || order_key || '|' || line_number), 1, 8) AS BIGINT) % {folds} AS fold
  FROM trips)"""


def _dealt(spark, sf, folds, *columns):
    rows = tv.trips(spark, sf, *KEYS, *columns)
    return rows.withColumn("fold", hash_bucket(*KEYS, buckets=folds, salt="fold").cast("int"))


@query("tun_02_penalties_by_fold", with_tables(f"""
WITH {_FOLD_SQL.format(folds=3)},
seen AS (
  SELECT f.fold, regr_slope(total_amount, fare_amount) AS slope, corr(total_amount, fare_amount) AS r,
         stddev_pop(total_amount) AS sy, stddev_pop(fare_amount) AS sx, avg(total_amount) AS my, avg(fare_amount) AS mx
  FROM dealt d JOIN (SELECT DISTINCT fold FROM dealt) f ON d.fold <> f.fold GROUP BY 1),
grid AS (SELECT CAST(strength AS DOUBLE) AS strength, CAST(l1_share AS DOUBLE) AS l1_share
         FROM (VALUES (0.0), (1000.0), (20000.0)) r(strength), (VALUES (0.0), (0.5), (1.0)) e(l1_share)),
lines AS (
  SELECT fold, strength, l1_share, mx, my,
         sign(r) * greatest(abs(r) - strength * l1_share / sy, 0) / (1 + strength * (1 - l1_share) / sy) * sy / sx AS w
  FROM seen, grid)
SELECT strength, l1_share, d.fold, round(1 - sum((total_amount - my - w * (fare_amount - mx)) ** 2)
         / (var_pop(total_amount) * count(*)), 6) AS r2
FROM dealt d JOIN lines l ON d.fold = l.fold GROUP BY ALL""", "trips"))
def tun_02_penalties(spark, sf):
    """R2 of every penalty on every fold: a soft threshold of the one slope."""
    df = _dealt(spark, sf, 3, "fare_amount", LABEL)
    grid = models.grid_points({"regParam": [0.0, 1000.0, 20000.0], "elasticNetParam": [0.0, 0.5, 1.0]})
    found = gram.products(df, gram.describe_columns(df, [], ["fare_amount"], LABEL), "fold", 3)
    scores = gram.cross_validated(found, "one_hot", grid)
    rows = [(p["regParam"], p["elasticNetParam"], f, round(r, 6))
            for p, own in zip(grid, scores.tolist(), strict=True) for f, r in enumerate(own)]
    return spark.createDataFrame(rows, "strength double, l1_share double, fold int, r2 double")


@query("tun_01_folds_of_target_means", with_tables(f"""
WITH {_FOLD_SQL.format(folds=3)},
means AS (
  SELECT f.fold, payment_type AS k, avg(total_amount) AS m
  FROM dealt d JOIN (SELECT DISTINCT fold FROM dealt) f ON d.fold <> f.fold GROUP BY ALL)
SELECT d.fold, round(1 - sum((total_amount - m) ** 2) / (var_pop(total_amount) * count(*)), 6) AS r2
FROM dealt d JOIN means ON d.fold = means.fold AND payment_type IS NOT DISTINCT FROM k GROUP BY 1""", "trips"))
def tun_01_folds(spark, sf):
    """A line through target means predicts the mean per code of the other folds."""
    df = _dealt(spark, sf, 3, "payment_type", LABEL)
    found = gram.products(df, gram.describe_columns(df, ["payment_type"], [], LABEL), "fold", 3)
    [scores] = gram.cross_validated(found, "target_mean", [{}]).tolist()
    return spark.createDataFrame([(f, round(r, 6)) for f, r in enumerate(scores)], "fold int, r2 double")


@query("tun_02_depths_by_fold", with_tables(f"""
WITH {_FOLD_SQL.format(folds=2)},
coded AS (SELECT fold, CAST(payment_type AS INT) AS k, total_amount AS y FROM dealt WHERE payment_type IS NOT NULL),
sums AS (
  SELECT f.fold, k, CAST(count(*) AS DOUBLE) AS n, sum(y) AS s
  FROM coded d JOIN (SELECT DISTINCT fold FROM coded) f ON d.fold <> f.fold GROUP BY ALL),
sides AS (
  SELECT fold, k, sum(n) OVER low AS n1, sum(s) OVER low AS s1,
         sum(n) OVER (PARTITION BY fold) AS n, sum(s) OVER (PARTITION BY fold) AS s
  FROM sums WINDOW low AS (PARTITION BY fold ORDER BY k)),
split AS (
  SELECT fold, arg_max(k, s1 * s1 / n1 + (s - s1) ** 2 / (n - n1)) AS up_to,
         arg_max(s1 / n1, s1 * s1 / n1 + (s - s1) ** 2 / (n - n1)) AS low_mean,
         arg_max((s - s1) / (n - n1), s1 * s1 / n1 + (s - s1) ** 2 / (n - n1)) AS high_mean
  FROM sides WHERE n > n1 GROUP BY 1),
predicted AS (
  SELECT 1 AS depth, coded.fold, y, CASE WHEN k <= up_to THEN low_mean ELSE high_mean END AS p
  FROM coded JOIN split ON coded.fold = split.fold
  UNION ALL
  SELECT 4, coded.fold, y, s / n FROM coded JOIN sums ON coded.fold = sums.fold AND coded.k = sums.k)
SELECT depth, fold, round(1 - sum((y - p) ** 2) / (var_pop(y) * count(*)), 6) AS r2
FROM predicted GROUP BY 1, 2""", "trips"))
def tun_02_depths(spark, sf):
    """One deep tree per fold, scored at depth 1 (its best split) and at depth 4 (a mean per code)."""
    df = _dealt(spark, sf, 2, "payment_type", LABEL).dropna(subset=["payment_type"])
    df = encode.assemble(["code"], label=LABEL).transform(
        df.withColumn("code", F.col("payment_type").cast("double"))).select("features", LABEL, "fold")
    df, rows = materialise(df, "codes"), []
    for fold in range(2):
        parts = models.Encoded(None, "features", df.where(F.col("fold") != fold), df.where(F.col("fold") == fold))
        scores = models.nested_scores("decision_tree", parts, LABEL, [{"maxDepth": 1}, {"maxDepth": 4}])
        rows += [(d, fold, round(r, 6)) for d, r in zip((1, 4), scores, strict=True)]
    return spark.createDataFrame(rows, "depth int, fold int, r2 double")


@query("tun_01_cross_validation")
def tun_01(spark, sf):
    train, test = model_parts(spark, sf)
    return _board(models.leaderboard(
        spark, train, test, schemas.CATEGORICAL, schemas.NUMERIC, LABEL,
        encode.ENCODINGS, list(models.MODELS), folds=3,
    ))


def _tuned(spark, sf, *names):
    train, test = model_parts(spark, sf)
    board, best = models.tune(
        spark, train, test, schemas.CATEGORICAL, schemas.NUMERIC, LABEL, list(names)
    )
    return board, best


@query("tun_02_grid_cross_validation")
def tun_02(spark, sf):
    return _board(_tuned(spark, sf, "linear_reg", "decision_tree")[0])


@query("tun_03_grid_validation_split")
def tun_03(spark, sf):
    return _board(_tuned(spark, sf, "random_forest", "gradient_boosting")[0])


@query("tun_04_best_parameters")
def tun_04(spark, sf):
    board, _ = _tuned(spark, sf, *models.MODELS)
    return board.select("model_name", F.explode("hyperparameters").alias("parameter", "value"))


# importance and tests -----------------------------------------------------


@contextmanager
def importance_frame(spark, sf):
    """Encoded and scaled trips with their feature names, kept for several fits."""
    pipeline, names = encode.importance_inputs(schemas.CATEGORICAL, schemas.NUMERIC, LABEL)
    df = model_rows(spark, sf)
    prepared = pipeline.fit(df).transform(df).select("features", LABEL, *names).persist()
    try:
        yield prepared, names
    finally:
        prepared.unpersist()


def _rounded(df, column):
    return df.withColumn(column, F.round(column, 4))


@query("imp_01_forest_importance")
def imp_01(spark, sf):
    with importance_frame(spark, sf) as (df, names):
        return _rounded(importance.forest_importance(df, names, LABEL)[0], "rf_importance")


@query("imp_02_boosting_importance")
def imp_02(spark, sf):
    with importance_frame(spark, sf) as (df, names):
        return _rounded(importance.boosting_importance(df, names, LABEL), "gbt_importance")


@query("imp_03_lasso_importance")
def imp_03(spark, sf):
    with importance_frame(spark, sf) as (df, names):
        return _rounded(importance.lasso_importance(df, names, LABEL), "lasso_importance")


@query("imp_04_ranked_features")
def imp_04(spark, sf):
    with importance_frame(spark, sf) as (df, names):
        return _rounded(importance.ranked_elimination(df, names, LABEL), "rfe_score")


@query("imp_05_permutation_importance")
def imp_05(spark, sf):
    with importance_frame(spark, sf) as (df, names):
        _, model = importance.forest_importance(df, names, LABEL)
        found = importance.permutation_importance(df, model, names)
        return _rounded(found, "permutation_importance")


@query("imp_05_attribution")
def imp_05_attribution(spark, sf):
    """Mean absolute contribution of every feature to a forest's predictions."""
    with importance_frame(spark, sf) as (df, names):
        _, model = importance.forest_importance(df, names, LABEL)
        return _rounded(treetables.mean_attributions(df, model, names), "mean_attribution")


# two yes-or-no inputs: the forest's trees are all the same, with the input of the larger
# gain at the root, so the value of each set of known inputs is a mean that SQL can state
_TWO_INPUTS = """
cells AS (
  SELECT CAST(passenger_count > 25 AS INT) AS a, CAST(improvement_surcharge > 0.04 AS INT) AS b,
         CAST(count(*) AS DOUBLE) AS n,
         sum(total_amount + CASE WHEN improvement_surcharge > 0.04 THEN 15000 ELSE 0 END) AS s
  FROM trips GROUP BY 1, 2),
known AS (
  SELECT a, b, n, s / n AS m, sum(s) OVER () / sum(n) OVER () AS f0,
         sum(s) OVER (PARTITION BY a) / sum(n) OVER (PARTITION BY a) AS mean_a,
         sum(s) OVER (PARTITION BY b) / sum(n) OVER (PARTITION BY b) AS mean_b,
         sum(n) OVER (PARTITION BY a) / sum(n) OVER () AS p_a,
         sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS p_b
  FROM cells),
rooted AS (
  SELECT *, sum(n * (mean_a - f0) ** 2) OVER () >= sum(n * (mean_b - f0) ** 2) OVER () AS a_first,
         sum(p_a * m) OVER (PARTITION BY b) AS spread_b, sum(p_b * m) OVER (PARTITION BY a) AS spread_a
  FROM known),
valued AS (
  SELECT *, CASE WHEN a_first THEN mean_a ELSE spread_a END AS f_a,
         CASE WHEN a_first THEN spread_b ELSE mean_b END AS f_b
  FROM rooted),
attributed AS (
  SELECT a, b, n, (f_a - f0 + m - f_b) / 2 AS contribution_a, (f_b - f0 + m - f_a) / 2 AS contribution_b
  FROM valued)"""


def _two_inputs(spark, sf):
    """Trips with two yes-or-no inputs, and a forest that reproduces the mean of each pair."""
    more = F.col("improvement_surcharge") > 0.04
    df = tv.trips(spark, sf, "passenger_count", "improvement_surcharge", LABEL).select(
        (F.col("passenger_count") > 25).cast("double").alias("a"), more.cast("double").alias("b"),
        (F.col(LABEL) + F.when(more, 15000).otherwise(0)).alias(LABEL))
    df = materialise(encode.assemble(["a", "b"], label=LABEL).transform(df), "two-inputs")
    forest = models.fit_rows(models.regressor(
        "random_forest", "features", LABEL, bootstrap=False, featureSubsetStrategy="all"), df)
    return df, forest


# the root takes the spread between its two sides, the other input what is left between the pairs
_TWO_GAINS = f"""
WITH {_TWO_INPUTS},
gains AS (
  SELECT sum(n * (m - f0) ** 2) AS pairs, sum(n * (mean_a - f0) ** 2) AS of_a, sum(n * (mean_b - f0) ** 2) AS of_b,
         any_value(a_first) AS a_first
  FROM rooted)
SELECT 'a' AS feature, round(CASE WHEN a_first THEN of_a ELSE pairs - of_b END / pairs, 4) AS {{0}} FROM gains
UNION ALL
SELECT 'b', round(CASE WHEN a_first THEN pairs - of_a ELSE of_b END / pairs, 4) FROM gains"""


@query("imp_01_forest_of_two_inputs", with_tables(_TWO_GAINS.format("rf_importance"), "trips"))
def imp_01_two(spark, sf):
    df, _ = _two_inputs(spark, sf)
    return _rounded(importance.forest_importance(
        df, ["a", "b"], LABEL, bootstrap=False, featureSubsetStrategy="all")[0], "rf_importance")


@query("imp_02_boosting_of_two_inputs", with_tables(_TWO_GAINS.format("gbt_importance"), "trips"))
def imp_02_two(spark, sf):
    df, _ = _two_inputs(spark, sf)
    return _rounded(importance.boosting_importance(df, ["a", "b"], LABEL), "gbt_importance")


@query("imp_03_lasso_of_two_inputs", with_tables("""
WITH seen AS (
  SELECT corr(fare_amount, total_amount) AS c1, corr(tolls_amount, total_amount) AS c2,
         corr(fare_amount, tolls_amount) AS r, stddev_pop(fare_amount) AS s1, stddev_pop(tolls_amount) AS s2,
         2000 / stddev_pop(total_amount) AS l
  FROM trips),
signed AS (SELECT *, sign(c1 - r * c2) AS g1, sign(c2 - r * c1) AS g2 FROM seen),
active AS (
  SELECT (c1 - l * g1 - r * (c2 - l * g2)) / (1 - r * r) AS w1, (c2 - l * g2 - r * (c1 - l * g1)) / (1 - r * r) AS w2,
         c1, c2, r, l, s1, s2, g1, g2
  FROM signed),
solved AS (  -- where one of both loses its sign, it is out and the other alone is thresholded
  SELECT CASE WHEN w1 * g1 > 0 AND w2 * g2 > 0 THEN abs(w1) WHEN abs(c1) >= abs(c2) THEN greatest(abs(c1) - l, 0) ELSE 0
         END / s1 AS a,
         CASE WHEN w1 * g1 > 0 AND w2 * g2 > 0 THEN abs(w2) WHEN abs(c2) > abs(c1) THEN greatest(abs(c2) - l, 0) ELSE 0
         END / s2 AS b
  FROM active)
SELECT 'fare_amount' AS feature, round(a / (a + b), 3) AS lasso_importance FROM solved
UNION ALL
SELECT 'tolls_amount', round(b / (a + b), 3) FROM solved""", "trips"))
def imp_03_two(spark, sf):
    names = ["fare_amount", "tolls_amount"]
    df = encode.assemble(names, label=LABEL).transform(stored_trips(spark, sf, *names, LABEL))
    return importance.lasso_importance(df, names, LABEL, strength=2000.0).withColumn(
        "lasso_importance", F.round("lasso_importance", 3))


@query("imp_05_attribution_of_two_inputs", with_tables(f"""
WITH {_TWO_INPUTS}
SELECT a, b, CAST(n AS BIGINT) AS n, round(contribution_a, 2) AS contribution_a,
       round(contribution_b, 2) AS contribution_b
FROM attributed""", "trips"))
def imp_05_two(spark, sf):
    df, forest = _two_inputs(spark, sf)
    cells = df.groupBy("a", "b").agg(F.count("*").alias("n"))
    cells = encode.assemble(["a", "b"]).transform(cells)
    return treetables.attributions(cells, forest).select(
        F.col("a").cast("int").alias("a"), F.col("b").cast("int").alias("b"), "n",
        *[F.round(F.get("contributions", F.lit(i)), 2).alias(f"contribution_{c}") for i, c in enumerate("ab")])


@query("imp_05_mean_attribution_of_two_inputs", with_tables(f"""
WITH {_TWO_INPUTS}
SELECT 'a' AS feature, round(sum(n * abs(contribution_a)) / sum(n), 2) AS mean_attribution FROM attributed
UNION ALL
SELECT 'b', round(sum(n * abs(contribution_b)) / sum(n), 2) FROM attributed""", "trips"))
def imp_05_two_means(spark, sf):
    df, forest = _two_inputs(spark, sf)
    return treetables.mean_attributions(df, forest, ["a", "b"]).withColumn(
        "mean_attribution", F.round("mean_attribution", 2))


@query("imp_06_merged_importance")
def imp_06(spark, sf):
    with importance_frame(spark, sf) as (df, names):
        forest, model = importance.forest_importance(df, names, LABEL)
        merged = importance.merged_importance({
            "rf_importance": forest,
            "gbt_importance": importance.boosting_importance(df, names, LABEL),
            "lasso_importance": importance.lasso_importance(df, names, LABEL),
            "rfe_score": importance.ranked_elimination(df, names, LABEL, step=1),
            "permutation_importance": importance.permutation_importance(df, model, names),
            "attribution_importance": importance.attribution_importance(df, model, names),
        })
        return _rounded(merged, "average_importance")


# one input decides the label, the others never change ------------------------

_INFORMATIVE = ["fare_amount", "constant_a", "constant_b"]


def _informative_sql(column):
    nothing = "var_pop(0 * fare_amount)"
    spread = {"fare_amount": "var_pop(fare_amount)", "constant_a": nothing, "constant_b": nothing}
    return with_tables("\nUNION ALL\n".join(
        f"SELECT '{c}' AS feature, CAST(CASE WHEN {v} > 0 THEN 1 ELSE 0 END AS DOUBLE) AS {column} FROM trips"
        for c, v in spread.items()), "trips")


def _informative(spark, sf):
    df = stored_trips(spark, sf, "fare_amount", LABEL).withColumns(
        {c: F.lit(v) for c, v in zip(_INFORMATIVE[1:], (1.0, 0.0))})
    return encode.assemble(_INFORMATIVE, label=LABEL).transform(df)


def _informative_scores(df):
    forest, model = importance.forest_importance(df, _INFORMATIVE, LABEL)
    return {
        "rf_importance": forest,
        "gbt_importance": importance.boosting_importance(df, _INFORMATIVE, LABEL, iterations=5),
        "lasso_importance": importance.lasso_importance(df, _INFORMATIVE, LABEL),
        "rfe_score": importance.ranked_elimination(df, _INFORMATIVE, LABEL),
        "permutation_importance": importance.permutation_importance(df, model, _INFORMATIVE),
    }


@query("imp_01_forest_of_one_input", _informative_sql("rf_importance"))
def imp_01_one(spark, sf):
    return _rounded(importance.forest_importance(_informative(spark, sf), _INFORMATIVE, LABEL)[0],
                    "rf_importance")


@query("imp_02_boosting_of_one_input", _informative_sql("gbt_importance"))
def imp_02_one(spark, sf):
    return _rounded(importance.boosting_importance(
        _informative(spark, sf), _INFORMATIVE, LABEL, iterations=5), "gbt_importance")


@query("imp_03_lasso_of_one_input", _informative_sql("lasso_importance"))
def imp_03_one(spark, sf):
    return _rounded(importance.lasso_importance(_informative(spark, sf), _INFORMATIVE, LABEL),
                    "lasso_importance")


@query("imp_04_ranking_of_one_input", _informative_sql("rfe_score"))
def imp_04_one(spark, sf):
    return _rounded(importance.ranked_elimination(_informative(spark, sf), _INFORMATIVE, LABEL), "rfe_score")


@query("imp_05_permutation_of_one_input", _informative_sql("permutation_importance"))
def imp_05_one(spark, sf):
    df = _informative(spark, sf)
    line = models.regressor("linear_reg", "features", LABEL).fit(df)
    return _rounded(importance.permutation_importance(df, line, _INFORMATIVE), "permutation_importance")


@query("imp_06_merge_of_one_input", _informative_sql("average_importance"))
def imp_06_one(spark, sf):
    merged = importance.merged_importance(_informative_scores(_informative(spark, sf)))
    return _rounded(merged, "average_importance").select("feature", "average_importance")


def _chi_square_sql(columns, label):
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*columns, label])
    return "\nUNION ALL\n".join(f"""
SELECT '{c}' AS feature, n * (sum(o * o * 1.0 / (r * k)) - 1) AS statistic,
       CAST((count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS BIGINT) AS degrees_of_freedom
FROM (SELECT *, sum(o) OVER (PARTITION BY a) AS r, sum(o) OVER (PARTITION BY b) AS k,
             sum(o) OVER () AS n
      FROM (SELECT {c} AS a, {label} AS b, CAST(count(*) AS DOUBLE) AS o
            FROM trips WHERE {complete} GROUP BY 1, 2))
GROUP BY n""" for c in columns)


# five codes: the degrees of freedom are even, and the tail is a finite sum
@query("sta_01_chi_square", with_tables(f"""
WITH tested AS ({_chi_square_sql(["DOLocationID", "passenger_count"], "payment_type")})
SELECT feature, round(statistic, 4) AS statistic, degrees_of_freedom,
       round(list_sum(list_transform(range(degrees_of_freedom // 2), lambda i:
         exp(i * ln(statistic / 2) - statistic / 2 - lgamma(i + 1)))), 6) AS p_value
FROM tested""", "trips"))
def sta_01(spark, sf):
    columns = ["DOLocationID", "passenger_count"]
    found = importance.chi_square(
        tv.trips(spark, sf, *columns, "payment_type"), columns, "payment_type"
    )
    return found.select("feature", F.round("statistic", 4).alias("statistic"),
                        "degrees_of_freedom", F.round("p_value", 6).alias("p_value"))
