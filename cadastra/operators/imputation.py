"""Statistical imputation of values: training rows from near regions, capped; regression; caps, scales, scores.

Models are fitted with Spark's own learners over distributed rows; what is
drawn at random is drawn by hashes of keys, so that it comes out alike again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cadastra.operators.geometry import haversine


def region_table(df: DataFrame, region: str, lat: str, lon: str, value: str) -> DataFrame:
    """(region, lat, lon, rows, labelled): centre and numbers of rows of each region."""
    return df.where(F.col(region).isNotNull()).groupBy(region).agg(F.avg(lat).alias("lat"), F.avg(lon).alias("lon"), F.count(F.lit(1)).alias("rows"), F.count(value).alias("labelled"))


def region_distances(regions: DataFrame, region: str, most_km: float, cell_degrees: float = 1.0) -> DataFrame:
    """(target, donor, km) of regions at most `most_km` apart, each with itself.

    Regions meet in cells of their latitude, as high as the reach, so that only neighbouring bands are compared.
    """
    band = most_km / 111.0 if most_km > 0 else cell_degrees
    a = regions.select(F.col(region).alias("target"), F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"), F.explode(F.array(*(F.floor(F.col("lat") / band) + d for d in (-1, 0, 1)))).alias("band"))
    b = regions.select(F.col(region).alias("donor"), F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), F.floor(F.col("lat") / band).alias("band"))
    km = haversine(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")) / 1000
    return a.join(b, "band").withColumn("km", km).where(F.col("km") <= most_km).select("target", "donor", "km")


def neighbour_orders(neighbours: DataFrame, a: str, b: str, most: int, path: str) -> DataFrame:
    """(region, other, order): least number of borders between two regions, up to `most`; stored below `path` step by step."""
    spark = neighbours.sparkSession
    one = neighbours.select(F.col(a).alias("region"), F.col(b).alias("other"))
    one = one.union(one.select("other", "region")).where("region <> other").distinct()
    found = one.withColumn("order", F.lit(1))
    for k in range(2, most + 1):
        step = found.where(F.col("order") == k - 1).select("region", F.col("other").alias("via")).join(one.select(F.col("region").alias("via"), "other"), "via")
        new = step.where("region <> other").select("region", "other").distinct().join(found.select("region", "other"), ["region", "other"], "left_anti")
        found.unionByName(new.withColumn("order", F.lit(k))).write.mode("overwrite").parquet(f"{path}/orders{k}")
        found = spark.read.parquet(f"{path}/orders{k}")
    return found


def donor_weight(km: Column, half_km: float = 100.0, own: float = 2.0) -> Column:
    """Weight of a donor region: halves every `half_km`; the region itself counts `own` times."""
    return F.when(km == 0, F.lit(own)).otherwise(F.pow(F.lit(0.5), km / half_km))


def training_rows(labelled: DataFrame, pairs: DataFrame, region: str, key: str, per_donor: int, seed: int = 0, leave_out: bool = False) -> DataFrame:
    """labelled rows by `target` region with `weight`: all of its own and up to `per_donor` of each other donor.

    Donors' rows are cut once by the least hashes of their keys, before they meet targets.  With leave_out, a target has no
    rows of its own, as for scoring.
    """
    w = Window.partitionBy(region).orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)
    ranked = labelled.withColumn("__rank", F.row_number().over(w)).withColumnRenamed(region, "donor")
    met = pairs.select("target", "donor", donor_weight(F.col("km")).alias("weight")).join(ranked, "donor")
    own = F.col("target") == F.col("donor")
    return met.where(~own & (F.col("__rank") <= per_donor) if leave_out else own | (F.col("__rank") <= per_donor)).drop("__rank")


def fit_log_linear(rows: DataFrame, features: list[str], label: str, weight: str):
    """(model, smearing): weighted regression of the label's logarithm, and the factor that makes means come out right."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    usable = rows.where(F.col(label) > 0).dropna(subset=features).withColumn("__y", F.log(label))
    wide = VectorAssembler(inputCols=features, outputCol="__x").transform(usable)
    model = LinearRegression(featuresCol="__x", labelCol="__y", weightCol=weight, predictionCol="__log", regParam=1e-6).fit(wide)
    fitted = model.transform(wide)
    smear = fitted.agg((F.sum(F.exp(F.col("__y") - F.col("__log")) * F.col(weight)) / F.sum(weight))).first()[0]
    return model, float(smear)


def predict_log_linear(df: DataFrame, fitted, features: list[str], out: str) -> DataFrame:
    """df with the expected label; null where a feature is missing."""
    model, smear = fitted
    total = F.lit(float(model.intercept))
    for c, w in zip(features, model.coefficients, strict=True):
        total = total + F.col(c) * F.lit(float(w))
    return df.withColumn(out, F.exp(total) * F.lit(smear))


def fit_share(rows: DataFrame, features: list[str], label: str, weight: str):
    """Weighted logistic regression of a 0/1 label."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    wide = VectorAssembler(inputCols=features, outputCol="__x").transform(rows.dropna(subset=[*features, label]))
    return LogisticRegression(featuresCol="__x", labelCol=label, weightCol=weight, regParam=1e-4).fit(wide)


def predict_share(df: DataFrame, model, features: list[str], out: str) -> DataFrame:
    total = F.lit(float(model.intercept))
    for c, w in zip(features, model.coefficients, strict=True):
        total = total + F.col(c) * F.lit(float(w))
    return df.withColumn(out, 1 / (1 + F.exp(-total)))


def area_caps(df: DataFrame, kind: str, value: str, area: str, quantile: float = 0.999) -> DataFrame:
    """(kind, cap): that quantile of value per area, of each class; the row with a null kind holds that of all."""
    rate = F.col(value) / F.col(area)
    rows = df.where((F.col(area) > 0) & (F.col(value) > 0)).withColumn("__r", rate)
    each = rows.where(F.col(kind).isNotNull()).groupBy(kind).agg(F.percentile("__r", quantile).alias("cap"))
    return each.unionByName(rows.agg(F.percentile("__r", quantile).alias("cap")).select(F.lit(None).cast(df.schema[kind].dataType).alias(kind), "cap"))


def clipped(df: DataFrame, caps: DataFrame, kind: str, value: str, area: str) -> DataFrame:
    """Values above their class's cap times the area become that; classes without a cap have the overall one."""
    overall = caps.where(F.col(kind).isNull()).select(F.max("cap").alias("__all"))
    joined = df.join(caps.where(F.col(kind).isNotNull()).withColumnRenamed("cap", "__cap"), kind, "left").join(F.broadcast(overall))
    most = F.coalesce("__cap", "__all") * F.col(area)
    return joined.withColumn(value, F.when(most.isNotNull() & F.col(value).isNotNull(), F.least(F.col(value), most)).otherwise(F.col(value))).select(*df.columns)


def scales(index: DataFrame, region: str, year: str, level: str, common: int) -> DataFrame:
    """(region, year, scale): what takes a year's values to those of the common year; null where that has no index."""
    base = index.where(F.col(year) == common).select(region, F.col(level).alias("__base"))
    return index.join(base, region, "left").select(region, year, F.try_divide("__base", level).alias("scale"))


def continued(index: DataFrame, wider: DataFrame, region: str, state: str, year: str, level: str) -> DataFrame:
    """Index of regions, continued in years that only their state has, at the state's growth since the region's last year; filled rows say so."""
    last = index.where(F.col(level).isNotNull()).groupBy(region, state).agg(F.max_by(level, year).alias("__level"), F.max(year).alias("__year"))
    grown = last.join(wider.select(state, F.col(year).alias("__year"), F.col(level).alias("__then")), [state, "__year"])
    later = grown.join(wider.select(state, year, F.col(level).alias("__now")), state).where(F.col(year) > F.col("__year"))
    new = later.select(region, state, year, (F.col("__level") * F.try_divide("__now", "__then")).alias(level), F.lit(True).alias("continued"))
    return index.where(F.col(level).isNotNull()).select(region, state, year, level, F.lit(False).alias("continued")).unionByName(new)


def void_implausible(df: DataFrame, bounds: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    """Values outside their bounds, and those that aren't numbers, become null."""

    def kept(c: str, low: float | None, high: float | None) -> Column:
        x = F.col(c)
        ok = ~F.isnan(x.cast("double"))
        ok = ok & (x >= low) if low is not None else ok
        return F.when(ok & (x <= high) if high is not None else ok, x)

    return df.withColumns({c: kept(c, *b) for c, b in bounds.items()})


def place_gravity(points: DataFrame, places: DataFrame, point_id: str, size: str, reach_km: float, least_km: float = 1.0) -> DataFrame:
    """(point, gravity, nearest_km): sum of size over squared distance of the places within reach, and the nearest of them.

    Points and places meet in bands of latitude and longitude as wide as the reach at the point's latitude.
    """
    step = reach_km / 111.0
    around = F.explode(F.sequence(F.lit(-1), F.lit(1)))
    a = points.select(point_id, F.col("lat").alias("a_lat"), F.col("lon").alias("a_lon"), F.floor(F.col("lat") / step).alias("g")).select("*", around.alias("d")).withColumn("band", F.col("g") + F.col("d"))
    b = places.select(F.col(size).alias("__size"), F.col("lat").alias("b_lat"), F.col("lon").alias("b_lon"), F.floor(F.col("lat") / step).alias("band"))
    km = haversine(F.col("a_lat"), F.col("a_lon"), F.col("b_lat"), F.col("b_lon")) / 1000
    near = a.join(b, "band").withColumn("km", km).where(F.col("km") <= reach_km)
    found = near.groupBy(point_id).agg(F.sum(F.col("__size") / F.pow(F.greatest(F.col("km"), F.lit(least_km)), 2)).alias("gravity"), F.min("km").alias("nearest_km"))
    return points.select(point_id).join(found, point_id, "left").select(point_id, F.coalesce("gravity", F.lit(0.0)).alias("gravity"), "nearest_km")


def score(df: DataFrame, by: str, truth: str, predicted: str) -> DataFrame:
    """Per group: rows, bias of the total, mean absolute error and median of the relative error, over rows that have both."""
    rows = df.where(F.col(truth).isNotNull() & F.col(predicted).isNotNull())
    off = F.abs(F.col(predicted) - F.col(truth))
    return rows.groupBy(by).agg(
        F.count(F.lit(1)).alias("rows"),
        (F.try_divide(F.sum(predicted), F.sum(truth)) - 1).alias("total_bias"),
        F.avg(off).alias("mean_error"),
        F.median(F.try_divide(off, F.abs(F.col(truth)))).alias("typical_miss"),
    )
