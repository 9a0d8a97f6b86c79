"""Queries for spectral features (I08), bump wavelets (H09), STL features and MARS."""

from pyspark.sql import functions as F

from chronoweave.operators import diagnostics, mars, spectral, stl
from chronoweave.operators.baselines import MODEL, YHAT
from chronoweave.panel import DS, ID, Y
from chronoweave.plans.catalog_diagnostics import padded_daily
from chronoweave.plans.catalog_ml import ml_split
from chronoweave.plans.catalog_models import nation_padded, r6
from chronoweave.plans.registry import register


@register("H09_bump_wavelet", None, ids=("H09",))
def h09(spark, sf):
    return spectral.augment_bump_wavelet(padded_daily(spark, sf), Y, (2, 7), freq="D")


@register("I08_tsfeatures", None, ids=("I08",))
def i08(spark, sf):
    """Frequency, STL strengths, spectral entropy, autocorrelations and a user mean per series, of the scaled values."""
    d = nation_padded(spark, sf)
    s = d.groupBy(ID).agg(F.avg(Y).alias("m"), F.stddev_samp(Y).alias("sd"))
    z = d.join(s, ID).select(ID, DS, F.try_divide(F.col(Y) - F.col("m"), F.col("sd")).alias(Y))
    strength = diagnostics.seasonal_strength(stl.stl(z, Y, 12, 13, freq="M", digits=None))
    a = diagnostics.acf(z, Y, 12, freq="M").where(F.col("lag").isin(1, 12)).groupBy(ID).pivot("lag", [1, 12]).agg(F.first("acf"))
    spec = spectral.spectral_features(z, Y, 64, "M")
    mean = diagnostics.user_features(d, {"my_mean": F.avg})
    out = mean.withColumn("frequency", F.lit(12)).join(strength, ID).join(spec.drop("segments"), ID).join(a, ID)
    return out.select(ID, *[F.round(F.col(c).cast("double"), 6).alias(f"ts_{n}") for c, n in (
        ("frequency", "frequency"), ("trend_strength", "trend"), ("seasonal_strength", "seasonal_strength"), ("spectral_entropy", "entropy"),
        ("dominant_period", "dominant_period"), ("1", "x_acf1"), ("12", "seas_acf1"), ("my_mean", "my_mean"))])


@register("N06_mars", None, ids=("N06",))
def n06(spark, sf):
    """Forward and backward selected hinge products on the lag, calendar and Fourier columns of the feature panel."""
    tr, te, feats = ml_split(spark, sf)
    inputs = [c for c in ("y_lag_56", "ds_yday", "ds_wday", "ds_index_num", "y_lag_56_rolling_mean_win_7") if c in tr.columns]
    m = mars.fit_mars(tr, inputs, Y, max_terms=11, degree=2, knots=10)
    rows = te.dropna(subset=inputs)
    return r6(rows.select(ID, DS, F.lit("MARS").alias(MODEL), m.column().alias(YHAT)))
