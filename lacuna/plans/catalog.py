"""Query catalog: one callable (spark, sf_dir) → DataFrame per inventory key.

Each query derives its domain table from the driver tables (``lacuna.sources.driver_tables``),
runs the operator over the whole table, and rounds floating outputs to 6 digits so the result
can be compared with the DuckDB oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lacuna.sources import driver_tables as dt
from lacuna.operators import series as S
from lacuna.operators.impute.linear import impute_linear

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def monthly_levels(spark: SparkSession, sf: str) -> DataFrame:
    """readings → D3 monthly mean → C7 dense monthly grid (station_id, month, level, lon, lat)."""
    m = S.monthly_mean_by_station(dt.readings(spark, sf))
    return S.densify(m)


# ---------------------------------------------------------------- minimum slice
@query("impute_linear")
def q_impute_linear(spark, sf):
    g = monthly_levels(spark, sf)
    return rounded(impute_linear(g, "level", out="filled").select("station_id", "month", "level", "filled"))


@query("monthly_mean_by_station")
def q_monthly_mean(spark, sf):
    return rounded(S.monthly_mean_by_station(dt.readings(spark, sf)))


@query("densify_series")
def q_densify(spark, sf):
    return rounded(monthly_levels(spark, sf))



# ---------------------------------------------------------------- fusion (flagship)
from lacuna.operators import weather as W  # noqa: E402
from lacuna.operators import spatial as SP  # noqa: E402
from lacuna.plans.fusion import fuse  # noqa: E402


def pet_monthly(spark, sf):
    return W.monthly_by_point(dt.pet_daily(spark, sf), "pet", "time", "sum")


@query("monthly_sum_by_point")
def q_monthly_sum_by_point(spark, sf):
    return rounded(pet_monthly(spark, sf))


@query("monthly_mean_by_point")
def q_monthly_mean_by_point(spark, sf):
    return rounded(W.monthly_by_point(dt.pet_daily(spark, sf), "pet", "time", "mean"))


@query("nearest_valid_join")
def q_nearest_valid_join(spark, sf):
    f = fuse(dt.readings(spark, sf), dt.points(spark, sf), pet_monthly(spark, sf))
    return rounded(f.select("station_id", "month", "level", "lon", "lat", "pet", "rain", "temp"))


@query("nearest_reference_year_join")
def q_nearest_reference_year_join(spark, sf):
    g = monthly_levels(spark, sf).select("station_id", F.add_months("month", 24 * 12).alias("month"), "lat", "lon")
    out = SP.nearest_reference_year_join(g, dt.soil(spark, sf))
    return rounded(out.select("station_id", "month", "sealed_area", "total_area"))


FLAGSHIP = "nearest_valid_join"


# ---------------------------------------------------------------- profiling, clustering, windows
from lacuna.operators import profile as P  # noqa: E402
from lacuna.operators import cluster as CL  # noqa: E402


def clustered(spark, sf):
    return CL.assign_clusters(monthly_levels(spark, sf), "level")


@query("availability_by_month")
def q_availability(spark, sf):
    return P.availability_by_month(dt.points(spark, sf), ["rain", "temp"])


@query("calendar_left_join")
def q_calendar_left_join(spark, sf):
    return P.calendar_left_join(dt.readings(spark, sf), ["level"], time="time")


@query("missing_months_by_year")
def q_missing_months(spark, sf):
    return P.missing_months_by_year(dt.points(spark, sf), ["rain", "temp"])


@query("fill_ratio")
def q_fill_ratio(spark, sf):
    return rounded(P.fill_ratio(monthly_levels(spark, sf), ["level", "lon", "lat"]))


@query("activity_span")
def q_activity_span(spark, sf):
    return P.activity_span(monthly_levels(spark, sf), ["level"])


@query("presence_matrix")
def q_presence(spark, sf):
    return P.presence_matrix(dt.sparse_readings(spark, sf), "level")


@query("distinct_stations")
def q_distinct_stations(spark, sf):
    return rounded(P.distinct_stations(dt.readings(spark, sf)))


@query("seasonal_median")
def q_seasonal_median(spark, sf):
    return rounded(P.seasonal_median(monthly_levels(spark, sf), "level"))


@query("station_constants")
def q_station_constants(spark, sf):
    return rounded(P.station_constants(monthly_levels(spark, sf), ["lon", "lat", "level"]))


@query("value_range_padded")
def q_value_range(spark, sf):
    return rounded(P.value_range_padded(monthly_levels(spark, sf), "level"))


@query("station_dimension")
def q_station_dimension(spark, sf):
    return rounded(P.station_dimension(clustered(spark, sf)))


@query("fluctuation_index")
def q_fluctuation_index(spark, sf):
    return rounded(CL.fluctuation_index(monthly_levels(spark, sf), "level"))


@query("fluctuation_class")
def q_fluctuation_class(spark, sf):
    return rounded(CL.fluctuation_class(CL.fluctuation_index(monthly_levels(spark, sf), "level")))


@query("cluster_two_way")
def q_cluster_two_way(spark, sf):
    return rounded(CL.cluster_two_way(CL.fluctuation_index(monthly_levels(spark, sf), "level")))


@query("duration_buckets")
def q_duration_buckets(spark, sf):
    return CL.duration_buckets(monthly_levels(spark, sf), "level")


@query("streak_buckets")
def q_streak_buckets(spark, sf):
    return CL.streak_buckets(dt.sparse_readings(spark, sf), "level")


@query("cluster_counts")
def q_cluster_counts(spark, sf):
    return CL.cluster_counts(clustered(spark, sf))


def overrides(spark, sf):
    """Manual class moves, derived from the data: suppliers with a negative balance are set inertial."""
    s = dt.table(spark, sf, "supplier")
    return s.filter(F.col("s_acctbal") < 0).select(F.col("s_suppkey").alias("station_id"), F.lit("inertial").alias("cluster"))


@query("cluster_override")
def q_cluster_override(spark, sf):
    c = clustered(spark, sf).select("station_id", "cluster").distinct()
    return CL.cluster_override(c, overrides(spark, sf))


@query("quality_filter")
def q_quality_filter(spark, sf):
    return rounded(CL.quality_filter(monthly_levels(spark, sf), "level", 5).select("station_id", "month", "level"))


@query("cluster_selection")
def q_cluster_selection(spark, sf):
    return rounded(CL.cluster_selection(clustered(spark, sf), ["reactive"]).select("station_id", "month", "level", "cluster"))


@query("series_diff")
def q_series_diff(spark, sf):
    return rounded(S.series_diff(monthly_levels(spark, sf), "level").select("station_id", "month", "diff"))


@query("rate_per_day")
def q_rate_per_day(spark, sf):
    return rounded(S.rate_per_day(monthly_levels(spark, sf), "level")
                   .select("station_id", "month", "days_diff", "delta", "delta_per_day"))


@query("variation_transform")
def q_variation(spark, sf):
    return rounded(S.variation_transform(monthly_levels(spark, sf), ["level"]).select("station_id", "month", "level"))


@query("ffill_bfill")
def q_ffill_bfill(spark, sf):
    return rounded(S.ffill_bfill(monthly_levels(spark, sf), "level", out="filled").select("station_id", "month", "filled"))


@query("longest_streak")
def q_longest_streak(spark, sf):
    return S.longest_streak(dt.sparse_readings(spark, sf), "level")


@query("segments_and_gaps")
def q_segments(spark, sf):
    return S.segments_and_gaps(monthly_levels(spark, sf), "level")


@query("series_shift")
def q_series_shift(spark, sf):
    g = S.with_position(monthly_levels(spark, sf)).withColumn("lag", F.col("station_id") % 5 - 2)
    return rounded(S.series_shift(g, "level", "lag").select("station_id", "month", "lag", "shifted"))


@query("cumulative_reconstruct")
def q_cumulative(spark, sf):
    g = S.ffill_bfill(monthly_levels(spark, sf), "level")
    d = g.withColumn("delta", F.col("level")).transform(lambda x: S.variation_transform(x, ["delta"]))
    return rounded(S.cumulative_reconstruct(d, "level", "delta", sign=-1).select("station_id", "month", "rebuilt"), 4)


@query("time_split")
def q_time_split(spark, sf):
    return S.time_split(monthly_levels(spark, sf)).select("station_id", "month", "split")


# ---------------------------------------------------------------- local cubic imputation
from lacuna.operators.impute.local import impute_pchip, impute_akima  # noqa: E402


@query("impute_pchip")
def q_impute_pchip(spark, sf):
    return rounded(impute_pchip(monthly_levels(spark, sf), "level", out="filled").select("station_id", "month", "level", "filled"))


@query("impute_akima")
def q_impute_akima(spark, sf):
    return rounded(impute_akima(monthly_levels(spark, sf), "level", out="filled").select("station_id", "month", "level", "filled"))


# ---------------------------------------------------------------- seasonal and kNN imputation
from lacuna.operators.impute.seasonal import impute_seasonal, seasonal_profile  # noqa: E402
from lacuna.operators.impute.knn import impute_knn  # noqa: E402


@query("impute_seasonal")
def q_impute_seasonal(spark, sf):
    return rounded(impute_seasonal(monthly_levels(spark, sf), "level", out="filled").select("station_id", "month", "level", "filled"))


@query("lookup_seasonal_profile")
def q_seasonal_profile(spark, sf):
    return rounded(seasonal_profile(monthly_levels(spark, sf), "level"))


@query("impute_knn")
def q_impute_knn(spark, sf):
    return rounded(impute_knn(monthly_levels(spark, sf), "level", out="filled").select("station_id", "month", "level", "filled"))


@query("impute_knn_past")
def q_impute_knn_past(spark, sf):
    return rounded(impute_knn(monthly_levels(spark, sf), "level", past_only=True, out="filled")
                   .select("station_id", "month", "level", "filled"))


# ---------------------------------------------------------------- splines, similar series
from lacuna.operators.impute import splines as SPL  # noqa: E402
from lacuna.operators.impute import similar as SIM  # noqa: E402


@query("impute_cubic")
def q_impute_cubic(spark, sf):
    return rounded(SPL.impute_cubic(monthly_levels(spark, sf), "level", out="filled").select("station_id", "month", "level", "filled"))


@query("impute_quadratic")
def q_impute_quadratic(spark, sf):
    return rounded(SPL.impute_quadratic(monthly_levels(spark, sf), "level", out="filled").select("station_id", "month", "level", "filled"))


@query("impute_smoothing_spline")
def q_impute_smoothing(spark, sf):
    return rounded(SPL.impute_smoothing_spline(monthly_levels(spark, sf), "level", out="filled")
                   .select("station_id", "month", "level", "filled"))


@query("spectrum_signature")
def q_spectrum(spark, sf):
    return rounded(SIM.spectrum(monthly_levels(spark, sf), "level", ["station_id"]), 4)


@query("spectrum_similarity")
def q_spectrum_similarity(spark, sf):
    """H9b on the embedding spectra: the 3 most similar others inside a label cluster (F2), by the exact cell search."""
    sp = dt.spectra(spark, sf)
    long = sp.select("cluster", "station_id", F.posexplode("amp").alias("bin", "amp"))
    return rounded(similar_from_vectors(long, 3), 6)


@query("impute_similar_series")
def q_impute_similar(spark, sf):
    found = SIM.impute_similar_series(clustered(spark, sf), "level", out="filled")
    # means of ten values of few digits often lie on a rounding edge, where the order of a sum would decide
    return rounded(found.select("station_id", "month", "level", (F.col("filled") + 1e-10).alias("filled")))


@query("lag_search_join")
def q_lag_search(spark, sf):
    """The lag of each station's ten most similar series."""
    return SIM.similar_lags(cut_lineage(clustered(spark, sf)), "level")[1]


@query("top_similar_series")
def q_top_similar(spark, sf):
    return rounded(SIM.similarity_topn(clustered(spark, sf), "level", 10), 6).select("cluster", "station_id", "other", "rank")


from pyspark.sql import Window  # noqa: E402


def similar_from_vectors(long, n_top):
    """Top-n by Pearson correlation of all entries but the first (vectors given as (cluster, station_id, bin, amp))."""
    sig = long.groupBy("cluster", "station_id").agg(F.sort_array(F.collect_list(F.struct("bin", F.col("amp").cast("double").alias("amp")))).alias("_a"))
    sig = sig.withColumn("_vv", F.transform(F.slice("_a", F.lit(2), F.size("_a")), lambda s: s["amp"])).withColumn("_n", F.size("_vv"))
    z = SIM._zvec_dyn(sig, "_vv", F.col("_n")).filter(F.col("_z").isNotNull())
    from lacuna.operators.neighbours import cell_topk
    top = cell_topk(z.select("cluster", "_n", F.col("station_id").alias("q_id"), F.col("_z").alias("q_z")),
                    z.select("cluster", "_n", F.col("station_id").alias("i_id"), F.col("_z").alias("i_z")), ["cluster", "_n"], n_top, correlate=True)
    return top.select("cluster", F.col("q_id").alias("station_id"), F.col("i_id").alias("other"), "sim", "rank")


# ---------------------------------------------------------------- holes, scoring, evaluation
from lacuna.operators import holes as HO  # noqa: E402
from lacuna.operators import scoring as SC  # noqa: E402
from lacuna.operators.impute import registry as REG  # noqa: E402
from lacuna.functions import stats as ST  # noqa: E402

SCORE_METHODS = ["lineaire", "pchip", "akima", "bss"]  # SQL gives their predictions too,
SQL_METHODS = [*SCORE_METHODS, "knn"]  # and these
ALL_METHODS = ["lineaire", "pchip", "akima", "cubique", "polynome", "spline", "knn", "bss", "knn_nappe", "rf", "cnn", "variation"]  # of the reference


@query("holes_points")
def q_holes_points(spark, sf):
    h = HO.holes_points(monthly_levels(spark, sf), "level", 0.2, seed=42)
    return rounded(h.select("station_id", "month", "level", "truth", "hole"))


@query("holes_blocks")
def q_holes_blocks(spark, sf):
    h = HO.holes_blocks(monthly_levels(spark, sf), "level", 0.2, seed=42, sizes=(1, 5))
    return rounded(h.select("station_id", "month", "level", "truth", "hole"))


@query("year_range_mask")
def q_year_range_mask(spark, sf):
    return rounded(HO.year_range_mask(monthly_levels(spark, sf), "level", 1997, 1998).select("station_id", "month", "level"))


@query("score_on_holes")
def q_score_on_holes(spark, sf):
    s = SC.score_on_holes(clustered(spark, sf), "level", SCORE_METHODS, 0.2, (1, 5), 42)
    return rounded(s.select("station_id", "lat", "lon", "cluster", "variable", "method", "nrmse"))


def _with_window_models():
    """The window models as plug-ins: the reference's trained networks."""
    model = lambda fn: lambda df, value, station, time, out: fn(df, value, WINDOW_FEATURES, WINDOW, station, time, out, holed=HOLED_FEATURES)
    REG.register("cnn", model(WM.impute_window_regression))
    REG.register("variation", model(WM.impute_variation_model))


@query("score_on_holes_all_methods")
def q_score_all(spark, sf):
    """I3 over all twelve methods, on the fused table."""
    _with_window_models()
    s = SC.score_on_holes(windowed(spark, sf), "level", ALL_METHODS, 0.2, (1, 5), 42)
    return rounded(s.select("station_id", "lat", "lon", "cluster", "variable", "method", "nrmse"))


@query("evaluate_all_methods")
def q_evaluate_all_methods(spark, sf):
    """I5 over all twelve methods and two rates, on the fused table."""
    _with_window_models()
    return rounded(SC.evaluate_all(windowed(spark, sf), "level", ALL_METHODS, [0.1, 0.2], seed=42, sizes=(1, 6)))


def _errors(spark, sf):
    return SC.evaluate_all(monthly_levels(spark, sf), "level", SQL_METHODS, [0.1, 0.2], seed=42, sizes=(1, 6))


@query("evaluate_methods")
def q_evaluate_methods(spark, sf):
    g = monthly_levels(spark, sf)
    h = cut_lineage(HO.holes_blocks(g, "level", 0.1, 42, (1, 6)))
    preds = REG.predictions_long(h.drop("truth", "hole"), "level", SQL_METHODS)
    truth = h.select("station_id", "month", F.col("truth").alias("level"))
    return rounded(SC.evaluate_methods(preds, truth, "level", 0.1))


@query("evaluate_all")
def q_evaluate_all(spark, sf):
    return rounded(_errors(spark, sf))


@query("nse")
def q_nse(spark, sf):
    g = monthly_levels(spark, sf)
    h = HO.holes_blocks(g, "level", 0.2, 42, (1, 5))
    preds = REG.predictions_long(h.drop("truth", "hole"), "level", ["lineaire"])
    truth = h.select("station_id", "month", F.col("truth").alias("level")).filter(F.col("level").isNotNull())
    return rounded(SC.nse(preds, truth, "level"))


@query("masked_mse")
def q_masked_mse(spark, sf):
    from lacuna.operators.impute.linear import impute_linear
    g = impute_linear(monthly_levels(spark, sf), "level", out="pred")
    g = g.withColumn("y", F.coalesce("level", F.lit(ST.MASK_VALUE)))
    return rounded(g.groupBy("station_id").agg(ST.masked_mse("y", "pred").alias("masked_mse")))


@query("mean_error_by_method")
def q_mean_error(spark, sf):
    return rounded(SC.mean_error_by_method(_errors(spark, sf)))


@query("error_pivot")
def q_error_pivot(spark, sf):
    return rounded(SC.error_pivot(_errors(spark, sf), SQL_METHODS))


@query("method_rank")
def q_method_rank(spark, sf):
    return rounded(SC.method_rank(_errors(spark, sf)).select("dataset", "pct_removed", "method", "NRMSE", "rank"))


@query("method_league")
def q_method_league(spark, sf):
    return rounded(SC.method_league(_errors(spark, sf)))


@query("summary_range")
def q_summary_range(spark, sf):
    return rounded(SC.summary_range(SC.score_on_holes(clustered(spark, sf), "level", SCORE_METHODS, 0.2, (1, 5), 42)))


@query("complete_variables")
def q_complete_variables(spark, sf):
    g = monthly_levels(spark, sf).select("station_id", "month", "level", "lon", "lat")
    out = REG.complete_variables(g, {"level": SQL_METHODS})
    return rounded(out.select("station_id", "month", "level", *[f"{m}_level" for m in SQL_METHODS]))


@query("apply_best_method")
def q_apply_best(spark, sf):
    c = cut_lineage(clustered(spark, sf))
    scores = SC.score_on_holes(c, "level", SCORE_METHODS, 0.2, (1, 5), 42)
    preds = REG.predictions_long(c.select("station_id", "month", "level", "lon", "lat"), "level", SCORE_METHODS)
    out = REG.apply_best_method(preds, scores, c.select("station_id", "month", "level"), "level")
    return rounded(out.select("station_id", "month", "best_method", "completed"))


# ---------------------------------------------------------------- projections, filters, joins, reshape, functions
from lacuna.operators import filters as FL  # noqa: E402
from lacuna.operators import joins as JN  # noqa: E402
from lacuna.operators import reshape as RS  # noqa: E402
from lacuna.functions import text as TX  # noqa: E402
from lacuna.functions import calendar as CA  # noqa: E402


def weather_raw(spark, sf):
    """Raw weather as delivered (AAAAMM, RR, TMM, ETP, LAT, LON), derived from the points."""
    p = dt.points(spark, sf)
    return p.select(F.date_format("month", "yyyyMM").cast("int").alias("AAAAMM"), F.col("rain").alias("RR"),
                    F.col("temp").alias("TMM"), (F.col("rain") / 1000.0).alias("ETP"),
                    F.col("lat").alias("LAT"), F.col("lon").alias("LON"), F.lit("x").alias("NOM"))


def communes(spark, sf):
    """Commune reference: customers with an INSEE-like code, a postal code and coordinates."""
    c = dt.table(spark, sf, "customer")
    return c.select(F.col("c_custkey").cast("string").alias("insee_code"),
                    ((F.col("c_custkey") * 37) % 96000).cast("string").alias("postal_code"),
                    dt.point_lat(F.col("c_nationkey")).alias("lat"), dt.point_lon(F.col("c_nationkey")).alias("lon"))


@query("project_rename")
def q_project_rename(spark, sf):
    return rounded(W.project_rename(weather_raw(spark, sf)))


@query("rain_daily_rate")
def q_rain_daily_rate(spark, sf):
    return rounded(W.rain_daily_rate(W.project_rename(weather_raw(spark, sf)), "mean"))


@query("filter_department")
def q_filter_department(spark, sf):
    return rounded(FL.filter_department(communes(spark, sf), [1, 13, 13, 45]))


@query("filter_bbox")
def q_filter_bbox(spark, sf):
    return rounded(FL.filter_bbox(dt.points(spark, sf), 43.0, 47.0, -2.0, 4.0))


@query("drop_incomplete_rows")
def q_drop_incomplete(spark, sf):
    return rounded(FL.drop_incomplete_rows(dt.points(spark, sf)))


@query("drop_all_null_rows")
def q_drop_all_null(spark, sf):
    return rounded(FL.drop_all_null_rows(dt.points(spark, sf), ["rain", "temp"]))


@query("drop_null_target")
def q_drop_null_target(spark, sf):
    return rounded(FL.drop_null_target(monthly_levels(spark, sf), "level"))


@query("fill_sentinel")
def q_fill_sentinel(spark, sf):
    return rounded(FL.fill_sentinel(monthly_levels(spark, sf), ["level"]))


@query("search_stations")
def q_search(spark, sf):
    return rounded(FL.search_stations(dt.stations(spark, sf), "PLIER#00000001"))


@query("coerce_types")
def q_coerce(spark, sf):
    e = dt.table(spark, sf, "events").select("event_id", F.col("event_type").alias("as_number"),
                                               F.col("value").alias("value"),
                                               F.col("props").alias("as_time"), "ts")
    return rounded(FL.coerce_types(e, ["as_number", "value"], ["as_time"], "ts").drop("ts"))


@query("compare_series")
def q_compare(spark, sf):
    li = dt.table(spark, sf, "lineitem")
    m = CA.month_floor("l_shipdate").alias("month")
    a = li.filter(F.col("l_returnflag") == "R").groupBy(m).agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("q"))
    b = li.filter(F.col("l_returnflag") != "R").groupBy(m).agg(F.count(F.lit(1)).alias("n"), F.avg("l_quantity").alias("q"))
    return rounded(FL.compare_series(a, b))


@query("join_commune_coords")
def q_join_communes(spark, sf):
    o = dt.table(spark, sf, "orders").select("o_orderkey", F.col("o_custkey").cast("string").alias("commune_code"))
    return rounded(JN.join_commune_coords(o, communes(spark, sf)).select("o_orderkey", "postal_code", "lat", "lon"))


def cells(spark, sf):
    s = dt.table(spark, sf, "supplier").select("s_suppkey", "s_acctbal")
    return (s.select(F.col("s_suppkey").alias("lambx"), F.explode(F.sequence(F.lit(1), F.lit(7))).alias("lamby"), "s_acctbal")
            .withColumn("lat", dt.station_lat(F.col("lambx")) + F.col("lamby") / 100.0)
            .withColumn("lon", dt.station_lon(F.col("lambx"))))


@query("join_grid_cells")
def q_join_grid_cells(spark, sf):
    li = dt.table(spark, sf, "lineitem").select("l_orderkey", F.col("l_suppkey").alias("lambx"),
                                                 F.col("l_linenumber").alias("lamby"), "l_quantity")
    return rounded(JN.join_grid_cells(li, cells(spark, sf).drop("s_acctbal")))


@query("semi_join_cells")
def q_semi_join(spark, sf):
    li = dt.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.col("l_suppkey").alias("cell_id"))
    c = dt.table(spark, sf, "supplier").filter(F.col("s_acctbal") > 0).select(F.col("s_suppkey").alias("cell_id"))
    return JN.semi_join_cells(li, c)


@query("union_all")
def q_union_all(spark, sf):
    li = dt.table(spark, sf, "lineitem")
    a = li.filter(F.col("l_returnflag") == "R").select("l_orderkey", "l_linenumber", "l_quantity")
    b = li.filter(F.col("l_returnflag") == "A").select("l_orderkey", "l_linenumber", "l_quantity")
    c = li.filter(F.col("l_returnflag") == "N").select("l_orderkey", "l_linenumber", "l_quantity")
    return rounded(RS.union_all(a, b, c))


@query("unpivot_vintages")
def q_unpivot(spark, sf):
    w = dt.soil_wide(spark, sf)
    return rounded(RS.unpivot_vintages(w, [("vintage_1", "sealed_1"), ("vintage_2", "sealed_2")], ["lat", "lon", "total_area"]))


@query("pivot_series")
def q_pivot_series(spark, sf):
    return _written_out(RS.pivot_series(monthly_levels(spark, sf), "level", width=16))


def _written_out(tiled):
    """The arrays of tiles as text, values in thousandths."""
    number = lambda v: F.coalesce(F.round(v * 1000).cast("long").cast("string"), F.lit("-"))
    return (tiled.withColumn("stations", F.array_join(F.col("stations").cast("array<string>"), ","))
            .withColumn("values", F.array_join(F.transform("values", number), ",")))


def _wide_scores(spark, sf):
    s = SC.score_on_holes(clustered(spark, sf), "level", SCORE_METHODS, 0.2, (1, 5), 42)
    return s.groupBy("station_id").pivot("method", SCORE_METHODS).agg(F.first("nrmse")) \
            .select("station_id", *[F.col(m).alias(f"{m}_level") for m in SCORE_METHODS])


@query("unpivot_scores")
def q_unpivot_scores(spark, sf):
    return rounded(RS.unpivot_scores(_wide_scores(spark, sf), ["station_id"], ["level"]))


@query("score_matrix_by_cluster")
def q_score_matrix(spark, sf):
    s = SC.score_on_holes(clustered(spark, sf), "level", SCORE_METHODS, 0.2, (1, 5), 42)
    return _written_out(RS.score_matrix_by_cluster(s, width=16))


@query("dataset_focus")
def q_dataset_focus(spark, sf):
    """The errors of one dataset, with the removal rates that it has."""
    rows, rates = FL.dataset_focus(_errors(spark, sf), 7)
    return rounded(rows.join(rates.withColumnRenamed("pct_removed", "rate"), F.col("pct_removed") == F.col("rate")).drop("rate"))


@query("distinct_sorted")
def q_distinct_sorted(spark, sf):
    return RS.distinct_sorted(dt.table(spark, sf, "events"), "event_type")


@query("sort_series")
def q_sort_series(spark, sf):
    return rounded(RS.sort_series(dt.points(spark, sf), ["month", "lat", "lon"]))


@query("sort_stations")
def q_sort_stations(spark, sf):
    g = monthly_levels(spark, sf)
    cls = CL.cluster_two_way(CL.fluctuation_index(g, "level")).select("station_id", "cluster")
    return rounded(RS.sort_stations(cls, CL.duration_years(g, "level"), S.longest_streak(g, "level")))


@query("scalar_functions")
def q_scalar_functions(spark, sf):
    """Calendar functions over the orders table."""
    o = dt.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    d = F.to_date("o_orderdate")
    return rounded(o.select(
        "o_orderkey",
        CA.parse_yyyymm(F.date_format(d, "yyyyMM")).alias("k1_month"),
        CA.parse_yyyymmdd(F.date_format(d, "yyyyMMdd")).alias("k1_day"),
        CA.year_start(F.year(d)).alias("k1_year"),
        CA.month_floor("o_orderdate").alias("k2_month"),
        CA.days_in_month(d).alias("k3_days"),
        CA.epoch_seconds_of_date(d).alias("k4_epoch"),
        F.year(d).alias("k5_year"), F.month(d).alias("k5_month"), F.dayofyear(d).alias("k5_doy"),
        CA.cyclic_month_sin(d).alias("k6_sin"), CA.cyclic_month_cos(d).alias("k6_cos"),
        CA.month_step(F.lit("1995-01-01").cast("date"), d).alias("k11_step")))


@query("string_functions")
def q_string_functions(spark, sf):
    """K7–K10, K12–K14 over pages (urls), customers (codes) and events (JSON props)."""
    p = dt.table(spark, sf, "pages").select("page_id", "url")
    out = p.select("page_id",
                   TX.basename("url").alias("k12_basename"),
                   TX.safe_name("url").alias("k8_safe"),
                   TX.zero_pad(F.col("page_id") * 997).alias("k7_pad"),
                   TX.clean_header(F.concat(F.lit(" #"), F.col("page_id").cast("string"), F.lit("# "))).alias("k9_header"),
                   TX.case_contains("url", "EXAMPLE.COM").alias("k10_contains"),
                   TX.station_from_file(F.concat(F.lit("data_"), F.col("page_id").cast("string"), F.lit(".csv"))).alias("k13_station"))
    return out


@query("json_fields")
def q_json_fields(spark, sf):
    e = dt.table(spark, sf, "events").select("event_id", "props")
    return e.select("event_id", TX.json_field("props", "$.k").cast("int").alias("k"),
                    TX.json_field("props", "$.format", "").alias("format"))


# ---------------------------------------------------------------- sources and sinks (write, then read back)
import uuid  # noqa: E402

from lacuna.session import cut_lineage, shared_path, staged  # noqa: E402
from lacuna.sources import readers as RD  # noqa: E402
from lacuna.sources import writers as WR  # noqa: E402


def _stage(spark, name):
    return shared_path(spark, f"stage/{name}-{uuid.uuid4().hex}")


def _series_text(df):
    return df.select(F.col("station_id").cast("string").alias("station_id"), "month", "level", "lon", "lat")


@query("scan_series_csv")
def q_scan_series_csv(spark, sf):
    p = _stage(spark, "series_csv")
    WR.write_table(_series_text(monthly_levels(spark, sf)), p, "csv")
    return rounded(RD.scan_series_csv(spark, p).withColumn("station_id", F.col("station_id").cast("long")))


@query("scan_series_folder")
def q_scan_series_folder(spark, sf):
    p = _stage(spark, "per_station")
    WR.write_per_station(_series_text(monthly_levels(spark, sf)), p)
    return rounded(RD.scan_series_folder(spark, p).withColumn("station_id", F.col("station_id").cast("long")))


@query("write_per_station")
def q_write_per_station(spark, sf):
    p = _stage(spark, "per_station_files")
    manifest = WR.write_per_station(_series_text(monthly_levels(spark, sf)), p, rows=1000)
    station = F.regexp_extract("station_file", "^data_(.*)$", 1).cast("long")
    return manifest.groupBy(station.alias("station_id")).agg(F.sum("n_rows").alias("n_rows"))


@query("series_pipeline")
def q_series_pipeline(spark, sf):
    """All stages over a folder: fusion, classes, training, completion; its summary of scores."""
    sources = {"readings": dt.readings(spark, sf), "weather": dt.points(spark, sf), "pet": dt.pet_daily(spark, sf), "soil": dt.soil(spark, sf)}
    settings = SPI.Settings(methods={"level": tuple(SCORE_METHODS)}, window=WINDOW)
    s = SPI.run(spark, _stage(spark, "series_pipeline"), settings, sources)
    return rounded(s.select("station_id", "lat", "lon", "cluster", "variable", "method", "nrmse"))


@query("write_by_cluster")
def q_write_by_cluster(spark, sf):
    p = _stage(spark, "by_cluster")
    WR.write_by_cluster(clustered(spark, sf).select("station_id", "month", "level", "cluster"), p)
    return rounded(spark.read.parquet(p))


@query("write_table")
def q_write_table(spark, sf):
    p = _stage(spark, "table")
    WR.write_table(dt.points(spark, sf), p, "csv")
    return rounded(spark.read.schema("lat double, lon double, month date, rain double, temp double")
                   .option("sep", ";").option("header", True).csv(p))


@query("append_run_log")
def q_append_run_log(spark, sf):
    p = _stage(spark, "run_log")
    e = cut_lineage(_errors(spark, sf))  # evaluated once, appended in two calls
    WR.append_run_log(e.filter(F.col("pct_removed") == 0.1), p)
    WR.append_run_log(e.filter(F.col("pct_removed") == 0.2), p)
    return rounded(spark.read.schema("dataset long, method string, NMAE double, NRMSE double, pct_removed double")
                   .option("header", True).csv(p))


@query("read_summary")
def q_read_summary(spark, sf):
    p = _stage(spark, "summary")
    WR.write_table(SC.score_on_holes(clustered(spark, sf), "level", SCORE_METHODS, 0.2, (1, 5), 42), p)
    return rounded(RD.read_summary(spark, p))


@query("read_clusters_or_fused")
def q_read_clusters_or_fused(spark, sf):
    c, f = _stage(spark, "clusters"), _stage(spark, "fused")
    WR.write_table(monthly_levels(spark, sf), f)
    WR.write_table(monthly_levels(spark, sf).limit(0).withColumn("cluster", F.lit("x")), c)
    return rounded(RD.read_clusters_or_fused(spark, c, f))


@query("scan_suffix_filter")
def q_scan_suffix(spark, sf):
    p = _stage(spark, "suffix")
    cm = communes(spark, sf)
    WR.write_table(cm, p + "/a_commune.csv", "csv", ",")
    WR.write_table(cm, p + "/other.csv", "csv", ",")
    return rounded(RD.scan_suffix_filter(spark, p, "commune.csv", "insee_code string, postal_code string, lat double, lon double"))


# ---------------------------------------------------------------- scaling, windows, models
from lacuna.operators import scale as SCL  # noqa: E402
from lacuna.operators import windows as WIN  # noqa: E402
from lacuna.operators.impute import models as MD  # noqa: E402
from lacuna.operators.impute import window_model as WM  # noqa: E402
from lacuna.operators.impute import grid_search as GS  # noqa: E402
from lacuna.plans import series_pipeline as SPI  # noqa: E402

SCALE_FEATURES = ["level", "lon", "lat"]
WINDOW_FEATURES = ["level", "lon", "lat", "time_num", "pet", "rain", "temp", "sealed_area", "total_area"]
HOLED_FEATURES = ["level", "pet", "rain", "temp"]
WINDOW = 12  # months; the driver's calendar has 84, fewer than the reference's default of 120


def windowed(spark, sf):
    """The fused table with all nine features of the window models, and the class of each station."""
    f = fuse(dt.readings(spark, sf), dt.points(spark, sf), pet_monthly(spark, sf), dt.soil(spark, sf))
    f = f.withColumn("time_num", F.unix_seconds(F.col("month").cast("timestamp")).cast("double"))
    return staged(CL.assign_clusters(staged(f), "level"))  # the class is joined to the rows it comes from


@query("minmax_scale")
def q_minmax(spark, sf):
    out, _ = SCL.minmax_scale(monthly_levels(spark, sf), SCALE_FEATURES)
    return rounded(out)


@query("minmax_inverse")
def q_minmax_inverse(spark, sf):
    g = monthly_levels(spark, sf)
    out, scaler = SCL.minmax_scale(g, SCALE_FEATURES)
    return rounded(SCL.minmax_inverse(out, SCALE_FEATURES, scaler))


@query("standard_scale")
def q_standard(spark, sf):
    g = monthly_levels(spark, sf)
    return rounded(SCL.standard_scale(g, ["level"], ["station_id"], F.col("level").isNotNull()))


@query("reuse_scaler")
def q_reuse_scaler(spark, sf):
    p = _stage(spark, "scaler")
    g = monthly_levels(spark, sf)
    SCL.reuse_scaler(spark, g, SCALE_FEATURES, p)           # fits and saves
    out, _ = SCL.reuse_scaler(spark, g, SCALE_FEATURES, p)  # reads it back
    return rounded(out)


@query("impute_forest_delta_tree")
def q_forest_tree(spark, sf):
    """H7 with a single tree of two levels: what SQL can write down."""
    f = fuse(dt.readings(spark, sf), dt.points(spark, sf), pet_monthly(spark, sf))
    return rounded(MD.impute_forest_delta(f, "level", out="filled", num_trees=1, depth=2).select("station_id", "month", "level", "filled"), 4)


def _windows(spark, sf, pairing):
    g = monthly_levels(spark, sf)
    h = HO.holes_blocks(g, "level", 0.1, 42, (1, 5)).drop("truth", "hole")
    w = WIN.sliding_windows(h, SCALE_FEATURES, WINDOW, pairing, truth=g)
    total = lambda c: F.round(F.aggregate(c, F.lit(0.0), lambda a, r: a + F.coalesce(r[0], F.lit(0.0))), 6)
    return w.select("station_id", "x_end", F.size("x").alias("n_x"), total("x").alias("sum_x_level"), total("y").alias("sum_y_level"))


@query("sliding_windows")
def q_sliding_windows(spark, sf):
    return _windows(spark, sf, "cnn")


@query("sliding_windows_lstm")
def q_sliding_windows_lstm(spark, sf):
    """E9 with the target one row ahead."""
    return _windows(spark, sf, "lstm")


@query("overlap_average")
def q_overlap(spark, sf):
    g = monthly_levels(spark, sf)
    win = WIN.inference_windows(g, ["level"], 12)
    wp = win.select("station_id", "start", F.transform("x", lambda r: r[0]).alias("values"))
    return rounded(WIN.overlap_average(wp, g.select("station_id", "month"), 12))


@query("impute_forest_delta")
def q_forest(spark, sf):
    f = fuse(dt.readings(spark, sf), dt.points(spark, sf), pet_monthly(spark, sf))
    return rounded(MD.impute_forest_delta(f, "level", out="filled", features=["pet", "temp"])
                   .select("station_id", "month", "level", "filled"), 4)


@query("impute_window_regression")
def q_window_regression(spark, sf):
    """H11 over all nine features of the fused table."""
    return rounded(WM.impute_window_regression(windowed(spark, sf), "level", WINDOW_FEATURES, WINDOW, out="filled", holed=HOLED_FEATURES)
                   .select("station_id", "month", "level", "filled"), 4)


@query("impute_window_regression_pair")
def q_window_regression_pair(spark, sf):
    """H11 on windows of two rows of the level alone: normal equations that SQL can write down."""
    return rounded(WM.impute_window_regression(monthly_levels(spark, sf), "level", ["level"], 2, out="filled")
                   .select("station_id", "month", "level", "filled"))


@query("impute_variation_model")
def q_variation_model(spark, sf):
    return rounded(WM.impute_variation_model(windowed(spark, sf), "level", WINDOW_FEATURES, WINDOW, out="filled", holed=HOLED_FEATURES)
                   .select("station_id", "month", "level", "filled"), 4)


GRID = {"sizes": [2], "ridges": [0.001, 0.1, 1.0], "pcts": [0.1, 0.2]}


@query("grid_search_resume")
def q_grid_search(spark, sf):
    """Two hole rates by three ridge terms on pairs of rows; the first call stops after one rate, the second takes up the rest."""
    p, g = _stage(spark, "grid_log"), cut_lineage(monthly_levels(spark, sf))
    GS.grid_search(g, "level", ["level"], p, GRID["sizes"], GRID["ridges"], GRID["pcts"][:1])
    GS.grid_search(g, "level", ["level"], p, **GRID)
    return rounded(GS.read_log(spark, p).withColumn("rank", F.row_number().over(Window.orderBy("val_loss", "pct", "ridge"))))


@query("grid_search_best")
def q_grid_search_best(spark, sf):
    """I6 over all nine features and three sizes: the chosen configuration of each class of stations."""
    p, df, out = _stage(spark, "grid_logs"), windowed(spark, sf), None
    for c in ("inertial", "reactive"):
        best = GS.grid_search(df.filter(F.col("cluster") == c), "level", WINDOW_FEATURES, f"{p}/{c}", [3, 6, 12], [0.001, 0.1], [0.1], holed=HOLED_FEATURES)
        best = best.withColumn("cluster", F.lit(c))
        out = best if out is None else out.unionByName(best)
    return rounded(out, 4)


@query("explode_api_pages")
def q_explode_api_pages(spark, sf):
    """Readings landed as API pages (one page per station and year, ≤ 366 items), read back."""
    r = dt.readings(spark, sf).select(F.col("station_id").cast("string").alias("code_bss"),
                                      F.col("time").cast("string").alias("date_mesure"),
                                      F.col("level").alias("niveau_nappe_eau"))
    pages = (r.groupBy("code_bss", F.substring("date_mesure", 1, 4).alias("y"))
             .agg(F.collect_list(F.struct("code_bss", "date_mesure", "niveau_nappe_eau")).alias("data")))
    p = _stage(spark, "api_pages")
    pages.select("data").write.mode("overwrite").json(p)
    items = RD.explode_api_pages(spark, p, "code_bss string, date_mesure string, niveau_nappe_eau double", multiline=False)
    return rounded(items.select(F.col("code_bss").cast("long").alias("station_id"),
                                F.to_date("date_mesure").alias("time"), F.col("niveau_nappe_eau").alias("level")))


# ---------------------------------------------------------------- odd formats, landed from the driver tables and read back
LANDED = "station_id long, time date, level double"


def _landed(spark, sf):
    return dt.readings(spark, sf).select("station_id", "time", "level")


@query("scan_mixed_compressed")
def q_scan_mixed_compressed(spark, sf):
    """A3: even stations as gzip files, odd ones plain, in one folder."""
    p, r = _stage(spark, "mixed"), _landed(spark, sf)
    w = lambda df, codec: df.write.mode("append").option("sep", ";").option("header", True).option("compression", codec).csv(p)
    w(r.filter("station_id % 2 = 0"), "gzip")
    w(r.filter("station_id % 2 = 1").select("time", "level", "station_id"), "none")
    return rounded(RD.scan_mixed_compressed(spark, p, LANDED))


@query("scan_schema_drift")
def q_scan_schema_drift(spark, sf):
    """A4: three vintages of files, one in another column order with an extra column, one without the level."""
    p, r = _stage(spark, "drift"), _landed(spark, sf)
    for i, cols in enumerate((["station_id", "time", "level"], ["level", "note", "time", "station_id"], ["time", "station_id"])):
        (r.filter(f"station_id % 3 = {i}").withColumn("note", F.lit("x")).select(*cols)
         .write.mode("overwrite").option("sep", ";").option("header", True).csv(f"{p}/{i}"))
    return rounded(RD.scan_schema_drift(spark, [f"{p}/{i}" for i in range(3)], LANDED))


@query("scan_with_preamble")
def q_scan_with_preamble(spark, sf):
    """A5: files with four lines before a '#' header whose columns stand in another order."""
    p = _stage(spark, "preamble")
    lines = _landed(spark, sf).select(F.concat_ws(";", F.coalesce(F.col("level").cast("string"), F.lit("")), F.col("station_id").cast("string"),
                                                  F.col("time").cast("string")).alias("value"))

    def with_head(batches):
        import pandas as pd
        yield pd.DataFrame({"value": ["produced by", "", "a; b; c", "----", "#level; station_id ;time"]})
        yield from batches

    lines.mapInPandas(with_head, "value string").write.mode("overwrite").text(p)
    return rounded(RD.scan_with_preamble(spark, p, LANDED))


@query("filter_manifest")
def q_filter_manifest(spark, sf):
    """A catalogue of resources, one page for each nation's suppliers; csv ones of departments 1 and 7 stay."""
    p = _stage(spark, "manifest")
    s = dt.table(spark, sf, "supplier")
    res = s.select("s_nationkey", F.struct(F.concat(F.lit("Set_"), F.col("s_nationkey").cast("string"), F.lit("_"), F.col("s_suppkey").cast("string")).alias("title"),
                                           F.concat(F.lit("http://x/"), F.col("s_suppkey").cast("string")).alias("url"),
                                           F.when(F.col("s_suppkey") % 3 == 0, F.lit("CSV")).when(F.col("s_suppkey") % 3 == 1, F.lit("json")).alias("format")).alias("r"))
    res.groupBy("s_nationkey").agg(F.collect_list("r").alias("resources")).select("resources").write.mode("overwrite").json(p)
    return RD.filter_manifest(spark, p, ["csv"], ["1_", "7_"], multiline=False)


PIVOT_YEARS = list(range(1992, 1999))  # of the driver's calendar


@query("month_year_pivot")
def q_month_year_pivot(spark, sf):
    return rounded(RS.month_year_pivot(monthly_levels(spark, sf), "level", PIVOT_YEARS))


@query("fit_global_and_per_cluster")
def q_fit_global_and_per_cluster(spark, sf):
    """The model of all stations on every station, and each class's on its own stations, saved and read back."""
    p, df = _stage(spark, "models"), windowed(spark, sf)
    fitted, scaler = WM.fit_global_and_per_cluster(df, "level", WINDOW_FEATURES, p, WINDOW, holed=HOLED_FEATURES)
    loaded = WM.WindowModel.load(spark, p, fitted.features, fitted.value)
    return rounded(WM.apply_windows(df, loaded, scaler, "cluster").select("station_id", "scope", "month", F.col("pred").alias("prediction")), 4)
