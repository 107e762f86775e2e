"""The registered queries: every operator over the whole of a given table."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fairtally.functions.centers import as_centers, centers_frame
from fairtally.operators import fair, frequency, groups, objectives, ordering, registers, reports, sketch, start, words
from fairtally.operators.bounds import bounded_kmeans
from fairtally.operators.center_table import nearest_in_table
from fairtally.operators.kmeans import initial_centers, kmeans
from fairtally.operators.nearest import with_nearest
from fairtally.plans.inputs import (
    CENTERS,
    EVEN_HASHES,
    GRID,
    HASHES,
    LINE_KEYS,
    SEPARATE_GROUPS,
    START_PICKS,
    START_SEED,
    STREAM_CHUNKS,
    SYNTH_SEED,
    TOP_K,
    documents,
    event_items,
    line_points,
    order_points,
    separate_points,
    table,
    vector_centers,
    vector_points,
)
from fairtally.sources.checked import read_points_checked
from fairtally.sources.item_table import table_items
from fairtally.sources.items import parse_items
from fairtally.sources.points import format_points, parse_points, read_points, write_points
from fairtally.sources.synthetic import synth_points
from fairtally.storage import held, scratch_dir
from fairtally.streaming import closing, prefix, running, tables


def _x(column: str = "features") -> Column:
    return F.get(column, F.lit(0))


def _y(column: str = "features") -> Column:
    return F.get(column, F.lit(1))


def _center_rows(spark: SparkSession, centers) -> DataFrame:
    return centers_frame(spark, centers).select(
        "cluster_id", F.round(_x("center"), 6).alias("cx"), F.round(_y("center"), 6).alias("cy")
    )


# --- points -------------------------------------------------------------------------------


def pt_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("l_orderkey", "l_linenumber")
    lines = line_points(spark, sf_dir, *keys).select(*keys, F.concat_ws(",", _x(), _y(), "grp").alias("value"))
    return parse_points(lines, dim=2).select(*keys, _x().alias("x"), _y().alias("y"), "grp")


def pt_parse_any_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = vector_points(spark, sf_dir)
    lines = vectors.select("vec_id", F.concat_ws(",", F.col("features").cast("array<string>"), "grp").alias("value"))
    return parse_points(lines).select(
        "vec_id", F.size("features").alias("dim"), _x().alias("first"), F.element_at("features", -1).alias("last"), "grp"
    )


def pt_text_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "points")
    write_points(line_points(spark, sf_dir), path)
    back = read_points(spark, path, dim=2)
    return back.groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.round(F.sum(_x()), 3).alias("sum_x"),
        F.round(F.sum(_y()), 3).alias("sum_y"),
    )


def pt_text_roundtrip_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All 64 coordinates, through other column names."""
    path = scratch_dir(spark, "vectors")
    renamed = vector_points(spark, sf_dir).withColumnsRenamed({"features": "place", "grp": "side"})
    write_points(renamed, path, features="place", grp="side")
    total = F.aggregate("features", F.lit(0.0), lambda t, v: t + v)
    return read_points(spark, path).groupBy("grp").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.size("features")).alias("dim"),
        F.round(F.sum(total), 3).alias("total"),
        F.round(F.sum(F.element_at("features", -1)), 3).alias("last"),
    )


def pt_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of points of which two in seven are bad, one way or another: how many of each kind were read."""
    path = scratch_dir(spark, "mixed-lines")
    lines = format_points(line_points(spark, sf_dir, "l_linenumber"), keep=["l_linenumber"])
    spoiled = (
        F.when(F.col("l_linenumber") == 6, F.concat(F.lit("?"), "value"))
        .when(F.col("l_linenumber") == 7, F.concat("value", F.lit(",C")))
        .otherwise(F.col("value"))
    )
    lines.select(spoiled.alias("value")).write.text(path)
    found = read_points_checked(spark, path, dim=2)
    kinds = found.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))
    good = found.good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("reason"), "n")
    read = spark.range(1).select(F.lit("read").alias("reason"), F.lit(found.n_read).cast("bigint").alias("n"))
    return kinds.unionByName(good).unionByName(read)


def pt_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objectives.group_counts(order_points(spark, sf_dir))


def pt_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objectives.point_dimensions(vector_points(spark, sf_dir))


# --- clustering at given centers ----------------------------------------------------------


def cl_assign(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("l_orderkey", "l_linenumber")
    return with_nearest(line_points(spark, sf_dir, *keys), CENTERS).select(*keys, "cluster_id", "dist")


def cl_assign_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = ("l_orderkey", "l_linenumber")
    return with_nearest(line_points(spark, sf_dir, *keys), GRID).select(*keys, "cluster_id", "dist")


def cl_assign_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_nearest(vector_points(spark, sf_dir), vector_centers(spark, sf_dir)).select("vec_id", "cluster_id")


def cl_assign_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The suppliers as centers, read by the tasks block by block."""
    place = F.array(F.col("s_suppkey") * 7 % 51, (F.col("s_acctbal") + 1000) / 100).cast("array<double>")
    centers = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("cluster_id"), place.alias("center"))
    found = nearest_in_table(line_points(spark, sf_dir, *LINE_KEYS), centers, 2, block=64)
    return found.select(*LINE_KEYS, "cluster_id")


def cl_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centers after two Lloyd rounds with bounds, and the points of each."""
    run = bounded_kmeans(line_points(spark, sf_dir), GRID, 2, tol=0.0)
    sizes = run.state.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("n"))
    return _center_rows(spark, run.centers).join(sizes, "cluster_id")


def cl_std_objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objectives.standard_objective(line_points(spark, sf_dir), CENTERS).select(F.round("delta", 6).alias("delta"))


def cl_fair_objective(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = objectives.fair_objective(line_points(spark, sf_dir), CENTERS)
    return row.select(*[F.round(c, 6).alias(c) for c in ("phi", "delta_a", "delta_b")])


def cl_group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objectives.cluster_group_sizes(line_points(spark, sf_dir), CENTERS)


def cl_group_sizes_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return objectives.cluster_group_sizes(line_points(spark, sf_dir), GRID)


def cl_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, lines = objectives.clustering_report(line_points(spark, sf_dir), CENTERS)
    return lines.select("i", _x("center").alias("cx"), _y("center").alias("cy"), "na", "nb")


def cl_report_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals, _ = objectives.clustering_report(order_points(spark, sf_dir), ((100000.0,), (250000.0,), (400000.0,)))
    return totals.select("n", "na", "nb", *[F.round(F.col(c) / 1e6, 4).alias(c) for c in ("delta", "phi")])


def cl_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.clustering_lines(line_points(spark, sf_dir), CENTERS)


# --- k-means ------------------------------------------------------------------------------


def cl_start_picks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The points that one round of the start picks, given a center."""
    points = line_points(spark, sf_dir, *LINE_KEYS)
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in LINE_KEYS])
    keyed = points.select(key.alias("key"), F.col("features").alias("x"), F.lit(1).cast("bigint").alias("w"))
    picked = start.cost_picks(keyed, as_centers(CENTERS[:1]), START_PICKS, START_SEED, 1)
    return picked.select("key", _x("x").alias("x"), _y("x").alias("y"))


def cl_init(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Start centers of a random method: one in each of the separate groups."""
    points = separate_points(spark, sf_dir, *LINE_KEYS)
    found = centers_frame(spark, initial_centers(points, SEPARATE_GROUPS, seed=START_SEED, ids=LINE_KEYS))
    group = F.floor((_x("center") + 500) / 1000)
    return found.agg(F.count(F.lit(1)).alias("n_centers"), F.count_distinct(group).alias("n_groups"))


def cl_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Centers of separate groups, in order, with their sizes: any start leads to the group means."""
    points = separate_points(spark, sf_dir, *LINE_KEYS)
    centers = kmeans(points, SEPARATE_GROUPS, 10, seed=START_SEED, ids=LINE_KEYS)
    ordered = centers[centers[:, 0].argsort()]
    return _center_rows(spark, ordered).join(objectives.cluster_group_sizes(points, ordered), "cluster_id")


def cl_kmeans_gain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lloyd rounds never make the start worse, and end at the best cost."""
    points = separate_points(spark, sf_dir, *LINE_KEYS)
    first = initial_centers(points, SEPARATE_GROUPS, seed=START_SEED, ids=LINE_KEYS)
    row = objectives.compare_centers(
        points.withColumn("grp", F.lit("all")), first, kmeans(points, SEPARATE_GROUPS, 10, init=first), groups=("all",)
    )
    return row.select(
        F.round("phi_fair", 6).alias("cost"), (F.col("phi_fair") <= F.col("phi_standard") * (1 + 1e-9)).alias("not_worse")
    )


def cl_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standard and fair centers of separate groups, from one random start."""
    with held(separate_points(spark, sf_dir, *LINE_KEYS)) as points:
        first = initial_centers(points, SEPARATE_GROUPS, seed=START_SEED, ids=LINE_KEYS)
        standard = kmeans(points, SEPARATE_GROUPS, 5, init=first)
        fair_centers = fair.fair_kmeans(points, SEPARATE_GROUPS, 5, init=first)
        row = objectives.compare_centers(points, standard, fair_centers)
        rounded = row.select(F.round("phi_standard", 6).alias("phi_standard"), F.round("phi_fair", 6).alias("phi_fair"))
        return spark.createDataFrame(rounded.collect(), rounded.schema)  # one row


def cl_compare_fixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Objective of the given centers and of the fair centers after three rounds from them."""
    points = line_points(spark, sf_dir)
    better = fair.fair_kmeans(points, 4, 3, init=CENTERS, cache=False)
    row = objectives.compare_centers(points, CENTERS, better)
    return row.select(F.round("phi_standard", 6).alias("phi_standard"), F.round("phi_fair", 6).alias("phi_fair"))


# --- fair k-means -------------------------------------------------------------------------


def _aligned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups.align_groups(groups.group_stats(line_points(spark, sf_dir), CENTERS))


def fl_cluster_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    means = [
        F.round(F.get(f"mean_{g}", F.lit(j)), 6).alias(f"mean_{g}_{axis}")
        for g in ("a", "b")
        for j, axis in enumerate(("x", "y"))
    ]
    return _aligned(spark, sf_dir).select("cluster_id", "n_a", "n_b", *means, F.round("ell", 6).alias("ell"))


def fl_cluster_stats_vec(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = groups.group_stats(vector_points(spark, sf_dir), vector_centers(spark, sf_dir))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda t, v: t + v)
    means = [
        F.round(f(f"mean_{g}"), 6).alias(f"mean_{g}_{name}") for g in ("a", "b") for name, f in (("first", _x), ("sum", total))
    ]
    return groups.align_groups(stats).select(
        "cluster_id", "n_a", "n_b", *means, *[F.round(c, 6).alias(c) for c in ("ss_a", "ss_b", "ell")]
    )


def fl_fractions(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = groups.group_fractions(_aligned(spark, sf_dir))
    return shares.select("cluster_id", F.round("alpha", 9).alias("alpha"), F.round("beta", 9).alias("beta"))


def fl_fixed_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = groups.fixed_terms(_aligned(spark, sf_dir))
    return terms.select(F.round("fixed_a", 6).alias("fixed_a"), F.round("fixed_b", 6).alias("fixed_b"))


def fl_fixed_terms_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = groups.align_groups(groups.group_stats(line_points(spark, sf_dir), GRID))
    return groups.fixed_terms(stats).select(F.round("fixed_a", 6).alias("fixed_a"), F.round("fixed_b", 6).alias("fixed_b"))


def fl_gamma(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = fair.fair_step(line_points(spark, sf_dir), CENTERS)
    return spark.range(1).select(
        F.lit(step.gamma).alias("gamma"), F.round(F.lit(step.f_a), 6).alias("fa"), F.round(F.lit(step.f_b), 6).alias("fb")
    )


def fl_centers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _center_rows(spark, fair.fair_step(line_points(spark, sf_dir), CENTERS).centers)


def fl_lloyd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _center_rows(spark, fair.fair_kmeans(line_points(spark, sf_dir), 4, 3, init=CENTERS, cache=False))


def fl_resumed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three rounds of which the first is of an earlier run: the second run goes on from the log."""
    points, log = line_points(spark, sf_dir), scratch_dir(spark, "rounds")
    fair.fair_kmeans(points, 4, 1, init=CENTERS, cache=False, log=log)
    return _center_rows(spark, fair.fair_kmeans(points, 4, 3, init=CENTERS, cache=False, log=log))


def fl_lloyd_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    centers = fair.fair_kmeans(line_points(spark, sf_dir), len(GRID), 3, init=GRID, cache=False)
    return _center_rows(spark, centers)


# --- frequencies and sketches -------------------------------------------------------------


def _frequencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frequency.item_frequencies(event_items(spark, sf_dir))


def _sketch(spark: SparkSession, sf_dir: str) -> sketch.Sketch:
    return sketch.build_sketch(event_items(spark, sf_dir), HASHES)


def sk_parse_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = event_items(spark, sf_dir).select(F.col("item").cast("string").alias("value"))
    return frequency.item_frequencies(parse_items(lines)).agg(
        F.count(F.lit(1)).alias("n_distinct"), F.sum("cnt").alias("n"), F.sum(F.col("item") * F.col("cnt")).alias("total")
    )


def sk_exact_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _frequencies(spark, sf_dir)


def sk_merge_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts per event type, then merged."""
    events = table(spark, sf_dir, "events")
    partial = events.groupBy("event_type", F.col("user_id").alias("item")).agg(F.count(F.lit(1)).alias("cnt"))
    return frequency.merge_frequencies(partial)


def sk_cm_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sketch(spark, sf_dir).cells.select("r", "c", F.col("cm").alias("cnt"))


def sk_cs_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sketch(spark, sf_dir).cells.select("r", "c", F.col("cs").alias("cnt"))


def sk_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketch of the clicks and the sketch of all other events, merged."""
    events = table(spark, sf_dir, "events")
    clicks = F.coalesce(F.col("event_type") == "click", F.lit(False))
    parts = [
        sketch.build_sketch(events.where(side).select(F.col("user_id").alias("item")), HASHES) for side in (clicks, ~clicks)
    ]
    return sketch.merge_sketches(*parts).cells.select("r", "c", F.col("cm").alias("cnt"), F.col("cs").alias("signed"))


def sk_cm_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = _frequencies(spark, sf_dir)
    return sketch.estimate_cm(freq, sketch.build_sketch(freq, HASHES, weight="cnt"))


def sk_cs_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = _frequencies(spark, sf_dir)
    return sketch.estimate_cs(freq, sketch.build_sketch(freq, HASHES, weight="cnt"))


def sk_even_estimate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An even number of rows: the median is the rounded mean of the middle two."""
    freq = _frequencies(spark, sf_dir)
    found = sketch.with_estimates(freq, sketch.build_sketch(freq, EVEN_HASHES, weight="cnt"))
    return found.select("item", "cm_est", "cs_est")


def sk_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = _frequencies(spark, sf_dir)
    top = sketch.heavy_hitters(freq, sketch.build_sketch(freq, HASHES, weight="cnt"), TOP_K)
    return top.select("item", "cnt", "cm_est").orderBy("item")


def sk_topk_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = _frequencies(spark, sf_dir)
    row = sketch.topk_error(freq, sketch.build_sketch(freq, HASHES, weight="cnt"), TOP_K)
    return row.select(F.round("err_cm", 9).alias("err_cm"), F.round("err_cs", 9).alias("err_cs"))


def _rounded_report(row: DataFrame) -> DataFrame:
    return row.select(
        "n", "n_distinct", "n_topk", F.round("err_cm", 9).alias("err_cm"), F.round("err_cs", 9).alias("err_cs")
    )


def sk_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = _frequencies(spark, sf_dir)
    return _rounded_report(sketch.sketch_report(freq, sketch.build_sketch(freq, HASHES, weight="cnt"), TOP_K))


def sk_report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    freq = _frequencies(spark, sf_dir)
    return reports.stream_lines(freq, sketch.build_sketch(freq, HASHES, weight="cnt"), TOP_K)


def sk_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registers.item_registers(event_items(spark, sf_dir))


def sk_distinct_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents: how many there are, estimated from merged registers of two halves."""
    tokens = words.words(documents(spark, sf_dir), "text").select(F.col("word").alias("item"))
    half = F.pmod(F.xxhash64("item"), F.lit(2)) == 0
    merged = registers.merge_registers(registers.item_registers(tokens.where(half)), registers.item_registers(tokens.where(~half)))
    return registers.estimate_distinct(merged).select(F.round("n_distinct", 4).alias("n_distinct"))


# --- streams ------------------------------------------------------------------------------


def _event_stream(spark: SparkSession, sf_dir: str, work: str) -> DataFrame:
    """The events as files that arrive over several micro-batches."""
    items = event_items(spark, sf_dir)
    items.repartition(STREAM_CHUNKS).write.parquet(f"{work}/incoming")
    return spark.readStream.schema(items.schema).option("maxFilesPerTrigger", 1).parquet(f"{work}/incoming")


def st_exact_freq(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "freq")
    query = running.start_frequencies(
        _event_stream(spark, sf_dir, work), f"{work}/table", f"{work}/checkpoint", availableNow=True
    )
    query.awaitTermination()
    running.compact_frequencies(spark, f"{work}/table")
    return running.read_frequencies(spark, f"{work}/table")


def st_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "sketch")
    query = running.start_sketch(
        _event_stream(spark, sf_dir, work), HASHES, f"{work}/table", f"{work}/checkpoint", availableNow=True
    )
    query.awaitTermination()
    return running.read_sketch(spark, f"{work}/table", HASHES).cells


def _arriving(spark: SparkSession, sf_dir: str, work: str) -> tuple[Iterator[DataFrame], int]:
    """Streams of the events in four parts by id, of which one more has arrived each time; 11/20 of their number.

    One pass writes all parts; events without an id come last.
    """
    events = table(spark, sf_dir, "events").select("event_id", F.col("user_id").alias("item"))
    n, top = events.agg(F.count(F.lit(1)), F.max("event_id")).first()
    part = F.floor(F.col("event_id") * STREAM_CHUNKS / F.lit((top or 0) + 1))
    placed = F.coalesce(F.greatest(part, F.lit(0)), F.lit(STREAM_CHUNKS - 1)).cast("int")
    events.select("item", placed.alias("part")).write.partitionBy("part").parquet(f"{work}/incoming")
    # The pattern lets one more folder arrive each time; the stream knows what it has read.
    read = spark.readStream.schema("item bigint")
    return (read.parquet(f"{work}/incoming/part=[0-{last}]") for last in range(STREAM_CHUNKS)), max(1, n * 11 // 20)


def _prefix_run(spark: SparkSession, sf_dir: str) -> tuple[str, int]:
    """Let the events arrive, one micro-batch each part, and stop after 11/20 of them."""
    work = scratch_dir(spark, "prefix")
    streams, threshold = _arriving(spark, sf_dir, work)
    for arrived in streams:
        stream = prefix.start_prefix_stream(
            arrived, HASHES, threshold, f"{work}/out", f"{work}/checkpoint", availableNow=True
        )
        stream.query.awaitTermination()
    return f"{work}/out", threshold


def st_until(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stop, decided by the state of the stream; each part is read by a query that starts again."""
    work = scratch_dir(spark, "until")
    streams, threshold = _arriving(spark, sf_dir, work)
    for arrived in streams:
        closing.start_until(arrived, threshold, f"{work}/out", f"{work}/checkpoint", availableNow=True).awaitTermination()
    return closing.read_until(spark, f"{work}/out")


def st_threshold_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix.prefix_frequencies(spark, *_prefix_run(spark, sf_dir))


def st_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    out, threshold = _prefix_run(spark, sf_dir)
    return _rounded_report(prefix.prefix_report(spark, out, threshold, HASHES, TOP_K))


def st_registers(spark: SparkSession, sf_dir: str) -> DataFrame:
    work = scratch_dir(spark, "registers")
    items = _event_stream(spark, sf_dir, work)
    running.start_registers(items, f"{work}/table", f"{work}/checkpoint", availableNow=True).awaitTermination()
    running.compact_registers(spark, f"{work}/table")
    return running.read_registers(spark, f"{work}/table")


def st_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events through the replayable source: every run goes on where the checkpoint of the last one stands."""
    n = table(spark, sf_dir, "events").count()
    work = scratch_dir(spark, "replay")
    for _ in range(STREAM_CHUNKS):
        items = table_items(
            spark, f"{sf_dir}/events.parquet", f"{work}/checkpoint", "user_id", max(1, -(-n // STREAM_CHUNKS)), max(1, n // 16)
        )
        running.start_frequencies(items, f"{work}/table", f"{work}/checkpoint", availableNow=True).awaitTermination()
    return running.read_frequencies(spark, f"{work}/table")


def st_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running counts whose finished batches are folded while the stream goes on, folded folders removed."""
    work = scratch_dir(spark, "compacted")
    items = _event_stream(spark, sf_dir, work)
    query = running.start_frequencies(items, f"{work}/table", f"{work}/checkpoint", processingTime="0 seconds")
    try:
        while query.isActive and len(query.recentProgress) < STREAM_CHUNKS // 2 and not query.awaitTermination(0.2):
            pass
        running.compact_frequencies(spark, f"{work}/table")
        query.processAllAvailable()
    finally:
        query.stop()
    running.compact_frequencies(spark, f"{work}/table")
    tables.vacuum(spark, f"{work}/table", 0)
    return running.read_frequencies(spark, f"{work}/table")


# --- ordered tables -----------------------------------------------------------------------


def _ordered_events(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[Column]]:
    events = table(spark, sf_dir, "events").select("event_id", "ts", "user_id")
    return events, [F.asc_nulls_first("ts"), F.asc_nulls_first("event_id")]


def wn_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Position, and the running sum of user ids, of all events by time."""
    events, order = _ordered_events(spark, sf_dir)
    found = ordering.running_sums(events, {"running": F.col("user_id")}, *order, blocks=16)
    return found.select("event_id", "place", "running")


def wn_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events by time until their user ids add up to half of all."""
    events, order = _ordered_events(spark, sf_dir)
    half = (events.agg(F.sum("user_id")).first()[0] or 0) // 2
    found = ordering.prefix_reaching(events, F.col("user_id"), max(1, half), *order, blocks=16)
    return found.select("event_id", "place", "running")


# --- words --------------------------------------------------------------------------------


def wc_num_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.document_count(documents(spark, sf_dir))


def wc_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_counts(documents(spark, sf_dir), "text")


def wc_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_counts(documents(spark, sf_dir), "text", salt=16)


def wc_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_counts(documents(spark, sf_dir), "text", by_partition=True)


def wc_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.distinct_words(documents(spark, sf_dir), "text")


def wc_avg_len(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = words.average_word_length(documents(spark, sf_dir), "text")
    return row.select(F.round("avg_len", 9).alias("avg_len"))


# --- generated points ---------------------------------------------------------------------


def _synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point for each order, by its key, in as many clusters as there are nations."""
    orders = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    k = table(spark, sf_dir, "nation").count()
    return synth_points(spark, orders.count(), k, seed=SYNTH_SEED, ids=orders)


def syn_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synthetic(spark, sf_dir).select(
        F.format_string("%.3f", _x()).cast("double").alias("x"),
        F.format_string("%.3f", _y()).cast("double").alias("y"),
        "grp",
    )


def syn_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synthetic(spark, sf_dir).groupBy("cluster_id").agg(
        F.count_if(F.col("grp") == "A").alias("na"), F.count_if(F.col("grp") == "B").alias("nb")
    )


QUERIES = {
    q.__name__: q
    for q in (
        pt_parse,
        pt_parse_any_dim,
        pt_text_roundtrip,
        pt_text_roundtrip_vec,
        pt_rejected,
        pt_counts,
        pt_dim,
        cl_assign,
        cl_assign_grid,
        cl_assign_vec,
        cl_assign_table,
        cl_bounded,
        cl_std_objective,
        cl_fair_objective,
        cl_group_sizes,
        cl_group_sizes_grid,
        cl_report,
        cl_report_totals,
        cl_report_text,
        cl_start_picks,
        cl_init,
        cl_kmeans,
        cl_kmeans_gain,
        cl_compare,
        cl_compare_fixed,
        fl_cluster_stats,
        fl_cluster_stats_vec,
        fl_fractions,
        fl_fixed_terms,
        fl_fixed_terms_grid,
        fl_gamma,
        fl_centers,
        fl_lloyd,
        fl_resumed,
        fl_lloyd_grid,
        sk_parse_items,
        sk_exact_freq,
        sk_merge_freq,
        sk_cm_table,
        sk_cs_table,
        sk_merge,
        sk_cm_estimate,
        sk_cs_estimate,
        sk_even_estimate,
        sk_topk,
        sk_topk_error,
        sk_report,
        sk_report_text,
        sk_registers,
        sk_distinct_approx,
        st_exact_freq,
        st_sketch,
        st_threshold_prefix,
        st_until,
        st_report,
        st_registers,
        st_replay,
        st_compacted,
        wn_running,
        wn_prefix,
        wc_num_docs,
        wc_counts,
        wc_salted,
        wc_partitioned,
        wc_distinct,
        wc_avg_len,
        syn_points,
        syn_counts,
    )
}
