"""Fair clustering and item-stream sketches as Spark DataFrame operators.

Points are DataFrames with ``features array<double>`` and ``grp string``; items
are DataFrames with ``item bigint``; documents are DataFrames with a text column.
"""

from fairtally.functions.hashing import HashFamily
from fairtally.operators.fair import fair_kmeans, fair_step
from fairtally.operators.frequency import item_frequencies, merge_frequencies, top_k_with_ties
from fairtally.operators.groups import align_groups, fixed_terms, group_fractions, group_stats
from fairtally.operators.kmeans import initial_centers, kmeans, lloyd_round
from fairtally.operators.nearest import with_nearest
from fairtally.operators.objectives import (
    cluster_group_sizes,
    clustering_report,
    compare_centers,
    fair_objective,
    group_counts,
    point_dimensions,
    standard_objective,
)
from fairtally.operators.sketch import (
    Sketch,
    build_sketch,
    estimate_cm,
    estimate_cs,
    heavy_hitters,
    merge_sketches,
    sketch_report,
    topk_error,
    with_estimates,
)
from fairtally.operators.words import average_word_length, distinct_words, document_count, word_counts
from fairtally.operators.bounds import bounded_kmeans
from fairtally.operators.center_table import nearest_in_table
from fairtally.operators.ordering import numbered, prefix_reaching, running_sums
from fairtally.operators.registers import estimate_distinct, item_registers, merge_registers
from fairtally.operators.start import start_centers
from fairtally.sources.checked import read_items_checked, read_points_checked
from fairtally.sources.item_table import table_items
from fairtally.sources.items import file_items, parse_items, socket_items
from fairtally.sources.points import parse_points, read_lines, read_points, write_points
from fairtally.sources.synthetic import synth_points
from fairtally.streaming.closing import read_until, start_until
from fairtally.streaming.prefix import prefix_frequencies, prefix_report, prefix_sketch, start_prefix_stream
from fairtally.streaming.running import (
    compact_frequencies,
    compact_registers,
    compact_sketch,
    read_frequencies,
    read_registers,
    read_sketch,
    start_frequencies,
    start_registers,
    start_sketch,
)
from fairtally.streaming.tables import vacuum

__all__ = [
    "HashFamily",
    "Sketch",
    "align_groups",
    "average_word_length",
    "bounded_kmeans",
    "build_sketch",
    "cluster_group_sizes",
    "clustering_report",
    "compact_frequencies",
    "compact_registers",
    "compact_sketch",
    "compare_centers",
    "distinct_words",
    "document_count",
    "estimate_cm",
    "estimate_cs",
    "estimate_distinct",
    "fair_kmeans",
    "fair_objective",
    "fair_step",
    "file_items",
    "fixed_terms",
    "group_counts",
    "group_fractions",
    "group_stats",
    "heavy_hitters",
    "initial_centers",
    "item_frequencies",
    "item_registers",
    "kmeans",
    "lloyd_round",
    "merge_frequencies",
    "merge_registers",
    "merge_sketches",
    "nearest_in_table",
    "numbered",
    "parse_items",
    "parse_points",
    "point_dimensions",
    "prefix_frequencies",
    "prefix_reaching",
    "prefix_report",
    "prefix_sketch",
    "read_frequencies",
    "read_items_checked",
    "read_lines",
    "read_points",
    "read_points_checked",
    "read_registers",
    "read_sketch",
    "read_until",
    "running_sums",
    "sketch_report",
    "socket_items",
    "standard_objective",
    "start_centers",
    "start_frequencies",
    "start_prefix_stream",
    "start_registers",
    "start_sketch",
    "start_until",
    "synth_points",
    "table_items",
    "top_k_with_ties",
    "topk_error",
    "vacuum",
    "with_estimates",
    "with_nearest",
    "word_counts",
    "write_points",
]
