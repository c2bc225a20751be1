"""Catalog profile: every result frame of the report over one set of typed rows, parsed and written once."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise import constants as K
from shelfwise.operators import profile as P
from shelfwise.session import cut_lineage


def run(cells: DataFrame) -> dict[str, DataFrame]:
    rows = cut_lineage(P.catalog_rows(P.drop_blank_rows(cells)))
    valid = P.valid_rows(rows)
    counts = P.category_counts(valid)
    return {
        "totals": P.profile_totals(valid),
        "categories": P.ranked_categories(counts),
        "availability": P.availability_counts(valid),
        "windows": P.window_stats(valid),
        "gemstones": P.pattern_summary(counts, K.GEMSTONE_PATTERNS),
        "audience": P.pattern_summary(counts, K.AUDIENCE_PATTERNS),
        "style": P.pattern_summary(counts, K.STYLE_PATTERNS),
        "taxonomy": P.taxonomy_mapping(counts),
        "tree": P.taxonomy_tree(counts),
        "warnings": P.row_warnings(rows),
        "repeated_ids": P.repeated_ids(valid),
    }
