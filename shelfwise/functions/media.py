"""Gates over image and mask metric rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from shelfwise import constants as K


def _collect(*pairs: tuple[Column, str]) -> Column:
    return F.array_compact(F.array(*[F.when(condition, message) for condition, message in pairs]))


def image_gate_reasons(
    mean_drift: Column,
    p95_drift: Column,
    channel_drift: Column,
    detail_ratio: Column,
    same_size: Column,
    icc_lost: Column,
    alpha_lost: Column,
    checksum_changed: Column,
) -> Column:
    return _collect(
        (~same_size, "dimension mismatch"),
        (mean_drift > K.MAX_MEAN_DRIFT, "mean color drift exceeds gate"),
        (p95_drift > K.MAX_P95_DRIFT, "p95 color drift exceeds gate"),
        (channel_drift > K.MAX_CHANNEL_DRIFT, "channel color drift exceeds gate"),
        (~detail_ratio.between(K.MIN_DETAIL_RATIO, K.MAX_DETAIL_RATIO), "detail retention ratio exceeds gate"),
        (icc_lost, "embedded ICC profile was not retained"),
        (alpha_lost, "alpha channel was not retained"),
        (checksum_changed, "original file checksum changed"),
    )


def mask_gate(
    left: Column, top: Column, right: Column, bottom: Column, width: Column, height: Column, nonzero: Column, semi: Column
) -> Column:
    """struct(status, occupancy, semi_ratio, touches_edge, warnings); an empty box is rejected."""
    empty = left.isNull()
    occupancy = nonzero / (width * height)
    semi_ratio = F.when(nonzero > 0, semi / nonzero).otherwise(0.0)
    touches = (left <= 2) | (top <= 2) | (right >= width - 2) | (bottom >= height - 2)
    bad = (occupancy < 0.005) | (occupancy > 0.98)
    warnings = _collect(
        (touches, "product mask touches source image edge; clipping is possible"),
        (semi_ratio > 0.35, "high soft-alpha ratio; thin metal edges or stones require visual review"),
        ((right - left < 24) | (bottom - top < 24), "mask bounding box is unusually small"),
        (bad, "mask occupancy is outside safe pilot range"),
    )
    return F.struct(
        F.when(empty | bad, "REJECT").when(F.size(warnings) > 0, "REVIEW").otherwise("PASS").alias("status"),
        F.when(empty, 0.0).otherwise(F.round(occupancy, 6)).alias("occupancy"),
        F.when(empty, 0.0).otherwise(F.round(semi_ratio, 6)).alias("semi_ratio"),
        F.coalesce(touches, F.lit(False)).alias("touches_edge"),
        F.when(empty, F.array(F.lit("empty alpha mask"))).otherwise(warnings).alias("warnings"),
    )


def large_stone_candidate(share: Column, concentration: Column) -> Column:
    return share.between(0.008, 0.12) & (concentration >= 1.8)


def resize_plan(width: Column, height: Column, max_edge: int = K.IMAGE_MAX_EDGE) -> Column:
    """struct(width, height, scale): shrink to the longest edge, never enlarge; halves round to even."""
    scale = F.least(F.lit(1.0), F.lit(float(max_edge)) / F.greatest(width, height))
    return F.struct(
        F.greatest(F.lit(1), F.bround(width * scale, 0).cast("int")).alias("width"),
        F.greatest(F.lit(1), F.bround(height * scale, 0).cast("int")).alias("height"),
        scale.alias("scale"),
    )
