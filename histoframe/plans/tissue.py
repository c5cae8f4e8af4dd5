"""Tissue stage with a plugged-in segmenter."""

from __future__ import annotations

from pyspark.sql import DataFrame

from histoframe.operators import tissue as T
from histoframe.plans.encoders import Segmenter, segment


def segment_tissue(pixels: DataFrame, slides: DataFrame, segmenter: Segmenter, channels: list[int], size: int, stride: int) -> DataFrame:
    """Pixels the overlapping tiles of a segmenter vote for."""
    votes = T.tile_vote(segment(pixels, slides, segmenter, channels, size, stride))
    return votes.filter("tissue").select("slide_id", "y", "x")
