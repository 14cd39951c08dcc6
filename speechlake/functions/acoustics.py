"""Scalar arithmetic of the landmark grid."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the landmark grid: sample rate, window and hop in samples.
SAMPLE_RATE = 8000
WINDOW_SAMPLES = 1024
HOP_SAMPLES = 512


def frames_to_seconds(frames: Column) -> Column:
    return frames * F.lit(HOP_SAMPLES) / F.lit(float(SAMPLE_RATE))


def seconds_to_frames(seconds: float) -> int:
    """Whole frames inside a span; a 5-second gap is 78 frames."""
    return int(seconds * SAMPLE_RATE / HOP_SAMPLES)


def pack_landmark(f1: Column, f2: Column, dt: Column) -> Column:
    """Two frequency bins and a frame distance in one bigint, ten bits for each of the last two."""
    high = F.shiftleft(f1.cast("bigint"), 20)
    mid = F.shiftleft(f2.cast("bigint"), 10)
    return high.bitwiseOR(mid).bitwiseOR(dt.cast("bigint"))
