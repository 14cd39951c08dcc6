from speechlake.functions.acoustics import frames_to_seconds, pack_landmark
from speechlake.functions.text import (
    audio_suffix,
    collapse_ws,
    dot_ts,
    family_label,
    hhmmss,
    path_stem,
    redact,
    redacted_detail,
    safe_uri,
    srt_ts,
    trunc_ts,
    word_logprob,
)

__all__ = [
    "audio_suffix", "collapse_ws", "dot_ts", "family_label", "frames_to_seconds", "hhmmss",
    "pack_landmark", "path_stem", "redact", "redacted_detail", "safe_uri", "srt_ts",
    "trunc_ts", "word_logprob",
]
