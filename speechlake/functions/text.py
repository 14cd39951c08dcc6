"""Column functions for timestamps, labels, paths and redaction. All stay in the JVM."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Recognised audio suffixes, in alphabetical order.
AUDIO_SUFFIXES = (".aac", ".flac", ".m4a", ".mp3", ".mp4", ".ogg", ".wav", ".wma")

# Fixed value: the characters a Unicode-aware split treats as white space, as a regex class.
UNICODE_SPACE = r"[\t-\r\x1c-\x20\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"

# Token prefixes that are always hidden, the keys an error body is searched
# for, the length an error detail is cut to, and the text shown when there is none.
TOKEN_PATTERN = r"(?:dckr_pat_|hf_|rpa_)[A-Za-z0-9_-]+"
ERROR_KEYS = ("detail", "message", "error", "title")
DETAIL_CHARS = 2000
NO_REASON = "no reason was given"
MASK = "***"


def _clock(total: Column, unit: int) -> Column:
    """HH:MM:SS of a whole count of 1/unit seconds; hours widen past two digits."""
    seconds = F.floor(total / F.lit(unit))
    return F.format_string(
        "%02d:%02d:%02d",
        F.floor(seconds / 3600),
        F.floor(seconds / 60) % 60,
        seconds % 60,
    )


def _at_least_zero(value: Column) -> Column:
    return F.greatest(F.lit(0).cast("bigint"), F.rint(value).cast("bigint"))


def srt_ts(seconds: Column) -> Column:
    """``HH:MM:SS,mmm``; half-even milliseconds, never negative."""
    ms = _at_least_zero(seconds * F.lit(1000))
    return F.concat(_clock(ms, 1000), F.format_string(",%03d", ms % 1000))


def trunc_ts(seconds: Column) -> Column:
    """:func:`srt_ts` with its milliseconds cut off (not rounded to seconds)."""
    return F.substring_index(srt_ts(seconds), ",", 1)


def dot_ts(seconds: Column) -> Column:
    return F.translate(srt_ts(seconds), ",", ".")


def hhmmss(seconds: Column) -> Column:
    """Half-even whole seconds as ``HH:MM:SS``."""
    return _clock(_at_least_zero(seconds), 1)


def collapse_ws(text: Column) -> Column:
    """Every run of Unicode white space becomes one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, UNICODE_SPACE + "+", " "))


def is_blank(text: Column) -> Column:
    return F.coalesce(~text.rlike("[^" + UNICODE_SPACE[1:]), F.lit(True))


def word_logprob(probability: Column) -> Column:
    """Natural log of a positive probability, else null (and so absent from JSON)."""
    return F.when(probability > 0, F.ln(probability))


def family_label(model: Column, family: str) -> Column:
    """Last path component of a model id, with the family name put before it when missing."""
    name = F.substring_index(model, "/", -1)
    return F.when(F.lower(name).startswith(family), name).otherwise(
        F.concat(F.lit(f"{family}-"), name)
    )


def path_name(path: Column) -> Column:
    return F.substring_index(F.regexp_replace(path, "/+$", ""), "/", -1)


def path_stem(path: Column) -> Column:
    """File name without its last suffix; a leading or trailing dot is not a suffix."""
    return F.regexp_replace(path_name(path), r"(?s)^(.+)\.[^.]+$", "$1")


def without_suffix(path: Column) -> Column:
    """The path itself without the last suffix of its file name."""
    return F.regexp_replace(path, r"(?s)^(.*[^/])\.[^./]+$", "$1")


def path_suffix(path: Column) -> Column:
    """Lower-cased last suffix with its dot, or an empty string."""
    return F.lower(F.regexp_extract(path_name(path), r"(?s)^.+(\.[^.]+)$", 1))


def safe_uri(path: Column) -> Column:
    """Readable, collision-resistant id: cleaned stem (48 characters) and 12 hex digits."""
    stem = F.regexp_replace(path_stem(path), r"[^\p{L}\p{N}]", "_")
    return F.concat_ws("_", F.substring(stem, 1, 48), F.substring(F.sha1(path), 1, 12))


# Audio and video content types and their usual suffixes.
CONTENT_TYPES = {
    "audio/3gpp": ".3gp",
    "audio/3gpp2": ".3g2",
    "audio/aac": ".aac",
    "audio/basic": ".au",
    "audio/mpeg": ".mp3",
    "audio/opus": ".opus",
    "audio/x-aiff": ".aif",
    "audio/x-pn-realaudio": ".ra",
    "audio/x-wav": ".wav",
    "video/mp4": ".mp4",
    "video/mpeg": ".mpeg",
    "video/quicktime": ".mov",
    "video/webm": ".webm",
    "video/x-msvideo": ".avi",
    "video/x-sgi-movie": ".movie",
}


def audio_suffix(url: Column, content_type: Column) -> Column:
    """Suffix of the URL path if recognised, else by content type, else ``.mp3``."""
    from_url = path_suffix(F.substring_index(url, "?", 1))
    pairs = [F.lit(x) for item in CONTENT_TYPES.items() for x in item]
    kind = F.lower(F.trim(F.substring_index(content_type, ";", 1)))
    from_type = F.try_element_at(F.create_map(*pairs), kind)
    return F.coalesce(
        F.when(from_url.isin(*AUDIO_SUFFIXES), from_url), from_type, F.lit(".mp3")
    )


def redact(text: Column, secrets: Iterable[str] = (), pattern: str = TOKEN_PATTERN) -> Column:
    """Hide known secrets, raw and JSON-escaped, and anything that looks like a token."""
    for secret in secrets:
        if not secret:
            continue
        for form in dict.fromkeys((secret, json.dumps(secret)[1:-1])):
            text = F.regexp_replace(text, re.escape(form), F.lit(MASK))
    return F.regexp_replace(text, pattern, F.lit(MASK))


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def redacted_detail(
    body: Column, secrets: Iterable[str] = (), pattern: str = TOKEN_PATTERN
) -> Column:
    """Reason found in an error body: redacted, taken from its JSON keys, one line, cut.

    The first key with a value that is not empty, zero or false gives the reason, as JSON; the
    last key counts even then. Other bodies are shown as they are. Only what starts as an object is parsed: nothing else has keys.
    """
    def reason(clean):
        def told(values):
            present = [F.when(values[i] != "null", values[i]) for i in range(len(ERROR_KEYS))]
            telling = [F.when(~value.isin('""', "0", "false", "[]", "{}"), value) for value in present]
            return F.coalesce(*telling, present[-1], clean)

        keyed = lambda parsed: F.array(*[
            F.to_json(F.try_variant_get(parsed, f"$.{key}", "variant")) for key in ERROR_KEYS])
        from_keys = _once(_once(F.try_parse_json(clean), keyed), told)
        return F.when(clean.rlike(r"^[\s\x{FEFF}]*\{"), from_keys).otherwise(clean)

    line = F.substring(collapse_ws(_once(redact(body, secrets, pattern), reason)), 1, DETAIL_CHARS)
    return _once(line, lambda shown: F.when(shown == "", F.lit(NO_REASON)).otherwise(shown))
