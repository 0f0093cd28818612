"""Words of a text as JVM expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

#: Full-width forms of the printable ASCII signs, and the ideographic blank.
WIDE = "".join(chr(c) for c in range(0xFF01, 0xFF5F)) + "　"
NARROW = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)) + " "


#: A sign outside printable ASCII, tabs and line ends: texts without one need no folding but that of case.
ODD = r"[^\t\n\x0B\f\r\x20-\x7e]"


def _every_sign(text):
    return F.lower(F.translate(F.regexp_replace(text, r"[\p{Cf}͏ᅟᅠ឴឵ㅤﾠ︀-️]|[\p{Cc}&&[^\t\n\r\u000B\f]]", ""), WIDE, NARROW))


def folded(text):
    """The text in lower case, narrow, without invisible signs (format and control signs except line breaks and tabs)."""
    return F.when(text.rlike(ODD), _every_sign(text)).otherwise(F.lower(text))


def words(text):
    """Array of the runs of letters and digits of a text; null for null."""
    every = F.regexp_extract_all(_every_sign(text), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
    return F.when(text.rlike(ODD), every).otherwise(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0)))
