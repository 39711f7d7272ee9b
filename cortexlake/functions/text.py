"""Column helpers for catalog text: null fill, description cleaning, UID
suffixes, object keys and the tags derived from them.

Every helper returns a ``Column`` built from JVM-side expressions, so whole
chains collapse into one projection inside whole-stage codegen.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str

NULL_TEXT = "NULL"

# Object-key prefixes of the two catalog landing modes.
TWO_PASS_PREFIX = "data/TCIAData_p3"
ONE_PASS_PREFIX = "data/TCIAData"
ARCHIVE_NAME = "blob.zip"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --------------------------------------------------------------------- P1
def null_fill(c: ColumnOrName, text: str = NULL_TEXT) -> Column:
    """null -> the text ``NULL`` (any type is rendered as text first)."""
    return F.coalesce(_c(c).cast("string"), F.lit(text))


# ----------------------------------------------------------- F2 / F3 rules
def _python_space_class() -> str:
    """Java regex character class equal to Python's ``\\s`` on str, derived
    from ``str.isspace`` (Java's own ``\\s`` is ASCII-only, ``(?U)\\s`` misses
    the four ASCII separators U+001C..U+001F)."""
    cps = [cp for cp in range(sys.maxunicode + 1) if chr(cp).isspace()]
    ranges, start, prev = [], cps[0], cps[0]
    for cp in cps[1:] + [-1]:
        if cp != prev + 1:
            ranges.append((start, prev))
            start = cp
        prev = cp
    parts = [f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges]
    return "[" + "".join(parts) + "]"


PY_SPACE = _python_space_class()

# The ordered rewrite rules (pattern, replacement) of the two
# description cleaners, applied after upper-casing. Order matters.
# Two-pass cleaner (ran as Spark/Java regex; \s is ASCII there):
TWO_PASS_RULES = [
    (r"[(]", ""),
    (r"[)]", ""),
    (r"[*]", ""),
    (r"[+]", ""),
    (r"\s+", "_"),
    (r"[?]*[/]", "over"),
    (r"[/]{1}", ""),
    (r"[?]$", ""),
    (r"^[_]", ""),
    (r"[_]$", ""),
]
# One-pass cleaner (ran as Python re; \s is Python's Unicode whitespace):
ONE_PASS_RULES = [
    (r"[*]", ""),
    (r"[+]", ""),
    (PY_SPACE + "+", "_"),
    (r"[?]*[/]", "over"),
    (r"[/]{1}", "-"),
    (r"[(]", ""),
    (r"[)]", ""),
    (r"[?]$", ""),
    (r"^[_]", ""),
    (r"[_]$", ""),
]


def _apply_rules(c: Column, rules) -> Column:
    for pattern, repl in rules:
        c = F.regexp_replace(c, pattern, repl)
    return c


def clean_description(c: ColumnOrName, mode: str = "twopass") -> Column:
    """F1 + F2/F3: upper-case, then the mode's rewrite rules; null -> NULL."""
    if mode == "twopass":
        # the two-pass job fills nulls before cleaning ("NULL" survives as is)
        return _apply_rules(F.upper(null_fill(c)), TWO_PASS_RULES)
    if mode == "onepass":
        return null_fill(_apply_rules(F.upper(_c(c)), ONE_PASS_RULES))
    raise ValueError(f"unknown clean mode {mode!r}")


# ----------------------------------------------------------------- F4 / F5
def uid_suffix_fixed(c: ColumnOrName) -> Column:
    """characters 60..64 (1-based); empty text when the UID is shorter."""
    return F.substring(_c(c), 60, 5)


def uid_suffix_last5(c: ColumnOrName) -> Column:
    """the last five characters (equals F4 for 64-character UIDs)."""
    return F.right(_c(c), F.lit(5))


# --------------------------------------------------------------------- F6
def build_object_key(prefix: str, collection: ColumnOrName, patient: ColumnOrName,
                     series_date: ColumnOrName, study_sfx: ColumnOrName,
                     series_number: ColumnOrName, description: ColumnOrName,
                     instance_sfx: ColumnOrName) -> Column:
    """``<prefix>/Coll/Patient/Date-studySfx/Number-Descr-instSfx/blob.zip``;
    each component is null-filled so that no key is ever NULL."""
    parts = [null_fill(x) for x in (collection, patient, series_date, study_sfx,
                                     series_number, description, instance_sfx)]
    coll, pat, date, ssfx, num, descr, isfx = parts
    return F.concat(F.lit(prefix + "/"), coll, F.lit("/"), pat, F.lit("/"),
                    date, F.lit("-"), ssfx, F.lit("/"),
                    num, F.lit("-"), descr, F.lit("-"), isfx,
                    F.lit("/" + ARCHIVE_NAME))


# --------------------------------------------------------------------- F7
def volume_key_from_subject(subject: ColumnOrName) -> Column:
    """Object key of a subject's T1w volume in the open connectome layout."""
    s = _c(subject).cast("string")
    return F.format_string("HCP_1200/%s/unprocessed/3T/T1w_MPR1/%s_3T_T1w_MPR1.nii.gz", s, s)


# --------------------------------------------------------------- F8 - F10
def object_tag(key: ColumnOrName) -> Column:
    """F8 (archive keys): drop every ``/blob.zip``, split on ``/``, keep the
    parts from the fourth on, join them with ``@``."""
    parts = F.split(F.replace(_c(key), F.lit("/" + ARCHIVE_NAME), F.lit("")), "/", -1)
    return F.array_join(F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(0))), "@")


def subject_tag(subject: ColumnOrName) -> Column:
    """F8 (subject volumes)."""
    return F.concat(F.lit("hcp_subject_"), _c(subject).cast("string"))


def output_prefix(out_dir: str, tag: ColumnOrName) -> Column:
    """``<out dir>/<tag>``."""
    return F.concat(F.lit(out_dir.rstrip("/") + "/"), _c(tag))


def output_tag_from_file(path: ColumnOrName) -> Column:
    """F10 (archive volumes): base name without ``.nii.gz``, ``(`` and ``)``."""
    base = F.element_at(F.split(_c(path), "/", -1), -1)
    return F.translate(F.replace(base, F.lit(".nii.gz"), F.lit("")), "()", "")


def output_tag_for_subject(subject: ColumnOrName, axis_name: ColumnOrName) -> Column:
    """F10 (subject volumes): ``subject{s}_3T_T1w_MPR1_{axis}``."""
    return F.format_string("subject%s_3T_T1w_MPR1_%s", _c(subject).cast("string"), _c(axis_name))


# ------------------------------------------------------------ F14 / F15
def source_request_url(series_uid: ColumnOrName, base: str) -> Column:
    """per-series download URL (the column only; nothing is fetched)."""
    return F.concat(F.lit(base), _c(series_uid))


def job_tag(key: ColumnOrName) -> Column:
    """key without ``/blob.zip`` and with ``/`` -> ``-`` (log names)."""
    return F.replace(F.replace(_c(key), F.lit("/" + ARCHIVE_NAME), F.lit("")),
                     F.lit("/"), F.lit("-"))
