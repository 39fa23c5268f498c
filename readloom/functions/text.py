"""Column expressions for the text conventions of run outputs.

All of them are built-in Catalyst expressions and safe under ANSI mode: text
that does not parse becomes NULL, it never raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# File name endings and the mate marker before them.
FASTQ_ENDING = r"(?i)\.(fastq\.gz|fq\.gz|fastq|fq)$"
MATE_MARK = r"[_-]R?[12](?:_001)?$"
MATE_ONE = r"[_-]R?1(?:_001)?$"
# Ordered replacements that turn a first-mate path into its second mate.
MATE_REPLACEMENTS = [
    ("_1.fastq", "_2.fastq"),
    ("_R1.", "_R2."),
    ("_R1_001.", "_R2_001."),
    (".1.fastq", ".2.fastq"),
    ("_1.fq", "_2.fq"),
    ("_R1.fq", "_R2.fq"),
]
SIZE_UNITS = ["B", "KB", "MB", "GB", "TB", "PB"]


def first_number(text: Column) -> Column:
    """First run of digits and commas, as a long: ``"pairs: 52,280"`` -> 52280."""
    return F.regexp_replace(F.regexp_extract(text, r"([\d,]+)", 1), ",", "").try_cast("bigint")


def percent(text: Column) -> Column:
    """``"93.57%"`` -> 93.57."""
    return F.regexp_replace(F.trim(text), "%+$", "").try_cast("double")


def whole_number(text: Column) -> Column:
    return F.trim(text).try_cast("bigint")


def path_part(path: Column, position: int = -2) -> Column:
    """One element of a slash path; -2 is the folder that names the sample."""
    return F.try_element_at(F.split(path, "/"), F.lit(position))


def file_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def strip_mate_number(name: Column) -> Column:
    return F.regexp_replace(name, "[_-][12]$", "")


def fastq_stem(path: Column) -> Column:
    return F.regexp_replace(file_name(path), FASTQ_ENDING, "")


def fastq_sample(path: Column) -> Column:
    return F.regexp_replace(fastq_stem(path), MATE_MARK, "")


def fastq_mate(path: Column) -> Column:
    """``R1`` or ``R2``; a name without a mate marker is a single-end ``R1``."""
    stem = fastq_stem(path)
    marked = stem.rlike(MATE_MARK)
    return F.when(marked & ~stem.rlike(MATE_ONE), "R2").otherwise("R1")


def has_mate_mark(path: Column) -> Column:
    return fastq_stem(path).rlike(MATE_MARK)


def second_mate_path(path: Column) -> Column:
    """Second-mate path by the ordered literal replacements."""
    for old, new in MATE_REPLACEMENTS:
        path = F.replace(path, F.lit(old), F.lit(new))
    return path


def matrix_sample(header: Column) -> Column:
    """Sample name of a count-matrix column header.

    Paths to a BAM file are named by their folder, other paths by their last
    element; BAM endings are removed.
    """
    named = (
        F.when(header.contains("/") & header.endswith(".bam"), path_part(header, -2))
        .when(header.contains("/"), path_part(header, -1))
        .otherwise(header)
    )
    named = F.replace(named, F.lit("Aligned.sortedByCoord.out.bam"), F.lit(""))
    return F.trim(F.replace(named, F.lit(".bam"), F.lit("")))


def valid_identifier(name: Column, max_length: int = 100) -> Column:
    """Letters, digits, ``_`` and ``-`` only; a trailing newline is rejected."""
    return F.coalesce(name.rlike(r"\A[a-zA-Z0-9_-]{1,%d}\z" % max_length), F.lit(False))


def digits_of(name: Column) -> Column:
    return F.regexp_replace(name, "[^0-9]", "")


def letters_of(name: Column) -> Column:
    return F.regexp_replace(name, "[^A-Za-z]", "")


def readable_size(size: Column) -> Column:
    """Bytes as text with one decimal, 1024 steps, ``B`` to ``PB``."""
    out = F.format_string("%.1f" + SIZE_UNITS[-1], size.cast("double") / 1024.0**5)
    for step in range(len(SIZE_UNITS) - 2, -1, -1):
        scaled = size.cast("double") / 1024.0**step
        out = F.when(scaled < 1024.0, F.format_string("%.1f" + SIZE_UNITS[step], scaled)).otherwise(out)
    return out
