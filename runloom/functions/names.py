"""Names taken from URLs and read-file names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The mark of a mate in a read-file name, in any case, and the suffixes of
# read files.
MATE = r"(?i)(?:^|[._-])R?([12])(?:[._-]|$)"
READ_SUFFIXES = (".fastq.gz", ".fq.gz", ".fastq", ".fq")


def last_component(path: Column) -> Column:
    """Last non-empty component of a path."""
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def url_file_name(url: Column) -> Column:
    """Decoded file name in the path of a URL; empty when the path is empty."""
    path = F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    decoded = F.coalesce(F.try_url_decode(F.replace(path, F.lit("+"), F.lit("%2B"))), path)
    return last_component(decoded)


def is_read_file(name: Column) -> Column:
    """Whether a file name has the suffix of a read file, in any case."""
    lowered = F.lower(name)
    found = F.lit(False)
    for suffix in READ_SUFFIXES:
        found = found | lowered.endswith(suffix)
    return found


def mate_number(name: Column) -> Column:
    """``1`` or ``2`` when the file name carries a mate mark, else null."""
    return F.nullif(F.regexp_extract(name, MATE, 1), F.lit(""))


def pair_key(name: Column) -> Column:
    """File name with the mate digit replaced, equal for the two mates of a pair."""
    mark = F.regexp_substr(name, F.lit(MATE))
    at = F.regexp_instr(name, F.lit(MATE))
    before = F.substring(name, F.lit(1), at - 1)
    after = F.substring(name, at + F.length(mark), F.length(name))
    return F.when(mark.isNotNull(), F.concat(before, F.translate(mark, "12", "##"), after))


def series_bucket(accession: Column) -> Column:
    """Archive folder of a series accession, null for anything else."""
    upper = F.upper(accession)
    digits = F.regexp_extract(upper, r"^GSE([0-9]+)$", 1)
    stem = F.regexp_replace(digits, r"[0-9]{1,3}$", "")
    return F.when(digits != "", F.concat(F.lit("GSE"), stem, F.lit("nnn")))
