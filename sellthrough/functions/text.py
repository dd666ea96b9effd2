"""Text helpers: trimming, header names, labels."""
from __future__ import annotations

from pyspark.sql import Column, functions as F

from sellthrough.schemas import MAX_LABEL_CHARS, SYNONYMS

# Everything Unicode calls white space, including the separators 1C-1F. Removing a fixed character set with btrim /
# translate stays in generated code and is far cheaper per row than a regular expression.
WHITESPACE = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B),
                               0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip_text(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITESPACE))


def standard_header(name: object) -> str:
    """Standard column name of one header cell; an unknown name is returned lower-cased without symbols."""
    plain = "".join(filter(str.isalnum, str(name).lower()))
    return SYNONYMS.get(plain, plain)


def normal_header(c: Column) -> Column:
    """Column form of the header rule's first half: lower case, letters and digits only."""
    return F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]", "")


def standard_name(c: Column) -> Column:
    """Column form of `standard_header`."""
    plain = normal_header(c)
    names = F.create_map(*[F.lit(v) for pair in SYNONYMS.items() for v in pair])
    return F.coalesce(F.try_element_at(names, plain), plain)


def money_text(c: Column) -> Column:
    """Money as shortest text with at least one decimal: 32.50 -> 32.5, 55.00 -> 55.0, 12.34 -> 12.34."""
    return F.regexp_replace(c.cast("decimal(18,2)").cast("string"), "0$", "")


def load_id(pipeline_id: Column, started_at: Column) -> Column:
    return F.concat(pipeline_id, F.lit("_"), F.date_format(started_at, "yyyyMMdd'T'HHmmss"))


def file_label(order: Column, path: Column) -> Column:
    """Aggregate: the one file's path, or `N files: first .. last` in the given order, at most 500 characters."""
    first, last, n = F.min_by(path, order), F.max_by(path, order), F.count(path)
    many = F.concat(n.cast("string"), F.lit(" files: "), first, F.lit(" .. "), F.substring_index(last, "/", -1))
    return F.substring(F.when(n > 1, many).otherwise(first), 1, MAX_LABEL_CHARS)
