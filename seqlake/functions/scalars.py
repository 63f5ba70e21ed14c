"""Scalar functions of the sequencing operators, all on built-in expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 15  # bases that fit in a bigint at four bits each


def to_path_id(c: Column) -> Column:
    """kb|... to its path form: every | becomes _."""
    return F.when(c.startswith("kb|"), F.replace(c, F.lit("|"), F.lit("_"))).otherwise(c)


def to_display_id(c: Column) -> Column:
    """kb_... to its display form."""
    return F.when(c.startswith("kb_"), F.replace(c, F.lit("kb_"), F.lit("kb|"))).otherwise(c)


def or_empty(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def option_list(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(" "))


def base_name(c: Column) -> Column:
    return F.element_at(F.split(c, "/"), -1)


def extension(c: Column) -> Column:
    return F.regexp_extract(c, r"\.([^./]+)$", 1)


def source_key(src: Column, genome: Column) -> Column:
    """Blanks to ::, then ::kb|genome, then ___ and the key's second part."""
    key = F.concat(F.replace(src, F.lit(" "), F.lit("::")), F.lit("::kb|"), genome)
    return F.concat(key, F.lit("___"), F.get(F.split(key, "::"), F.lit(1)))


def percent(fraction: Column) -> Column:
    return (fraction * 100).cast("int")


def reverse_complement(c: Column) -> Column:
    return F.reverse(F.translate(c, "ACGT", "TGCA"))


def phred(c: Column) -> Column:
    return F.ascii(c) - 33


def read_key(name: Column) -> Column:
    """Read name without the text after a blank and without /1 or /2."""
    return F.regexp_replace(F.regexp_replace(name, r"\s.*$", ""), r"/[12]$", "")


def natural_key(c: Column) -> list[Column]:
    """Sort keys of a name with one number in it: text, number, whole name."""
    number = F.regexp_extract(c, r"(\d+)", 1).try_cast("bigint")
    return [F.regexp_extract(c, r"^(\D*)", 1), F.coalesce(number, F.lit(-1)), c]


def digits(c: Column) -> Column:
    """A sequence with a hexadecimal digit for each base."""
    return F.translate(c, "ACGTN", "12480")


def packed(c: Column, most: int) -> list[Column]:
    """A sequence of at most ``most`` bases as bigints of 15 bases each, four bits a base."""
    return packed_digits(digits(c), most)


def packed_digits(c: Column, most: int) -> list[Column]:
    """:func:`packed` of the :func:`digits` of a sequence."""
    return [
        F.coalesce(F.conv(F.substring(c, i * CHUNK + 1, CHUNK), 16, 10).cast("bigint"), F.lit(0))
        for i in range(math.ceil(most / CHUNK))
    ]


def mismatches(a: list[Column], b: list[Column]) -> Column:
    """Hamming distance of two packed sequences of equal length."""
    total = F.lit(0)
    ones = F.lit(0x111111111111111)
    for x, y in zip(a, b, strict=True):
        d = x.bitwiseXOR(y)
        d = d.bitwiseOR(F.shiftrightunsigned(d, 1))
        d = d.bitwiseOR(F.shiftrightunsigned(d, 2))
        total = total + F.bit_count(d.bitwiseAND(ones))
    return total
