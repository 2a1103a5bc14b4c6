"""Cleaning of assessor and loan fields."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def _first_number(text: Column) -> Column:
    """The first number in a text, commas between its thousands taken out; empty if there is none."""
    found = F.regexp_extract(text.cast("string"), r"-?(?:\d{1,3}(?:,\d{3})+(?!\d)|\d+)(?:\.\d+)?|-?\.\d+", 0)
    return F.regexp_replace(found, ",", "")


def clean_number(text: Column) -> Column:
    """The first number of a count field: ``"1,250 "`` gives 1250.0, ``"2 full 1 half"`` 2.0, junk NULL."""
    return _first_number(text).try_cast("double")


def clean_int(text: Column) -> Column:
    """As ``clean_number``, rounded down, exact up to 28 digits and NULL beyond a long."""
    return F.floor(_first_number(text).try_cast("decimal(38,10)")).try_cast("long")


def clean_date(text: Column) -> Column:
    return F.substring(text.cast("string"), 1, 10).try_cast("date")


def truncate_decimals(code: Column) -> Column:
    """Code fields that went through a float: ``"48201.0"`` back to ``"48201"``."""
    return F.regexp_replace(code.cast("string"), r"\.[0-9]*\z", "")


def derived_property_id(identifier: Column, zip_code: Column) -> Column:
    return F.concat(identifier, F.lit(" "), zip_code)


def tract_block_group(fips: Column, tract: Column, block_group: Column) -> Column:
    return F.concat(
        truncate_decimals(fips), truncate_decimals(tract), truncate_decimals(block_group)
    )


def dollars_from_millions(amount: Column) -> Column:
    return amount.try_cast("decimal(18,6)") * F.lit(1_000_000)
