"""Readers for delimited, fixed-width and marker-laden text, and text sinks."""

from .files import read_csv, read_csv_cast, write_json, write_lines
from .records import (
    read_areas,
    read_calendar,
    read_county_rates,
    read_daily_weather,
    read_measurements,
    read_products,
    read_sales,
    read_series,
    read_state_rates,
    read_stations,
    read_stores,
    read_zip_codes,
)
from .text import Field, Slice, parse_delimited, parse_fixed_width

__all__ = [
    "Field",
    "Slice",
    "parse_delimited",
    "parse_fixed_width",
    "read_areas",
    "read_calendar",
    "read_county_rates",
    "read_csv",
    "read_csv_cast",
    "read_daily_weather",
    "read_measurements",
    "read_products",
    "read_sales",
    "read_series",
    "read_state_rates",
    "read_stations",
    "read_stores",
    "read_zip_codes",
    "write_json",
    "write_lines",
]
