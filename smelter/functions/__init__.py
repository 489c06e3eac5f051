from smelter.functions.dates import date_parts, spread_date

__all__ = ["date_parts", "spread_date"]
