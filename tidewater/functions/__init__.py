"""Column functions: names, text, numbers, dates, rules and nested data."""

from tidewater.functions import dates, names, nested, numbers, rules, text

__all__ = ["dates", "names", "nested", "numbers", "rules", "text"]
