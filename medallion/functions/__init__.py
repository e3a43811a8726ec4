"""Column-level helpers: brackets, ages, JSON paths, null-safe comparisons, exact-name references."""

from medallion.functions.columns import (
    age_years,
    bracket,
    col_exact,
    distinct_from,
    json_path,
    quote_ident,
    seniority_years,
    struct_order_key,
)

__all__ = ["age_years", "bracket", "col_exact", "distinct_from", "json_path", "quote_ident",
           "seniority_years", "struct_order_key"]
