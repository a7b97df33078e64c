"""Order intake and fruit list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeworks.operators import tables


def ingredients_text(chosen: list[str]) -> Column:
    """Chosen ingredients, each followed by a blank."""
    return F.lit("".join(f"{name} " for name in chosen))


def new_order(orders: DataFrame, chosen: list[str], name: str, order_uid: int) -> DataFrame:
    """Orders plus one; values travel as literals, never inside SQL text."""
    row = orders.sparkSession.range(1).select(
        F.lit(order_uid).alias("order_uid"),
        ingredients_text(chosen).alias("ingredients"),
        F.lit(name).alias("name_on_order"),
    )
    filled = tables.fill_defaults(row, order_filled=F.lit(False), order_ts=F.current_timestamp())
    return tables.append(orders, filled)


def fill_anonymous(orders: DataFrame) -> DataFrame:
    """Mark orders without a name as filled."""
    return tables.update_where(orders, F.col("name_on_order").isNull(), order_filled=F.lit(True))


def with_search_names(fruits: DataFrame, renamed: dict[str, str]) -> DataFrame:
    """Search text per fruit: its own name, unless listed in ``renamed``."""
    wide = tables.add_column(fruits, "search_on", "string")
    filled = tables.update_where(
        wide, F.col("search_on").isNull(), search_on=F.col("fruit_name")
    )
    for fruit, search in renamed.items():
        filled = tables.update_where(
            filled, F.col("fruit_name") == fruit, search_on=F.lit(search)
        )
    return filled
