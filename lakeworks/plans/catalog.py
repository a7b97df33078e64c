"""Product catalogue: files joined with prices, sizes and accessories."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeworks.functions.text import join_or, product_name
from lakeworks.operators.joins import lookup_join

# Fixed value: text for products without matching accessories.
NO_ACCESSORY = "Consider: White, Black or Grey Sweat Accessories"


def product_list(files: DataFrame, products: DataFrame) -> DataFrame:
    """Products whose file exists, with the name made from the file name."""
    named = files.select(
        "relative_path", "file_url", product_name("relative_path").alias("product_name")
    )
    return lookup_join(products, named, F.col("relative_path") == F.col("file_name")).select(
        "product_name", "file_name", "color_or_style", "price", "file_url"
    )


def size_lists(listed: DataFrame, sizes: DataFrame) -> DataFrame:
    """Sizes of each product as one text, without building product x size.

    The size list is the same for all products, so it is gathered once.  A
    product listed n times would meet every size n times; the text repeats it
    as often.  Without sizes no product is offered, so there are no rows.  The
    list has one entry for each size on offer, and a cell must hold it.
    """
    counted = listed.groupBy("color_or_style", "price", "file_name").agg(F.count("*").alias("_n"))
    all_sizes = sizes.agg(F.sort_array(F.collect_list("sizes_available")).alias("s")).scalar()
    repeated = F.flatten(
        F.transform("_sizes", lambda s: F.array_repeat(s, F.col("_n").cast("int")))
    )
    with_sizes = counted.withColumn("_sizes", all_sizes).filter(F.size("_sizes") > 0)
    return with_sizes.withColumn("size_list", F.array_join(repeated, " | ")).drop("_n", "_sizes")


def catalog_for_website(
    listed: DataFrame,
    sizes: DataFrame,
    upsell: DataFrame,
    coordination: DataFrame,
    accessory_lines: DataFrame,
) -> DataFrame:
    """One row per product for display, with sizes and accessory advice."""
    base = size_lists(listed, sizes)
    mapped = lookup_join(
        base,
        upsell.withColumnRenamed("sweatsuit_color_or_style", "_style"),
        F.col("_style") == F.col("color_or_style"),
        "left",
    )
    matched = lookup_join(
        mapped,
        coordination.select(F.col("product_code").alias("_coordinated")),
        F.col("_coordinated") == F.col("upsell_product_code"),
        "left",
    )
    advised = lookup_join(
        matched, accessory_lines, F.col("product_code") == F.col("_coordinated"), "left"
    )
    advice = join_or(
        NO_ACCESSORY,
        "Consider: ",
        F.col("headband_description"),
        " & ",
        F.col("wristband_description"),
    )
    return advised.select(
        "color_or_style", "price", "file_name", "size_list", advice.alias("upsell_product_desc")
    )


def product_of_style(website: DataFrame, style: str) -> DataFrame:
    """Catalogue entry of one colour or style; the value is a parameter, never SQL text."""
    return website.filter(F.col("color_or_style") == F.lit(style)).select(
        "file_name", "price", "size_list", "upsell_product_desc"
    )
