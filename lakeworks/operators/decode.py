"""Vehicle numbers: cut into codes and decoded through five lookups."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeworks.functions.text import cut
from lakeworks.operators.joins import lookup_join
from lakeworks.operators.tables import update_from

# 1-based position and length of each code in a vehicle number.
CODE_POSITIONS = {
    "wmi": (1, 3),
    "vds": (4, 5),
    "model_year_code": (10, 1),
    "plant_code": (11, 1),
}

# Columns of a decoded vehicle, in order.
DECODED = (
    "manuf_name", "vehicle_type", "make_name", "plant_name", "model_year", "model_name",
    "desc1", "desc2", "desc3", "desc4", "desc5", "engine", "drive_type", "transmission", "mpg",
)

#: Columns an enriched stock row receives; the model name stays as it was.
ENRICHED = tuple(c for c in DECODED if c != "model_name")


@dataclass(frozen=True)
class Lookups:
    """The five decode tables."""

    manufacturers: DataFrame  # wmi, manuf_id, manuf_name, country, vehicle_type
    makes: DataFrame  # manuf_id, make_name, make_id
    plants: DataFrame  # make_id, plant_code, plant_name
    years: DataFrame  # model_year_code, model_year_name
    models: DataFrame  # make_id, vds, model_name, desc1..desc5, engine, ...


def code_columns(vin: Column | str) -> list[Column]:
    """The codes of a vehicle number as named columns."""
    return [cut(vin, start, length).alias(name) for name, (start, length) in CODE_POSITIONS.items()]


def parse_codes(df: DataFrame, vin: str = "vin") -> DataFrame:
    return df.select("*", *code_columns(vin))


def decode(df: DataFrame, lookups: Lookups, vin: str = "vin") -> DataFrame:
    """Decoded columns for every vehicle number of ``df``, one plan for any number of rows.

    Numbers with an unknown code drop out; a code listed twice gives two rows.
    """
    coded = parse_codes(df.select(F.col(vin).alias("vin")))
    joined = lookup_join(
        coded, lookups.manufacturers.select("wmi", "manuf_id", "manuf_name", "vehicle_type"), "wmi"
    )
    joined = lookup_join(joined, lookups.makes.select("manuf_id", "make_name", "make_id"), "manuf_id")
    joined = lookup_join(
        joined,
        lookups.plants.select("make_id", "plant_code", "plant_name"),
        ["plant_code", "make_id"],
    )
    joined = lookup_join(
        joined,
        lookups.years.select("model_year_code", F.col("model_year_name").alias("model_year")),
        "model_year_code",
    )
    models = lookups.models.select("make_id", "vds", *DECODED[DECODED.index("model_name"):])
    return lookup_join(joined, models, ["vds", "make_id"]).select("vin", *DECODED)


def register_decode(spark: SparkSession, lookups: Lookups, name: str = "parse_and_enhance_vin") -> None:
    """``SELECT * FROM name('...')`` for SQL text in this session, also lateral over a table."""
    for field in fields(lookups):
        getattr(lookups, field.name).createOrReplaceTempView(f"{name}_{field.name}")
    codes = ", ".join(
        f"substr({name}.this_vin, {start}, {length}) AS {column}"
        for column, (start, length) in CODE_POSITIONS.items()
    )
    chosen = ", ".join("model_year_name" if c == "model_year" else c for c in DECODED)
    # the codes come first, so that a lateral call over a table stays a chain of hash joins
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(this_vin STRING) "
        f"RETURNS TABLE (vin STRING, {', '.join(f'{c} STRING' for c in DECODED)}) "
        f"RETURN SELECT vin, {chosen} FROM (SELECT {name}.this_vin AS vin, {codes}) "
        f"JOIN {name}_manufacturers USING (wmi) JOIN {name}_makes USING (manuf_id) "
        f"JOIN {name}_plants USING (make_id, plant_code) JOIN {name}_years USING (model_year_code) "
        f"JOIN {name}_models USING (make_id, vds)"
    )


def decode_one(df: DataFrame, lookups: Lookups, vin: str) -> DataFrame:
    """Stock columns and decoded columns of one vehicle number."""
    wanted = df.filter(F.col("vin") == F.lit(vin))
    found = decode(wanted.select("vin").distinct(), lookups)
    return wanted.select("vin", "exterior", "interior").join(found, "vin")


def enrich(stock: DataFrame, lookups: Lookups) -> DataFrame:
    """Fill the decoded columns for every vehicle number with an undecoded row.

    One set-based update in place of a row-by-row loop.  Numbers without an
    undecoded row and numbers with an unknown code keep their values.
    """
    missing = stock.filter(F.col("manuf_name").isNull()).select("vin").distinct()
    source = decode(missing, lookups).select("vin", *ENRICHED)
    return update_from(stock, source, ["vin"], list(ENRICHED))
