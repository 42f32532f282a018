"""Table contracts between the stages."""

from pyspark.sql import types as T

# --- Fixed values: columns of RAW, in order -------------------------------------------------

RAW = T.StructType(
    [
        T.StructField("property_url", T.StringType()),
        T.StructField("property_code", T.StringType()),
        T.StructField("property_type", T.StringType()),
        T.StructField("price_eur", T.LongType()),
        T.StructField("cadastral_income_eur", T.LongType()),
        T.StructField("postal_code", T.StringType()),
        T.StructField("locality_name", T.StringType()),
        T.StructField("state_of_the_property", T.StringType()),
        T.StructField("currently_leased", T.StringType()),
        T.StructField("build_year", T.LongType()),
        T.StructField("bedrooms", T.LongType()),
        T.StructField("bathrooms", T.LongType()),
        T.StructField("toilets", T.LongType()),
        T.StructField("livable_surface_m2", T.LongType()),
        T.StructField("total_land_surface_m2", T.LongType()),
        T.StructField("terrace_m2", T.LongType()),
        T.StructField("garden_m2", T.LongType()),
        T.StructField("heating_type", T.StringType()),
        T.StructField("epc_kwh_m2_year", T.LongType()),
        T.StructField("swimming_pool", T.StringType()),
    ]
)

# --------------------------------------------------------------------------------------------

SILVER = T.StructType(
    [f for f in RAW if f.name != "heating_type"] + [T.StructField("province", T.StringType())]
)

NUMERIC = [f.name for f in RAW if f.dataType == T.LongType()]
FLAGS = ["currently_leased", "swimming_pool"]

PAGES = T.StructType(
    [
        T.StructField("page_id", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("html", T.StringType()),
        T.StructField("status", T.IntegerType()),
    ]
)
