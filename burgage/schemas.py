"""Raw and cleaned table layouts, and the constants that results depend on.

Layouts are data: the CSV loader binds columns by position, so the order below is the file order.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "money": T.DecimalType(18, 2),
}


def layout(text: str) -> T.StructType:
    """Build a StructType from `name` or `name:type` words; the default type is string."""
    fields = []
    for word in text.split():
        name, _, kind = word.partition(":")
        fields.append(T.StructField(name, _TYPES[kind or "string"], True))
    return T.StructType(fields)


def as_strings(schema: T.StructType) -> T.StructType:
    """The same columns, all strings: the form in which raw files are read."""
    return T.StructType([T.StructField(f.name, T.StringType(), True) for f in schema.fields])


# ---- fixed values: raw file layouts, in file order ----

BUILDING_PERMITS = layout("""
    permit_number permit_type:long permit_type_definition permit_creation_date block lot
    street_number street_number_suffix street_name street_suffix unit unit_suffix description
    current_status current_status_date filed_date issued_date completed_date
    first_construction_document_date structural_notification number_of_existing_stories:long
    number_of_proposed_stories:long voluntary_soft_story_retrofit fire_only_permit
    permit_expiration_date estimated_cost:money revised_cost:money existing_use
    existing_units:long proposed_use proposed_units:long plansets:long tidf_compliance
    existing_construction_type existing_construction_type_description
    proposed_construction_type proposed_construction_type_description site_permit
    supervisor_district neighborhoods_analysis_boundaries zipcode location record_id
""")

LAND_USE = layout("""
    the_geom objectid:long blklot block lot from_st to_st st_type street odd_even mapblklot
    landuse restype bldgsqft:long yrbuilt:long units:long mips_units:long pdr_units:long
    cie_units:long med_units:long ret_units:long visitor_units:long cultural_units:long
""")

HOUSE_PRICE_INDEX = layout("observation_date value:double")

CENSUS_ACS = layout("""
    name median_rent:long median_income:long pop_total:long pop_white:long
    state county tract geoid
""")

# ---- fixed values: tokens, sentinel, codes ----

NULL_TOKENS = ("", "NULL", "null", "NA")

MISSING_SENTINEL = -666666666

CENSUS_VARIABLES = {
    "NAME": "name",
    "B25064_001E": "median_rent",
    "B19013_001E": "median_income",
    "B03002_001E": "pop_total",
    "B03002_003E": "pop_white",
}

# county code, name, latitude, longitude of the centre
COUNTIES = (
    ("001", "Alameda", 37.6017, -121.7195),
    ("013", "Contra Costa", 37.9535, -122.0311),
    ("041", "Marin", 38.0834, -122.7633),
    ("055", "Napa", 38.5025, -122.2654),
    ("075", "San Francisco", 37.7749, -122.4194),
    ("081", "San Mateo", 37.4337, -122.4014),
    ("085", "Santa Clara", 37.3541, -121.9552),
    ("095", "Solano", 38.2494, -122.0400),
    ("097", "Sonoma", 38.5110, -122.9750),
)

RENT_COLOUR_BOUNDS = (1200.0, 3000.0)

# ---- fixed values: default report parameters ----

TREND_YEARS = (2000, 2024)
RANKING_YEARS = (2018, 2024)
DAYS_RANGE = (0, 1000)
TOP_PLACES = 20
TOP_FLOWS = 15
TOP_TREND_TYPES = 5
TOP_TIMING_TYPES = 6
MIN_PAIRS = 50
SAMPLE_ROWS = 10_000
MIN_RADIUS = 8.0
PEOPLE_PER_RADIUS_UNIT = 100_000
