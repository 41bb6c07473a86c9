"""Reference-shaped input schemas.

All source columns are text, as in the published CSV files; typed values
are derived with ``try_cast`` in the plans.
"""

from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

# --- Fixed values: column names and order of the public input files. ---
# Incident table: 28 text columns, header skipped (matched by position).
INCIDENT_COLUMNS = (
    "DR_NO", "Date Rptd", "DATE OCC", "TIME OCC", "AREA", "AREA NAME", "Rpt Dist No",
    "Part 1-2", "Crm Cd", "Crm Cd Desc", "Mocodes", "Vict Age", "Vict Sex", "Vict Descent",
    "Premis Cd", "Premis Desc", "Weapon Used Cd", "Weapon Desc", "Status", "Status Desc",
    "Crm Cd 1", "Crm Cd 2", "Crm Cd 3", "Crm Cd 4", "LOCATION", "Cross Street", "LAT", "LON",
)
INCIDENT_SCHEMA = StructType([StructField(c, StringType()) for c in INCIDENT_COLUMNS])

# Police stations: X is longitude, Y latitude.
STATION_SCHEMA = StructType([StructField(c, StringType())
                             for c in ("X", "Y", "FID", "DIVISION", "LOCATION", "PREC")])

# Median income per postal code, ';'-separated, money text like "$12,345".
INCOME_SCHEMA = StructType([StructField(c, StringType())
                            for c in ("Zip_Code", "Community", "Estimated_Median_Income")])

# Minimal census document schema: only what the analysis reads, so the JSON
# reader skips geometry and every other property.
CENSUS_PROPERTIES = StructType([
    StructField("ZCTA20", StringType()),
    StructField("POP20", LongType()),
    StructField("HOUSING20", LongType()),
])
CENSUS_DOC_SCHEMA = StructType([
    StructField("features", ArrayType(StructType([StructField("properties", CENSUS_PROPERTIES)]))),
])
