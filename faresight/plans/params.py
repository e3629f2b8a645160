"""Parameters of the registered queries on the driver's test tables.

The test tables span 1995-2001 instead of 2019-2024, so the reference's
dates and thresholds are mapped onto comparable values here.  Every query
still runs over whole tables; these only choose which day, month or zone a
question is about.
"""

GROWTH_YEARS = (1996, 1997)            # stands for (2019, 2020)
TOP_ZONES_DAY = "1996-06-17"           # one busy pickup day
TOP_ZONES_MIN_TOTAL = 100_000          # HAVING bound
TOP_ZONES_K = 3
TIP_PICKUP_ZONE = "NATION_3"           # "East Harlem North"
VENDOR_RANGE = ("1998-03-01", "1998-03-15")
NEW_DAY = "2031-01-01"                 # a day that no trip has
EVENT_DAY = "2024-01-15"
P90_YEAR, P90_MONTH, P90_RANK = 1996, 11, 2
PAGE_ROWS, EMPTY_PAGE = 100, 7         # records of a landed page, and the page that is empty
INCREMENTAL_INITIAL = "2024-01-01"     # first-run cursor floor
LOAD_RESOURCES = ("click", "purchase")  # kinds of rides loaded as resources of their own
ARRIVALS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")  # when landed files are picked up
INCREMENTAL_SPLIT = "2024-01-15"       # source extent at the first run
SMALL_BATCH_EVERY = 500                # one order key in so many is new, and one is there already
KEPT_BEFORE = 1998                     # fares before this year are counted in a kept table
MERGE_TARGET_BEFORE = "1998-01-01"     # target holds files before this month
REVISED_RATECODE = "3"                 # rides of the new batch that come again with another fare
MERGE_SOURCE_FROM = "1997-07-01"       # new batch overlaps the target by 6 months
SESSION_GAP = "5 minutes"
SESSION_GAP_LONG = "6 hours"
ROW_ID_COLUMNS_ON_PREMISE = ("vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid",
                             "dolocationid", "fare_amount", "trip_distance")
ROW_ID_COLUMNS_CLOUD = ("vendorid", "pickup_datetime", "dropoff_datetime", "pulocationid", "dolocationid")
PRODUCT_KEYS = ("brand", "price")
ROWS_YEAR = 1997                       # "rows for all files of 2020"
ROWS_MONTH = (1998, 3)                 # "rows for the March 2021 file"

INGEST_MONTHS = ((1997, 5), (1997, 6), (1997, 7))
AS_OF, DAYS_BACK = "2024-01-20", 7
TOP_TIPS = 10
LATE_BEFORE = "2024-01-15 00:00:00"

# Slices of drop-off time in which the streaming query receives its rides.
STREAM_SLICES = 3
