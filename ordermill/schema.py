"""Column names, result names and lookup values of the flat order table."""

from __future__ import annotations

from pyspark.sql import types as T

# Header names of the order table, in file order.  `promotion-ids` is
# always found by name; files may carry further columns, which are ignored.
ORDER_COLUMNS = [
    "index",
    "Order ID",
    "Date",
    "Status",
    "Fulfilment",
    "Sales Channel",
    "ship-service-level",
    "Style",
    "SKU",
    "Category",
    "Size",
    "ASIN",
    "Courier Status",
    "Qty",
    "currency",
    "Amount",
    "ship-city",
    "ship-state",
    "ship-postal-code",
    "ship-country",
    "promotion-ids",
    "B2B",
    "fulfilled-by",
]

# Fixed value: date pattern of the `Date` column and of formatted window dates.
DATE_PATTERN = "MM-dd-yy"

# Clothing sizes from smallest to largest; the rank is the position from 1.
SIZES = ["XS", "S", "M", "L", "XL", "XXL", "3XL", "4XL", "5XL", "6XL"]

# The canonical state names.
STATES = [
    "ANDAMAN & NICOBAR",
    "ANDHRA PRADESH",
    "ARUNACHAL PRADESH",
    "ASSAM",
    "BIHAR",
    "CHANDIGARH",
    "CHHATTISGARH",
    "DADRA AND NAGAR",
    "DELHI",
    "GOA",
    "GUJARAT",
    "HARYANA",
    "HIMACHAL PRADESH",
    "JAMMU & KASHMIR",
    "JHARKHAND",
    "KARNATAKA",
    "KERALA",
    "LADAKH",
    "LAKSHADWEEP",
    "MADHYA PRADESH",
    "MAHARASHTRA",
    "MANIPUR",
    "MEGHALAYA",
    "MIZORAM",
    "NAGALAND",
    "ODISHA",
    "PUDUCHERRY",
    "PUNJAB",
    "RAJASTHAN",
    "SIKKIM",
    "TAMIL NADU",
    "TELANGANA",
    "TRIPURA",
    "UTTAR PRADESH",
    "UTTARAKHAND",
    "WEST BENGAL",
]

# Spellings that stand for a canonical state.
STATE_ALIASES = {
    "NEW DELHI": "DELHI",
    "ORISSA": "ODISHA",
    "PONDICHERRY": "PUDUCHERRY",
    "PB": "PUNJAB",
    "PUNJAB/MOHALI/ZIRAKPUR": "PUNJAB",
    "RAJSTHAN": "RAJASTHAN",
    "RAJSHTHAN": "RAJASTHAN",
    "RAJSHSTHAN": "RAJASTHAN",
    "RJ": "RAJASTHAN",
}

# Fixed values: (state code, city as written, state) corrections that need the city.
CITY_FIXES = [
    ("AR", "ITANAGAR", "ARUNACHAL PRADESH"),
    ("NL", "DIMAPUR", "NAGALAND"),
]

# Cell texts that the usual data-frame readers take as missing.
MISSING_MARKERS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

ORDER_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ORDER_COLUMNS])
