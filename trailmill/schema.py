"""Click schema and the fixed code tables of the shop data."""

from __future__ import annotations

from pyspark.sql import types as T

SESSION = "session_id"
ORDER = "click_order"
ITEM = "item_id"

# Raw semicolon CSV, in file order.
RAW_CLICKS = T.StructType(
    [
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("day", T.IntegerType()),
        T.StructField(ORDER, T.IntegerType()),
        T.StructField("country", T.IntegerType()),
        T.StructField(SESSION, T.LongType()),
        T.StructField("category", T.IntegerType()),
        T.StructField(ITEM, T.StringType()),
        T.StructField("colour", T.IntegerType()),
        T.StructField("location", T.IntegerType()),
        T.StructField("photo_type", T.IntegerType()),
        T.StructField("price", T.IntegerType()),
        T.StructField("price_2", T.IntegerType()),
        T.StructField("page", T.IntegerType()),
    ]
)

# Country codes of each region.
POLAND = [29]
OTHER_EU = [2, 3, 8, 9, 10, 11, 14, 15, 16, 17, 18, 21, 22, 23, 24, 25, 27, 30, 34, 35, 36, 37, 41]
EUROPE_NON_EU = [7, 19, 28, 31, 32, 33, 38, 39]
OUTSIDE_EUROPE = [1, 4, 5, 6, 20, 26, 40, 42]

# Region labels, in the order of their integer codes 0 to 4.
REGIONS = ["Poland", "Other_EU", "Europe_non_EU", "Outside_Europe", "Unidentified_or_Domain"]

# Names of the codes in the data.
CATEGORY_NAMES = {1: "trousers", 2: "skirts", 3: "blouses", 4: "sale"}
COLOUR_NAMES = {
    1: "beige", 2: "black", 3: "blue", 4: "brown", 5: "burgundy", 6: "gray", 7: "green",
    8: "navy blue", 9: "many colors", 10: "olive", 11: "pink", 12: "red", 13: "violet", 14: "white",
}
COUNTRY_NAMES = {
    1: "Australia", 2: "Austria", 3: "Belgium", 4: "British Virgin Islands", 5: "Cayman Islands",
    6: "Christmas Island", 7: "Croatia", 8: "Cyprus", 9: "Czech Republic", 10: "Denmark",
    11: "Estonia", 12: "unidentified", 13: "Faroe Islands", 14: "Finland", 15: "France",
    16: "Germany", 17: "Greece", 18: "Hungary", 19: "Iceland", 20: "India", 21: "Ireland",
    22: "Italy", 23: "Latvia", 24: "Lithuania", 25: "Luxembourg", 26: "Mexico", 27: "Netherlands",
    28: "Norway", 29: "Poland", 30: "Portugal", 31: "Romania", 32: "Russia", 33: "San Marino",
    34: "Slovakia", 35: "Slovenia", 36: "Spain", 37: "Sweden", 38: "Switzerland", 39: "Ukraine",
    40: "United Arab Emirates", 41: "United Kingdom", 42: "USA", 43: "biz (.biz)",
    44: "com (.com)", 45: "int (.int)", 46: "net (.net)", 47: "org (.org)",
}
