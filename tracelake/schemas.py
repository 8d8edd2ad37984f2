"""Explicit schemas of the logical tables and the fixed region dictionary.

Nothing in this library infers a schema: every input is text read by
position (logs, cell directory) or by header name (places).
"""

from __future__ import annotations

from pyspark.sql import types as T

LINES = T.StructType([T.StructField("value", T.StringType())])

LOGS = T.StructType([
    T.StructField("lac", T.StringType()),
    T.StructField("cell", T.StringType()),
    T.StructField("phone", T.StringType()),
    T.StructField("ts", T.StringType()),
])

CELLS = T.StructType([
    T.StructField("lac", T.StringType()),
    T.StructField("cell", T.StringType()),
    T.StructField("city", T.StringType()),
])

ITINERARIES = T.StructType([
    T.StructField("phone", T.StringType()),
    T.StructField("itinerary", T.StringType()),
])

DAILY_ITINERARIES = T.StructType([
    T.StructField("phone", T.StringType()),
    T.StructField("day", T.StringType()),
    T.StructField("itinerary", T.StringType()),
])

PLACES_TEXT = T.StructType([
    T.StructField("lng", T.StringType()),
    T.StructField("lat", T.StringType()),
    T.StructField("region", T.StringType()),
    T.StructField("country", T.StringType()),
])

REQUESTS = T.StructType([
    T.StructField("request_id", T.LongType()),
    T.StructField("phone", T.StringType()),
    T.StructField("start", T.StringType()),
    T.StructField("end", T.StringType()),
])

LABELS = T.StructType([
    T.StructField("region", T.StringType()),
    T.StructField("label", T.DoubleType()),
])

# Positions (0-based) of the fields read from a split line. Fixed values.
LOG_FIELDS = {"lac": 1, "cell": 2, "phone": 3, "ts": 4}
CELL_FIELDS = {"lac": 2, "cell": 3, "city": 12}
# A line must have more fields than the highest position the original jobs
# tested for: more than 4 for logs, more than 12 for cells. Fixed values.
LOG_MIN_FIELDS = 5
CELL_MIN_FIELDS = 13

# The region dictionary of the classifier, region name and its
# class number, in the original order (31 classes, numbered 0 to 30).
PROVINCE_LABELS = [
    ("北京市", 0.0),
    ("天津市", 1.0),
    ("上海市", 2.0),
    ("重庆市", 3.0),
    ("内蒙古自治区", 4.0),
    ("广西壮族自治区", 5.0),
    ("西藏自治区", 6.0),
    ("宁夏回族自治区", 7.0),
    ("新疆维吾尔自治区", 8.0),
    ("河北省", 9.0),
    ("山西省", 10.0),
    ("辽宁省", 11.0),
    ("吉林省", 12.0),
    ("黑龙江省", 13.0),
    ("江苏省", 14.0),
    ("安徽省", 15.0),
    ("广东省", 16.0),
    ("四川省", 17.0),
    ("甘肃省", 18.0),
    ("福建省", 19.0),
    ("浙江省", 20.0),
    ("山东省", 21.0),
    ("海南省", 22.0),
    ("湖北省", 23.0),
    ("江西省", 24.0),
    ("贵州省", 25.0),
    ("湖南省", 26.0),
    ("青海省", 27.0),
    ("陕西省", 28.0),
    ("云南省", 29.0),
    ("河南省", 30.0),
]
# Fixed value: the country kept by the classifier's filter.
DEFAULT_COUNTRY = "中国"

# Forest settings of the original classifier.
FOREST_PARAMS = {
    "numTrees": 100,
    "maxDepth": 5,
    "maxBins": 100,
    "impurity": "gini",
    "featureSubsetStrategy": "auto",
    "seed": 42,
}

# Parts that the training rows are dealt into, at least, and the rows of a part
# beyond which their number doubles; the forest depends on the number of parts.
FOREST_PARTITIONS = 16
FOREST_ROWS_PER_PARTITION = 1 << 20
