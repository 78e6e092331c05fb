"""Column names, keys and fixed schemas shared by all operators."""

from pyspark.sql import types as T

#: Unit of order for events and custom messages: one log file of a device.
SERIES_KEYS = ("device", "date", "file_name")

#: Unit of order for trips: one day folder of a device, over all its files.
DAY_KEYS = ("device", "date")

#: Columns that come from the object path, not from the message itself.
PATH_COLUMNS = ("device", "message", "date", "file_name")

# Fixed output schemas (values that must stay as they are).
EVENT_SCHEMA = T.StructType(
    [
        T.StructField("t", T.TimestampType()),
        T.StructField("EventName", T.StringType()),
        T.StructField("DeviceID", T.StringType()),
        T.StructField("EventId", T.StringType()),
        T.StructField("Message", T.StringType()),
        T.StructField("Signal", T.StringType()),
        T.StructField("EventType", T.StringType()),
        T.StructField("EventValue", T.LongType()),
        T.StructField("SignalValue", T.DoubleType()),
        T.StructField("Latitude", T.DoubleType()),
        T.StructField("Longitude", T.DoubleType()),
    ]
)

TRIP_SUMMARY_SCHEMA = T.StructType(
    [
        T.StructField("DeviceID", T.StringType()),
        T.StructField("Message", T.StringType()),
        T.StructField("Signal", T.StringType()),
        T.StructField("Aggregation", T.StringType()),
        T.StructField("SignalValue", T.DoubleType()),
        T.StructField("SignalCount", T.LongType()),
        T.StructField("Duration", T.DoubleType()),
        T.StructField("TripStart", T.TimestampType()),
        T.StructField("TripEnd", T.TimestampType()),
        T.StructField("TripID", T.StringType()),
        T.StructField("Cluster", T.StringType()),
    ]
)

# The ten aggregation names a trip summary accepts (fixed values).
AGGREGATIONS = (
    "avg",
    "median",
    "max",
    "min",
    "sum",
    "first",
    "last",
    "delta_sum",
    "delta_sum_pos",
    "delta_sum_neg",
)
