"""Declared schemas of the records that enter and leave the system."""

from pyspark.sql import types as T

# JSON body of a measurement message; ``timestamp`` is epoch milliseconds.
MEASUREMENT_JSON = T.StructType(
    [
        T.StructField("channel_id", T.StringType()),
        T.StructField("channel_value", T.DoubleType()),
        T.StructField("hourly_frequency", T.DoubleType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

# A decoded measurement: the body, the transport time and the event time.
MEASUREMENT = T.StructType(
    [
        *MEASUREMENT_JSON.fields,
        T.StructField("ts", T.TimestampType()),
        T.StructField("event_time", T.TimestampType()),
    ]
)

# JSON body of a sensor record; ``timestamp`` is epoch milliseconds.
SENSOR_JSON = T.StructType(
    [
        T.StructField("timestamp", T.LongType()),
        T.StructField("value", T.DoubleType()),
    ]
)

# One report row per channel and window.
REPORT = T.StructType(
    [
        T.StructField("channel_id", T.StringType()),
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("hourly_frequency", T.DoubleType()),
        T.StructField("totalReadings", T.LongType()),
        T.StructField("readingsList", T.StringType()),
        T.StructField("averageReading", T.DoubleType()),
        T.StructField("maxReading", T.DoubleType()),
        T.StructField("minReading", T.DoubleType()),
        T.StructField("stdReading", T.DoubleType()),
    ]
)

# A measurement that survived the per-channel throttle.
CLEANED = T.StructType(
    [
        T.StructField("channel_id", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("channel_value", T.DoubleType()),
    ]
)

# JSON body of a transaction; the amount may arrive as text or as a number.
TRANSACTION_JSON = T.StructType(
    [
        T.StructField("transaction_id", T.StringType()),
        T.StructField("amount", T.StringType()),
    ]
)

ALERT = T.StructType([T.StructField("fraud_result", T.StringType())])

# JSON body of a contact record with a nested address.
CONTACT_JSON = T.StructType(
    [
        T.StructField("name", T.StringType()),
        T.StructField("tel", T.IntegerType()),
        T.StructField(
            "addr",
            T.StructType(
                [
                    T.StructField("country", T.StringType()),
                    T.StructField("city", T.StringType()),
                ]
            ),
        ),
    ]
)
