"""Record shapes shared by the batch and streaming jobs."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names and types of the records the jobs exchange.

FLIGHTS = T.StructType([
    T.StructField("FlightDate", T.StringType()),
    T.StructField("Year", T.IntegerType()),
    T.StructField("Month", T.IntegerType()),
    T.StructField("DayofMonth", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("Carrier", T.StringType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("TailNum", T.StringType()),
    T.StructField("Origin", T.StringType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("ArrDelay", T.DoubleType()),
    T.StructField("CRSDepTime", T.StringType()),
    T.StructField("CRSArrTime", T.StringType()),
    T.StructField("DepTime", T.StringType()),
    T.StructField("ArrTime", T.StringType()),
    T.StructField("AirTime", T.DoubleType()),
])

FEATURES = T.StructType([
    T.StructField("ArrDelay", T.DoubleType()),
    T.StructField("CRSArrTime", T.TimestampNTZType()),
    T.StructField("CRSDepTime", T.TimestampNTZType()),
    T.StructField("Carrier", T.StringType()),
    T.StructField("DayOfMonth", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayOfYear", T.IntegerType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("FlightDate", T.DateType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("Origin", T.StringType()),
])

REQUEST = T.StructType([
    T.StructField("Carrier", T.StringType()),
    T.StructField("DayOfMonth", T.IntegerType()),
    T.StructField("DayOfWeek", T.IntegerType()),
    T.StructField("DayOfYear", T.IntegerType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("FlightDate", T.DateType()),
    T.StructField("FlightNum", T.StringType()),
    T.StructField("Origin", T.StringType()),
    T.StructField("Timestamp", T.TimestampNTZType()),
    T.StructField("UUID", T.StringType()),
])

RESULT = T.StructType([
    *REQUEST.fields,
    T.StructField("Route", T.StringType()),
    T.StructField("Prediction", T.DoubleType()),
])

RESPONSE = T.StructType([
    T.StructField("uuid", T.StringType()),
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("carrier", T.StringType()),
    T.StructField("flight_date", T.StringType()),
    T.StructField("dep_delay", T.DoubleType()),
    T.StructField("distance", T.DoubleType()),
    T.StructField("prediction", T.IntegerType()),
    T.StructField("timestamp", T.TimestampNTZType()),
])

#: Value of a response message; field names are those of the request it answers.
RESPONSE_MESSAGE = T.StructType([
    T.StructField("UUID", T.StringType()),
    T.StructField("Origin", T.StringType()),
    T.StructField("Dest", T.StringType()),
    T.StructField("Carrier", T.StringType()),
    T.StructField("FlightDate", T.DateType()),
    T.StructField("DepDelay", T.DoubleType()),
    T.StructField("Distance", T.DoubleType()),
    T.StructField("prediction", T.DoubleType()),
    T.StructField("Timestamp", T.TimestampNTZType()),
])

DISTANCES = T.StructType([
    T.StructField("origin", T.StringType()),
    T.StructField("dest", T.StringType()),
    T.StructField("distance", T.DoubleType()),
])

AIRPLANES = T.StructType([
    T.StructField(name, T.StringType())
    for name in (
        "TailNum", "Owner", "OwnerState", "Manufacturer", "Model", "ManufacturerYear",
        "SerialNumber", "EngineManufacturer", "EngineModel",
    )
])

AIRLINES = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("CarrierCode", "Name", "url", "domain", "logo_url", "summary")
])

#: A message log: the columns the Kafka source provides.
TOPIC = T.StructType([
    T.StructField("key", T.BinaryType()),
    T.StructField("value", T.BinaryType()),
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])

REQUEST_TOPIC = "flight-delay-ml-request"
RESPONSE_TOPIC = "flight-delay-ml-response"
