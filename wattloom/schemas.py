"""Explicit schemas. Nothing is inferred; parse fields are nullable."""

from __future__ import annotations

from pyspark.sql import types as T


STRING, INT, LONG, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def struct(fields: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields.items()])


def array_of(fields: dict[str, T.DataType]) -> T.ArrayType:
    return T.ArrayType(struct(fields))


INTENSITY = struct({"forecast": INT, "actual": INT, "index": STRING})
REGION_MIX = array_of({"fuel": STRING, "perc": DOUBLE})
GENERATION_MIX = array_of({"psr_type": STRING, "name": STRING, "value_mw": DOUBLE})
REGION = {
    "regionid": INT,
    "shortname": STRING,
    "dnoregion": STRING,
    "intensity": INTENSITY,
    "generationmix": REGION_MIX,
}
PERIOD = {"from": STRING, "to": STRING}
PLACE = {"latitude": DOUBLE, "longitude": DOUBLE, "elevation": DOUBLE}
READINGS = ["temperature_2m", "wind_speed_10m", "cloud_cover", "shortwave_radiation"]

CARBON_PAYLOAD = struct({**PERIOD, **REGION})

# cloud_cover is read as DOUBLE: the historical feed sends 59.5, which an INT field would lose.
WEATHER_PAYLOAD = struct(
    {"city": STRING, **PLACE, "time": STRING, **{name: DOUBLE for name in READINGS}}
)

GENERATION_PAYLOAD = struct(
    {
        "country_code": STRING,
        "country_name": STRING,
        "eic_code": STRING,
        "period_start": STRING,
        "period_end": STRING,
        "resolution": STRING,
        "total_generation_mw": DOUBLE,
        "generation_mix": GENERATION_MIX,
    }
)

# What the generation XML looks like after from_xml; single elements become 1-element arrays.
GENERATION_XML = struct(
    {
        "TimeSeries": array_of(
            {
                "MktPSRType": struct({"psrType": STRING}),
                "Period": array_of(
                    {
                        "timeInterval": struct({"start": STRING}),
                        "resolution": STRING,
                        "Point": array_of({"position": STRING, "quantity": STRING}),
                    }
                ),
            }
        )
    }
)

REGIONAL_RESPONSE = struct({"data": array_of({**PERIOD, "regions": array_of(REGION)})})

HOURLY_RESPONSE = struct(
    {
        **PLACE,
        "hourly_units": struct({name: STRING for name in READINGS}),
        "hourly": struct(
            {"time": T.ArrayType(STRING), **{name: T.ArrayType(DOUBLE) for name in READINGS}}
        ),
    }
)

# The message frame a topic delivers, and the bronze row derived from it.
TOPIC_FRAME = struct(
    {
        "key": T.BinaryType(),
        "value": T.BinaryType(),
        "topic": STRING,
        "partition": INT,
        "offset": LONG,
        "timestamp": T.TimestampType(),
    }
)
BRONZE = struct(
    {
        "envelope_json": STRING,
        "kafka_key": STRING,
        "topic": STRING,
        "partition": INT,
        "offset": LONG,
        "kafka_timestamp": T.TimestampType(),
        "ingested_at_ts": T.TimestampType(),
        "event_date": T.DateType(),
    }
)


def envelope(payload: T.StructType) -> T.StructType:
    """The eight envelope fields around one feed's payload."""
    return struct(
        {
            "event_id": STRING,
            "source": STRING,
            "source_version": STRING,
            "ingested_at": STRING,
            "event_time": STRING,
            "region": STRING,
            "payload": payload,
            "checksum": STRING,
        }
    )
