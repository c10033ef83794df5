"""Small hand-made documents and rows."""

import json

from pyspark.sql import functions as F

from aqlake.feeds import POLLUTANTS
from aqlake.sources.documents import stage_documents
from aqlake.sources.schemas import REGISTER, STAGING

HOUR = 1_704_067_200  # 2024-01-01 00:00:00 UTC
WARSAW = (52.22977, 21.01178)
CENTRE = (52.22904, 21.01644)


def pollution_element(lat, lon, dt=HOUR, aqi=2, **components):
    values = {name: 1.0 for name in POLLUTANTS} | components
    return {
        "coord": {"lat": lat, "lon": lon},
        "list": [{"dt": dt, "main": {"aqi": aqi}, "components": values}],
    }


def weather_element(lat, lon, dt=HOUR, id=7, name="x", temp=3.5, deg=2.7):
    return {
        "id": id, "name": name, "dt": dt, "visibility": 10000,
        "coord": {"lat": lat, "lon": lon},
        "weather": [{"description": "mist"}],
        "main": {"temp": temp, "feels_like": 1.0, "temp_min": 0.0, "temp_max": 5.0, "pressure": 1000, "humidity": 80},
        "wind": {"speed": 2.5, "deg": deg},
        "clouds": {"all": 90},
    }


def document(*elements):
    return json.dumps({"results": list(elements)}, ensure_ascii=False, indent=4)


def files(spark, *bodies):
    rows = [(f"f{i}", body) for i, body in enumerate(bodies)]
    return spark.createDataFrame(rows, "path string, content string")


def staging(spark, feed, *delivered):
    """Staging rows of ``(ingestion_ts, body)`` pairs."""
    rows = [(f"f{i}", ts, body) for i, (ts, body) in enumerate(delivered)]
    landed = spark.createDataFrame(rows, "path string, at string, content string")
    when = landed.select(F.col("path").alias("source_filename"), F.col("at").cast("timestamp").alias("ingestion_ts"))
    staged = stage_documents(landed.select("path", "content"), feed).drop("ingestion_ts")
    return staged.join(when, "source_filename").select(*STAGING.names)


def register(spark, *rows):
    return spark.createDataFrame(
        [(city, city, lat, lon, "PL", population, "Europe/Warsaw", "Poland") for city, lat, lon, population in rows],
        REGISTER,
    )


def write_file(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode() if isinstance(text, str) else text)
