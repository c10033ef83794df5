"""What a feed's documents look like."""

from __future__ import annotations

from typing import NamedTuple


class Feed(NamedTuple):
    """A kind of document: ``{"results": [element, ...]}``, one file per run.

    ``dt_path`` leads to the measuring time (epoch seconds) of the first
    element, which stands for the whole document. ``fields`` lists
    ``(column, path within an element, type)``.
    """

    name: str
    file_name: str
    dt_path: str
    fields: tuple[tuple[str, str, str], ...]


# Document layout of the public weather service's two replies,
# and the column names and types its fields are stored under.
POLLUTION = Feed(
    name="pollution",
    file_name="aq_data.json",
    dt_path="$.results[0].list[0].dt",
    fields=(
        ("lat", "$.coord.lat", "double"),
        ("lon", "$.coord.lon", "double"),
        ("aqi", "$.list[0].main.aqi", "int"),
        ("co", "$.list[0].components.co", "double"),
        ("no", "$.list[0].components.no", "double"),
        ("no2", "$.list[0].components.no2", "double"),
        ("o3", "$.list[0].components.o3", "double"),
        ("so2", "$.list[0].components.so2", "double"),
        ("pm2_5", "$.list[0].components.pm2_5", "double"),
        ("pm10", "$.list[0].components.pm10", "double"),
        ("nh3", "$.list[0].components.nh3", "double"),
    ),
)
WEATHER = Feed(
    name="weather",
    file_name="weather_data.json",
    dt_path="$.results[0].dt",
    fields=(
        ("location_id", "$.id", "int"),
        ("city", "$.name", "string"),
        ("lat", "$.coord.lat", "double"),
        ("lon", "$.coord.lon", "double"),
        ("weather_con", "$.weather[0].description", "string"),
        ("temp", "$.main.temp", "double"),
        ("feels_like", "$.main.feels_like", "double"),
        ("min_temp", "$.main.temp_min", "double"),
        ("max_temp", "$.main.temp_max", "double"),
        ("pressure", "$.main.pressure", "double"),
        ("humidity", "$.main.humidity", "double"),
        ("visibility", "$.visibility", "int"),
        ("wind_speed", "$.wind.speed", "double"),
        ("wind_deg", "$.wind.deg", "int"),
        ("clouds", "$.clouds.all", "int"),
    ),
)

# Pollutants in storage order, and the label of each that competes
# for "prominent". CO is left out: its usual level is about ten times the others'.
POLLUTANTS = ("co", "no", "no2", "o3", "so2", "pm2_5", "pm10", "nh3")
LABELLED_POLLUTANTS = {
    "no": "NO",
    "no2": "NO2",
    "o3": "O3",
    "so2": "SO2",
    "pm2_5": "PM2_5",
    "pm10": "PM10",
    "nh3": "NH3",
}

# Weather measures in storage order, and the measures the hourly
# averages are kept for.
WEATHER_MEASURES = (
    "temp", "feels_like", "min_temp", "max_temp", "pressure",
    "humidity", "visibility", "wind_speed", "wind_deg", "clouds",
)
AVERAGED_MEASURES = (*POLLUTANTS, "aqi", "temp", "wind_speed")
