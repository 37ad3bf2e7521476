"""Fixed station registry and the station file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerolith import schemas

# station_id, province, region, latitude, longitude. The city id of a station is
# 101 plus its position in this list.
_STATIONS = """
HN01,Ha Noi,North,21.03,105.85
HUE01,Hue,Central,16.46,107.59
LC01,Lai Chau,North,22.40,103.46
DB01,Dien Bien,North,21.39,103.02
SL01,Son La,North,21.33,103.91
LS01,Lang Son,North,21.85,106.76
QN01,Quang Ninh,North,20.95,107.08
TH01,Thanh Hoa,Central,19.81,105.78
NA01,Nghe An,Central,18.68,105.68
HT01,Ha Tinh,Central,18.34,105.91
CB01,Cao Bang,North,22.67,106.26
TQ01,Tuyen Quang,North,21.82,105.21
LC02,Lao Cai,North,22.49,103.97
TN01,Thai Nguyen,North,21.59,105.85
PT01,Phu Tho,North,21.32,105.40
BN01,Bac Ninh,North,21.18,106.08
HY01,Hung Yen,North,20.85,106.05
HP01,Hai Phong,North,20.86,106.68
NB01,Ninh Binh,North,20.25,105.97
QT01,Quang Tri,Central,16.81,107.10
DN01,Da Nang,Central,16.05,108.21
QNG01,Quang Ngai,Central,15.12,108.80
GL01,Gia Lai,Central,13.98,108.00
KH01,Khanh Hoa,Central,12.24,109.19
LD01,Lam Dong,Central,11.94,108.44
DL01,Dak Lak,Central,12.69,108.05
HCM01,Ho Chi Minh City,South,10.82,106.63
DN02,Dong Nai,South,10.95,106.82
TN02,Tay Ninh,South,11.31,106.10
CT01,Can Tho,South,10.04,105.78
VL01,Vinh Long,South,10.25,105.97
DT01,Dong Thap,South,10.46,105.63
CM01,Ca Mau,South,9.18,105.15
AG01,An Giang,South,10.39,105.44
"""
_FIRST_CITY_ID = 101


def station_registry(spark: SparkSession) -> DataFrame:
    """station_id, city_id, province, region, latitude, longitude of the fixed stations."""
    rows = []
    for city_id, line in enumerate(_STATIONS.split("\n")[1:-1], _FIRST_CITY_ID):
        station, province, region, latitude, longitude = line.split(",")
        rows.append((station, city_id, province, region, float(latitude), float(longitude)))
    schema = f"{schemas.REGISTRY.simpleString()[7:-1]},latitude:double,longitude:double"
    return spark.createDataFrame(rows, schema)


def scan_stations(spark: SparkSession, path: str) -> DataFrame:
    """Station dimension from CSV files with a header; fields are matched by name and trimmed.

    ``station_id``, ``province`` and ``region`` are required; station name and coordinates are
    taken along when the file has them. ``station_id`` must be unique.
    """
    raw = spark.read.csv(
        path, header=True, enforceSchema=False, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True
    )
    missing = [f.name for f in schemas.STATION if f.name not in raw.columns]
    if missing:
        raise ValueError(f"station file lacks {missing}")
    extras = [f for f in schemas.STATION_EXTRAS if f.name in raw.columns]
    return raw.select(
        *[F.col(f.name) for f in schemas.STATION],
        *[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in extras],
    )
