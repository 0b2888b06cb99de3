"""Geohash cells against published vectors and a plain bisection."""

import random

from pyspark.sql import functions as F

from ridewright.functions import geo

DIGITS = geo.GEOHASH_DIGITS


def bisected(lat, lon, length=12):
    box = {0: [-180.0, 180.0], 1: [-90.0, 90.0]}
    bits = ""
    for n in range(5 * length):
        side, value = box[n % 2], (lon, lat)[n % 2]
        middle = (side[0] + side[1]) / 2
        bits += "1" if value >= middle else "0"
        side[0 if value >= middle else 1] = middle
    return "".join(DIGITS[int(bits[i : i + 5], 2)] for i in range(0, len(bits), 5))


def points():
    draw = random.Random(3)
    rows = [(57.64911, 10.40744), (0.0, 0.0), (-90.0, -180.0), (90.0, 180.0), (-1e-12, -1e-12), (45.0, 90.0)]
    rows += [(draw.uniform(-90, 90), draw.uniform(-180, 180)) for _ in range(500)]
    rows += [(x * 180 / 2**20, x * 360 / 2**20) for x in range(-200, 200)]
    return rows


def test_encode(spark):
    df = spark.createDataFrame(points(), "lat double, lon double")
    for row in df.select("*", geo.geohash(F.col("lat"), F.col("lon")).alias("g")).collect():
        assert row.g == bisected(row.lat, row.lon)
    assert bisected(57.64911, 10.40744).startswith("u4pruydqqvj")


def test_missing_coordinates(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (None, None), (1.0, 1.0)], "lat double, lon double")
    got = [r.g for r in df.select(geo.geohash(F.col("lat"), F.col("lon")).alias("g")).collect()]
    assert got == [None, None, None, bisected(1.0, 1.0)]


def test_decode_gives_a_point_of_the_cell(spark):
    df = spark.createDataFrame([(bisected(a, b)[:n],) for a, b in points()[:60] for n in (1, 4, 5, 12)], "g string")
    lat, lon = geo.cell_centre(F.col("g"))
    for row in df.select("g", lat.alias("lat"), lon.alias("lon")).collect():
        assert bisected(row.lat, row.lon, len(row.g)) == row.g


def test_neighbours_touch_and_wrap(spark):
    cells = ["u4pru", "ezs42", bisected(0.0, 179.99)[:5], bisected(0.0, -179.99)[:5], bisected(89.99, 0.0)[:5], "s", "z"]
    df = spark.createDataFrame([(c,) for c in cells], "cell string")
    found = {}
    for row in geo.with_neighbours(df, "cell", "n").collect():
        found.setdefault(row.cell, []).append(row.n)
    assert sorted(found["ezs42"]) == sorted(
        ["ezs42", "ezs48", "ezs49", "ezs43", "ezs41", "ezs40", "ezefp", "ezefr", "ezefx"]
    )
    for cell, around in found.items():
        assert len(set(around)) == len(around) and cell in around
    east, west = cells[2], cells[3]
    assert west in found[east] and east in found[west]
    assert len(found[cells[4]]) == 6  # nothing beyond the pole


def test_codes_of_cells_are_ranges(spark):
    rows = [(g, n) for a, b in points()[:40] for g in (bisected(a, b),) for n in (1, 2, 5, 8, 12)]
    df = spark.createDataFrame(rows, "g string, n int")
    cell = geo.code_prefix(geo.cell_code(F.col("g")), F.col("n"))
    low, high = geo.code_range(cell, F.col("n"))
    out = df.select("g", "n", geo.code_text(cell, F.col("n")).alias("text"), geo.cell_code(F.col("g")).between(low, high).alias("inside"), (high - low).alias("size"))
    for row in out.collect():
        assert row.text == row.g[: row.n] and row.inside and row.size == 32 ** (12 - row.n) - 1


def test_neighbours_against_the_grid(spark):
    """The cells around a random one are those of points one cell away."""
    draw = random.Random(9)
    wanted = {}
    for _ in range(60):
        n = draw.randint(1, 12)
        lon_bits, lat_bits = (5 * n + 1) // 2, 5 * n // 2
        x, y = draw.choice([0, 1, 2**lon_bits - 1, draw.randrange(2**lon_bits)]), draw.choice([0, 2**lat_bits - 1, draw.randrange(2**lat_bits)])
        spell = lambda i, j: bisected((j + 0.5) * 180 / 2**lat_bits - 90, (i + 0.5) * 360 / 2**lon_bits - 180, n)  # noqa: E731, B023
        wanted[spell(x, y)] = sorted(spell((x + i) % 2**lon_bits, y + j) for i in (-1, 0, 1) for j in (-1, 0, 1) if 0 <= y + j < 2**lat_bits)
    found = {}
    for row in geo.with_neighbours(spark.createDataFrame([(c,) for c in wanted], "cell string"), "cell", "n").collect():
        found.setdefault(row.cell, []).append(row.n)
    assert {c: sorted(f) for c, f in found.items()} == wanted
