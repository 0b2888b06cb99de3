"""Geohash cells as native column expressions.

A point becomes two 30-bit cell indexes; interleaving their bits gives the 60-bit hash whose
base-32 digits are the 12-character geohash. Expressions refer to costly parts once or leave them
free of conditions, so that generated code evaluates each part once per row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published geohash alphabet, and the digits conv() writes in base 32.
GEOHASH_DIGITS = "0123456789bcdefghjkmnpqrstuvwxyz"
BASE32_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"

FULL_LENGTH = 12
AXIS_BITS = 30
EVEN_BITS = 0x5555555555555555

# Six bits moved to the even bit positions: binary digits read as base 4.
_SPREAD_SIX = [int(f"{n:b}", 4) for n in range(64)]


def _cell_index(value: Column, low: float, span: float) -> Column:
    """Index of the cell holding ``value`` among 2^30 equal cells; the upper end is in the last.

    Cell borders are exact in binary while the quotient is rounded, so a guess one cell too high
    is taken back. No conditions: nulls pass through.
    """
    cells = float(1 << AXIS_BITS)
    guess = F.floor(value * F.lit(cells) / F.lit(span)).cast("bigint") - F.lit(int(low * cells / span))
    border = guess.cast("double") * F.lit(span / cells) + F.lit(low)
    index = guess - (value < border).cast("bigint")
    return index - F.shiftright(index, AXIS_BITS)


def lon_index(lon: Column) -> Column:
    return _cell_index(lon, -180.0, 360.0)


def lat_index(lat: Column) -> Column:
    return _cell_index(lat, -90.0, 180.0)


def _spread(index: Column) -> Column:
    """The bits of ``index`` at the even bit positions."""
    table = F.array(*[F.lit(v).cast("bigint") for v in _SPREAD_SIX])
    out = None
    for low in range(0, AXIS_BITS, 6):
        six = F.get(table, F.shiftright(index, low).bitwiseAND(F.lit(63)).cast("int"))
        part = F.shiftleft(six, 2 * low)
        out = part if out is None else out.bitwiseOR(part)
    return out


def _squeeze(bits: Column) -> Column:
    """Every second bit of ``bits``, packed: base-4 digits read as binary ones."""
    digits = F.conv(bits.bitwiseAND(F.lit(EVEN_BITS).cast("bigint")).cast("string"), 10, 4)
    return F.conv(digits, 2, 10).cast("bigint")


def _hash_text(lon_idx: Column, lat_idx: Column) -> Column:
    packed = F.shiftleft(_spread(lon_idx), 1).bitwiseOR(_spread(lat_idx))
    digits = F.lpad(F.conv(packed.cast("string"), 10, 32), FULL_LENGTH, "0")
    return F.translate(digits, BASE32_DIGITS[10:], GEOHASH_DIGITS[10:])


def geohash(lat: Column, lon: Column) -> Column:
    """The 12-character geohash of a point; null when either coordinate is null."""
    return _hash_text(lon_index(lon), lat_index(lat))


def prefix(cell: Column, length: Column | int) -> Column:
    length = F.lit(length) if isinstance(length, int) else length
    return F.left(cell, length)


def prefix_columns(cell: Column, upto: int = 10) -> list[Column]:
    return [prefix(cell, k).alias(f"geo_hash_{k}") for k in range(1, upto + 1)]


def _packed(cell: Column) -> Column:
    """60-bit hash of the south-west corner of a cell."""
    full = F.rpad(cell, FULL_LENGTH, GEOHASH_DIGITS[0])
    digits = F.translate(full, GEOHASH_DIGITS[10:], BASE32_DIGITS[10:])
    return F.conv(digits, 32, 10).cast("bigint")


def _corner(packed: Column) -> tuple[Column, Column]:
    """30-bit (lon, lat) indexes of a 60-bit hash."""
    return _squeeze(F.shiftright(packed, 1)), _squeeze(packed)


def _axis_bits(cell: Column) -> tuple[Column, Column]:
    bits = F.length(cell) * 5
    return F.floor((bits + 1) / 2).cast("int"), F.floor(bits / 2).cast("int")


def _shift_left(value: Column, by: Column) -> Column:
    return F.call_function("shiftleft", value, by)


def _shift_right(value: Column, by: Column) -> Column:
    return F.call_function("shiftright", value, by)


def cell_centre(cell: Column) -> tuple[Column, Column]:
    """(lat, lon) of the middle of a cell."""
    lon_idx, lat_idx = _corner(_packed(cell))
    lon_bits, lat_bits = _axis_bits(cell)
    one = F.lit(1).cast("bigint")
    lon_half = _shift_left(one, F.lit(AXIS_BITS) - lon_bits).cast("double") / 2
    lat_half = _shift_left(one, F.lit(AXIS_BITS) - lat_bits).cast("double") / 2
    cells = float(1 << AXIS_BITS)
    lat = (lat_idx.cast("double") + lat_half) * F.lit(180.0 / cells) - F.lit(90.0)
    lon = (lon_idx.cast("double") + lon_half) * F.lit(360.0 / cells) - F.lit(180.0)
    return lat, lon


def cell_code(cell: Column) -> Column:
    """A cell as the number that its five bits a character spell; cells of one length differ in it."""
    return F.conv(F.translate(cell, GEOHASH_DIGITS[10:], BASE32_DIGITS[10:]), 32, 10).cast("bigint")


def code_prefix(packed: Column, length: Column) -> Column:
    """The code of the cell of ``length`` characters that holds a 60-bit one."""
    return _shift_right(packed, F.lit(5 * FULL_LENGTH) - length * 5)


def code_range(code: Column, length: Column) -> tuple[Column, Column]:
    """The least and greatest 60-bit code inside a cell."""
    below = F.lit(5 * FULL_LENGTH) - length * 5
    low = _shift_left(code, below)
    return low, low + _shift_left(F.lit(1).cast("bigint"), below) - 1


def code_text(code: Column, length: Column) -> Column:
    digits = F.lpad(F.conv(code.cast("string"), 10, 32), length, F.lit("0"))
    return F.translate(digits, BASE32_DIGITS[10:], GEOHASH_DIGITS[10:])


def with_neighbour_codes(df: DataFrame, cell: str, out: str) -> DataFrame:
    """One row per cell of the neighbourhood, the cell itself included, as codes of the cell's length.

    Longitude has every second bit of a code and latitude the others, so a step along one axis is an addition
    that carries through the bits of the other. Longitude wraps at the date line; cells beyond a pole do not
    exist.
    """
    long = lambda value: F.lit(value).cast("bigint")
    odd = F.length(F.col(cell)) % 2 == 1
    whole = _shift_left(long(1), F.length(F.col(cell)) * 5) - 1
    even_bits, odd_bits = whole.bitwiseAND(long(EVEN_BITS)), whole.bitwiseAND(long(EVEN_BITS << 1 & (1 << 60) - 1))
    coded = df.withColumns(
        {
            "_code": cell_code(F.col(cell)),
            # a code of an odd length ends with a bit of longitude
            "_east": F.when(odd, even_bits).otherwise(odd_bits),
            "_north": F.when(odd, odd_bits).otherwise(even_bits),
            "_step": F.when(odd, long(1)).otherwise(long(2)),
        }
    )
    code, east, north, step = (F.col(c) for c in ("_code", "_east", "_north", "_step"))
    rise = long(3) - step  # the least bit of latitude
    lon, lat = code.bitwiseAND(east), code.bitwiseAND(north)
    placed = coded.withColumns(
        {
            "_x0": (lon - step).bitwiseAND(east),
            "_x1": lon,
            "_x2": (code.bitwiseOR(north) + step).bitwiseAND(east),
            "_y0": F.when(lat != 0, (lat - rise).bitwiseAND(north)),
            "_y1": lat,
            "_y2": F.when(lat != north, (code.bitwiseOR(east) + rise).bitwiseAND(north)),
        }
    )
    around = F.array(*[F.col(f"_x{i}").bitwiseOR(F.col(f"_y{j}")) for j in range(3) for i in range(3)])
    return (
        placed.withColumn(out, F.explode(around))
        .where(F.col(out).isNotNull())
        .drop("_code", "_east", "_north", "_step", *[f"_{axis}{i}" for axis in "xy" for i in range(3)])
    )


def with_neighbours(df: DataFrame, cell: str, out: str) -> DataFrame:
    """Like :func:`with_neighbour_codes`, with the neighbours spelled as geohashes."""
    coded = with_neighbour_codes(df, cell, "_near")
    return coded.withColumn(out, code_text(F.col("_near"), F.length(F.col(cell)))).drop("_near")
