"""Normal forms of raw tag values, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that stand for an unknown tag value, compared trimmed and in lower case.
UNKNOWN = ("", "?", "unknown", "unset", "none", "null", "nan")
# A number within a text, with a decimal point or comma.
NUMBER = r"([-+]?(?:\d+(?:[.,]\d*)?|[.,]\d+))"
# Inclines that give only a direction.
UPWARDS = ("up", "uphill")
DOWNWARDS = ("down", "downhill")
# Metres in a foot, and feet in an inch.
FOOT_M = 0.3048

#: Java and Python trim this white space.
_BLANK = " \t\n\x0b\x0c\r"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normalize_categorical(c: Column | str) -> Column:
    """Trimmed, in lower case."""
    return F.lower(F.btrim(col(c), F.lit(_BLANK)))


def is_unknown(c: Column | str) -> Column:
    """Null, or one of UNKNOWN."""
    return col(c).isNull() | normalize_categorical(col(c).cast("string")).isin(*UNKNOWN)


def normalize_sequence(c: Column | str) -> Column:
    """The known items of an array of strings, in normal form; a null array is empty."""
    items = F.transform(F.coalesce(col(c), F.array().cast("array<string>")), normalize_categorical)
    return F.filter(items, lambda x: ~is_unknown(x))


def parse_number(c: Column | str) -> Column:
    """The first number in a text as a double; null where there is none or the value is unknown."""
    text = F.regexp_replace(F.regexp_extract(col(c).cast("string"), NUMBER, 1), ",", ".")
    value = text.try_cast("double")
    return F.when(~is_unknown(c) & (F.abs(value) < float("inf")), value)


# A width in feet and perhaps inches, whole; and texts anywhere in a width that give its unit, in metres, first match first.
FEET = r"^(\d+(?:\.\d+)?)\s*'\s*(?:(\d+(?:\.\d+)?)\s*(?:\"|in)?)?$"
INCH_M = 0.0254
UNITS = (("ft", FOOT_M), ("feet", FOOT_M), ("cm", 0.01), ("mm", 0.001))


def _width_one(text: Column) -> Column:
    t = normalize_categorical(text)
    feet, inches = F.regexp_extract(t, FEET, 1), F.regexp_extract(t, FEET, 2)
    n = parse_number(t)
    value = F.when(feet != "", parse_number(feet) * FOOT_M + F.coalesce(parse_number(inches), F.lit(0.0)) * INCH_M)
    for unit, metres in UNITS:
        value = value.when(t.contains(unit), n * metres)
    return value.otherwise(n)


def parse_width_m(c: Column | str) -> Column:
    """A width in metres: the least of the parts between semicolons; feet and inches, cm and mm are converted."""
    whole = col(c).cast("string")
    parts = F.transform(F.split(whole, ";"), _width_one)
    return F.when(whole.contains(";"), F.array_min(F.filter(parts, lambda x: x.isNotNull()))).otherwise(_width_one(whole))


def parse_incline(c: Column | str) -> Column:
    """struct(percent, kind): kind is numeric, qualitative, missing or invalid; degrees become percent."""
    t = normalize_categorical(col(c).cast("string"))
    n = parse_number(t)
    percent = F.when(t.isin(*UPWARDS, *DOWNWARDS) | is_unknown(c), None).when(t.contains("°") | t.contains("deg"), F.tan(F.radians(n)) * 100).otherwise(n)
    kind = F.when(is_unknown(c), "missing").when(t.isin(*UPWARDS, *DOWNWARDS), "qualitative").when(percent.isNull(), "invalid").otherwise("numeric")
    return F.struct(percent.cast("double").alias("percent"), kind.alias("kind"))


def fill_unknown(df, columns=None, mark: str = "?"):
    """Nulls of string columns become the mark."""
    return df.na.fill(mark, subset=columns or [f.name for f in df.schema.fields if f.dataType.simpleString() == "string"])


def replace_values(c: Column | str, values: dict[str, str]) -> Column:
    """Listed values are replaced, others stay."""
    if not values:
        return col(c)
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col(c)], col(c))


def last_update(day: Column | str, month: Column | str, year: Column | str) -> Column:
    """d-m-yyyy without padding."""
    return F.concat_ws("-", col(day).cast("string"), col(month).cast("string"), col(year).cast("string"))


# The revision date that stands for an unknown one.
DEFAULT_DATE = (2004, 8, 9)


def rev_date(year: Column | str, month: Column | str, day: Column | str) -> Column:
    """The revision's date, or the default one."""
    text = F.format_string("%04d-%02d-%02d", col(year).cast("int"), col(month).cast("int"), col(day).cast("int"))
    return F.coalesce(text.try_cast("date"), F.lit("%04d-%02d-%02d" % DEFAULT_DATE).cast("date"))


def age_years(year: Column | str, month: Column | str, day: Column | str, as_of: str) -> Column:
    """Whole days since the revision over 365.25; -1 where the date is invalid."""
    text = F.format_string("%04d-%02d-%02d", col(year).cast("int"), col(month).cast("int"), col(day).cast("int"))
    return F.coalesce(F.datediff(F.lit(as_of).cast("date"), text.try_cast("date")) / F.lit(365.25), F.lit(-1.0))


def parse_timestamp(c: Column | str, tz: str = "UTC") -> Column:
    """ISO texts (without a zone: UTC), else dd/MM/yyyy HH:mm:ss in the given zone, as a UTC timestamp; null otherwise."""
    t = F.btrim(col(c))
    iso = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(t))
    local = F.to_utc_timestamp(F.try_to_timestamp(F.when(t.rlike(r"^\d{2}/\d{2}/\d{4} "), t), F.lit("dd/MM/yyyy HH:mm:ss")), tz)
    return F.coalesce(iso, local)


def isoformat_utc(c: Column | str) -> Column:
    return F.date_format(col(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def feature_url(element: Column | str, id_: Column | str) -> Column:
    """Link to a mapped feature."""
    return F.concat(F.lit("https://www.openstreetmap.org/"), col(element), F.lit("/"), col(id_).cast("string"))


def history_url(element: Column | str, id_: Column | str) -> Column:
    """Link to a feature's versions."""
    return F.concat(feature_url(element, id_), F.lit("/history"))


# The element a geometry type is mapped as.
GEOMETRY_ELEMENT = {"Point": "node", "LineString": "way", "Polygon": "way", "MultiPolygon": "relation", "MultiLineString": "way"}


def geometry_to_element(c: Column | str) -> Column:
    return F.create_map(*[F.lit(x) for kv in GEOMETRY_ELEMENT.items() for x in kv])[col(c)]


def invert_element(c: Column | str) -> Column:
    """node and way swapped."""
    return F.when(col(c) == "node", "way").when(col(c) == "way", "node").otherwise(col(c))


def edge_kind(layer: Column | str, highway: Column | str, footway_class: Column | None = None) -> Column:
    """crossing, sidewalk, stairs or footway."""
    stairs = (col(highway) == "steps") if footway_class is None else (col(highway) == "steps") | (footway_class == "stairways")
    return F.when(col(layer) == "crossings", "crossing").when(col(layer) == "sidewalks", "sidewalk").when(F.coalesce(stairs, F.lit(False)), "stairs").otherwise("footway")


def bins_label(lo: float, hi: float | None) -> str:
    """The label of a bin: lo-<hi, or lo+ for the last."""
    return f"{lo:g}+" if hi is None else f"{lo:g}–<{hi:g}"


def percent_text(part: Column, total: Column) -> Column:
    """A share in percent with two places."""
    return F.concat(F.bround(100 * part / F.nullif(total, F.lit(0)), 2).cast("string"), F.lit("%"))


def travel_time_min(km: Column | str, speed_kmh: float) -> Column:
    """Whole minutes, one at least."""
    return F.greatest(F.lit(1), F.floor(col(km) / speed_kmh * 60 + 0.5)).cast("int")


def fingerprint(*parts: Column) -> Column:
    """A SHA-256 over parts, nulls told apart from empty texts."""
    return F.sha2(F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("+"), p.cast("string")), F.lit("-")) for p in parts]), 256)


def split_type_id(c: Column | str) -> Column:
    """struct(element, id) of a type_id key."""
    parts = F.split(col(c), "_")
    return F.struct(F.get(parts, F.lit(0)).alias("element"), F.get(parts, F.lit(1)).try_cast("long").alias("id"))


def edit_url(element: Column | str, id_: Column | str, zoom: int, lat: Column, lon: Column) -> Column:
    """Link to a feature in the editor, at a place of the map."""
    return F.concat(F.lit("https://www.openstreetmap.org/edit?"), col(element), F.lit("="), col(id_).cast("string"), F.lit(f"#map={zoom}/"), lat.cast("string"), F.lit("/"), lon.cast("string"))


def survey_year(c: Column | str) -> Column:
    """The last part of a d-m-yyyy date."""
    return F.element_at(F.split(col(c), "-"), -1).try_cast("int")


def status_name(c: Column | str, names: dict) -> Column:
    """A status code's name, or the code itself."""
    return replace_values(col(c).cast("string"), {str(k): v for k, v in names.items()})


def humanize(c: Column | str) -> Column:
    """snake_case as a title."""
    return F.initcap(F.regexp_replace(col(c), "_", " "))
