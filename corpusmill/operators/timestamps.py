"""Normalising mixed timestamp notations (problem 6).

One regular expression holds every notation as an alternative with named groups. ``regexp_replace`` runs it once per
value and rewrites the value to its components parted by ``|``; everything after that is integer arithmetic on those
components: calendar checks, day numbers, offsets. Nothing depends on the session time zone and no Python runs.

Defined results
---------------
* null and blank values, and values that already are an existing ``yyyy-MM-dd`` date: ``status`` is ``blank`` or ``date``
* date only -> ``yyyy-MM-dd``; date and time -> ``yyyy-MM-ddTHH:mm:ssZ`` with fractions cut off
* anything that names no existing date, or an impossible time of day or offset -> ``invalid``
* a local time that occurs twice means the first one; a skipped one is read with the offset in force before the change
* rows whose source is unknown, or whose source has no zone or no order: UTC and day before month
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.functions.columns import staged
from corpusmill.functions.text import blank, folded_lower

# Month names and their abbreviations in Portuguese, English, Spanish, French and Italian.
MONTHS = [
    "jan janeiro january enero ene janvier janv gennaio gen",
    "fev fevereiro feb february febrero fevrier fevr febbraio",
    "mar marco march marzo mars",
    "abr abril apr april avr avril aprile",
    "mai maio may mayo maggio mag",
    "jun junho june junio juin giugno giu",
    "jul julho july julio juillet juil luglio lug",
    "ago agosto aug august aout",
    "set setembro sep sept september septiembre septembre settembre",
    "out outubro oct october octubre octobre ottobre ott",
    "nov novembro november noviembre novembre",
    "dez dezembro dec december dic diciembre decembre dicembre",
]
# Zone abbreviations and their offsets from UTC in minutes.
ZONES = {
    "utc": 0, "gmt": 0, "z": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "eet": 120, "eest": 180,
    "brt": -180, "brst": -120, "amt": -240, "amst": -180, "fnt": -120, "act": -300, "art": -180,
    "est": -300, "edt": -240, "cst": -360, "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420,
}

# {n} is the number of the alternative: group names must be unique within one Java regular expression.
_TIME = r"(?<h{n}>\d{{1,2}})(?:[:h](?<i{n}>\d{{2}})(?::(?<s{n}>\d{{2}})(?:[.,]\d+)?)?|h)\s*(?:min)?\s*(?<p{n}>[ap]\.?m\.?)?"
_ZONE = r"\s*(?:\(?(?<a{n}>[a-z]{{1,5}})\)?|(?:utc|gmt)?(?<o{n}>[+-]\d{{1,2}}(?::?\d{{2}})?)(?:\s*\([a-z]+\))?|\[(?<r{n}>[a-z]+(?:[/_+-][a-z0-9]+)*)\])?"
_TAIL = rf"(?:(?:\s+|\s*t\s*|\s*,\s*|\s+as\s+|\s+at\s+|\s*-\s+)(?:as\s+)?{_TIME}{_ZONE})?"
_DAY = r"(?:[a-z]+(?:-feira)?\.?,?\s+)?"
_FORMS = [
    r"(?<y{n}>\d{{4}})(?<q{n}>[-/.])(?<m{n}>\d{{1,2}})[-/.](?<d{n}>\d{{1,2}})" + _TAIL,
    r"(?<y{n}>\d{{4}})(?<m{n}>\d{{2}})(?<d{n}>\d{{2}})(?:\s*t?\s*(?<h{n}>\d{{2}}):?(?<i{n}>\d{{2}})(?::?(?<s{n}>\d{{2}})(?:[.,]\d+)?)?" + _ZONE + ")?",
    r"(?<u{n}>\d{{1,2}})[-/.](?<v{n}>\d{{1,2}})[-/.](?<y{n}>\d{{4}}|\d{{2}})" + _TAIL,
    _DAY + r"(?<d{n}>\d{{1,2}})(?:st|nd|rd|th|o|º|°|er)?(?:\s+de\s+|\s*[-/.]\s*|\s+)(?<w{n}>[a-z]+)\.?(?:\s+del?\s+|\s*[-/.,]\s*|\s+)(?<y{n}>\d{{4}}|\d{{2}})" + _TAIL,
    _DAY + r"(?<w{n}>[a-z]+)\.?\s+(?<d{n}>\d{{1,2}})(?:st|nd|rd|th)?,?\s+(?<y{n}>\d{{4}})" + _TAIL,
    r"(?<e{n}>\d{{10}}|\d{{13}})",
]
_PARTS = "ymdwuvhispaore"
PATTERN = r"^\s*(?:" + "|".join(f.format(n=n) for n, f in enumerate(_FORMS)) + r")\s*\.?\s*$"
# Of each component the group of whichever alternative matched: the others are empty.
_REPLACE = "#" + "|".join("".join(f"${{{p}{n}}}" for n in range(len(_FORMS)) if f"(?<{p}{n}>" in PATTERN) for p in _PARTS) + "|"


def _month_map() -> Column:
    return F.create_map(*[F.lit(x) for k, names in enumerate(MONTHS, 1) for name in names.split() for x in (name, k)])


def _zones() -> list[str]:
    """The zone names this JVM knows: an unknown name must give ``invalid``, not an exception."""
    return sorted(SparkSession.active()._jvm.java.util.ArrayList(SparkSession.active()._jvm.java.time.ZoneId.getAvailableZoneIds()))


def _days_in_month(y: Column, m: Column) -> Column:
    leap = ((y % 4 == 0) & (y % 100 != 0)) | (y % 400 == 0)
    return F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)


def _day_number(y: Column, m: Column, d: Column) -> Column:
    """Days since 1970-01-01 of a proleptic Gregorian date, by integer arithmetic (years from 1 on)."""
    yy = F.when(m <= 2, y - 1).otherwise(y)
    era = F.floor(yy / 400)
    yoe = yy - era * 400
    doy = F.floor((153 * (m + F.when(m > 2, -3).otherwise(9)) + 2) / 5) + d - 1
    return (era * 146097 + yoe * 365 + F.floor(yoe / 4) - F.floor(yoe / 100) + doy - 719468).cast("int")


def normalised(value: Column, home_tz: Column | None = None, date_order: Column | None = None) -> Column:
    """Struct ``(status, normal)``: status is ``blank``, ``date`` (already yyyy-MM-dd), ``date_only``, ``instant`` or ``invalid``."""
    tz = F.coalesce(F.when(home_tz.isin(_zones()), home_tz), F.lit("UTC")) if home_tz is not None else F.lit("UTC")
    mdy = F.upper(F.coalesce(date_order, F.lit("DMY"))) == "MDY" if date_order is not None else F.lit(False)
    text = F.regexp_replace(folded_lower(value), r"(?U)[\s\p{Z}\p{Cf}]+", " ")
    parts = F.split(F.regexp_replace(text, PATTERN, _REPLACE), r"\|")
    return F.struct(value.alias("v"), parts.alias("x"), tz.alias("tz"), mdy.alias("mdy"), blank(value).alias("b"))


def normalise_timestamps(df: DataFrame, value: str, home_tz: str | None = None, date_order: str | None = None, out: str = "date_utc") -> DataFrame:
    """Adds ``out`` (string) and ``out + '_status'`` to ``df``; see the module's docstring for every case.

    ``home_tz`` and ``date_order`` name columns of ``df``. Extra columns pass through; helper columns are prefixed and dropped.
    """
    t = "__ts_"
    raw = normalised(F.col(value), F.col(home_tz) if home_tz else None, F.col(date_order) if date_order else None)
    df = staged(df, {t + "in": raw})
    x = F.col(t + "in.x")
    hit = F.substring(x[0], 1, 1) == "#"
    part = {p: F.substring(x[0], 2, 9) if k == 0 else F.get(x, F.lit(k)) for k, p in enumerate(_PARTS)}
    num = {p: F.when(hit & (part[p] != "") & (F.length(part[p]) <= 9), part[p].cast("int")) for p in "ymduvhis"}
    epoch = F.when(hit & (part["e"] != ""), F.when(F.length(part["e"]) == 13, F.floor(part["e"].cast("bigint") / 1000)).otherwise(part["e"].cast("bigint")))
    mdy = F.col(t + "in.mdy")
    zone_map = F.create_map(*[F.lit(v) for kv in ZONES.items() for v in kv])
    df = staged(df, {t + "c": F.struct(
        F.when(F.length(part["y"]) == 2, num["y"] + 2000).otherwise(num["y"]).alias("y"),
        F.when(part["w"] != "", F.element_at(_month_map(), part["w"])).when(part["u"] != "", F.when(mdy, num["u"]).otherwise(num["v"])).otherwise(num["m"]).alias("m"),
        F.when(part["u"] != "", F.when(mdy, num["v"]).otherwise(num["u"])).otherwise(num["d"]).alias("d"),
        num["h"].alias("h"), F.coalesce(num["i"], F.lit(0)).alias("i"), F.coalesce(num["s"], F.lit(0)).alias("s"),
        F.when(hit & (part["p"] != ""), F.substring(part["p"], 1, 1)).alias("p"),
        F.when(part["a"] != "", part["a"]).alias("a"), F.when(part["o"] != "", part["o"]).alias("o"), F.when(part["r"] != "", part["r"]).alias("r"),
        epoch.alias("e"), hit.alias("hit"),
    )})
    c = lambda p: F.col(f"{t}c.{p}")
    hour = F.when(c("p") == "p", F.when(c("h") < 12, c("h") + 12).otherwise(c("h"))).when(c("p") == "a", F.when(c("h") == 12, 0).otherwise(c("h"))).otherwise(c("h"))
    digits = F.regexp_replace(c("o"), "[+:-]", "")
    oh = F.when(F.length(digits) <= 2, digits.cast("int")).otherwise(F.floor(digits.cast("int") / 100))
    om = F.when(F.length(digits) <= 2, 0).otherwise(digits.cast("int") % 100)
    offset = F.when(c("o").isNotNull(), F.when(F.startswith(c("o"), F.lit("-")), -(oh * 60 + om)).otherwise(oh * 60 + om)).when(c("a").isNotNull(), F.element_at(zone_map, c("a")))
    ok = c("hit") & (c("y") >= 1) & c("m").between(1, 12) & (c("d") >= 1) & (c("d") <= _days_in_month(c("y"), c("m")))
    ok = F.coalesce(ok & (c("h").isNull() | (hour.between(0, 23) & c("i").between(0, 59) & c("s").between(0, 59) & (c("p").isNull() | c("h").between(1, 12)))), F.lit(False))
    known = F.create_map(*[F.lit(x) for z in _zones() for x in (z.lower(), z)])
    reg = F.when(c("r").isNotNull(), F.element_at(known, c("r")))
    ok = ok & (c("r").isNull() | reg.isNotNull()) & (c("a").isNull() | offset.isNotNull()) & (c("o").isNull() | ((oh <= 18) & (om < 60)))
    df = staged(df, {t + "k": F.struct(ok.alias("ok"), _day_number(c("y"), c("m"), c("d")).alias("day"), hour.alias("h"), offset.alias("off"), reg.alias("reg"))})
    k = lambda p: F.col(f"{t}k.{p}")
    local = k("day").cast("bigint") * 86400 + k("h") * 3600 + c("i") * 60 + c("s")
    # Both kinds of zone resolve with the earlier offset where a local time repeats, and with the one before the change where it is skipped.
    region = F.when(c("r").isNotNull(), F.col(t + "k.reg")).otherwise(F.col(t + "in.tz"))
    in_zone = F.unix_seconds(F.to_utc_timestamp(F.timestamp_seconds(local), region))
    utc = F.when(c("e").isNotNull(), c("e")).when(k("off").isNotNull(), local - k("off") * 60).otherwise(in_zone)
    two = lambda n: F.lpad(n.cast("string"), 2, "0")
    stamp = lambda s: F.concat(F.date_from_unix_date(F.floor(s / 86400).cast("int")).cast("string"), F.lit("T"), two(F.floor(F.pmod(s, F.lit(86400)) / 3600)), F.lit(":"), two(F.floor(F.pmod(s, F.lit(3600)) / 60)), F.lit(":"), two(F.pmod(s, F.lit(60))), F.lit("Z"))
    plain = F.col(value).rlike(r"^\d{4}-\d{2}-\d{2}\z")
    status = F.when(blank(F.col(value)), "blank").when(c("e").isNotNull(), "instant").when(~k("ok"), "invalid").when(c("h").isNotNull(), "instant").when(plain, "date").otherwise("date_only")
    df = staged(df, {t + "z": F.struct(status.alias("st"), utc.alias("utc"))})
    st, utc = F.col(t + "z.st"), F.col(t + "z.utc")
    df = df.withColumn(out + "_status", st)
    df = df.withColumn(out, F.when(st == "blank", None).when(st == "invalid", "invalid").when(st == "instant", stamp(utc)).otherwise(F.date_from_unix_date(k("day")).cast("string")))
    return df.drop(t + "in", t + "c", t + "k", t + "z")


def found(main: DataFrame, registry: DataFrame) -> DataFrame:
    """``(rid, date_utc)`` of every row whose ``date_iso`` is neither null nor blank nor already an existing yyyy-MM-dd date."""
    reg = registry.groupBy("dataset_name").agg(F.first("home_tz", True).alias("home_tz"), F.first("date_order", True).alias("date_order"))
    rows = main.select("rid", "dataset_name", "date_iso").join(reg, "dataset_name", "left")
    done = normalise_timestamps(rows, "date_iso", "home_tz", "date_order")
    return done.where(~F.col("date_utc_status").isin("blank", "date")).select("rid", "date_utc")
