"""Column expressions that bring values and names to one form."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .vocabulary import CLEAN_ENDINGS, COMPOUND_ENDINGS, LOOKUP_ENDINGS

NULL_WORDS = ("none", "nan", "null", "na", "nat")
NUMBER = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
#: What is trimmed off.
WHITE = " \t\n\x0b\f\r"
#: Longer values are compared by digest, so that whole texts do not travel through joins.
LONG = 256


def trimmed(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def digest(c: Column) -> Column:
    """What stands for a long text: the digest of the trimmed text, and behind + that of the whole one where they differ."""
    return F.concat(F.lit("md5:"), F.md5(trimmed(c)), F.when(F.length(trimmed(c)) < F.length(c), F.concat(F.lit("+"), F.md5(c))).otherwise(""))


def as_text(c: Column, kind: T.DataType, whole: bool = False) -> Column:
    """A value as text: integral doubles without a fraction, timestamps in ISO form, long strings as digests unless ``whole``."""
    if isinstance(kind, (T.DoubleType, T.FloatType, T.DecimalType)):
        x = c.cast("double")
        return F.when((x == F.floor(x)) & (F.abs(x) < 1e15), x.cast("bigint").cast("string")).otherwise(x.cast("string"))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.date_format(c.cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = c.cast("string")
    if isinstance(kind, T.StringType) and not whole:
        return F.when((F.length(text) > LONG) & (F.length(trimmed(text)) > LONG), digest(text)).otherwise(text)
    return text


def is_compound(name: str | Column) -> bool | Column:
    """Whether a column is named as one whose cells hold lists."""
    if isinstance(name, str):
        return name.lower().endswith(COMPOUND_ENDINGS)
    return reduce(lambda a, b: a | b, (F.lower(name).endswith(e) for e in COMPOUND_ENDINGS))


def number(s: Column) -> Column:
    """The number that a text spells, else null."""
    return F.when(s.rlike(NUMBER), s.try_cast("double"))


def in_one_form(df: DataFrame, raw: Column, name: str = "value") -> DataFrame:
    """df with a column of the one spelling of each value, null for blanks and null words.

    Whole numbers lose sign, leading zeros and a zero fraction; other numbers are written in six
    significant digits as C's %g writes them (ties of the seventh go up); other text is trimmed, and long text stands as its digest.
    The steps are projections of their own, so that each is a small generated method that the JIT compiles.
    """
    s, x, size, power, scaled = (F.col(f"_{c}") for c in ("s", "x", "size", "power", "scaled"))
    known = set(df.columns) - {name}
    df = df.withColumn("_s", trimmed(raw))
    mixed = s.startswith("md5:") & s.rlike(r"^md5:[0-9a-f]{32}\+[0-9a-f]{32}$")
    df = df.withColumn("_s", F.when(F.length(s) > LONG, F.concat(F.lit("md5:"), F.md5(s))).when(mixed, F.left(s, F.lit(36))).otherwise(s))
    blank = (s == "") | ((F.length(s) <= 4) & F.lower(s).isin(*NULL_WORDS))
    kind = F.when(s.isNull() | blank, 0).when(~s.rlike(r"^[+-]?\.?\d"), 3).when(s.rlike(r"^[+-]?\d+(\.0*)?$"), 1).when(s.rlike(NUMBER), 2).otherwise(3)
    df = df.withColumn("_kind", kind)
    df = df.withColumn("_x", F.when(F.col("_kind") == 2, s.try_cast("double")))
    df = df.withColumn("_size", F.when((x != F.floor(x)) | (F.abs(x) >= 1e18), F.abs(x)))
    df = df.withColumn("_power", F.floor(F.log10(size)).cast("int"))
    df = df.withColumn("_scaled", F.floor(size * F.pow(F.lit(10.0), F.lit(5) - power) + 0.5))
    over = scaled >= 1e6
    df = df.withColumns({"_power": F.when(over, power + 1).otherwise(power), "_scaled": F.when(over, F.lit(100000.0)).otherwise(scaled)})
    strip = lambda d: F.regexp_replace(d.cast("string"), r"\.?0+$", "")
    plain = strip((scaled / F.pow(F.lit(10.0), F.lit(5) - power)).cast("decimal(24,10)"))
    df = df.withColumn("_plain", F.when((power >= -4) & (power < 6), plain))
    digits = F.concat(strip((scaled / 1e5).cast("decimal(10,5)")), F.lit("e"), F.when(power < 0, "-").otherwise("+"), F.lpad(F.abs(power).cast("string"), 2, "0"))
    df = df.withColumn("_short", F.when(size.isNotNull(), F.concat(F.when(x < 0, "-").otherwise(""), F.coalesce("_plain", digits))))
    whole = F.ltrim(F.substring_index(s, ".", 1), F.lit("+-0"))
    value = F.when(F.col("_kind") == 1, F.when(whole == "", "0").otherwise(whole)).when(F.col("_kind") == 2, F.coalesce("_short", x.cast("bigint").cast("string"))).when(F.col("_kind") == 3, s)
    return df.withColumn(name, value).select(*(c for c in df.columns if c in known), name)


def parts(value: Column) -> Column:
    """The members of a compound value, if none is blank; else the value alone."""
    split = F.split(trimmed(value), r"[|;,，、]")
    return F.when((F.size(split) > 1) & F.forall(split, lambda p: F.trim(p) != ""), split).otherwise(F.array(value))


def without_ending(name: Column, endings: tuple[str, ...]) -> Column:
    """A name in lower case without the first ending that it has."""
    low = F.lower(name)
    return reduce(lambda out, e: F.when(low.endswith(e), F.substring(low, F.lit(1), F.length(low) - len(e))).otherwise(out), reversed(endings), low)


def lookup_stem(name: Column) -> Column:
    return without_ending(name, LOOKUP_ENDINGS)


def clean_name(name: Column) -> Column:
    return without_ending(name, CLEAN_ENDINGS)


def is_subsequence(short: Column, long: Column) -> Column:
    """Whether all characters of one text stand in another in order."""
    return F.rlike(long, F.concat(F.lit("^.*"), F.regexp_replace(short, "(.)", r"\\Q$1\\E.*")))


def cents(x: Column) -> Column:
    """Two decimals, half up, alike in every engine."""
    return F.floor(x * 100 + 0.5) / 100


def has_any(text: Column, words: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(w)) for w in words))


def excel_letter(index: Column) -> Column:
    """A, B, ... Z, AA, ... for a column number from 0 (seven letters at most)."""

    def further(state: Column, _: Column) -> Column:
        n, s = state["n"] - 1, state["s"]
        letter = F.char(65 + F.pmod(n, F.lit(26)))
        return F.struct(F.floor((n - F.pmod(n, F.lit(26))) / 26).alias("n"), F.when(n < 0, s).otherwise(F.concat(letter, s)).alias("s"))

    start = F.struct((index.cast("bigint") + 1).alias("n"), F.lit("").alias("s"))
    return F.when(index.isNotNull(), F.aggregate(F.sequence(F.lit(1), F.lit(7)), start, further)["s"])
