"""Reading typed values out of string cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Plain decimal notation; keeps out what engines read differently, such as 1d or 1_000.
NUMBER = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:nan|inf|infinity)$"
TRUE_WORDS = ("1", "true", "yes", "y", "t")


def to_float(cell: Column) -> Column:
    """A number, or null for null, empty and unreadable cells."""
    text = F.trim(cell.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def scalar(cell: Column) -> Column:
    """A number, or 0 where there is none."""
    return F.coalesce(to_float(cell), F.lit(0.0))


def truthy(cell: Column) -> Column:
    return F.coalesce(F.lower(F.trim(cell.cast("string"))).isin(*TRUE_WORDS), F.lit(False))


def flag_unset(cell: Column) -> Column:
    """The clean-up flag as the matcher reads it: missing, empty or 0, without trimming."""
    return F.coalesce(cell.cast("string"), F.lit("0")).isin("0", "")


def flag_set(cell: Column) -> Column:
    """The clean-up flag as the cleaner reads it: 1, true, True or TRUE, trimmed."""
    return F.coalesce(F.trim(cell.cast("string")).isin("1", "true", "True", "TRUE"), F.lit(False))


def first_filled(*cells: Column) -> Column:
    """The first cell that is neither null nor empty."""
    return F.coalesce(*(F.nullif(c, F.lit("")) for c in cells))


def degrees(radians: Column) -> Column:
    return radians * 180.0 / F.pi()


def maybe_degrees(angle: Column) -> Column:
    """Angles up to pi + 0.05 are taken for radians, whatever wrote them."""
    return F.when(F.abs(angle) <= F.pi() + 0.05, degrees(angle)).otherwise(angle)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def stem(path: Column) -> Column:
    """The file name without its last suffix; a leading dot is no suffix."""
    return F.regexp_replace(base_name(path), r"(?<=.)[.][^.]*$", "")


def suffix(path: Column) -> Column:
    """The last suffix in lower case, with its dot; empty without one."""
    return F.lower(F.regexp_extract(base_name(path), r".([.][^.]*)$", 1))


def first_number(text: Column) -> Column:
    """The first run of digits as a number; null without one."""
    return F.regexp_extract(text, "([0-9]+)", 1).try_cast("long")


def padded(number: Column, width: int = 6) -> Column:
    """Zeros in front up to ``width`` digits; longer numbers stay whole."""
    return F.format_string(f"%0{width}d", number.cast("long"))


def safe_name(text: Column) -> Column:
    """Slashes and runs of other characters become _, white space one blank."""
    plain = F.regexp_replace(F.regexp_replace(text, r"[/\\]", "_"), r"[^A-Za-z0-9 _-]+", "_")
    return F.trim(F.regexp_replace(plain, r"\s+", " "))


def clock_seconds(text: Column) -> Column:
    """SS, MM:SS or HH:MM:SS(.ms) in seconds; null for other forms."""
    t = F.trim(text)
    parts = F.split(t, ":")
    number = lambda i: to_float(F.get(parts, i))
    return (
        F.when(t.rlike(r"^[0-9]+([.][0-9]+)?$"), t.try_cast("double"))
        .when(F.size(parts) == 2, number(0) * 60 + number(1))
        .when(F.size(parts) == 3, number(0) * 3600 + number(1) * 60 + number(2))
    )


def clock_text(seconds: Column) -> Column:
    """mm:ss, or h:mm:ss from an hour on; whole seconds."""
    s = F.greatest(F.lit(0), seconds.cast("long"))
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.when(h > 0, F.format_string("%d:%02d:%02d", h, m, r)).otherwise(F.format_string("%02d:%02d", m, r))


def range_spec(text: Column) -> Column:
    """A-B as a struct of two clock times in seconds; null for other forms."""
    found = F.regexp_extract(text, r"^\s*([0-9:.]+)\s*-\s*([0-9:.]+)\s*$", 0)
    side = lambda i: clock_seconds(F.regexp_extract(text, r"^\s*([0-9:.]+)\s*-\s*([0-9:.]+)\s*$", i))
    return F.when(found != "", F.struct(side(1).alias("start"), side(2).alias("end")))


def rational(text: Column) -> Column:
    """N/D as a number; null if it is not positive."""
    value = F.try_divide(F.split_part(text, F.lit("/"), F.lit(1)).try_cast("double"), F.split_part(text, F.lit("/"), F.lit(2)).try_cast("double"))
    return F.when(value > 0, value)


def percent(count: Column, total: Column) -> Column:
    return F.lit(100.0) * count / F.greatest(total, F.lit(1))


def bar(percentage: Column, width: int = 16) -> Column:
    """A bar of ``width`` cells, rounded half to even."""
    filled = F.bround(F.lit(float(width)) * F.greatest(F.lit(0.0), F.least(F.lit(100.0), percentage)) / 100.0).cast("int")
    return F.rpad(F.repeat(F.lit("█"), filled), width, " ")


# Cells of a fine bar that is filled in part.
PARTIAL_CELLS = "▏▎▍▌▋▊▉"


def fine_bar(ratio: Column, width: int = 20) -> Column:
    """A bar of ``width`` cells whose last one may be filled in part (no cell for less than 2/7 of one)."""
    r = F.greatest(F.lit(0.0), F.least(F.lit(1.0), ratio)) * width
    full = F.floor(r).cast("int")
    part = F.floor((r - full) * len(PARTIAL_CELLS)).cast("int")
    cell = F.when((full < width) & (part > 0), F.substring(F.lit(PARTIAL_CELLS), F.least(part + 1, F.lit(len(PARTIAL_CELLS))), F.lit(1))).otherwise(F.lit(""))
    return F.rpad(F.concat(F.repeat(F.lit("█"), full), cell), width, " ")


def on_off(value: str | bool | None, default: bool) -> bool:
    """An option's value: on/off words in any case, else the default."""
    text = "" if value is None else str(value).strip().lower()
    return True if text in {"1", "true", "on", "yes", "y"} else False if text in {"0", "false", "off", "no", "n"} else default
