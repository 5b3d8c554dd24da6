"""Text functions."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

_REGEX_META = set(".$|()[]{}^?*+\\")


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _pattern(sep: str) -> str:
    if len(sep) != 1:
        raise ValueError("sep must be a single character")
    return "\\" + sep if sep in _REGEX_META else sep


def split_trimmed(c: Column | str, sep: str) -> Column:
    """Split at a one-character separator, dropping trailing empty items.

    An empty string gives one empty item, a string of separators none, NULL gives NULL.
    """
    c, pattern = as_column(c), _pattern(sep)
    # Trimming is slow next to the split itself, so only what needs it is trimmed.
    trimmed = F.rtrim(c, F.lit(sep))
    return (
        F.when(~c.endswith(F.lit(sep)), F.split(c, pattern))
        .when(trimmed == "", F.array().cast("array<string>"))
        .otherwise(F.split(trimmed, pattern))
    )


def pick_fields(
    c: Column | str,
    pick: Callable[[Callable[[int], Column]], Column],
    sep: str = "\t",
    more_than: int | None = None,
) -> Column:
    """The fields of a line that `pick` takes, as an array of at most one item.

    `pick` gets a function from a position to the field there (NULL past the end). In a line
    that is not valid UTF-8, what `split` puts in the place of malformed bytes is dropped from
    it, as `drop_malformed_utf8` does for whole lines; valid lines stay as they are. With `more_than`,
    lines with at most that many fields give an empty array; trailing empty fields do not
    count. To be exploded: the line is split once, and only what is picked is kept.
    """
    valid = F.is_valid_utf8(as_column(c))
    lines = F.array(F.split(as_column(c), _pattern(sep)))

    def repaired(field: Column) -> Column:
        return F.when(valid, field).otherwise(_without_replacements(field))

    if more_than is not None:
        lines = F.filter(
            lines,
            lambda f: F.exists(
                F.slice(f, F.lit(more_than + 1), F.size(f)),
                lambda x: repaired(x) != "",
            ),
        )
    return F.transform(
        lines, lambda f: pick(lambda i: repaired(F.get(f, F.lit(i))))
    )


def _without_replacements(c: Column) -> Column:
    return F.replace(c, F.lit("\ufffd"), F.lit(""))


def before_first(c: Column | str, sep: str = ",") -> Column:
    """The text before the first `sep`; the whole text where there is none."""
    return F.substring_index(as_column(c), sep, 1)


def first_field(c: Column | str, sep: str = "\t") -> Column:
    """The first field of a line, trailing empty fields or not."""
    return F.split_part(as_column(c), F.lit(sep), F.lit(1))


def contains_any(c: Column | str, substrings: Sequence[str]) -> Column:
    c = as_column(c)
    return reduce(or_, [c.contains(s) for s in substrings], F.lit(False))


def keep_name(
    name: Column | str, exclude: Sequence[str] = (), drop_empty: bool = False
) -> Column:
    """True for the names that are to be counted."""
    name = as_column(name)
    keep = ~contains_any(name, exclude) if exclude else F.lit(True)
    return keep & (name != "") if drop_empty else keep


def name_list(
    names: Column | str, exclude: Sequence[str] = ("Category",), drop_empty: bool = True
) -> Column:
    """`name,offset;name,offset;...` as an array of the names to count."""
    parts = F.transform(split_trimmed(names, ";"), lambda e: before_first(e, ","))
    return F.filter(parts, lambda n: keep_name(n, exclude, drop_empty))


def merge_count_maps(left: Column | str, right: Column | str) -> Column:
    """Two name -> count maps as one; counts of a name in both are added."""
    zero = F.lit(0).cast("bigint")
    return F.map_zip_with(
        as_column(left),
        as_column(right),
        lambda _, a, b: F.coalesce(a, zero) + F.coalesce(b, zero),
    )


def drop_malformed_utf8(c: Column | str) -> Column:
    """Drop byte sequences that are not UTF-8.

    Text that needs no repair is passed on as it is; from other text the replacement
    character goes as well.
    """
    c = as_column(c)
    repaired = _without_replacements(F.make_valid_utf8(c))
    return F.when(F.is_valid_utf8(c), c).otherwise(repaired)


def record_key(c: Column | str) -> Column:
    """`<time>-<seq>` as struct(time, seq); (0, 0) for anything else."""
    parts = split_trimmed(c, "-")

    def number(i: int) -> Column:
        part = F.get(parts, F.lit(i))
        # A cast alone would also accept surrounding blanks.
        return F.when(part.rlike(r"^\+?[0-9]+$"), part.try_cast("bigint"))

    valid = (F.size(parts) == 2) & number(0).isNotNull() & number(1).isNotNull()
    zero = F.lit(0).cast("bigint")
    return F.struct(
        F.when(valid, number(0)).otherwise(zero).alias("time"),
        F.when(valid, number(1)).otherwise(zero).alias("seq"),
    )
