"""Column functions on partition specs (`a=1/b=2`), paths, modes and file counts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.scalars import col

MERGE_THRESHOLD = 104_857_600


def spec_level(spec: Column | str, level: int) -> Column:
    """One `field=value` level of a spec; 1 is the first, -1 the last."""
    return F.element_at(F.split(col(spec), "/"), level)


def spec_field(spec: Column | str, level: int = 1) -> Column:
    return F.split_part(spec_level(spec, level), F.lit("="), F.lit(1))


def spec_value(spec: Column | str, level: int = 1) -> Column:
    return F.split_part(spec_level(spec, level), F.lit("="), F.lit(2))


def spec_level_count(spec: Column | str) -> Column:
    spec = col(spec)
    return F.length(spec) - F.length(F.replace(spec, F.lit("=")))


def spec_head(spec: Column | str) -> Column:
    """The first two levels of a spec, or all of a shorter one."""
    return F.substring_index(col(spec), "/", 2)


def spec_predicate(spec: Column | str) -> Column:
    """`a=1/b=2` as the SQL text `a='1' and b='2'`."""
    levels = F.transform(F.split(col(spec), "/"), lambda s: F.regexp_replace(s, "^([^=]*)=(.*)$", "$1='$2'"))
    return F.array_join(levels, " and ")


def path_cluster(path: Column | str) -> Column:
    """The authority of a URI: `scheme://cluster/dir` gives `cluster`."""
    return F.regexp_extract(col(path), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def path_parent(path: Column | str) -> Column:
    return F.regexp_extract(col(path), "^(.*)/[^/]*$", 1)


def path_name(path: Column | str) -> Column:
    return F.substring_index(col(path), "/", -1)


def path_extension(path: Column | str) -> Column:
    """What follows the last dot of the last component; empty without a dot."""
    return F.regexp_extract(col(path), r"\.([^./]*)$", 1)


def dated_path(path: Column | str, folder: str, subfolder: str, day: Column | str) -> Column:
    """Insert `subfolder/dt=yyyyMMdd` behind the first component named `folder`."""
    behind = F.concat(F.lit(f"/{folder}/{subfolder}/dt="), F.date_format(col(day), "yyyyMMdd"), F.lit("/"))
    path = col(path)
    at = F.instr(path, f"/{folder}/")
    moved = F.concat(F.substr(path, F.lit(1), at - 1), behind, F.substr(path, at + len(folder) + 2))
    return F.when(at > 0, moved).otherwise(path)


def mode_octal(mode: Column | str) -> Column:
    """`drwxr-xr-x` as `755`."""
    mode = col(mode)

    def digit(first: int) -> Column:
        bits = zip("rwx", (4, 2, 1))
        return sum(
            (F.when(F.substring(mode, first + i, 1) == flag, bit).otherwise(0)
             for i, (flag, bit) in enumerate(bits)),
            F.lit(0),
        )

    return F.concat(*[digit(first).cast("string") for first in (2, 5, 8)])


def target_files(total: Column | str, largest: Column | str, files: Column | str,
                 threshold: int = MERGE_THRESHOLD) -> Column:
    """How many files a partition should be rewritten to.

    Total bytes over the larger of the threshold and the largest child, at least 1 and never
    more than there are now.
    """
    wanted = F.floor(col(total) / F.greatest(col(largest), F.lit(threshold)))
    return F.greatest(F.lit(1), F.least(col(files), wanted)).cast("long")
