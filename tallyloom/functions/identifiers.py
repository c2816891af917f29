"""Names: turning raw headers and file names into safe identifiers."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F

# The naming rules that generated identifiers follow.
UNSAFE_RUN = "[^0-9a-zA-Z]+"
EMPTY_NAME = "col"
DIGIT_PREFIX = "c_"
ID_NAMES = ("id", "rowid", "uuid", "guid")
ID_SUFFIX = "_id"
RESCUED_COLUMN = "_rescued_data"


def identifier(name: Column) -> Column:
    """A safe lower-case identifier from a column of raw names."""
    core = F.lower(F.btrim(F.regexp_replace(name, UNSAFE_RUN, "_"), F.lit("_")))
    core = F.when(core == "", F.lit(EMPTY_NAME)).otherwise(core)
    return F.when(core.rlike("^[0-9]"), F.concat(F.lit(DIGIT_PREFIX), core)).otherwise(core)


def unique_identifiers(names: Iterable[str], taken: Iterable[str] = ()) -> list[str]:
    """Identifiers for the columns of one schema, or the files of one folder. Repeats get
    the first free numbered form, so the result never holds a name twice."""
    used, out = set(taken), []
    for name in names:
        base = "_".join(re.findall("[0-9a-zA-Z]+", name)).lower() or EMPTY_NAME
        base = DIGIT_PREFIX + base if base[0].isdigit() else base
        numbered = (f"{base}_{i}" for i in itertools.count(2))
        out.append(next(c for c in itertools.chain([base], numbered) if c not in used))
        used.add(out[-1])
    return out


def file_stem(path: Column) -> Column:
    """The last path component without its extension."""
    return F.regexp_replace(F.regexp_extract(path, "([^/]*)$", 1), r"(?<=.)\.[^.]*$", "")


def table_name(path: Column) -> Column:
    """The table that a file loads into."""
    return identifier(file_stem(path))


def rename_clean(df: DataFrame) -> DataFrame:
    """The same rows under clean column names, without the rescue column."""
    kept = [c for c in df.columns if c != RESCUED_COLUMN]
    return df.select(*[F.col(f"`{c.replace('`', '``')}`") for c in kept]).toDF(*unique_identifiers(kept))


def id_like(name: Column) -> Column:
    """Whether a column name denotes an identifier rather than a measure."""
    return F.lower(name).isin(*ID_NAMES) | F.lower(name).endswith(ID_SUFFIX)
