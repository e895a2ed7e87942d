"""Path keys: when do two spellings name the same file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The root table is configuration, not data; a longer one is refused instead of being sent to every task.
MAX_ROOTS = 1000


def slashed(path: Column) -> Column:
    """Trimmed, lower case, one '/' for every run of separators and '.' steps. Null stays null."""
    p = F.lower(F.regexp_replace(path, r"^\s+|\s+$", ""))
    p = F.regexp_replace(p, r"[\\/]+(?:\.[\\/]+)*", "/")
    p = F.regexp_replace(p, r"^\./", "")
    return F.regexp_replace(p, r"/\.?$", "")


def unquoted(path: Column) -> Column:
    """Without blanks and then quotes round it, for paths out of lists and tables that people write."""
    return F.regexp_replace(F.regexp_replace(path, r"^\s+|\s+$", ""), "^[\"']+|[\"']+$", "")


def root_pairs(roots: DataFrame) -> list[tuple[str, str]]:
    """(root, canonical root) in slashed form, longest root first, so that a nested root wins. Rows with a null are ignored."""
    rows = (
        roots.select(slashed(F.col("root_path")).alias("r"), slashed(F.col("canonical_root")).alias("c"))
        .where("r is not null and c is not null and r <> ''")
        .groupBy("r")
        .agg(F.min("c").alias("c"))
        .limit(MAX_ROOTS + 1)
        .collect()
    )
    if len(rows) > MAX_ROOTS:
        raise ValueError(f"more than {MAX_ROOTS} path roots")
    return sorted(((x.r, x.c) for x in rows), key=lambda x: (-len(x[0]), x[0]))


def file_key(path: Column, roots: list[tuple[str, str]]) -> Column:
    """Equal for two spellings of one file: slashed form with the leading root replaced by its canonical root.

    The expression is long: select it under a name of its own before using it several times.
    """
    key = slashed(path)
    if not roots:
        return key
    by_canonical: dict[str, list[str]] = {}
    for root, canonical in roots:
        by_canonical.setdefault(canonical, []).append(root)
    # a replaced root is marked until all are through, so that none is replaced twice
    for canonical, own in by_canonical.items():
        longest = "|".join("\\Q" + root + "\\E" for root in sorted(own, key=len, reverse=True))
        key = F.regexp_replace(key, f"^(?:{longest})(?=/|$)", "\x01" + canonical.replace("\\", "\\\\").replace("$", "\\$"))
    return F.regexp_replace(key, "^\x01", "")


def without_extension(key: Column) -> Column:
    """Drops a last '.ext' of two to five letters and digits; a date such as '18.32 memo' is no extension."""
    return F.regexp_replace(key, r"\.[a-z][a-z0-9]{1,4}$", "")


def base_name(path: Column) -> Column:
    """Last component, lower case."""
    return F.element_at(F.split(slashed(path), "/"), -1)


def stem(path: Column) -> Column:
    return without_extension(base_name(path))


def tail_from_marker(key: Column, markers: tuple[str, ...]) -> Column:
    """The part of a slashed key from the first of the markers on (markers in order of preference); null where none occurs."""
    return F.coalesce(*[F.when(F.instr(key, m) > 0, F.substring(key, F.instr(key, m), F.lit(1 << 30))) for m in markers])


def base_recording_name(name: Column, marker: str = "_sent") -> Column:
    """The file name up to the sentence marker that chunking adds."""
    return F.substring_index(name, marker, 1)


def strip_suffixes(name: Column, pattern: str) -> Column:
    """Removes any run of the given suffix pattern before the extension."""
    return F.regexp_replace(name, rf"(?:{pattern})+(?=(?:\.[A-Za-z0-9]+)?$)", "")


def uid_from_name(name: Column) -> Column:
    """The first of two hexadecimal ids in '<base uid>_<uid>__...', null if the name has another form."""
    return F.nullif(F.regexp_extract(name, r"^([0-9a-f]{8,40})_[0-9a-f]{8,40}__", 1), F.lit(""))
