"""Label text, slugs, names and natural order as Column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_LABELS = ("nan", "none", "null")  # fixed values: texts that mean "no label"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_label(c, renames: Mapping[str, str] | None = None) -> Column:
    """Trimmed label with underscores as spaces; NULL for empty, nan, none and null."""
    label = F.trim(_col(c).cast("string"))
    present = (label != "") & ~F.lower(label).isin(*EMPTY_LABELS)
    named = label
    if renames:
        pairs = [F.lit(x) for kv in renames.items() for x in kv]
        named = F.coalesce(F.try_element_at(F.create_map(*pairs), label), label)
    return F.when(present, F.trim(F.translate(named, "_", " ")))


def slugify(c) -> Column:
    slug = F.regexp_replace(F.lower(_col(c)), "[^a-z0-9]+", "_")
    slug = F.regexp_replace(slug, "^_+|_+$", "")
    return F.when(slug == "", F.lit("unknown")).otherwise(slug)


def task_of(c) -> Column:
    """The part before the first slash; NULL without a slash or when it is blank."""
    key = _col(c)
    task = F.trim(F.substring_index(key, "/", 1))
    return F.when(F.contains(key, F.lit("/")) & (task != ""), task)


def label_of(c) -> Column:
    """Everything behind the first slash, or the whole text without one."""
    key = _col(c)
    at = F.instr(key, "/")
    return F.when(at > 0, F.trim(F.substr(key, at + 1))).otherwise(key)


def label_folder(c) -> Column:
    """``task_slug/label_slug``."""
    return F.concat_ws("/", F.when(task_of(c).isNotNull(), slugify(task_of(c))),
                       slugify(label_of(c)))


def natural_key(c) -> Column:
    """Sortable array: digit runs compare as numbers, the rest as lower-case text."""
    parts = F.regexp_extract_all(F.lower(_col(c)), F.lit(r"(\D*\d*)"), F.lit(1))
    return F.transform(F.filter(parts, lambda p: p != ""), lambda p: F.struct(
        F.regexp_extract(p, r"^(\D*)", 1).alias("text"),
        F.coalesce(F.regexp_extract(p, r"(\d+)$", 1).try_cast("decimal(38,0)"),
                   F.lit(-1).cast("decimal(38,0)")).alias("number")))


def unix_path(c) -> Column:
    return F.translate(_col(c), "\\", "/")


def file_name(path) -> Column:
    return F.substring_index(_col(path), "/", -1)


def file_stem(path) -> Column:
    """File name without its last suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]*$", "")


def parent_name(path) -> Column:
    parts = F.split(_col(path), "/")
    return F.get(parts, F.size(parts) - 2)


def path_parts(path) -> Column:
    return F.filter(F.split(_col(path), "/"), lambda p: p != "")


def first_part(path, condition, last: bool = False) -> Column:
    parts = F.filter(path_parts(path), condition)
    return F.get(F.reverse(parts) if last else parts, F.lit(0))


def safe_stem(c) -> Column:
    """A relative path as one file name: no suffix, ``/`` as ``__``, blanks as ``_``."""
    stem = F.regexp_replace(_col(c), r"(?<=[^/])\.[^./]*$", "")
    return F.translate(F.regexp_replace(stem, "/", "__"), " ", "_")


def people(n: Column) -> Column:
    return F.concat(n.cast("string"), F.when(n == 1, F.lit(" person")).otherwise(F.lit(" people")))


def distinct_filled(columns: Sequence[str]) -> Column:
    """Non-empty values of the columns, first occurrence first, each once."""
    values = F.array(*[F.col(c).cast("string") for c in columns])
    return F.array_distinct(F.filter(values, lambda v: v.isNotNull() & (v != "")))


def joined(c) -> Column:
    """``a + b`` for several labels, NULL for none."""
    arr = _col(c)
    return F.when(F.size(arr) > 0, F.array_join(arr, " + "))


def expand_vocabulary(c) -> Column:
    """The entries of a written vocabulary, ranges such as ``S 01-03`` written out.

    Tokens are parted by a middle dot, bullet, bar or comma; a leading ``name:`` is dropped.
    A range keeps the wider zero padding, must not run backwards and spans at most 500.
    """
    body = F.regexp_replace(_col(c), r"^[^:\n]+:\s*", "")
    tokens = F.filter(F.transform(F.split(body, r"\s*[·•|]\s*|\s*,\s*"),
                                  lambda t: F.trim(t)), lambda t: t != "")
    pattern = r"^(.*?)(\d+)\s*[–-]\s*(\d+)$"

    def expand(token: Column) -> Column:
        low_text, high_text = (F.regexp_extract(token, pattern, g) for g in (2, 3))
        low, high = low_text.try_cast("long"), high_text.try_cast("long")
        width = F.greatest(F.length(low_text), F.length(high_text))
        fits = token.rlike(pattern) & low.isNotNull() & high.isNotNull() & (high >= low) & (
            high - low <= 500)
        names = F.transform(
            F.sequence(F.coalesce(low, F.lit(0)), F.when(fits, high).otherwise(F.coalesce(low, F.lit(0)))),
            lambda n: F.trim(F.concat(F.regexp_extract(token, pattern, 1),
                                      F.lpad(n.cast("string"), width, F.lit("0")))))
        return F.when(fits, names).otherwise(F.array(token))

    return F.flatten(F.transform(tokens, expand))


def glob_to_regex(pattern: str) -> str:
    """A file glob as an anchored regular expression; ``**/`` spans any number of folders."""
    out, rest = "", pattern
    while rest:
        if rest.startswith("**/"):
            out, rest = out + "(?:.*/)?", rest[3:]
        elif rest.startswith("*"):
            out, rest = out + "[^/]*", rest[1:]
        elif rest.startswith("?"):
            out, rest = out + "[^/]", rest[1:]
        else:
            ch = rest[0]
            out, rest = out + ("\\" + ch if ch in r".+()[]{}^$|\\" else ch), rest[1:]
    return f"^{out}$"
