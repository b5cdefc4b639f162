"""Strings for reports, paths and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number(x: Column, places: int, suffix: str = "") -> Column:
    """Fixed places, rounded from the exact binary value, or a dash for null."""
    pattern = F.lit("0." + "0" * places) if places else F.lit("0")
    return F.when(x.isNull(), F.lit("-")).otherwise(F.concat(F.call_function("format_number", x, pattern), F.lit(suffix)))


def shortened(text: Column, most: int = 80) -> Column:
    return F.when(F.length(text) > most, F.concat(F.substring(text, 1, most - 3), F.lit("..."))).otherwise(text)


def flag_list(flags: Column) -> Column:
    return F.when(F.coalesce(F.size(flags), F.lit(0)) <= 0, F.lit("none")).otherwise(F.array_join(flags, ", "))


def label(key: Column, names: dict[str, str]) -> Column:
    """A short name; keys without one stand for themselves."""
    pairs = [F.lit(x) for kv in names.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), key), key) if pairs else key


def slug(provider: Column, voice_id: Column) -> Column:
    return F.translate(F.concat_ws("-", provider, voice_id), "/:", "__")


def composite_id(prompt_id: Column, voice_slug: Column) -> Column:
    return F.concat_ws("_", prompt_id, voice_slug)


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dataset_relative(path: Column, folder: str = "audio") -> Column:
    return F.concat(F.lit(folder + "/"), basename(path))


def posix(path: Column) -> Column:
    return F.translate(path, "\\", "/")


def absolute(base: str, path: Column) -> Column:
    return F.concat_ws("/", F.lit(base), path)


def is_absolute(path: Column) -> Column:
    return path.rlike(r"^([A-Za-z]:|/)")


def percent(part: Column, whole: Column) -> Column:
    return F.lit(100.0) * part / F.greatest(whole, F.lit(1))


def error_text(kind: Column, message: Column) -> Column:
    return F.concat_ws(": ", kind, message)


def joined_segments(segments: Column) -> Column:
    # not F.trim itself: it takes a second argument, which ``transform`` fills with the segment's place
    return F.trim(F.array_join(F.transform(segments, lambda s: F.trim(s)), " "))


#: Fixed value: the reply's other key.
OTHER_KEY = "جمل"


def prompts_from_json(text: Column, key: str = "prompts", other: str = OTHER_KEY) -> Column:
    """Array of strings from a JSON reply: the key or, if missing or empty, the other key; scalars become strings, anything else is no list."""
    first, second = (F.from_json(F.get_json_object(text, f"$.{k}"), "array<string>", {"mode": "PERMISSIVE"}) for k in (key, other))
    found = F.when(F.coalesce(F.size(first), F.lit(0)) > 0, first).otherwise(second)
    return F.coalesce(F.filter(found, lambda x: x.isNotNull() & ~F.coalesce(x.rlike(r"^\s*[\[{]"), F.lit(False))), F.array().cast("array<string>"))
