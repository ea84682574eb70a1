"""Text normalisation as Column expressions. Missing text is NULL, never ''."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wakeline import params as P


WHITESPACE = " \t\n\x0b\f\r"


def col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` worked out once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda v: body(v)), F.lit(0))


def present(value: Column | str) -> Column:
    """Trimmed text, NULL when empty."""
    return F.nullif(F.trim(col(value).cast("string"), F.lit(WHITESPACE)), F.lit(""))


def norm_text(value: Column | str) -> Column:
    return F.regexp_replace(F.upper(present(value)), r"\s+", " ")


def collapse(value: Column | str) -> Column:
    return F.regexp_replace(present(value), r"\s+", " ")


def norm_key(value: Column | str) -> Column:
    return F.nullif(F.regexp_replace(F.upper(col(value).cast("string")), "[^A-Z0-9]", ""), F.lit(""))


def norm_digits(value: Column | str) -> Column:
    return F.nullif(F.regexp_replace(col(value).cast("string"), "[^0-9]", ""), F.lit(""))


def split_tokens(value: Column | str) -> Column:
    parts = F.transform(F.split(F.coalesce(col(value), F.lit("")), r"[;,|]"), lambda x: F.trim(x))
    return F.filter(parts, lambda x: x != "")


def to_bool(value: Column | str) -> Column:
    return F.coalesce(F.lower(present(value)).isin(*P.TRUE_WORDS), F.lit(False))


def normalize_unknown(value: Column | str) -> Column:
    return let(present(value), lambda text: F.when(~F.upper(text).isin(*P.UNKNOWN_WORDS), text))


# Decimal text whose value cannot overflow, and decimal text of any size.
NUMBER = r"^\s*[+-]?(\d{1,200}\.?\d*|\.\d+)([eE][+-]?\d{1,2})?\s*$"
LONG_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def parse_float(value: Column | str) -> Column:
    """Finite double or NULL. Text is checked before the cast: a failing cast costs an exception per row."""
    text = col(value).cast("string")
    long = F.when(text.rlike(LONG_NUMBER), text).try_cast("double")
    return F.coalesce(F.when(text.rlike(NUMBER), text).try_cast("double"), F.when(F.abs(long) < float("inf"), long))


def is_nonempty(value: Column | str) -> Column:
    return present(value).isNotNull()


def inactive_or_test(active: Column | str, *texts: Column | str) -> Column:
    """True for rows switched off or marked as examples."""
    off = F.coalesce(F.lower(present(active)).isin(*P.FALSE_WORDS), F.lit(False))
    hay = F.lower(F.concat_ws(" ", *[col(t) for t in texts]))
    return off | hay.rlike("|".join(P.TEST_WORDS))


def provider_label(*texts: Column | str) -> Column:
    """Provider id from free source text."""
    hay = F.lower(F.concat_ws(" ", *[col(t) for t in texts]))
    return (
        F.when(hay.contains("aisstream"), "aisstream")
        .when(hay.contains("fintraffic"), "fintraffic")
        .when(hay.contains("barentswatch") | hay.contains("norwegian coastal"), "barentswatch")
        .when(hay.contains("ais_dk") | hay.contains("danish"), "ais_dk_historical")
        .when(hay.contains("global_fishing_watch") | hay.contains("global fishing watch")
              | hay.rlike(r"\bgfw\b"), "global_fishing_watch")
        .otherwise("unknown")
    )


def first_nonempty(*values: Column | str) -> Column:
    return F.coalesce(*[present(v) for v in values])


def scene_id(value: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.upper(present(value)), r"\.SAFE$", ""), "_COG$", "")


def prune_properties(props: Column | str, hints=P.PROPERTY_HINTS, max_properties: int | None = None,
                     max_chars: int | None = None) -> Column:
    """Best-matching properties of a MAP<STRING,STRING>: exact hint, then containing one.

    Ties go to the shorter key, then alphabetical order. Both limits are off unless given.
    """
    words = F.array(*[F.lit(h) for h in hints])

    def cut(value: Column) -> Column:
        return value if max_chars is None else F.substring(value, 1, max_chars)

    def score(key: Column) -> Column:
        low = F.lower(key)
        return (F.when(F.array_contains(words, low), 2)
                .when(F.exists(words, lambda h: low.contains(h)), 1).otherwise(0))

    def scored(entry: Column) -> Column:
        return F.struct((-score(entry["key"])).alias("rank"), F.length(entry["key"]).alias("n"),
                        F.lower(entry["key"]).alias("low"), entry["key"].alias("key"),
                        cut(F.trim(entry["value"])).alias("value"))

    entries = F.transform(F.map_entries(col(props)), scored)
    kept = F.filter(entries, lambda e: (e["rank"] < 0) & ~e["key"].startswith("_")
                    & F.coalesce(e["value"] != "", F.lit(False)))
    best = F.array_sort(kept) if max_properties is None else F.slice(F.array_sort(kept), 1, max_properties)
    return F.map_from_entries(F.transform(best, lambda e: F.struct(e["key"], e["value"])))


def feature_name(props: Column | str, fallback: Column | str) -> Column:
    values = [present(col(props)[key]) for key in P.NAME_KEYS]
    return F.coalesce(*values, col(fallback))
