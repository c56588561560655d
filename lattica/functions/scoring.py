"""Scoring functions: built-in expressions, no UDF."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import NOT_AFTER_WORD, NOT_BEFORE_WORD, WS_CLASS, _col, strip


def _found(x: Column, pattern: str) -> Column:
    """The first group of the first match, upper case; NULL without one."""
    return F.nullif(F.upper(F.regexp_extract(x, pattern, 1)), F.lit(""))


def choice_letter(prediction: Column | str) -> Column:
    """The letter A to D that a free-text prediction chooses, or NULL.

    In this order: the whole text is a letter in any case; "answer is X" or "answer: X" in any case;
    "**X"; "(X." at the start; the first capital that stands alone.
    """
    x = strip(prediction)
    s = f"[{WS_CLASS}]"
    return F.coalesce(
        F.when(F.upper(x).isin("A", "B", "C", "D"), F.upper(x)),
        _found(x, rf"(?i)answer{s}*(?:is|:){s}*([A-D]){NOT_BEFORE_WORD}"),
        _found(x, rf"\*\*([A-D]){NOT_BEFORE_WORD}"),
        _found(x, rf"^[({WS_CLASS}]*([A-D])[.):{WS_CLASS}]"),
        _found(x, rf"{NOT_AFTER_WORD}([A-D]){NOT_BEFORE_WORD}"),
    )


def choice_letter_ten(prediction: Column | str) -> Column:
    """The letter A to J that a prediction chooses, or NULL.

    The whole text is a capital; "answer is (X" in any case, whatever follows; the last capital that stands alone.
    """
    x = strip(prediction)
    s = f"[{WS_CLASS}]"
    alone = F.regexp_extract_all(x, F.lit(rf"{NOT_AFTER_WORD}([A-J]){NOT_BEFORE_WORD}"), 1)
    return F.coalesce(F.when(x.rlike("^[A-J]$"), x), _found(x, rf"(?i)answer is{s}*\(?([A-J])"), F.try_element_at(alone, F.lit(-1)))


def choice_score(prediction: Column | str, gold: Column | str) -> Column:
    """1 or 0 by exact comparison of the chosen letter; NULL (the row is to be dropped) without a letter. NULL gold scores 0."""
    letter = choice_letter(prediction)
    return F.when(letter.isNotNull(), F.coalesce((letter == _col(gold)).cast("double"), F.lit(0.0)))


def choice_score_ten(prediction: Column | str, gold: Column | str) -> Column:
    """1 or 0; without a letter 0. The gold letter is stripped and upper-cased."""
    return F.coalesce((choice_letter_ten(prediction) == F.upper(strip(gold))).cast("double"), F.lit(0.0))


def free_score(prediction: Column | str, gold: Column | str, answer_type: Column | str | None = None) -> Column:
    """Multiple choice as choice_score; else the prediction's first number against the gold number within 1e-6, with no way back
    if both are numbers; else whether the gold text occurs in the prediction (an empty one does)."""
    p, g = F.lower(strip(prediction)), F.lower(strip(gold))
    number = F.regexp_extract(p, r"([-+]?\d*\.?\d+)", 1).try_cast("double")
    wanted = g.try_cast("double")
    close = F.when(F.isnan(wanted), 0.0).otherwise((F.abs(number - wanted) < 1e-6).cast("double"))
    text = F.coalesce(p.contains(g).cast("double"), F.lit(0.0))
    free = F.when(number.isNotNull() & wanted.isNotNull(), close).otherwise(text)
    return free if answer_type is None else F.when(_col(answer_type) == "multi_choice", choice_score(prediction, gold)).otherwise(free)


def judge_score(score: Column | str, judgment: Column | str) -> Column:
    """The score, or where it is NULL or the mark -1 the number in "[[n]]" of the judgment; NULL (drop the row) if that fails too."""
    tagged = F.nullif(F.regexp_extract(F.coalesce(_col(judgment), F.lit("")), r"\[\[(\d+(?:\.\d+)?)\]\]", 1), F.lit(""))
    return F.coalesce(F.nullif(_col(score), F.lit(-1.0)), tagged.try_cast("double"))


def present_or(record: Column | str, key: str, other: str) -> Column:
    """record[key] if the map has the key, even with a NULL; else record[other]."""
    m = _col(record)
    return F.when(F.map_contains_key(m, key), F.try_element_at(m, F.lit(key))).otherwise(F.try_element_at(m, F.lit(other)))


def with_either(df: DataFrame, record: str, keys: tuple[str, str], name: str) -> DataFrame:
    """Rows whose map has one of the keys, with its value (the first key's if it is there); records with neither are skipped."""
    m = F.col(record)
    return df.where(F.map_contains_key(m, keys[0]) | F.map_contains_key(m, keys[1])).withColumn(name, present_or(record, *keys))


def fraction(x: Column | str) -> Column:
    """"k/N" as a number, "X" as 0; NULL for a zero N and for anything else."""
    x = strip(x)
    parts = F.split(x, "/")
    return F.when(x == "X", 0.0).otherwise(F.try_divide(F.try_element_at(parts, F.lit(1)).try_cast("double"), F.try_element_at(parts, F.lit(2)).try_cast("double")))


def from_percent(x: Column | str) -> Column:
    """Above 1 it is a percentage."""
    x = _col(x)
    return F.when(x > 1, x / 100).otherwise(x)


def number(x: Column | str) -> Column:
    """A number, NULL if it is none; True and False are 1 and 0."""
    x = strip(_col(x).cast("string"))
    return F.when(x == "True", 1.0).when(x == "False", 0.0).otherwise(F.nanvl(x.try_cast("double"), F.lit(None)))


def whole(x: Column | str) -> Column:
    """A number cut to an integer, toward zero."""
    return number(x).try_cast("int")


def rating(x: Column | str) -> Column:
    """A rating from 1 to 5, else NULL."""
    n = number(x)
    return F.when(n.between(1, 5), n)


def clip(x: Column | str) -> Column:
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), _col(x)))


def share(points: Column | str, most: Column | str) -> Column:
    """points / most within 0 and 1; NULL (skip the criterion) without points or with a maximum that is 0 or missing."""
    p, m = F.nanvl(_col(points), F.lit(None)), F.nanvl(_col(most), F.lit(None))
    return F.when((m != 0) & p.isNotNull(), clip(p / m))


def yes(x: Column | str) -> Column:
    """1 for yes, 0 for anything else."""
    return F.coalesce((F.lower(strip(x)) == "yes").cast("double"), F.lit(0.0))
