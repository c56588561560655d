"""Text functions: Unicode strip, NFC, identifiers, truncation, name cleaning. All built-in expressions but NFC."""

from __future__ import annotations

import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The code points that count as white space.
SPACE_POINTS = (*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
WS = "".join(map(chr, SPACE_POINTS))
#: The same as a regular-expression class body.
WS_CLASS = "".join(f"\\x{{{c:x}}}" for c in SPACE_POINTS)
#: A place with no letter, digit or underscore before it, and one with none after it.
NOT_AFTER_WORD, NOT_BEFORE_WORD = r"(?<![\p{L}\p{N}_])", r"(?![\p{L}\p{N}_])"
CUT_MARK = "\n...[truncated]"


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


@F.pandas_udf(T.StringType())
def _nfc(x: pd.Series) -> pd.Series:
    return x.map(lambda s: None if s is None else unicodedata.normalize("NFC", s))


def nfc(x: Column | str) -> Column:
    """NFC. Spark has no such function, so each row passes a Python worker; of pure ASCII, which is NFC already, only a NULL does. Give it distinct values where many rows share few."""
    x = _col(x)
    return F.coalesce(_nfc(F.when(F.octet_length(x) > F.char_length(x), x)), x)


def strip(x: Column | str) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.trim(_col(x), F.lit(WS))


def blank_to_null(x: Column | str) -> Column:
    return F.nullif(strip(x), F.lit(""))


def hash16(x: Column | str) -> Column:
    """The first 16 hexadecimal digits of SHA-256 of the UTF-8 text."""
    return F.substring(F.sha2(_col(x), 256), 1, 16)


def label_form(x: Column | str) -> Column:
    return F.lower(strip(nfc(x)))


def content_form(x: Column | str) -> Column:
    return strip(nfc(x))


def subject_id(label: Column | str) -> Column:
    return hash16(label_form(label))


def item_surrogate(content: Column | str, raw_id: Column | str | None) -> Column:
    """What identifies an item: its content, or its raw id where there is none. Empty content is content."""
    if raw_id is None:
        return _col(content)
    return F.coalesce(_col(content), F.concat(F.lit("raw:"), _col(raw_id).cast("string")))


def item_id(benchmark: Column | str, content: Column | str, raw_id: Column | str | None = None) -> Column:
    return hash16(F.concat(benchmark if isinstance(benchmark, Column) else F.lit(benchmark), F.lit("::"), content_form(item_surrogate(content, raw_id))))


def content_hash(content: Column | str, raw_id: Column | str | None = None) -> Column:
    return hash16(content_form(item_surrogate(content, raw_id)))


def cut(x: Column | str, n: int) -> Column:
    """The first n characters."""
    return F.substring(_col(x), 1, n)


def cut_marked(x: Column | str, n: int) -> Column:
    """At most n characters, the last of them saying so where some were cut; empty is NULL."""
    x = _col(x)
    return F.when(F.char_length(x) <= n, F.nullif(x, F.lit(""))).otherwise(F.concat(F.substring(x, 1, n - len(CUT_MARK)), F.lit(CUT_MARK)))


def strip_cut(x: Column | str, n: int) -> Column:
    """Stripped, NULL if nothing is left, cut to n characters."""
    return F.substring(blank_to_null(x), 1, n)


def key_form(x: Column | str) -> Column:
    """Stripped, lower case, dashes and blanks as underscores."""
    return F.translate(F.lower(strip(x)), "- ", "__")


def plain_slug(x: Column | str) -> Column:
    """Lower case without white space, dashes and quotes."""
    return F.lower(F.regexp_replace(_col(x), f"[{WS_CLASS}\\-'\"]", ""))


def bare_slug(x: Column | str, numbered: bool = True) -> Column:
    """Lower-case letters and digits only; with numbered, a leading "[...]" tag and then a leading "NN-" or "NN_" go first."""
    x = _col(x)
    if numbered:
        x = F.regexp_replace(F.regexp_replace(x, rf"^\[.*?\][{WS_CLASS}]*(?=.)", ""), r"^\d+[-_]", "")
    return F.regexp_replace(F.lower(x), "[^a-z0-9]", "")


def archive_model_name(name: Column | str) -> Column:
    """The model in the name of a result archive: known prefixes and suffixes go, one after the other."""
    x = _col(name)
    # The affixes of result archives, in the order in which they are removed.
    affixes = (r"^model_outputs_", r"_\d+shots\.json\.zip$", r"_\d+shots\.zip$", r"_\d+-shots\.zip$", r"_\d+shots_\d+_\d+_\d+\.zip$", r"\.zip$", r"\.json$")
    for a in affixes:
        x = F.regexp_replace(x, a, "")
    return x


def split_suffix(name: Column | str, suffixes: tuple[str, ...]) -> tuple[Column, Column]:
    """Base and suffix of "base-suffix" where the suffix is a known one; else the whole name and NULL."""
    x, pattern = _col(name), rf"^(.*)-({'|'.join(suffixes)})$"
    return F.coalesce(F.nullif(F.regexp_extract(x, pattern, 1), F.lit("")), x), F.nullif(F.regexp_extract(x, pattern, 2), F.lit(""))


def suffix_label(name: Column | str, suffixes: tuple[str, ...]) -> Column:
    base, suffix = split_suffix(name, suffixes)
    return F.when(suffix.isNull(), base).otherwise(F.concat(base, F.lit(" ("), suffix, F.lit(")")))


# What result file names say about dataset and prompt; the first dataset with a mark in the name counts.
DATASET_MARKS = (
    ("afrimedqa-v2.5", ("afrimed-qa-v2.5", "afrimed-qa-v2-5")),
    ("afrimedqa-v2", ("afrimed-qa-v2",)),
    ("afrimedqa-v1", ("afrimed-qa-v1", "afrimed-qa_")),
    ("medqa", ("medqa",)),
)
INSTRUCT_MARKS = ("instruct-prompt", "instruct_prompt", "instruct_0shot")


def result_file_class(name: Column | str) -> Column:
    """dataset, prompt and shots of a result file by its name; NULL for files that are no multiple-choice CSV."""
    low = F.lower(_col(name))
    any_of = lambda marks: reduce(Column.__or__, [low.contains(m) for m in marks])
    dataset = F.coalesce(*[F.when(any_of(marks), label) for label, marks in DATASET_MARKS], F.lit("unknown"))
    prompt = F.when(any_of(INSTRUCT_MARKS), "instruct").otherwise("base")
    shots = F.coalesce(F.nullif(F.regexp_extract(low, r"(\d+)[_-]?shot", 1), F.lit("")).cast("int"), F.lit(0))
    return F.when(low.endswith(".csv") & low.contains("mcq"), F.struct(dataset.alias("dataset"), prompt.alias("prompt"), shots.alias("shots")))


def paper_month(url: Column | str) -> Column:
    """YYYY-MM of a preprint address with a YYMM.NNNNN number."""
    x, pattern = _col(url), r"(\d{2})(\d{2})\.\d{4,5}"
    return F.when(F.regexp_extract(x, pattern, 1) != "", F.concat(F.lit("20"), F.regexp_extract(x, pattern, 1), F.lit("-"), F.regexp_extract(x, pattern, 2)))


def renamed(x: Column | str, names: dict[str, str]) -> Column:
    """The name's replacement, or itself."""
    x = _col(x)
    if not names:
        return x
    table = F.create_map(*[F.lit(v) for kv in names.items() for v in kv])
    return F.coalesce(F.try_element_at(table, x), x)
