"""Building item content, conditions and message texts from columns."""

from __future__ import annotations

import json
from collections.abc import Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .text import _col, blank_to_null, cut, strip


def first_text(*columns: Column | str) -> Column:
    """The first column with text in it; blank counts as missing."""
    return F.coalesce(*map(blank_to_null, columns))


def choice_content(question: Column | str, options: dict[str, Column | str], limit: int = 4000) -> Column:
    """Question, blank line, "A: ..." lines; missing options are left out, a missing question gives NULL."""
    lines = F.concat_ws("\n", *[F.concat(F.lit(f"{k}: "), _col(v).cast("string")) for k, v in options.items()])
    return F.when(_col(question).isNotNull(), cut(F.concat_ws("\n\n", strip(question), F.nullif(lines, F.lit(""))), limit))


def listed_content(question: Column | str, options: Column | str, most: int = 10, mark: str = ": ", limit: int | None = None) -> Column:
    """Question, blank line and the first options of an array as lettered lines; only the question without options."""
    o = F.slice(_col(options), 1, most)
    lines = F.array_join(F.transform(o, lambda x, i: F.concat(F.char(i + 65), F.lit(mark), F.coalesce(x, F.lit("")))), "\n")
    out = F.when(F.size(o) > 0, F.concat(F.coalesce(_col(question), F.lit("")), F.lit("\n\n"), lines)).otherwise(F.nullif(_col(question), F.lit("")))
    return out if limit is None else cut(out, limit)


def tagged_pair(first: Column | str, second: Column | str, tags: tuple[str, str] = ("user_task", "injection_task")) -> Column:
    """"[tag] text" lines of what is there; NULL without either."""
    parts = [F.concat(F.lit(f"[{t}] "), F.nullif(_col(x), F.lit(""))) for t, x in zip(tags, (first, second), strict=True)]
    return F.nullif(F.concat_ws("\n", *parts), F.lit(""))


def _written(messages: Column, role: str | None = None) -> Column:
    full = lambda m: m["content"].isNotNull() & (strip(m["content"]) != "")
    return F.filter(messages, full if role is None else lambda m: (m["role"] == role) & full(m))


def user_prompt(messages: Column | str) -> Column:
    """The first user message with text, else the first message with text."""
    m = _col(messages)
    return F.coalesce(F.get(_written(m, "user"), F.lit(0))["content"], F.get(_written(m), F.lit(0))["content"])


def assistant_reply(messages: Column | str) -> Column:
    """The first assistant message with text, else the last message with text."""
    m = _col(messages)
    return F.coalesce(F.get(_written(m, "assistant"), F.lit(0))["content"], F.try_element_at(_written(m), F.lit(-1))["content"])


def prompt_of(raw: Column | str) -> Column:
    """The prompt in JSON text or plain text: that of a list of messages by user_prompt, a text stripped; NULL if blank."""
    raw = _col(raw)
    listed = F.from_json(raw, "array<struct<role:string,content:string>>")
    return F.when(strip(raw).startswith("["), user_prompt(listed)).otherwise(blank_to_null(raw))


def condition(parts: dict[str, Column | str], sep: str = "|") -> Column:
    """"k=v|k=v"; NULL if a value is NULL."""
    out = [F.concat(F.lit(f"{k}="), _col(v).cast("string")) for k, v in parts.items()]
    return F.concat(*[x for i, p in enumerate(out) for x in ([F.lit(sep), p] if i else [p])])


def condition_map(text: Column | str, separators: str = "|;") -> Column:
    return F.str_to_map(_col(text), F.lit(f"[{separators}]"), F.lit("="))


def titled(title: Column | str, body: Column | str, least: int = 10, limit: int | None = None) -> Column:
    """Title, line end and body, stripped; NULL if shorter than least."""
    x = strip(F.concat_ws("\n", F.nullif(_col(title), F.lit("")), F.nullif(_col(body), F.lit(""))))
    return F.when(F.char_length(x) >= least, x if limit is None else cut(x, limit))


def task_content(categories: Column | str, category: Column | str, difficulty: Column | str, prompt: Column | str, competition: Column | str, name: Column | str, known: Column) -> Column:
    """"[categories] difficulty=d | prompt" where the task's metadata are known, else "[category] competition: name"."""
    cats = F.coalesce(F.nullif(F.array_join(_col(categories), ", "), F.lit("")), _col(category))
    with_meta = F.concat(F.lit("["), cats, F.lit("] difficulty="), F.coalesce(_col(difficulty), F.lit("")), F.coalesce(F.concat(F.lit(" | "), cut(F.nullif(_col(prompt), F.lit("")), 1500)), F.lit("")))
    return F.when(known, with_meta).otherwise(F.concat(F.lit("["), _col(category), F.lit("] "), _col(competition), F.lit(": "), _col(name)))


def numbered_id(own: Column | str, source: Column | str, n: Column | str) -> Column:
    """The own id, or source_n where it is missing or empty."""
    return F.coalesce(F.nullif(_col(own), F.lit("")), F.concat(_col(source), F.lit("_"), _col(n).cast("string")))


def compact_json(x: Column | str) -> Column:
    """JSON without blanks, non-ASCII kept."""
    return F.to_json(_col(x))


def _flat(value) -> Iterable[str]:
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, list):
            todo += reversed(x)
        elif isinstance(x, dict):
            text, role = x.get("content"), x.get("role")
            if isinstance(text, str) and text.strip():
                yield f"[{role}] {text}" if role else text
        elif isinstance(x, str) and x.strip():
            yield x


@F.pandas_udf(T.StringType())
def nested_text(x: pd.Series) -> pd.Series:
    """JSON of arbitrarily nested lists of messages and texts as "[role] text" lines; NULL if there is none.

    The depth is open, which no built-in expression can follow.
    """

    def one(raw: str | None) -> str | None:
        if raw is None:
            return None
        try:
            value = json.loads(raw)
        except ValueError:
            return None
        if isinstance(value, str):
            return value.strip() or None
        return "\n".join(_flat(value))[:8000] or None

    return x.map(one)
