"""Sources that need Python: archives, spreadsheets, Python source. Each file is one row to a batch function; nothing is collected."""

from __future__ import annotations

import ast
import io
import json
import re
import zipfile
import zlib
from collections.abc import Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _binary(spark: SparkSession, path: str, glob: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path).select("path", "content")


def zipped_json(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, record (JSON text) of the array in each archive's first .json member outside __MACOSX; others are skipped."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        members = [n for n in z.namelist() if n.endswith(".json") and not n.startswith("__MACOSX")]
                        data = json.loads(z.read(members[0])) if members else None
                except (zipfile.BadZipFile, ValueError, KeyError, zlib.error, NotImplementedError, RuntimeError):
                    continue
                records = [json.dumps(x, ensure_ascii=False) for x in data if isinstance(x, dict)] if isinstance(data, list) else []
                for s in range(0, len(records), 10_000):
                    part = records[s : s + 10_000]
                    yield pd.DataFrame({"file": name, "pos": range(s, s + len(part)), "record": part})

    return _binary(spark, path, "*.zip").mapInPandas(read, "file string, pos int, record string")


_NS = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"


def sheet_rows(content: bytes) -> Iterator[list[str | None]]:
    """The cells of a workbook's first sheet as text, row by row. Only the standard library: XLSX is zipped XML."""
    with zipfile.ZipFile(io.BytesIO(content)) as z:
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            for s in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iter(f"{_NS}si"):
                shared.append("".join(t.text or "" for t in s.iter(f"{_NS}t")))
        sheets = sorted((n for n in z.namelist() if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)), key=lambda n: int(re.sub(r"\D", "", n)))
        for row in ElementTree.fromstring(z.read(sheets[0])).iter(f"{_NS}row"):
            cells: dict[int, str | None] = {}
            for at, c in enumerate(row.iter(f"{_NS}c")):
                letters = re.sub(r"\d", "", c.get("r", ""))
                place = sum((ord(x) - 64) * 26**i for i, x in enumerate(reversed(letters))) - 1 if letters else at
                v = c.find(f"{_NS}v")
                kind = c.get("t")
                if kind == "inlineStr":
                    cells[place] = "".join(t.text or "" for t in c.iter(f"{_NS}t"))
                elif v is None or v.text is None:
                    cells[place] = None
                elif kind == "s":
                    cells[place] = shared[int(v.text)]
                elif kind == "b":
                    cells[place] = "True" if v.text == "1" else "False"
                else:
                    cells[place] = v.text
            yield [cells.get(i) for i in range(max(cells, default=-1) + 1)]


def xlsx(spark: SparkSession, path: str) -> DataFrame:
    """file, pos, cells (map from header to text) of each workbook's first sheet; the first row is the header."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for files in batches:
            for name, content in zip(files["path"], files["content"], strict=True):
                rows = sheet_rows(content)
                header = next(rows, [])
                out = [{h: v for h, v in zip(header, row, strict=False) if h} for row in rows]
                yield pd.DataFrame({"file": name, "pos": range(len(out)), "cells": out})

    return _binary(spark, path, "*.xlsx").mapInPandas(read, "file string, pos int, cells map<string,string>")


class TaskFile:
    """The texts that a Python file's task classes assign: constants, concatenations and f-strings of known constants."""

    KINDS = {"UserTask": ("user_task", "PROMPT"), "InjectionTask": ("injection_task", "GOAL")}

    def __init__(self, source: str):
        self.found: dict[tuple[str, str], str] = {}
        try:
            tree = ast.parse(source)
        except (SyntaxError, ValueError):
            return
        outer = self.constants(tree.body)
        for node in tree.body:
            if isinstance(node, ast.ClassDef) and (m := re.match(r"(UserTask|InjectionTask)(\d+)", node.name)):
                kind, field = self.KINDS[m[1]]
                names = outer | self.constants(node.body)
                for target, value in self.assignments(node.body):
                    text = self.text(value, names) if target in (field, "GROUND_TRUTH_OUTPUT") else None
                    if text and target == field:
                        self.found[kind, f"{kind}_{m[2]}"] = text
                    elif text and kind == "user_task":
                        self.found["ground_truth", f"{kind}_{m[2]}"] = text
        for node in ast.walk(tree):
            if isinstance(node, ast.Call) and isinstance(node.func, ast.Attribute) and node.func.attr == "create_combined_task":
                self.combined(node, outer)

    @staticmethod
    def assignments(body: list[ast.stmt]) -> Iterator[tuple[str, ast.expr]]:
        for x in body:
            if isinstance(x, ast.Assign) and len(x.targets) == 1 and isinstance(x.targets[0], ast.Name):
                yield x.targets[0].id, x.value
            elif isinstance(x, ast.AnnAssign) and isinstance(x.target, ast.Name) and x.value is not None:
                yield x.target.id, x.value

    def constants(self, body: list[ast.stmt]) -> dict[str, str]:
        return {n: v.value for n, v in self.assignments(body) if isinstance(v, ast.Constant) and isinstance(v.value, str)}

    def text(self, node: ast.expr, names: dict[str, str]) -> str | None:
        match node:
            case ast.Constant(value=str(s)):
                return s
            case ast.Name(id=n):
                return names.get(n)
            case ast.BinOp(left=a, op=ast.Add(), right=b):
                x, y = self.text(a, names), self.text(b, names)
                return None if x is None or y is None else x + y
            case ast.JoinedStr(values=parts):
                return "".join(self.placeholder(p, names) for p in parts)
        return None

    def placeholder(self, part: ast.expr, names: dict[str, str]) -> str:
        if isinstance(part, ast.FormattedValue):
            known = self.text(part.value, names)
            return known if known is not None else "{" + ast.unparse(part.value) + "}"
        return part.value if isinstance(part, ast.Constant) else ""

    def combined(self, call: ast.Call, names: dict[str, str]) -> None:
        """A task made of others: its own prompt if given, else those of the tasks it refers to, joined by blanks."""
        name = call.args[0].value if call.args and isinstance(call.args[0], ast.Constant) else None
        m = re.match(r"UserTask(\d+)", name) if isinstance(name, str) else None
        if not m or ("user_task", f"user_task_{m[1]}") in self.found:
            return
        own = next((t for k in call.keywords if k.arg == "prompt" and (t := self.text(k.value, names))), None)
        keys = [a.slice.value for a in call.args[1:] if isinstance(a, ast.Subscript) and isinstance(a.slice, ast.Constant)]
        parts = [self.found["user_task", k] for k in keys if ("user_task", k) in self.found]
        if own or parts:
            self.found["user_task", f"user_task_{m[1]}"] = own or " ".join(parts)


@F.udtf(returnType=T.StructType([T.StructField(c, T.StringType()) for c in ("kind", "task", "text")]))
class _Tasks:
    def eval(self, source: str):
        for (kind, task), text in TaskFile(source).found.items():
            yield kind, task, text


def task_prompts(spark: SparkSession, root: str) -> DataFrame:
    """kind, suite, task, text from root/vN/suite/*_tasks.py; a later version's text replaces an earlier one's."""
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*_tasks.py").text(root, wholetext=True)
    parts = F.split(F.col("_metadata.file_path"), "/")
    rows = files.select(F.element_at(parts, -3).alias("version"), F.element_at(parts, -2).alias("suite"), "value")
    rows.createOrReplaceTempView("_lattica_task_files")
    spark.udtf.register("_lattica_tasks", _Tasks)
    found = spark.sql("SELECT f.version, f.suite, t.kind, t.task, t.text FROM _lattica_task_files f, LATERAL _lattica_tasks(f.value) t")
    return found.groupBy("kind", "suite", "task").agg(F.max_by("text", "version").alias("text"))
