"""Symbols of source files as a table function that SQL can call."""

from __future__ import annotations

import ast
import re

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf
from pyspark.sql.types import IntegerType, StringType, StructType
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult

#: What a line of a file that does not parse can declare, by its first words.
LINES = [
    ("class", re.compile(r"\s*class\s+(\w+)")), ("function", re.compile(r"\s*(?:async\s+)?def\s+(\w+)")),
    ("import", re.compile(r"\s*from\s+([\w.]+)\s+import\b")), ("import", re.compile(r"\s*import\s+([\w.]+)")),
]
DECORATOR = re.compile(r"\s*@([\w.]+)")


def parsed(text: str) -> list[tuple[str, str, int, str]]:
    """(kind, name, line, decorators) of a file that parses."""
    out = []
    for node in ast.walk(ast.parse(text)):
        if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef, ast.ClassDef)):
            kind = "class" if isinstance(node, ast.ClassDef) else "function"
            marks = [ast.unparse(d.func if isinstance(d, ast.Call) else d) for d in node.decorator_list]
            out.append((kind, node.name, node.lineno, ",".join(marks)))
        elif isinstance(node, ast.Import):
            out += [("import", a.name, node.lineno, "") for a in node.names]
        elif isinstance(node, ast.ImportFrom):
            out.append(("import", node.module or "", node.lineno, ""))
    return out


def scanned(text: str) -> list[tuple[str, str, int, str]]:
    """The same of a file that does not, line by line: what its lines begin with, whatever is broken elsewhere."""
    out, marks = [], []
    for number, line in enumerate(text.split("\n"), 1):
        if m := DECORATOR.match(line):
            marks.append(m[1])
            continue
        for kind, pattern in LINES:
            if m := pattern.match(line):
                out.append((kind, m[1], number, "" if kind == "import" else ",".join(marks)))
                break
        if line.strip():
            marks = []
    return out


class Symbols:
    """``symbols(TABLE(files), 'content')``: all other columns of each row of the table, then kind, name, line, decorators and
    whether the file parsed, for every symbol of the named column."""

    @staticmethod
    def analyze(files: AnalyzeArgument, column: AnalyzeArgument) -> AnalyzeResult:
        if not files.isTable:
            raise ValueError("the first argument is a table")
        if column.value not in files.dataType.names:
            raise ValueError(f"no column {column.value}")
        schema = StructType([f for f in files.dataType if f.name != column.value])
        for name, kind in (("kind", StringType()), ("name", StringType()), ("line", IntegerType()), ("decorators", StringType()), ("parsed", StringType())):
            schema = schema.add(name, kind)
        return AnalyzeResult(schema=schema)

    def eval(self, row, column):
        text = row[column]
        if text is None:
            return
        try:
            found, how = parsed(text), "yes"
        except (SyntaxError, ValueError, RecursionError):
            found, how = scanned(text), "no"
        kept = [row[c] for c in row.__fields__ if c != column]
        for symbol in found:
            yield (*kept, *symbol, how)


def register(spark: SparkSession) -> None:
    spark.udtf.register("symbols", udtf(Symbols))
