"""Named scopes of source code by bracket depth: which contract, function, module or block encloses a place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.code_patterns import (
    BLOCK_FUNCTION, CALL_RISKS, CONTRACT, CONTRACT_HEAD, CONTRACT_SCOPES, CTYPES, EXTERN_BLOCK, MANUAL_MEMORY, WASM_EACH, WASM_RISKS, WASM_SCOPES,
)
from auditloom.functions.catalogs import frame
from auditloom.functions.cells import spread
from auditloom.functions.text import line_of, matches, window
from auditloom.operators.boundaries import kinds_in


def scopes(files: DataFrame, heads: list[tuple[str, str]], brackets: str) -> DataFrame:
    """files: file_id, content -> file_id, kind, name, open, close, depth of every scope that a head (kind, pattern) names.

    A head's match holds the scope's opening bracket as its first (round ones) or last character (curly ones), its first group is the
    name. Openings and closings of one depth alternate along a file, so a scope ends at the next bracket of its depth: a running
    sum and one look ahead. Heads stand among the brackets, each behind its own one, so names take no join, which Spark would
    broadcast while texts are small files. A scope that never closes ends with the file (close null). Brackets in comments and
    strings count as brackets."""
    left, right = brackets
    none = F.lit(None).cast("string")
    events = files.select("file_id", F.explode(matches(F.col("content"), f"[\\{left}\\{right}]")).alias("b"))
    events = events.select("file_id", F.col("b.start").alias("at"), F.lit(0).alias("rank"), (F.col("b.text") == left).alias("opens"), none.alias("kind"), none.alias("name"))
    at = F.col("m.start") if left == "(" else F.col("m.end") - 1
    for kind, p in heads:
        named = files.select("file_id", F.explode(matches(F.col("content"), p)).alias("m"))
        events = events.unionByName(named.select("file_id", at.alias("at"), F.lit(1).alias("rank"), F.lit(None).cast("boolean").alias("opens"), F.lit(kind).alias("kind"), F.regexp_extract("m.text", p, 1).alias("name")))
    along = Window.partitionBy("file_id").orderBy("at", "rank")
    depth = F.sum(F.when(F.col("opens"), 1).when(~F.col("opens"), -1).otherwise(0)).over(along)
    leveled = events.withColumn("depth", depth + F.when(~F.col("opens"), 1).otherwise(0))  # of what the bracket opens or closes
    level = Window.partitionBy("file_id", "depth").orderBy("at", "rank")
    own = F.last(F.when(F.col("opens"), F.col("at")), ignorenulls=True).over(level)
    bracket = leveled.withColumn("bracket", F.when(F.col("rank") == 0, F.col("at"))).withColumn("own", own)
    close = F.expr("lead(bracket) IGNORE NULLS OVER (PARTITION BY file_id, depth ORDER BY at, rank)")
    return bracket.withColumn("close", close).filter("rank = 1 AND own = at").select("file_id", "kind", "name", F.col("at").alias("open"), "close", "depth")


def innermost(places: DataFrame, found: DataFrame, kinds: list[str]) -> DataFrame:
    """places (file_id, start, ...) with a column for each kind: the name of the innermost scope of the kind that holds the
    place, null if none does.

    Scopes of a kind nest. Along a file each opening raises the level by one and each closing lowers it, so the scope in
    question is the last one opened at the place's own level: sorted windows a file, however many scopes and places meet."""
    for kind in kinds:
        mine = found.filter(F.col("kind") == kind)
        none = F.lit(None).cast(places.select(F.struct("*")).schema[0].dataType)
        events = places.select("file_id", F.col("start").alias("at"), F.lit(0).alias("step"), F.lit(None).cast("string").alias("name"), F.struct("*").alias("row"))
        events = events.unionByName(mine.select("file_id", F.col("open").alias("at"), F.lit(1).alias("step"), "name", none.alias("row")))
        events = events.unionByName(mine.filter("close is not null").select("file_id", F.col("close").alias("at"), F.lit(-1).alias("step"), F.lit(None).cast("string").alias("name"), none.alias("row")))
        along = Window.partitionBy("file_id").orderBy("at", "step")
        leveled = events.withColumn("level", F.sum("step").over(along) + F.when(F.col("step") < 0, 1).otherwise(0))
        last = F.last("name", ignorenulls=True).over(Window.partitionBy("file_id", "level").orderBy("at", "step"))
        places = leveled.withColumn("name", F.when(F.col("level") > 0, last)).filter("row is not null").select("row.*", F.col("name").alias(kind))
    return places


def _hits(files: DataFrame, lang: str, rules: list[tuple[str, str]]) -> DataFrame:
    """file_id, content, kind, start, end of every match of every rule."""
    catalog = frame(files.sparkSession, "kind string, pattern string", rules)
    found = files.filter(F.col("lang") == lang).select("file_id", "content").join(F.broadcast(catalog), F.lit(True))
    return found.select("file_id", "content", "kind", F.explode(matches(F.col("content"), F.col("pattern"))).alias("m")).select("file_id", "content", "kind", F.col("m.start").alias("start"), F.col("m.end").alias("end"))


def _first(text: Column, pattern: str, group: int = 1) -> Column:
    """What the first match has, null if there is none."""
    return F.when(text.rlike(pattern), F.regexp_extract(text, pattern, group))


def contract_calls(files: DataFrame) -> DataFrame:
    """A row a native call of a contract: the file's contract and the first function head within 200 characters before, as one
    reads it without brackets; the contract and function that enclose it by brackets; value, gas and target nearby; risks.

    Texts are dealt by file once, evenly; what follows stays within a file."""
    files = spread(files.filter("lang = 'solidity'").select("file_id", "lang", "content"), "file_id")
    hit = _hits(files, "solidity", list(CONTRACT["solidity"].items()))
    text, start, end = F.col("content"), F.col("start"), F.col("end")
    contract = F.coalesce(*[_first(text, p) for p in CONTRACT_HEAD], F.lit("Unknown"))
    low = F.greatest(F.lit(0), start - 200)
    before = text.substr(low + 1, start - low)
    near = window(text, start, end, 300)
    own = (
        F.when(F.col("kind") == "delegatecall", F.array_compact(F.array(F.when(~near.contains("onlyOwner") & ~near.contains("require"), "access_control"), F.when(~F.lower(near).contains("update"), "reentrancy"))))
        .when(F.col("kind") == "extcode", F.array_compact(F.array(F.when(near.contains("extcodesize") & ~F.substring(F.split_part(near, F.lit("extcodesize"), F.lit(2)), 1, 10).contains("0"), "extcode_size"))))
        .when(F.col("kind").isin("staticcall", "callcode"), F.array_compact(F.array(F.when(~near.contains("require"), "unchecked_return"))))
        .otherwise(F.array().cast("array<string>"))
    )
    out = hit.select(
        "file_id", "kind", "start", line_of(text, start).alias("line"), contract.alias("contract"), F.coalesce(_first(before, r"function\s+(\w+)"), F.lit("unknown")).alias("function"),
        window(text, start, end, 100).rlike(r"\.value\s*\(|msg\.value").alias("value_transfer"),
        F.coalesce(_first(window(text, start, end, 50), r"gas:\s*(\d+)").try_cast("long"), F.lit(0)).alias("gas"),
        F.coalesce(_first(text.substr(start + 1, end - start + 200), r"address\s*\(\s*([^)]+)\s*\)"), F.lit("unknown")).alias("target"),
        F.array_distinct(F.concat(own, kinds_in(near, CALL_RISKS))).alias("risks"),
    )
    held = scopes(files, CONTRACT_SCOPES, "{}")
    return innermost(out, held, ["in_contract", "in_function"])


def contract_statistics(calls: DataFrame) -> DataFrame:
    """By contract and in all ('*'): calls, those with two risks or more, value transfers, mean gas in whole numbers."""
    sums = calls.groupingSets([[F.col("contract")], []], "contract").agg(F.count("*").alias("n"), F.count_if(F.size("risks") >= 2).alias("high"), F.count_if("value_transfer").alias("transfers"), F.expr("sum(gas) div count(*)").alias("mean_gas"))
    return sums.select(F.coalesce("contract", F.lit("*")).alias("contract"), "n", "high", "transfers", "mean_gas").filter("n > 0")


def abi_lines(files: DataFrame) -> DataFrame:
    """file_id, line, signature: lines of contracts that begin with ``function`` or ``external``."""
    lines = files.filter("lang = 'solidity'").select("file_id", F.posexplode(F.split("content", "\n", -1)).alias("at", "raw"))
    signature = F.regexp_replace("raw", r"^\s+|\s+$", "")
    return lines.select("file_id", (F.col("at") + 1).alias("line"), signature.alias("signature")).filter("startswith(signature, 'function ') OR startswith(signature, 'external ')")


def wasm_boundaries(files: DataFrame) -> DataFrame:
    """A row a boundary of a module in text form and pattern: module, function head within 50 characters before, enclosing function
    by brackets, memory offset, table index, host name, risks.

    Texts are dealt by file once, evenly; what follows stays within a file."""
    files = spread(files.filter("lang = 'wasm'").select("file_id", "lang", "content"), "file_id")
    hit = _hits(files, "wasm", WASM_EACH)
    text, start, end = F.col("content"), F.col("start"), F.col("end")
    after = text.substr(start + 1, end - start + 100)
    low = F.greatest(F.lit(0), start - 50)
    out = hit.select(
        "file_id", "kind", "start", line_of(text, start).alias("line"), F.coalesce(_first(text, r"\(module\s+(\w+)"), F.lit("unknown")).alias("module"),
        F.coalesce(_first(text.substr(low + 1, start - low), r"func\s+\$?\w+", 0), F.lit("unknown")).alias("function"),
        F.coalesce(_first(after, r"offset\s*=\s*(\d+)").try_cast("long"), F.lit(-1)).alias("memory_offset"), F.coalesce(_first(after, r"table\s*=\s*(\d+)").try_cast("long"), F.lit(-1)).alias("table_index"),
        F.coalesce(_first(after, r"import\s*[\"']([^\"']+)[\"']"), F.lit("unknown")).alias("host"), kinds_in(window(text, start, end, 200), WASM_RISKS).alias("risks"),
    )
    return innermost(out, scopes(files, WASM_SCOPES, "()"), ["in_function"])


def extern_functions(files: DataFrame) -> DataFrame:
    """A row a function of an extern block: file_id, name, line and what its block does (unsafe code, memory by hand, raw
    pointers). A block ends at its own bracket, so bodies with brackets of their own are whole; the line counts from the block's
    beginning to where the name first stands in it."""
    rust = files.filter("lang = 'rust'")
    block = scopes(rust, [("block", EXTERN_BLOCK)], "{}").select("file_id", "open", "close")
    head = rust.select("file_id", "content", F.explode(matches(F.col("content"), EXTERN_BLOCK)).alias("m")).select("file_id", "content", F.col("m.start").alias("start"), (F.col("m.end") - 1).alias("open"))
    body = F.col("content").substr(F.col("open") + 2, F.coalesce("close", F.length("content")) - F.col("open") - 1)
    body = head.join(block, ["file_id", "open"]).select("file_id", "start", line_of(F.col("content"), F.col("start")).alias("first"), body.alias("body"))
    each = body.withColumn("name", F.explode(F.regexp_extract_all("body", F.lit(BLOCK_FUNCTION), F.lit(1))))
    lower = F.lower("body")
    return each.select(
        "file_id", "start", "name", (F.col("first") + line_of(F.col("body"), F.instr("body", F.col("name")) - 1) - 1).alias("line"), F.contains("body", F.lit("unsafe")).alias("unsafe"),
        F.exists(F.array(*map(F.lit, MANUAL_MEMORY)), lambda w: F.contains(lower, w)).alias("manual_memory"), (F.contains("body", F.lit("*mut")) | F.contains("body", F.lit("*const"))).alias("raw_pointer"),
    )


def ctypes_calls(files: DataFrame) -> DataFrame:
    """file_id, line, call, mismatch (a pointer type that is not ``c_void_p``) of loads and types of foreign functions."""
    hit = _hits(files, "python", [("ctypes", p) for p in CTYPES])
    call = F.col("content").substr(F.col("start") + 1, F.col("end") - F.col("start"))
    return hit.select("file_id", "start", line_of(F.col("content"), F.col("start")).alias("line"), call.alias("call"), (call.contains("POINTER") & ~call.contains("c_void_p")).alias("mismatch"))
