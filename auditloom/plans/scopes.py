"""Native calls, foreign blocks and runtime boundaries with the scopes that enclose them."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions import code_patterns as cp
from auditloom.functions.catalogs import values_sql
from auditloom.operators import scopes
from auditloom.plans.code import LEAVES, joined, risks_sql
from auditloom.plans.registry import register
from auditloom.plans.texts import hits_sql
from auditloom.sources.bindings import domain, with_sql

LINE = "CAST(length(substr(content, 1, {0})) - length(replace(substr(content, 1, {0}), chr(10), '')) + 1 AS INT)"


def around(n: int) -> str:
    return f"substr(content, greatest(0, x.start - {n}) + 1, x.start + length(match) + {n} - greatest(0, x.start - {n}))"


def first(text: str, pattern: str, default: str = "'unknown'", group: int = 1) -> str:
    return f"coalesce(nullif(regexp_extract({text}, '{pattern.replace(chr(39), chr(39) * 2)}', {group}), ''), {default})"


def enclosing(kind: str, heads: list[tuple[str, str]], left: str, right: str) -> dict[str, str]:
    """Tables of an innermost scope by pairs: an opening's end is the first later place of less depth, and of all scopes around a
    place the last opened one counts."""
    mine = [(k, p) for k, p in heads if k == kind]
    at = "start" if left == "(" else "start + length(match) - 1"
    return {
        f"b_{kind}": f"SELECT file_id, start, match, sum(CASE match WHEN '{left}' THEN 1 ELSE -1 END) OVER (PARTITION BY file_id ORDER BY start) AS d FROM ({hits_sql('units', 'content', 'file_id', values_sql([(rf'[\{left}\{right}]',)], 'pattern', 'r'))})",
        f"h_{kind}": f"SELECT file_id, {at} AS open, regexp_extract(match, pattern, 1) AS name FROM ({hits_sql('units', 'content', 'file_id', values_sql([(p,) for _, p in mine], 'pattern', 'r'))})",
        f"s_{kind}": f"SELECT h.file_id, h.open, h.name, min(c.start) AS close FROM h_{kind} h JOIN b_{kind} o ON o.file_id = h.file_id AND o.start = h.open LEFT JOIN b_{kind} c ON c.file_id = h.file_id AND c.start > o.start AND c.d < o.d GROUP BY ALL",
        f"i_{kind}": f"SELECT x.file_id, x.start, x.pattern, arg_max(name, open) AS {kind} FROM hit x JOIN s_{kind} s ON s.file_id = x.file_id AND s.open < x.start AND (s.close IS NULL OR s.close > x.start) GROUP BY ALL",
    }


def hits(lang: str, rules: list[tuple[str, str]]) -> str:
    return f"SELECT h.*, content FROM ({hits_sql('units', 'content', 'file_id', values_sql(rules, 'kind, pattern', 'r'))}) h JOIN units USING (file_id) WHERE lang = '{lang}'"


RISKS = cp.CALL_RISKS | {"unchecked_return": [rf"call\s*\([^)]*\)[^;]*;\s*(?:{LEAVES})"]}
near = around(300)
OWN = f"""list_filter(CASE kind
 WHEN 'delegatecall' THEN [CASE WHEN NOT contains({near}, 'onlyOwner') AND NOT contains({near}, 'require') THEN 'access_control' END, CASE WHEN NOT contains(lower({near}), 'update') THEN 'reentrancy' END]
 WHEN 'extcode' THEN [CASE WHEN contains({near}, 'extcodesize') AND NOT contains(substr(string_split({near}, 'extcodesize')[2], 1, 10), '0') THEN 'extcode_size' END]
 WHEN 'staticcall' THEN [CASE WHEN NOT contains({near}, 'require') THEN 'unchecked_return' END]
 WHEN 'callcode' THEN [CASE WHEN NOT contains({near}, 'require') THEN 'unchecked_return' END] ELSE [] END, lambda x: x IS NOT NULL)"""
CALLS = {
    "hit": hits("solidity", list(cp.CONTRACT["solidity"].items())),
    **enclosing("in_contract", cp.CONTRACT_SCOPES, "{", "}"),
    **enclosing("in_function", cp.CONTRACT_SCOPES, "{", "}"),
    "calls": f"SELECT x.file_id, kind, x.start, {LINE.format('x.start')} AS line, {first('content', cp.CONTRACT_HEAD[0], first('content', cp.CONTRACT_HEAD[1], chr(39) + 'Unknown' + chr(39)))} AS contract, "
    + first("substr(content, greatest(0, x.start - 200) + 1, x.start - greatest(0, x.start - 200))", r"function\s+(\w+)")
    + rf" AS function, regexp_matches({around(100)}, '\.value\s*\(|msg\.value') AS value_transfer, CAST({first(around(50), r'gas:\s*(\d+)', chr(39) + '0' + chr(39))} AS BIGINT) AS gas, "
    + first("substr(content, x.start + 1, length(match) + 200)", r"address\s*\(\s*([^)]+)\s*\)")
    + f" AS target, {OWN} AS own, string_split({risks_sql(RISKS, near)}, ',') AS other, in_contract, in_function FROM hit x LEFT JOIN i_in_contract USING (file_id, start, pattern) LEFT JOIN i_in_function USING (file_id, start, pattern)",
    "found": "SELECT * EXCLUDE (own, other), list_concat(own, list_filter(other, lambda r: r <> '' AND NOT list_contains(own, r))) AS risks FROM calls",
}
register("contract_calls", lambda s, d: scopes.contract_calls(domain(s, d, "units")).withColumn("risks", joined("risks")), with_sql(["units"], "SELECT * REPLACE (array_to_string(risks, ',') AS risks) FROM found", **CALLS))
register(
    "contract_statistics",
    lambda s, d: scopes.contract_statistics(scopes.contract_calls(domain(s, d, "units"))),
    with_sql(["units"], "SELECT coalesce(contract, '*') AS contract, count(*) AS n, count(*) FILTER (len(risks) >= 2) AS high, count(*) FILTER (value_transfer) AS transfers, CAST(sum(gas) // count(*) AS BIGINT) AS mean_gas FROM found GROUP BY GROUPING SETS ((contract), ())", **CALLS),
)
register(
    "abi_lines",
    lambda s, d: scopes.abi_lines(domain(s, d, "units")),
    with_sql(["units"], "SELECT file_id, CAST(line AS INT) AS line, trim(raw) AS signature FROM (SELECT file_id, unnest(string_split(content, chr(10))) AS raw, unnest(range(1, len(string_split(content, chr(10))) + 1)) AS line FROM units WHERE lang = 'solidity') WHERE starts_with(trim(raw), 'function ') OR starts_with(trim(raw), 'external ')"),
)
AFTER = "substr(content, x.start + 1, length(match) + 100)"
register(
    "wasm_boundaries",
    lambda s, d: scopes.wasm_boundaries(domain(s, d, "units")).withColumn("risks", joined("risks")),
    with_sql(
        ["units"],
        f"SELECT x.file_id, kind, x.start, {LINE.format('x.start')} AS line, {first('content', r'\(module\s+(\w+)')} AS module, "
        + first("substr(content, greatest(0, x.start - 50) + 1, x.start - greatest(0, x.start - 50))", r"func\s+\$?\w+", group=0)
        + f" AS function, CAST({first(AFTER, r'offset\s*=\s*(\d+)', chr(39) + '-1' + chr(39))} AS BIGINT) AS memory_offset, CAST({first(AFTER, r'table\s*=\s*(\d+)', chr(39) + '-1' + chr(39))} AS BIGINT) AS table_index, "
        + first(AFTER, r"""import\s*["']([^"']+)["']""")
        + f" AS host, {risks_sql(cp.WASM_RISKS, around(200))} AS risks, in_function FROM hit x LEFT JOIN i_in_function USING (file_id, start, pattern)",
        hit=hits("wasm", cp.WASM_EACH),
        **enclosing("in_function", cp.WASM_SCOPES, "(", ")"),
    ),
)
BODY = "substr(content, open + 2, coalesce(close, length(content)) - open - 1)"
register(
    "extern_functions",
    lambda s, d: scopes.extern_functions(domain(s, d, "units")),
    with_sql(
        ["units"],
        f"SELECT file_id, start, name, CAST({LINE.format('start')} + length(substr(body, 1, instr(body, name) - 1)) - length(replace(substr(body, 1, instr(body, name) - 1), chr(10), '')) AS INT) AS line, contains(body, 'unsafe') AS \"unsafe\", "
        + "regexp_matches(lower(body), 'malloc|free|alloc|dealloc') AS manual_memory, contains(body, '*mut') OR contains(body, '*const') AS raw_pointer FROM each",
        **{k.replace("_x", ""): v for k, v in enclosing("x", [("x", cp.EXTERN_BLOCK)], "{", "}").items() if not k.startswith("i_")} | {"s": "SELECT h.file_id, h.open, min(c.start) AS close FROM h JOIN b o ON o.file_id = h.file_id AND o.start = h.open LEFT JOIN b c ON c.file_id = h.file_id AND c.start > o.start AND c.d < o.d GROUP BY ALL"},
        heads=f"SELECT file_id, start, start + length(match) - 1 AS open FROM ({hits_sql('units', 'content', 'file_id', values_sql([(cp.EXTERN_BLOCK,)], 'pattern', 'r'))})",
        each=f"SELECT file_id, start, content, {BODY} AS body, unnest(regexp_extract_all({BODY}, '{cp.BLOCK_FUNCTION}', 1)) AS name FROM heads JOIN s USING (file_id, open) JOIN units USING (file_id) WHERE lang = 'rust'",
    ),
)
register(
    "ctypes_calls",
    lambda s, d: scopes.ctypes_calls(domain(s, d, "units")),
    with_sql(["units"], f"SELECT file_id, start, {LINE.format('start')} AS line, match AS call, contains(match, 'POINTER') AND NOT contains(match, 'c_void_p') AS mismatch FROM hit", hit=hits("python", [("ctypes", p) for p in cp.CTYPES])),
)
register(
    "function_scopes",
    lambda s, d: scopes.scopes(domain(s, d, "units").filter("lang = 'solidity'"), cp.CONTRACT_SCOPES, "{}").groupBy("kind", "name").agg(F.count("*").alias("n"), F.sum(F.col("close") - F.col("open")).alias("size")),
    with_sql(
        ["units"],
        " UNION ALL ".join(f"SELECT '{k}' AS kind, name, count(*) AS n, CAST(sum(close - open) AS BIGINT) AS size FROM s_{k} JOIN units USING (file_id) WHERE lang = 'solidity' GROUP BY name" for k in ("in_contract", "in_function")),
        **{k: v for k, v in CALLS.items() if k[:2] in ("b_", "h_", "s_")},
    ),
)
