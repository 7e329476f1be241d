"""Domain tables from the driver's tables, by fixed rules of integer arithmetic.

Each is a source table and, per column, an expression that Spark and DuckDB read alike; ``domain`` gives the DataFrame,
``with_sql`` the common table expressions for an oracle."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from auditloom.functions.catalogs import BUG_CLASSES, CWES


def cases(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values)) + " END"


MESSAGES = "CASE o_orderkey % 8 WHEN 0 THEN concat('Fix CVE-2024-', cast(1000 + o_orderkey % 9000 as string), ' buffer overflow') WHEN 1 THEN 'Refactor build scripts' WHEN 2 THEN 'patch integer overflow and CVE-2023-12345, cve-2022-0001' WHEN 3 THEN 'Update docs' WHEN 4 THEN 'Resolve race condition in null pointer path' WHEN 5 THEN 'Security: use-after-free in parser' WHEN 6 THEN 'Bump version' ELSE 'Add tests for injection' END"

BINDINGS: dict[str, tuple[str, dict[str, str]]] = {
    "findings": ("orders", {
        "finding_id": "o_orderkey", "bug_class": cases("o_custkey", BUG_CLASSES), "cwe_id": cases("o_custkey", CWES),
        "location": "concat('src/', CASE o_custkey % 7 WHEN 0 THEN 'kernel' WHEN 1 THEN 'driver' WHEN 2 THEN 'nginx' WHEN 3 THEN 'azure' WHEN 4 THEN 'redis' WHEN 5 THEN 'crypto' ELSE 'core' END, '/f', cast(o_custkey % 50 as string), '.c:', cast(o_orderkey % 400 as string))",
        "score": "cast((o_orderkey * 37) % 101 as double) / 100",
        "severity": "CASE o_orderpriority WHEN '1-URGENT' THEN 'critical' WHEN '2-HIGH' THEN 'high' WHEN '3-MEDIUM' THEN 'medium' ELSE 'low' END",
        "address": "o_custkey",
    }),
    "mergeable": ("orders", {
        "finding_id": "o_orderkey", "bug_class": cases("o_custkey", BUG_CLASSES), "cwe_id": cases("o_custkey % 15", CWES), "function": "concat('fn', cast(o_custkey as string), '_', cast(o_orderkey % 4 as string))",
        "pattern": "concat('p', cast(cast(floor(o_orderkey / 8) as bigint) as string))", "location": "concat('src/', cast(cast(floor(o_orderkey / 8) as bigint) as string), ':', cast(o_orderkey % 2 as string))",
    }),
    "patches": ("orders", {
        "patch_id": "o_orderkey", "bug_class": "CASE o_orderkey % 4 WHEN 0 THEN 'race_condition' WHEN 1 THEN 'logic_error' WHEN 2 THEN 'Overflow' ELSE NULL END",
        "description": "CASE o_orderkey % 11 WHEN 0 THEN 'Buffer overflow in parser' WHEN 1 THEN 'Use after free of a dangling pointer' WHEN 2 THEN 'integer overflow of the size' WHEN 3 THEN 'race condition (TOCTOU)' WHEN 4 THEN 'NULL dereference' WHEN 5 THEN 'SQL injection via query format' WHEN 6 THEN 'Reentrancy: external call, state change' WHEN 7 THEN 'wasm linear memory' WHEN 8 THEN 'extern block' WHEN 9 THEN 'delegatecall' ELSE 'misc fix' END",
        "pre": "CASE o_custkey % 8 WHEN 0 THEN concat('  strcpy(d, s); free(p); use(p); free(p) ', repeat('- ', 40), 'sprintf(b, x) ', chr(10)) WHEN 1 THEN 'delete q; x = q->a; eval(z)' WHEN 2 THEN 'if (p) p = 1; malloc(n + 1 + 2)' WHEN 3 THEN 'Select * from t where a = + b; f\"{x}\"' WHEN 4 THEN '#[repr(C)] extern \"C\" unsafe block' WHEN 5 THEN 'call.delegatecall(x); extcodesize(y); selfdestruct(z); extcodesize(w); extcodesize(v); selfdestruct(u)' WHEN 6 THEN 'ptr->a ? b : c; role check is missing' ELSE 'memory grow; native method; interop' END",
        "post": "CASE o_orderkey % 3 WHEN 0 THEN 'free(q); check; free(q)' WHEN 1 THEN 'add bounds check then act' ELSE NULL END",
    }),
    "votes": ("lineitem", {
        "finding_id": "l_orderkey", "line": "l_linenumber", "vote": "l_returnflag <> 'R'", "weight": "cast(l_quantity as int)",
        "persona": cases("l_linenumber", ["pro-vulnerability", "anti-vulnerability", "arbiter"]),
        "stance": "CASE l_returnflag WHEN 'N' THEN 'FOR' WHEN 'A' THEN 'AGAINST' ELSE 'ABSTAIN' END",
    }),
    "ground_truth": ("part", {
        "vuln_id": "p_partkey", "category": cases("p_partkey", BUG_CLASSES), "cwe_id": cases("p_partkey", CWES),
        "location": "concat('src/', CASE p_partkey % 7 WHEN 0 THEN 'kernel' WHEN 1 THEN 'driver' WHEN 2 THEN 'nginx' WHEN 3 THEN 'azure' WHEN 4 THEN 'redis' WHEN 5 THEN 'crypto' ELSE 'core' END, CASE WHEN p_partkey % 9 = 4 THEN '/g' ELSE '/f' END, cast(p_partkey % 50 as string), '.c:', cast(p_size * 8 as string))",
        "lang": cases("p_size", ["c", "rust", "solidity", "python"]), "stage": cases("p_partkey", ["scan", "validate", "dedup"]), "agent_id": "p_size",
    }),
    "files": ("documents", {
        "file_id": "doc_id", "path": "concat('repo/', source, '/d', cast(doc_id as string), CASE lang WHEN 'en' THEN '.py' WHEN 'de' THEN '.rs' WHEN 'fr' THEN '.js' ELSE '.go' END)", "content": "text",
    }),
    "programs": ("documents", {
        "file_id": "doc_id", "lang": cases("doc_id", ["python", "rust", "javascript", "go"]),
        "content": "concat(CASE doc_id % 4 WHEN 0 THEN concat('import os', chr(10), CASE doc_id % 3 WHEN 0 THEN 'data = input (\"x\")' WHEN 1 THEN 'data = requests.get(u); flask.request.args' ELSE 'cfg = json.load(f); with open (p)' END) WHEN 1 THEN CASE doc_id % 3 WHEN 0 THEN 'unsafe  fn f() { env::var(k)' WHEN 1 THEN 'let b = reqwest::get(u)' ELSE 'let f = File::open(p); args()' END WHEN 2 THEN CASE doc_id % 3 WHEN 0 THEN 'const fs = require(\"fs\"); prompt (q)' WHEN 1 THEN 'fetch (u); new WebSocket(v)' ELSE 'fs.readFileSync(p)' END ELSE CASE doc_id % 3 WHEN 0 THEN 'fmt.Scan(x)' WHEN 1 THEN 'net/http.Get(u)' ELSE 'import \"C\"; os.Open(p)' END END, chr(10), text, chr(10), CASE doc_id % 5 WHEN 0 THEN 'x.Strip ()' WHEN 1 THEN 'y = Validated' ELSE '' END, chr(10), CASE doc_id % 4 WHEN 0 THEN 'cursor.executemany(q); subprocess.run(c)' WHEN 1 THEN 'conn.execute(q); std::ptr::write(p, v)' WHEN 2 THEN 'db.query(q); eval (c); fs.writeFile(p)' ELSE 'db.Exec(q); exec.Command(c)' END, chr(10), CASE doc_id % 7 WHEN 0 THEN 'escape; ctypes.CDLL; requests.post(u); WebAssembly.x; eval (z); File::create(p)' ELSE 'ioutil.WriteFile(p); open (a, \"w\")' END)",
    }),
    "alerts": ("events", {
        "event_id": "event_id", "alert_id": "concat(cast(user_id as string), '-', event_type)", "ts": "ts", "mode": "event_type",
        "severity": "CASE event_id % 4 WHEN 0 THEN 'low' WHEN 1 THEN 'medium' WHEN 2 THEN 'high' ELSE 'critical' END", "anomaly": "value", "agent_id": "user_id",
    }),
    "costs": ("events", {
        "seq": "event_id", "stage": "event_type", "model": cases("event_id", ["small", "medium", "large"]), "cents": "cast(floor(value * 100) as bigint)", "run_id": "user_id",
    }),
    "commits": ("orders", {"commit_id": "o_orderkey", "message": MESSAGES}),
    "intel": ("customer", {
        "address": "c_custkey", "tvl": "c_acctbal * 100000", "transaction_volume": "cast(c_custkey % 20 as double) * 1000000", "active_addresses": "cast(c_custkey % 13 as double) * 10000",
        "dependents": "cast(c_custkey % 11 as double) * 100", "price_impact": "cast(c_custkey % 101 as double)", "liquidity_depth": "cast(c_custkey % 9 as double) * 2000000",
    }),
    "hosts": ("lineitem", {
        "address": "l_suppkey", "ip": "l_orderkey", "service": cases("l_linenumber", ["apache", "nginx", "ssh", "redis"]), "country": cases("l_partkey", ["us", "de", "fr", "jp", "br"]), "vuln": cases("l_partkey", ["CVE-2021-1", "CVE-2022-2", "CVE-2023-3"]),
    }),
    "code": ("part", {
        "file_id": "p_partkey", "lang": cases("p_partkey", ["rust", "python", "solidity", "wasm", "go"]),
        "content": "CASE p_partkey % 5 WHEN 0 THEN concat('extern \"C\" fn f', cast(p_partkey as string), '() {', chr(10), 'unsafe { raw_pointer }', chr(10), '#[no_mangle]', chr(10), 'static mut X; memcpy(d, s, n + 1); fn main() {}') WHEN 1 THEN concat('import ctypes', chr(10), 'lib = ctypes.CDLL(None)', chr(10), 'password = \"x\"; MD5', chr(10), 'app.run()', chr(10), CASE p_size % 2 WHEN 0 THEN 'CString::new' ELSE 'Box::leak' END) WHEN 2 THEN concat('contract C', cast(p_size as string), ' is Base {', chr(10), 'function pay(address a) public {', chr(10), 'a.call(x);', CASE p_size % 3 WHEN 0 THEN ' require(ok);' ELSE ' ' END, ' balance[m] = 0; totalSupply;', chr(10), 'a.delegatecall (data); extcodesize(a) > 0; allowance[b]; }}') WHEN 3 THEN concat('(module (import \"env\" \"f\") (i32.load (0) + 4 )', chr(10), 'memory.grow call_indirect global.get export x)', cast(p_size as string)) ELSE concat('x := C.puts', chr(10), 'p := unsafe.Pointer(q)', chr(10), 'callback lifetime ', cast(p_size as string)) END",
    }),
    "units": ("part", {
        "file_id": "p_partkey", "lang": cases("p_partkey", ["rust", "python", "solidity", "wasm"]),
        "content": "CASE p_partkey % 4 WHEN 0 THEN concat('extern \"C\" {', chr(10), ' fn malloc_', cast(p_partkey as string), '(n: usize) -> *mut u8;', chr(10), CASE p_size % 2 WHEN 0 THEN 'fn plain(a: i32);' ELSE 'fn hook(x: i32) { if x { unsafe { y } } }' END, chr(10), 'fn last();', chr(10), '}', chr(10), CASE p_size % 3 WHEN 0 THEN 'extern  \"C\"  { fn other(x: i32); }' ELSE '' END, chr(10), 'fn main() { unsafe { free(p) } }') WHEN 1 THEN concat('import ctypes', chr(10), 'lib = ctypes.CDLL(\"x', cast(p_partkey as string), '.so\")', chr(10), 'P = ctypes.POINTER(ctypes.c_int)', chr(10), 'Q = ctypes.POINTER(ctypes.c_void_p)', chr(10), CASE p_size % 2 WHEN 0 THEN 'F = ctypes.CFUNCTYPE(None, ctypes.c_int)' ELSE 'W = ctypes.WinDLL(name); ctypes.CDLL()' END) WHEN 2 THEN concat('library L {', chr(10), 'function helper(uint a) internal { x.staticcall(data); }', chr(10), '}', chr(10), 'contract C', cast(p_size as string), CASE p_size % 2 WHEN 0 THEN ' is Base {' ELSE ' {' END, chr(10), '  function pay(address a) public {', chr(10), CASE p_size % 4 WHEN 0 THEN repeat('// pad ', 40) ELSE '' END, 'if (ok) { a.call{value: 1, gas: ', cast(p_size * 100 as string), '}(abi.encode(address(t', cast(p_partkey as string), '))); }', chr(10), '}', chr(10), CASE p_size % 3 WHEN 0 THEN 'function drain() external { require(ok); owner.delegatecall(data); msg.value; }' WHEN 1 THEN 'modifier m { create2(salt); if (extcode(a) && extcodesize(b) > 1) { update(); } }' ELSE 'receive() { selfdestruct(address( owner )); callcode(x); }' END, chr(10), '} a.send(1);', chr(10), '  external last') ELSE concat('(module m', cast(p_partkey as string), chr(10), '(import \"env\" \"f', cast(p_size % 5 as string), '\")', chr(10), '(func $run (param i32)', chr(10), '(i32.load offset=', cast(p_size as string), ' (i32.const 0)))', chr(10), '(func $go (call_indirect table=', cast(p_size % 3 as string), ' (i32.store8 (i32.const 4))))', chr(10), 'call import x', chr(10), '(export \"run\" (func $run)))') END",
    }),
    "catalog": ("supplier", {
        "technique_id": "concat('D3-X', cast(s_suppkey as string))", "tactic": cases("s_suppkey", ["Detect", "Isolate", "Deceive"]), "technique": cases("s_suppkey", ["Memory Checks", "Credential Hygiene"]), "level_0": "''", "level_1": "''",
        "definition": "CASE s_suppkey % 6 WHEN 0 THEN 'Checks buffer bounds;  memory.' WHEN 1 THEN 'Rotate every credential and password, storage' WHEN 2 THEN 'Limits resource exhaustion (rate)' WHEN 3 THEN 'Race detection, by thread; \"sanitize\"' WHEN 4 THEN 'Certificate pinning' ELSE 'decoys' END",
    }),
    "ontology_map": ("customer", {"cwe_id": cases("c_custkey", ["CWE-190", "CWE-476", "CWE-326", "CWE-119"]), "technique_id": "concat('D3-O', cast(c_custkey % 7 as string))"}),
    "ontology_known": ("customer", {"technique_id": "concat('D3-O', cast(c_custkey % 5 as string))"}),
    "hierarchy": ("part", {
        "technique_id": "p_partkey", "parent": "CASE WHEN p_partkey % 97 = 0 THEN NULL ELSE cast(floor(p_partkey / 3) as bigint) END", "other": "CASE WHEN p_partkey % 5 = 0 THEN cast(floor(p_partkey / 7) as bigint) ELSE NULL END",
        "tactic": "CASE p_size % 6 WHEN 0 THEN 'Harden' WHEN 1 THEN 'Detect' WHEN 2 THEN 'Isolate' WHEN 3 THEN 'Deceive' WHEN 4 THEN 'Restore' ELSE NULL END",
    }),
    "attack_tactics": ("orders", {
        "finding_id": "o_orderkey", "one": cases("o_custkey", ["Execution", "Impact", "Persistence", "Discovery", "Credential Access"]), "two": cases("o_orderkey", ["Impact", "Initial Access", "Execution"]),
        "technique_id": "concat('D3-', cast(o_custkey % 9 as string))", "label": "concat('Technique ', cast(o_custkey % 9 as string))", "tactic": cases("o_custkey", ["Harden", "Detect"]),
    }),
    "provable": ("part", {
        "file_id": "p_partkey", "lang": cases("p_partkey", ["c", "rust", "python"]),
        "content": "CASE p_partkey % 3 WHEN 0 THEN concat('int f', cast(p_partkey as string), '(char *s) {', chr(10), CASE p_size % 4 WHEN 0 THEN 'free(s);' WHEN 1 THEN 'mutex_lock(m);' WHEN 2 THEN 'return 1 + 2;' ELSE 'return;' END, ' }', chr(10), repeat('; ', 150), chr(10), 'void g (void) { return; }') WHEN 1 THEN concat('fn a() { unsafe { x } }', chr(10), CASE p_size % 2 WHEN 0 THEN 'unsafe{ y }' ELSE '' END) ELSE concat('import weakref, threading', chr(10), 'del x', chr(10), CASE p_size % 3 WHEN 0 THEN 'with Lock(): gc.collect()' WHEN 1 THEN 'Semaphore(2); finalize(x)' ELSE 'asyncio.create_task(f)' END) END",
    }),
    "annotated": ("supplier", {
        "file_id": "s_suppkey",
        "content": "concat('/* The caller must hold the lock', chr(10), '   short', chr(10), ' at most ', cast(s_suppkey as string), ' packets; never negative */', chr(10), '  # requires that the key is valid', chr(10), CASE s_suppkey % 3 WHEN 0 THEN concat('assert x > ', cast(s_suppkey as string), ' and y', chr(10), 'self.assertEqual(a, b, c)') WHEN 1 THEN concat('require(ok == done); // must ensure order', chr(10), '// returns is null, always sorted') ELSE concat('\"\"\"Guarantees that', chr(10), 'output must be a hash of the file\"\"\"', chr(10), 'assertRaises(E); assume(n >= 1); invariant (z)') END)",
    }),
    "maps": ("supplier", {
        "mapper": "CASE WHEN s_suppkey % 5 = 0 THEN 'iam' WHEN s_suppkey % 5 = 1 THEN 'data_type' WHEN s_suppkey % 5 = 2 THEN 'dlp_action' WHEN s_suppkey % 5 = 3 THEN 'pki_component' ELSE 'attack_pattern' END",
        "key": "CASE WHEN s_suppkey % 5 = 0 THEN 'pam' WHEN s_suppkey % 5 = 2 THEN CASE s_nationkey % 3 WHEN 0 THEN 'block' WHEN 1 THEN 'audit' ELSE 'encrypt' END ELSE concat('k', cast(s_nationkey % 4 as string)) END",
        "field": "CASE WHEN s_suppkey % 5 = 0 THEN 'controls' WHEN s_suppkey % 15 = 2 THEN 'description' WHEN s_suppkey % 5 = 4 THEN 'detection' ELSE 'techniques' END", "place": "cast(floor(s_suppkey / 5) as bigint)",
        "value": "CASE WHEN s_suppkey % 5 = 0 THEN concat(CASE s_suppkey % 4 WHEN 0 THEN 'Vault of ' WHEN 1 THEN 'Credential checkout ' WHEN 2 THEN 'Key ROTATION ' ELSE 'Session recording ' END, cast(s_nationkey as string)) WHEN s_suppkey % 15 = 2 THEN concat('What it does ', cast(s_nationkey as string)) ELSE concat('D3-', cast(s_suppkey % 23 as string)) END",
    }),
    "policy_requests": ("customer", {
        "policy_id": "c_custkey", "one": "concat('k', cast(c_custkey % 4 as string))", "two": "concat('k', cast(c_custkey % 6 as string))", "action": cases("c_custkey", ["block", "audit", "encrypt", "warn", "block"]),
        "identity": cases("c_custkey", ["root", "service_account", "api_key", "guest"]), "mapper": cases("c_custkey", ["iam", "pki_component", "attack_pattern"]),
    }),
    "notes": ("supplier", {
        "note_id": "s_suppkey", "content": "CASE s_suppkey % 4 WHEN 0 THEN concat('The caller must hold the lock', chr(10), 'short', chr(10), 'it always returns is positive; at most ', cast(s_suppkey as string)) WHEN 1 THEN 'Ensures that the result is sorted and never changes' WHEN 2 THEN concat('   maximum size of buffer  ', chr(10), 'range between zero and ten; property of x') ELSE 'nothing to see in here' END",
    }),
    "outputs": ("events", {"run_id": "event_id", "output": "CASE event_id % 5 WHEN 0 THEN concat('ERROR: Heap-Use-After-Free at ', event_type) WHEN 1 THEN 'WARNING: data race; Thread-Leak' WHEN 2 THEN 'runtime error: division-by-zero, shift-exponent' ELSE 'ok' END"}),
    "uploads": ("orders", {"upload_id": "o_orderkey", "name": "CASE o_orderkey % 7 WHEN 0 THEN 'a.txt' WHEN 1 THEN '../a' WHEN 2 THEN '/etc/x' WHEN 3 THEN 'a.b.exe' WHEN 4 THEN 'a.tar.gz' WHEN 5 THEN '.hidden' ELSE 'lib.min.js' END"}),
    "certs": ("customer", {
        "chain_id": "cast(floor(c_custkey / 3) as bigint)", "position": "c_custkey % 3", "subject": "concat('s', cast(c_custkey % 4 as string))", "issuer": "concat('s', cast(c_custkey % 5 as string))",
        "algorithm": cases("c_custkey", ["sha256", "sha1WithRSA", "ecdsa", "MD5", "sha512"]), "key_size": "cast(c_custkey % 5 * 1024 as int)", "not_after": "concat('20', cast(20 + c_custkey % 10 as string), '-06-01 00:00:00')",
    }),
    "agents": ("nation", {"agent_id": "n_nationkey", "bug_class": cases("n_regionkey", ["memory_corruption", "race_condition", "reentrancy"]), "stage": cases("n_nationkey", ["view", "click"]), "load": "n_nationkey * 7 % 10"}),
    "controls": ("part", {
        "control": "concat('CCI-', cast(100000 + p_partkey % 300 as string))", "technique_id": cases("p_partkey", ["D3-SCH", "D3-AH", "D3-MA", "D3-CH", "D3-MFA", "D3-PA", "D3-NTA"]),
        "name": cases("p_size", ["Application Hardening", "Credential Rotation", "Network Traffic Analysis"]), "definition": "concat('The system must enforce ', CASE p_size % 3 WHEN 0 THEN 'hardening of application' WHEN 1 THEN 'rotation of credential' ELSE 'analysis' END)",
    }),
    "targets": ("orders", {
        "target_id": "o_orderkey", "property": cases("o_orderkey", ["memory_safety", "thread_safety", "arithmetic"]), "method": cases("o_custkey", ["symbolic", "static"]), "status": cases("o_orderkey * 7 + o_custkey", ["verified", "violated", "unknown", "timeout"]),
        "requirement": "CASE o_orderkey % 3 WHEN 0 THEN 'network traffic must be inspected' WHEN 1 THEN 'rotation of every credential' ELSE 'none' END",
    }),
    "models": ("supplier", {"model_id": "s_suppkey", "tier": cases("s_suppkey", ["frontier", "balanced", "distilled"]), "price": "cast(s_suppkey * 13 % 17 + 1 as double) / 4", "has_code": "s_suppkey % 2 = 0"}),
    "paths": ("customer", {"path_id": "c_custkey", "path": "CASE c_custkey % 5 WHEN 0 THEN concat('C:', chr(92), 'Windows', chr(92), 'x') WHEN 1 THEN '/usr/lib/a' WHEN 2 THEN '/Library/b' WHEN 3 THEN '/etc/ssh' ELSE 'rel/path' END"}),
    "sheets": ("nation", {
        "name": "concat('Sheet ', n_name)", "priority": cases("n_nationkey", ["high", "critical", "low", "medium"]), "kind": cases("n_nationkey", ["class", "cwe"]), "ordinal": "n_nationkey",
        "value": "CASE n_nationkey % 2 WHEN 0 THEN " + cases("n_nationkey", BUG_CLASSES) + " ELSE " + cases("n_nationkey", CWES) + " END",
    }),
    "answers": ("conversations", {
        "conv_id": "conv_id", "turn": "turn", "role": "role",
        "response": "CASE turn % 4 WHEN 0 THEN concat('VOTE: for', chr(10), 'CONFIDENCE: 0.', cast(turn % 10 as string), chr(10), 'REASONING: because ', role) WHEN 1 THEN concat(' VOTE: AGAINST', chr(10), 'CONFIDENCE: 7', chr(10), 'VOTE: maybe') WHEN 2 THEN concat('CONFIDENCE: high', chr(10), text) ELSE text END",
    }),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def domain(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    source, columns = BINDINGS[name]
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS {c}" for c, e in columns.items()])


def with_sql(names: list[str], query: str, **more: str) -> str:
    """query after the common table expressions it needs."""
    parts = [f"{n} AS (SELECT " + ", ".join(f"{e} AS {c}" for c, e in BINDINGS[n][1].items()) + f" FROM {BINDINGS[n][0]})" for n in names]
    parts += [f"{n} AS ({q})" for n, q in more.items()]
    return "WITH " + ", ".join(parts) + " " + query if parts else query
