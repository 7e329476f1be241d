"""Fixed patterns over source code."""

# Patterns, words and thresholds that results depend on.

FFI = {
    "rust": {"extern_c": r'extern\s*"C"\s*fn\s+(\w+)', "unsafe_block": r"unsafe\s*\{", "repr_c": r"#\[repr\(C\)\]", "no_mangle": r"#\[no_mangle\]"},
    "python": {"ctypes": r"ctypes\.", "cffi": r"cffi\.", "pybind11": "pybind11::", "cython": r"cdef\s+extern"},
    "go": {"cgo": r'//\s*#include\s*"C"', "cimport": r"C\.", "unsafe_pointer": r"unsafe\.Pointer"},
    "node": {"napi": "napi_", "node_ffi": "node-ffi", "neon": r"neon\."},
    "java": {"jni": "JNI_", "native": r"native\s+\w+\("},
}
FFI_RISKS = {
    "unsafe_block": [r"unsafe\s*\{[^}]*\}\s*\)", "transmute_copy", "raw_pointer"],
    "buffer_overflow": [r"memcpy.*\+", r"strcpy.*\+", r"buffer.*size.*\+"],
    "memory_leak": ["malloc.*without.*free", "new.*without.*delete", "Box::leak"],
    "race_condition": ["Arc::clone", "Rc::clone", "static.*mut"],
    "callback_lifetime": ["callback.*lifetime", "closure.*lifetime", "static.*callback"],
    "string_encoding": ["string.*null.*terminated", r"CStr\(", "CString::"],
}
CONTRACT = {
    "solidity": {
        "delegatecall": r"delegatecall\s*\(", "staticcall": r"staticcall\s*\(", "callcode": r"callcode\s*\(", "extcode": r"extcode\(", "extcodesize": r"extcodesize\(",
        "selfdestruct": r"selfdestruct\s*\(", "suicide": r"suicide\s*\(", "address.call": r"\.call\s*\{", "address.delegatecall": r"\.delegatecall\s*\(",
        "address.staticcall": r"\.staticcall\s*\(", "address.send": r"\.send\s*\(", "address.transfer": r"\.transfer\s*\(", "call.value": r"\.call\.value\s*\(",
        "call.gas": r"\.call\.gas\s*\(", "extcodecopy": r"extcodecopy\(", "create": r"create\s*\(", "create2": r"create2\s*\(",
    }
}
# The look-ahead of unchecked returns is a rule of its own: see operators.boundaries.unchecked.
CONTRACT_RISKS = {
    "delegatecall_risk": [r"delegatecall\s*\([^)]*\)", r"address\.delegatecall", r"function\s+\w+\s*\(\s*address\s+\w+\s*\)"],
    "extcode_size": [r"extcodesize\s*\([^)]*\)\s*>\s*0", r"extcodecopy\s*\([^)]*\)"],
    "reentrancy": [r"call\.value\s*\([^)]*\)", r"\.call\s*\{[^}]*\.value\s*", r"external\s+call\s+before\s+update"],
    "call_injection": [r"call\s*\([^)]*address\([^)]*\)[^)]*\)", r"delegatecall\s*\([^)]*abi\.encodeWithSelector"],
    "gas_limit": [r"call\s*\{\s*gas:\s*\d+\s*\}", r"\.call\s*\{[^}]*gas:\s*\d+"],
    "access_control": [r"function\s+\w+\s*\(\s*\)\s*public", r"function\s+\w+\s*\(\s*\)\s*external", r"onlyOwner\s*\(\s*\)\s*public"],
    "address_predictability": [r"block\.timestamp", r"blockhash\s*\(", r"block\.number"],
}
WASM = {
    "wasm": {
        "memory_access": r"[if](32|64)\.(load|store)", "table_access": r"call_indirect|table\.(get|set|grow|size)", "host_import": r"call\s+import|import\s+\w+|\.import", "export": r"export\s+",
    }
}
WASM_RISKS = {
    "linear_memory_overflow": [r"i32\.load.*\+\s*\d+\s*\)", r"i64\.load.*\+\s*\d+\s*\)", r"memory\.grow"],
    "uninitialized_memory": [r"i32\.load\s*\(\s*0\s*\)", r"i64\.load\s*\(\s*0\s*\)"],
    "stack_overflow": [r"call\s+\w+\s*[^)]*\)", "call_indirect"],
    "host_import_injection": [r"import\s*[\"'].*[\"']\s*", r"env\.get"],
    "side_channel": [r"global\.get", r"global\.set", r"performance\.now"],
    "unsafe_host_call": [r"import\s+env", r"import\s+process", r"import\s+fs"],
}
EXTERNAL_CALL = r"(\w+\.call\s*\([^)]*\)|delegatecall\s*\([^)]*\)|staticcall\s*\([^)]*\))"
STATE_WRITE = r"(balance\[|totalSupply|allowance\[|mapping\[)"

INVARIANTS = {
    "precondition": [r"(must|should|shall|require|need|must not)\s+(\w+)", r"(before|prior to|precondition for)\s+(\w+)", r"(assumes?|assumption)\s+(that|the)", r"(requires?|requirement)\s+(that|the)"],
    "postcondition": [r"(ensures?|guarantees?|will|shall)\s+(\w+)", r"(after|postcondition for)\s+(\w+)", r"(returns?|result)\s+(is|should be)", r"(output)\s+(must|should)"],
    "invariant": [r"(always|never|must)\s+(\w+)", r"(invariant|property)\s+(of|for)\s+(\w+)", r"(maintains?|preserves?)\s+(\w+)", r"(cannot|must not)\s+(\w+)"],
    "constraint": [r"(constraint|limit|restriction)\s+(on|for)\s+(\w+)", r"(maximum|minimum)\s+(\w+)", r"(at most|at least)\s+(\d+)", r"(range)\s+(between|of)"],
}
RELEVANT = ["must", "shall", "require", "ensure", "guarantee", "invariant", "property", "constraint", "condition", "assert", "assume", "precondition", "postcondition"]
ENTRY_POINTS = {
    "python": ["main(", "if __name__ == '__main__'", "app.run(", "Flask(", "FastAPI("], "javascript": ["app.listen(", "express(", "server.listen(", "createServer("],
    "rust": ["fn main(", "#[main]"], "solidity": ["function ", "constructor("],
}
SANITIZER_OUTPUT = {
    "address_sanitizer": ["heap-buffer-overflow", "stack-buffer-overflow", "use-after-free", "double-free", "negative-size-as-size", "heap-use-after-free"],
    "undefined_sanitizer": ["undefined-behavior", "shift-exponent", "division-by-zero"],
    "thread_sanitizer": ["data race", "lock-order-inversion", "thread-leak"],
}
WEAK_CRYPTO = {"MD5": "md5", "SHA1": "sha1", "DES": "des", "RC4": "rc4"}
FIX_PATTERNS = [
    ("add.*check", "Added validation check"), ("add.*null.*check", "Added null pointer check"), ("add.*bounds.*check", "Added bounds check"),
    ("use.*safe.*function", "Replaced with safe function"), ("add.*lock", "Added locking mechanism"), ("add.*sanitize", "Added input sanitization"),
    ("change.*size", "Fixed buffer size"), ("add.*length.*check", "Added length check"), ("remove.*unsafe", "Removed unsafe operation"),
    ("initialize.*variable", "Added variable initialization"),
]
NETWORK_FACING = ["live-host", "network-range-own-assets"]
CROSS_LANGUAGE_CLASSES = ["ffi_boundary", "cross_language"]
# What names a contract, its scopes, blocks of foreign functions and calls of them.
CONTRACT_HEAD = [r"contract\s+(\w+)\s*is", r"contract\s+(\w+)\s*\{"]
CONTRACT_SCOPES = [("in_contract", r"(?:contract|library|interface)\s+(\w+)[^{};]*\{"), ("in_function", r"function\s+(\w+)[^{};]*\{")]
WASM_SCOPES = [("in_function", r"\(\s*func\s+\$?(\w+)")]
WASM_EACH = [
    ("memory_access", r"i32\.load"), ("memory_access", r"i64\.load"), ("memory_access", r"f32\.load"), ("memory_access", r"f64\.load"),
    ("memory_access", r"i32\.store"), ("memory_access", r"i64\.store"), ("memory_access", r"f32\.store"), ("memory_access", r"f64\.store"),
    ("table_access", "call_indirect"), ("table_access", r"table\.get"), ("table_access", r"table\.set"), ("table_access", r"table\.grow"), ("table_access", r"table\.size"),
    ("host_import", r"call\s+import"), ("host_import", r"import\s+\w+"), ("host_import", r"\.import"), ("export", r"export\s+"), ("export", r'\(export\s+"'),
]
EXTERN_BLOCK = r'extern\s*"C"\s*\{'
BLOCK_FUNCTION = r"fn\s+(\w+)\s*\([^)]*\)"
MANUAL_MEMORY = ["malloc", "free", "alloc", "dealloc"]
CTYPES = [r"ctypes\.CDLL\(([^)]+)\)", r"ctypes\.WinDLL\(([^)]+)\)", r"ctypes\.CFUNCTYPE\(([^)]+)\)", r"ctypes\.POINTER\(([^)]+)\)"]
# Risks of contract calls, unchecked returns among them.
CALL_RISKS = {
    "delegatecall_risk": CONTRACT_RISKS["delegatecall_risk"], "extcode_size": CONTRACT_RISKS["extcode_size"], "reentrancy": CONTRACT_RISKS["reentrancy"],
    "unchecked_return": [r"call\s*\([^)]*\)[^;]*;(?!\s*require)"], "call_injection": CONTRACT_RISKS["call_injection"], "gas_limit": CONTRACT_RISKS["gas_limit"],
    "access_control": CONTRACT_RISKS["access_control"], "address_predictability": CONTRACT_RISKS["address_predictability"],
}
# Comments that span lines, forms of assertions, and what is worth a proof in Python.
COMMENT_BLOCKS = [r"/\*[\s\S]*?\*/", r'"""[^"]*"""', r"'''[^']*'''"]
ASSERTIONS = [r"assert\s+(.+)", r"assertEqual\s*\((.+),\s*(.+)\)", r"assertTrue\s*\((.+)\)", r"assertFalse\s*\((.+)\)", r"assertRaises\s*\((.+)\)", r"invariant\s*\((.+)\)", r"assume\s*\((.+)\)", r"require\s*\((.+)\)"]
PYTHON_TARGETS = {"memory_safety": [r"(del|__del__|gc\.)", r"(weakref|finalize)"], "thread_safety": [r"(threading|Thread|asyncio\.create_task)", r"(lock|Lock|Semaphore)"]}
