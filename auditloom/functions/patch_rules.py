"""Fixed rules of patch classes."""

# Patterns of the classes of a patch, in their order. Four patterns that refer to a group without having one get the group they mean.

PATCH_CLASSES = {
    "buffer_overflow": [r"strcpy|strcat|sprintf|gets\(", r"memcpy.*len.*\+", "buffer.*overflow", "stack.*smash"],
    "use_after_free": [r"free\(([^)]+)\)[\s\S]*?\1", r"delete\s+(\w+)[\s\S]*?\1", "pointer.*after.*free", "dangling.*pointer"],
    "integer_overflow": [r"\+\s*\+.*\*", r"\*\s*\*.*\+", r"malloc.*\+.*\+", "size.*overflow"],
    "race_condition": ["check.*then.*act", "time.*of.*check.*time.*of.*use", "toctou", "race.*condition"],
    "null_dereference": [r"->.*\?", r"\*\s*[a-z_]+\s*\?", "null.*dereference", r"if\s*\(([^)]+)\)\s*\1"],
    "memory_leak": ["malloc.*without.*free", "new.*without.*delete", "realloc.*leak", "leak.*memory"],
    "double_free": [r"free\(([^)]+)\)[\s\S]*?free\(\1\)", "delete.*delete", "double.*free"],
    "auth_bypass": ["auth.*bypass", "permission.*check.*missing", "access.*control.*bypass", "role.*check.*missing"],
    "injection": [r"exec\(", r"system\(", r"eval\(", r"\.format\(", r"""f["'].*\{.*\}"""],
    "sql_injection": [r"SELECT.*\+", "query.*format", r"execute.*\+", "union.*select"],
    "reentrancy": ["call.*before.*update", "external.*call.*state.*change", "reentrancy", "checks.*effects.*interactions"],
    "ffi_boundary": ['extern.*"C"', r"#[repr\(C\)]", "from.*ffi", r"ctypes\.", "unsafe.*block"],
    "cross_language": ["jni.*call", "native.*method", "interop", "cross.*language"],
    "wasm_runtime": ["wasm.*memory", "linear.*memory", "wasm.*instantiate", "memory.*grow"],
    "solidity_native": [r"call\.delegatecall", "extcodesize", "selfdestruct", "delegate.*call"],
}
# Classes that are taken as they are.
KNOWN = [
    "buffer_overflow", "use_after_free", "integer_overflow", "race_condition", "null_dereference", "memory_leak", "double_free", "type_confusion", "auth_bypass", "injection", "xss", "csrf",
    "sql_injection", "command_injection", "reentrancy", "logic_error", "configuration_error", "crypto_error", "ffi_boundary", "cross_language", "wasm_runtime", "solidity_native",
]
# Words of a described bug, tried in this order where its class is none of these: all words of a list, of one of the lists.
DESCRIBED = [
    ("buffer_overflow", [["buffer", "overflow"]]), ("use_after_free", [["use after free"]]), ("integer_overflow", [["integer", "overflow"]]), ("race_condition", [["race"]]),
    ("null_dereference", [["null", "dereference"]]), ("injection", [["injection"]]), ("reentrancy", [["reentrancy"]]), ("ffi_boundary", [["ffi"], ["extern"]]),
    ("wasm_runtime", [["wasm"]]), ("solidity_native", [["solidity"], ["delegatecall"]]),
]
