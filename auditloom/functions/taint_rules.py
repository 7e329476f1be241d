"""Fixed rules of tainted data by language."""

# Patterns of sources, sinks and native markers, and the class of a flow.

SOURCES = {
    "python": {
        "user_input": [r"input\s*\(", r"sys\.argv", r"os\.environ", r"request\.args", r"request\.form", r"request\.json", r"flask\.request"],
        "network": [r"urllib\.request", r"requests\.get", r"httpx\.get", r"aiohttp\.get", r"socket\.recv"],
        "file": [r"open\s*\(", r"with open\s*\(", r"Path\.read_text", r"json\.load"],
    },
    "rust": {"user_input": [r"stdin\(\)", r"env::var", r"args\(\)"], "network": [r"reqwest::get", r"ureq::get", r"hyper::get"], "file": [r"File::open", r"std::fs::read_to_string"]},
    "javascript": {
        "user_input": [r"prompt\s*\(", r"process\.argv", r"process\.env", r"""require\(["']body-parser["']\)"""],
        "network": [r"fetch\s*\(", r"axios\.get", r"XMLHttpRequest", r"WebSocket"],
        "file": [r"fs\.readFileSync", r"fs\.readFile", r"""require\(["']fs["']\)"""],
    },
    "go": {"user_input": [r"fmt\.Scan", r"os\.Args", r"os\.Getenv"], "network": [r"http\.Get", r"net/http\.Get"], "file": [r"ioutil\.ReadFile", r"os\.Open"]},
}
SINKS = {
    "python": {
        "sql_query": [r"cursor\.execute", r"cursor\.executemany", r"\.execute\s*\(", r"sqlite3\.execute"],
        "command_execution": [r"subprocess\.(call|run|Popen)", r"os\.system", r"eval\s*\(", r"exec\s*\("],
        "file_write": [r"\.write\s*\(", r"\.writelines\s*\(", r"""open\s*\([^)]*,\s*["']w["']"""],
        "network_send": [r"requests\.(post|put|patch)", r"urllib\.request\.urlopen", r"socket\.send"],
    },
    "rust": {"sql_query": [r"conn\.execute", r"query\.execute"], "command_execution": [r"Command::new", r"std::process::Command::new"], "file_write": [r"File::create", r"std::fs::write"], "memory_write": [r"ptr::write", r"std::ptr::write"]},
    "javascript": {
        "sql_query": [r"query\.(exec|execute)", r"db\.query"], "command_execution": [r"child_process\.(exec|spawn)", r"eval\s*\(", r"Function\s*\("],
        "file_write": [r"fs\.writeFileSync", r"fs\.writeFile"], "code_eval": [r"eval\s*\(", r"new Function"],
    },
    "go": {"sql_query": [r"db\.Exec", r"query\.Exec"], "command_execution": [r"exec\.Command", r"os/exec\.Command"], "file_write": [r"ioutil\.WriteFile"]},
}
NATIVE = {
    "python": [r"ctypes\.", r"cffi\.", "pybind11", "swig"],
    "rust": ['extern "C"', r"#\[no_mangle\]", r"unsafe\s+fn", "libc::", "winapi::"],
    "javascript": [r"WebAssembly\.", r"wasm\.", r"FFI\.", r"N-API\."],
    "go": ['import "C"', "//extern", "#cgo"],
}
FLOW_CLASSES = {
    ("user_input", "sql_query"): "SQL Injection", ("user_input", "command_execution"): "Command Injection", ("user_input", "file_write"): "Path Traversal", ("user_input", "code_eval"): "Code Injection",
    ("network", "sql_query"): "Second-Order SQL Injection", ("network", "command_execution"): "Remote Code Execution", ("network", "code_eval"): "Remote Code Execution",
    ("file", "sql_query"): "File-based SQL Injection", ("file", "command_execution"): "Command Injection from File",
    ("database", "sql_query"): "Second-Order SQL Injection", ("database", "command_execution"): "Command Injection from DB",
    ("environment", "sql_query"): "Environment-based SQL Injection", ("environment", "command_execution"): "Environment-based Command Injection",
}
EXTENSION = {"python": "py", "rust": "rs", "javascript": "js", "go": "go"}
