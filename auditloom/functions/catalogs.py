"""Fixed catalogs as literal rows. They are small, of constant size, and joined by broadcast."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

# Names, mappings, patterns and thresholds that results depend on.

BUG_CLASSES = ["memory_corruption", "integer_overflow", "race_condition", "auth_bypass", "deserialization", "type_confusion", "signature_malleability", "account_confusion", "oracle_manipulation", "reentrancy", "logic_error"]

CWES = ["CWE-119", "CWE-120", "CWE-125", "CWE-190", "CWE-362", "CWE-367", "CWE-20", "CWE-79", "CWE-89", "CWE-352", "CWE-400", "CWE-502", "CWE-287", "CWE-476", "CWE-522", "CWE-787", "CWE-295", "CWE-296", "CWE-297", "CWE-326", "CWE-523", "CWE-649"]

RISK_CLASS = {"data_handling": "memory_corruption", "input_validation": "integer_overflow", "concurrency": "race_condition", "authentication": "auth_bypass", "serialization": "deserialization", "type_safety": "type_confusion", "signature": "signature_malleability", "account": "account_confusion", "oracle": "oracle_manipulation"}

THREAT_CLASS = {"buffer_overflow": "memory_corruption", "integer_overflow": "integer_overflow", "race_condition": "race_condition", "auth_bypass": "auth_bypass", "injection": "deserialization", "type_confusion": "type_confusion", "reentrancy": "reentrancy", "logic": "logic_error"}

CLASS_ATTACK = {
    "memory_corruption": ["T1203", "T1068", "T1211"],
    "integer_overflow": ["T1203", "T1068", "T1496"],
    "race_condition": ["T1203", "T1068", "T1565"],
    "auth_bypass": ["T1078", "T1552", "T1098", "T1550"],
    "deserialization": ["T1203", "T1059", "T1505"],
    "type_confusion": ["T1203", "T1211"],
    "signature_malleability": ["T1550", "T1078", "T1565"],
    "account_confusion": ["T1078", "T1098", "T1550"],
    "oracle_manipulation": ["T1565", "T1499"],
    "reentrancy": ["T1499", "T1565", "T1496"],
    "logic_error": ["T1203", "T1565", "T1499"],
}

CWE_ATTACK = {
    "CWE-119": ["T1203", "T1068"], "CWE-120": ["T1203", "T1068"], "CWE-121": ["T1203", "T1068"], "CWE-122": ["T1203", "T1068"],
    "CWE-125": ["T1203", "T1068", "T1211"], "CWE-190": ["T1203", "T1068", "T1496"], "CWE-191": ["T1203", "T1068", "T1496"],
    "CWE-362": ["T1203", "T1068", "T1565"], "CWE-367": ["T1203", "T1068", "T1565"], "CWE-20": ["T1203", "T1190", "T1210"],
    "CWE-78": ["T1059", "T1203"], "CWE-79": ["T1189", "T1190"], "CWE-89": ["T1190", "T1098"], "CWE-94": ["T1059", "T1203"],
    "CWE-287": ["T1078", "T1552", "T1550"], "CWE-306": ["T1078", "T1098"], "CWE-352": ["T1189", "T1098"], "CWE-400": ["T1499", "T1496"],
    "CWE-502": ["T1203", "T1059", "T1505"], "CWE-522": ["T1552", "T1078"], "CWE-732": ["T1098", "T1078"], "CWE-798": ["T1552", "T1078"],
    "CWE-918": ["T1190", "T1210"], "CWE-476": ["T1203", "T1499"], "CWE-416": ["T1203", "T1068"], "CWE-772": ["T1499", "T1496"],
    "CWE-835": ["T1499", "T1496"], "CWE-295": ["T1552.004", "T1550", "T1078"], "CWE-296": ["T1078", "T1550", "T1552.004"],
    "CWE-297": ["T1078", "T1552.004", "T1190"], "CWE-326": ["T1552.004", "T1040", "T1550"], "CWE-523": ["T1552.004", "T1078", "T1098"],
    "CWE-649": ["T1552.004", "T1550", "T1078"],
}

# Where a CWE was listed more than once, the last entry is the one in force.
CWE_D3FEND = {
    "CWE-119": ["D3-MSI", "DMSA"], "CWE-120": ["D3-MSA", "D3-MSI"], "CWE-125": ["D3-MSI", "DMSA"], "CWE-787": ["D3-MSI", "DMSA"],
    "CWE-190": ["D3-MSI", "DMSA"], "CWE-362": ["D3-MSI", "DMSA"], "CWE-367": ["D3-MSI", "DMSA"], "CWE-20": ["D-MSI", "DMSA"],
    "CWE-79": ["D3-MSI", "DMSA"], "CWE-89": ["D-MSI", "DMSA"], "CWE-352": ["D-MSI", "DMSA"], "CWE-400": ["D-MSI", "DMSA"],
    "CWE-502": ["D3-MSI", "DMSA"], "CWE-287": ["D-MSI", "DMSA"], "CWE-476": ["D3-MSI", "DMSA"], "CWE-522": ["D3-MSI", "DMSA"],
    "CWE-295": ["D3-CBAN", "D3-CP", "D3-CA"], "CWE-296": ["D3-CBAN", "D3-TBA", "D3-AA"], "CWE-297": ["D3-CBAN", "D3-CA", "D3-ACA"],
    "CWE-326": ["D3-CBAN", "D3-MENCR", "D3-CP"], "CWE-523": ["D3-CBAN", "D3-CP", "D3-CERO"], "CWE-649": ["D3-CBAN", "D3-MFA", "D3-TB"],
}

CLASS_D3FEND = {
    "memory_corruption": ["D3-SCH", "D3-AH", "D3-MA"], "race_condition": ["D3-SCH", "D3-MA", "D3-EI"], "auth_bypass": ["D3-CH", "D3-AH", "D3-NTA"],
    "integer_overflow": ["D3-SCH", "D3-MA"], "deserialization": ["D3-SCH", "D3-AH", "D3-PA"], "type_confusion": ["D3-SCH", "D3-MA"],
    "reentrancy": ["D3-SCH", "D3-MA"], "oracle_manipulation": ["D3-AH", "D3-NTA"], "account_confusion": ["D3-CH", "D3-AH"],
}
CLASS_D3FEND_DEFAULT = ["D3-SCH", "D3-AH"]

CONTROLS = {
    "ISO_27001": {"A.12.6.1": ["D3-SCH", "D3-AH", "D3-MA"], "A.16.1.1": ["D3-PA", "D3-NTA"], "A.18.2.2": ["D3-CH", "D3-MFA"], "A.9.4.1": ["D3-CH", "D3-AH"], "A.10.1.1": ["D3-MH", "D3-MENCR"]},
    "HIPAA": {"164.312(a)(1)": ["D3-CH", "D3-AH", "D3-MFA"], "164.312(b)": ["D3-MH", "D3-MENCR"], "164.312(c)(1)": ["D3-FE", "D3-DENCR"], "164.312(d)": ["D3-MAN", "D3-TAAN"], "164.312(e)(1)": ["D3-MENCR", "D3-ET"]},
    "PCI_DSS": {"Req 6.5": ["D3-SCH", "D3-AH", "D3-MA"], "Req 8.2": ["D3-CH", "D3-MFA", "D3-PWA"], "Req 10.2": ["D3-PA", "D3-NTA"], "Req 11.3.2": ["D3-NVA", "D3-SYSVA"], "Req 12.10.1": ["D3-PA", "D3-NTA"]},
    "GDPR": {"Art 25": ["D3-SCH", "D3-AH", "D3-MA"], "Art 32": ["D3-FE", "D3-DENCR", "D3-MENCR"], "Art 33": ["D3-PA", "D3-NTA"], "Art 35": ["D3-NVA", "D3-SYSVA"]},
    "SOC_2": {"CC6.1": ["D3-CH", "D3-AH", "D3-MFA"], "CC6.2": ["D3-SCP", "D3-UAP"], "CC6.6": ["D3-FE", "D3-DENCR"], "CC7.2": ["D3-SYSVA", "D3-NVA"], "CC7.3": ["D3-PA", "D3-NTA"]},
    "NIST_800_53": {"AC-3": ["D3-CH", "D3-AH"], "AU-6": ["D3-PA", "D3-NTA"], "CM-4": ["D3-SCH", "D3-AH"], "IR-4": ["D3-PA", "D3-NTA"], "RA-5": ["D3-NVA", "D3-SYSVA"], "SC-13": ["D3-MENCR", "D3-FE"]},
}

SERVICES = ["apache", "nginx", "tomcat", "iis", "mongodb", "mysql", "postgresql", "redis", "elasticsearch", "docker", "kubernetes", "ssh", "telnet", "ftp", "smtp", "vpn", "rdp", "vnc", "jenkins", "gitlab", "grafana", "prometheus"]
CLASS_SERVICE = {"sql-injection": "mysql", "xss": "nginx", "command-injection": "ssh", "path-traversal": "nginx", "buffer-overflow": "apache"}

HOST_MULTIPLIER = {"buffer-overflow": 1.3, "use-after-free": 1.2, "race-condition": 1.1, "auth-bypass": 1.4, "integer-overflow": 1.2, "reentrancy": 1.3, "oracle-manipulation": 1.2}

EXPOSURE = {"tvl": (0.3, 1e9), "transaction_volume": (0.25, 1e7), "active_addresses": (0.15, 1e5), "dependents": (0.15, 1e3), "price_impact": (0.1, 100.0), "liquidity_depth": (0.05, 1e7)}
SEVERITY_RANGE = {"critical": (9.0, 10.0), "high": (7.0, 8.9), "medium": (4.0, 6.9), "low": (0.1, 3.9)}
UNKNOWN_EXPOSURE = 10.0

COMMIT_WORDS = ["cve", "vulnerability", "security", "fix", "patch", "exploit", "buffer overflow", "integer overflow", "race condition", "use-after-free", "double free", "null pointer", "injection"]
REASONING_WORDS = ["because", "since", "therefore", "however", "although", "evidence", "precondition", "feasible", "mitigating"]

SENSITIVE = [
    ("credentials", "Hardcoded password", r"""password\s*=\s*["'][^"']+["']"""),
    ("credentials", "Hardcoded API key", r"""api_key\s*=\s*["'][^"']+["']"""),
    ("credentials", "Hardcoded secret", r"""secret\s*=\s*["'][^"']+["']"""),
    ("credentials", "AWS access key", r"""AWS_ACCESS_KEY_ID\s*=\s*["'][^"']+["']"""),
    ("credentials", "AWS access key ID pattern", r"AKIA[0-9A-Z]{16}"),
    ("credentials", "GitHub personal access token", r"ghp_[a-zA-Z0-9]{36}"),
    ("pii", "SSN pattern", r"\b\d{3}-\d{2}-\d{4}\b"),
    ("pii", "Credit card number", r"\b\d{4}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"),
    ("pii", "Email address", r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"),
    ("chd", "Visa card number", r"\b4\d{3}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"),
    ("chd", "Mastercard number", r"\b5[1-5]\d{2}[\s-]?\d{4}[\s-]?\d{4}[\s-]?\d{4}\b"),
]

PATCH_WORDS = {"buffer_overflow": ["buffer", "overflow"], "integer_overflow": ["integer"], "race_condition": ["race"], "use_after_free": ["use-after-free"], "null_pointer": ["null"]}

TAINT_SOURCES = {"user_input": [r"input\s*\(", r"sys\.argv", r"os\.environ", r"request\.args"], "network": [r"urllib\.request", r"requests\.get", r"socket\.recv"], "file": [r"open\s*\(", r"with open\s*\(", r"json\.load"]}
TAINT_SINKS = {"sql_query": [r"execute\s*\(", r"cursor\.execute"], "command_execution": [r"os\.system", r"subprocess\."], "code_eval": [r"eval\s*\(", r"exec\s*\("]}
SANITIZERS = [r"\.strip\s*\(", r"\.lower\s*\(", r"\.upper\s*\(", r"re\.sub\s*\(", r"replace\s*\(", "validate", "sanitize", "escape", "clean"]
FLOW_CLASS = {
    ("user_input", "sql_query"): "SQL Injection", ("user_input", "command_execution"): "Command Injection", ("user_input", "code_eval"): "Code Injection",
    ("network", "sql_query"): "Second-Order SQL Injection", ("network", "command_execution"): "Remote Code Execution", ("network", "code_eval"): "Remote Code Execution",
    ("file", "sql_query"): "File-based SQL Injection", ("file", "command_execution"): "Command Injection from File",
}

OWNERS = [("kernel", "Kernel Security"), ("driver", "Driver Security"), ("hyper-v", "Hyper-V Security"), ("hyperv", "Hyper-V Security"), ("azure", "Azure Security"), ("net", "Networking Security"), ("crypto", "Crypto Security")]
SLA_HOURS = {"critical": 24, "high": 72, "medium": 168, "low": 720}


def frame(spark: SparkSession, ddl: str, rows: Iterable[tuple]) -> DataFrame:
    return spark.createDataFrame(list(rows), ddl)


def listed(catalog: dict[str, list[str]]) -> list[tuple[str, int, str]]:
    """(key, ordinal, value) of a catalog of lists."""
    return [(k, i, v) for k, vs in catalog.items() for i, v in enumerate(vs)]


def values_sql(rows: Iterable[tuple], columns: str, name: str = "c") -> str:
    """Literal rows as SQL."""
    def cell(x) -> str:
        return "'" + x.replace("'", "''") + "'" if isinstance(x, str) else repr(x)

    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + f") {name}({columns})"


# Words and tactics by which a catalog is searched for a weakness, and what to do against an attack's tactic.
CWE_KEYWORDS = {
    "CWE-119": ["buffer", "bounds", "memory", "validate"], "CWE-120": ["buffer", "overflow", "memory", "validate"], "CWE-121": ["stack", "buffer", "overflow"], "CWE-122": ["heap", "buffer", "overflow"],
    "CWE-125": ["out-of-bounds", "memory", "read"], "CWE-190": ["integer", "overflow", "wrap", "validate"], "CWE-191": ["integer", "underflow", "wrap"], "CWE-362": ["race", "condition", "concurrency", "thread"],
    "CWE-367": ["time-of-check", "time-of-use", "race"], "CWE-20": ["input", "validation", "sanitize"], "CWE-78": ["command", "injection", "shell", "os"], "CWE-79": ["cross-site", "xss", "scripting", "sanitize"],
    "CWE-89": ["sql", "injection", "query", "parameterize"], "CWE-94": ["code", "injection", "eval", "dynamic"], "CWE-287": ["authentication", "credential", "identity"], "CWE-306": ["authentication", "missing", "credential"],
    "CWE-352": ["cross-site", "forgery", "csrf", "token"], "CWE-400": ["resource", "exhaustion", "denial", "rate"], "CWE-502": ["deserialization", "untrusted", "marshal"], "CWE-522": ["credential", "password", "storage", "hash"],
    "CWE-732": ["permission", "authorization", "access"], "CWE-798": ["hardcoded", "credential", "password"], "CWE-918": ["server-side", "request", "ssrf", "forgery"], "CWE-476": ["null", "pointer", "dereference", "reference"],
    "CWE-416": ["use-after-free", "memory", "dangling"], "CWE-772": ["resource", "leak", "memory", "unreachable"], "CWE-835": ["infinite", "loop", "resource", "exhaustion"], "CWE-295": ["certificate", "validation", "trust", "identity", "authentication"],
    "CWE-296": ["certificate", "authentication", "identity", "bypass"], "CWE-297": ["certificate", "validation", "spoofing", "man-in-middle"], "CWE-326": ["encryption", "key", "strength", "cryptography", "weak"],
    "CWE-523": ["certificate", "transmission", "exposure", "credential"], "CWE-649": ["reliance", "obfuscation", "authentication", "crypto"],
}
CWE_TACTICS = {
    "CWE-119": ["Harden"], "CWE-120": ["Harden"], "CWE-125": ["Harden"], "CWE-190": ["Harden"], "CWE-362": ["Harden", "Isolate"], "CWE-20": ["Harden", "Detect"], "CWE-78": ["Harden", "Detect"], "CWE-79": ["Harden", "Detect"],
    "CWE-89": ["Harden", "Detect"], "CWE-287": ["Harden"], "CWE-306": ["Harden"], "CWE-400": ["Harden", "Detect"], "CWE-502": ["Harden", "Detect"], "CWE-522": ["Harden"], "CWE-476": ["Harden"], "CWE-416": ["Harden"],
    "CWE-295": ["Harden", "Detect"], "CWE-296": ["Harden"], "CWE-297": ["Harden", "Detect"], "CWE-326": ["Harden"], "CWE-523": ["Harden", "Isolate"], "CWE-649": ["Harden"],
}
DEFAULT_TACTICS = ["Harden", "Detect"]
COUNTERMEASURES = {
    "Execution": ["Implement application allowlisting (D3FEND: Application Control)"],
    "Privilege Escalation": ["Enforce principle of least privilege (D3FEND: Privilege Restriction)", "Monitor for anomalous privilege usage"],
    "Defense Evasion": ["Enable comprehensive logging and tamper protection", "Deploy behavioral detection for obfuscated execution"],
    "Credential Access": ["Use hardware security modules for credential storage", "Implement multi-factor authentication"],
    "Initial Access": ["Harden public-facing interfaces (D3FEND: Attack Surface Reduction)", "Deploy Web Application Firewall with known exploit signatures"],
    "Impact": ["Implement rate limiting and resource quotas", "Deploy automated rollback for integrity violations"],
    "Persistence": ["Monitor for unauthorized software installations", "Verify integrity of critical binaries at startup"],
}

# What the agents' path binds a class to, and what it takes where the class is unknown.
AGENT_ANALYTICS = {
    "buffer-overflow": ["pattern-matching", "static-analysis", "sanitizer"], "use-after-free": ["static-analysis", "sanitizer", "taint-analysis"], "race-condition": ["static-analysis", "dynamic-analysis", "sanitizer"],
    "auth-bypass": ["pattern-matching", "static-analysis", "access-control-audit"], "integer-overflow": ["static-analysis", "sanitizer", "symbolic-execution"], "deserialization": ["static-analysis", "pattern-matching", "taint-analysis"],
    "type-confusion": ["static-analysis", "type-checking", "sanitizer"], "sql-injection": ["pattern-matching", "static-analysis", "taint-analysis"], "xss": ["pattern-matching", "static-analysis", "taint-analysis"],
    "path-traversal": ["pattern-matching", "static-analysis", "access-control-audit"], "reentrancy": ["static-analysis", "symbolic-execution", "formal-verification"], "oracle-manipulation": ["static-analysis", "data-flow-analysis", "formal-verification"],
    "account-confusion": ["static-analysis", "access-control-audit", "pattern-matching"], "arithmetic-overflow": ["static-analysis", "sanitizer", "symbolic-execution"], "irp-flaw": ["static-analysis", "pattern-matching", "formal-verification"],
    "vm-escape": ["static-analysis", "formal-verification", "access-control-audit"],
}
AGENT_DEFENCES = {
    "buffer-overflow": ["D3-SCH", "D3-AH", "D3-MA"], "use-after-free": ["D3-SCH", "D3-MA", "D3-PA"], "race-condition": ["D3-SCH", "D3-MA", "D3-EI"], "auth-bypass": ["D3-CH", "D3-AH", "D3-NTA"],
    "integer-overflow": ["D3-SCH", "D3-MA"], "deserialization": ["D3-SCH", "D3-AH", "D3-PA"], "type-confusion": ["D3-SCH", "D3-MA"], "sql-injection": ["D3-AH", "D3-NTA"], "xss": ["D3-AH", "D3-NTA"],
    "path-traversal": ["D3-AH", "D3-MA"], "reentrancy": ["D3-SCH", "D3-MA"], "oracle-manipulation": ["D3-AH", "D3-NTA"], "account-confusion": ["D3-CH", "D3-AH"], "arithmetic-overflow": ["D3-SCH", "D3-MA"],
    "irp-flaw": ["D3-SCH", "D3-MA", "D3-EI"], "vm-escape": ["D3-EI", "D3-MA", "D3-NI"],
}
AGENT_ATTACKS = {
    "buffer-overflow": ["T1203", "T1068"], "use-after-free": ["T1203", "T1068"], "race-condition": ["T1203", "T1499"], "auth-bypass": ["T1078", "T1552"], "integer-overflow": ["T1203"], "deserialization": ["T1203", "T1059"],
    "type-confusion": ["T1203", "T1068"], "sql-injection": ["T1190"], "xss": ["T1189", "T1059"], "path-traversal": ["T1083", "T1041"], "reentrancy": ["T1649"], "oracle-manipulation": ["T1649"], "account-confusion": ["T1078"],
    "arithmetic-overflow": ["T1203"], "irp-flaw": ["T1068", "T1203"], "vm-escape": ["T1565", "T1203"],
}
AGENT_DEFAULTS = (["static-analysis", "pattern-matching"], ["D3-SCH", "D3-AH"], ["T1203"])
