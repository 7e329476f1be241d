"""Classes of patches and of described bugs."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.patch_rules import DESCRIBED, KNOWN, PATCH_CLASSES
from auditloom.operators import patches
from auditloom.plans.registry import register
from auditloom.sources.bindings import domain, with_sql

# SQL has no references to groups; the pointers of the table are p and q, so these patterns are written out for both.
WRITTEN = {
    r"free\(([^)]+)\)[\s\S]*?\1": r"free\(p\)[\s\S]*?p|free\(q\)[\s\S]*?q", r"delete\s+(\w+)[\s\S]*?\1": r"delete\s+q[\s\S]*?q",
    r"if\s*\(([^)]+)\)\s*\1": r"if\s*\(p\)\s*p|if\s*\(q\)\s*q", r"free\(([^)]+)\)[\s\S]*?free\(\1\)": r"free\(p\)[\s\S]*?free\(p\)|free\(q\)[\s\S]*?free\(q\)",
}
plain = lambda p: "(?i)" + WRITTEN.get(p, p).replace("'", "''")
BEST = {
    "tx": "SELECT *, lower(concat_ws(' ', coalesce(description, ''), coalesce(pre, ''), coalesce(post, ''))) AS text FROM patches",
    "sc": "SELECT *, list_max([" + ", ".join("{'s': " + " + ".join(f"len(regexp_extract_all(text, '{plain(p)}'))" for p in ps) + f", 'o': {-i}, 'c': '{k}'}}" for i, (k, ps) in enumerate(PATCH_CLASSES.items())) + "]) AS b FROM tx",
    "best": "SELECT patch_id, b.c AS bug_class, CAST(b.s AS INT) AS score, pre FROM sc",
}
register("patch_class_score", lambda s, d: patches.classify(domain(s, d, "patches").drop("bug_class")).select("patch_id", "bug_class", "score"), with_sql(["patches"], "SELECT patch_id, bug_class, score FROM best", **BEST))
# Around a match: what stands before it are the pieces between matches and the matches before.
AROUND = " UNION ALL ".join(
    f"SELECT patch_id, {i} AS rule, pre, regexp_extract_all(pre, '{plain(p)}') AS m, string_split_regex(pre, '{plain(p)}') AS s FROM best WHERE bug_class = '{k}'" for k, ps in PATCH_CLASSES.items() for i, p in enumerate(ps)
)
register(
    "patch_contexts",
    lambda s, d: patches.contexts(patches.classify(domain(s, d, "patches").drop("bug_class"))),
    with_sql(
        ["patches"],
        "SELECT patch_id, CAST(place AS INT) AS place, context FROM (SELECT patch_id, row_number() OVER (PARTITION BY patch_id ORDER BY rule, n) AS place, regexp_replace(substr(pre, greatest(0, pos - 50) + 1, pos + len(m[n]) + 50 - greatest(0, pos - 50)), '^\\s+|\\s+$', '', 'g') AS context FROM pl) WHERE place <= 5",
        **BEST,
        mm=AROUND,
        nn="SELECT *, unnest(range(1, len(m) + 1)) AS n FROM mm",
        pl="SELECT *, CAST(list_sum(list_transform(s[1:n], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:(n - 1)], lambda x: len(x))), 0) AS INT) AS pos FROM nn",
    ),
)
register(
    "described_class",
    lambda s, d: domain(s, d, "patches").select("patch_id", patches.described_class(F.col("bug_class"), F.col("description")).alias("bug_class")),
    with_sql(
        ["patches"],
        f"SELECT patch_id, CASE WHEN bug_class IN ({', '.join(repr(k) for k in KNOWN)}) THEN bug_class "
        + " ".join("WHEN " + " OR ".join("(" + " AND ".join(f"lower(description) LIKE '%{w}%'" for w in ws) + ")" for ws in lists) + f" THEN '{k}'" for k, lists in DESCRIBED)
        + " ELSE 'logic_error' END AS bug_class FROM patches",
    ),
)
