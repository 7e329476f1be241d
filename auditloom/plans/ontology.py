"""Technique hierarchies, techniques by the first source that answers, recommendations."""

from __future__ import annotations

from pyspark.sql import functions as F

from auditloom.functions.catalogs import COUNTERMEASURES, CWE_D3FEND, CWE_KEYWORDS, CWE_TACTICS, DEFAULT_TACTICS, frame, listed, values_sql
from auditloom.operators import ontology
from auditloom.plans.registry import register
from auditloom.sources.bindings import domain, with_sql


def _parents(s, d):
    h = domain(s, d, "hierarchy")
    return h.select(F.col("technique_id").alias("node"), F.explode(F.array("parent", "other")).alias("parent"))


PARENTS = {"par": "SELECT technique_id AS node, parent FROM hierarchy WHERE parent <> technique_id UNION SELECT technique_id, other FROM hierarchy WHERE other <> technique_id"}
CLOSURE = PARENTS | {
    "up": "SELECT node, parent AS ancestor, 1 AS depth FROM par UNION SELECT up.node, par.parent, up.depth + 1 FROM up JOIN par ON up.ancestor = par.node",
    "anc": "SELECT node, ancestor, CAST(min(depth) AS INT) AS depth FROM up GROUP BY 1, 2",
}
recursive = lambda q: q.replace("WITH ", "WITH RECURSIVE ", 1)
register("technique_ancestors", lambda s, d: ontology.ancestors(_parents(s, d)), recursive(with_sql(["hierarchy"], "SELECT * FROM anc", **CLOSURE)))
register(
    "tactic_subtrees",
    lambda s, d: ontology.subtree_tactics(ontology.ancestors(_parents(s, d)), domain(s, d, "hierarchy")),
    recursive(with_sql(["hierarchy"], "SELECT ancestor, coalesce(tactic, 'unknown') AS tactic, count(*) AS n, max(depth) AS deepest FROM anc JOIN hierarchy ON technique_id = node GROUP BY ALL", **CLOSURE)),
)


def _cascade(s, d):
    pairs = lambda table, value: frame(s, f"cwe_id string, o int, {value} string", listed(table)).drop("o")
    return ontology.cwe_techniques(
        domain(s, d, "findings"), domain(s, d, "catalog"), pairs(CWE_KEYWORDS, "keyword"), pairs(CWE_TACTICS, "tactic"), DEFAULT_TACTICS, domain(s, d, "ontology_known"), domain(s, d, "ontology_map"), pairs(CWE_D3FEND, "technique")
    )


CASCADE = {
    "cw": "SELECT DISTINCT cwe_id FROM findings",
    "kw": "SELECT cwe_id, technique_id FROM cw JOIN " + values_sql(listed(CWE_KEYWORDS), "c, o, w", "k") + r" ON c = upper(cwe_id) JOIN catalog ON list_contains(list_transform(regexp_split_to_array(lower(concat_ws(' ', technique_id, tactic, technique, level_0, level_1, definition)), '\s+'), lambda x: trim(x, '.,;:''' || chr(34))), w) WHERE length(w) >= 4",
    "hi": "SELECT cwe_id, t FROM cw JOIN " + values_sql(listed(CWE_TACTICS), "c, o, t", "k") + " ON c = upper(cwe_id) UNION ALL SELECT cwe_id, unnest([" + ", ".join(f"'{t}'" for t in DEFAULT_TACTICS) + "]) FROM cw WHERE upper(cwe_id) NOT IN (" + ", ".join(f"'{k}'" for k in CWE_TACTICS) + ")",
    "ta": "SELECT cwe_id, technique_id FROM hi JOIN catalog ON tactic = t WHERE cwe_id NOT IN (SELECT cwe_id FROM kw)",
    "onto": "SELECT m.cwe_id, m.technique_id FROM cw JOIN ontology_map m ON m.cwe_id = cw.cwe_id WHERE m.technique_id IN (SELECT technique_id FROM ontology_known) AND cw.cwe_id NOT IN (SELECT cwe_id FROM kw UNION SELECT cwe_id FROM ta)",
    "fo": "SELECT DISTINCT *, 'keyword' AS source FROM kw UNION ALL SELECT DISTINCT *, 'tactic' FROM ta UNION ALL SELECT DISTINCT *, 'ontology' FROM onto",
    "casc": "SELECT * FROM fo UNION ALL SELECT DISTINCT cwe_id, v, 'list' FROM cw JOIN " + values_sql(listed(CWE_D3FEND), "k, o, v", "a") + " ON k = cwe_id WHERE NOT EXISTS (SELECT 1 FROM fo WHERE fo.cwe_id = cw.cwe_id AND technique_id = v)",
}
SOURCES = ["findings", "catalog", "ontology_map", "ontology_known"]
register("cwe_cascade", _cascade, with_sql(SOURCES, "SELECT * FROM casc", **CASCADE))
register(
    "finding_defences",
    lambda s, d: domain(s, d, "findings").select("finding_id", "cwe_id").join(_cascade(s, d).groupBy("cwe_id").agg(F.count("*").alias("n"), F.count_if(F.col("source") == "list").alias("listed"), F.min("technique_id").alias("first")), "cwe_id"),
    with_sql(SOURCES, "SELECT cwe_id, finding_id, n, listed, \"first\" FROM findings JOIN (SELECT cwe_id, count(*) AS n, count(*) FILTER (source = 'list') AS listed, min(technique_id) AS \"first\" FROM casc GROUP BY 1) USING (cwe_id)", **CASCADE),
)


def _recommended(s, d):
    t = domain(s, d, "attack_tactics")
    attacks = t.select("finding_id", F.posexplode(F.array("one", "two")).alias("ordinal", "tactic"))
    texts = frame(s, "tactic string, place int, text string", listed(COUNTERMEASURES))
    return ontology.recommendations(attacks, t.select("finding_id", "technique_id", "label", "tactic", F.lit(0).alias("ordinal")), texts)


register(
    "defensive_recommendations",
    _recommended,
    with_sql(
        ["attack_tactics"],
        "SELECT finding_id, CAST(row_number() OVER (PARTITION BY finding_id ORDER BY a.part, a.o, a.p) AS INT) AS place, text FROM (SELECT finding_id, text, min({'part': part, 'o': o, 'p': p}) AS a FROM re GROUP BY finding_id, text)",
        asked="SELECT finding_id, 0 AS o, one AS t FROM attack_tactics UNION ALL SELECT finding_id, 1, two FROM attack_tactics",
        re="SELECT finding_id, 0 AS part, asked.o AS o, k.o AS p, text FROM asked JOIN " + values_sql(listed(COUNTERMEASURES), "tactic, o, text", "k") + " ON tactic = t UNION ALL SELECT finding_id, 1, 0, 0, 'Apply D3FEND technique ' || technique_id || ': ' || label || ' (' || tactic || ' tactic)' FROM attack_tactics",
    ),
)
