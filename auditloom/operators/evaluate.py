"""Findings against labelled vulnerabilities."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auditloom.functions.cells import cell_join, spread
from auditloom.functions.storage import materialize
from auditloom.operators.graph import connected_components

TOLERANCE = 5
#: Rows of either side that meet in one cell of a hot base name and line bucket.
CELL = 1000
#: Sums of finding ids over pairs.
SUMS = "decimal(38,0)"


def file_and_line(location: Column) -> tuple[Column, Column]:
    """Up to the last colon, and the number after it (null if there is none)."""
    return F.regexp_extract(location, "^(.*):(.*)$", 1), F.regexp_extract(location, "^(.*):(.*)$", 2).try_cast("int")


def _sides(findings: DataFrame, truth: DataFrame, same_path: bool) -> tuple[DataFrame, DataFrame]:
    """Findings with name and line, labels with base and at (line); rows without a line are left out."""
    file, line = file_and_line(F.col("location"))
    last = file if same_path else F.substring_index(file, "/", -1)
    a = findings.select("*", last.alias("name"), line.alias("line")).filter("line is not null")
    return a, truth.select("*", last.alias("base"), line.alias("at")).filter("at is not null")


def _met_names(a: DataFrame, b: DataFrame, same_path: bool) -> DataFrame:
    """name, base: distinct names of findings and base names of labels that they end with; equal ones with same_path.

    A base name holds no slash, so it can only end the finding's own base name: distinct names of findings are met with those
    of labels by their suffixes."""
    names, bases = a.select("name").distinct(), b.select("base").distinct()
    if same_path:
        return names.join(bases, F.col("name") == F.col("base"))
    longest = F.broadcast(bases.agg(F.coalesce(F.max(F.length("base")), F.lit(0)).alias("longest")))  # one row
    starts = F.expr("sequence(greatest(1, length(name) - longest + 1), length(name) + 1)")
    ends = names.join(longest, F.lit(True)).select("name", F.explode(F.transform(starts, lambda i: F.col("name").substr(i, F.length("name")))).alias("base"))
    return ends.join(bases, "base").select("name", "base")


def _around(line: str, tolerance: int) -> Column:
    """The lines that are at most tolerance away, a row each."""
    at = F.col(line).cast("long")
    return F.explode(F.sequence(at - tolerance, at + tolerance))


def band_join(findings: DataFrame, truth: DataFrame, tolerance: int = TOLERANCE, same_path: bool = False) -> DataFrame:
    """Pairs whose lines are at most tolerance apart and where the finding's path ends with the base name (last part) of the
    labelled one, as equal paths do: an equality join on base name and line bucket. With same_path only equal paths match.

    Keys of many pairs are dealt into cells where every two rows meet once. Who asks only whether a row has a match, or how many
    pairs there are, does not need them listed: ``labels_met``, ``findings_met``, ``match_summary``."""
    width = tolerance + 1
    a, b = _sides(findings.select("finding_id", "location"), truth.select("vuln_id", "location"), same_path)
    b = b.select("vuln_id", "base", "at", F.expr(f"at div {width}").alias("bucket"))
    a = a.select("finding_id", "line", F.col("name").alias("base")) if same_path else a.join(_met_names(a, b, same_path), "name").select("finding_id", "line", "base")
    a = a.withColumn("bucket", F.explode(F.expr(f"array(line div {width} - 1, line div {width}, line div {width} + 1)")))
    met = cell_join(a, b, ["base", "bucket"], ["finding_id"], ["vuln_id"], CELL)
    return met.filter(F.abs(F.col("line").cast("long") - F.col("at")) <= tolerance).select("finding_id", "vuln_id", (F.col("line") - F.col("at")).alias("offset"))


def labels_met(findings: DataFrame, truth: DataFrame, tolerance: int = TOLERANCE, same_path: bool = False) -> DataFrame:
    """vuln_id of the labels that ``band_join`` pairs with any finding, from the distinct places of findings, without pairs."""
    a, b = _sides(findings.select("location"), truth.select("vuln_id", "location"), same_path)
    spots = a.select("name", "line").distinct().join(_met_names(a, b, same_path), "name").select("base", _around("line", tolerance).alias("at")).distinct()
    held = b.select("base", "at").distinct().join(spots, ["base", "at"], "left_semi")
    return b.join(held, ["base", "at"], "left_semi").select("vuln_id")


def findings_met(findings: DataFrame, truth: DataFrame, tolerance: int = TOLERANCE, same_path: bool = False) -> DataFrame:
    """finding_id of the findings that ``band_join`` pairs with any label, from the distinct places of labels, without pairs."""
    a, b = _sides(findings.select("finding_id", "location"), truth.select("location"), same_path)
    spots = b.select("base", "at").distinct().select("base", _around("at", tolerance).alias("line")).distinct()
    held = a.select("name", "line").distinct().join(_met_names(a, b, same_path), "name").join(spots, ["base", "line"], "left_semi").select("name", "line").distinct()
    return a.join(held, ["name", "line"], "left_semi").select("finding_id")


def _plain(c: str) -> Column:
    return F.regexp_replace(c, "[_-]", "")


def scored_pairs(findings: DataFrame, truth: DataFrame, same_path: bool = False) -> DataFrame:
    """finding_id, vuln_id, points (tenths: 5 same location or 3 within the band, 3 same CWE, 2 class in class) of 5 or more,
    match_type, both (same CWE and class), of pairs whose places agree: two equality joins, never all pairs.

    Pairs without a place that have CWE and class in common (5 points) grow with the product of a CWE's rows; they are not
    listed here but counted by ``match_summary``."""
    f = findings.select("finding_id", "location", F.upper("cwe_id").alias("cwe"), _plain("bug_class").alias("cls"))
    t = truth.select("vuln_id", F.col("location").alias("t_location"), F.upper("cwe_id").alias("t_cwe"), _plain("category").alias("t_cls"))
    near = band_join(findings, truth, same_path=same_path).select("finding_id", "vuln_id")
    exact = f.join(t, F.col("location") == F.col("t_location")).select("finding_id", "vuln_id")
    full = near.unionByName(exact).distinct().join(f, "finding_id").join(t, "vuln_id")
    place = F.when(F.col("location") == F.col("t_location"), 5).otherwise(3)
    cwe, cls = F.coalesce(F.col("cwe") == F.col("t_cwe"), F.lit(False)), _same_class()
    points = place + F.when(cwe, 3).otherwise(0) + F.when(cls, 2).otherwise(0)
    kind = F.when(F.col("points") >= 8, "exact").otherwise("fuzzy")
    return full.withColumn("points", points).withColumn("both", cwe & cls).filter("points >= 5").select("finding_id", "vuln_id", "points", kind.alias("match_type"), "both")


def _same_class() -> Column:
    return F.contains("cls", F.col("t_cls")) | F.contains(F.col("t_cls"), F.col("cls"))


def match_summary(findings: DataFrame, truth: DataFrame, same_path: bool = False) -> DataFrame:
    """match_type, points, n, ids (sum of finding ids) of all scored pairs, by products of group sizes: no pair is listed.

    Sums of ids are decimals of 38 digits, since over many pairs they pass 64 bits. Findings and labels are counted by place, CWE
    and class. Those near each other meet by base name and line, the findings of a group standing at all lines of its band; those
    at equal locations are taken out there and counted with their own points; those by CWE and class alone are all of these less
    the ones that have a place too."""
    f = findings.groupBy("location", F.upper("cwe_id").alias("cwe"), _plain("bug_class").alias("cls")).agg(F.count("*").alias("fn"), F.sum(F.col("finding_id").cast("decimal(20,0)")).alias("fids"))
    t = truth.groupBy("location", F.upper("cwe_id").alias("t_cwe"), _plain("category").alias("t_cls")).agg(F.count("*").alias("tn"))
    f, t = materialize(f, "findings"), materialize(t, "labels")
    sums = (F.sum("fn").alias("fn"), F.sum("fids").alias("fids"))
    a, b = _sides(f, t, same_path)
    a = a.groupBy("name", "line", "cwe", "cls").agg(*sums).join(_met_names(a, b, same_path), "name").withColumn("at", _around("line", TOLERANCE)).groupBy("base", "at", "cwe", "cls").agg(*sums)
    b = b.groupBy("base", F.col("at").cast("long").alias("at"), "t_cwe", "t_cls").agg(F.sum("tn").alias("tn"))
    near = _scored(a.join(b, ["base", "at"]), F.lit(3))
    same = f.join(t, "location")
    also_near = same.filter(file_and_line(F.col("location"))[1].isNotNull()).withColumns({"fn": -F.col("fn"), "fids": -F.col("fids")})
    placed = near.unionByName(_scored(also_near, F.lit(3))).unionByName(_scored(same, F.lit(5))).groupBy("points", "both").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"))
    placed = materialize(placed, "placed")  # a row for points and both
    kind = F.when(F.col("points") >= 8, "exact").otherwise("fuzzy")
    listed = placed.filter("points >= 5").groupBy(kind.alias("match_type"), "points").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids")).filter("n > 0")
    f = f.groupBy("cwe", "cls").agg(*sums)
    t = t.groupBy("t_cwe", "t_cls").agg(F.sum("tn").alias("tn"))
    product = f.join(t, F.col("cwe") == F.col("t_cwe")).filter(_same_class()).select(*_products())
    rest = product.unionByName(placed.filter("both").select((-F.col("n")).alias("n"), (-F.col("ids")).alias("ids"))).agg(F.sum("n").alias("n"), F.sum("ids").alias("ids")).filter("n > 0")
    return listed.unionByName(rest.select(F.lit("cwe_only").alias("match_type"), F.lit(5).alias("points"), "n", "ids"))


def _products() -> tuple[Column, Column]:
    """n, ids of the pairs that a group of findings and one of labels make."""
    return (F.col("fn") * F.col("tn")).alias("n"), (F.col("fids") * F.col("tn")).cast(SUMS).alias("ids")


def _scored(groups: DataFrame, place: Column) -> DataFrame:
    """points, both (same CWE and class), n, ids of pairs of groups."""
    cwe, cls = F.coalesce(F.col("cwe") == F.col("t_cwe"), F.lit(False)), F.coalesce(_same_class(), F.lit(False))
    points = place + F.when(cwe, 3).otherwise(0) + F.when(cls, 2).otherwise(0)
    return groups.select(points.alias("points"), (cwe & cls).alias("both"), *_products()).groupBy("points", "both").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"))


def greedy_match(pairs: DataFrame, findings: DataFrame | None = None, truth: DataFrame | None = None) -> DataFrame:
    """One-to-one assignment in the order of findings: each takes the free vulnerability of most points, the first of equals.

    With findings and truth, pairs that agree in CWE and class alone (5 points) count too. They are not listed: a finding has a
    row for each group (CWE and class) of vulnerabilities that it is compatible with, a vulnerability one for its group.
    A finding's choice only matters to those it is connected with, so components are folded apart from each other; the order
    within one is sequential by definition, and one task holds the rows of one component."""
    rows = pairs.select("finding_id", "vuln_id", F.col("points").cast("int").alias("points"), "match_type", F.lit(None).cast("string").alias("cell"))
    if findings is not None and truth is not None:
        f = findings.select("finding_id", F.upper("cwe_id").alias("cwe"), _plain("bug_class").alias("cls"))
        t = truth.select("vuln_id", F.upper("cwe_id").alias("t_cwe"), _plain("category").alias("t_cls"))
        cell = F.to_json(F.array("t_cwe", "t_cls")).alias("cell")
        kinds = f.select("cwe", "cls").distinct().join(t.select("t_cwe", "t_cls").distinct(), F.col("cwe") == F.col("t_cwe")).filter(_same_class()).select("cwe", "cls", cell)
        asking = f.join(kinds, ["cwe", "cls"]).select("finding_id", "cell")
        offered = t.select("vuln_id", cell).join(kinds.select("cell").distinct(), "cell")
        rows = rows.unionByName(asking, allowMissingColumns=True).unionByName(offered, allowMissingColumns=True)
    rows = materialize(rows, "scored")
    finding, vuln, cell = F.col("finding_id") * 3, F.col("vuln_id") * 3 + 1, F.pmod(F.xxhash64("cell"), F.lit(1 << 60)) * 3 + 2
    edges = rows.select(F.coalesce(finding, vuln).alias("a"), F.when(F.col("cell").isNotNull(), cell).otherwise(vuln).alias("b"))
    # No nulls among the ids: pandas would read the column as floats.
    keyed = rows.join(connected_components(edges), F.coalesce(finding, vuln) == F.col("node"))
    keyed = keyed.withColumn("role", F.when(F.col("cell").isNull(), "listed").when(F.col("vuln_id").isNull(), "asks").otherwise("offered")).na.fill(0, ["finding_id", "vuln_id", "points"])

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        listed, asked, offered = defaultdict(list), defaultdict(list), defaultdict(list)
        part = lambda role, *columns: pdf[pdf["role"] == role].sort_values("vuln_id")[list(columns)].itertuples(index=False)
        for f, v, points, kind in part("listed", "finding_id", "vuln_id", "points", "match_type"):
            listed[f].append((-points, v, kind))
        for f, cell in part("asks", "finding_id", "cell"):
            asked[f].append(cell)
        for v, cell in part("offered", "vuln_id", "cell"):
            offered[cell].append(v)
        taken, first, out = set(), defaultdict(int), []
        for f in sorted(listed.keys() | asked.keys()):
            free = [x for x in listed[f] if x[1] not in taken]
            for cell in asked[f]:
                vulns = offered[cell]
                while first[cell] < len(vulns) and vulns[first[cell]] in taken:
                    first[cell] += 1
                if first[cell] < len(vulns):
                    free.append((-5, vulns[first[cell]], "cwe_only"))
            if free:
                points, v, kind = min(free, key=lambda x: x[:2])
                taken.add(v)
                out.append((f, v, -points, kind))
        return pd.DataFrame(out, columns=["finding_id", "vuln_id", "points", "match_type"])

    return keyed.groupBy("component").applyInPandas(fold, "finding_id long, vuln_id long, points int, match_type string")


#: Rows of a block of ``_packed``; Spark hands 10,000 blocks at a time to Python.
BLOCK = 1000
#: Links of kinds of CWE and class up to so many are joined in one task.
SMALL = 100_000
BLOCKS = pa.schema([("component", pa.int64()), ("role", pa.int32()), ("x", pa.int64()), ("y", pa.int64()), ("n", pa.int64()), ("xs", pa.binary()), ("ys", pa.binary()), ("cs", pa.binary())])


def _starts(values: np.ndarray) -> np.ndarray:
    """Where a new value begins in sorted values."""
    return np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.empty(0, np.int64)


def _packed(batches: Iterator[pa.RecordBatch], role: int, size: int) -> Iterator[pa.RecordBatch]:
    """component, x, y, c of a sorted partition -> blocks of one component as bytes, with what they are to be sorted by."""
    n = 0
    for batch in batches:
        for at in range(0, batch.num_rows, size):
            component, x, y, c = (batch.slice(at, size).column(k).to_numpy(zero_copy_only=False) for k in range(4))
            order = np.argsort(component, kind="stable")
            component, x, y, c = component[order], x[order], y[order], c[order].astype(np.int8)
            starts = _starts(component)
            out = []
            for a, b in zip(starts, np.append(starts[1:], len(x))):
                out.append((component[a], role, x[a], y[a] if role == 1 else 0, n, x[a:b].tobytes(), y[a:b].tobytes(), c[a:b].tobytes()))
                n += 1
            yield pa.record_batch([pa.array(column, field.type) for column, field in zip(zip(*out), BLOCKS)], schema=BLOCKS)


class _Free:
    """The free labels of a component, and what its kinds of findings would take.

    Blocks come sorted: ids of labels (role 0), pools and ids (1), kinds and pools with points, the most first (2). A pool is labels
    alike in all that points depend on; a label is in the pool of its place (an even number) and in that of its CWE and class (odd).
    Of a pool only the first free label matters, and a pool or kind that is used up stays so."""

    def __init__(self) -> None:
        self.parts: list[list] = [[], [], []]
        self.ids = self.pools = self.kinds = None

    def add(self, role: int, x: np.ndarray, y: np.ndarray, c: np.ndarray) -> None:
        if role == 1:
            self._labels()
            y = np.searchsorted(self.ids, y).astype(np.int32)
        elif role == 2:
            self._pools()
            y = np.searchsorted(self.pools, y).astype(np.int32)
        self.parts[role].append((x, y, c))

    def _whole(self, role: int, *columns: int) -> list[np.ndarray]:
        rows, self.parts[role] = self.parts[role], []
        return [np.concatenate([row[k] for row in rows]) for k in columns]

    def _labels(self) -> None:
        if self.ids is None:
            (ids,) = self._whole(0, 0)
            self.ids = ids[_starts(ids)]
            self.taken = bytearray(len(self.ids))

    def _pools(self) -> None:
        if self.pools is None:
            pool, members = self._whole(1, 0, 1)
            starts = _starts(pool)
            self.pools, self.members = pool[starts], memoryview(members)
            self.head, self.tail = starts.tolist(), np.append(starts[1:], len(pool)).tolist()
            self.alone = (self.pools % 2 == 1).tolist()

    def _kinds(self) -> None:
        if self.kinds is None:
            kind, pool, points = self._whole(2, 0, 1, 2)
            starts = _starts(kind)
            self.kinds, self.pool, self.points = kind[starts], memoryview(pool), memoryview(points)
            self.first, self.end = starts.tolist(), np.append(starts[1:], len(kind)).tolist()
            self.alive = np.ones(len(starts), bool)

    def better(self, kind: int, best: tuple) -> tuple:
        """The better of best and what kind would take: minus points, place of the label's id, whether it has no place in common."""
        first, end = self.first[kind], self.end[kind]
        members, taken, heads, tails = self.members, self.taken, self.head, self.tail
        for i in range(first, end):
            points = -self.points[i]
            if points > best[0]:
                break
            pool = self.pool[i]
            head, tail = heads[pool], tails[pool]
            while head < tail and taken[members[head]]:
                head += 1
            heads[pool] = head
            if head < tail:
                best = min(best, (points, members[head], self.alone[pool]))
            elif i == first:
                first += 1
        self.first[kind] = first
        if first == end:
            self.alive[kind] = False
        return best

    def fold(self, findings: np.ndarray, kinds: np.ndarray) -> list[tuple]:
        """finding, label, points, whether by CWE and class alone; findings ascend, with a row for each kind that one has."""
        self._kinds()
        place = np.searchsorted(self.kinds, kinds)
        keep = np.flatnonzero(self.alive[place])
        nothing, out = (0, -1, False), []
        now, best = None, nothing

        def take() -> None:
            if best[0]:
                self.taken[best[1]] = 1
                out.append((now, self.ids[best[1]], -best[0], best[2]))

        for f, kind in zip(findings[keep].tolist(), place[keep].tolist()):
            if f != now:
                take()
                now, best = f, nothing
            best = self.better(kind, best)
        take()
        return out


def _assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of ``_packed`` in order -> the assignment; labels and kinds are held, findings (role 3) pass by."""
    component, free, rest = None, None, None

    def chosen(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            yield pa.record_batch([pa.array(column, kind) for column, kind in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int32(), pa.bool_()))], names=["finding_id", "vuln_id", "points", "alone"])

    for batch in batches:
        for at in range(batch.num_rows):
            own, role, *parts = (column[at].as_py() for column in batch.columns)
            if own != component:
                if rest:
                    yield from chosen(free.fold(*rest))
                component, free, rest = own, _Free(), None
            x, y, c = (np.frombuffer(part, kind) for part, kind in zip(parts, (np.int64, np.int64, np.int8)))
            if role < 3:
                free.add(role, x, y, c)
                continue
            if rest:
                x, y = np.append(rest[0], x), np.append(rest[1], y)
            cut = np.searchsorted(x, x[-1])  # the last finding may go on in the next block
            yield from chosen(free.fold(x[:cut], y[:cut]))
            rest = x[cut:], y[cut:]
    if rest:
        yield from chosen(free.fold(*rest))


def _alike(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join by equal keys, nulls being equal."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    return left.join(right, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]).drop(*[f"_{k}" for k in keys])


def greedy_assignment(findings: DataFrame, truth: DataFrame, same_path: bool = False) -> DataFrame:
    """``greedy_match`` of all scored pairs and those by CWE and class alone, without listing pairs of rows.

    Findings alike in place, CWE and class (a kind) want the same labels, and of labels alike (a pool) only the first free one can
    be taken. So kinds meet pools, and findings pass by in their order. What a finding gets depends on those before it, so what hangs
    together by CWE and class is one task by definition; it holds its labels and the links of kinds and pools, findings come to it in
    packed blocks. Rows without id are left out."""
    f_keys, t_keys, number = ["location", "cwe", "cls"], ["location", "t_cwe", "t_cls"], F.monotonically_increasing_id()
    f = findings.filter("finding_id is not null").select("finding_id", "location", F.upper("cwe_id").alias("cwe"), _plain("bug_class").alias("cls"))
    t = truth.filter("vuln_id is not null").select("vuln_id", "location", F.upper("cwe_id").alias("t_cwe"), _plain("category").alias("t_cls"))
    kinds = materialize(f.select(*f_keys).distinct().withColumn("kind", number), "kinds")
    pools = materialize(t.select(*t_keys).distinct().withColumn("pool", number * 2), "pools")
    cells = materialize(t.select("t_cwe", "t_cls").distinct().withColumn("pool", number * 2 + 1), "cells")
    a, b = _sides(kinds, pools, same_path)
    b = b.select("pool", "t_cwe", "t_cls", F.col("location").alias("t_location"), "base", F.col("at").cast("long").alias("at"))
    near = a.join(_met_names(a, b, same_path), F.col("name") == F.col("base")) if same_path else a.join(_met_names(a, b, same_path), "name")
    near = near.withColumn("at", _around("line", TOLERANCE)).join(b, ["base", "at"])
    unplaced = kinds.filter(file_and_line(F.col("location"))[1].isNull()).join(pools, "location")
    points = lambda place: place + F.when(F.col("cwe") == F.col("t_cwe"), 3).otherwise(0) + F.when(_same_class(), 2).otherwise(0)
    ends = ["kind", "cwe", "cls", "pool", "t_cwe", "t_cls"]
    placed = near.select(*ends, points(F.when(F.col("location") == F.col("t_location"), 5).otherwise(3)).alias("points")).filter("points >= 5")
    alone = f.select("cwe", "cls").distinct().join(cells, F.col("cwe") == F.col("t_cwe")).filter(_same_class())
    alone = kinds.join(alone, ["cwe", "cls"]).select(*ends, F.lit(5).alias("points"))
    of_f, of_t = F.xxhash64(F.lit("f"), F.to_json(F.array("cwe", "cls"))), F.xxhash64(F.lit("t"), F.to_json(F.array("t_cwe", "t_cls")))
    links = placed.unionByName(unplaced.select(*ends, points(F.lit(5)).alias("points"))).unionByName(alone)
    links = materialize(links.select("kind", "pool", "points", of_f.alias("a"), of_t.alias("b")), "links")
    parts = materialize(connected_components(links.select("a", "b"), small=SMALL), "parts")  # a row for CWE and class
    links = links.join(parts, F.col("a") == F.col("node")).select("component", "kind", "pool", "points")
    labels = _alike(_alike(t, pools, t_keys), cells.withColumnRenamed("pool", "cell"), ["t_cwe", "t_cls"])
    labels = materialize(labels.withColumn("b", of_t).join(parts, F.col("b") == F.col("node")).select("component", "vuln_id", "pool", "cell"), "labels")
    asking = _alike(f, kinds.join(links.select("component", "kind").distinct(), "kind"), f_keys)
    rows = lambda df, x, y, c: df.select("component", x.alias("x"), y.cast("long").alias("y"), c.cast("int").alias("c"))
    none = F.lit(0)
    roles = [
        (rows(labels, F.col("vuln_id").cast("long"), none, none), ["x"], ["x"]),
        (rows(labels, F.explode(F.array("pool", "cell")), F.col("vuln_id"), none), ["x", "y"], ["x", "y"]),
        (rows(links, F.col("kind"), F.col("pool"), F.col("points")), ["x"], ["x", F.desc("c")]),
        (rows(asking, F.col("finding_id").cast("long"), F.col("kind"), none), ["x"], ["x"]),
    ]
    blocks = [df.repartitionByRange(*ranges).sortWithinPartitions(*order).mapInArrow(partial(_packed, role=role, size=BLOCK), "component long, role int, x long, y long, n long, xs binary, ys binary, cs binary") for role, (df, ranges, order) in enumerate(roles)]
    dealt = reduce(DataFrame.unionByName, blocks).repartition("component").sortWithinPartitions("component", "role", "x", "y", "n")
    out = dealt.select("component", "role", "xs", "ys", "cs").mapInArrow(_assign, "finding_id long, vuln_id long, points int, alone boolean")
    kind = F.when(F.col("alone"), "cwe_only").when(F.col("points") >= 8, "exact").otherwise("fuzzy")
    return out.select("finding_id", "vuln_id", "points", kind.alias("match_type"))


def confusion(predicted: DataFrame) -> DataFrame:
    """predicted: truth, guess (booleans) -> counts, precision, recall, F1, false discovery; 0 where there is nothing."""
    g = predicted.agg(F.count_if(F.col("truth") & F.col("guess")).alias("tp"), F.count_if(~F.col("truth") & F.col("guess")).alias("fp"), F.count_if(F.col("truth") & ~F.col("guess")).alias("fn"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return g.select("tp", "fp", "fn", zero(tp, tp + fp).alias("precision"), zero(tp, tp + fn).alias("recall"), zero(2 * tp, 2 * tp + fp + fn).alias("f1"), zero(fp, tp + fp).alias("fdr"))


def category_breakdown(truth: DataFrame, found: DataFrame) -> DataFrame:
    """Per category: labelled, found, missed."""
    g = truth.join(found.select("vuln_id").distinct().withColumn("hit", F.lit(1)), "vuln_id", "left").groupBy("category")
    return g.agg(F.count("*").alias("total"), F.count("hit").alias("tp"), (F.count("*") - F.count("hit")).alias("fn"))


def category_metrics(findings: DataFrame, truth: DataFrame, found: DataFrame, matched: DataFrame) -> DataFrame:
    """Per category of the labels: labelled, found (tp), missed (fn), unmatched findings of a CWE that the category has (fp),
    precision and recall; found: vuln_id, matched: finding_id that match anything. Findings are counted by CWE before they meet categories."""
    hit = truth.join(found.select("vuln_id").distinct().withColumn("hit", F.lit(1)), "vuln_id", "left").groupBy("category")
    counts = hit.agg(F.count("*").alias("total"), F.count("hit").alias("tp"), (F.count("*") - F.count("hit")).alias("fn"))
    left = findings.join(matched.select("finding_id").distinct(), "finding_id", "left_anti").groupBy("cwe_id").agg(F.count("*").alias("n"))
    fp = truth.select("category", "cwe_id").distinct().join(left, "cwe_id").groupBy("category").agg(F.sum("n").alias("fp"))
    zero = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    out = counts.join(fp, "category", "left").withColumn("fp", F.coalesce("fp", F.lit(0).cast("long")))
    return out.withColumns({"precision": zero(F.col("tp"), F.col("tp") + F.col("fp")), "recall": zero(F.col("tp"), F.col("total"))})


def recall_at(scored: DataFrame, k: int, group: str) -> DataFrame:
    """scored: group, score, id, relevant -> share of the relevant among the k best of each group."""
    w = Window.partitionBy(group).orderBy(F.desc("score"), "id")
    g = scored.withColumn("r", F.row_number().over(w)).groupBy(group)
    return g.agg(F.count_if("relevant").alias("relevant"), F.count_if(F.col("relevant") & (F.col("r") <= k)).alias("hits")).withColumn("recall", F.coalesce(F.try_divide("hits", "relevant"), F.lit(0.0)))


def mean_interval(values: DataFrame, group: str) -> DataFrame:
    """Mean and 1.96 standard errors around it."""
    g = values.groupBy(group).agg(F.count("*").alias("n"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("sd"))
    return g.select(group, "n", "mean", (F.col("mean") - 1.96 * F.col("sd") / F.sqrt("n")).alias("low"), (F.col("mean") + 1.96 * F.col("sd") / F.sqrt("n")).alias("high"))


def false_discovery(tests: DataFrame, q: float = 0.05) -> DataFrame:
    """Benjamini-Hochberg over a table of tests (a row a hypothesis): p, rank, adjusted value, rejected; tests without p are
    left out.

    Ranks and the minimum over higher ranks are taken within ranges of p and carried over from a table of a row a range."""
    dealt = materialize(tests.select("id", "p").filter("p is not null").repartitionByRange("p", "id").withColumn("part", F.spark_partition_id()), "tests")
    whole = Window.orderBy("part")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("own"))
    before = sizes.select("part", (F.sum("own").over(whole) - F.col("own")).alias("before"), F.sum("own").over(Window.partitionBy()).alias("n"))  # a row a range
    inside = Window.partitionBy("part")
    ranked = dealt.join(F.broadcast(before), "part").withColumn("rank", F.row_number().over(inside.orderBy("p", "id")) + F.col("before")).withColumn("value", F.col("p") * F.col("n") / F.col("rank"))
    lows = ranked.groupBy("part").agg(F.min("value").alias("low"))
    later = lows.select("part", F.min("low").over(Window.orderBy(F.desc("part")).rowsBetween(Window.unboundedPreceding, -1)).alias("later"))  # a row a range
    lowest = F.min("value").over(inside.orderBy(F.desc("p"), F.desc("id")).rowsBetween(Window.unboundedPreceding, 0))
    adjusted = F.least(F.lit(1.0), lowest, F.col("later"))
    return ranked.join(F.broadcast(later), "part").withColumn("adjusted", adjusted).select("id", "p", "rank", "adjusted", (F.col("adjusted") <= q).alias("rejected"))


#: Draws are made for so many (row, draw) pairs at a time; they stay in the cache of a core.
WEIGHTS = 60_000
PRIME = 2_147_483_647
#: Chances of up to 0, 1, 2, 3 and 4 events of a Poisson(1) count; more count as 5.
POISSON = [0.367879, 0.735759, 0.919699, 0.981012, 0.996340]
#: The least numbers whose share of PRIME reaches these chances.
STEPS = [next(x for x in range(int(c * PRIME) - 2, PRIME) if x / PRIME >= c) for c in POISSON]


def _weights(ids: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Poisson(1) weights of rows (ids * 16807 modulo PRIME) and draws. As PRIME is 2^31 - 1, a number's upper bits added to its lower
    31 are the same modulo PRIME, and y * 69621 + y * y is one product below 2^63."""
    y, high = ids[:, None] + each, np.empty((len(ids), len(each)), np.int64)

    def fold(v: np.ndarray) -> None:
        np.right_shift(v, 31, out=high)
        np.bitwise_and(v, PRIME, out=v)
        np.add(v, high, out=v)

    fold(y)
    np.add(y, 69_621, out=high)
    np.multiply(y, high, out=y)
    fold(y)
    fold(y)  # at most PRIME + 2
    x = y.astype(np.uint32)
    w = (x >= STEPS[0]).view(np.uint8)
    for step in STEPS[1:]:
        w += (x >= step).view(np.uint8)
    w -= (x >= PRIME).view(np.uint8) * np.uint8(len(STEPS))  # those stand for 0, 1 and 2
    return w


def _draw(batches: Iterator[pa.RecordBatch], draws: int) -> Iterator[pa.RecordBatch]:
    """Sums of weights and of weighted differences of a partition's rows for all draws: a matrix of weights a block of rows."""
    sums = np.zeros((2, draws))
    each = (np.arange(1, draws + 1, dtype=np.int64) * 48_271 + 12_345) % PRIME
    rows = max(1, WEIGHTS // draws)
    some = False
    for batch in batches:
        ids, d = batch.column("id").to_numpy(zero_copy_only=False) % PRIME * 16_807 % PRIME, batch.column("d").to_numpy(zero_copy_only=False)
        both = np.stack([np.ones(len(d)), d])
        for a in range(0, len(ids), rows):
            some = True
            sums += both[:, a : a + rows] @ _weights(ids[a : a + rows], each).astype(np.float64)
    if some:
        yield pa.record_batch([pa.array(np.arange(1, draws + 1, dtype=np.int32)), pa.array(sums[0].astype(np.int64)), pa.array(sums[1])], names=["draw", "n", "s"])


def bootstrap(values: DataFrame, draws: int = 10_000) -> DataFrame:
    """values: id (a whole number), a, b (scores of two runs on one item) -> draw, difference of means under Poisson(1) weights.

    A weight is a function of item and draw, so a draw is the same whatever the partitions. Rows are dealt evenly, for one
    is 16 bytes and draws weights: a task works out the weights of a block of rows for all draws as one matrix, adds them up and sends one row a draw, however many
    rows it has. Rows without id, a or b are left out; repeated ids draw alike."""
    known = values.select(F.col("id").cast("long").alias("id"), (F.col("a") - F.col("b")).cast("double").alias("d")).dropna()
    known = spread(known)
    sums = known.mapInArrow(lambda it: _draw(it, draws), "draw int, n long, s double").groupBy("draw").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    return sums.select("draw", F.coalesce(F.try_divide("s", "n"), F.lit(0.0)).alias("difference"))


def bootstrap_interval(values: DataFrame, draws: int = 10_000) -> DataFrame:
    """One row: n, difference of means, low and high (the middle 95 % of the draws), effect (Cohen's d: the difference in
    units of the root of the mean variance of both runs; null if neither varies)."""
    known = values.dropna(subset=["id", "a", "b"])
    spread = F.sqrt((F.var_samp("a") + F.var_samp("b")) / 2)
    whole = known.agg(F.count("*").alias("n"), (F.avg("a") - F.avg("b")).alias("difference"), F.try_divide(F.avg("a") - F.avg("b"), spread).alias("effect"))
    low, high = (F.percentile("difference", F.lit(q)) for q in (0.025, 0.975))
    return whole.join(F.broadcast(bootstrap(values, draws).agg(low.alias("low"), high.alias("high"))), F.lit(True)).select("n", "difference", "low", "high", "effect")
