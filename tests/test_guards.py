"""Imports that fail, folders that are not shared, texts with very many matches."""

import re
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from auditloom.functions import storage
from auditloom.functions.text import matches


def test_engine_stands_without_optional_modules():
    code = "import sys; sys.modules['ahocorasick'] = None; import __spark_entry__ as e; q = e.queries(); assert 'validated_top' in q and 'pipeline' not in q; print(len(q))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120)
    assert out.returncode == 0, out.stderr
    assert "left out" in out.stderr


def test_no_local_folder_on_a_cluster():
    class There:
        def isDefined(self):
            return False

    class Context:
        master = "spark://somewhere:7077"

        class _jsc:
            @staticmethod
            def sc():
                return type("S", (), {"getCheckpointDir": staticmethod(There)})

    class Session:
        sparkContext = Context

        class conf:
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError):
        storage.shared_dir(Session)


def test_very_many_matches(spark):
    texts = ["é ab " * n for n in (1, 255, 256, 257, 2000)] + ["x", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r["i"]: [tuple(m) for m in r["m"] or []] for r in df.select("i", matches(F.col("t"), "a(b)").alias("m")).collect()}
    assert got == {i: [(m.start(), m.end(), m[0]) for m in re.finditer("ab", t or "")] for i, t in enumerate(texts)}
