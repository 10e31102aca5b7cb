import ast
from pathlib import Path

import pytest

from wayword import session

PACKAGE = Path(session.__file__).parent


def test_shared_folder_comes_from_the_session(spark):
    assert session.scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert session.scratch_path(spark, "x") != session.scratch_path(spark, "x")


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext = Context()
        conf = Conf()

    with pytest.raises(ValueError):
        session.shared_dir(Session())


def test_materialise_counts(spark):
    path = session.scratch_path(spark, "counted")
    table, n = session.materialise_counted(spark.range(17).where("id > 3"), path)
    assert n == 13 and table.count() == 13


def test_no_python_per_row_outside_the_model_hook():
    """Only the hook for a caller's model may start Python workers."""
    for source in PACKAGE.rglob("*.py"):
        names = {n.attr for n in ast.walk(ast.parse(source.read_text())) if isinstance(n, ast.Attribute)}
        allowed = {"pandas_udf"} if source.name == "encode.py" else set()
        found = names & {"udf", "pandas_udf", "rdd", "mapInPandas", "applyInPandas", "localCheckpoint", "crossJoin"}
        assert found <= allowed, source
