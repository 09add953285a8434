"""Marts are written and read back as small CSV tables."""

import os
import tempfile

from conftest import SF_SMALL
from vireo.operators.models import decision_tree
from vireo.plans import marts


def test_marts_written(spark):
    out = tempfile.mkdtemp(prefix="vireo-marts-")
    paths = marts.write_marts(marts.build_all(spark, SF_SMALL, models={"decision_tree": decision_tree()}), out)
    assert len(paths) == 14
    for p in paths:
        assert any(f.endswith(".csv") for f in os.listdir(p))
    overview = spark.read.option("header", True).csv(os.path.join(out, "data_quality", "overview"))
    assert overview.count() == 8
