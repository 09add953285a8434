"""Dashboard marts: compositions of the operators, each a
small aggregated table written as one header CSV by ``write_mart``.

    python -m vireo.plans.marts <sf_dir> <out_dir> [--tuning]
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vireo.functions.text import NUMERIC_FEATURES
from vireo.operators import evaluation as ev
from vireo.operators import profile, sampling, scaling
from vireo.operators import vectors as vec
from vireo.operators.features import eda_features, text_features
from vireo.operators.joins import materialize
from vireo.plans.registry import posts, scored_labels, table
from vireo.sources.files import write_mart


def data_quality_mart(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Overview, missing values, classes, schema."""
    docs = table(spark, sf, "documents")
    return {"overview": profile.dataset_overview(docs, "lang"),
            "missing": profile.missing_profile(docs),
            "classes": profile.class_distribution(table(spark, sf, "labels"), "quality"),
            "schema": profile.schema_info(docs, {"doc_id": "id", "text": "text", "lang": "group"})}


def model_mart(spark: SparkSession, sf: str, models: dict | None = None, grids: dict | None = None) -> dict[str, DataFrame]:
    """Model comparison, metrics and bootstrap intervals of fitted models [, tuning tables].

    ``models`` are estimators by name (the four base models by default), ``grids`` tuning grids by model name.
    """
    from vireo.operators import models as md
    d = posts(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    _, train, test = md.prepare(d, vec.build_pipeline("text", "summary", "lang"), "doc_id", "quality")
    models = md.base_models() if models is None else models
    fitted, comparison = md.train_all(train, test, models, "doc_id")
    comparison = materialize(comparison)
    best = comparison.orderBy(F.desc("f1"), F.desc("auc"), "model").first()["model"]  # details of the best model
    scored = md.score(fitted[best], test)
    out = {"comparison": comparison, "metrics": ev.class_metrics(scored), "intervals": ev.bootstrap_ci(scored, "doc_id")}
    for name, grid in (grids or {}).items():
        out[f"tuning_{name}"] = md.cv_table(md.tune(models[name], grid, train, "doc_id"))
    return out


def insight_mart(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """A hash sample of EDA features, class profile, feature catalogue,
    group distribution."""
    d = posts(spark, sf).join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    feats = text_features(d, "text", "summary", "ref")
    assembled = vec.assembler(NUMERIC_FEATURES).transform(feats)
    return {"feature_sample": eda_features(sampling.hash_sample(d, "doc_id", 0.05), "text", "summary", "quality"),
            "class_profile": profile.class_profile(feats, "quality", NUMERIC_FEATURES),
            "catalog": vec.feature_catalog(assembled),
            "groups": profile.group_distribution(table(spark, sf, "documents"), "lang", k=30)}


def scaling_mart(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Strong and weak scaling and data-size impact from a run log."""
    runs = scaling.run_log_from_events(table(spark, sf, "events"))
    return {"strong": scaling.strong_scaling(runs), "weak": scaling.weak_scaling(runs),
            "size": scaling.size_impact(runs)}


def write_marts(marts: dict[str, dict[str, DataFrame]], out_dir: str) -> list[str]:
    written = []
    for mart, tables in marts.items():
        for name, df in tables.items():
            path = os.path.join(out_dir, mart, name)
            write_mart(df.select(*[F.col(c).cast("string") if t.startswith(("array", "struct", "vector"))
                                   else F.col(c) for c, t in df.dtypes]), path)
            written.append(path)
    return written


def build_all(spark: SparkSession, sf: str, with_tuning: bool = False, models: dict | None = None) -> dict[str, dict[str, DataFrame]]:
    from vireo.operators.models import GRIDS
    return {"data_quality": data_quality_mart(spark, sf),
            "models": model_mart(spark, sf, models, GRIDS["batch"] if with_tuning else None),
            "insights": insight_mart(spark, sf), "scaling": scaling_mart(spark, sf)}


if __name__ == "__main__":
    from vireo.session import local_session
    session = local_session()
    for p in write_marts(build_all(session, sys.argv[1], "--tuning" in sys.argv), sys.argv[2]):
        print(p)
