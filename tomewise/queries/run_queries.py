"""Queries over run, artifact, version and metric tables."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import lexicons as lx
from ..operators import evaluation, runs
from ..operators.registry import VersionRegistry
from ..sources import tables
from ..sources.workspace import cut, new_path
from . import sql as q
from .registry import query, r6

SCORE = "greatest(coalesce(best_r2, 0), coalesce(test_r2, 0))"


@query(
    "best_run",
    q.over_runs(
        "SELECT experiment, run_id, best_r2 FROM (SELECT *, row_number() OVER (PARTITION BY "
        "experiment ORDER BY best_r2 DESC, run_id) AS rn FROM runs WHERE best_r2 IS NOT NULL) "
        "WHERE rn = 1"
    ),
)
def best_run(spark, sf):
    return runs.best_run(tables.runs(spark, sf))


_FIRST = (
    "SELECT run_id, position, artifact FROM (SELECT *, row_number() OVER (PARTITION BY run_id "
    "ORDER BY position, artifact) AS rn FROM artifacts WHERE contains(lower(artifact), 'model')) "
    "WHERE rn = 1"
)


@query("model_artifact", q.over_runs(_FIRST))
def model_artifact(spark, sf):
    return runs.model_artifact(tables.artifacts(spark, sf))


@query(
    "good_runs",
    q.over_runs(
        f"SELECT experiment, run_id, start_time, {SCORE} AS r2_score FROM (SELECT *, row_number() "
        "OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id DESC) AS rn FROM runs) "
        f"WHERE rn <= 50 AND {SCORE} > 0.25"
    ),
)
def good_runs(spark, sf):
    return runs.good_runs(tables.runs(spark, sf))


@query(
    "latest_good_run",
    q.over_runs(
        f"SELECT run_id, start_time, {SCORE} AS r2_score, artifact FROM "
        "(SELECT * FROM runs ORDER BY start_time DESC, run_id DESC LIMIT 20) "
        f"JOIN ({_FIRST}) USING (run_id) WHERE {SCORE} > 0.25 "
        "ORDER BY start_time DESC, run_id DESC LIMIT 1"
    ),
)
def latest_good_run(spark, sf):
    return runs.latest_good_run(tables.runs(spark, sf), tables.artifacts(spark, sf))


# Every model's run with the best score becomes its next version.
_NEW = (
    "SELECT model_name, run_id, best_r2 AS r2 FROM (SELECT *, row_number() OVER (PARTITION BY "
    "model_name ORDER BY best_r2 DESC, run_id) AS rn FROM versions JOIN runs USING (run_id) "
    "WHERE best_r2 IS NOT NULL) WHERE rn = 1"
)


@query(
    "promote_version",
    q.over_runs(
        "SELECT v.model_name, v.version, v.run_id, CASE WHEN stage = 'Production' AND n.run_id IS "
        "NOT NULL THEN 'Archived' ELSE stage END AS stage, CAST(NULL AS VARCHAR) AS description "
        "FROM versions v LEFT JOIN fresh n ON n.model_name = v.model_name UNION ALL "
        "SELECT model_name, (SELECT max(version) FROM versions v WHERE v.model_name = "
        "fresh.model_name) + 1, run_id, 'Production', printf('R2 = %.4f', r2) FROM fresh",
        fresh=_NEW,
    ),
)
def promote_version(spark, sf):
    versions, all_runs = tables.versions(spark, sf), tables.runs(spark, sf)
    top = F.max(F.struct("best_r2", (-F.col("run_id")).alias("neg_id"))).alias("top")
    fresh = (
        versions.join(all_runs.where("best_r2 IS NOT NULL"), "run_id")
        .groupBy("model_name")
        .agg(top)
        .select("model_name", (-F.col("top.neg_id")).alias("run_id"), F.col("top.best_r2").alias("r2"))
    )
    return runs.promote(versions, fresh, F.format_string("R2 = %.4f", "r2"))


@query(
    "registry_commits",
    q.over_runs(
        "SELECT v.model_name, v.version, v.run_id, CASE WHEN stage = 'Production' AND n.run_id IS "
        "NOT NULL THEN 'Archived' ELSE stage END AS stage, CAST(NULL AS VARCHAR) AS description "
        "FROM versions v LEFT JOIN fresh n ON n.model_name = v.model_name UNION ALL "
        "SELECT fresh.model_name, last + 1, run_id, 'Archived', printf('R2 = %.4f', r2) "
        "FROM fresh JOIN last USING (model_name) UNION ALL "
        "SELECT second.model_name, last + 2, second.run_id, 'Production', printf('R2 = %.4f', second.r2) "
        "FROM second JOIN last USING (model_name) UNION ALL "
        "SELECT fresh.model_name || '-new', 1, run_id, 'Production', printf('R2 = %.4f', r2) FROM fresh",
        ranked="SELECT model_name, run_id, best_r2 AS r2, row_number() OVER (PARTITION BY model_name "
        "ORDER BY best_r2 DESC, run_id) AS rn FROM versions JOIN runs USING (run_id) WHERE best_r2 IS NOT NULL",
        fresh="SELECT model_name, run_id, r2 FROM ranked WHERE rn = 1",
        second="SELECT model_name, run_id, r2 FROM ranked WHERE rn = 2",
        last="SELECT model_name, max(version) AS last FROM versions GROUP BY model_name",
    ),
)
def registry_commits(spark, sf):
    """All versions registered, then two promotions, the first of them by a job that runs twice."""
    versions, all_runs = tables.versions(spark, sf), tables.runs(spark, sf)
    best = Window.partitionBy("model_name").orderBy(F.desc("best_r2"), "run_id")
    ranked = (
        versions.join(all_runs.where("best_r2 IS NOT NULL"), "run_id")
        .withColumn("rn", F.row_number().over(best))
        .where("rn <= 2")
        .select("model_name", "run_id", F.col("best_r2").alias("r2"), "rn")
    )
    ranked = cut(ranked, "ranked")
    first, second = ranked.where("rn = 1").drop("rn"), ranked.where("rn = 2").drop("rn")
    fresh = first.withColumn("model_name", F.concat("model_name", F.lit("-new")))
    said = F.format_string("R2 = %.4f", "r2")
    registry = VersionRegistry(spark, new_path(spark, "registry"))
    registry.register(versions)
    for rows, key in ((first.union(fresh), "job 1"), (first.union(fresh), "job 1"), (second, "job 2")):
        registry.promote(rows, said, key)
    return registry.versions()


@query(
    "compare_versions",
    q.over_runs(
        "SELECT model_name, version, stage, run_id, coalesce(best_r2, test_r2) AS r2_score "
        "FROM versions LEFT JOIN runs USING (run_id)"
    ),
)
def compare_versions(spark, sf):
    return runs.compare_versions(tables.versions(spark, sf), tables.runs(spark, sf))


@query(
    "resolve_version",
    q.over_runs(
        "SELECT model_name, version, run_id, stage FROM (SELECT *, row_number() OVER (PARTITION BY "
        "model_name ORDER BY CASE WHEN stage = 'Production' THEN 2 WHEN version = 1 THEN 1 ELSE 0 "
        "END DESC, version DESC) AS rn FROM versions) WHERE rn = 1"
    ),
)
def resolve_version(spark, sf):
    return runs.resolve_version(tables.versions(spark, sf))


THRESHOLDS = {"best_r2": 0.05, "test_r2": 0.1}


@query(
    "metric_alerts",
    q.over_runs(
        " UNION ALL ".join(
            f"SELECT run_id, '{k}' AS key, {k} AS value, CAST({v} AS DOUBLE) AS threshold "
            f"FROM runs WHERE {k} < {v}"
            for k, v in THRESHOLDS.items()
        )
    ),
)
def metric_alerts(spark, sf):
    long = tables.runs(spark, sf).unpivot("run_id", ["best_r2", "test_r2"], "key", "value")
    return runs.metric_alerts(long, THRESHOLDS).select("run_id", "key", "value", "threshold")


@query(
    "readiness_check",
    q.over_runs(
        "SELECT run_id, features = 511 AS features_ok, coalesce(best_r2 > 0.25 AND best_r2 <= 1, "
        "false) AS score_ok, features = 511 AND coalesce(best_r2 > 0.25 AND best_r2 <= 1, false) "
        "AS ready FROM (SELECT *, 508 + run_id % 5 AS features FROM runs)"
    ),
)
def readiness_check(spark, sf):
    """Feature counts around the expected one follow from the run id."""
    counted = tables.runs(spark, sf).withColumn("n_features", 508 + F.col("run_id") % 5)
    return runs.readiness(counted)


# One result row per run: the experiment stands for the model, the run for its position.
@query(
    "champion_model",
    q.over_runs(
        "SELECT run_id, experiment, best_r2 AS r2 FROM runs WHERE best_r2 IS NOT NULL "
        "ORDER BY best_r2 DESC, run_id LIMIT 1"
    ),
)
def champion_model(spark, sf):
    results = tables.runs(spark, sf).withColumnsRenamed({"best_r2": "r2"})
    return evaluation.champion(results, position="run_id").select("run_id", "experiment", "r2")


_SETS = "CASE run_id % 3 WHEN 0 THEN 'traditional' WHEN 1 THEN 'semantic' ELSE 'full' END"


@query(
    "ablation_deltas",
    q.over_runs(
        "SELECT model, t AS traditional_r2, s AS semantic_r2, f AS full_r2, "
        + q.named(
            {
                "semantic_improvement": "s - t",
                "lexicon_improvement": "f - s",
                "total_improvement": "f - t",
                "total_improvement_pct": "(f - t) / abs(nullif(t, 0)) * 100",
            },
            "double",
        )
        + " FROM (SELECT concat('exp', CAST(experiment AS VARCHAR)) AS model, "
        + ", ".join(
            f"max(test_r2) FILTER (WHERE {_SETS} = '{s}') AS {s[0]}"
            for s in ("traditional", "semantic", "full")
        )
        + " FROM runs GROUP BY experiment)"
    ),
)
def ablation_deltas(spark, sf):
    results = tables.runs(spark, sf).selectExpr(
        "concat('exp', CAST(experiment AS STRING)) AS model", f"{_SETS} AS feature_set", "test_r2 AS r2"
    )
    deltas = evaluation.ablation_deltas(results)
    gains = [c for c in deltas.columns if "improvement" in c]
    return deltas.withColumns({c: r6(c) for c in gains})


def _ladder(name: str) -> str:
    *steps, (_, rest) = lx.VERDICTS[name]
    rules = " ".join(f"WHEN r2 > {v} THEN '{label}'" for v, label in steps)
    return f"CASE WHEN r2 IS NOT NULL THEN CASE {rules} ELSE '{rest}' END END"


@query(
    "verdict_bands",
    q.over_runs(
        "SELECT run_id, "
        + q.named({"improvement": "r2 - 0.1851", "improvement_pct": "(r2 - 0.1851) / 0.1851 * 100"}, "double")
        + ", " + ", ".join(f"{_ladder(n)} AS {n}_verdict" for n in lx.VERDICTS)
        + " FROM (SELECT run_id, best_r2 AS r2 FROM runs)"
    ),
)
def verdict_bands(spark, sf):
    score = F.col("best_r2")
    gains = evaluation.improvement(score)
    return tables.runs(spark, sf).select(
        "run_id",
        *[r6(c).alias(n) for n, c in gains.items()],
        *[evaluation.verdict(score, n).alias(f"{n}_verdict") for n in lx.VERDICTS],
    )
