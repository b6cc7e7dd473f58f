"""Every registered query of the core against its SQL on a small scale, through Catalyst's eyes too."""

import duckdb
import pytest

from tideline.plans import registry

from conftest import SF

#: The scale at which queries are compared, and the smallest one for those of few sessions and laps.
SCALE = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SQL = registry.oracle_sql()


def connected(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def canonical(rows, names):
    order = [names.index(n) for n in sorted(names)]
    return sorted(repr([round(r[i], 6) + 0.0 if isinstance(r[i], float) else r[i] for i in order]) for r in rows)


@pytest.mark.parametrize("name,folder", [(n, SCALE) for n in sorted(SQL)] + [(n, SF) for n in sorted(SQL) if n.startswith("season_")])
def test_query_equals_sql(spark, name, folder):
    df, rel = registry.queries()[name](spark, folder), connected(folder).sql(SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert canonical(df.collect(), df.columns) == canonical(rel.fetchall(), list(rel.columns))


#: Queries that may call Python: solvers, streams of groups and file writers.
PYTHON = {"archived_documents", "copied_documents", "batch_scoring", "saved_scoring", "ols_predict", "level_effects_predict", "season_feature_guards", "season_model_guards", "season_model_metrics"}


@pytest.mark.parametrize("name", sorted(n for n in registry.queries() if n not in PYTHON and not n.startswith("season_")))
def test_no_cartesian_product_and_no_python(spark, name):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "Python" not in plan and "MapInArrow" not in plan and "FlatMapGroups" not in plan


def test_scan_reads_only_needed_columns(spark):
    plan = registry.queries()["masked_agg"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string,l_linestatus:string>" in plan
