import os

import duckdb
import pytest

import __spark_entry__ as entry
from contactloom import catalog

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def same(spark_rows, duck_rows):
    norm = lambda rows: sorted(tuple(sorted((k, str(v)) for k, v in r.items())) for r in rows)
    return norm(spark_rows) == norm(duck_rows)


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    got = [r.asDict() for r in entry.queries()[name](spark, SF).collect()]
    cur = duck.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in cur.description]
    assert same(got, [dict(zip(columns, r, strict=True)) for r in cur.fetchall()])
    assert got


def test_counts_known_for_these_tables(spark, duck):
    assert entry.queries()["mate_pairs"](spark, SF).count() == 512
    assert entry.queries()["narrow_mismatches"](spark, SF).count() == 46


def test_entry(spark, duck):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(set(catalog.queries()) - set(catalog.oracle_sql())))
def test_queries_without_sql_run(spark, duck, name):
    assert entry.queries()[name](spark, SF).count() > 0


@pytest.mark.parametrize("name", ["mate_pairs", "edge_counts", "reduced_alignments"])
def test_steps_after_the_site_filter_do_not_read_all_alignments(spark, duck, name):
    plan = entry.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "near-" in plan and "ordered-" not in plan


def test_summary_reads_all_alignments_once(spark, duck):
    """For their count; the other table with numbers is that of the nodes."""
    plan = entry.queries()["filter_summary"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert sum("FileScan" in line and "ordered-" in line for line in plan.splitlines()) == 2


def test_edge_counts_sort_no_alignments(spark, duck, monkeypatch):
    """Only nodes get numbers; contacts are counted from rows that are compared."""
    from contactloom.operators import ordinals

    names, stage = [], ordinals.stage
    monkeypatch.setattr(ordinals, "stage", lambda df, name: names.append(df.columns) or stage(df, name))
    assert entry.queries()["edge_counts"](spark, SF).count() > 0
    assert names and not any("read_name" in columns for columns in names)
